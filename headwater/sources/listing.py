"""Article lists of a query service: addresses, answers, retries, and downloads of slice files by the executors."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.functions import text
from headwater.sources.articles import LIST_SCHEMA

#: What the service and its limits are.
ADDRESS = "https://api.gdeltproject.org/api/v2/doc/doc"
MAX_RECORDS, PAUSE, TIMEOUT = 250, 5, 40
RETRY_WAITS = (30, 90, 180, 300)


class FetchError(RuntimeError):
    pass


class RateLimited(FetchError):
    """An answer that isn't JSON, or a status that says so: asked too often."""


def address(query: str, first: str, last: str, most: int = MAX_RECORDS, base: str = ADDRESS) -> str:
    """The address that lists articles of [first, last], 14 digits each in UTC, latest first."""
    fields = {"query": query, "mode": "artlist", "format": "json", "startdatetime": first, "enddatetime": last, "maxrecords": int(most), "sort": "datedesc"}
    return base + "?" + urllib.parse.urlencode(fields, quote_via=urllib.parse.quote)


def body(url: str, opener: Callable = urllib.request.urlopen, agent: str = "headwater/1.0") -> str:
    try:
        with opener(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=TIMEOUT) as answer:
            return answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        kind = RateLimited if e.code in (429, 503) else FetchError
        raise kind(f"status {e.code}: {e.read().decode('utf-8', 'replace')[:200]}") from e
    except urllib.error.URLError as e:
        raise FetchError(f"not reached: {e.reason}") from e


def parse(answer: str) -> dict:
    """The object of an answer; a bare list is its articles, control characters inside strings are let through."""
    try:
        found = json.loads(answer or "", strict=False)
    except json.JSONDecodeError as e:
        raise RateLimited(f"no JSON: {(answer or '')[:200]!r}") from e
    if isinstance(found, list):
        return {"articles": found}
    if not isinstance(found, dict):
        raise RateLimited(f"no list of articles: {answer[:200]!r}")
    return found


def fetch(url: str, opener: Callable = urllib.request.urlopen, pause: float = PAUSE, waits: Iterable[float] = RETRY_WAITS, sleep: Callable[[float], None] = time.sleep) -> dict:
    """The parsed answer of an address: a pause first, then again after each of ``waits`` while the service asks for patience."""
    if pause > 0:
        sleep(pause)
    for wait in [*(w for w in waits if w > 0), None]:
        try:
            return parse(body(url, opener))
        except RateLimited:
            if wait is None:
                raise
            sleep(wait)
    raise AssertionError


def parsed_answers(answers: DataFrame) -> DataFrame:
    """The column ``body`` of many answers at once: ``state`` is ok or rate_limited, ``articles`` the items.

    Empty and non-JSON bodies, and JSON that is neither an object nor a list, are rate-limited; a bare list is wrapped.
    """
    b = text.strip(F.col("body"))
    wrapped = F.when(b.startswith("["), F.concat(F.lit('{"articles":'), b, F.lit("}"))).otherwise(b)
    read = F.from_json(wrapped, f"{LIST_SCHEMA}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowUnquotedControlChars": "true"})
    out = answers.withColumn("_read", read)
    ok = (b != "") & wrapped.startswith("{") & F.col("_read").isNotNull() & F.col("_read._corrupt").isNull()
    none = F.array().cast(LIST_SCHEMA.split(" ", 1)[1])
    return out.select(*answers.columns, F.when(ok, "ok").otherwise("rate_limited").alias("state"), F.when(ok, F.coalesce("_read.articles", none)).otherwise(none).alias("articles"))


def in_source_order(parsed: DataFrame, most: int = MAX_RECORDS) -> DataFrame:
    """Items of parsed answers, at most ``most`` of each, with their place in the answer."""
    return parsed.select(*[c for c in parsed.columns if c not in ("articles", "state")], F.posexplode(F.slice("articles", 1, most)).alias("place", "item")).select("*", "item.*").drop("item")


def counted_items(parsed: DataFrame) -> DataFrame:
    """Items, and those without a link, which normalisation leaves out."""
    items = parsed.select(F.explode("articles").alias("a"))
    return items.agg(F.count("*").alias("n_items"), F.count_if(text.strip(F.col("a.url")) == "").alias("dropped_no_url"))


def _download(batches: Iterable[pa.RecordBatch], folder: str, attempts: int) -> Iterator[pa.RecordBatch]:
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    for batch in batches:
        states, sizes = [], []
        for stamp, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            state, data = "failed", b""
            for _ in range(attempts):
                try:
                    with urllib.request.urlopen(url, timeout=TIMEOUT) as answer:
                        state, data = "landed", answer.read()
                    break
                except urllib.error.HTTPError as e:
                    state = "missing" if e.code == 404 else "failed"
                    if state == "missing":
                        break
                except urllib.error.URLError as e:
                    state = "missing" if isinstance(e.reason, FileNotFoundError) else "failed"
                    if state == "missing":
                        break
            if state == "landed":
                # a repeated task writes the same bytes to the same place
                with system.open_output_stream(f"{place}/{stamp}.zip", compression=None) as out:
                    out.write(data)
            states.append(state)
            sizes.append(len(data))
        yield pa.record_batch([batch.column(0), pa.array(states, pa.string()), pa.array(sizes, pa.int64())], names=["stamp", "state", "bytes"])


def download(slices: DataFrame, folder: str, attempts: int = 3, workers: int = 6) -> DataFrame:
    """Lands the files of slices (stamp, url) in ``folder``, a few at a time on each of ``workers`` tasks: stamp, state (landed, missing or failed) and bytes."""
    return slices.select("stamp", "url").repartition(workers).mapInArrow(lambda b: _download(b, folder, attempts), "stamp string, state string, bytes long")
