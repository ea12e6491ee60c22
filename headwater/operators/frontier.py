"""A day collected from a source that gives no more than so many rows at once: full windows are halved, level by level.

All windows of a level are asked for by the executors at the same time. Their answers land in a folder before anything is done with them, so
what has been received stays when a later window fails, and are read from there. Windows whose answer is full go into the
next level as halves; one that the source refuses is kept as blocked, and its siblings go on.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.sources import listing

#: The deepest level that a caller can ask for: 32 windows.
DEEPEST = 5
ANSWERS = "attempt int, n int, depth int, start timestamp_ntz, end timestamp_ntz, body string, error string"
WINDOWS = "n int, depth int, start timestamp_ntz, end timestamp_ntz, count long, hit_cap boolean, split boolean, truncated boolean, blocked boolean, reason string"


class Blocked(RuntimeError):
    """Not one window of a day could be had."""


@dataclass
class Window:
    n: int
    depth: int
    start: datetime
    end: datetime

    def halves(self) -> list[Window]:
        """Two windows that share their middle second; none of a window that is too short for that."""
        seconds = int((self.end - self.start).total_seconds())
        if seconds < 2:
            return []
        middle = self.start + timedelta(seconds=seconds // 2)
        return [Window(2 * self.n, self.depth + 1, self.start, middle), Window(2 * self.n + 1, self.depth + 1, middle, self.end)]


def _ask(batches: Iterable[pa.RecordBatch], fetch: Callable[[str, str, int], str | dict], cap: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies, errors = [], []
        for start, end in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            try:
                found = fetch(start.strftime("%Y%m%d%H%M%S"), end.strftime("%Y%m%d%H%M%S"), cap)
                bodies.append(found if isinstance(found, str) else json.dumps(found, ensure_ascii=False))
                errors.append(None)
            except listing.RateLimited as e:
                bodies.append(None)
                errors.append(str(e)[:500] or "refused")
        yield pa.record_batch([*batch.columns, pa.array(bodies, pa.string()), pa.array(errors, pa.string())], names=[*batch.schema.names, "body", "error"])


def collect(spark: SparkSession, fetch: Callable[[str, str, int], str | dict], first: datetime, last: datetime, folder: str, cap: int = listing.MAX_RECORDS, depth: int = DEEPEST, workers: int = 6, again: int = 1) -> tuple[DataFrame, DataFrame]:
    """The windows that were asked for and the landed answers (window, state, articles) of [first, last].

    ``fetch(start, end, cap)`` runs on the executors, ``workers`` windows at a time, and returns a body or its object; it may raise
    ``RateLimited``. A body that isn't a list of articles blocks its window as well. A day without a single row is asked for ``again`` times more, as
    a source that is busy may say nothing. If nothing could be had at all, ``Blocked`` is raised with the source's words.
    """
    depth = max(0, min(depth, DEEPEST))
    for attempt in range(again + 1):
        told: list[tuple] = []
        level = [Window(1, 0, first, last)]
        while level:
            rows = [(attempt, w.n, w.depth, w.start, w.end) for w in level]
            asked = spark.createDataFrame(rows, ANSWERS.rsplit(", body", 1)[0]).repartition(min(workers, len(rows)), "n")
            out = f"{folder}/attempt={attempt}-level={level[0].depth}"
            asked.mapInArrow(lambda b: _ask(b, fetch, cap), ANSWERS).write.mode("overwrite").parquet(out)
            # at most 32 windows of a level
            states = {r.n: r for r in listing.parsed_answers(spark.read.parquet(out)).select("n", "state", F.size("articles").alias("n_items"), "error").collect()}
            below = []
            for w in level:
                s = states[w.n]
                blocked = s.state != "ok"
                full = not blocked and s.n_items >= cap
                halves = w.halves() if full and w.depth < depth else []
                why = (s.error or "the answer isn't a list") if blocked else None
                if full and not halves:
                    why = "the deepest level is reached" if w.depth >= depth else "the window can't be halved"
                told.append((w.n, w.depth, w.start, w.end, 0 if blocked else s.n_items, full, bool(halves), full and not halves, blocked, why))
                below += halves
            level = below
        received = sum(t[4] for t in told)
        if received or any(t[8] for t in told):
            break
    if all(t[8] for t in told):
        raise Blocked(told[0][9])
    landed = spark.read.schema(ANSWERS).parquet(*[f"{folder}/attempt={attempt}-level={d}" for d in sorted({t[1] for t in told})])
    return spark.createDataFrame(told, WINDOWS), listing.parsed_answers(landed).drop("body")


def items(answers: DataFrame) -> DataFrame:
    """The rows of all answers, as the source gave them, with the window (``n``)."""
    return answers.where("state = 'ok'").select("n", F.inline("articles"))
