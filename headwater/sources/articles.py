"""Articles from tables, captured lists and slice files."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions import text, timewin, urls

LIST_SCHEMA = "articles array<struct<url:string,url_mobile:string,title:string,seendate:string,socialimage:string,domain:string,language:string,sourcecountry:string>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pos, url, title, domain, seen_ts and kst_date: a page's link, the whole first line of a document, and an event's time."""
    pages, docs, events = (table(spark, sf_dir, n) for n in ("pages", "documents", "events"))
    n = F.broadcast(events.agg(F.count("*").alias("n")))
    keyed = pages.select(F.col("page_id").alias("pos"), "url").crossJoin(n).withColumn("event_id", F.col("pos") * 37 % F.col("n")).drop("n")
    lines = docs.select(F.col("doc_id").alias("pos"), F.split_part(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(1)).alias("title"), F.col("source").alias("domain"))
    return keyed.join(lines, "pos").join(events.select("event_id", F.col("ts").alias("seen_ts")), "event_id").select("pos", "url", "title", "domain", "seen_ts", timewin.local_date(F.col("seen_ts")).alias("kst_date"))


def captured_list(spark: SparkSession, path: str) -> DataFrame:
    """Items of captured article lists, one JSON document a file; control characters inside strings are let through."""
    read = spark.read.schema(LIST_SCHEMA).option("multiLine", True).option("allowUnquotedControlChars", True)
    return read.json(path).select(F.inline("articles"))


def normalised(raw: DataFrame) -> DataFrame:
    """Rows with a link, with cleaned titles, lower-case domains (from the link where empty) and uniform times."""
    url = text.strip(F.col("url"))
    domain = F.lower(text.strip(F.col("domain")))
    host = F.regexp_replace(F.lower(F.regexp_extract(urls.tidy(url), r"^[a-zA-Z]+://([^/?#]*)", 1)), r"^www\.", "")
    return raw.where(url != "").select(
        urls.tidy(url).alias("url"), text.clean_title(F.col("title")).alias("title"), F.col("title").alias("title_raw"), F.when(domain != "", domain).otherwise(host).alias("domain"), timewin.normal_seen(F.col("seendate")).alias("seendate"), F.coalesce("language", F.lit("")).alias("language")
    )


def within(df: DataFrame, first: str, last: str, column: str = "seendate") -> DataFrame:
    """Rows whose 14 digits lie in [first, last]."""
    digits = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), "[^0-9]", "")
    return df.where((F.length(digits) == 14) & digits.between(first, last))


def _unzip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                lines = []
                for line in io.TextIOWrapper(f, "utf-8", errors="replace", newline="\n"):
                    lines.append(line.rstrip("\n"))
                    if len(lines) == 4096:
                        yield pa.record_batch([pa.array([path] * len(lines)), pa.array(lines)], names=["path", "line"])
                        lines = []
                yield pa.record_batch([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.string())], names=["path", "line"])


def slice_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of zipped slice files, a member each."""
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_unzip, "path string, line string")


def parse_slices(lines: DataFrame, pattern: str, language: str = "kor") -> tuple[DataFrame, DataFrame]:
    """Articles of a language whose title matches, and the two counts (all of the language, kept)."""
    f = F.split("line", "\t")
    rows = lines.where(F.size(f) > 26).select(F.get(f, 1).alias("at"), F.get(f, 3).alias("domain"), F.get(f, 4).alias("url"), F.regexp_extract(F.get(f, 25), r"srclc:(\w+)", 1).alias("code"), text.unescape_twice(F.regexp_extract(F.get(f, 26), "(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>", 1)).alias("title"))
    rows = rows.where(F.col("code") == language)
    picked = (text.strip(F.col("title")) != "") & F.col("title").rlike("(?i)" + pattern)
    kept = rows.where(picked).select("url", text.strip(F.col("title")).alias("title"), F.lower("domain").alias("domain"), timewin.normal_seen(F.col("at")).alias("seendate"))
    return kept, rows.agg(F.count("*").alias("n_language"), F.count_if(picked).alias("n_kept"))


def missing_slices(expected: DataFrame, landed: DataFrame, most: int = 8) -> DataFrame:
    """Stamps without a file; raises if too many are missing for a day to count as complete."""
    missing = expected.join(landed, "stamp", "left_anti")
    if (n := missing.count()) > most:
        raise RuntimeError(f"{n} slices are missing; at most {most} may be")
    return missing


def settings(*paths: str) -> dict:
    """Settings files over one another: objects merge, lists and values replace. A missing file is empty, a malformed one an error."""
    out: dict = {}
    for p in paths:
        if Path(p).exists():
            try:
                found = json.loads(Path(p).read_text(encoding="utf-8"))
            except json.JSONDecodeError as e:
                raise ValueError(f"{p}, line {e.lineno}: {e.msg}") from e
            if not isinstance(found, dict):
                raise ValueError(f"{p} doesn't hold an object")
            out = merged(out, found)
    return out


def merged(a: dict, b: dict) -> dict:
    return {**a, **{k: merged(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}}


def setting(config: dict, dotted: str, default=None):
    """A value by its dotted name. An empty list is a value: it disables; only an absent key means the default."""
    for key in dotted.split("."):
        if not isinstance(config, dict) or key not in config:
            return default
        config = config[key]
    return config


def overridden(config: dict, environ: dict, prefix: str = "HEADWATER_CFG__") -> dict:
    """Settings from variables such as PREFIX + judge__threshold, read as JSON where they are."""
    for name, value in environ.items():
        if name.startswith(prefix):
            try:
                value = json.loads(value)
            except ValueError:
                pass
            for key in reversed(name[len(prefix) :].split("__")):
                value = {key: value}
            config = merged(config, value)
    return config
