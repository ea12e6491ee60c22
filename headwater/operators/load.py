"""Keep-first deduplication, idempotent loading and stored decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headwater.operators import keyindex
from headwater.session import settled


def keep_first(df: DataFrame, key: Column, *order: Column | str) -> DataFrame:
    """The first row of each key. A minimum of structs is combined on the map side, so a hot key moves a row for each task."""
    columns = [F.col(o) if isinstance(o, str) else o for o in order]
    keyed = df.select(key.alias("_key"), F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(columns)], F.struct(*df.columns).alias("_row")).alias("_all"))
    return keyed.groupBy("_key").agg(F.min("_all").alias("_all")).select("_all._row.*")


def dedupe_metrics(df: DataFrame, key: Column, url: str, *order: str) -> DataFrame:
    """Rows dropped as repeats, how many of those have another link text than the first, and rows kept."""
    firsts = df.select(key.alias("_key"), F.struct(*order, url).alias("_o"), F.col(url).alias("_url"))
    # counted by key and link text first: both steps combine on the map side
    texts = firsts.groupBy("_key", "_url").agg(F.count("*").alias("n"), F.min("_o").alias("o"))
    keys = texts.groupBy("_key").agg(F.sum("n").alias("n"), F.min(F.struct("o", F.col("n").alias("own"))).alias("first"))
    return keys.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicated"), F.coalesce(F.sum(F.col("n") - F.col("first.own")), F.lit(0)).alias("merged_distinct_urls"), F.count("*").alias("kept"))


def first_wins(batches: DataFrame, *order: str) -> DataFrame:
    """What loading the batches in order leaves: the first row of each link; blank links vanish."""
    rows = batches.where(F.coalesce(F.trim("url"), F.lit("")) != "")
    return keep_first(rows, F.col("url"), *order)


def load(spark: SparkSession, new: DataFrame, path: str, *order: str) -> DataFrame:
    """Appends links that the table at ``path`` lacks, partitioned by kst_date; returns inserted, duplicated and total.

    A link once stored keeps its day. Stored links are looked up in the buckets that the new ones fall into (``keyindex``); the table itself isn't read.
    """
    rows = settled(new.where(F.coalesce(F.trim("url"), F.lit("")) != ""))
    seen = rows.count()
    inserted, total = keyindex.load(spark, new, path, keep_first(rows, F.col("url"), *order), "url", "kst_date")
    if not total:
        # a table that has never had a row is still one
        new.limit(0).write.mode("append").partitionBy("kst_date").parquet(path)
    return spark.createDataFrame([(inserted, seen - inserted, total)], "inserted long, duplicated long, total long")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where there is none yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def run_log(batches: DataFrame) -> DataFrame:
    """For each batch, in order, how many links it inserted and how many were there already."""
    rows = batches.where(F.coalesce(F.trim("url"), F.lit("")) != "")
    firsts = rows.groupBy("url").agg(F.min("batch").alias("batch")).groupBy("batch").agg(F.count("*").alias("inserted"))
    return rows.groupBy("batch").agg(F.count("*").alias("n")).join(firsts, "batch", "left").select("batch", F.coalesce("inserted", F.lit(0)).alias("inserted"), (F.col("n") - F.coalesce("inserted", F.lit(0))).alias("duplicated"))


def append_run(spark: SparkSession, day: Column, metrics: DataFrame, started_at: str, path: str) -> None:
    """One row of the run log for a load: its day, when it began, and what ``load`` told."""
    metrics.select(day.alias("kst_date"), F.lit(started_at).alias("started_at"), "inserted", "duplicated").write.mode("append").parquet(path)


def runs_of_day(log: DataFrame, day: Column) -> DataFrame:
    """The loads of a day, numbered in the order in which they began."""
    order = Window.partitionBy("kst_date").orderBy("started_at")
    return log.where(F.col("kst_date") == day).withColumn("run", F.row_number().over(order))


def positioned(decisions: DataFrame) -> DataFrame:
    """Positions from 0 in a day: kept rows first, dropped ones go on."""
    w = Window.partitionBy("kst_date").orderBy(F.col("verdict") != "kept", "pos")
    return decisions.withColumn("position", F.row_number().over(w) - 1)


def must_judge_again(stored: DataFrame, handled: DataFrame, key: str = "url") -> bool:
    """Whether the multisets of links differ."""
    a, b = (d.groupBy(key).agg(F.count("*").alias("n")) for d in (stored, handled))
    return not a.exceptAll(b).isEmpty() or not b.exceptAll(a).isEmpty()
