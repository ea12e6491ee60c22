"""Adaptive bisection of time windows that hit a source's cap."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidates(first: datetime, last: datetime, depth: int) -> list[tuple[int, int, datetime, datetime, bool]]:
    """(number, depth, start, end, splittable) of all windows that halving may reach. Halves share their middle second."""
    out, level = [], [(1, first, last)]
    for d in range(max(0, min(5, depth)) + 1):
        below = []
        for n, a, b in level:
            can = (b - a).total_seconds() >= 2
            out.append((n, d, a, b, can))
            if can:
                middle = a + timedelta(seconds=int((b - a).total_seconds()) // 2)
                below += [(2 * n, a, middle), (2 * n + 1, middle, b)]
        level = below
    return out


def bisect(rows: DataFrame, first: datetime, last: datetime, cap: int, depth: int = 5, at: str = "seen_ts") -> DataFrame:
    """The windows that would be asked for: the whole, and halves of those that are full.

    63 windows at most are broadcast and counted in one pass; a window is kept if all above it are full.
    """
    spark = rows.sparkSession
    table = [(n, d, a, b, c, [n >> i for i in range(1, d + 1)]) for n, d, a, b, c in candidates(first, last, depth)]
    windows = spark.createDataFrame(table, "n int, depth int, start timestamp_ntz, end timestamp_ntz, splittable boolean, above array<int>")
    seconds = rows.where(F.col(at).between(F.lit(first), F.lit(last))).groupBy(F.date_trunc("second", at).cast("timestamp_ntz").alias("s")).agg(F.count("*").alias("c"))
    counted = F.broadcast(windows).join(seconds, F.col("s").between(F.col("start"), F.col("end")), "inner").groupBy("n").agg(F.sum("c").alias("count"))
    all_ = windows.join(counted, "n", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    full = all_.agg(F.collect_set(F.when(F.col("count") >= cap, F.col("n"))).alias("full"))
    out = all_.crossJoin(F.broadcast(full)).where(F.size(F.array_except("above", "full")) == 0)
    hit = F.col("count") >= cap
    split = hit & F.col("splittable") & (F.col("depth") < max(0, min(5, depth)))
    return out.select("n", "depth", "start", "end", "count", hit.alias("hit_cap"), split.alias("split"), (hit & ~split).alias("truncated"))


def union_of_windows(rows: DataFrame, asked: DataFrame, at: str = "seen_ts") -> DataFrame:
    """The rows of all windows that were asked for, with the window's number. Few windows are broadcast; a row comes once for each that holds it."""
    first, last = asked.agg(F.min("start"), F.max("end")).first()
    inside = rows.where(F.col(at).between(F.lit(first), F.lit(last)))
    second = F.date_trunc("second", at).cast("timestamp_ntz")
    return inside.join(F.broadcast(asked.select("n", "start", "end")), second.between(F.col("start"), F.col("end")))
