"""Counts by day and by keyword and day, kept beside the articles: a change counts its own days anew, and questions read the counts alone."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions import automaton, timewin
from headwater.operators import report, series
from headwater.sinks.versions import DAY, DayTables

SCHEMAS = {"days": "n long", "keywords": "keyword string, n long"}


def tables(spark: SparkSession, folder: str) -> DayTables:
    return DayTables(spark, folder, SCHEMAS)


def refresh(store: DayTables, articles: DataFrame, words: list[str], days: list[date] | None = None) -> int:
    """Counts ``days`` anew, or all days of ``articles``, and puts both counts in place in one step; returns the version.

    ``articles`` has day and title; of a table by day only the days given are read. A day without articles any more is stored as an empty one. Words
    are those to count from now on: where the list changes, refresh all days.
    """
    if days is None:
        days = [r[DAY] for r in articles.select(DAY).distinct().collect()]
    rows = articles.where(F.col(DAY).isin(*days)) if days else articles.limit(0)
    own = list({w.strip().lower(): w for w in reversed(words)}.values())[::-1]
    return store.replace(days, {"days": rows.groupBy(DAY).agg(F.count("*").alias("n")), "keywords": automaton.counted(rows, own, DAY)})


def daily_counts(store: DayTables, state: dict | None = None) -> DataFrame:
    """kst_date and n, with zeros for days between."""
    counted = store.read("days", state=state)
    return timewin.calendar(counted).join(counted, DAY, "left").select(DAY, F.coalesce("n", F.lit(0)).alias("n"))


def keyword_counts(store: DayTables, words: list[str], first: date | None = None, last: date | None = None) -> DataFrame:
    """keyword and n in [first, last], zeros included; a reversed range is turned round, words equal in lower case are one."""
    if first and last:
        first, last = min(first, last), max(first, last)
    own = list({w.strip().lower(): w for w in reversed(words)}.values())[::-1]
    names = store.spark.createDataFrame([(w, w.strip().lower()) for w in own], "keyword string, key string")
    sums = store.read("keywords", first, last).groupBy(F.lower(F.trim("keyword")).alias("key")).agg(F.sum("n").alias("n"))
    return names.join(sums, "key", "left").select("keyword", F.coalesce("n", F.lit(0)).alias("n"))


def daily_stats(store: DayTables, words: list[str], window: int = 7, least: int = 3, lookback: int = 7, since: Column | None = None) -> DataFrame:
    """The same as ``series.daily_stats``. Days on which a keyword doesn't occur need no row."""
    state = store.days()
    seen = series.first_seen_of(store.read("keywords", state=state).where(F.col("keyword").isin(*words)), lookback)
    return series.stats_of(daily_counts(store, state), seen, words, window, least, lookback, since)


def week_rows(store: DayTables, entries: list[dict], start: date, most: int = 5) -> DataFrame:
    """The same as ``report.week_rows``; two weeks' folders are read."""
    spark = store.spark
    names = spark.createDataFrame([(e["name"], e.get("roman") or "") for e in entries], "keyword string, roman string")
    this = F.col(DAY) >= F.lit(start)
    two = store.read("keywords", start - timedelta(days=7), start + timedelta(days=6)).groupBy("keyword").agg(F.sum(F.when(this, F.col("n")).otherwise(0)).alias("this_week"), F.sum(F.when(~this, F.col("n")).otherwise(0)).alias("last_week"))
    return report.shaped_rows(names.join(two, "keyword").select("keyword", "roman", "this_week", "last_week"), most)
