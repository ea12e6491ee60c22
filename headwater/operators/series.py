"""Counts over days and weeks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.functions import keywords, timewin


def daily_counts(articles: DataFrame) -> DataFrame:
    """kst_date and n, with zeros for days between. The calendar comes from the counts, so articles are read once."""
    counted = articles.groupBy("kst_date").agg(F.count("*").alias("n"))
    return timewin.calendar(counted).join(counted, "kst_date", "left").select("kst_date", F.coalesce("n", F.lit(0)).alias("n"))


def recent_average(daily: DataFrame, days: int = 7, least: int = 3, since: Column | None = None) -> DataFrame:
    """Mean of the days before that have articles, and how many there are; null with fewer than ``least``. Days before ``since`` don't count."""
    number = F.datediff("kst_date", F.lit("1970-01-01"))
    # one row for each day of the history
    w = Window.orderBy("d").rangeBetween(-days, -1)
    some = F.when((F.col("n") > 0) if since is None else (F.col("n") > 0) & (F.col("kst_date") >= since), F.col("n"))
    out = daily.withColumn("d", number).select("kst_date", "n", F.avg(some).over(w).alias("mean"), F.count(some).over(w).alias("days_used"))
    return out.select("kst_date", "n", F.when(F.col("days_used") >= least, F.round("mean", 6)).alias("avg_n"), "days_used")


def total_of_day(articles: DataFrame, day: Column) -> DataFrame:
    return articles.where(F.col("kst_date") == day).agg(F.count("*").alias("n"))


def keyword_counts(articles: DataFrame, words: list[str], first: date | None = None, last: date | None = None) -> DataFrame:
    """Articles whose title has the keyword, zeros included: one scan with a sum each. Days are inclusive; a reversed range is turned round."""
    if first and last:
        first, last = min(first, last), max(first, last)
    for bound, sign in ((first, 1), (last, -1)):
        if bound:
            articles = articles.where(F.col("kst_date") >= F.lit(bound) if sign > 0 else F.col("kst_date") <= F.lit(bound))
    distinct = list({w.lower(): w for w in reversed(words)}.values())[::-1]
    sums = articles.agg(*[F.coalesce(F.sum(keywords.counts(F.col("title"), w).cast("long")), F.lit(0)).alias(f"k{i}") for i, w in enumerate(distinct)])
    return sums.select(F.inline(F.array(*[F.struct(F.lit(w).alias("keyword"), F.col(f"k{i}").alias("n")) for i, w in enumerate(distinct)])))


def keyword_days(articles: DataFrame, words: list[str]) -> DataFrame:
    """keyword, kst_date, n on the full grid of days."""
    sums = articles.groupBy("kst_date").agg(*[F.sum(keywords.counts(F.col("title"), w).cast("long")).alias(f"k{i}") for i, w in enumerate(words)])
    grid = timewin.calendar(sums).join(sums, "kst_date", "left")
    return grid.select("kst_date", F.inline(F.array(*[F.struct(F.lit(w).alias("keyword"), F.coalesce(F.col(f"k{i}"), F.lit(0)).alias("n")) for i, w in enumerate(words)])))


def first_seen(articles: DataFrame, words: list[str], lookback: int = 7) -> DataFrame:
    """Days on which a keyword occurs and in the days before doesn't."""
    return first_seen_of(keyword_days(articles, words), lookback)


def first_seen_of(counts: DataFrame, lookback: int = 7) -> DataFrame:
    """The same from counts (keyword, kst_date, n); days without a row count as none."""
    w = Window.partitionBy("keyword").orderBy("d").rangeBetween(-lookback, -1)
    grid = counts.withColumn("d", F.datediff("kst_date", F.lit("1970-01-01")))
    return grid.withColumn("before", F.coalesce(F.max("n").over(w), F.lit(0))).where("n > 0 and before = 0").select("keyword", "kst_date", "n")


def week_over_week(articles: DataFrame, words: list[str]) -> DataFrame:
    """keyword, week, this_week, last_week, delta and note; weeks begin on Monday; rows of two zeros are left out."""
    weekly = keyword_days(articles, words).groupBy("keyword", F.to_date(F.date_trunc("WEEK", "kst_date")).alias("week")).agg(F.sum("n").alias("this_week"))
    last = F.coalesce(F.lag("this_week").over(Window.partitionBy("keyword").orderBy("week")), F.lit(0))
    out = weekly.withColumn("last_week", last).where("this_week > 0 or last_week > 0")
    note = F.when(F.col("last_week") == 0, "new").when(F.col("this_week") == 0, "gone").otherwise("")
    return out.withColumn("delta", F.col("this_week") - F.col("last_week")).withColumn("note", note)


def top(rows: DataFrame, n: int) -> DataFrame:
    """The first of each week by this week's count, last week's and the keyword."""
    w = Window.partitionBy("week").orderBy(F.desc("this_week"), F.desc("last_week"), "keyword")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def volume_status(n: Column, mean: Column, used: Column, least: int = 3) -> Column:
    return F.when(mean.isNull() | (used < least), "skip").when((n / mean <= 0.5) | (n / mean >= 2.0), "warn").otherwise("ok")


def volume_words(n: Column, mean: Column) -> Column:
    """similar within a twentieth of the mean or one article, else more or fewer."""
    diff = n - mean
    return F.when(mean.isNull(), "unknown").when(F.abs(diff) < F.greatest(F.lit(1.0), mean * 0.05), "similar").when(diff > 0, "more").otherwise("fewer")


def history(daily: DataFrame, lookback: int = 7) -> DataFrame:
    """Sum and number of non-empty days of the days before each day."""
    w = Window.orderBy("d").rangeBetween(-lookback, -1)
    out = daily.withColumn("d", F.datediff("kst_date", F.lit("1970-01-01")))
    return out.select("kst_date", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n_before"), F.count_if(F.col("n") > 0).over(w).alias("days_before")).withColumn("ready", F.col("n_before") > 0)


def daily_stats(articles: DataFrame, words: list[str], window: int = 7, least: int = 3, lookback: int = 7, since: Column | None = None) -> DataFrame:
    """For each day what its brief says in numbers: articles, mean of the days before, days used, articles of the look-back, and keywords first seen.

    Keywords are left out (``skipped``) where nothing at all is stored for the look-back, as everything would be new then.
    """
    return stats_of(daily_counts(articles), first_seen(articles, words, lookback), words, window, least, lookback, since)


def stats_of(daily: DataFrame, seen: DataFrame, words: list[str], window: int = 7, least: int = 3, lookback: int = 7, since: Column | None = None) -> DataFrame:
    """The same from counts of all days and the keywords first seen."""
    mean = recent_average(daily, window, least, since).select("kst_date", F.col("n").alias("article_count"), F.coalesce("avg_n", F.lit(0.0)).alias("avg_7d"), "days_used")
    past = history(daily, lookback).select("kst_date", "n_before")
    place = F.create_map(*[F.lit(x) for i, w in enumerate(words) for x in (w, i)])
    new = seen.groupBy("kst_date").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.element_at(place, F.col("keyword")).alias("i"), "keyword"))), lambda x: x["keyword"]).alias("seen"))
    out = mean.join(past, "kst_date").join(new, "kst_date", "left").withColumn("skipped", F.col("n_before") == 0)
    none = F.array().cast("array<string>")
    return out.withColumn("first_seen", F.when(F.col("skipped"), none).otherwise(F.coalesce("seen", none))).drop("seen")
