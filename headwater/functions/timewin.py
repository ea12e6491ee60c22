"""Local days, weeks and slices. Local time is UTC+9 throughout the year."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSET_HOURS = 9


def local_date(ts: Column) -> Column:
    return F.to_date(ts + F.expr(f"INTERVAL {OFFSET_HOURS} HOURS"))


def seen_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts.cast("timestamp"), "yyyyMMdd"), F.lit("T"), F.date_format(ts.cast("timestamp"), "HHmmss"), F.lit("Z"))


def normal_seen(c: Column) -> Column:
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) == 14, F.concat(F.substring(digits, 1, 8), F.lit("T"), F.substring(digits, 9, 6), F.lit("Z"))).otherwise(c)


def local_date_of_text(c: Column) -> Column:
    """The local day of a UTC text of 14 digits; null if it isn't one."""
    digits = F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")
    return F.when(F.length(digits) == 14, F.to_date(F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")) + F.expr(f"INTERVAL {OFFSET_HOURS} HOURS")))


def day_window(day: date) -> tuple[datetime, datetime]:
    """First and last second of a local day, in UTC."""
    first = datetime(day.year, day.month, day.day) - timedelta(hours=OFFSET_HOURS)
    return first, first + timedelta(days=1, seconds=-1)


def week_start(day: date) -> date:
    return day - timedelta(days=day.weekday())


def shifted(day: date, days: int) -> date:
    return day + timedelta(days=days)


def days_between(first: date, last: date) -> list[date]:
    """All days of a range, which may be given the wrong way round."""
    first, last = min(first, last), max(first, last)
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def local_today(now: datetime) -> date:
    """The local day of a moment in UTC."""
    return (now + timedelta(hours=OFFSET_HOURS)).date()


def slices(spark: SparkSession, first: datetime, last: datetime, minutes: int = 15) -> DataFrame:
    """Stamps of the slices that begin in [first, last]."""
    step = timedelta(minutes=minutes)
    start = datetime.min + ((first - datetime.min) // step) * step
    start = start if start >= first else start + step
    n = max(0, (last - start) // step + 1)
    return spark.range(n).select(F.date_format(F.timestamp_seconds(F.lit(int((start - datetime(1970, 1, 1)).total_seconds())) + F.col("id") * minutes * 60), "yyyyMMddHHmmss").alias("stamp"))


def calendar(days: DataFrame, column: str = "kst_date") -> DataFrame:
    """All days from the first to the last of a table's."""
    return days.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias(column))
