"""The eleven checks of a day, as rows of place, check, status, n, value and note.

Each input is aggregated once into a row of facts; the rows of facts are joined and unfolded into checks. Notes
are machine-readable; ``wording`` has the names that people read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.functions import text, timewin, urls
from headwater.functions.wording import CHECK_TABLE, CHECKS
from headwater.operators import grouping, series

LIMITS = {"stray": 0.1, "drop": 0.7, "low": 0.5, "high": 2.0, "least_days": 3, "least_mean": 3.0, "lookback": 7, "overlap": 0.2, "sample": 3}
REQUIRED = ("url", "title", "domain", "seendate")
_ROW = "place int, check string, status string, n long, value double, note string"


def _blank(c: str) -> Column:
    return text.strip(F.col(c).cast("string")) == ""


def _note(**parts: Column) -> Column:
    return F.concat_ws(";", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in parts.items()])


def _row(check: str, status: Column | str, n: Column, value: Column | None = None, note: Column | None = None) -> Column:
    status = F.lit(status) if isinstance(status, str) else status
    value = F.lit(None) if value is None else F.round(value, 6)
    place = list(CHECKS).index(check) + 1
    return F.struct(F.lit(place).alias("place"), F.lit(check).alias("check"), status.alias("status"), n.cast("long").alias("n"), value.cast("double").alias("value"), (F.lit("") if note is None else note).alias("note"))


def _unfold(facts: list[DataFrame], rows: list[Column]) -> DataFrame:
    """One row a check from tables of one row each."""
    return reduce(lambda a, b: a.crossJoin(F.broadcast(b)), facts).select(F.inline(F.array(*rows))).select(*[c.split()[0] for c in _ROW.split(", ")])


def collected(articles: DataFrame, day: Column, windows: DataFrame | None = None, metrics: DataFrame | None = None) -> DataFrame:
    """Checks 1 to 5 of what was collected for a day: count, full or blocked windows, dates, required fields and repeated links.

    ``articles``: url, title, domain and seendate. ``windows``: truncated and, if known, blocked. ``metrics``: one row of dropped_no_url,
    stray_dropped, duplicated and merged_distinct_urls, as the collector counted them.
    """
    spark = articles.sparkSession
    own_day = timewin.local_date_of_text(F.col("seendate"))
    dated = ~_blank("seendate")
    facts = articles.agg(
        F.count("*").alias("total"),
        F.count_if(dated & own_day.isNull()).alias("unreadable"),
        F.count_if(dated & (own_day != day)).alias("stray"),
        *[F.count_if(_blank(c)).alias(f"no_{c}") for c in REQUIRED],
    )
    url = text.strip(F.col("url"))
    key = F.coalesce(F.nullif(urls.audit_key(url), F.lit("")), url)
    again = articles.where(url != "").groupBy(key.alias("k")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("again"))
    names = ("dropped_no_url", "stray_dropped", "duplicated", "merged_distinct_urls")
    known = spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in names]) if metrics is None else metrics.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in names])
    if windows is None:
        full = spark.range(1).select(F.lit(None).cast("long").alias("full"), F.lit(None).cast("long").alias("blocked"))
    else:
        blocked = F.coalesce(F.col("blocked"), F.lit(False)) if "blocked" in windows.columns else F.lit(False)
        full = windows.agg(F.count_if(F.col("truncated") & ~blocked).alias("full"), F.count_if(blocked).alias("blocked"))
    in_list = F.col("stray") / F.greatest(F.col("total"), F.lit(1))
    dropped = F.col("stray_dropped") / F.greatest(F.col("total") + F.col("stray_dropped"), F.lit(1))
    over = lambda ratio: F.when(ratio > LIMITS["stray"], "fail").otherwise("warn")
    # rows that came into the list and rows that the collector dropped are judged apart, the former first
    dates = F.when(F.col("unreadable") > 0, "fail").when(F.col("stray") > 0, over(in_list)).when(F.col("stray_dropped") > 0, over(dropped)).otherwise("ok")
    ratio = F.when(F.col("unreadable") > 0, F.lit(None)).when(F.col("stray") > 0, in_list).when(F.col("stray_dropped") > 0, dropped).otherwise(0.0)
    empty = sum((F.col(f"no_{c}") for c in REQUIRED), F.lit(0))
    rows = [
        _row("count", F.when(F.col("total") == 0, "fail").otherwise("ok"), F.col("total"), note=_note(no_url=F.col("dropped_no_url"))),
        _row("windows", F.when(F.col("full").isNull(), "warn").when(F.col("full") + F.col("blocked") > 0, "fail").otherwise("ok"), F.col("full"), note=_note(blocked=F.coalesce("blocked", F.lit(0)))),
        _row("dates", dates, F.col("stray"), ratio, _note(unreadable=F.col("unreadable"), dropped=F.col("stray_dropped"))),
        _row("fields", F.when(empty > 0, "fail").otherwise("ok"), empty, note=_note(**{c: F.col(f"no_{c}") for c in REQUIRED})),
        _row("duplicates", F.when(F.col("again") > 0, "fail").otherwise("ok"), F.col("again"), note=_note(duplicated=F.col("duplicated"), distinct=F.col("merged_distinct_urls"))),
    ]
    return _unfold([facts, again, known, full], rows)


def loaded(articles: DataFrame, stored_day: DataFrame, daily: DataFrame, decisions: DataFrame, day: Column, since: Column | None = None) -> DataFrame:
    """Checks 6 to 10 of a day: load, history, volume, dropped ratio, and judged against stored.

    ``articles``, ``stored_day`` and ``decisions`` (with verdict) are those of the day; ``daily`` counts all stored days.
    """
    total = articles.agg(F.count("*").alias("total"))
    held = stored_day.agg(F.count("*").alias("stored"))
    at = lambda df: df.where(F.col("kst_date") == day)
    past = at(series.history(daily, LIMITS["lookback"])).agg(F.coalesce(F.max("n_before"), F.lit(0)).alias("n_before"), F.coalesce(F.max("days_before"), F.lit(0)).alias("days_before"))
    mean = at(series.recent_average(daily, LIMITS["lookback"], LIMITS["least_days"], since)).agg(F.max("avg_n").alias("mean"), F.coalesce(F.max("days_used"), F.lit(0)).alias("used"))
    judged = decisions.agg(F.count("*").alias("judged"), F.count_if(F.col("verdict") == "dropped").alias("dropped"))
    volume = F.col("total") / F.col("mean")
    odd = (volume <= LIMITS["low"]) | (volume >= LIMITS["high"])
    share = F.col("dropped") / F.nullif(F.col("judged"), F.lit(0))
    differ = F.when((F.col("judged") > 0) & (F.col("stored") > 0), F.col("judged") - F.col("stored")).otherwise(0)
    rows = [
        _row("load", F.when(F.col("stored") != F.col("total"), "warn").otherwise("ok"), F.col("stored") - F.col("total"), note=_note(stored=F.col("stored"))),
        _row("history", F.when(F.col("n_before") > 0, "ok").otherwise("warn"), F.col("n_before"), note=_note(days=F.col("days_before"))),
        _row("volume", F.when(F.coalesce(odd & (F.col("mean") >= LIMITS["least_mean"]), F.lit(False)), "warn").otherwise("ok"), F.col("used"), F.when(F.col("mean") >= LIMITS["least_mean"], volume)),
        _row("dropped", F.when(F.coalesce(share > LIMITS["drop"], F.lit(False)), "warn").otherwise("ok"), F.col("dropped"), share),
        _row("judged", F.when(differ != 0, "fail").otherwise("ok"), differ, note=_note(judged=F.col("judged"))),
    ]
    return _unfold([total, held, past, mean, judged], rows)


def link_sample(articles: DataFrame, most: int = LIMITS["sample"]) -> DataFrame:
    """The first few of a day, as the collector lists them, that have a link and a title."""
    usable = articles.where(~_blank("url") & ~_blank("title"))
    return grouping.collector_order(usable).where(F.col("place") <= most)


def links(sample: DataFrame, fetched: DataFrame, enabled: bool = False) -> DataFrame:
    """Check 11: titles against those of the pages that their links lead to. ``fetched``: url, status and html; a link without a row wasn't reached.

    Off by default, as it is the one check that goes outside.
    """
    if not enabled:
        return sample.sparkSession.range(1).select(F.inline(F.array(_row("links", "ok", F.lit(0), note=F.lit("off")))))
    both = sample.select(F.col("url"), "title").join(fetched.select("url", "status", text.page_title(F.col("html")).alias("page")), "url", "left")
    far = text.overlap(text.word_set(F.col("title")), text.word_set(F.col("page"))) < LIMITS["overlap"]
    outcome = F.when(F.col("status").isNull(), "unreached").when((F.col("status") != 200) | (F.col("page") == "") | far, "odd").otherwise("fits")
    facts = both.groupBy(outcome.alias("o")).agg(F.count("*").alias("c")).agg(*[F.coalesce(F.sum(F.when(F.col("o") == o, F.col("c"))), F.lit(0)).alias(o) for o in ("fits", "odd", "unreached")])
    status = F.when(F.col("odd") + F.col("unreached") > 0, "warn").otherwise("ok")
    return facts.select(F.inline(F.array(_row("links", status, F.col("odd"), note=_note(fits=F.col("fits"), unreached=F.col("unreached"))))))


def pages_of(pages: DataFrame, most: int = 400_000) -> DataFrame:
    """Fetched pages for ``links`` from landed ones: at most ``most`` characters of each are read."""
    return pages.select("url", F.lit(200).alias("status"), F.left("html", F.lit(most)).alias("html"))


def summary(checks: DataFrame) -> DataFrame:
    """Counts by status and the exit code."""
    return checks.agg(F.count_if(F.col("status") == "ok").alias("n_ok"), F.count_if(F.col("status") == "warn").alias("n_warn"), F.count_if(F.col("status") == "fail").alias("n_fail"), F.max((F.col("status") == "fail").cast("int")).alias("exit_code"))


def table_lines(checks: DataFrame) -> DataFrame:
    """The checks as lines of a table for people, in columns that take wide characters into account. At most eleven rows."""
    name = F.create_map(*[F.lit(x) for pair in CHECKS.items() for x in pair])
    detail = F.concat_ws(" ", F.col("n").cast("string"), F.when(F.col("value").isNotNull(), text.one_decimal(F.col("value"))), F.nullif("note", F.lit("")))
    cells = checks.select("place", F.array(F.element_at(name, F.col("check")), F.col("status"), F.coalesce(detail, F.lit(""))).alias("c"))
    head = checks.sparkSession.range(1).select(F.lit(-1).alias("place"), F.array(*[F.lit(x) for x in CHECK_TABLE]).alias("c"))
    both = head.union(cells)
    widths = both.agg(*[F.max(text.display_width(F.get("c", i))).alias(f"w{i}") for i in range(3)])
    lines = both.crossJoin(F.broadcast(widths))
    pad = lambda c, w: F.concat(c, F.repeat(F.lit(" "), (w - text.display_width(c)).cast("int")))
    rule = widths.select(F.lit(0).alias("place"), F.concat_ws("  ", *[F.repeat(F.lit("-"), F.col(f"w{i}").cast("int")) for i in range(3)]).alias("line"))
    return lines.select("place", F.rtrim(F.concat_ws("  ", *[pad(F.get("c", i), F.col(f"w{i}")) for i in range(3)])).alias("line")).union(rule)


def stray_split(articles: DataFrame, day: Column) -> tuple[DataFrame, DataFrame]:
    """Rows of the local day, and the others."""
    own = F.coalesce(F.col("kst_date") == day, F.lit(False))
    return articles.where(own), articles.where(~own)


def stray_report(articles: DataFrame, day: Column, most: int = 5) -> DataFrame:
    """How many rows lie outside the day, and the links of the first few of them, by time and link."""
    _, stray = stray_split(articles, day)
    # the least few combine on the map side, so a hot stray day gathers nowhere
    first = stray.orderBy("seen_ts", "url").limit(most).agg(F.transform(F.array_sort(F.collect_list(F.struct("seen_ts", "url"))), lambda x: x["url"]).alias("samples"))
    return stray.agg(F.count("*").alias("stray_dropped")).crossJoin(first).select("stray_dropped", F.array_join("samples", " ").alias("samples"))


def local_dates(articles: DataFrame, column: str = "seendate") -> DataFrame:
    """The audit's own day of each row."""
    return articles.withColumn("audit_date", timewin.local_date_of_text(F.col(column)))
