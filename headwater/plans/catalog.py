"""The queries of the headline engine by name, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.functions import automaton, keywords, text, timewin, urls
from headwater.operators import grouping, load, quality, report, series, windows
from headwater.session import scratch, settled
from headwater.sinks.versions import DayTables
from headwater.sources.articles import articles, table
from headwater.streaming import slices

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

WATCH = ["the", "and", "to", "was", "it"]
INTEREST, EXCLUDE = ["the", "and", "of the", "is", "de"], ["by", "que"]
REGULATION, TOOL = ["that", "was"], ["and", "in"]
DAY = date(2024, 1, 10)
FIRST, LAST = datetime(2024, 1, 9, 15), datetime(2024, 1, 10, 14, 59, 59)

ART = """WITH art AS (SELECT p.page_id AS pos, p.url, split_part(coalesce(d.text, ''), chr(10), 1) AS title, d.source AS domain, e.ts AS seen_ts,
 CAST(e.ts + INTERVAL 9 HOUR AS DATE) AS kst_date FROM pages p JOIN documents d ON d.doc_id = p.page_id JOIN events e ON e.event_id = (p.page_id * 37) % (SELECT count(*) FROM events)),
cal AS (SELECT CAST(unnest(generate_series((SELECT min(kst_date) FROM art), (SELECT max(kst_date) FROM art), INTERVAL 1 DAY)) AS DATE) AS kst_date),
daily AS (SELECT cal.kst_date, count(art.pos) AS n FROM cal LEFT JOIN art USING (kst_date) GROUP BY cal.kst_date)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def boundary(kw: str, column: str = "lower(title)") -> str:
    return f"regexp_matches({column}, '(^|[^0-9a-z]){kw}($|[^0-9a-z])')"


HITS = ", ".join(f"('{k}')" for k in WATCH)
KWD = (
    ", kwd AS (SELECT kw.k AS keyword, cal.kst_date, count(art.pos) AS n FROM (VALUES "
    + HITS
    + ") kw(k) CROSS JOIN cal LEFT JOIN art ON art.kst_date = cal.kst_date AND regexp_matches(lower(art.title), '(^|[^0-9a-z])' || kw.k || '($|[^0-9a-z])') GROUP BY 1, 2)"
)


@query(f"{ART} SELECT * FROM daily")
def daily_counts(spark, sf):
    return series.daily_counts(articles(spark, sf))


AVG = "avg(CASE WHEN n > 0 THEN n END) OVER w"
USED = "count(CASE WHEN n > 0 THEN n END) OVER w"
W = "WINDOW w AS (ORDER BY kst_date - DATE '1970-01-01' RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING)"


@query(f"{ART} SELECT kst_date, n, CASE WHEN {USED} >= 3 THEN round({AVG}, 6) END AS avg_n, {USED} AS days_used FROM daily {W}")
def recent_average(spark, sf):
    return series.recent_average(series.daily_counts(articles(spark, sf)))


@query(
    f"{ART}, r AS (SELECT kst_date, n, CASE WHEN {USED} >= 3 THEN round({AVG}, 6) END AS m, {USED} AS u FROM daily {W}) SELECT kst_date, CASE WHEN m IS NULL OR u < 3 THEN 'skip' WHEN n / m <= 0.5 OR n / m >= 2 THEN 'warn' ELSE 'ok' END AS status, "
    "CASE WHEN m IS NULL THEN 'unknown' WHEN abs(n - m) < greatest(1.0, m * 0.05) THEN 'similar' WHEN n > m THEN 'more' ELSE 'fewer' END AS trend FROM r"
)
def volume_check(spark, sf):
    r = series.recent_average(series.daily_counts(articles(spark, sf)))
    return r.select("kst_date", series.volume_status(F.col("n"), F.col("avg_n"), F.col("days_used")).alias("status"), series.volume_words(F.col("n"), F.col("avg_n")).alias("trend"))


@query(f"{ART} SELECT kst_date, CAST(coalesce(sum(n) OVER w, 0) AS BIGINT) AS n_before, count(CASE WHEN n > 0 THEN 1 END) OVER w AS days_before, coalesce(sum(n) OVER w, 0) > 0 AS ready FROM daily {W}")
def history_info(spark, sf):
    return series.history(series.daily_counts(articles(spark, sf)))


@query(f"{ART}{KWD} SELECT keyword, CAST(sum(n) AS BIGINT) AS n FROM kwd GROUP BY keyword")
def keyword_counts(spark, sf):
    return series.keyword_counts(articles(spark, sf), WATCH)


@query(f"{ART}{KWD} SELECT keyword, CAST(sum(n) AS BIGINT) AS n FROM kwd GROUP BY keyword")
def keyword_counts_in_one_pass(spark, sf):
    """The same by the automaton of all keywords."""
    return automaton.keyword_counts(articles(spark, sf), WATCH)


@query(
    f"{ART}, bw AS (SELECT DISTINCT unnest(regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z]+')) AS keyword FROM benchmark), "
    "tv AS (SELECT DISTINCT pos, kst_date, unnest(regexp_extract_all(lower(title), '[0-9a-z]+')) AS keyword FROM art) SELECT keyword, CAST(date_trunc('week', kst_date) AS DATE) AS week, count(*) AS n FROM tv JOIN bw USING (keyword) GROUP BY ALL"
)
def keyword_list_counts(spark, sf):
    """A long list of keywords, all words of the benchmark's items, counted in the titles of each week in one pass."""
    words = table(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[0-9a-z]+"), F.lit(0))).alias("w")).distinct()
    a = articles(spark, sf).select("title", F.to_date(F.date_trunc("WEEK", "kst_date")).alias("week"))
    return automaton.counted(a, [r.w for r in words.orderBy("w").collect()], "week")


@query(f"{ART}{KWD}, z AS (SELECT keyword, kst_date, n, max(n) OVER (PARTITION BY keyword ORDER BY kst_date - DATE '1970-01-01' RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS b FROM kwd) SELECT keyword, kst_date, n FROM z WHERE n > 0 AND coalesce(b, 0) = 0")
def first_seen(spark, sf):
    return series.first_seen(articles(spark, sf), WATCH)


WEEKLY = f"{ART}{KWD}, wk AS (SELECT keyword, CAST(date_trunc('week', kst_date) AS DATE) AS week, CAST(sum(n) AS BIGINT) AS this_week FROM kwd GROUP BY 1, 2), wl AS (SELECT *, coalesce(lag(this_week) OVER (PARTITION BY keyword ORDER BY week), 0) AS last_week FROM wk), wn AS (SELECT *, this_week - last_week AS delta, CASE WHEN last_week = 0 THEN 'new' WHEN this_week = 0 THEN 'gone' ELSE '' END AS note FROM wl WHERE this_week > 0 OR last_week > 0)"


@query(f"{WEEKLY} SELECT *, CASE WHEN delta > 0 THEN '+' ELSE '' END || delta AS delta_text FROM wn")
def week_over_week(spark, sf):
    return series.week_over_week(articles(spark, sf), WATCH).withColumn("delta_text", text.delta_text(F.col("delta")))


@query(f"{WEEKLY} SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY week ORDER BY this_week DESC, last_week DESC, keyword) AS INT) AS place FROM wn) WHERE place <= 3")
def weekly_top_n(spark, sf):
    return series.top(series.week_over_week(articles(spark, sf), WATCH), 3)


@query(f"{ART} SELECT pos, url, title, domain FROM art WHERE seen_ts BETWEEN TIMESTAMP '2024-01-09 15:00:00' AND TIMESTAMP '2024-01-10 14:59:59'")
def kst_day_window(spark, sf):
    first, last = timewin.day_window(DAY)
    return articles(spark, sf).where(F.col("seen_ts").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))).select("pos", "url", "title", "domain")


@query("SELECT strftime(s, '%Y%m%d%H%M%S') AS stamp, count(event_id) AS n FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-09 15:00:00', TIMESTAMP '2024-01-10 14:59:59', INTERVAL 15 MINUTE)) AS s) LEFT JOIN events ON time_bucket(INTERVAL 15 MINUTE, ts) = s GROUP BY s")
def slice_counts(spark, sf):
    all_ = timewin.slices(spark, FIRST, LAST)
    at = F.date_format(F.window(F.col("ts").cast("timestamp"), "15 minutes")["start"], "yyyyMMddHHmmss")
    counted = table(spark, sf, "events").groupBy(at.alias("stamp")).agg(F.count("*").alias("n"))
    return all_.join(counted, "stamp", "left").select("stamp", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT strftime(s, '%Y%m%d%H%M%S') AS stamp FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-09 15:00:00', TIMESTAMP '2024-01-10 14:59:59', INTERVAL 15 MINUTE)) AS s) WHERE s NOT IN (SELECT time_bucket(INTERVAL 15 MINUTE, ts) FROM events)")
def missing_slices(spark, sf):
    landed = table(spark, sf, "events").select(F.date_format(F.window(F.col("ts").cast("timestamp"), "15 minutes")["start"], "yyyyMMddHHmmss").alias("stamp"))
    return timewin.slices(spark, FIRST, LAST).join(landed, "stamp", "left_anti")


def _params(expr: str, bad: str) -> str:
    kept = f"list_sort(list_filter(list_filter(string_split({expr}, '&'), lambda x: x <> ''), lambda x: NOT ({bad})))"
    return f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({kept}, '&') ELSE '' END"


_PARTS = r"SELECT page_id AS pos, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS a, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS p, regexp_extract(url, '\?([^#]*)', 1) AS q FROM pages"
_PATH = "CASE WHEN p = '' THEN '/' WHEN length(p) > 1 THEN rtrim(p, '/') ELSE p END"
COLLECT = rf"regexp_replace(a, '^(www\.|m\.|mobile\.)', '') || {_PATH} || " + _params("q", "regexp_matches(lower(x), '^((utm_|_ga|ga_|nil_|t__nil|pk_|mtm_|piwik_)|(fbclid|gclid|gclsrc|dclid|msclkid|ttclid|yclid|igshid|mc_cid|mc_eid|spm|ref|referer|referrer|referral|source|src|from|cmpid|cmp|campaign|cloc|dablewidget|outputtype|amp)(=|$))') OR NOT regexp_matches(x, '=.')")
AUDIT = rf"regexp_replace(a, '^www\.', '') || {_PATH} || " + _params("q", "regexp_matches(lower(x), '^((utm_|_ga)|(fbclid|gclid|igshid|spm|ref|refer|cmpid|ncid)(=|$))')")


@query(f"SELECT pos, {COLLECT} AS k FROM ({_PARTS})")
def url_key_collect(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("pos"), urls.collect_key(F.col("url")).alias("k"))


@query(f"SELECT pos, {AUDIT} AS k FROM ({_PARTS})")
def url_key_audit(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("pos"), urls.audit_key(F.col("url")).alias("k"))


@query(
    r"SELECT page_id AS pos, regexp_replace(regexp_replace(url, '^(https://[^/?#]*):443([/?#]|$)', '\1\2', 'i'), '^(http://[^/?#]*):80([/?#]|$)', '\1\2', 'i') AS tidy, CASE WHEN length(regexp_replace(url, '^https?://', '')) <= 48 THEN regexp_replace(url, '^https?://', '') ELSE left(regexp_replace(url, '^https?://', ''), 45) || '...' END AS short, "
    r"regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '^www\.', ''), '^m\.', ''), '^amp\.', '') AS outlet FROM pages"
)
def url_display(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(F.col("page_id").alias("pos"), urls.tidy(u).alias("tidy"), urls.short(u).alias("short"), urls.outlet(u).alias("outlet"))


KEYED = f"{ART}, ku AS (SELECT *, {COLLECT} AS k FROM ({_PARTS.replace('SELECT page_id', 'SELECT page_id AS id, page_id')})), kd AS (SELECT art.*, ku.k FROM art JOIN ku ON ku.id = art.pos), kr AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seen_ts, url, pos) AS r, first_value(url) OVER (PARTITION BY k ORDER BY seen_ts, url, pos) AS f FROM kd)"


@query(f"{KEYED} SELECT pos, url, title, domain FROM kr WHERE r = 1")
def dedupe_keep_first(spark, sf):
    return load.keep_first(articles(spark, sf), urls.collect_key(F.col("url")), "seen_ts", "url", "pos").select("pos", "url", "title", "domain")


@query(f"{KEYED} SELECT count(*) - count(DISTINCT k) AS duplicated, CAST(sum(CASE WHEN url <> f THEN 1 ELSE 0 END) AS BIGINT) AS merged_distinct_urls, count(DISTINCT k) AS kept FROM kr")
def dedupe_metrics(spark, sf):
    return load.dedupe_metrics(articles(spark, sf), urls.collect_key(F.col("url")), "url", "seen_ts")


BATCHES = f"{ART}, bt AS (SELECT 1 AS batch, pos, url, kst_date FROM art WHERE pos % 3 <> 0 UNION ALL SELECT 2, pos, url, kst_date + 1 FROM art WHERE pos % 3 <> 1)"


def _batches(spark, sf):
    """Two loads that overlap; the second sees each link a day later."""
    a = articles(spark, sf).select("pos", "url", "kst_date")
    second = a.where("pos % 3 <> 1").select(F.lit(2).alias("batch"), "pos", "url", F.date_add("kst_date", 1).alias("kst_date"))
    return a.where("pos % 3 <> 0").select(F.lit(1).alias("batch"), "pos", "url", "kst_date").union(second)


@query(f"{BATCHES} SELECT batch, pos, url, kst_date FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch, pos) AS r FROM bt) WHERE r = 1")
def upsert_first_wins(spark, sf):
    return load.first_wins(_batches(spark, sf), "batch", "pos")


@query(f"{BATCHES}, f AS (SELECT url, min(batch) AS batch FROM bt GROUP BY url) SELECT b.batch, coalesce(i, 0) AS inserted, n - coalesce(i, 0) AS duplicated FROM (SELECT batch, count(*) AS n FROM bt GROUP BY batch) b LEFT JOIN (SELECT batch, count(*) AS i FROM f GROUP BY batch) g USING (batch)")
def run_log(spark, sf):
    return load.run_log(_batches(spark, sf))


@query(f"{ART} SELECT pos, " + ", ".join(f"{boundary(k)} AS has_{k}" for k in WATCH) + " FROM art")
def keyword_match_counting(spark, sf):
    return articles(spark, sf).select("pos", *[keywords.counts(F.col("title"), k).alias(f"has_{k}") for k in WATCH])


def _first_sql(words: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {boundary(w)} THEN '{w}'" for _, w in sorted(enumerate(words), key=lambda x: (-len(x[1]), x[0]))) + " END"


@query(f"{ART} SELECT pos, {_first_sql(INTEREST)} AS keyword, CAST({' + '.join(f'CAST({boundary(k)} AS INT)' for k in INTEREST)} AS INT) AS hits FROM art")
def longest_keyword(spark, sf):
    return articles(spark, sf).select("pos", keywords.first_of(F.col("title"), INTEREST).alias("keyword"), keywords.hits(F.col("title"), INTEREST).alias("hits"))


JUDGED = (
    f"{ART}, cl AS (SELECT *, row_number() OVER (PARTITION BY kst_date, url, trim(title) <> '' ORDER BY pos) AS nth, {_first_sql(EXCLUDE)} AS bad, {_first_sql(INTEREST)} AS good FROM art), "
    "jd AS (SELECT *, CASE WHEN trim(coalesce(url, '')) = '' THEN 'no_url' WHEN trim(title) = '' THEN 'no_title' WHEN nth > 1 THEN 'repeated_url' WHEN bad IS NOT NULL THEN 'exclude:' || bad WHEN good IS NULL THEN 'no_interest' ELSE 'interest:' || good END AS reason FROM cl)"
)


def _judged(spark, sf):
    return grouping.classify(articles(spark, sf), INTEREST, EXCLUDE)


@query(f"{ART} SELECT pos, {_first_sql(INTEREST)} AS keyword, CAST({' + '.join(f'CAST({boundary(k)} AS INT)' for k in INTEREST)} AS INT) AS hits FROM art")
def longest_keyword_in_one_pass(spark, sf):
    return automaton.classified(articles(spark, sf).select("pos", "title"), INTEREST).select("pos", "keyword", "hits")


@query(f"{JUDGED} SELECT pos, reason, CASE WHEN reason LIKE 'interest:%' THEN 'kept' ELSE 'dropped' END AS verdict FROM jd")
def classify(spark, sf):
    return _judged(spark, sf).select("pos", "reason", "verdict")


@query(f"{JUDGED} SELECT kst_date, round(avg(CASE WHEN reason LIKE 'interest:%' THEN 0.0 ELSE 1.0 END), 6) AS ratio, avg(CASE WHEN reason LIKE 'interest:%' THEN 0.0 ELSE 1.0 END) > 0.7 AS warn FROM jd GROUP BY kst_date")
def drop_ratio(spark, sf):
    ratio = F.avg((F.col("verdict") == "dropped").cast("double"))
    return _judged(spark, sf).groupBy("kst_date").agg(F.round(ratio, 6).alias("ratio"), (ratio > 0.7).alias("warn"))


TOK = r"list_distinct(list_filter(list_transform(regexp_extract_all(title, '[0-9A-Za-z]+'), lambda x: lower(x)), lambda x: length(x) >= 2))"
TOKENS = f"{ART}, tk AS (SELECT pos, kst_date, title, domain, CASE WHEN len({TOK}) > 0 THEN {TOK} WHEN len(regexp_extract_all(title, '[0-9A-Za-z]+')) > 0 THEN list_distinct(list_transform(regexp_extract_all(title, '[0-9A-Za-z]+'), lambda x: lower(x))) ELSE [lower(title)] END AS tokens FROM art)"


def _tokens(spark, sf):
    return articles(spark, sf).withColumn("tokens", text.tokens(F.col("title")))


@query(f"{TOKENS} SELECT pos, array_to_string(list_sort(tokens), ' ') AS tokens, CAST(len(tokens) AS INT) AS n FROM tk")
def title_tokens(spark, sf):
    return _tokens(spark, sf).select("pos", F.array_join(F.array_sort("tokens"), " ").alias("tokens"), F.size("tokens").alias("n"))


@query(f"{TOKENS}, pr AS (SELECT a.kst_date, a.pos AS pos_a, b.pos AS pos_b, len(list_intersect(a.tokens, b.tokens)) AS i, len(a.tokens) AS x, len(b.tokens) AS y FROM tk a JOIN tk b ON a.kst_date = b.kst_date AND a.pos < b.pos) SELECT kst_date, pos_a, pos_b, round(i / (x + y - i), 9) AS similarity FROM pr WHERE i / (x + y - i) >= 0.4 - 1e-12")
def jaccard_pairs(spark, sf):
    return grouping.jaccard_pairs(_tokens(spark, sf)).withColumn("similarity", F.round("similarity", 9))


#: One decoding of the entities that the pages have; the ampersand comes last, so that what it makes isn't decoded again.
PAGE_TITLE = r"""trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT page_id AS pos, {PAGE_TITLE} AS page_title FROM pages")
def page_title(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("pos"), text.page_title(F.col("html")).alias("page_title"))


_WS = "list_distinct(regexp_extract_all(lower({}), '[0-9a-z]{{2,}}'))"
_A, _B = _WS.format("a"), _WS.format("b")


@query(f"WITH p AS (SELECT page_id AS pos, split_part(coalesce(d.text, ''), chr(10), 1) AS a, {PAGE_TITLE} AS b FROM pages JOIN documents d ON doc_id = page_id) SELECT pos, round(CASE WHEN least(len({_A}), len({_B})) > 0 THEN len(list_intersect({_A}, {_B})) / least(len({_A}), len({_B})) ELSE 0.0 END, 9) AS overlap FROM p")
def title_overlap(spark, sf):
    both = articles(spark, sf).select("pos", "title").join(table(spark, sf, "pages").select(F.col("page_id").alias("pos"), "html"), "pos")
    return both.select("pos", F.round(text.overlap(text.word_set(F.col("title")), text.word_set(text.page_title(F.col("html")))), 9).alias("overlap"))


#: Windows are halved in SQL itself: a window asks for its halves while it is full.
BISECT = """WITH RECURSIVE w AS (SELECT 1 AS n, 0 AS depth, TIMESTAMP '2024-01-09 15:00:00' AS a, TIMESTAMP '2024-01-10 14:59:59' AS b,
 (SELECT count(*) FROM events WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-09 15:00:00' AND TIMESTAMP '2024-01-10 14:59:59' AND ts <= TIMESTAMP '2024-01-10 14:59:59') AS c
UNION ALL SELECT n, depth, a, b, count(e.ts) FROM (SELECT 2 * n + h AS n, depth + 1 AS depth, CASE WHEN h = 0 THEN a ELSE m END AS a, CASE WHEN h = 0 THEN m ELSE b END AS b
 FROM (SELECT *, a + to_seconds(CAST(floor(epoch(b - a) / 2) AS BIGINT)) AS m FROM w WHERE c >= 60 AND depth < 5 AND epoch(b - a) >= 2), (VALUES (0), (1)) x(h)) k
 LEFT JOIN events e ON date_trunc('second', e.ts) BETWEEN k.a AND k.b AND e.ts BETWEEN TIMESTAMP '2024-01-09 15:00:00' AND TIMESTAMP '2024-01-10 14:59:59' GROUP BY n, depth, a, b)"""


@query(f"{BISECT} SELECT n, depth, c AS count, c >= 60 AS hit_cap, c >= 60 AND depth < 5 AND epoch(b - a) >= 2 AS split, c >= 60 AND NOT (depth < 5 AND epoch(b - a) >= 2) AS truncated FROM w")
def window_bisect(spark, sf):
    return windows.bisect(table(spark, sf, "events"), FIRST, LAST, 60, at="ts").drop("start", "end")


@query(f"{ART} SELECT CASE WHEN kst_date = DATE '2024-01-10' THEN 'own' ELSE 'stray' END AS side, count(*) AS n FROM art GROUP BY 1")
def stray_split(spark, sf):
    own, stray = quality.stray_split(articles(spark, sf), F.lit(DAY))
    return own.select(F.lit("own").alias("side")).union(stray.select(F.lit("stray").alias("side"))).groupBy("side").agg(F.count("*").alias("n"))


@query(f"{ART} SELECT CAST(sum(CASE WHEN trim(coalesce(url, '')) = '' THEN 1 ELSE 0 END) AS BIGINT) AS no_url, CAST(sum(CASE WHEN trim(title) = '' THEN 1 ELSE 0 END) AS BIGINT) AS no_title, CAST(sum(CASE WHEN trim(coalesce(domain, '')) = '' THEN 1 ELSE 0 END) AS BIGINT) AS no_domain FROM art")
def required_fields(spark, sf):
    blank = lambda c: F.count_if(text.strip(F.col(c)) == "")
    return articles(spark, sf).agg(blank("url").alias("no_url"), blank("title").alias("no_title"), blank("domain").alias("no_domain"))


@query(f"{JUDGED} SELECT kst_date, pos, CASE WHEN reason LIKE 'interest:%' THEN 'kept' ELSE 'dropped' END AS verdict, CAST(row_number() OVER (PARTITION BY kst_date ORDER BY reason NOT LIKE 'interest:%', pos) - 1 AS INT) AS position FROM jd")
def decisions_roundtrip(spark, sf):
    store = DayTables(spark, scratch(spark, "decisions"), {"decisions": "pos long, verdict string, position int"})
    d = settled(load.positioned(_judged(spark, sf)).select("kst_date", "pos", "verdict", "position"))
    days = [r.kst_date for r in d.select("kst_date").distinct().collect()]
    store.replace(days, {"decisions": d})
    store.replace([DAY], {"decisions": d})
    return store.read("decisions").select("kst_date", "pos", "verdict", "position")


@query(f"{JUDGED} SELECT CAST(date_trunc('week', kst_date) AS DATE) AS week, count(DISTINCT url) AS n_kept FROM jd WHERE reason LIKE 'interest:%' GROUP BY 1")
def kept_urls_week(spark, sf):
    return report.kept_links(_judged(spark, sf))


@query(f"{JUDGED} SELECT kst_date, CASE WHEN kst_date > DATE '2024-01-25' THEN 'upcoming' ELSE 'missing' END AS state FROM cal WHERE kst_date NOT IN (SELECT kst_date FROM jd WHERE reason LIKE 'interest:%')")
def missing_days(spark, sf):
    a = articles(spark, sf)
    return report.missing_days(timewin.calendar(series.daily_counts(a)), _judged(spark, sf).where("verdict = 'kept'"), date(2024, 1, 25))


@query("SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S') AS stamp, count(*) AS n FROM events GROUP BY 1")
def stream_slice_counts(spark, sf):
    folder = scratch(spark, "stream")
    stream = spark.readStream.schema(table(spark, sf, "events").schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return slices.run_available(slices.slice_counts(stream), f"{folder}/counts", f"{folder}/state")


@query(f"{ART} SELECT kst_date, sum(length(title)) AS chars, CAST(sum(CASE WHEN ends_with(title, '.') THEN 1 ELSE 0 END) AS BIGINT) AS sentences FROM art GROUP BY kst_date")
def title_stats(spark, sf):
    return articles(spark, sf).groupBy("kst_date").agg(F.sum(F.length("title")).alias("chars"), F.count_if(F.col("title").endswith(".")).alias("sentences"))


@query("SELECT doc_id, i, CASE WHEN trim(l) = '' THEN 'blank' WHEN regexp_matches(trim(l), '^### ') THEN 'heading_3' WHEN regexp_matches(trim(l), '^## ') THEN 'heading_2' WHEN regexp_matches(trim(l), '^# ') THEN 'heading_1' WHEN regexp_matches(trim(l), '^> ?') THEN 'quote' WHEN regexp_matches(trim(l), '^(-{3,}|\\*{3,})$') THEN 'divider' WHEN regexp_matches(trim(l), '^[-*] ') THEN 'bulleted_list_item' WHEN regexp_matches(trim(l), '^\\d+\\. ') THEN 'numbered_list_item' ELSE 'paragraph' END AS kind FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, CAST(generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS INT) AS i FROM documents)".replace("\\\\", "\\"))
def markdown_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("i", "l"))
    return lines.select("doc_id", "i", text.markdown_kind(F.col("l")).alias("kind"))
