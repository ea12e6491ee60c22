"""The queries of the operators, each over its whole table, and SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import bpe, class_lm, collocations, decontaminate, jaccard_join, periodic_runs, quality_rules, sharding, simhash, substring_dedup, suffix_dedup, token_counts, warc
from headwater.llm.common import table


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.fit_score(table(spark, sf_dir, "documents"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode_decode(table(spark, sf_dir, "documents"), "byte_bpe_50k.json")
    return found.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), percent=80, n=5)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(table(spark, sf_dir, "documents"), "word_bpe_49k.json")
    return found.withColumn("over_limit", F.col("n_tokens") > 2048)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least=0)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), max_n=3, least=10, percent=50, top=2000)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.echoed(table(spark, sf_dir, "documents")), least=12)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), radius=2, n=3)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    own = [op1_suffix_dedup, op2_class_lm, op3_bpe, op4_decontaminate, op5_substring_dedup, op6_ngram_jaccard_join, op7_sharding, op8_token_counts, op9_warc, op10_quality_rules, op11_collocations, op12_periodic_runs, op13_simhash, pipeline]
    return {f.__name__: f for f in own}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP4_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i, w FROM b WHERE len(w) > 0),
bk AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM bw),
ms AS (SELECT DISTINCT m FROM bk),
dw AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, w FROM d, ms WHERE len(w) >= m),
hit AS (SELECT doc_id, i, dw.m, item_id FROM dw JOIN bk ON dw.m = bk.m AND array_to_string(w[i:i + dw.m - 1], ' ') = s),
hw AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""

OP5_SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
s AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM s) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
x AS (SELECT doc_id, w, generate_subscripts(w, 1) AS p FROM d),
y AS (SELECT x.doc_id, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN w[x.p] END, ' ' ORDER BY x.p) AS kept FROM x LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.p = x.p GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN y USING (doc_id)
"""

OP6_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM both_ JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS m FROM r GROUP BY x) USING (doc_id)
"""

#: The function words, written out for the SQL alone.
_STOPS = (
    "'a', 'an', 'and', 'are', 'as', 'at', 'be', 'by', 'for', 'from', 'he', 'his', 'in', 'is', 'it', 'not', 'of', 'on', 'or', 'she', 'that', 'the', "
    "'they', 'this', 'to', 'was', 'were', 'which', 'with', 'aber', 'als', 'auf', 'auch', 'aus', 'bei', 'das', 'dem', 'den', 'der', 'des', 'die', 'ein', 'eine', 'einer', "
    "'er', 'es', 'für', 'ich', 'im', 'ist', 'mit', 'nicht', 'sich', 'sie', 'sind', 'und', 'von', 'war', 'wie', 'wir', 'zu', 'zum', 'al', 'como', 'con', 'de', "
    "'del', 'el', 'en', 'la', 'las', 'lo', 'los', 'más', 'no', 'para', 'pero', 'por', 'que', 'se', 'su', 'un', 'una', 'y', 'au', 'aux', 'avec', 'ce', "
    "'ces', 'dans', 'du', 'elle', 'est', 'et', 'il', 'le', 'les', 'leur', 'mais', 'ne', 'nous', 'ou', 'par', 'pas', 'pour', 'qui', 'sur', 'une', 'vous'"
)


def op10_sql(source: str = "documents") -> str:
    return rf"""
WITH a AS (SELECT *, coalesce(text, '') AS t FROM {source}),
d AS (SELECT *, {_WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM a),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
tw AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
rw AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM tw) GROUP BY doc_id),
c AS (SELECT d.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
 CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
 CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
 len(list_filter(w, lambda x: rtrim(lower(x), '.,!?;:') IN ({_STOPS}))) AS n_stop_words,
 len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09]*[-*\x{{2022}}]'))) AS n_bullets,
 len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09\x0D]*$'))) AS n_open_ends
 FROM d LEFT JOIN rw USING (doc_id)),
e AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM c)
SELECT *, (NOT base_failed AND word_chars * 100 >= n_words * 200 AND word_chars * 100 <= n_words * 1500 AND n_symbols * 100 <= n_words * 20 AND n_stop_words * 100 >= n_words * 4 AND n_dup_lines * 100 <= n_lines * 50 AND n_bullets * 100 <= n_lines * 90 AND n_open_ends * 100 <= n_lines * 50) AS kept FROM e
"""


OP10_SQL = f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM ({op10_sql()})"


OP11_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(ps), '[^\x20\x09]+') AS w FROM d),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS s FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(m) WHERE len(w) >= m)),
f AS MATERIALIZED (SELECT lang, m, s, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, m, s, string_split(s, ' ') AS w, f AS a FROM f WHERE m > 1 AND f >= 10),
v AS (SELECT *, unnest(range(1, m)) AS k FROM c),
k AS MATERIALIZED (SELECT lang, s, m, a, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:m], ' ') AS q FROM v),
x AS (SELECT k.lang, k.s, k.m, k.a, k, l.f AS l, r.f AS r, CAST((1000000 * k.a::HUGEINT * k.a::HUGEINT) // (l.f::HUGEINT * r.f::HUGEINT) AS BIGINT) AS score FROM k JOIN f l ON l.lang = k.lang AND l.s = k.p JOIN f r ON r.lang = k.lang AND r.s = k.q),
b AS (SELECT lang, s, m, a, l, r, score FROM (SELECT *, row_number() OVER (PARTITION BY lang, s ORDER BY score, k) AS o FROM x) WHERE o = 1),
e AS (SELECT lang, unnest([array_to_string(w[1:m - 1], ' '), array_to_string(w[2:m], ' ')]) AS s, a FROM c WHERE m = 3),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM b WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.lang = b.lang AND e.s = b.s AND 100 * e.a >= 50 * b.a))
SELECT lang, rank, s AS phrase, a, l, r, n, score FROM q JOIN n USING (lang) WHERE rank <= 2000
"""

#: CRC-32 of the decimal id, bit by bit (fixed value: the polynomial).
_CRC = "xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(doc_id AS VARCHAR)[i]) AS BIGINT)), lambda c, b: list_reduce([xor(c, b)] || range(8), lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT)"

OP12_SQL = rf"""
WITH h AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS o, {_CRC} AS h FROM documents),
g AS (SELECT doc_id, o, CASE WHEN h % 10 = 0 AND len(o) > 0 THEN (h // 10) % len(o) END AS a, (h // 10) % 8 AS g8 FROM h),
d AS (SELECT doc_id, CASE WHEN a IS NULL THEN o ELSE list_transform(range(0, len(o)), lambda i: o[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(o) - a) // (3 + g8)) END]) END AS w FROM g),
v AS (SELECT doc_id, len(w) AS n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM d),
e AS (SELECT a.doc_id, b.i - a.i AS p, a.i FROM v a JOIN v b ON a.doc_id = b.doc_id AND a.x = b.x AND b.i > a.i WHERE b.i - a.i <= a.n // 2),
s AS (SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS k FROM e) GROUP BY doc_id, p, k HAVING count(*) >= p AND count(*) + p >= 12),
r AS (SELECT doc_id, start, length, min(p) AS period FROM s GROUP BY doc_id, start, length),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) AS o FROM r) WHERE o = 1),
t AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS l FROM r GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
y AS (SELECT v.doc_id, string_agg(x, ' ' ORDER BY v.i) AS kept FROM v ANTI JOIN gone ON gone.doc_id = v.doc_id AND gone.i = v.i GROUP BY v.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(l, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN y USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": OP4_SQL, "op5_substring_dedup": OP5_SQL, "op6_ngram_jaccard_join": OP6_SQL, "op10_quality_rules": OP10_SQL, "op11_collocations": OP11_SQL, "op12_periodic_runs": OP12_SQL}
