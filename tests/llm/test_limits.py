"""Broadcast limits passed, very long texts, and odd rows whose values are held against plain versions."""

import base64
import hashlib
import random

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from headwater.llm import decontaminate, jaccard_join, substring_dedup, suffix_dedup, warc
from tests.llm import brute

CLASHES = ["payload", "digest", "payload_digest", "chunk", "chunk_no", "n", "row", "record_type", "refers_to", "size", "archive", "uri", "first"]


def prose(n, seed):
    rng = random.Random(seed)
    return [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else f"word{rng.randrange(9000)}" for _ in range(n)]


LONG = prose(60_000, 1)
ODD = [(1, None), (2, ""), (3, " \n"), (4, " ".join(LONG)), (5, " ".join(LONG[:30_000] + ["other"] + LONG[30_001:])), (6, " ".join(prose(90, 2) + LONG[500:560])), (7, "x" * 300_000), (8, "x" * 300_000), (9, "word " * 50_000), (10, "four words are here"), (11, "FOUR words are here"), (12, "é" * 120)]


def test_values_of_very_long_and_null_texts(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").repartition(3)
    sub = {r.doc_id: (r.n_words, r.n_removed, brute.sha(r.kept.encode())) for r in substring_dedup.substring_dedup(docs).collect()}
    assert sub == brute.substring_dedup(ODD)
    groups = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.ngram_jaccard_join(docs).collect()}
    assert groups == brute.jaccard(ODD) and groups[5][1] == 4 and groups[11][1] == 10
    # every window of 100 bytes of the plain version takes memory, so the longest texts are left to the words' test
    short = [(d, t if d in (1, 2, 3, 6, 10, 11, 12) else (t or "")[:5000]) for d, t in ODD]
    cut = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in suffix_dedup.suffix_dedup(spark.createDataFrame(short, "doc_id long, text string")).collect()}
    assert cut == brute.suffix_dedup(short)


def test_joins_beyond_the_broadcast_limits(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(prose(80, i % 7) + (["odd"] if i > 7 else []))) for i in range(30)] + [(99, " ".join(prose(40, 50)))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(prose(80, 3)[20:50])), (2, "odd"), (3, None)], "item_id long, text string")
    own = lambda: sorted(tuple(r) for r in decontaminate.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect())
    pairs = lambda: sorted(tuple(r) for r in jaccard_join.ngram_jaccard_join(docs).collect())
    before = own(), pairs()
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    assert (own(), pairs()) == before
    assert sum(r[-1] for r in before[0]) > 3 and len({c for *_, c in before[1]}) == 8


def test_pages_with_odd_rows_and_clashing_columns(spark):
    rows = [(None, "u", "a\r\n\r\nb" * 900_000), (None, None, "own"), (3, "u", "a\r\n\r\nb" * 900_000), (4, "", None), (5, None, ""), (5, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    found = warc.round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    digest = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest) for r in found) == sorted((str(p), len((t or "").encode()), digest(t)) for p, _, t in rows)
    by = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in found if r.payload_bytes == 0)
    assert by == [("4", "response", "None"), ("5", "revisit", "4"), ("5", "revisit", "4")]
    assert sorted(r.record_type for r in found if r.payload_bytes > 9) == ["response", "revisit"]
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_stages_on_very_long_texts(spark, tmp_path):
    leak = prose(30, 9)
    rows = [(1, LONG), (2, LONG[:100] + ["changed"] + LONG[101:]), (3, prose(40_000, 3) + LONG[700:760] + prose(40_000, 4)), (4, prose(50_000, 5) + leak), (5, prose(200, 6))]
    spark.createDataFrame([(1, " ".join(leak))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, " ".join(w), "en", "s", 1) for i, w in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert kept == [[1, 2, 3, 4, 5], [1, 3, 4, 5], [1, 3, 4, 5], [1, 3, 5], [1, 3, 5]]
    texts = {r.doc_id: r.text.split() for r in spark.read.parquet(f"{tmp_path}/3").collect()}
    assert texts[1] == LONG and texts[3] == rows[2][1][:40_000] + rows[2][1][40_060:] and texts[5] == rows[4][1]
