"""Rows that share a doc_id, or have none, are documents of their own."""

import random

import corpus_pipeline as pipeline
from headwater.llm import class_lm, common
from headwater.llm.jaccard_join import ngram_jaccard_join
from headwater.llm.substring_dedup import substring_dedup
from headwater.llm.suffix_dedup import suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else f"word{rng.randrange(9000)}" for _ in range(n))


def shared_ids():
    rng = random.Random(8)
    passage = prose(rng, 40)
    rows = [(None, prose(rng, 20) + f" {passage} end"), (None, passage), (None, prose(rng, 90)), (7, prose(rng, 60) + " " + passage), (7, "short text"), (7, passage + " " + prose(rng, 9)), (7, "short text"), (9, prose(rng, 30) + " " + passage)]
    return rows


def ordered(spark, rows):
    """Numbers for the distinct rows, in the order that the operators take them in."""
    marked, keys = common.identified(spark.createDataFrame(rows, SCHEMA), "row_id")
    assert keys is not None
    return {(r.doc_id, r.text): r.row_id for r in marked.collect()}


def test_numbers_follow_doc_ids(spark):
    rows = shared_ids()
    number = ordered(spark, rows)
    assert len(set(number.values())) == len(set(rows))
    least = lambda r: common.NO_ID if r[0] is None else r[0]
    assert [least(r) for r in sorted(number, key=number.get)] == sorted(map(least, number))
    unique = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "b")], SCHEMA)
    marked, keys = common.identified(unique, "row_id")
    assert keys is None and sorted(r.row_id for r in marked.collect()) == [common.NO_ID, 1, 1, 2]


def test_repeat_removers(spark):
    rows = shared_ids()
    number = ordered(spark, rows)
    df, plain = spark.createDataFrame(rows, SCHEMA), [(number[r], r[1]) for r in rows]
    want = brute.suffix_dedup(plain)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, brute.sha(bytes(r.kept))) for r in suffix_dedup(df).collect()) == sorted((r[0] or 0, *want[number[r]]) for r in rows)
    want = brute.substring_dedup(plain)
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, brute.sha(r.kept.encode())) for r in substring_dedup(df).collect()) == sorted((r[0] or 0, *want[number[r]]) for r in rows)


def test_scores_are_those_of_rows_with_ids_of_their_own(spark):
    rows = shared_ids() + [(i, t) for i, (_, t) in enumerate(shared_ids(), 100)]
    df = spark.createDataFrame(rows, SCHEMA)
    model = class_lm.fit(df, top=50, classes=6, sweeps=1)
    cut = lambda r: (r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
    alone = {t: cut(class_lm.score(spark.createDataFrame([(1, t)], SCHEMA), model).first()) for t in {t for _, t in rows[:8]}}
    found = class_lm.score(df, model).collect()
    assert sorted((r.doc_id or 0, *cut(r)) for r in found) == sorted((d or 0, *alone[t]) for d, t in rows)
    ids = [r.doc_id for r in found if r.doc_id is not None]
    held = class_lm.held_out(common.np.array(ids))
    assert [r.held_out for r in found if r.doc_id is not None] == held.tolist() and not any(r.held_out for r in found if r.doc_id is None)


def linked():
    rng = random.Random(4)
    a, b, c = ([f"word{rng.randrange(9000)}" for _ in range(100)] for _ in range(3))
    near = lambda x: " ".join(x[:50] + ["changed"] + x[51:])
    # 3 is near to one null row and 4 to another; 5 has two texts without a link
    return [(None, " ".join(a)), (None, " ".join(b)), (None, prose(rng, 80)), (3, near(a)), (4, near(b)), (5, " ".join(c)), (5, prose(rng, 70)), (6, near(c)), (5, " ".join(c))]


def test_rows_are_linked_by_their_texts_alone(spark):
    found = sorted((r.doc_id or 0, r.component_id or 0) for r in ngram_jaccard_join(spark.createDataFrame(linked(), SCHEMA)).collect())
    assert found == [(0, 0), (0, 0), (0, 0), (3, 0), (4, 0), (5, 5), (5, 5), (5, 5), (6, 5)]


def test_stages_keep_rows_that_share_an_id(spark, tmp_path):
    rows = linked()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = pipeline.near_duplicates(spark, df, "")
    assert kept.columns == df.columns
    want = [rows[i] for i in (0, 1, 2, 5, 6)]
    assert sorted(map(str, map(tuple, kept.collect()))) == sorted(map(str, want))
    clean = pipeline.repeated_passages(spark, spark.createDataFrame(want, SCHEMA), "")
    assert sorted(map(str, map(tuple, clean.collect()))) == sorted(map(str, want))
    spark.createDataFrame([(1, " ".join(rows[0][1].split()[20:40]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    free = pipeline.benchmark_free(spark, spark.createDataFrame(want, SCHEMA), str(tmp_path))
    assert sorted(map(str, map(tuple, free.collect()))) == sorted(map(str, want[1:]))


def test_documents_may_have_columns_of_the_operators(spark):
    rng = random.Random(2)
    passage = prose(rng, 30)
    rows = [(1, passage, 5, 6, "yes", 8, "o"), (2, passage + " tail", 5, 6, "no", 8, "o"), (3, passage, 5, 6, "no", 8, "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words long, n_removed long, kept string, component_id long, own_id string")
    cut = pipeline.repeated_passages(spark, docs, "")
    assert cut.columns == docs.columns
    assert sorted(map(tuple, cut.collect())) == [rows[0], (2, "tail", *rows[1][2:])]
    assert sorted(map(tuple, pipeline.near_duplicates(spark, docs, "").collect())) == rows[:1]
