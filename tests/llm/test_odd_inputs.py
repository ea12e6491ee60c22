"""Null and repeated ids, repeated rows, very long and empty texts, empty tables and clashing columns, for every operator of a text table."""

import random

import pytest
from pyspark.sql import functions as F

from headwater.llm import bpe, class_lm, decontaminate, jaccard_join, quality_rules, sharding, substring_dedup, suffix_dedup, token_counts

CLASHES = ["n_words", "n_removed", "kept", "own_id", "bucket", "class", "component_id", "n_shingles", "shard", "slot", "size", "n_tokens", "ids", "score", "held_out", "base", "w", "row", "_row", "h", "places"]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else f"word{rng.randrange(9000)}" for _ in range(n))


ROWS = [(None, prose(80, 1)), (None, prose(90, 2)), (None, prose(90, 2)), (5, prose(60, 3)), (5, prose(70, 4)), (6, prose(60, 3)), (7, ""), (8, None), (9, "\n \t"), (10, "word " * 200_000), (11, "x" * 500_000), (12, prose(60_000, 5))]
BENCH = [(1, prose(90, 2)[40:260]), (None, "x y"), (3, None)]
OPERATORS = {
    "op1": (suffix_dedup.suffix_dedup, ["n_bytes", "n_removed", "n_spans"]),
    "op2": (lambda d: class_lm.fit_score(d, top=50, classes=6, sweeps=1), ["n_tokens", "n_known"]),
    "op3": (bpe.encode_decode, ["decoded"]),
    "op4": (None, ["n_words", "n_hit", "contaminated"]),
    "op5": (substring_dedup.substring_dedup, ["n_words", "n_removed"]),
    "op6": (jaccard_join.ngram_jaccard_join, ["n_shingles", "component_id"]),
    "op7": (lambda d: sharding.shard(d, 3), ["size", "shard", "grown_shard"]),
    "op8": (token_counts.token_counts, ["n_bytes", "n_tokens"]),
    "op10": (quality_rules.quality_rules, ["n_words", "word_chars", "kept"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_tables(spark, name):
    apply, columns = OPERATORS[name]
    if apply is None:
        items = spark.createDataFrame(BENCH, "item_id long, text string")
        apply = lambda d: decontaminate.decontaminate(d, items)
    plain = spark.createDataFrame(ROWS, "doc_id long, text string")
    clashing = plain.select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    found = apply(clashing).select("doc_id", *columns).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in ROWS)
    assert sorted(map(key, found)) == sorted(map(key, apply(plain).select("doc_id", *columns).collect()))
    # repeated rows get equal results
    twice = [r for r in map(key, found) if sum(x == r for x in map(key, found)) > 1]
    assert len(twice) >= 2 and twice[0][0] == "None"
    assert apply(clashing.limit(0)).collect() == []
