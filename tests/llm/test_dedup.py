import random

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headwater.llm.substring_dedup import substring_dedup
from headwater.llm.suffix_dedup import SuffixFamily, suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, n_words string, kept string"


def odd_rows():
    rng = random.Random(5)
    base = [" ".join(rng.choice("the of and réd ünd x-y zeta").strip() + str(rng.randrange(40)) for _ in range(150)) for _ in range(4)]
    rows = [(1, base[0]), (2, base[0]), (3, None), (4, ""), (5, base[1] + " " + base[0][200:600] + " tail " + base[1][:300]), (6, " \n\t "), (7, "a " * 90), (8, "a" * 400), (9, base[2].replace(" ", "\n\n")), (10, base[2])]
    rows += [(11 + i, f"head {i} " + base[3][: 300 + 7 * i] + f" end {i}") for i in range(30)]
    rows += [(60, " ".join(base[2].split())), (61, base[3] * 40), (-5, base[3][100:400])]
    return [(d, t, "x", "y") for d, t in rows]


def as_dict(df, names):
    df = df.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("rows", [odd_rows(), []], ids=["odd", "empty"])
def test_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    plain = [r[:2] for r in rows]
    assert as_dict(suffix_dedup(df), ["n_bytes", "n_removed", "n_spans", "kept_sha256"]) == brute.suffix_dedup(plain)
    assert as_dict(substring_dedup(df), ["n_words", "n_removed", "kept_sha256"]) == brute.substring_dedup(plain)


def test_whole_table(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert as_dict(suffix_dedup(df), ["n_bytes", "n_removed", "n_spans", "kept_sha256"]) == brute.suffix_dedup(rows)
    assert as_dict(substring_dedup(df), ["n_words", "n_removed", "kept_sha256"]) == brute.substring_dedup(rows)


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    found = sorted(((r.doc_id, r.n_removed) for r in substring_dedup(df).collect()), key=str)
    assert found == [(1, 60), (1, 60), (2, 60), (None, 0)]
    assert sorted(r.n_removed > 0 for r in suffix_dedup(df).collect()) == [False, True, True, True]


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 2)), max_size=30), max_size=12))
def test_family_finds_earlier_entries(batches):
    import numpy as np

    family, seen = SuffixFamily(), set()
    for batch in batches:
        flags = family.add(np.array([a for a, _ in batch], np.uint64), np.array([b for _, b in batch], np.uint64))
        want = []
        for x in batch:
            want.append(x in seen)
            seen.add(x)
        assert flags.tolist() == want
        sizes = [len(k) for k, _ in family.levels]
        assert all(a >= 2 * b for a, b in zip(sizes, sizes[1:]))
