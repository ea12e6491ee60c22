import random

import numpy as np
import pytest

from headwater.llm import jaccard_join
from headwater.llm.jaccard_join import bands, ngram_jaccard_join, signatures
from tests.llm import brute


def rows():
    rng = random.Random(3)
    base = [[f"w{rng.randrange(3000)}" for _ in range(k)] for k in (7, 30, 120, 400)]
    out = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  b"), (6, "a b c d e"), (7, "a b c d e f"), (8, "a " * 500)]
    i = 10
    for words in base:
        for _ in range(40):
            w = list(words)
            for _ in range(rng.randrange(0, max(2, len(w) // 25))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            cut = rng.randrange(0, max(1, len(w) // 12))
            out.append((i, " ".join(w[cut:])))
            i += 1
    out.append((i, out[-1][1]))
    return out


@pytest.mark.parametrize("group", [jaccard_join.GROUP, 300], ids=["whole", "blocks"])
def test_against_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(jaccard_join, "GROUP", group)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(spark.createDataFrame(rows(), "doc_id long, text string")).collect()}
    assert found == brute.jaccard(rows())


def test_whole_table_and_empty(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(df).collect()}
    assert found == brute.jaccard([(r.doc_id, r.text) for r in df.collect()])
    assert ngram_jaccard_join(df.limit(0)).collect() == []


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for size in [1, 3, 4, 5, 9, 10, 17, 45, 200, 1000]:
        for _ in range(40):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            gone = rng.integers(0, size // 9 + 1)
            new = rng.integers(0, size // 9 + 1)
            while 9 * (gone + new) > 2 * size - gone + new:
                gone, new = max(0, gone - 1), max(0, new - 1)
            b = np.concatenate((a[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)))
            doc, h, need = signatures(np.concatenate((a, b)), np.array([len(a), len(b)]))
            assert np.intersect1d(h[doc == 0], h[doc == 1]).size >= max(1, need.max())


def test_bands_cover_neighbours():
    upper = bands(5000)
    for a in range(1, 4000):
        b = a * 5 // 4
        assert np.searchsorted(upper, b) - np.searchsorted(upper, a) in (0, 1)
