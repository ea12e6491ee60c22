"""Collocations, periodic runs and SimHash against plain versions, with odd tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from headwater.llm import collocations, periodic_runs, simhash

CLASHES = ["n", "lang_", "phrase", "a", "l", "r", "k", "f", "fp", "u", "v", "variant", "root", "least", "start", "length", "period", "runs", "_g", "_w", "_n", "_a", "_p", "id", "none", "label", "node"]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def words_of(t):
    return [w.decode() for w in (t or "").encode().split()]


# collocations


def plain_collocations(rows, max_n, least, percent, top):
    f, n = Counter(), Counter()
    for lang, t in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, max_n + 1):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = {(lang, p[i : i + m]) for (lang, p), b in candidates.items() for m in range(2, len(p)) for i in range(len(p) - m + 1) if 100 * b >= percent * f[lang, p[i : i + m]]}
    out = []
    for lang in n:
        own = []
        for (x, p), a in candidates.items():
            if x == lang and (x, p) not in covered:
                score, k = min((1_000_000 * a * a // (f[x, p[:k]] * f[x, p[k:]]), k) for k in range(1, len(p)))
                own.append((-score, -a, " ".join(p).encode(), f[x, p[:k]], f[x, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(own)[:top])]
    return sorted(out)


def some_texts(n, seed):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "city", "état", "of", "the", "x y", "日本"]
    return [("".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ", ", "\n", ". ", "!"]) for _ in range(rng.randrange(60)))) for _ in range(n)]


@pytest.mark.parametrize("max_n, least, top", [(3, 10, 2000), (2, 3, 5), (5, 2, 2000), (4, 4, 7)])
def test_collocations_are_the_plain_ones(spark, monkeypatch, max_n, least, top):
    monkeypatch.setattr(collocations, "CHUNK", 2000)
    rng = random.Random(max_n)
    rows = [(rng.choice(["en", "fr", None, "und", ""]), t) for t in some_texts(200, max_n)] + [("en", None), (None, ""), ("de", " .,\n")] + [("fr", "the same row twice the same row twice")] * 3
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = [tuple(r) for r in collocations.collocations(docs, max_n, least, 50, top).collect()]
    want = [r for r in plain_collocations(rows, max_n, least, 50, top)]
    assert sorted(found) == want and len(want) > 3


def test_a_small_bitmap_loses_nothing(spark, monkeypatch):
    rows = [("en", t) for t in some_texts(60, 9)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = plain_collocations(rows, 4, 3, 50, 2000)
    # every bit is set, so everything longer is exploded
    monkeypatch.setattr(collocations, "BITS", 1 << 4)
    full = type("Full", (), {"value": (8, np.array([255], np.uint8))})
    monkeypatch.setattr(collocations, "_bitmap", lambda phrases: full)
    assert sorted(tuple(r) for r in collocations.collocations(docs, 4, 3).collect()) == want


def test_scores_of_counts_past_64_bits(spark):
    a, left, right = 4_000_000_000_001, 5_000_000_000_009, 999_999_999_999_999
    counts = spark.createDataFrame([("en", "p q", a), ("en", "p", left), ("en", "q", right)], "lang string, phrase string, f long")
    assert collocations.scored(counts).collect()[0].score == 1_000_000 * a * a // (left * right)


def test_collocations_of_odd_tables(spark):
    rows = [(None, "Big deal " * 12), (None, "Big deal " * 12), (5, "x" * 300_000), (5, None), (6, "word " * 100_000)]
    plain = spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, lang string")
    clashing = plain.select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    found = sorted(map(tuple, collocations.collocations(clashing).collect()))
    assert found == plain_collocations([("en", t) for _, t in rows], 3, 10, 50, 2000) and found
    assert collocations.collocations(clashing.limit(0)).collect() == []


# periodic runs


def plain_runs(w, least=12):
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - p:
            if w[i] != w[i + p]:
                i += 1
                continue
            s = i
            while i < len(w) - p and w[i] == w[i + p]:
                i += 1
            if i - s >= max(p, least - p):
                found.setdefault((s, i - s + p), p)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def told(w):
    own = plain_runs(w)
    gone = {i for s, n, p in own for i in range(s + p, s + n)}
    best = max(own, key=lambda r: (r[1], -r[0], -r[2])) if own else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (len(own), *best, 1000 * best[1] // best[2] if own else None, sha("".join("%d,%d,%d\n" % r for r in own)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic_text(rng):
    kinds, n = rng.choice([1, 2, 3, 12]), rng.choice([0, 1, 5, 12, 40, 150])
    w = [f"W{rng.randrange(kinds)}é" for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randrange(2, 12)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return rng.choice([" ", "\n", " \t"]).join(w)


@pytest.mark.parametrize("near, piece, block", [(16, 64, 1 << 20), (1, 1, 1), (3, 4, 50)])
def test_runs_are_the_plain_ones(monkeypatch, near, piece, block):
    for name, value in (("NEAR", near), ("PIECE", piece), ("BLOCK", block)):
        monkeypatch.setattr(periodic_runs, name, value)
    rng = random.Random(near)
    for _ in range(150):
        docs = [periodic_text(rng).split() for _ in range(4)]
        first = np.cumsum([0] + [len(d) for d in docs])
        names = {}
        codes = np.array([names.setdefault(x, len(names)) for d in docs for x in d], np.int64)
        found = periodic_runs.runs(codes, first)
        assert [found.get(i, []) for i in range(4)] == [plain_runs(d) for d in docs]


def test_periodic_runs_of_odd_tables(spark):
    rng = random.Random(3)
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    rows = [(None, periodic_text(rng)), (None, "x " * 20), (None, "x " * 20), (5, "a b " * 9), (5, "c"), (6, ""), (7, None), (8, "\n \t"), (9, "w " * 30_000), (10, "x" * 300_000), (11, " ".join(fib[-1]))] + [(20 + i, periodic_text(rng)) for i in range(60)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = plain.select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", F.sha2("collapsed", 256)]
    # the plain version takes the square of the text's length
    by_hand = {9: (1, 0, 30_000, 1, 30_000_000, hashlib.sha256(b"0,30000,1\n").hexdigest(), hashlib.sha256(b"w").hexdigest())}
    found = sorted((tuple(r) for r in periodic_runs.periodic_runs(clashing).select(*columns).collect()), key=str)
    assert found == sorted(((d, *(by_hand.get(d) or told(words_of(t)))) for d, t in rows), key=str)
    assert periodic_runs.periodic_runs(clashing.limit(0)).collect() == []


def test_echoed_texts(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(40)))) for i in range(-5, 200)] + [(None, "a b"), (3, None)]
    found = periodic_runs.echoed(spark.createDataFrame(rows, "doc_id long, text string")).collect()

    def want(d, t):
        h = 1 if d is None else zlib.crc32(str(d).encode())
        w, g = words_of(t), h // 10
        if h % 10 or not w:
            return t
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(len(w)))

    assert sorted(map(tuple, found), key=str) == sorted(((d, want(d, t)) for d, t in rows), key=str)
    assert sum(want(d, t) != t for d, t in rows) > 8


# SimHash


def plain_print(t, n=3):
    w = words_of(lower(t))
    if not w:
        return 0
    own = [xxhash.xxh64_intdigest(" ".join(w[i : i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in own) > len(own))


def plain_groups(rows, radius):
    prints = {i: plain_print(t) for i, (_, t) in enumerate(rows)}
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in prints:
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min((x for x in (least.get(root(i)), d) if x is not None), default=None)
    return sorted(((d, f"{prints[i]:016x}", least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_simhash_groups_are_the_plain_ones(spark, radius):
    rng = random.Random(radius)
    base = [[f"word{rng.randrange(500)}" for _ in range(150)] for _ in range(6)]
    rows = [(None, None), (None, " "), (4, ""), (None, "only here, no number"), (5, "Two words"), (5, "TWO  words"), (6, "x" * 200_000), (7, "w " * 20_000)]
    for i in range(70):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = f"odd{rng.randrange(99)}"
        rows.append((100 + i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    assert sorted((tuple(r) for r in simhash.simhash_groups(docs, radius).collect()), key=str) == plain_groups(rows, radius)


def test_links_join_all_within_the_radius(spark):
    rng = random.Random(7)
    for radius in (1, 2, 3):
        prints = {rng.getrandbits(64) for _ in range(3)}
        for _ in range(60):
            x = rng.choice(sorted(prints))
            for _ in range(rng.randrange(1, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
        signed = {x - (1 << 64) if x >> 63 else x for x in prints}
        rows = spark.createDataFrame([(x,) for x in signed], "fp long")
        up = {x: x for x in signed}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x

        pairs = simhash.links(rows, radius).collect()
        for u, v in pairs:
            assert ((u ^ v) & ((1 << 64) - 1)).bit_count() <= radius
            up[root(u)] = root(v)
        for u in signed:
            for v in signed:
                if ((u ^ v) & ((1 << 64) - 1)).bit_count() <= radius:
                    assert root(u) == root(v)


def test_a_fingerprint_counts_repeats_and_long_texts(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 7)
    for t in ["A b c d A b c", "one", "one two", "Ä ß ı İ K", "x y z w v", "w " * 100, "a b c " * 33]:
        assert simhash.fingerprint(t.encode()) == plain_print(t)


def test_empty_table(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []
