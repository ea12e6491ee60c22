"""The class model: likelihood, probabilities, and scores against a plain recomputation."""

import math
import random
import re
import zlib

import numpy as np
import xxhash

from headwater.llm import class_lm, packing

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())


def likelihood(joint):
    f = lambda x: float((x[x > 0] * np.log(x[x > 0])).sum())
    return f(joint) - f(joint.sum(0)) - f(joint.sum(1))


def test_a_sweep_raises_the_likelihood():
    rng = np.random.default_rng(3)
    side = rng.integers(0, 4, 60)
    bigrams = rng.poisson(0.3 + 6.0 * (side[:, None] == (side[None] + 1) % 4)).astype(float)
    found = []
    for sweeps in range(4):
        cls = class_lm.exchange(bigrams, 0, 6, sweeps)
        member = np.eye(6)[cls]
        found.append(likelihood(member.T @ bigrams @ member))
        assert cls[0] == 0 and (cls[1:] > 0).all()
    assert all(b >= a - 1e-6 for a, b in zip(found, found[1:])) and found[-1] > found[0] + 1


def test_one_step_takes_the_best_class():
    rng = np.random.default_rng(5)
    k = 7
    joint = rng.integers(2000, 9000, (k, k)).astype(float)
    word, cell, times = [], [], []
    for w in range(40):
        for c in sorted(rng.choice(2 * k, rng.integers(1, 6), replace=False).tolist()):
            word.append(w), cell.append(c), times.append(int(rng.integers(1, 40)))
    word, cell, times = map(np.array, (word, cell, times))
    start, total = rng.integers(1, k, 40), np.maximum(np.bincount(word, times * (cell < k)), 1).astype(int)
    got = class_lm.best_classes(word, cell, times, start, total, joint)
    assert (got > 0).all()
    for w in range(40):
        own = word == w

        def moved(b):
            new = joint.copy()
            out, into = joint.sum(1), joint.sum(0)
            for c, r in zip(cell[own], times[own]):
                for cls, sign in ((start[w], -1), (b, 1)):
                    i, j = (cls, c) if c < k else (c - k, cls)
                    new[i, j] += sign * r
            out[start[w]] -= total[w]
            out[b] += total[w]
            into[start[w]] -= total[w]
            into[b] += total[w]
            f = lambda x: float((x * np.log(x)).sum())
            return f(new) - f(out) - f(into)

        gains = {b: moved(b) for b in range(1, k)}
        assert gains[got[w]] >= max(gains.values()) - 1e-2
    blocks = class_lm.CELLS
    try:
        class_lm.CELLS = 5
        assert (class_lm.best_classes(word, cell, times, start, total, joint) == got).all()
    finally:
        class_lm.CELLS = blocks


def corpus():
    rng = random.Random(2)
    # one ending for all, so their neighbours alone tell the sides apart
    sides = [[f"{s}{i}-end" for i in range(60)] for s in "abc"]
    pick = lambda side: side[min(int(rng.expovariate(0.08)), 59)]
    texts = [" ".join(pick(sides[(start + i) % 3]) for i in range(50)) for start in [0, 1, 2] * 50]
    return [*texts, None, "", " \n", "new WORDS here", "A1 a2 b3", "word " * 4000, texts[5]]


def test_scores_are_those_of_the_formulas(spark):
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in enumerate(texts)], "doc_id long, text string, score string, n_tokens int")
    model = class_lm.fit(docs, top=20, classes=7, sweeps=3)
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    split = [[*WORDS.findall(lower(t)), b"\n"] for t in texts]
    count = {}
    for i in train:
        for w in split[i]:
            count[w] = count.get(w, 0) + 1
    table = {}
    for r in model.words.collect():
        for h, c, k in zip(*packing.unpack(r.words), strict=True):
            table[int(h)] = (int(c), int(k))
    digest = lambda w: int(np.frombuffer(xxhash.xxh3_128_digest(w), "<u8")[0])
    cls = {w: table[digest(w)][1] for w in count}
    assert {w: table[digest(w)][0] for w in count} == count and len(table) == len(count)
    assert cls[b"\n"] == 0 and all(cls[w] > 0 for w in count if w != b"\n")
    # words outside the broadcast table have classes of their own, not those of their endings
    rare = [w for w in count if w != b"\n" and digest(w) not in set(map(int, model.top_hash))]
    stand_in = {w: int(model.cls[len(model.top_hash) + 1 + class_lm.Tokens(np.frombuffer(w, np.uint8), np.array([0, len(w)])).ending[0]]) for w in rare}
    assert len(rare) > 100 and sum(cls[w] != stand_in[w] for w in rare) > len(rare) // 2
    sides = [[chr(w[0]) for w in rare if cls[w] == k and w.endswith(b"-end")] for k in range(7)]
    assert sum(max(map(x.count, "abc")) for x in sides) > 0.9 * sum(map(len, sides))
    # a class's tokens and words, and probabilities that add up
    for k in range(7):
        own = [w for w in count if cls[w] == k]
        n, v = sum(count[w] for w in own), len(own)
        if own:
            assert (model.class_tokens[k], model.class_words[k]) == (n, v)
        if own and k:
            assert math.isclose(sum(count[w] - model.discount for w in own) / n + model.discount * v / n, 1)
    assert np.allclose(model.transition.sum(1), 1)
    joint = np.zeros((7, 7))
    for i in train:
        before = 0
        for w in split[i]:
            joint[before, cls[w]] += 1
            before = cls[w]
    share = (joint.sum(0) + 1) / (joint.sum() + 7)
    assert np.allclose(model.transition, (joint + 20 * share) / (joint.sum(1, keepdims=True) + 20))
    n, v = sum(count.values()), len(count)
    found = class_lm.score(docs, model).collect()
    assert len(found) == len(texts)
    for r in found:
        own, before, want = split[r.doc_id], 0, 0.0
        for w in own:
            guess = int(model.cls[len(model.top_hash) + 1 + class_lm.Tokens(np.frombuffer(w, np.uint8), np.array([0, len(w)])).ending[0]]) if w not in count else 0
            k, c = cls.get(w, guess), count.get(w, 0)
            lift = c if w == b"\n" else max(c - model.discount, 1e-3) if c else model.discount * model.class_words[k]
            want += math.log10(model.transition[before, k]) + math.log10(lift / model.class_tokens[k])
            before = k
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(own), sum(w in count for w in own), n, r.doc_id not in train)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, want, rel_tol=1e-9)
    once = class_lm.fit_score(docs, top=20, classes=7, sweeps=3).collect()
    assert sorted((r.doc_id, round(r.score, 6)) for r in once) == sorted((r.doc_id, round(r.score, 6)) for r in found)
    held = [r for r in found if r.held_out and r.n_tokens > 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_tables_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert class_lm.fit_score(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, "a b a c"), (1, "a b a c"), (2, "c b a"), (None, "a c")]
    found = sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.score, 9), r.train_tokens) for r in class_lm.fit_score(spark.createDataFrame(rows, schema), top=2, classes=3).collect())
    assert [x[:3] for x in found] == [("1", 5, 5), ("1", 5, 5), ("2", 4, 4), ("None", 3, 3)] and found[0] == found[1]
    assert {x[4] for x in found} == {sum(len(t.split()) + 1 for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 7 != 2)}
