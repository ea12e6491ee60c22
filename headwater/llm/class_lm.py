"""Scoring by Brown's class-based bigram model.

P(text) is the product over its tokens of P(class | class before) and P(word | class). Exchange
clustering assigns every training word to a class by the likelihood of class bigrams, in two parts:

1. On the driver, words take turns over sweeps: the ``top`` most frequent ones, and stand-ins for all
   others, which are pooled by their ending. The bigrams of these types are bounded by the parameters.
2. Distributed, each other word leaves its stand-in: from its own neighbours' classes, gathered over all
   training documents, it moves to the class that raises the likelihood most, if by more than naming a class costs;
   words that hardly occur would follow chance otherwise. All words move at once, against the class bigrams of part 1. The word's class and count stay distributed, dealt by the word's hash.

Transitions are then counted anew over all training documents with the final classes of all words. Texts
are scored by dealing the words outside the broadcast table to their hash buckets and their classes back to the texts.

A known word has (count - d) / N(class), and d * V(class) / N(class) is left to the class's unknown
words, which have the class of their ending's stand-in, with d from the numbers of words seen once and twice.
Transitions are smoothed towards class frequencies.

Null texts are empty and have the end token alone. Rows repeated as a whole count as often as they occur
and get equal results. Rows with a null doc_id are for training.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import common, packing, repeats
from headwater.llm.textarrays import U64, Words, chunks, column_bytes, mix, slices

CHUNK = 4 << 20
TOP, ENDINGS, CLASSES, SWEEPS = 2048, 512, 48, 5
#: Counts that a task holds before it adds them up.
HELD = 2_000_000
#: Cells of contexts that are valued at a time.
CELLS = 1 << 16
#: What it takes to name a word's class, in units of the logarithm of the number of classes.
MARGIN = 1.0
#: Class of a token whose word is looked up elsewhere.
OPEN = 255
END = np.frombuffer(xxhash.xxh3_128_digest(b"\n"), "<u8")[0]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def held_out(ids: np.ndarray) -> np.ndarray:
    return np.array([d != common.NO_ID and zlib.crc32(b"%d" % d) % 7 == 2 for d in ids.tolist()], bool)


class Tokens:
    """Words of a chunk in lower case: an exact dictionary with hashes and endings, and each word's place in it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = Words(_LOWER[data], offsets)
        at, distinct = self.words.dictionary()
        used = np.zeros(len(distinct), bool)
        used[at] = True
        place = np.cumsum(used) - 1
        self.at = place[at] if len(at) else np.zeros(0, np.int64)
        texts = distinct.filter(pa.array(used)).to_pylist() if len(at) else []
        self.hash = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, texts)), "<u8").reshape(-1, 2)[:, 0]
        ends = [int.from_bytes(w[-3:], "little") for w in texts]
        self.ending = (mix(np.array(ends, U64), 5) % U64(ENDINGS)).astype(np.int64)


def _summed(h: np.ndarray, e: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, e, c = h[order], e[order], c[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[first], e[first], np.add.reduceat(c, first)


def _count(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[tuple[int, bytes]]:
    parts: list[tuple] = []

    def flush() -> Iterator[tuple[int, bytes]]:
        if parts:
            h, e, c = _summed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            parts.clear()
            for b, at in packing.split((h % U64(n)).astype(np.int64), n):
                yield b, packing.pack(h[at], e[at].astype(np.uint16), c[at].astype(np.uint64), raw=(0,))

    for ids, data, offsets in chunks(batches, CHUNK):
        train = ~held_out(ids)
        if not train.any():
            continue
        t = Tokens(data, offsets)
        c = np.bincount(t.at[train[t.words.doc]], minlength=len(t.hash))
        some = c > 0
        parts.append((np.append(t.hash[some], END), np.append(t.ending[some], 0), np.append(c[some], train.sum())))
        if sum(len(x[0]) for x in parts) > HELD:
            yield from flush()
    yield from flush()


def _reduce(group: pa.Table, top: int) -> pa.Table:
    """One row a bucket: its counts, the sums by ending, and its most frequent words."""
    h, e, c = _summed(*packing.concat(repeats.blobs_of(group)))
    bucket = group.column("bucket")[0].as_py()
    real = h != END
    sums = np.stack([np.bincount(e[k], w, minlength=ENDINGS).astype(np.int64) for k, w in ((real, c[real]), (real, None), (real & (c == 1), None), (real & (c == 2), None))])
    first = np.lexsort((h, -c.astype(np.int64)))[: top + 1]
    row = [[bucket], [packing.pack(h, e, c, raw=(0,))], [packing.pack(*sums)], [packing.pack(h[first], e[first], c[first], raw=(0,))], [int(c.sum())], [len(h)]]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["bucket", "counts", "sums", "top", "tokens", "types"])


def _exploded(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Rows of the arrays of blobs; the first column of sums is the place in the array."""
    names = {"sums": ["ending", "n", "v", "once", "twice"], "class": ["class", "n", "v"], "top": ["hash", "ending", "n"]}[column]
    for batch in batches:
        for blob in batch.column(0).to_pylist():
            arrays = [x.astype(np.int64) if x.dtype != U64 else x.view(np.int64) for x in packing.unpack(blob)]
            if column != "top":
                arrays = [np.arange(len(arrays[0])), *arrays]
            yield pa.record_batch([pa.array(x, pa.int64()) for x in arrays], names=names)


def _types(t: Tokens, top_hash: np.ndarray) -> np.ndarray:
    """The type of each word of the dictionary. Types: frequent words, the end token, endings."""
    if not len(top_hash):
        return 1 + t.ending
    slot = np.minimum(np.searchsorted(top_hash, t.hash), len(top_hash) - 1)
    return np.where(top_hash[slot] == t.hash, slot, len(top_hash) + 1 + t.ending)


def _sequence(t: Tokens, types: np.ndarray, end: int, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Types before and of all tokens, ends included, and the documents."""
    own = np.full(len(t.at) + docs, end, np.int64)
    own[np.arange(len(t.at)) + t.words.doc] = types[t.at]
    before = np.concatenate(([end], own[:-1]))
    doc = np.repeat(np.arange(docs), t.words.counts + 1)
    return before, own, doc


def _bigrams(batches: Iterable[pa.RecordBatch], top, size: int, rows_each: int, parts: int) -> Iterator[tuple[int, bytes]]:
    """The type bigrams of a task, dealt by ``rows_each`` first types and one of ``parts`` groups of tasks."""
    top_hash = top.value
    total = np.zeros(size * size, np.int64)
    some = False
    for ids, data, offsets in chunks(batches, CHUNK):
        train = ~held_out(ids)
        if not train.any():
            continue
        some = True
        t = Tokens(data, offsets)
        before, own, doc = _sequence(t, _types(t, top_hash), len(top_hash), len(ids))
        keep = train[doc]
        at, n = np.unique(before[keep] * size + own[keep], return_counts=True)
        total[at] += n
    if some:
        at = np.flatnonzero(total)
        mine = TaskContext.get().partitionId() % parts
        for b, own in packing.split(at // size // rows_each, size // rows_each + 1):
            yield b * parts + mine, packing.pack(at[own].astype(np.uint32), total[at[own]].astype(np.uint64))


def _add_bigrams(group: pa.Table, parts: int) -> pa.Table:
    """The sum of a group's blobs, for the bucket without its ``parts``."""
    at, n = packing.concat(repeats.blobs_of(group))
    order = np.argsort(at, kind="stable")
    at, n = at[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return repeats.as_table([(group.column("bucket")[0].as_py() // parts, packing.pack(at[first], np.add.reduceat(n, first)))])


def exchange(bigrams: np.ndarray, end: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each type. Class 0 is the end token's own."""
    size = len(bigrams)
    weight = bigrams.sum(0) + bigrams.sum(1)
    order = np.argsort(-weight, kind="stable")
    order = order[order != end]
    cls = np.zeros(size, np.int64)
    cls[order] = 1 + np.arange(len(order)) % (classes - 1)
    member = np.zeros((size, classes))
    member[np.arange(size), cls] = 1
    joint = member.T @ bigrams @ member

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-9))

    after, ahead = bigrams @ member, bigrams.T @ member
    fj = f(joint)
    for _ in range(sweeps):
        moved = 0
        for w in order[weight[order] > 0]:
            a, own = cls[w], bigrams[w, w]
            right, left = after[w], ahead[w]
            # take w out of its class
            joint[a] -= right
            joint[:, a] -= left
            joint[a, a] += own
            fj[a], fj[:, a] = f(joint[a]), f(joint[:, a])
            r, l = right.copy(), left.copy()
            r[a] -= own
            l[a] -= own
            rows, columns = joint + r, joint + l[:, None]
            corner = np.diag(joint) + r + l + own
            gain = (f(rows) - fj).sum(1) + (f(columns) - fj).sum(0) - f(np.diag(rows)) - f(np.diag(columns)) + np.diag(fj) + f(corner)
            out, into = joint.sum(1), joint.sum(0)
            nw, mw = r.sum() + own, l.sum() + own
            gain -= f(out + nw) - f(out) + f(into + mw) - f(into)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            joint[b] += r
            joint[:, b] += l
            joint[b, b] += own
            fj[b], fj[:, b] = f(joint[b]), f(joint[:, b])
            if b != a:
                moved += 1
                cls[w] = b
                after[:, a] -= bigrams[:, w]
                after[:, b] += bigrams[:, w]
                ahead[:, a] -= bigrams[w]
                ahead[:, b] += bigrams[w]
            # counts between classes include the pairs of w with itself again
        # sums and differences leave small residues
        member[:] = 0
        member[np.arange(size), cls] = 1
        joint = member.T @ bigrams @ member
        after, ahead = bigrams @ member, bigrams.T @ member
        fj = f(joint)
        if not moved:
            break
    return cls


def _contexts(batches: Iterable[pa.RecordBatch], shared, n: int) -> Iterator[tuple[int, bytes]]:
    """For each word outside the broadcast table how often each class comes after and before it, dealt by its hash."""
    m = shared.value
    end, k = len(m["top_hash"]), m["classes"]
    for ids, data, offsets in chunks(batches, common.chunk_bytes(n, CHUNK)):
        train = ~held_out(ids)
        if not train.any():
            continue
        t = Tokens(data, offsets)
        types = _types(t, m["top_hash"])
        _, own, _ = _sequence(t, types, end, len(ids))
        cls = m["cls"][own]
        at = np.flatnonzero((types[t.at] > end) & train[t.words.doc])
        if not len(at):
            continue
        # an end token follows each text, so a text's first word has the end before it and the last one after it
        place = at + t.words.doc[at]
        word = t.at[at] * (2 * k)
        key, times = np.unique(np.concatenate((word + cls[place + 1], word + k + np.where(place > 0, cls[place - 1], 0))), return_counts=True)
        word, cell = key // (2 * k), (key % (2 * k)).astype(np.uint8)
        for b, own in packing.split((t.hash[word] % U64(n)).astype(np.int64), n):
            _, words, sizes = packing.by_doc(word[own])
            yield b, packing.pack(_six(t.hash[words]), sizes, cell[own], times[own].astype(np.uint32), raw=(0,))


def _six(h: np.ndarray) -> np.ndarray:
    """The lower 48 bits of hashes, as bytes; the bucket tells the others apart."""
    return np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8)[:, :6].reshape(-1)


def _from_six(six: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(six) // 6, 8), np.uint8)
    wide[:, :6] = six.reshape(-1, 6)
    return wide.reshape(-1).view(U64)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-9)), 0.0)


def best_classes(word: np.ndarray, cell: np.ndarray, times: np.ndarray, start: np.ndarray, total: np.ndarray, joint: np.ndarray, margin: float = 0.0) -> np.ndarray:
    """The class of each word after one exchange step against the class bigrams ``joint``.

    Cells are sorted by word: a class after (cell below the number of classes) or before the word, and how often. ``start`` and
    ``total`` are the words' classes and counts. Only the word's own cells change, so nothing else is valued;
    staying is valued as the loss by leaving. A move has to gain over ``margin`` nats, what it costs to tell the class of
    a word that departs from its stand-in's. Class 0 is the end token's.
    """
    k = len(joint)
    both = np.concatenate((joint.T, joint))
    out, into = joint.sum(1), joint.sum(0)
    small = np.arange(1, 16)
    table = (_xlogx(both[None] + small[:, None, None]) - _xlogx(both)[None]).astype(np.float32)
    best = start.copy()
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(word) else np.zeros(0, np.int64)
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(first, first[i] + CELLS, "right")) - 1)
        j = len(first) if len(word) - first[i] <= CELLS else j
        a, b = first[i], first[j] if j < len(first) else len(word)
        c, r, own = cell[a:b].astype(np.int64), times[a:b].astype(np.int64), word[first[i:j]]
        gain = table[np.minimum(r, 15) - 1, c]
        large = np.flatnonzero(r > 15)
        gain[large] = _xlogx(both[c[large]] + r[large, None]) - _xlogx(both[c[large]])
        gain = np.add.reduceat(gain, first[i:j] - a)
        was, n = start[own], total[own].astype(float)
        here = both[c, start[word[a:b]]]
        stay = np.add.reduceat(_xlogx(here) - _xlogx(here - r), first[i:j] - a)
        for side in (out, into):
            gain -= (_xlogx(side[None] + n[:, None]) - _xlogx(side)[None]).astype(np.float32)
            stay -= _xlogx(side[was]) - _xlogx(side[was] - n)
        gain[np.arange(len(own)), was] = stay + margin
        gain[:, 0] = -np.inf
        best[own] = np.argmax(gain, 1)
        i = j
    return best


def _assigned(own: pa.Table, found: pa.Table, shared) -> pa.Table:
    """A bucket's words with counts and classes, and the sums by class."""
    m = shared.value
    bucket = (own if own.num_rows else found).column("bucket")[0].as_py()
    h, e, c = packing.concat(found.column("counts").to_pylist())
    end = len(m["top_hash"])
    slot = np.minimum(np.searchsorted(m["top_hash"], h), max(0, end - 1))
    frequent = m["top_hash"][slot] == h if end else np.zeros(len(h), bool)
    cls = np.where(h == END, 0, np.where(frequent, m["cls"][slot], m["cls"][end + 1 + e])).astype(np.int64)
    if own.num_rows:
        six, sizes, cell, times = packing.concat(repeats.blobs_of(own))
        low = h & U64(0xFFFFFFFFFFFF)
        order = np.argsort(low)
        word = order[np.searchsorted(low[order], _from_six(six))]
        key = np.repeat(word, sizes) * 256 + cell
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key, times = key[first], np.add.reduceat(times, first)
        cls = best_classes(key >> 8, key & 255, times, cls, c.astype(np.int64), m["joint"], MARGIN * np.log(m["classes"]))
    sums = [np.bincount(cls, w, m["classes"]).astype(np.int64) for w in (c, None)]
    row = [[bucket], [packing.pack(h, c, cls.astype(np.uint8), raw=(0,))], [packing.pack(*sums)]]
    return pa.table([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["bucket", "words", "sums"])


@dataclass
class Model:
    """What the driver knows: bounded by the parameters. ``words`` is the distributed rest."""

    top_hash: np.ndarray
    top_count: np.ndarray
    #: of the types: frequent words, the end token, stand-ins of endings
    cls: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    end_count: int
    discount: float
    tokens: int
    types: int
    #: bucket and a blob of hashes, counts and classes, of all training words
    words: DataFrame
    buckets: int
    transition: np.ndarray | None = None

    def shared(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "words"}


def learn(docs: DataFrame, top: int = TOP, classes: int = CLASSES, sweeps: int = SWEEPS) -> Model:
    """Counts and classes of the words of all documents that aren't held out, without transitions yet."""
    if classes > 128:
        raise ValueError("contexts are packed for 128 classes at most")
    spark = docs.sparkSession
    common.shared_folder(spark)
    own = common.texts(docs)
    n = max(3, common.buckets(own) // 2)
    sent = own.mapInArrow(lambda x: repeats.rows(_count(x, n)), repeats.BLOBS)
    found = sent.groupBy("bucket").applyInArrow(lambda g: _reduce(g, top), "bucket int, counts binary, sums binary, top binary, tokens long, types long").checkpoint()
    tokens, types = (x or 0 for x in found.agg(F.sum("tokens"), F.sum("types")).first())
    sums = np.zeros((4, ENDINGS))
    rows = found.select("sums").mapInArrow(lambda x: _exploded(x, "sums"), "ending long, n long, v long, once long, twice long")
    for r in rows.groupBy("ending").agg(*[F.sum(c).alias(c) for c in ("n", "v", "once", "twice")]).collect():
        sums[:, r.ending] = r.n, r.v, r.once, r.twice
    first = found.select("top").mapInArrow(lambda x: _exploded(x, "top"), "hash long, ending long, n long").orderBy(F.desc("n"), "hash").limit(top + 1).collect()
    end_count = next((r.n for r in first if r.hash == int(END.view(np.int64))), 0)
    first = [r for r in first if r.hash != int(END.view(np.int64))][:top]
    h = np.array([r.hash for r in first], np.int64).view(U64)
    order = np.argsort(h)
    top_hash, top_count = h[order], np.array([r.n for r in first], np.int64)[order]
    size = len(top_hash) + 1 + ENDINGS
    table = spark.sparkContext.broadcast(top_hash)
    rows_each, parts = 16, max(1, n // 64)
    pairs = own.mapInArrow(lambda x: repeats.rows(_bigrams(x, table, size, rows_each, parts)), repeats.BLOBS)
    if parts > 1:
        pairs = pairs.groupBy("bucket").applyInArrow(lambda g: _add_bigrams(g, parts), repeats.BLOBS)
    pairs = pairs.groupBy("bucket").applyInArrow(lambda g: _add_bigrams(g, 1), repeats.BLOBS)
    bigrams = np.zeros(size * size)
    for r in pairs.toLocalIterator():
        at, c = packing.unpack(r.blob)
        bigrams[at] = c
    bigrams = bigrams.reshape(size, size)
    cls = exchange(bigrams, len(top_hash), classes, sweeps)
    member = np.zeros((size, classes))
    member[np.arange(size), cls] = 1
    shared = spark.sparkContext.broadcast({"top_hash": top_hash, "cls": cls, "classes": classes, "joint": member.T @ bigrams @ member})
    contexts = own.mapInArrow(lambda x: repeats.rows(_contexts(x, shared, n)), repeats.BLOBS)
    words = contexts.groupBy("bucket").cogroup(found.select("bucket", "counts").groupBy("bucket")).applyInArrow(lambda a, b: _assigned(a, b, shared), "bucket int, words binary, sums binary").checkpoint()
    of = np.zeros((2, classes))
    rows = words.select("sums").mapInArrow(lambda x: _exploded(x, "class"), "class long, n long, v long")
    for r in rows.groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        of[:, r["class"]] = r.n, r.v
    once, twice = sums[2].sum(), sums[3].sum()
    discount = float(np.clip(once / max(1.0, once + 2 * twice), 0.1, 0.95))
    return Model(top_hash, top_count, cls, np.maximum(of[0], 1), np.maximum(of[1], 1), int(end_count), discount, int(tokens), int(types), words.select("bucket", "words"), n)


def _annotate(batches: Iterable[pa.RecordBatch], shared, n: int, p: int) -> Iterator[tuple[int, bytes]]:
    """A text's classes and sums as far as the broadcast table tells go to its bucket; its other words go to theirs."""
    m = shared.value
    end = len(m["top_hash"])
    counts = np.append(m["top_count"], m["end_count"]).astype(float)
    # the ends' class has one word, to which no discount applies
    lift = np.append(np.maximum(counts[:-1] - m["discount"], 1e-3), max(counts[-1], 0.5))
    emission, plus = np.log10(lift / m["class_tokens"][m["cls"][: end + 1]]), np.log10(counts + 1)
    for ids, data, offsets in chunks(batches, common.chunk_bytes(n, CHUNK)):
        t = Tokens(data, offsets)
        types = _types(t, m["top_hash"])
        _, own, doc = _sequence(t, types, end, len(ids))
        cls = m["cls"][own].astype(np.uint8)
        rare = own > end
        tokens = t.words.counts + 1
        seen, score, base = (np.bincount(doc[~rare], w[own[~rare]], len(ids)) for w in ((counts > 0).astype(float), emission, plus))
        first = np.cumsum(tokens) - tokens
        sequence = np.where(rare, np.uint8(OPEN), cls)
        for b, at in packing.split(common.doc_buckets(ids, p), p):
            yield n + b, packing.pack(ids[at], tokens[at].astype(np.uint32), seen[at].astype(np.uint32), score[at], base[at], sequence[slices(first[at], tokens[at])], raw=(3, 4))
        at = np.flatnonzero(types[t.at] > end)
        if not len(at):
            continue
        d, h = t.words.doc[at], t.hash[t.at[at]]
        place = (at + d - first[d]).astype(np.uint32)
        guess = cls[at + d]
        for b, own in packing.split((h % U64(n)).astype(np.int64), n):
            _, docs, sizes = packing.by_doc(ids[d[own]])
            yield b, packing.pack(docs, sizes, _six(h[own]), place[own], guess[own], raw=(2,))


def _looked_up(own: pa.Table, found: pa.Table, shared, n: int, p: int) -> pa.Table:
    """Classes and sums of the words of a bucket, dealt to the texts."""
    bucket = (own if own.num_rows else found).column("bucket")[0].as_py()
    if bucket >= n:
        return repeats.as_table((bucket - n, b) for b in repeats.blobs_of(own))
    if not own.num_rows:
        return repeats.as_table(())
    m = shared.value
    ids, sizes, six, place, guess = packing.concat(repeats.blobs_of(own))
    c, cls = np.zeros(len(guess)), guess.astype(np.int64)
    if found.num_rows:
        h, counts, classes = packing.concat(found.column("words").to_pylist())
        h = h & U64(0xFFFFFFFFFFFF)
        order = np.argsort(h)
        h = h[order]
        key = _from_six(six)
        slot = np.minimum(np.searchsorted(h, key), len(h) - 1)
        known = h[slot] == key
        c = np.where(known, counts[order][slot], 0).astype(float)
        cls = np.where(known, classes[order][slot], guess).astype(np.int64)
    lift = np.where(c > 0, np.maximum(c - m["discount"], 1e-3), m["discount"] * m["class_words"][cls])
    run = np.repeat(np.arange(len(ids)), sizes)
    seen, score, base = (np.bincount(run, w, len(ids)) for w in (c > 0, np.log10(lift / m["class_tokens"][cls]), np.log10(c + 1)))
    first = np.cumsum(sizes.astype(np.int64)) - sizes

    def sent() -> Iterator[tuple[int, bytes]]:
        for b, at in packing.split(common.doc_buckets(ids, p), p):
            items = slices(first[at], sizes[at])
            yield b, packing.pack(ids[at], sizes[at], seen[at].astype(np.uint32), score[at], base[at], place[items], cls[items].astype(np.uint8), raw=(3, 4))

    return repeats.as_table(sent())


def _assembled(group: pa.Table) -> pa.Table:
    """The texts of a bucket with the classes of all their tokens."""
    blobs = repeats.blobs_of(group)
    ids, tokens, seen, score, base, cls = packing.concat([b for b in blobs if b[0] == 6])
    cls, tokens = cls.copy(), tokens.astype(np.int64)
    start = np.cumsum(tokens) - tokens
    own, first, inverse, rows = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
    sums = [x[first].astype(float) for x in (seen, score, base)]
    if rest := [b for b in blobs if b[0] == 7]:
        who, sizes, *more, place, found = packing.concat(rest)
        at = np.searchsorted(own, who)
        cls[np.repeat(start[first][at], sizes) + place] = found
        # a row repeated as a whole has sent its words as often
        sums = [x + np.bincount(at, w, len(own)) / rows for x, w in zip(sums, more, strict=True)]
    seen, score, base = (x[inverse] for x in sums)
    data = cls[slices(start[first][inverse], tokens)]
    ends = np.concatenate(([0], np.cumsum(tokens))).astype(np.int32)
    classes = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    columns = [pa.array(ids), pa.array(tokens), pa.array(np.rint(seen).astype(np.int64)), pa.array(base), pa.array(score), classes]
    return pa.table(columns, names=["row_id", "n_tokens", "n_known", "base", "emission", "classes"])


def annotate(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, the sums ``base`` and ``emission`` and the classes of all tokens, a byte each. Computed now."""
    n, p = model.buckets, common.buckets(common.texts(docs))
    marked, keys = common.identified(common.texts(docs), "row_id")
    shared = docs.sparkSession.sparkContext.broadcast(model.shared())
    sent = marked.select("row_id", "text").mapInArrow(lambda x: repeats.rows(_annotate(x, shared, n, p)), repeats.BLOBS)
    found = sent.groupBy("bucket").cogroup(model.words.groupBy("bucket")).applyInArrow(lambda a, b: _looked_up(a, b, shared, n, p), repeats.BLOBS)
    out = found.groupBy("bucket").applyInArrow(_assembled, "row_id long, n_tokens long, n_known long, base double, emission double, classes binary")
    out = out.withColumnRenamed("row_id", "doc_id") if keys is None else out.join(keys, "row_id").drop("row_id")
    # the same as in held_out()
    held = (F.col("doc_id") != common.NO_ID) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "base", "emission", "classes").checkpoint()


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes before and of all tokens of some texts, and the texts. The end token's class 0 comes before a text."""
    data, offsets = column_bytes(column)
    own = data.astype(np.int64)
    before = np.concatenate(([0], own[:-1]))
    before[offsets[:-1]] = 0
    return before, own, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _transitions(batches: Iterable[pa.RecordBatch], classes: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(classes * classes, np.int64)
    for batch in batches:
        before, own, _ = _pairs(batch.column(0))
        total += np.bincount(before * classes + own, minlength=classes * classes)
    at = np.flatnonzero(total)
    yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["cell", "n"])


def with_transitions(model: Model, annotated: DataFrame) -> Model:
    """The model with the transitions of the annotated texts that aren't held out."""
    classes = len(model.class_tokens)
    cells = annotated.where("not held_out").select("classes").mapInArrow(lambda x: _transitions(x, classes), "cell long, n long")
    joint = np.zeros(classes * classes)
    # classes * classes rows at most
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        joint[r.cell] = r.n
    joint = joint.reshape(classes, classes)
    share = (joint.sum(0) + 1) / (joint.sum() + classes)
    return replace(model, transition=(joint + 20 * share) / (joint.sum(1, keepdims=True) + 20))


def _scored(batches: Iterable[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    tokens, types, transition = shared.value
    logs = np.log10(transition)
    for batch in batches:
        doc, held, n_tokens, n_known, base, emission, classes = batch.columns
        before, own, text = _pairs(classes)
        score = emission.to_numpy() + np.bincount(text, logs[before, own], batch.num_rows)
        base = base.to_numpy() - n_tokens.to_numpy() * np.log10(tokens + types + 1.0)
        columns = [doc, held, n_tokens, n_known, pa.array(np.full(batch.num_rows, tokens)), pa.array(base), pa.array(score)]
        yield pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def scored(annotated: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, the texts' log10 probabilities."""
    shared = annotated.sparkSession.sparkContext.broadcast((model.tokens, model.types, model.transition))
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return annotated.mapInArrow(lambda x: _scored(x, shared), schema).withColumn("doc_id", common.real_id())


def fit(docs: DataFrame, top: int = TOP, classes: int = CLASSES, sweeps: int = SWEEPS) -> Model:
    """Learns from the documents that aren't held out. Runs jobs over all of them."""
    model = learn(docs, top, classes, sweeps)
    return with_transitions(model, annotate(docs, model))


def score(docs: DataFrame, model: Model) -> DataFrame:
    return scored(annotate(docs, model), model)


def fit_score(docs: DataFrame, top: int = TOP, classes: int = CLASSES, sweeps: int = SWEEPS) -> DataFrame:
    """``fit`` and ``score`` of the same documents, which are annotated once."""
    model = learn(docs, top, classes, sweeps)
    annotated = annotate(docs, model)
    return scored(annotated, with_transitions(model, annotated))
