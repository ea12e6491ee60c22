"""Jaccard similarity join on word shingles by PartEnum signatures.

Sets of a size band and the next share an instance of the scheme, whose Hamming bound k
follows from the band's largest size. The hashed feature domain is cut into m parts,
each of three sub-parts, m over k // 2 by some slack: of the parts of two similar sets at
least m - k // 2 differ in one feature at most, so two of the three sub-parts agree. Each
of the three pairs of sub-parts of each part gives a signature. Signatures that
cover fewer than two features are left out by a document as long as fewer parts have one than the
slack has to spare; equal signatures get the same verdict, so a similar pair always keeps one in common.

Documents with equal sets form a class and take part once. A first pass counts for
each class its shingles that any other class has too: with fewer than 80 in 100 of them it has no similar class, so
documents that only share passages are done. For the rest, a
bucket of signatures links each document of a signature to the smallest; connected ones are candidate groups.
Their sets, as 56-bit hashes of shingles, are compared in whole in the group: documents outside the largest
component found so far are counted against the whole group through an inverted index, so a group
of copies costs a pass for each straggler and no pair is written. Groups over
``GROUP`` shingles are dealt out as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import common, packing, repeats
from headwater.llm.textarrays import U64, Words, chunks, mix, slices, window_hash

CHUNK = 2 << 20
#: Shingles compared in one task.
GROUP = 4_000_000
#: Rows of one number that may be broadcast, counted before; beyond, the join shuffles.
BROADCAST_ROWS = 2_000_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bands(largest: int) -> np.ndarray:
    """Largest sizes of the bands: sets with a similarity of 0.8 lie in one band or in neighbours."""
    out = [0, 1]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return np.array(out)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes by document, and their counts. A text of fewer words than ``n`` is one shingle."""
    docs = len(offsets) - 1
    words = Words(_LOWER[data], offsets)
    if not len(words):
        return np.zeros(0, U64), np.zeros(docs, np.int64)
    low, high = words.hashes()
    owners, hashes = [], []
    if len(words) >= n:
        at = np.flatnonzero(words.doc[: len(words) - n + 1] == words.doc[n - 1 :])
        owners.append(words.doc[at])
        hashes.append(mix(window_hash(low, n)[at] ^ (window_hash(high, n, 1)[at] << U64(1))))
    for size in range(1, n):
        own = np.flatnonzero(words.counts == size)
        if len(own):
            owners.append(own)
            hashes.append(mix(window_hash(low, size)[words.first[own]] ^ (window_hash(high, size, 1)[words.first[own]] << U64(1)), size))
    doc, h = np.concatenate(owners), np.concatenate(hashes)
    # by hash, then by document; the second sort keeps the order and is linear for few documents
    order = np.argsort(h)
    order = order[np.argsort(doc[order].astype(np.uint16 if docs <= 65536 else np.int64), kind="stable")]
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[new], np.bincount(doc[new], minlength=docs)


def _classes(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for an empty one."""
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(sets, 11))))
    ends = np.cumsum(counts)
    total = sums[ends] - sums[ends - counts]
    return np.where(counts > 0, mix(total, 3) ^ counts.astype(U64), U64(0)).view(np.int64)


def _class_rows(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for ids, data, offsets in chunks(batches, CHUNK):
        sets, counts = shingles(data, offsets, n)
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(_classes(sets, counts), pa.int64())], names=["doc_id", "n_shingles", "class"])


def signatures(sets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of documents and their signatures, in order of documents, and how many at least a document shares with each similar one."""
    docs = len(counts)
    upper = bands(int(counts.max()) if docs else 0)
    upper = np.append(upper, max(upper[-1] + 1, upper[-1] * 5 // 4))
    band = np.searchsorted(upper, counts)
    owner = np.repeat(np.arange(docs), counts)
    found, need = [], np.full(docs, np.iinfo(np.int64).max)
    for step in (0, 1):
        instance = band + step
        spare = (bound := upper[instance] * 2 // 9) // 8
        m = np.where(counts > 0, bound // 2 + 1 + spare, 0)
        first = np.concatenate(([0], np.cumsum(3 * m)))
        h = mix(sets, 17)
        # fixed-point scaling of the upper 32 bits to the document's number of sub-parts
        slot = first[owner] + ((h >> U64(32)) * (3 * m)[owner].astype(U64) >> U64(32)).astype(np.int64)
        total = np.zeros(first[-1], U64)
        np.add.at(total, slot, mix(sets, 23))
        size = np.bincount(slot, minlength=first[-1])
        part = total.reshape(-1, 3)
        filled = size.reshape(-1, 3)
        doc = np.repeat(np.arange(docs), m)
        within = (np.arange(len(doc)) - np.repeat(first[:-1] // 3, m)).astype(U64)
        label = mix((instance[doc].astype(U64) << U64(40)) | within)
        weak = np.stack([filled[:, a] + filled[:, b] < 2 for a, b in ((0, 1), (0, 2), (1, 2))])
        parts_weak = np.bincount(doc[weak.any(0)], minlength=docs)
        # m - bound // 2 parts agree; one of them must be left
        light = parts_weak < m - bound // 2
        need = np.minimum(need, m - bound // 2 - np.where(light, parts_weak, 0))
        drop = light[doc]
        for i, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
            keep = ~(weak[i] & drop)
            h = mix((part[:, a] ^ (part[:, b] * U64(0x9E3779B97F4A7C15))) + label, 29 + i)
            found.append((doc[keep], h[keep]))
    doc, h = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(doc, kind="stable")
    return doc[order], h[order], need


def _send(batches: Iterable[pa.RecordBatch], n: int, size: int, percent: int) -> Iterator[tuple[int, bytes]]:
    """The shingles of each class of a chunk, and how many of them it must share to have a similar class."""
    for _, data, offsets in chunks(batches, common.chunk_bytes(n, CHUNK)):
        sets, counts = shingles(data, offsets, size)
        if not len(sets):
            continue
        classes = _classes(sets, counts)
        _, once = np.unique(classes, return_index=True)
        one = np.zeros(len(counts), bool)
        one[once] = True
        sets, classes, counts = sets[np.repeat(one, counts)], classes[one], counts[one]
        doc, h = np.repeat(np.arange(len(counts)), counts), mix(sets, 31)
        need = -(-counts * percent // 100)
        for b, at in packing.split((h % U64(n)).astype(np.int64), n):
            first, ids, sizes = packing.by_doc(classes[doc[at]])
            yield b, packing.pack(ids, sizes, need[doc[at][first]].astype(np.uint32), (h[at] >> U64(32)).astype(np.uint32), raw=(0, 3))


def _groups(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of signatures, sorted by signature and without repeats, with first places and sizes of the groups."""
    key = h.astype(U64)
    key <<= U64(32)
    key |= at.astype(np.uint32)
    key.sort()
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    first = np.flatnonzero(np.concatenate(([True], (key[1:] ^ key[:-1]) >= U64(1 << 32)))) if len(key) else np.zeros(0, np.int64)
    return (key & U64(0xFFFFFFFF)).astype(np.int32), first, np.diff(np.append(first, len(key)))


def _matched(group: pa.Table, n: int) -> pa.Table:
    """How many shingles of each class another class has too."""
    ids, sizes, need, h = packing.concat(repeats.blobs_of(group))
    classes, inverse = np.unique(ids, return_inverse=True)
    least = np.zeros(len(classes), np.uint32)
    least[inverse] = need
    at, _, size = _groups(h, np.repeat(inverse, sizes))
    shared = np.bincount(at[np.repeat(size > 1, size)], minlength=len(classes))
    some = shared > 0
    classes, least, shared = classes[some], least[some], shared[some].astype(np.uint32)
    return repeats.as_table((b, packing.pack(classes[k], least[k], shared[k], raw=(0,))) for b, k in packing.split(common.doc_buckets(classes, n), n))


def _active(group: pa.Table) -> pa.Table:
    classes, need, shared = packing.concat(repeats.blobs_of(group))
    ids, first, inverse = np.unique(classes, return_index=True, return_inverse=True)
    return pa.table([pa.array(ids[np.bincount(inverse, shared) >= need[first]], pa.int64())], names=["class"])


def _send_active(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[tuple[int, bytes]]:
    """Signatures of documents whose sets are at hand."""
    for batch in batches:
        for i in range(0, batch.num_rows, 512):
            part = batch.slice(i, 512)
            sets = [packing.from_upper(x) for x in part.column(1).to_pylist()]
            doc, h, _ = signatures(np.concatenate(sets), np.array([len(x) for x in sets]))
            yield from repeats.send_entries((h % U64(n)).astype(np.int64), n, part.column(0).to_numpy()[doc], [(h >> U64(32)).astype(np.uint32)], raw=(0,))


def _star(group: pa.Table) -> pa.Table:
    """Distinct edges from the least document of each signature to its others."""
    found = repeats.entries(repeats.blobs_of(group))
    u = v = np.zeros(0, np.int64)
    if found:
        ids, at = np.unique(found[0], return_inverse=True)
        at, first, size = _groups(found[1], at)
        lead = np.repeat(at[first], size)
        pair = np.unique((lead[lead != at].astype(U64) << U64(32)) | at[lead != at].astype(U64))
        u, v = ids[(pair & U64(0xFFFFFFFF)).astype(np.int64)], ids[(pair >> U64(32)).astype(np.int64)]
    return pa.table([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def linked(ids: np.ndarray, counts: np.ndarray, sets: np.ndarray, percent: int) -> np.ndarray:
    """For each document the place of the first one it is connected with, by links of this similarity."""
    m = len(ids)
    # 32-bit places, as a group is bounded; what isn't needed any more goes at once
    order = np.argsort(sets).astype(np.int32)
    new = np.ones(len(sets), bool)
    new[1:] = sets[order[1:]] != sets[order[:-1]]
    start = np.flatnonzero(new)
    df = np.diff(np.append(start, len(sets)))
    sid = np.empty(len(sets), np.int32)
    sid[order] = np.cumsum(new, dtype=np.int32) - 1
    listed = np.repeat(np.arange(m, dtype=np.int32), counts)[order]
    del order, new
    first = np.concatenate(([0], np.cumsum(counts)))
    comp, todo = np.arange(m), np.ones(m, bool)
    while True:
        waiting = np.bincount(comp[todo], minlength=m)
        some = np.flatnonzero(waiting)
        if len(some) <= 1:
            return comp
        p = int(np.flatnonzero(todo & (comp == some[np.argmin(waiting[some])]))[0])
        todo[p] = False
        mine = sid[first[p] : first[p + 1]]
        mine = mine[df[mine] > 1]
        both = np.bincount(listed[slices(start[mine], df[mine])], minlength=m)
        near = (100 + percent) * both >= percent * (counts + counts[p])
        near[p] = True
        joined = np.unique(comp[near])
        comp[np.isin(comp, joined)] = joined[0]


def _verify(group: pa.Table, percent: int) -> pa.Table:
    out_u, out_v = [], []
    task = group.column("task").to_numpy()
    ids = group.column("doc_id").to_numpy()
    order = np.lexsort((ids, task))
    blobs = group.column("shingles")
    first, _, sizes = packing.by_doc(task[order])
    for f, s in zip(first.tolist(), sizes.tolist(), strict=True):
        own = order[f : f + s]
        sets = [packing.from_upper(blobs[int(i)].as_py()) for i in own]
        comp = linked(ids[own], np.array([len(x) for x in sets]), np.concatenate(sets), percent)
        far = comp != np.arange(len(own))
        out_u.append(ids[own][far])
        out_v.append(ids[own][comp[far]])
    join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return pa.table([pa.array(join(out_u), pa.int64()), pa.array(join(out_v), pa.int64())], names=["u", "v"])


def _set_rows(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for ids, data, offsets in chunks(batches, CHUNK):
        sets, counts = shingles(data, offsets, n)
        ends = np.cumsum(counts)
        blobs = [packing.upper(sets[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist(), strict=True)]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "shingles"])


def ngram_jaccard_join(docs: DataFrame, percent: int = 80, n: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id, the least doc_id that links lead to.

    Null and empty texts, and those of white space only, have an empty set and no
    link. Rows with a null doc_id are kept and compared like others; rows that share a doc_id, or have none, are linked
    by their texts alone. Only 80 percent or more is supported.
    """
    own, keys = common.identified(common.texts(docs), "row_id")
    found = linked_rows(own.select(F.col("row_id").alias("doc_id"), "text"), common.buckets(common.texts(docs)), percent, n)
    if keys is not None:
        least = keys.select(F.col("row_id").alias("component_id"), F.col("doc_id").alias("least_id"))
        found = found.join(keys.withColumnRenamed("doc_id", "own_id"), F.col("doc_id") == F.col("row_id")).join(least, "component_id")
        found = found.select(F.col("own_id").alias("doc_id"), "n_shingles", F.col("least_id").alias("component_id"))
    return found.select(common.real_id(), "n_shingles", common.real_id("component_id"))


def linked_rows(own: DataFrame, b: int, percent: int = 80, n: int = 5) -> DataFrame:
    """The same for doc_id and text without nulls, where each doc_id has one text, over ``b`` buckets."""
    if percent < 80:
        raise ValueError("the size bands and the Hamming bound are made for a similarity of 0.8 or more")
    common.shared_folder(own.sparkSession)
    classes = own.mapInArrow(partial(_class_rows, n=n), "doc_id long, n_shingles long, class long").checkpoint()
    firsts = classes.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    sent = own.mapInArrow(lambda batches: repeats.rows(_send(batches, b, n, percent)), repeats.BLOBS)
    shared = sent.groupBy("bucket").applyInArrow(lambda group: _matched(group, b), repeats.BLOBS)
    active = firsts.join(shared.groupBy("bucket").applyInArrow(_active, "class long"), "class").select("doc_id").distinct().checkpoint()
    active = F.broadcast(active) if active.count() <= BROADCAST_ROWS else active
    sets = own.join(active, "doc_id").select("doc_id", "text").mapInArrow(partial(_set_rows, n=n), "doc_id long, shingles binary").checkpoint()
    # sets take more memory than the texts they come from; the screen keeps to fewer buckets, as each document is named in all of them
    many = 2 * b + 1
    again = sets.mapInArrow(lambda batches: repeats.rows(_send_active(batches, many)), repeats.BLOBS)
    candidates = common.components(again.groupBy("bucket").applyInArrow(_star, "u long, v long"))
    members = candidates.withColumnRenamed("node", "doc_id").join(classes.select("doc_id", "n_shingles").distinct(), "doc_id")
    totals = members.groupBy("label").agg(F.ceil(F.sum("n_shingles") / GROUP).cast("int").alias("parts"))
    members = members.join(totals, "label").select("doc_id", "label", "parts")
    sets = sets.join(members, "doc_id")
    block = F.pmod(F.xxhash64("doc_id"), "parts")
    tasks = sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)))
    tasks = tasks.withColumn("task", F.xxhash64("label", F.least("block", "other"), F.greatest("block", "other")))
    tasks = tasks.withColumn("bucket", F.when(F.col("parts") > 1, F.col("task")).otherwise(F.pmod(F.col("task"), F.lit(many))))
    links = tasks.select("bucket", "task", "doc_id", "shingles").groupBy("bucket").applyInArrow(lambda group: _verify(group, percent), "u long, v long")
    groups = common.components(links).withColumnRenamed("node", "first_id")
    kept = firsts.select("class", F.col("doc_id").alias("first_id"))
    grouped = kept.join(groups, "first_id", "left").select("class", F.coalesce("label", "first_id").alias("component_id"))
    found = classes.withColumn("class", F.when(F.col("n_shingles") > 0, F.col("class"))).join(grouped, "class", "left")
    return found.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
