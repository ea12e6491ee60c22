"""Removal of repeated strings by a logarithmic family of suffix arrays.

Suffixes are sampled for the search: those at positions that hold the least hash of
their neighbourhood, so that two equal strings of ``length`` bytes have a sampled suffix
at the same place. The surroundings of sampled suffixes whose head occurs twice go to
buckets by the hash of the head. There, batches of documents arrive in order of
doc_id. Each batch gets an array of its suffixes, ordered by their leading bytes and then
by a fingerprint of their first ``length`` bytes, which brings equal prefixes together.
It is merge-scanned against the levels that exist; what matches starts earlier there and is
removed, the rest becomes a level, and levels of equal size merge, so a bucket holds a
logarithmic number of them.

Null texts count as empty. A row repeated as a whole counts once and its copies get the
same result; other rows with a doc_id in common, or with none, are documents of their own, in the order of a hash of the text. Texts shorter than ``length`` keep everything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from headwater.llm import common, packing, repeats
from headwater.llm.textarrays import U64, byte_values, chunks, column_bytes, mix, runs, slices, window_hash, winnow

#: Bytes hashed at a time, and the head of a sampled suffix.
CHUNK, HEAD = 1 << 20, 32
#: Windows that one batch of the family holds.
BATCH = 1 << 18
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


class SuffixFamily:
    """Suffix arrays of doubling sizes. Entries are (order key, fingerprint); equal pairs stand for equal strings."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """Adds a batch in text order; returns the flags of entries that occur earlier, in a level or the batch."""
        order = np.lexsort((prints, keys))
        k, p = keys[order], prints[order]
        again = np.zeros(len(k), bool)
        again[1:] = (k[1:] == k[:-1]) & (p[1:] == p[:-1])
        heads = np.flatnonzero(~again)
        known = np.zeros(len(heads), bool)
        for level_keys, level_prints in self.levels:
            known |= _merge_scan(k[heads], p[heads], level_keys, level_prints)
        group = np.cumsum(~again) - 1
        flags = np.empty(len(k), bool)
        flags[order] = again | known[group]
        self._push(k[heads][~known], p[heads][~known])
        return flags

    def _push(self, keys: np.ndarray, prints: np.ndarray) -> None:
        if not len(keys):
            return
        while self.levels and len(self.levels[-1][0]) < 2 * len(keys):
            other_keys, other_prints = self.levels.pop()
            keys, prints = np.concatenate((other_keys, keys)), np.concatenate((other_prints, prints))
            order = np.argsort(keys, kind="stable")
            keys, prints = keys[order], prints[order]
        self.levels.append((keys, prints))


def _merge_scan(keys: np.ndarray, prints: np.ndarray, level_keys: np.ndarray, level_prints: np.ndarray) -> np.ndarray:
    """Which sorted entries occur in a sorted level."""
    found = np.zeros(len(keys), bool)
    at = np.searchsorted(level_keys, keys)
    open_ = np.arange(len(keys))
    while len(open_):
        here = at[open_]
        inside = here < len(level_keys)
        open_, here = open_[inside], here[inside]
        same = level_keys[here] == keys[open_]
        open_, here = open_[same], here[same]
        equal = level_prints[here] == prints[open_]
        found[open_[equal]] = True
        open_ = open_[~equal]
        at[open_] += 1
    return found


def _samples(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all windows that lie in one document, their sampled suffixes, the documents and the hashes of heads."""
    head = min(HEAD, max(1, length // 2))
    heads = window_hash(byte_values(data), head)
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), heads
    anchors = winnow(heads, length - head + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    fits = np.flatnonzero(doc[: len(anchors)] == doc[length - 1 :])
    return fits, anchors[fits], doc[fits], heads


def _screen(batches: Iterable[pa.RecordBatch], n: int, length: int) -> Iterator[tuple[int, bytes]]:
    for ids, data, offsets in chunks(batches, common.chunk_bytes(n, CHUNK)):
        _, anchors, doc, heads = _samples(data, offsets, length)
        if not len(anchors):
            continue
        new = np.concatenate(([True], anchors[1:] != anchors[:-1]))
        anchors, doc = anchors[new], doc[new]
        h = mix(heads[anchors])
        yield from repeats.send_entries((h % U64(n)).astype(np.int64), n, ids[doc], [(anchors - offsets[doc]).astype(np.uint32), (h >> U64(32)).astype(np.uint32)], raw=(1,))


def _extend(own: pa.Table, found: repeats.Places, n: int, length: int) -> Iterator[tuple[int, bytes]]:
    """The surroundings of repeated samples; a piece that this bucket of documents has had is removed here at once."""
    seen: dict[bytes, None] = {}
    for ids, data, offsets in repeats.documents_of(own, CHUNK):
        starts, anchors, doc, heads = _samples(data, offsets, length)
        if not len(starts):
            continue
        hit = found.mark(ids, offsets[:-1], len(data))[anchors]
        starts, anchors, doc = starts[hit], anchors[hit], doc[hit]
        if not len(starts):
            continue
        first = np.flatnonzero(np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1))))
        size = np.diff(np.concatenate((first, [len(starts)])))
        starts, anchors, doc = starts[first], anchors[first], doc[first]
        text = data.tobytes()
        again = np.zeros(len(starts), bool)
        for i, (s, w, a) in enumerate(zip(starts.tolist(), size.tolist(), anchors.tolist(), strict=True)):
            piece = hashlib.blake2b(text[s : s + w + length - 1], digest_size=16, salt=(a - s).to_bytes(8, "little")).digest()
            again[i] = piece in seen
            seen[piece] = None
        place = starts - offsets[doc]
        if again.any():
            d = ids[doc[again]]
            yield from repeats.send_entries(common.doc_buckets(d, n), n, d, [place[again].astype(np.uint32), size[again].astype(np.uint32)], tag=n)
        keep = ~again
        starts, anchors, doc, size, place = starts[keep], anchors[keep], doc[keep], size[keep], place[keep]
        bucket = (mix(heads[anchors], 1) % U64(n)).astype(np.int64)
        for b, at in packing.split(bucket, n):
            _, docs, counts = packing.by_doc(ids[doc[at]])
            yield b, packing.pack(docs, counts, place[at].astype(np.uint32), size[at].astype(np.uint32), data[slices(starts[at], size[at] + length - 1)])


def _first_only(blobs: list[bytes], n: int, length: int) -> Iterator[tuple[int, bytes]]:
    """Runs of windows that also start earlier. Blobs of decided runs, which have no text, pass on."""
    parts = [b for b in blobs if b[0] == 5]
    yield from ((-1, b) for b in blobs if b[0] == 4)
    if not parts:
        return
    docs, place, size, data = repeats.entries(parts)
    size = size.astype(np.int64)
    ends = np.cumsum(size + length - 1)
    order = np.lexsort((place, docs))
    family, i = SuffixFamily(), 0
    out: list[tuple[np.ndarray, np.ndarray]] = []
    total = np.cumsum(size[order])
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + BATCH, "right")))
        own = order[i:j]
        i = j
        lengths = size[own] + length - 1
        part = data[slices(ends[own] - lengths, lengths)]
        windows = slices(np.concatenate(([0], np.cumsum(lengths)[:-1])), size[own])
        lead = part[:-3].astype(U64) << U64(24) | part[1:-2].astype(U64) << U64(16) | part[2:-1].astype(U64) << U64(8) | part[3:].astype(U64)
        keys = (lead[windows] << U64(32)) | (window_hash(byte_values(part), length)[windows] >> U64(32))
        removed = np.flatnonzero(family.add(keys, window_hash(byte_values(part, 7), length, 1)[windows]))
        if len(removed):
            entry = np.searchsorted(np.cumsum(size[own]), removed, "right")
            within = removed - (np.cumsum(size[own]) - size[own])[entry]
            # runs within one entry only: a step over to another entry breaks them
            first, count = runs(removed + entry)
            out.append((own[entry[first]], np.stack((place[own[entry[first]]] + within[first], count))))
    if out:
        at = np.concatenate([x for x, _ in out])
        start, count = np.concatenate([y for _, y in out], 1)
        yield from repeats.send_entries(common.doc_buckets(docs[at], n), n, docs[at], [start.astype(np.uint32), count.astype(np.uint32)])


def _decided(blobs: list[bytes], n: int, length: int) -> Iterator[tuple[int, bytes]]:
    for bucket, blob in _first_only(blobs, n, length):
        if bucket >= 0:
            yield bucket, blob
        else:
            parts = repeats.entries([blob])
            yield int(common.doc_buckets(parts[0][:1], n)[0]), blob


def covered(ids: np.ndarray, offsets: np.ndarray, removed: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Flags of the items of a chunk that lie in removed windows of ``length`` items."""
    step = np.zeros(int(offsets[-1]) + 1, np.int32)
    for i, d in enumerate(ids.tolist()):
        if (own := removed.get(d)) is not None:
            np.add.at(step, offsets[i] + own[0], 1)
            np.add.at(step, offsets[i] + own[0] + own[1] + length - 1, -1)
    return np.cumsum(step[:-1]) > 0


def removed_runs(blobs: list[bytes]) -> dict[int, np.ndarray]:
    """First places and counts of the removed windows, by document."""
    found = repeats.entries(blobs)
    if not found:
        return {}
    docs, start, count = found
    order = np.argsort(docs, kind="stable")
    docs, both = docs[order], np.stack((start[order], count[order])).astype(np.int64)
    first, ids, sizes = packing.by_doc(docs)
    return {int(d): both[:, f : f + int(s)] for d, f, s in zip(ids, first, sizes, strict=True)}


def _cut(own: pa.Table, blobs: list[bytes], length: int) -> pa.Table:
    removed = removed_runs(blobs)
    ids, told = own.column("doc_id").to_pylist(), own.column("own_id").to_pylist()
    data, offsets = column_bytes(own.column("text"))
    raw = data.tobytes()
    out = []
    for i, d in enumerate(ids):
        a, b = int(offsets[i]), int(offsets[i + 1])
        kept, gone, spans = raw[a:b], 0, 0
        if (mine := removed.get(d)) is not None:
            flags = covered(np.array([d]), np.array([0, b - a]), {d: mine}, length)
            gone, spans = int(flags.sum()), int((flags & ~np.concatenate(([False], flags[:-1]))).sum())
            kept = data[a:b][~flags].tobytes()
        out.append([told[i], b - a, gone, spans, kept])
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*out, strict=True)) or [()] * len(names)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """One row a document: its size, what is removed, and the bytes kept once each byte is gone that a
    string of ``length`` bytes covers which also starts earlier (at a smaller doc_id, or earlier in the document).

    ``kept`` is binary, as a cut may fall inside a character.
    """
    found = repeats.remove_repeats(
        repeats.marked(docs), common.buckets(common.texts(docs)), partial(_screen, length=length), repeats.repeated_hashes, partial(_extend, length=length), partial(_decided, length=length), partial(_cut, length=length), SCHEMA
    )
    return found.withColumn("doc_id", common.real_id())
