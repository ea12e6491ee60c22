"""The plan shared by the two exact repeat removers.

1. Screen: each chunk of documents sends the hashes of its anchors to hash buckets;
   a bucket reports those that occur at more than one place.
2. Extend: documents meet the reports about them, and send what surrounds the
   repeated anchors to buckets again; a bucket decides which windows also start earlier.
3. Cut: documents meet the removed runs.

Rows of the exchanges are blobs for one chunk and one bucket. A frequent passage adds an
entry for each place to a bucket, never a pair of places. Documents are dealt by their
id, so copies and hot sources spread; steps 2 and 3 share one exchange of the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headwater.llm import common, packing
from headwater.llm.textarrays import chunks, column_bytes, slices

BLOBS = "bucket int, blob binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])


def rows(found: Iterable[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    """Blobs as record batches of a few MB."""
    keys, blobs, size = [], [], 0
    for key, blob in found:
        keys.append(key)
        blobs.append(blob)
        size += len(blob)
        if size > 4 << 20:
            yield pa.record_batch([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], schema=_SCHEMA)
            keys, blobs, size = [], [], 0
    if keys:
        yield pa.record_batch([pa.array(keys, pa.int32()), pa.array(blobs, pa.binary())], schema=_SCHEMA)


def as_table(found: Iterable[tuple[int, bytes]]) -> pa.Table:
    return pa.Table.from_batches(list(rows(found)), schema=_SCHEMA)


def blobs_of(group: pa.Table) -> list[bytes]:
    return group.column("blob").to_pylist()


def send_entries(bucket: np.ndarray, n: int, docs: np.ndarray, arrays: list[np.ndarray], raw: tuple[int, ...] = (), tag: int = 0) -> Iterator[tuple[int, bytes]]:
    """A blob for each bucket of entries, with document ids stored once a run. ``raw`` counts places in ``arrays``."""
    for b, at in packing.split(bucket, n):
        _, ids, counts = packing.by_doc(docs[at])
        yield b + tag, packing.pack(ids, counts, *(a[at] for a in arrays), raw=tuple(r + 2 for r in raw))


def entries(blobs: list[bytes]) -> list[np.ndarray]:
    """Documents and the other arrays of the entries that ``send_entries`` packed."""
    parts = packing.concat(blobs)
    return [np.repeat(parts[0], parts[1]), *parts[2:]] if parts else []


def reported(docs: np.ndarray, places: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
    """Places of documents, dealt to the buckets of the documents."""
    yield from send_entries(common.doc_buckets(docs, n), n, docs, [places.astype(np.uint32)])


class Places:
    """Reported places by document."""

    def __init__(self, blobs: list[bytes]):
        found = entries(blobs)
        docs, self.places = found[:2] if found else (np.zeros(0, np.int64), np.zeros(0, np.uint32))
        order = np.lexsort((self.places, docs))
        docs, self.places = docs[order], self.places[order].astype(np.int64)
        self.first, ids, self.counts = packing.by_doc(docs)
        self.at = {int(d): i for i, d in enumerate(ids)}

    def of(self, doc: int) -> np.ndarray:
        i = self.at.get(int(doc))
        return self.places[:0] if i is None else self.places[self.first[i] : self.first[i] + int(self.counts[i])]

    def mark(self, ids: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
        """Flags at first[doc] + place, over an array of ``size``, for the given documents."""
        out = np.zeros(size, bool)
        own = [(i, self.at[int(d)]) for i, d in enumerate(ids) if int(d) in self.at]
        if own:
            i, j = np.array(own).T
            sizes = self.counts[j].astype(np.int64)
            out[np.repeat(first[i], sizes) + self.places[slices(self.first[j], sizes)]] = True
        return out


def documents_of(group: pa.Table, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The documents of a bucket in the order of their ids, in chunks. Rows of one id have one text and count once."""
    ids = group.column("doc_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    group = group.select(["doc_id", "text"])
    start = 0
    sizes = np.diff(column_bytes(group.column("text"))[1])[order] if len(order) else np.zeros(0, np.int64)
    keep = np.concatenate(([True], ids[order][1:] != ids[order][:-1])) if len(order) else np.zeros(0, bool)
    order, sizes = order[keep], sizes[keep]
    total = np.cumsum(sizes)
    while start < len(order):
        end = max(start + 1, int(np.searchsorted(total, (total[start - 1] if start else 0) + limit, "right")))
        for batch in group.take(pa.array(order[start:end])).combine_chunks().to_batches():
            yield from chunks([batch], 2**62)
        start = end


def marked(docs: DataFrame) -> DataFrame:
    """The input of ``remove_repeats``: a doc_id of its own for each text of a doc_id, the text, and the doc_id to tell."""
    return common.identified(common.texts(docs), "row_id")[0].select(F.col("row_id").alias("doc_id"), "text", F.col("doc_id").alias("own_id"))


def remove_repeats(docs: DataFrame, n: int, screen: Callable, repeated: Callable, extend: Callable, first_only: Callable, cut: Callable, schema: str | StructType) -> DataFrame:
    """``docs``: doc_id, text, own_id and what else ``cut`` takes along; a text for each doc_id.

    The callables are the three steps' Python parts, each given the number ``n`` of buckets.
    """
    dealt = docs.withColumn("bucket", common.doc_bucket(n))
    anchors = docs.select("doc_id", "text").mapInArrow(lambda batches: rows(screen(batches, n)), BLOBS)
    hits = anchors.groupBy("bucket").applyInArrow(lambda group: as_table(repeated(blobs_of(group), n)), BLOBS)
    windows = dealt.groupBy("bucket").cogroup(hits.groupBy("bucket")).applyInArrow(lambda own, found: as_table(extend(own, Places(blobs_of(found)), n)), BLOBS)
    runs = windows.groupBy("bucket").applyInArrow(lambda group: as_table(first_only(blobs_of(group), n)), BLOBS)
    return dealt.groupBy("bucket").cogroup(runs.groupBy("bucket")).applyInArrow(lambda own, found: cut(own, blobs_of(found)), schema)


def repeated_hashes(blobs: list[bytes], n: int) -> Iterator[tuple[int, bytes]]:
    """Entries (document, place, hash of 32 bits) whose hash occurs twice or more, dealt to their documents."""
    found = entries(blobs)
    if not found:
        return
    docs, places, hashes = found
    key = np.sort((hashes.astype(np.uint64) << np.uint64(32)) | np.arange(len(hashes), dtype=np.uint64))
    top = key >> np.uint64(32)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = top[1:] == top[:-1]
    hit = np.sort((key & np.uint64(0xFFFFFFFF))[same[1:] | same[:-1]].astype(np.int64))
    yield from reported(docs[hit], places[hit], n)
