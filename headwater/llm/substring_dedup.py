"""Removal of repeated word sequences by fixed-block anchors.

Every document is cut into blocks of ``window // 2`` words that don't overlap; those are the
index. All rolling windows of that many words probe it. A run of ``window`` words
holds a whole block wherever it starts, so an earlier occurrence shows as a probe that
hits a block. Hits are extended word by word to all windows of ``window`` words around them; of equal windows all but the
first go, and neighbouring ones make up the maximal repeats. Windows are told apart by two hashes of 128 bits together: at 10**14 windows
the chance that any two differing ones agree is under 10**-10.

Null texts have no words. A row repeated as a whole counts once and its copies get
the same result; other rows with a doc_id in common, or with none, are documents of their own, in the order of a hash of the text. Texts of fewer than ``window`` words keep everything.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

from headwater.llm import common, repeats
from headwater.llm.suffix_dedup import covered, removed_runs
from headwater.llm.textarrays import U64, Words, chunks, column_bytes, mix, runs, window_hash

CHUNK = 4 << 20
SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


def _within(words: Words, size: int) -> np.ndarray:
    """Places of the words at which ``size`` words of one document start."""
    if len(words) < size:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.doc[: len(words) - size + 1] == words.doc[size - 1 :])


def _screen(batches: Iterable[pa.RecordBatch], n: int, window: int) -> Iterator[tuple[int, bytes]]:
    """Rolling windows of half the size; the lowest bit of the place tells a block of the index."""
    block = max(1, window // 2)
    for ids, data, offsets in chunks(batches, common.chunk_bytes(n, CHUNK)):
        words = Words(data, offsets)
        at = _within(words, block)
        # only documents that have a whole window can lose words
        at = at[words.counts[words.doc[at]] >= window]
        if not len(at):
            continue
        h = mix(window_hash(words.hashes()[0], block)[at])
        doc = words.doc[at]
        place = at - words.first[doc]
        yield from repeats.send_entries((h % U64(n)).astype(np.int64), n, ids[doc], [(place * 2 + (place % block == 0)).astype(np.uint32), (h >> U64(32)).astype(np.uint32)], raw=(1,))


def _probe(blobs: list[bytes], n: int) -> Iterator[tuple[int, bytes]]:
    """Places whose hash occurs twice or more, at least once as a block of the index."""
    found = repeats.entries(blobs)
    if not found:
        return
    docs, place, hashes = found
    key = np.sort((hashes.astype(U64) << U64(32)) | np.arange(len(hashes), dtype=U64))
    at = (key & U64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (key[1:] ^ key[:-1]) >= U64(1 << 32))))
    size = np.diff(np.concatenate((first, [len(key)])))
    indexed = np.add.reduceat((place[at] & 1).astype(np.int64), first) > 0
    hit = np.sort(at[np.repeat(indexed & (size > 1), size)])
    yield from repeats.reported(docs[hit], place[hit] >> 1, n)


def _extend(own: pa.Table, found: repeats.Places, n: int, window: int) -> Iterator[tuple[int, bytes]]:
    block = max(1, window // 2)
    for ids, data, offsets in repeats.documents_of(own, CHUNK):
        words = Words(data, offsets)
        at = _within(words, window)
        if not len(at):
            continue
        hits = np.concatenate(([0], np.cumsum(found.mark(ids, words.first[:-1], len(words)))))
        at = at[hits[at + window - block + 1] > hits[at]]
        if not len(at):
            continue
        low, high = words.hashes()
        a, b = window_hash(low, window)[at], window_hash(high, window, 1)[at]
        doc = words.doc[at]
        yield from repeats.send_entries((mix(a) % U64(n)).astype(np.int64), n, ids[doc], [(at - words.first[doc]).astype(np.uint32), a, b], raw=(1, 2))


def _first_only(blobs: list[bytes], n: int) -> Iterator[tuple[int, bytes]]:
    found = repeats.entries(blobs)
    if not found:
        return
    docs, place, a, b = found
    order = np.lexsort((place, docs))
    docs, place, a, b = docs[order], place[order], a[order], b[order]
    order = np.lexsort((b, a))
    again = np.zeros(len(order), bool)
    again[1:] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
    later = np.sort(order[again])
    if len(later):
        docs, place = docs[later], place[later]
        yield from repeats.send_entries(common.doc_buckets(docs, n), n, docs, [place, np.ones(len(place), np.uint32)])


def _kept(own: pa.Table, blobs: list[bytes], window: int) -> Iterator[tuple[int, int, bytes]]:
    """For each row its words, how many go, and the others joined by spaces."""
    removed = removed_runs(blobs)
    data, offsets = column_bytes(own.column("text"))
    raw = data.tobytes()
    for i, d in enumerate(own.column("doc_id").to_pylist()):
        words = raw[int(offsets[i]) : int(offsets[i + 1])].split()
        n, kept = len(words), words
        if (mine := removed.get(d)) is not None:
            flags = covered(np.array([d]), np.array([0, n]), {d: mine}, window)
            kept = [w for w, gone in zip(words, flags.tolist(), strict=True) if not gone]
        yield n, n - len(kept), b" ".join(kept)


def _cut(own: pa.Table, blobs: list[bytes], window: int) -> pa.Table:
    n, gone, kept = zip(*_kept(own, blobs, window), strict=True) if own.num_rows else ((), (), ())
    columns = [own.column("own_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.table(columns, names=["doc_id", "n_words", "n_removed", "kept"])


def _cut_rows(own: pa.Table, blobs: list[bytes], window: int, chars: str | None) -> pa.Table:
    """The rows themselves, those that lose all their words left out. ``chars``: a column that tells the length of the text."""
    stay, texts, sizes = [], own.column("text").to_pylist(), own.column(chars).to_pylist() if chars else []
    for i, ((n, gone, kept), null) in enumerate(zip(_kept(own, blobs, window), own.column("no_text").to_pylist(), strict=True)):
        stay.append(gone == 0 or gone < n)
        if gone:
            texts[i] = kept.decode()
            if chars:
                sizes[i] = len(texts[i])
        elif null:
            texts[i] = None
    out = own.set_column(own.schema.get_field_index("text"), "text", pa.array(texts, own.schema.field("text").type))
    if chars:
        out = out.set_column(own.schema.get_field_index(chars), chars, pa.array(sizes, own.schema.field(chars).type))
    return out.filter(pa.array(stay, pa.bool_())).drop_columns(["doc_id", "own_id", "no_text", "bucket"])


def substring_dedup(docs: DataFrame, window: int = 20) -> DataFrame:
    """One row a document: its words, how many go as a run of ``window`` words covers them
    that also starts earlier, and ``kept``, the others joined by spaces."""
    found = _removed(repeats.marked(docs), common.buckets(common.texts(docs)), window, partial(_cut, window=window), SCHEMA)
    return found.withColumn("doc_id", common.real_id())


def cut_documents(docs: DataFrame, window: int = 20) -> DataFrame:
    """The rows of ``docs`` with the repeated words gone, and ``n_chars``, if there is one, counted anew.

    Rows that lose all their words go, untouched ones stay as they are, null texts too. The other columns, of any
    name and kind, travel with the texts through the one exchange, so nothing is joined back.
    """
    own, _ = common.identified(docs, "_row")
    name = {c: "text" if c == "text" else f"c{i}" for i, c in enumerate(docs.columns)}
    rest = [F.col(c).alias(name[c]) for c in docs.columns if c != "text"]
    sent = own.select(F.col("_row").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("_row").alias("own_id"), F.col("text").isNull().alias("no_text"), *rest)
    schema = StructType([StructField(name[f.name], f.dataType) for f in [docs.schema["text"], *(f for f in docs.schema if f.name != "text")]])
    chars = name.get("n_chars") if "n_chars" in name and isinstance(docs.schema["n_chars"].dataType, IntegralType) else None
    found = _removed(sent, common.buckets(common.texts(docs)), window, partial(_cut_rows, window=window, chars=chars), schema)
    return found.select(*[F.col(name[c]).alias(c) for c in docs.columns])


def _removed(own: DataFrame, n: int, window: int, cut: Callable, schema: str | StructType) -> DataFrame:
    return repeats.remove_repeats(own, n, partial(_screen, window=window), _probe, partial(_extend, window=window), _first_only, cut, schema)
