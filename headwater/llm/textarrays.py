"""Vectorised views of Arrow text columns: chunks, words, window hashes, winnowing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

U64 = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BYTES = np.frombuffer(b"".join(xxhash.xxh3_64_digest(bytes([i])) for i in range(256)), "<u8").astype(U64)
_MULTIPLIERS = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
#: Keep the lowest 0 to 8 bytes of a piece.
_MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)
_LONG = 64
_FINAL = U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = (x ^ (x >> U64(32)) ^ U64(seed)) * _FINAL
    x ^= x >> U64(29)
    x *= _MULTIPLIERS[0]
    return x ^ (x >> U64(32))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and its offsets from 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of runs of rows with at most ``limit`` bytes, or of one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        data, offsets = column_bytes(batch.column(1))
        i, n = 0, len(ids)
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
            yield ids[i:j], data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j


class Words:
    """Maximal runs of bytes other than ASCII white space, by document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, n, docs = data, len(data), len(offsets) - 1
        inside = ~_SEPARATOR[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | edge[:-1]))
        before[:] = False
        before[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~before | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=docs).astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def __len__(self) -> int:
        return len(self.starts)

    def dictionary(self) -> tuple[np.ndarray, pa.Array]:
        """For each word its place in an exact dictionary of byte strings (which may hold more entries)."""
        m = len(self.starts)
        if not m:
            return np.zeros(0, np.int64), pa.array([], pa.binary())
        offsets = np.empty(2 * m, np.int64)
        offsets[0::2], offsets[1::2] = self.starts, self.ends
        wide = len(self.data) >= 2**31
        kind = pa.large_binary() if wide else pa.binary()
        both = pa.Array.from_buffers(kind, 2 * m - 1, [None, pa.py_buffer(offsets if wide else offsets.astype(np.int32)), pa.py_buffer(self.data)])
        coded = both.dictionary_encode()
        return coded.indices.to_numpy()[::2], coded.dictionary

    def hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Two independent 64-bit hashes of each word, over its pieces of 8 bytes; words of over ``_LONG`` bytes are hashed one by one."""
        size = self.ends - self.starts
        low, high = mix(size.astype(U64), 1), mix(size.astype(U64), 2)
        pieces = np.ndarray(len(self.data) + 1, "<u8", np.concatenate((self.data, np.zeros(8, np.uint8))), strides=(1,))
        at = np.flatnonzero(size <= _LONG)
        for step in range(0, _LONG, 8):
            at = at[size[at] > step]
            if not len(at):
                break
            x = pieces[self.starts[at] + step] & _MASKS[np.minimum(size[at] - step, 8)]
            low[at], high[at] = mix(low[at] ^ x, 3), mix(high[at] * _MULTIPLIERS[1] + x, 4)
        for i in np.flatnonzero(size > _LONG).tolist():
            low[i], high[i] = np.frombuffer(xxhash.xxh3_128_digest(self.data[self.starts[i] : self.ends[i]].tobytes()), "<u8")
        return low, high


def byte_values(data: np.ndarray, seed: int = 0) -> np.ndarray:
    return (mix(_BYTES, seed) if seed else _BYTES)[data]


def window_hash(values: np.ndarray, n: int, kind: int = 0) -> np.ndarray:
    """A hash of each run of ``n`` values. Halves are joined by a mixing step, so that no algebraic identity of plain polynomials holds."""
    if len(values) < n:
        return np.zeros(0, U64)
    by = _MULTIPLIERS[kind]

    def join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = a * by
        out += b
        out ^= out >> U64(31)
        out *= _FINAL
        return out

    power, span, out, have = values, 1, None, 0
    while True:
        if n & span:
            if out is None:
                out, have = power, span
            else:
                size = len(values) - have - span + 1
                out = join(out[:size], power[have : have + size])
                have += span
        if have == n:
            return out
        size = len(values) - 2 * span + 1
        power = join(power[:size], power[span : span + size])
        span *= 2


def window_min(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of ``n`` values."""
    size = len(values) - n + 1
    if size <= 0:
        return values[:0]
    span = 1
    while 2 * span <= n:
        values = np.minimum(values[: len(values) - span], values[span:])
        span *= 2
    return np.minimum(values[:size], values[n - span : n - span + size])


def winnow(values: np.ndarray, window: int) -> np.ndarray:
    """For each run of ``window`` values the place of its least one, the leftmost of equal ones."""
    bits = U64(max(1, int(len(values)).bit_length()))
    low = (U64(1) << bits) - U64(1)
    return (window_min((values & ~low) | np.arange(len(values), dtype=U64), window) & low).astype(np.int64)


def slices(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The concatenated ranges [first, first + size)."""
    size = np.asarray(size, np.int64)
    total = int(size.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(np.asarray(first, np.int64) - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(total)


def runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of the runs of consecutive integers in a sorted array."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate(([True], np.diff(sorted_values) != 1)))
    return at, np.diff(np.concatenate((at, [len(sorted_values)])))
