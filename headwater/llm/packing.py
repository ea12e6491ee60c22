"""Blobs of integer arrays: a shuffle row for each chunk and bucket in place of one for each entry."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import zstandard

U64 = np.uint64


def pack(*arrays: np.ndarray, raw: tuple[int, ...] = ()) -> bytes:
    """``raw``: places of arrays that don't compress, such as hashes. The others are stored as differences."""
    out = [struct.pack("<B", len(arrays))]
    for i, a in enumerate(arrays):
        a = np.ascontiguousarray(a)
        if i in raw:
            body, kind = a.tobytes(), 0
        elif a.dtype.kind in "iu" and a.dtype.itemsize > 1:
            step = a.copy()
            step[1:] -= a[:-1]
            body, kind = zstandard.ZstdCompressor(level=1, write_content_size=True).compress(step.tobytes()), 1
        else:
            body, kind = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(a.tobytes()), 2
        out += [struct.pack("<B3sI", kind, a.dtype.str[:3].encode(), len(body)), body]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    out, at = [], 1
    for _ in range(blob[0]):
        kind, dtype, size = struct.unpack_from("<B3sI", blob, at)
        at += 8
        body = blob[at : at + size]
        at += size
        a = np.frombuffer(body if kind == 0 else zstandard.decompress(body), dtype.decode())
        out.append(np.cumsum(a, dtype=a.dtype) if kind == 1 else a)
    return out


def upper(values: np.ndarray, size: int = 7) -> bytes:
    """The upper ``size`` bytes of hashes of 64 bits."""
    return np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :].tobytes()


def from_upper(blob: bytes, size: int = 7) -> np.ndarray:
    wide = np.zeros((len(blob) // size, 8), np.uint8)
    wide[:, 8 - size :] = np.frombuffer(blob, np.uint8).reshape(-1, size)
    return wide.reshape(-1).view("<u8")


def concat(blobs: list[bytes]) -> list[np.ndarray]:
    """The arrays of many blobs of one layout, each kind joined."""
    parts = [unpack(b) for b in blobs]
    return [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else []


def split(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places of its entries in order) for each bucket that has some."""
    small = bucket.astype(np.uint16 if buckets <= 65536 else np.int64)
    order = np.argsort(small, kind="stable")
    sizes = np.bincount(small, minlength=buckets)
    ends = np.cumsum(sizes)
    for b in np.flatnonzero(sizes):
        yield int(b), order[ends[b] - sizes[b] : ends[b]]


def by_doc(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of the first entries, ids, counts) of runs of equal ids."""
    if not len(docs):
        return np.zeros(0, np.int64), docs, np.zeros(0, np.uint32)
    first = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
    return first, docs[first], np.diff(np.concatenate((first, [len(docs)]))).astype(np.uint32)
