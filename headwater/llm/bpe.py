"""Byte-level BPE: encoding by a queue of merge ranks over a doubly linked list of symbols, and decoding.

Text is cut at added tokens, then by the pre-tokenizer's pattern; each piece is
encoded on its own and kept in the worker's cache. A null text counts as empty and has no
tokens; repeated rows get equal results, and rows without a doc_id are rows like others. A byte sequence that isn't UTF-8 after decoding shows as U+FFFD, as in the library.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import common, tokenizer_files

#: The pre-tokenizer's pattern, a fixed value of the format.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text that a result batch comes from.
BATCH_BYTES = 4 << 20


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabularies: itself if it prints, else the next one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    def __init__(self, file: str):
        with open(tokenizer_files.path(file), encoding="utf-8") as f:
            told = json.load(f)
        vocab = told["model"]["vocab"]
        letters = byte_letters()
        self.single = [0] * 256
        for letter, b in letters.items():
            self.single[b] = vocab[letter]
        #: pair of ids, as one number -> rank and the id of the union, as one number
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(told["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocab[a] << 20 | vocab[b], rank << 20 | vocab[a + b])
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.strings: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.strings[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        for token, i in self.added.items():
            self.strings[i] = token.encode()
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.cache = tokenizer_files.Cache(self.piece)

    def piece(self, text: str) -> bytes:
        """The ids of one piece, as little-endian numbers of 32 bits."""
        symbols = [self.single[b] for b in text.encode()]
        n = len(symbols)
        merges = self.merges
        queue = []
        for i in range(n - 1):
            found = merges.get(symbols[i] << 20 | symbols[i + 1])
            if found is not None:
                queue.append((found >> 20, i, found))
        if not queue:
            return np.array(symbols, "<u4").tobytes()
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            _, i, found = heappop(queue)
            j = after[i]
            # stale: a neighbour was merged meanwhile, so this is another pair now
            if symbols[i] < 0 or j >= n or merges.get(symbols[i] << 20 | symbols[j]) != found:
                continue
            new = found & 0xFFFFF
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                more = merges.get(new << 20 | symbols[k])
                if more is not None:
                    heappush(queue, (more >> 20, i, more))
            k = before[i]
            if k >= 0:
                more = merges.get(symbols[k] << 20 | new)
                if more is not None:
                    heappush(queue, (more >> 20, k, more))
        return np.array([s for s in symbols if s >= 0], "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        get, split = self.cache.__getitem__, self.split
        if self.cut is None or not any(t in text for t in self.added):
            return b"".join(map(get, split(text)))
        parts = []
        for part in self.cut.split(text):
            if part in self.added:
                parts.append(np.array([self.added[part]], "<u4").tobytes())
            elif part:
                parts.append(b"".join(map(get, split(part))))
        return b"".join(parts)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load(file: str) -> BytePairs:
    return BytePairs(file)


def _batches(batches: Iterable[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column(1).nbytes / max(1, batch.num_rows)
        step = max(1, int(limit / max(1.0, sizes)))
        for i in range(0, batch.num_rows, step):
            yield batch.slice(i, step)


def _encode(batches: Iterable[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    pairs = load(file)
    for batch in _batches(batches):
        ids = [pairs.encode(t) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])


def _both(batches: Iterable[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    pairs = load(file)
    for batch in _batches(batches):
        ids = [pairs.encode(t) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array([pairs.decode(x) for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])


def _decode(batches: Iterable[pa.RecordBatch], file: str) -> Iterator[pa.RecordBatch]:
    pairs = load(file)
    for batch in _batches(batches):
        yield pa.record_batch([batch.column(0), pa.array([pairs.decode(x or b"") for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "decoded"])


def encode(docs: DataFrame, file: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and ids, little-endian numbers of 32 bits in one binary."""
    return common.texts(docs).mapInArrow(lambda x: _encode(x, file), "doc_id long, ids binary").withColumn("doc_id", common.real_id())


def decode(encoded: DataFrame, file: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id and decoded, from doc_id and ids."""
    return encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(lambda x: _decode(x, file), "doc_id long, decoded string")


def encode_decode(docs: DataFrame, file: str = "byte_bpe_50k.json") -> DataFrame:
    """doc_id, ids and decoded in one pass over the texts."""
    return common.texts(docs).mapInArrow(lambda x: _both(x, file), "doc_id long, ids binary, decoded string").withColumn("doc_id", common.real_id())
