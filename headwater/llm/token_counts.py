"""Token counts by a two-tier lookup on the map side.

A chunk's runs between white space are coded by an exact dictionary, so each distinct one is
looked up once. The first tier is a broadcast table of the corpus's own frequent runs and their lengths,
compared as whole strings. What it lacks goes to the worker's cache, and what that lacks to the tokenizer. No run of the
corpus is shuffled. Which runs the table holds is taken from a sample of about ``SAMPLE_ROWS`` rows spread over the table, whatever its
size, and decides nothing but how often the second tier is asked.

White space never lies inside a token of the ``.json`` tokenizers and no rule looks across it, so counts of
the parts add up to that of the text. A ``.model`` may join white space to its tokens, so
there a whole text is looked up at once. A null text counts as empty; repeated rows get equal results.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import common, tokenizer_files
from headwater.llm.textarrays import Words, chunks

CHUNK = 4 << 20
#: Runs of the broadcast table, each of ``RUN_BYTES`` at most: 2 MB at the very most.
TABLE_WORDS, RUN_BYTES = 32_768, 64
#: Rows, about, that the table's choice is taken from.
SAMPLE_ROWS = 50_000
#: Runs of a task's summary, and those it holds before it leaves out the rarest.
SUMMARY, HELD = 32_768, 1_000_000


class Counter:
    """Lengths of runs, or of whole texts for a ``.model``, by the library that reads the file."""

    def __init__(self, file: str):
        place = tokenizer_files.path(file)
        self.whole = place.endswith(".model")
        if self.whole:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=place)
            self.many = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            own = Tokenizer.from_file(place)
            own.no_truncation()
            own.no_padding()
            self.many = lambda texts: [len(x) for x in own.encode_batch_fast(texts, add_special_tokens=False)]
        self.cache = tokenizer_files.Cache(None)


@lru_cache(maxsize=2)
def counter(file: str) -> Counter:
    return Counter(file)


def _runs(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray, pa.Array]:
    """The runs of a chunk, the place of each in the dictionary, and the dictionary."""
    words = Words(data, offsets)
    at, distinct = words.dictionary()
    used = np.zeros(len(distinct), bool)
    used[at] = True
    place = np.cumsum(used) - 1
    return words, place[at] if len(at) else at, distinct.filter(pa.array(used))


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most frequent runs of a task. Memory is bounded: rare runs are left out along the way, which only the table's choice can notice."""
    counts: dict[bytes, int] = {}
    for _, data, offsets in chunks(batches, CHUNK):
        _, at, distinct = _runs(data, offsets)
        n = np.bincount(at, minlength=len(distinct))
        some = np.flatnonzero((n > 1) & (pc.binary_length(distinct).to_numpy() <= RUN_BYTES))
        for w, k in zip(distinct.take(pa.array(some)).to_pylist(), n[some].tolist(), strict=True):
            counts[w] = counts.get(w, 0) + k
        if len(counts) > HELD:
            counts = dict(sorted(counts.items(), key=lambda x: -x[1])[: HELD // 4])
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:SUMMARY]
    yield pa.record_batch([pa.array([w for w, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], names=["run", "n"])


def frequent(docs: DataFrame, most: int) -> list[bytes]:
    """The most frequent runs of a sample: at most ``most`` strings of at most ``RUN_BYTES`` bytes."""
    rows = docs.count()
    some = docs if rows <= SAMPLE_ROWS else docs.sample(SAMPLE_ROWS / rows, seed=8)
    found = common.texts(some).mapInArrow(_summaries, "run binary, n long").groupBy("run").agg(F.sum("n").alias("n"))
    # the sample's runs are few; each part sends its first ones to the driver, so there are few parts as well
    return [bytes(r.run) for r in found.coalesce(4).orderBy(F.desc("n"), "run").limit(most).collect()]


def _lengths(own: Counter, distinct: pa.Array, table: tuple[pa.Array, np.ndarray]) -> np.ndarray:
    """The number of tokens of each run, by the table, the worker's cache or the tokenizer."""
    runs, lengths = table
    slot = pc.index_in(distinct, value_set=runs)
    known = slot.is_valid().to_numpy(zero_copy_only=False)
    size = np.zeros(len(distinct), np.int64)
    size[known] = lengths[slot.drop_null().to_numpy()]
    cache, old, new = own.cache, own.cache.old, []
    misses = np.flatnonzero(~known)
    for i, w in zip(misses.tolist(), distinct.take(pa.array(misses)).to_pylist(), strict=True):
        n = cache.get(w)
        if n is None:
            n = old.get(w)
            if n is None:
                new.append((i, w))
                continue
            cache.add(w, n)
        size[i] = n
    for (i, w), n in zip(new, own.many([w.decode() for _, w in new]), strict=True):
        size[i] = n
        cache.add(w, n)
    return size


def _count(batches: Iterable[pa.RecordBatch], file: str, shared) -> Iterator[pa.RecordBatch]:
    own = counter(file)
    runs, lengths = shared.value
    table = pa.array(runs, pa.binary()), np.array(lengths, np.int64)
    for ids, data, offsets in chunks(batches, CHUNK):
        if own.whole:
            raw = data.tobytes()
            total = np.array(own.many([raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]), np.int64)
        else:
            words, at, distinct = _runs(data, offsets)
            size = _lengths(own, distinct, table)
            sums = np.concatenate(([0], np.cumsum(size[at])))
            total = sums[words.first[1:]] - sums[words.first[:-1]]
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(total, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, file: str = "word_bpe_49k.json") -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row."""
    own = counter(file)
    runs = [] if own.whole else frequent(docs, TABLE_WORDS)
    table = docs.sparkSession.sparkContext.broadcast((runs, own.many([r.decode() for r in runs])))
    return common.texts(docs).mapInArrow(lambda x: _count(x, file, table), "doc_id long, n_bytes long, n_tokens long").withColumn("doc_id", common.real_id())
