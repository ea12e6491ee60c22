"""Stretches of consecutive words that repeat with a period, found by probing a grid of places for each period.

A stretch of period p with at least 2p words has a grid point jp such that the words at jp and at (j+1)p are both
inside it, so these n / p pairs of each period are all that has to be compared: n log n probes for a text of n words. Probes
that hold are extended to both sides by comparing arrays piece by piece, first a few words for all of them at once, then
in pieces that double. Grid points inside a run found earlier are passed over where they could only find that run again: both
words in the run, the period a multiple of the run's, and the run at least as long as both periods together, as then
every word that continues the one period continues the other.

Periods are taken in ranges that double, all documents of a chunk together; no multiple of a period is in the
same range. A text is handled in whole by one task, and no text needs another one: there is no shuffle.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import common
from headwater.llm.textarrays import Words, chunks, slices

CHUNK = 4 << 20
#: Probes compared at a time, and words to each side that are compared before an extension in pieces.
BLOCK, NEAR = 1 << 20, 16
#: Words of the first piece of an extension, and the most words that the pieces of one step have together.
PIECE, STEP = 64, 1 << 22
SCHEMA = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, collapsed binary"


class _Runs:
    """The runs of the documents whose words, as codes, stand one after another. ``first`` are the places of their first words and of the end."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, least: int):
        self.codes, self.first, self.least = codes, first, least
        self.sizes = np.diff(first)
        self.found: dict[tuple[int, int, int], int] = {}
        #: For each word the longest run found around it, as its row in ``runs`` (start, length, period).
        self.of = np.full(len(codes), -1, np.int64)
        self.runs = np.zeros((64, 3), np.int64)
        low, most = 1, int(self.sizes.max(initial=0)) // 2
        while low <= most:
            docs = np.flatnonzero(self.sizes // 2 >= low)
            count = np.minimum(2 * low - 1, self.sizes[docs] // 2) - low + 1
            self._periods(np.repeat(docs, count), slices(np.full(len(docs), low), count))
            low *= 2

    def _periods(self, doc: np.ndarray, period: np.ndarray) -> None:
        """Probes every grid point of each pair of a document and a period."""
        size = (self.sizes[doc] - 1) // period
        ends = np.cumsum(size)
        at = 0
        while at < len(doc):
            # a pair of more than BLOCK points is a block of its own
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK, "right")))
            pair = np.repeat(np.arange(at, to), size[at:to])
            j = slices(np.zeros(to - at, np.int64), size[at:to])
            place = self.first[doc[pair]] + j * period[pair]
            hit = np.flatnonzero(self.codes[place] == self.codes[place + period[pair]])
            self._extend(place[hit], period[pair[hit]], doc[pair[hit]], pair[hit])
            at = to

    def _extend(self, place: np.ndarray, period: np.ndarray, doc: np.ndarray, pair: np.ndarray) -> None:
        alive = ~self._known(place, period)
        place, period, doc, pair = place[alive], period[alive], doc[alive], pair[alive]
        need = np.maximum(period, self.least - period)
        lowest, highest = self.first[doc], self.first[doc + 1] - period
        left, right = self._near(place, period, lowest, -1), self._near(place, period, highest, 1)
        alive = (left == NEAR) | (right == NEAR) | (left + right + 1 >= need)
        place, period, doc, pair, need, lowest, highest = (x[alive] for x in (place, period, doc, pair, need, lowest, highest))
        while len(place):
            # the leftmost point of each pair, whose stretch holds all others before its end
            lead = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
            end = self._far(place[lead], period[lead], highest[lead], 1)
            start = self._far(place[lead], period[lead], lowest[lead], -1)
            good = end - start >= need[lead]
            for s, e, p, d in zip(start[good].tolist(), end[good].tolist(), period[lead][good].tolist(), doc[lead][good].tolist(), strict=True):
                self._add(s, e - s + p, p, d)
            upto = np.repeat(end, np.diff(np.concatenate((lead, [len(place)]))))
            alive = place >= upto
            place, period, doc, pair, need, lowest, highest = (x[alive] for x in (place, period, doc, pair, need, lowest, highest))

    def _known(self, place: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Points that can only lead to the run around them."""
        run = self.of[place]
        start, length, own = self.runs[run].T
        return (run >= 0) & (place + period < start + length) & (period % np.maximum(own, 1) == 0) & (length >= period + own)

    def _near(self, place: np.ndarray, period: np.ndarray, bound: np.ndarray, way: int) -> np.ndarray:
        """How many of the next NEAR words on one side go on with the period."""
        count, going = np.zeros(len(place), np.int64), np.arange(len(place))
        for k in range(1, NEAR + 1):
            at = place[going] + way * k
            going = going[at < bound[going]] if way > 0 else going[at >= bound[going]]
            at = place[going] + way * k
            going = going[self.codes[at] == self.codes[at + period[going]]]
            if not len(going):
                break
            count[going] = k
        return count

    def _far(self, place: np.ndarray, period: np.ndarray, bound: np.ndarray, way: int) -> np.ndarray:
        """The end (way 1) or the start (way -1) of the stretch of equal words around each place."""
        out = place + (1 if way > 0 else 0)
        width = PIECE
        going = np.arange(len(place))
        while len(going):
            left = []
            for part in np.array_split(going, max(1, -(-len(going) * width // STEP))):
                room = bound[part] - out[part] if way > 0 else out[part] - bound[part]
                size = np.minimum(room, width)
                at = slices(out[part] if way > 0 else out[part] - size, size)
                differ = self.codes[at] != self.codes[at + np.repeat(period[part], size)]
                owner = np.repeat(np.arange(len(part)), size)
                told = size.copy()
                where = np.flatnonzero(differ)
                if way > 0:
                    who, one = np.unique(owner[where], return_index=True)
                    told[who] = at[where[one]] - out[part][who]
                else:
                    who, one = np.unique(owner[where][::-1], return_index=True)
                    told[who] = out[part][who] - 1 - at[where[::-1][one]]
                out[part] += way * told
                left.append(part[(told == size) & (room > size)])
            going = np.concatenate(left)
            width = min(2 * width, STEP)
        return out

    def _add(self, start: int, length: int, period: int, doc: int) -> None:
        if (doc, start, length) in self.found:
            return
        number = len(self.found)
        self.found[doc, start, length] = period
        if number == len(self.runs):
            self.runs = np.concatenate((self.runs, np.zeros_like(self.runs)))
        self.runs[number] = start, length, period
        around = self.of[start : start + length]
        around[(around < 0) | (self.runs[around, 1] < length)] = number


def runs(codes: np.ndarray, first: np.ndarray, least: int = 12) -> dict[int, list[tuple[int, int, int]]]:
    """The runs of each document that has some, as (start, length, period) by start and period; starts count from the document's first word."""
    out = defaultdict(list)
    for (doc, start, length), period in _Runs(codes, first, least).found.items():
        out[doc].append((start - int(first[doc]), length, period))
    return {d: sorted(x, key=lambda r: (r[0], r[2])) for d, x in out.items()}


def _rows(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    kinds = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for ids, data, offsets in chunks(batches, CHUNK):
        words = Words(data, offsets)
        codes, _ = words.dictionary()
        found = runs(codes, words.first, least)
        nothing = hashlib.sha256().hexdigest()
        best, lists, digests, kept = [], [], [], []
        for i in range(len(offsets) - 1):
            own = found.get(i, [])
            text = data[offsets[i] : offsets[i + 1]].tobytes().split()
            if own:
                gone = np.zeros(len(text), bool)
                for start, length, period in own:
                    gone[start + period : start + length] = True
                text = [w for w, g in zip(text, gone.tolist(), strict=True) if not g]
            best.append(max(own, key=lambda r: (r[1], -r[0], -r[2])) if own else None)
            lists.append([{"start": s, "length": n, "period": p} for s, n, p in own])
            digests.append(hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in own).encode()).hexdigest() if own else nothing)
            kept.append(b" ".join(text))
        told = [pa.array([b and b[k] for b in best], pa.int64()) for k in range(3)]
        exponent = pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64())
        columns = [pa.array(ids, pa.int64()), pa.array([len(x) for x in lists], pa.int64()), *told, exponent, pa.array(lists, pa.list_(kinds)), pa.array(digests), pa.array(kept, pa.binary())]
        yield pa.record_batch(columns, names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs", "runs_sha256", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """For each document its periodic runs and its text without their repetitions.

    Words are stretches of bytes other than ASCII white space, as they stand. A run is a longest stretch whose words equal those one
    smallest period before, with at least ``least`` words and at least two periods. ``start`` (a word's number from 0),
    ``length``, ``period`` and ``exponent_milli`` tell of the longest run, the first and then the one of the smallest period
    among equals, and are null where there is none; ``runs`` has all by start and period, ``runs_sha256`` is the digest of their lines
    ``start,length,period``. ``collapsed`` has the words that no run has after its first period, joined by a space.

    A null or empty text has no words, no runs and an empty ``collapsed``. Rows are taken one by one: repeated rows and null ids
    stay as they are. Other columns of ``docs`` may have any name and are let go. A very long text takes memory in proportion to its words.
    """
    found = common.texts(docs).mapInArrow(lambda batches: _rows(batches, least), SCHEMA)
    return found.withColumn("doc_id", common.real_id())


def echoed(docs: DataFrame, one_in: int = 10) -> DataFrame:
    """doc_id and text of ``docs``, with the words of one document in ``one_in`` made periodic from some word on, as decided by its id; for trials of ``periodic_runs``.

    Let h be the CRC-32 of the decimal doc_id and g = h div ``one_in``. Where h mod ``one_in`` is 0 and there are n > 0 words, each word from
    a = g mod n on becomes the word at a + (i - a) mod p, with p = 1 + (n - a) div (3 + g mod 8). A null doc_id leaves the text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    own = docs.select("doc_id", "text").withColumn("_g", F.when(h % one_in == 0, F.floor(h / one_in).cast("long"))).withColumn("_w", F.when(F.col("_g").isNotNull(), words))
    own = own.withColumn("_n", F.size("_w").cast("long"))
    own = own.withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n"))).withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    made = F.array_join(F.expr("transform(_w, (x, i) -> if(i >= _a, get(_w, cast(_a + (i - _a) % _p as int)), x))"), " ")
    return own.withColumn("text", F.when(F.col("_a").isNotNull(), made).otherwise(F.col("text"))).drop("_g", "_w", "_n", "_a", "_p")
