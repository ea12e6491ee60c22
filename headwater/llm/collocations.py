"""Phrases whose words keep together, mined for each language.

All runs of 1 to ``max_n`` words are exploded into rows and counted by a hash aggregation. A run of three or more words is as rare as the rarer of the
two runs one word shorter inside it, so longer ones are exploded only where both of these reach ``least``: the frequent
shorter ones go out as a bitmap of at most ``BITS`` bits, built by Spark's bitmap aggregates. A false positive of the bitmap adds a row to be
counted, nothing is lost. Each map task counts the runs of a chunk of text before it makes rows of them, so a frequent
word, pair or language moves a row for each chunk and, after Spark's own partial sums, one for each task.

Candidates are then joined with the counts of both sides of each cut, scored in exact decimals, taken out where a phrase one word longer covers
them (a longer one still covers no more often than the one between), and ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm import common
from headwater.llm.textarrays import Words, chunks

CHUNK = 4 << 20
#: Bits of the largest bitmap that is broadcast (64 MB), and bits for each phrase in it while it is smaller.
BITS, BITS_EACH = 1 << 29, 16
#: Languages of null.
UNKNOWN = "und"
#: Bytes that end a piece become a line feed, A to Z small letters.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[[*b".,;:!?", *range(10, 14)]] = 10
#: Counts are exact below this many digits; a larger one stops the query.
DIGITS = 15


def _grams(langs: np.ndarray, data: np.ndarray, offsets: np.ndarray, max_n: int, wanted: Callable[[np.ndarray, pa.Array], np.ndarray] | None, few: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """(languages, phrases, counts) of a chunk's runs of each length from 1 to ``max_n``.

    ``wanted`` tells which distinct runs may be part of longer ones; it is asked from length ``few`` on.
    """
    flat = _TABLE[data]
    words = Words(flat, offsets)
    if not len(words):
        return
    codes, names = words.dictionary()
    piece = np.cumsum(flat == 10)[words.starts]
    lang, kinds = pd.factorize(langs)
    keys = lang[words.doc].astype(np.int64) * len(names) + codes
    unique, ids, counts = np.unique(keys, return_inverse=True, return_counts=True)
    owner, phrases = unique // len(names), names.take(pa.array(unique % len(names)))
    word_ids, at, alone = ids, np.arange(len(words)), phrases
    yield kinds[owner], phrases, counts
    for n in range(2, max_n + 1):
        # places where a run of n - 1 words begins and another begins at the next word, in the same piece of the same text
        follows = np.flatnonzero((at[1:] == at[:-1] + 1) & (words.doc[at[:-1]] == words.doc[np.minimum(at[:-1] + n - 1, len(words) - 1)]))
        follows = follows[piece[at[follows]] == piece[at[follows] + n - 1]]
        if n > few and wanted:
            good = wanted(kinds[owner], phrases)
            follows = follows[good[ids[follows]] & good[ids[follows + 1]]]
        if not len(follows):
            return
        keys = ids[follows] * len(alone) + word_ids[at[follows] + n - 1]
        unique, new, counts = np.unique(keys, return_inverse=True, return_counts=True)
        owner = owner[unique // len(alone)]
        phrases = pc.binary_join_element_wise(phrases.take(pa.array(unique // len(alone))), alone.take(pa.array(unique % len(alone))), b" ")
        ids, at = new, at[follows]
        yield kinds[owner], phrases, counts


def _hashes(langs: np.ndarray, phrases: pa.Array) -> np.ndarray:
    """Spark's ``xxhash64`` of language and phrase."""
    seeds = {x: xxhash.xxh64_intdigest(x.encode(), 42) for x in pd.unique(langs)}
    return np.fromiter((xxhash.xxh64_intdigest(p, seeds[x]) for x, p in zip(langs.tolist(), phrases.to_pylist(), strict=True)), np.uint64, len(phrases)).view(np.int64)


def _rows(batches: Iterable[pa.RecordBatch], low: int, high: int, bitmap=None) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of runs of ``low`` to ``high`` words; from length 1 on also an empty phrase with the number of words of each language."""
    wanted = None
    if bitmap is not None:
        bits, value = bitmap.value

        def wanted(langs: np.ndarray, phrases: pa.Array) -> np.ndarray:
            at = np.mod(_hashes(langs, phrases), bits)
            return (value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    for langs, data, offsets in chunks(batches, CHUNK):
        for size, (own, phrases, counts) in enumerate(_grams(langs, data, offsets, high, wanted, low - 1 if low > 1 else high), 1):
            if size < low:
                continue
            if size == 1:
                total = pd.Series(counts).groupby(own).sum()
                own, counts = np.concatenate((own, total.index.to_numpy())), np.concatenate((counts, total.to_numpy()))
                phrases = pa.concat_arrays([phrases, pa.array([b""] * len(total), phrases.type)])
            yield pa.record_batch([pa.array(own, pa.string()), phrases.cast(pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=["lang", "phrase", "n"])


def _counted(rows: DataFrame, low: int, high: int, least: int, bitmap=None) -> DataFrame:
    """(lang, phrase, f) of the runs of ``low`` to ``high`` words that occur at least ``least`` times, and of the empty phrase."""
    made = rows.mapInArrow(lambda batches: _rows(batches, low, high, bitmap), "lang string, phrase string, n long")
    return made.groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == "")).checkpoint()


def _bitmap(phrases: DataFrame):
    """A broadcast (bits, bytes) of the hashes of the phrases, of a size that follows their number up to ``BITS``."""
    spark = phrases.sparkSession
    bits = min(BITS, 1 << max(16, (phrases.count() * BITS_EACH).bit_length()))
    # Spark's bitmaps count positions from 1 and hold 32,768 of them
    place = F.pmod(F.xxhash64("lang", "phrase"), F.lit(bits)) + 1
    blocks = phrases.select(F.bitmap_bucket_number(place).alias("block"), F.bitmap_bit_position(place).alias("bit")).groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    value = np.zeros(bits // 8, np.uint8)
    for row in blocks.toArrow().to_pylist():
        value[(row["block"] - 1) * 4096 : row["block"] * 4096] = np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast((bits, value))


def phrase_counts(docs: DataFrame, max_n: int = 3, least: int = 10) -> DataFrame:
    """(lang, phrase, f): how often each run of 1 to ``max_n`` words occurs in each language, of those that occur ``least`` times, and the number of words as the empty phrase."""
    common.shared_folder(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = last = _counted(rows, 1, min(2, max_n), least)
    for n in range(3, max_n + 1):
        shorter = last.where(_length(F.col("phrase")) == n - 1)
        last = _counted(rows, n, n, least, _bitmap(shorter))
        found = found.union(last)
    return found


def _length(phrase: Column) -> Column:
    """How many words a phrase has."""
    return F.when(phrase == "", 0).otherwise(F.length(phrase) - F.length(F.replace(phrase, F.lit(" "))) + 1)


def _exact(c: str) -> Column:
    return F.col(c).cast(f"decimal({DIGITS},0)")


def scored(counts: DataFrame, max_n: int = 3) -> DataFrame:
    """lang, phrase, a, l, r and score of the phrases of two and more words: of the cut that scores lowest, the first of equals."""
    words = F.split("phrase", " ")
    cuts = counts.where(_length(F.col("phrase")) >= 2).withColumnRenamed("f", "a").withColumn("w", words).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.lit(max_n)), " ").alias("right"))
    both = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * _exact("a") * _exact("a"), _exact("l") * _exact("r"))
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("s")
    return both.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "s.l", "s.r", "s.score")


def uncovered(phrases: DataFrame, percent: int = 50) -> DataFrame:
    """The phrases that no phrase of more words around them has in ``percent`` of 100 of their occurrences."""
    w = F.split("phrase", " ")
    longer = phrases.where(_length(F.col("phrase")) >= 3).select("lang", F.explode(F.array(F.array_join(F.slice(w, F.lit(1), F.size(w) - 1), " "), F.array_join(F.slice(w, F.lit(2), F.size(w) - 1), " "))).alias("phrase"), "a")
    most = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    return phrases.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))).drop("most")


def ranked(phrases: DataFrame, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language with their ranks: by score, then by count, both falling, then by the phrase's bytes.

    Ranked in parts of each language first, so that no task gets more than ``top`` phrases of each part.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(phrases.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(parts))
    first = phrases.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    out = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return out.where(F.col("rank") <= top).drop("part")


def collocations(docs: DataFrame, max_n: int = 3, least: int = 10, percent: int = 50, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first ``top`` phrases of 2 to ``max_n`` words.

    Texts, A to Z in lower case, are cut into pieces at ``.,;:!?`` and line ends, pieces into words at spaces and tabs; a phrase lies in one
    piece. ``a`` is how often it occurs (``least`` times or it is no candidate), overlaps included, ``l`` and ``r`` the same for both sides of the cut
    with the lowest score, floor(1000000 a a / (l r)), the first such cut; ``n`` is the language's number of words.

    A null language is ``und``; a null or empty text has no words. Repeated rows count each time, whatever their ids. An empty
    table, or one without a phrase that is frequent enough, gives no rows. Other columns may have any name and are let go.
    """
    counts = phrase_counts(docs, max_n, least)
    found = scored(counts, max_n).checkpoint()
    sizes = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))
    return ranked(uncovered(found, percent), top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
