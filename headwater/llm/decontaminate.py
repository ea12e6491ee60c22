"""Benchmark decontamination by winnowing, in DataFrame operations alone.

A document keeps the least hash of its 5-word grams for each run of ``WINDOW - K + 1`` of
them, which is one fingerprint for each window of 10 words; neighbouring windows mostly share it
and become one row. Two equal windows have equal fingerprints, so each shared span of 10 words or more
is found. Items of fewer words are one window of their own length, whose print is the hash of the whole; a document
gives its grams of each such length too. All prints of a document come from one pass over its words and meet those of the
benchmark in one join. Windows behind a hit are then compared as whole strings, which removes chance hits and
gives the exact spans.

Null and empty texts have no words. Items without words are never found. Repeated rows of documents
get the same result; rows that share a doc_id, or have none, are judged by their own texts. What is broadcast is
measured in bytes first, up to ``BROADCAST_BYTES``; beyond, the join shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.llm import common

WINDOW, K = 10, 5
#: Measured bytes of the columns that may be broadcast.
BROADCAST_BYTES = 64 << 20
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    # on ASCII alone lower() changes nothing but A-Z, and is faster
    lower = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _LETTERS, _LETTERS.lower()))
    return F.array_remove(F.split(lower, _BETWEEN), "")


def n_words(text: Column) -> Column:
    """As many as ``words`` gives; capitals need no folding to be counted."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long")


def _grams(size: int) -> Column:
    """Hashes of all runs of ``size`` of the words w."""
    none = F.array().cast("array<bigint>")
    return F.when(F.size("w") >= size, F.transform(F.sequence(F.lit(0), F.size("w") - size), lambda i: F.xxhash64(*[F.get("w", i + j) for j in range(size)]))).otherwise(none)


def _prints(df: DataFrame, key: str, lengths: Sequence[int], whole: bool) -> DataFrame:
    """(key, length, print, start, n): prints of windows of these lengths and the n places from start that have them, from rows of key and w.

    ``whole``: words of fewer than WINDOW give their one window, as items do; else all windows of each length.
    """
    span = WINDOW - K + 1
    short = [m for m in lengths if m < WINDOW]
    long_enough = F.size("w") >= WINDOW
    shorter = [F.when(F.size("w") == m, _grams(m)).otherwise(F.array().cast("array<bigint>")) if whole else _grams(m) for m in short]
    grams = df.select(key, F.when(long_enough, _grams(K)).otherwise(F.array().cast("array<bigint>")).alias("h") if WINDOW in lengths else F.array().cast("array<bigint>").alias("h"), *[c.alias(f"s{m}") for m, c in zip(short, shorter, strict=True)])
    rest = [f"s{m}" for m in short]
    none = F.array().cast("array<bigint>")
    least = F.when(F.size("h") > 0, F.transform(F.sequence(F.lit(0), F.size("h") - span), lambda i: F.least(*[F.get("h", i + j) for j in range(span)]))).otherwise(none)
    least = grams.select(key, least.alias("m"), *rest)
    first = F.filter(F.transform("m", lambda x, i: i), lambda i: (i == 0) | (F.get("m", i) != F.get("m", i - 1)))
    at = least.select(key, "m", first.alias("first"), *rest)
    row = lambda length, value, start, n: F.struct(F.lit(length).alias("length"), value.alias("print"), start.alias("start"), n.alias("n"))
    found = [F.transform("first", lambda i, j: row(WINDOW, F.get("m", i), i, F.coalesce(F.get("first", j + 1), F.size("m")) - i))]
    each = lambda m: F.transform(f"s{m}", lambda x, i: row(m, x, i, F.lit(1)))
    found += [each(m) for m in short]
    return at.select(key, F.inline(F.concat(*found)))


def _windows(df: DataFrame, key: str, places: Column) -> DataFrame:
    """(key, length, start, window) for an array of length, start and n."""
    each = F.flatten(F.transform(places, lambda p: F.transform(F.sequence(p["start"], p["start"] + p["n"] - 1), lambda i: F.struct(p["length"].alias("length"), i.alias("start")))))
    text = F.transform(F.array_distinct(each), lambda x: F.struct(x["length"].alias("length"), x["start"].alias("start"), F.array_join(F.slice("w", x["start"] + 1, x["length"]), " ").alias("window")))
    return df.select(key, F.inline(text))


def _bounded(df: DataFrame, width: Column) -> DataFrame:
    """``df``, to be broadcast if its rows, each of ``width`` bytes, are few enough."""
    return F.broadcast(df) if (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES else df


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, start, size and item_ids of each window of a document that an item has. Starts and sizes count words.

    ``docs`` has a text for each doc_id, and may repeat it.
    """
    common.shared_folder(docs.sparkSession)
    own = common.texts(docs)
    bench = items.select(F.col("item_id"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    # at most WINDOW numbers
    lengths = sorted(r[0] for r in bench.select(F.least(F.size("w"), F.lit(WINDOW))).distinct().collect())
    if not lengths:
        return docs.sparkSession.createDataFrame([], f"doc_id long, start int, size int, item_ids array<{dict(items.dtypes)['item_id']}>")
    prints = _prints(bench, "item_id", lengths, True).select("length", "print").distinct()
    length = F.least(F.size("w"), F.lit(WINDOW))
    whole = F.array(F.struct(length.alias("length"), F.lit(0).alias("start"), (F.size("w") - length + 1).alias("n")))
    windows = _windows(bench, "item_id", whole).groupBy("length", "window").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    rows = _prints(own.select("doc_id", words(F.col("text")).alias("w")), "doc_id", lengths, False)
    near = rows.join(_bounded(prints, F.lit(24)), ["length", "print"], "left_semi")
    # narrow and written, so that its size decides how the texts meet it
    near = near.groupBy("doc_id").agg(F.collect_set(F.struct("length", "start", "n")).alias("places")).checkpoint()
    again = own.join(_bounded(near, 32 + 24 * F.size("places")), "doc_id").select("doc_id", "places", words(F.col("text")).alias("w"))
    item_bytes = F.octet_length("window") + 16 * F.size("item_ids") + 32
    return _windows(again, "doc_id", F.col("places")).join(_bounded(windows, item_bytes), ["length", "window"]).select("doc_id", "start", F.col("length").alias("size"), "item_ids")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit (words inside an occurrence), item_ids (sorted as strings) and contaminated, a row for each of docs."""
    own, _ = common.identified(docs.select(F.col("doc_id").alias("_told"), F.col("doc_id"), "text"), "_row")
    own = own.select("_told", F.col("_row").alias("doc_id"), "text")
    both = hits(own, items).groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.struct("start", "size"))).alias("spans"),
        F.array_sort(F.transform(F.array_distinct(F.flatten(F.collect_set("item_ids"))), lambda x: x.cast("string"))).alias("item_ids"),
    )
    # sorted starts: a span adds what lies beyond the furthest end so far
    state = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate("spans", state, lambda s, x: F.struct(F.greatest(s["end"], x["start"] + x["size"]).alias("end"), (s["hit"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(s["end"], x["start"]))).alias("hit")), lambda s: s["hit"])
    both = both.select("doc_id", covered.alias("n_hit"), "item_ids").checkpoint()
    sizes = own.select("_told", "doc_id", n_words(F.col("text")).alias("n_words"))
    out = sizes.join(_bounded(both, 32 + 32 * F.size("item_ids")), "doc_id", "left")
    return out.select(F.col("_told").cast("long").alias("doc_id"), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
