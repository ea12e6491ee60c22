"""Many keywords in one pass over the titles: an automaton of all of them, and the rules of both matchers checked at each hit.

The automaton is built once, broadcast, and walked once along each title, however many keywords there are. A list of more than
``BLOCK`` keywords goes in blocks, each with an automaton of bounded size and a pass of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.functions.keywords import DIFFERENT_WORDS

#: Keywords of one automaton; about 100 bytes of memory for each of their letters.
BLOCK = 200_000


def _plain(c: str) -> bool:
    return "0" <= c <= "9" or "a" <= c <= "z"


def _hangul(c: str) -> bool:
    return "가" <= c <= "힣"


def counts_at(text: str, first: int, end: int, word: str) -> bool:
    """Whether the keyword at [first, end) counts: alone if it is ASCII, else at the beginning of a word that isn't a different one."""
    before, after = text[first - 1] if first else "", text[end : end + 1]
    if word.isascii():
        return not (before and _plain(before)) and not (after and _plain(after))
    if before and (_plain(before) or _hangul(before)):
        return False
    return not any(w != word and w.startswith(word) and text.startswith(w, first) for w in DIFFERENT_WORDS)


def classifies_at(text: str, first: int, end: int, word: str) -> bool:
    """Whether the keyword at [first, end) classifies: alone if it is ASCII, a single Hangul syllable outside Hangul words, others anywhere."""
    before, after = text[first - 1] if first else "", text[end : end + 1]
    if word.isascii():
        return not (before and _plain(before)) and not (after and _plain(after))
    if len(word) == 1 and _hangul(word):
        return not (before and _hangul(before)) and not (after and _hangul(after))
    return True


RULES = {"counts": counts_at, "classifies": classifies_at}


def automaton(words: Iterable[tuple[int, str]]) -> ahocorasick.Automaton:
    """Of numbered keywords; those that are equal in lower case share a place, blank ones are in none."""
    numbers: dict[str, list[int]] = {}
    for i, w in words:
        if w and (key := w.strip().lower()):
            numbers.setdefault(key, []).append(i)
    out = ahocorasick.Automaton()
    for key, own in numbers.items():
        out.add_word(key, (key, own))
    if numbers:
        out.make_automaton()
    return out


def found(own: ahocorasick.Automaton, text: str | None, rule: Callable[[str, int, int, str], bool]) -> list[int]:
    """Numbers of the keywords of a lower-case title, each once."""
    if not text or not len(own):
        return []
    out: dict[int, None] = {}
    for last, (key, numbers) in own.iter(text):
        if numbers[0] not in out and rule(text, last + 1 - len(key), last + 1, key):
            out.update(dict.fromkeys(numbers))
    return sorted(out)


def _rows(batches: Iterable[pa.RecordBatch], shared, rule: str) -> Iterator[pa.RecordBatch]:
    own = shared.value
    for batch in batches:
        at = batch.schema.get_field_index("_lower")
        hits = [found(own, t, RULES[rule]) for t in batch.column(at).to_pylist()]
        columns = [c for i, c in enumerate(batch.columns) if i != at]
        names = [n for i, n in enumerate(batch.schema.names) if i != at]
        yield pa.record_batch([*columns, pa.array(hits, pa.list_(pa.int32()))], names=[*names, "found"])


def with_keywords(titles: DataFrame, words: list[str], rule: str = "counts", column: str = "title") -> list[DataFrame]:
    """``titles`` with ``found``, the numbers of the keywords in each title; one table for each block of keywords.

    A null title has none. A keyword that occurs several times in a title is found once.
    """
    spark = titles.sparkSession
    rows = titles.withColumn("_lower", F.lower(F.col(column)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in titles.schema)
    out = []
    numbered = list(enumerate(words))
    for at in range(0, max(1, len(numbered)), BLOCK):
        shared = spark.sparkContext.broadcast(automaton(numbered[at : at + BLOCK]))
        out.append(rows.mapInArrow(lambda batches, shared=shared: _rows(batches, shared, rule), f"{schema}, found array<int>"))
    return out


def counted(titles: DataFrame, words: list[str], *by: str) -> DataFrame:
    """keyword, the columns ``by`` and n: titles with each keyword that occurs, by the counting matcher. Counted on the map side first."""
    rows = None
    for part in with_keywords(titles.select("title", *by), words):
        own = part.select(*by, F.explode("found").alias("i"))
        rows = own if rows is None else rows.union(own)
    sums = rows.groupBy("i", *by).agg(F.count("*").alias("n"))
    names = titles.sparkSession.createDataFrame(list(enumerate(words)), "i int, keyword string")
    return sums.join(names, "i").select("keyword", *by, "n")


def keyword_counts(titles: DataFrame, words: list[str]) -> DataFrame:
    """keyword and n for every keyword, zeros included; those equal in lower case are one, named as the first of them."""
    distinct = list({w.strip().lower(): w for w in reversed(words)}.values())[::-1]
    names = titles.sparkSession.createDataFrame([(w,) for w in distinct], "keyword string")
    return names.join(counted(titles, distinct), "keyword", "left").select("keyword", F.coalesce("n", F.lit(0)).alias("n"))


def classified(titles: DataFrame, words: list[str], column: str = "title") -> DataFrame:
    """``titles`` with ``keyword``, the longest that classifies (the earlier of equal lengths) or null, and ``hits``, how many do."""
    ranks = {i: r for r, (i, _) in enumerate(sorted(enumerate(words), key=lambda x: (-len(x[1]), x[0])))}
    by_rank = [w for _, w in sorted((r, words[i]) for i, r in ranks.items())]
    parts = with_keywords(titles, by_rank, "classifies", column)
    if len(parts) > 1:
        raise ValueError(f"at most {BLOCK} keywords can classify")
    names = F.lit(None).cast("string") if not words else None
    rows = parts[0].withColumn("_i", F.get("found", 0)).withColumn("hits", F.size("found")).drop("found")
    if names is not None:
        return rows.withColumn("keyword", names).drop("_i")
    named = titles.sparkSession.createDataFrame(list(enumerate(by_rank)), "_i int, keyword string")
    return rows.join(F.broadcast(named) if len(by_rank) <= BLOCK else named, "_i", "left").drop("_i")
