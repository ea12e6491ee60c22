"""Two matchers for keywords: one counts, one classifies."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Longer words that begin like a keyword and mean something else.
DIFFERENT_WORDS = ("메타버스",)


def counts(title: Column, keyword: str) -> Column:
    """An ASCII keyword stands alone; another one begins a word, unless a different word begins there."""
    kw = keyword.strip().lower()
    if not kw:
        return F.lit(False)
    if kw.isascii():
        pattern = rf"(?<![0-9a-z]){re.escape(kw)}(?![0-9a-z])"
    else:
        longer = [re.escape(w[len(kw) :]) for w in DIFFERENT_WORDS if w.startswith(kw) and w != kw]
        pattern = rf"(?<![0-9a-z가-힣]){re.escape(kw)}" + (f"(?!{'|'.join(longer)})" if longer else "")
    return F.coalesce(F.lower(title).rlike(pattern), F.lit(False))


def classifies(title: Column, keyword: str) -> Column:
    """An ASCII keyword stands alone; a single Hangul syllable isn't part of a Hangul word; others may stand anywhere."""
    kw, text = keyword.strip().lower(), F.lower(title)
    if not kw:
        return F.lit(False)
    if kw.isascii():
        found = text.rlike(rf"(?<![0-9a-z]){re.escape(kw)}(?![0-9a-z])")
    elif len(kw) == 1 and "가" <= kw <= "힣":
        found = text.rlike(rf"(?<![가-힣]){kw}(?![가-힣])")
    else:
        found = text.contains(kw)
    return F.coalesce(found, F.lit(False))


def first_of(title: Column, keywords: list[str]) -> Column:
    """The longest keyword that classifies, or null; the earlier of equal lengths."""
    out = F.lit(None).cast("string")
    for _, kw in sorted(enumerate(keywords), key=lambda x: (len(x[1]), -x[0])):
        out = F.when(classifies(title, kw), F.lit(kw)).otherwise(out)
    return out


def hits(title: Column, keywords: list[str]) -> Column:
    """How many of the keywords classify."""
    out = F.lit(0)
    for kw in keywords:
        out = out + classifies(title, kw).cast("int")
    return out
