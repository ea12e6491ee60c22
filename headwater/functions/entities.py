"""HTML character references decoded by column functions alone.

A reference begins at an ampersand and never holds another one, so a text is cut at its ampersands and each piece
decides by itself. Names and the numbers that stand for something else come from Python's own tables, as literal maps.
"""

from __future__ import annotations

import html
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names that count without a semicolon, and so as the beginning of a longer word, longest first.
_BARE = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Numbers that don't stand for their own character, as far as they are single cases.
_CASES = [*range(0xA0), *range(0xFDD0, 0xFDF0), *(plane << 16 | low for plane in range(17) for low in (0xFFFE, 0xFFFF))]
_OTHERS = {n: html.unescape(f"&#{n};") for n in _CASES if html.unescape(f"&#{n};") != chr(n)}
_UNKNOWN = "�"
#: Stands between the entries of a literal; no name or replacement holds it.
_BETWEEN = "\x01"


def _literal_map(entries: dict[str, str]) -> Column:
    # folded to one literal by the optimizer
    parts = lambda values: F.split(F.lit(_BETWEEN.join(values)), _BETWEEN)
    return F.map_from_arrays(parts(entries), parts(entries.values()))


def _character(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def _numbered(piece: Column, others: Column) -> Column:
    """A piece that begins with a number's reference."""
    decimal, sixteen = F.regexp_extract(piece, "^#0*([0-9]+);?", 1), F.regexp_extract(piece, "^#[xX]0*([0-9a-fA-F]+);?", 1)
    rest = F.regexp_replace(piece, "^#([0-9]+|[xX][0-9a-fA-F]+);?", "")
    digits = F.when(decimal != "", decimal).otherwise(F.conv(F.right(sixteen, F.lit(8)), 16, 10))
    long_ = (F.length(decimal) > 7) | (F.length(sixteen) > 6)
    number = F.when(long_, F.lit(0x110000)).otherwise(digits.cast("long"))
    told = F.when((number > 0x10FFFF) | number.between(0xD800, 0xDFFF), _UNKNOWN).otherwise(F.coalesce(F.element_at(others, number.cast("string")), _character(number)))
    return F.concat(told, rest)


def _named(piece: Column, names: Column) -> Column:
    """A piece that begins with a name: whole, or else the longest name without a semicolon at its beginning."""
    name = F.regexp_extract(piece, "^[^\\t\\n\\f <&#;]{1,32};?", 0)
    bare = F.regexp_extract(name, "^(" + "|".join(_BARE) + ")", 1)
    after = lambda found: F.substring(piece, F.length(found) + 1, F.length(piece))
    whole = F.element_at(names, name)
    return F.when(whole.isNotNull(), F.concat(whole, after(name))).when(bare != "", F.concat(F.element_at(names, bare), after(bare))).otherwise(F.concat(F.lit("&"), piece))


def unescape(c: Column) -> Column:
    """The same as Python's ``html.unescape``; null stays null."""
    names, others = _literal_map(html5), _literal_map({str(n): x for n, x in _OTHERS.items()})
    piece = lambda p: F.when(p.rlike("^#([0-9]|[xX][0-9a-fA-F])"), _numbered(p, others)).when(p.startswith("#"), F.concat(F.lit("&"), p)).otherwise(_named(p, names))
    parts = F.split(c, "&")
    made = F.concat(F.get(parts, 0), F.array_join(F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), piece), ""))
    return F.when(F.contains(c, F.lit("&")), made).otherwise(c)
