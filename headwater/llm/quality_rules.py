"""Quality rules: a table of thresholds compiled into one projection, without user functions.

A null or empty text has no words and fails. Rows are judged on their own, so repeated rows get
equal results and no column but ``doc_id`` and ``text`` matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of the languages of the corpus.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "he", "his", "in", "is",
    "it", "not", "of", "on", "or", "she", "that", "the", "they", "this", "to", "was", "were", "which",
    "with",
    "aber", "als", "auf", "auch", "aus", "bei", "das", "dem", "den", "der", "des", "die", "ein", "eine",
    "einer", "er", "es", "für", "ich", "im", "ist", "mit", "nicht", "sich", "sie", "sind", "und", "von",
    "war", "wie", "wir", "zu", "zum",
    "al", "como", "con", "de", "del", "el", "en", "es", "la", "las", "lo", "los", "más", "no",
    "para", "pero", "por", "que", "se", "su", "un", "una", "y",
    "au", "aux", "avec", "ce", "ces", "dans", "des", "du", "elle", "en", "est", "et", "il", "la",
    "le", "les", "leur", "mais", "ne", "nous", "ou", "par", "pas", "pour", "qui", "sur", "un", "une",
    "vous",
)

_SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"

#: name, counted, its bound in hundredths, what it is measured against. A text is kept if all hold.
RULES = (
    ("long_enough", "word_chars", ">=", 200, "n_words"),
    ("short_enough", "word_chars", "<=", 1500, "n_words"),
    ("few_symbols", "n_symbols", "<=", 20, "n_words"),
    ("stop_words", "n_stop_words", ">=", 4, "n_words"),
    ("few_repeated_lines", "n_dup_lines", "<=", 50, "n_lines"),
    ("few_bullets", "n_bullets", "<=", 90, "n_lines"),
    ("few_open_ends", "n_open_ends", "<=", 50, "n_lines"),
)


def verdict(rules=RULES) -> Column:
    """The table as one condition over the counted columns."""
    out = F.lit(True)
    for _, left, sign, bound, right in rules:
        a, b = F.col(left) * 100, F.col(right) * bound
        out = out & (a >= b if sign == ">=" else a <= b)
    return out


def _repeated_words() -> Column:
    """Words inside 3-word windows found twice or more. Windows are sorted by hash with their places; places whose neighbour is equal are kept and their spans added up."""
    places = F.sequence(F.lit(0), F.size("w") - 3)
    # the array is bound once as a lambda's variable; a plain reference could be inlined into the inner lambdas
    hashes = F.transform(places, lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)))

    def of(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = F.transform(F.array(pairs), lambda s: F.sort_array(F.transform(F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])), lambda x: x["i"])))[0]
        state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        total = F.aggregate(twice, state, lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + 3 - F.greatest(F.lit(0), a["end"] - i)).alias("n")), lambda a: a["n"])
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(total)

    return F.when(F.size("w") < 4, F.lit(0)).otherwise(F.transform(F.array(hashes), of)[0])


def measured(docs: DataFrame) -> DataFrame:
    """A struct ``row`` of the columns of ``docs``, with the counts, base_failed and kept beside it, so that no names clash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    bare = F.translate(text, " \t\n\x0b\x0c\r", "")
    step = docs.select(F.struct(*docs.columns).alias("row"), F.array_remove(F.split(text, _SPACE + "+"), "").alias("w"), lines.alias("l"), F.length(bare).cast("long").alias("word_chars"), (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    counted = step.select(
        "row",
        F.size("w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeated_words().cast("long").alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.size(F.filter("w", lambda x: F.rtrim(F.lower(x), F.lit(".,!?;:")).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("l", lambda x: x.rlike(r"^[\x20\x09]*[-*\x{2022}]"))).cast("long").alias("n_bullets"),
        F.size(F.filter("l", lambda x: x.rlike(r"(\.\.\.|\x{2026})[\x20\x09\x0D]*$"))).cast("long").alias("n_open_ends"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict())


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id with the counts, base_failed and kept."""
    found = measured(docs.select("doc_id", "text"))
    return found.select("row.doc_id", *[c for c in found.columns if c != "row"])


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that the rules keep.

    The verdict passes through a one-element array: a filter on the expression itself would be
    pushed into the projections below, with every count written out for each place that names it.
    """
    return measured(docs).select("row", F.explode(F.array("kept")).alias("verdict")).where("verdict").select("row.*")
