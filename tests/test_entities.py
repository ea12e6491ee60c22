"""Character references in the JVM against Python's decoder."""

import html
import random
from html.entities import html5

from pyspark.sql import functions as F

from headwater.functions import entities, text


def test_all_names_and_odd_numbers(spark):
    rng = random.Random(5)
    texts = [f"a&{n}b" for n in html5] + [f"&{n[:-1]} {n}" for n in html5 if n.endswith(";")]
    texts += [f"&#{n};" for n in [*range(0x180), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x1F600, 0x1FFFE, 0x10FFFE, 0x10FFFF, 0x110000, 10**9, 10**30]]
    texts += [f"x&#x{n:x}z" for n in [*range(0x100), 0xD800, 0x1F600, 0x10FFFF, 0x110000, 16**12]] + ["&#000065;", "&#X0000000041;", "&#", "&#;", "&#x", "&#xg;", "&", "&&", "&;", "a & b", "&notit;", "&notin;", "&ampamp;", "&amp;lt;", "&" + "x" * 40 + ";", "&lt\n&gt\t", "", None]
    bits = ["&", "#", "x", ";", "amp", "lt", "not", "in", "8", "41", " ", "é", "&amp;", "&#38;", "notit", "<"]
    texts += ["".join(rng.choice(bits) for _ in range(rng.randrange(9))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = {r.i: (r.once, r.twice) for r in rows.select("i", entities.unescape(F.col("t")).alias("once"), text.unescape_twice(F.col("t")).alias("twice")).collect()}

    def twice(t):
        t = html.unescape(t)
        return html.unescape(t) if "&amp;" in t or "&#" in t else t

    for i, t in enumerate(texts):
        assert found[i] == ((None, None) if t is None else (html.unescape(t), twice(t))), (t, found[i])


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([("<title>a &amp; b</title>",)], "html string").select(text.page_title(F.col("html")).alias("t"))
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "MapIn" not in plan and pages.first().t == "a & b"
