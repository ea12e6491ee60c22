"""Page titles and what is made of them, against plain Python with its own entity decoder."""

import html
import re

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from headwater.functions import text
from headwater.operators import quality
from headwater.plans.catalog import QUERIES


def title(page):
    found = re.search(r"<title[^>]*>(.*?)</title>", page or "", re.I | re.S)
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", " ", found[1]))).strip() if found else ""


def words(t):
    return set(re.findall("[0-9a-z가-힣]{2,}", t.lower()))


PAGES = [
    ("a", "Salt &amp; pepper", "<title>Salt &amp; <b>pepper</b></title>"),
    ("b", "단독 x", "<TITLE>&lt;단독&gt;&nbsp; x &amp;lt;</TITLE>"),
    ("c", "amp lt", "<title>&amp; &lt;&#39;</title>"),
    ("d", "none", None),
]


def test_entities_are_decoded_once_after_tags(spark):
    df = spark.createDataFrame(PAGES, "url string, title string, html string")
    found = {r.url: r.t for r in df.select("url", text.page_title(F.col("html")).alias("t")).collect()}
    assert found == {u: title(h) for u, _, h in PAGES} == {"a": "Salt & pepper", "b": "<단독> x &lt;", "c": "& <'", "d": ""}


def test_link_check_has_no_words_from_entities(spark):
    df = spark.createDataFrame(PAGES, "url string, title string, html string")
    fetched = df.select("url", F.lit(200).alias("status"), "html")
    odd = quality.links(df.select("url", "title"), fetched, True).first()
    want = 0
    for _, a, page in PAGES:
        x, y = words(a), words(title(page))
        want += not (x and y) or len(x & y) / min(len(x), len(y)) < quality.LIMITS["overlap"]
    assert (odd.n, odd.status) == (want, "warn")
    gone = fetched.where("url <> 'c'").withColumn("status", F.when(F.col("url") == "a", 404).otherwise(200))
    # a answers 404, b fits, c isn't reached, d has no title
    assert tuple(quality.links(df.select("url", "title"), gone, True).first())[2:] == ("warn", 2, None, "fits=1;unreached=1")
    assert tuple(quality.links(df.select("url", "title"), gone).first())[2:] == ("ok", 0, None, "off")


def test_tables(spark, sf):
    big = sf.replace("sf0.001", "sf0.01")
    pages = {r["page_id"]: title(r["html"]) for r in pq.read_table(f"{big}/pages.parquet").to_pylist()}
    assert {r.pos: r.page_title for r in QUERIES["page_title"](spark, big).collect()} == pages
    lines = {r["doc_id"]: (r["text"] or "").split("\n")[0] for r in pq.read_table(f"{big}/documents.parquet").to_pylist()}
    want = {}
    for p, t in pages.items():
        if p in lines:
            x, y = words(lines[p]), words(t)
            want[p] = round(len(x & y) / min(len(x), len(y)), 9) if x and y else 0.0
    assert {r.pos: r.overlap for r in QUERIES["title_overlap"](spark, big).collect()} == want
