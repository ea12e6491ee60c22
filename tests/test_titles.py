"""Titles are whole first lines, against plain Python."""

import re

import pyarrow.parquet as pq
import pytest

from headwater.plans import catalog
from headwater.plans.catalog import QUERIES
from headwater.sources.articles import articles


@pytest.fixture(scope="module")
def titles(sf):
    texts = {r["doc_id"]: (r["text"] or "").split("\n")[0] for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()}
    found = {r["page_id"]: texts[r["page_id"]] for r in pq.read_table(f"{sf}/pages.parquet").to_pylist() if r["page_id"] in texts}
    assert any(len(t) > 80 for t in found.values())
    return found


def words(title):
    all_ = [w.lower() for w in re.findall("[0-9A-Za-z가-힣]+", title)]
    return {w for w in all_ if len(w) >= 2} or set(all_) or {title.lower()}


def test_articles_have_whole_first_lines(spark, sf, titles):
    assert {r.pos: r.title for r in articles(spark, sf).collect()} == titles


def test_keywords_and_tokens_see_the_whole_line(spark, sf, titles):
    hits = {k: sum(bool(re.search(f"(^|[^0-9a-z]){k}($|[^0-9a-z])", t.lower())) for t in titles.values()) for k in catalog.WATCH}
    assert {r.keyword: r.n for r in QUERIES["keyword_counts"](spark, sf).collect()} == hits
    assert {r.pos: r.tokens.split(" ") for r in QUERIES["title_tokens"](spark, sf).collect()} == {p: sorted(words(t)) for p, t in titles.items()}
    assert sum(r.chars for r in QUERIES["title_stats"](spark, sf).collect()) == sum(map(len, titles.values()))
