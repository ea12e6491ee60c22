"""Literal rows for what the tables lack: Hangul, ports, entities, times."""

import io
import json
import zipfile
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from headwater.functions import keywords, text, timewin, urls
from headwater.operators import load, windows
from headwater.sources import articles as src


def value(spark, column, *args):
    df = spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    ("title", "keyword", "want"),
    [("OpenAIs news", "openai", False), ("OpenAI가 발표", "OpenAI", True), ("메타가 공개", "메타", True), ("빅메타 공개", "메타", False), ("메타버스 전시", "메타", False), ("메타버스 전시", "메타버스", True), ("x", "", False)],
)
def test_counting_matcher(spark, title, keyword, want):
    assert value(spark, keywords.counts(F.col("c0"), keyword), title) is want


@pytest.mark.parametrize(("title", "keyword", "want"), [("AIR plane", "ai", False), ("AI가 온다", "ai", True), ("법안", "법", False), ("새 법 나온다", "법", True), ("초거대모델", "거대", True)])
def test_classifying_matcher(spark, title, keyword, want):
    assert value(spark, keywords.classifies(F.col("c0"), keyword), title) is want


def test_longest_keyword_wins(spark):
    assert value(spark, keywords.first_of(F.col("c0"), ["ai", "ai 기본법"]), "AI 기본법 시행") == "ai 기본법"


@pytest.mark.parametrize(
    ("url", "key"),
    [("https://www.a.kr:443/x/?utm_source=q&b=2&a=1#t", "a.kr/x?a=1&b=2"), ("http://u@m.a.kr:80", "a.kr/"), ("https://n.naver.com/v/1?sid=105", "n.naver.com/v/1"), ("https://b.kr/v?sid=105&z=", "b.kr/v?sid=105"), ("A.kr/Path/", "a.kr/path"), ("", ""), (None, "")],
)
def test_collect_key(spark, url, key):
    assert value(spark, urls.collect_key(F.col("c0")), url) == key


@pytest.mark.parametrize(("url", "key"), [("https://www.a.kr:443/x/?b=&ref=1", "a.kr:443/x?b="), ("m.a.kr/x", "m.a.kr/x"), ("", "")])
def test_audit_key(spark, url, key):
    assert value(spark, urls.audit_key(F.col("c0")), url) == key


def test_tidy_url(spark):
    assert value(spark, urls.tidy(F.col("c0")), "https://a.kr:443/x") == "https://a.kr/x"
    assert value(spark, urls.tidy(F.col("c0")), "http://a.kr:443/x") == "http://a.kr:443/x"


def test_titles(spark):
    assert value(spark, text.clean_title(F.col("c0")), '  A &amp;amp; B  ( c ) " d " - ') == 'A & B (c) "d"'
    assert value(spark, text.tokens(F.col("c0"), ["관련"]), "정부가 AI를 규제 관련 A") == ["정부", "ai", "규제"]
    assert value(spark, text.trimmed_headline(F.col("c0")), "[단독] 새 모델 공개 | 한국일보") == "새 모델 공개"
    assert value(spark, text.headline_sentence(F.col("c0"), F.lit(3)), "정부가 밝혔다") == "정부가 밝혔다고 3개 매체가 전했다"
    assert value(spark, text.closed_syllable(F.col("c0")), "한국") is True
    assert value(spark, text.page_id(F.col("c0")), "https://x.so/T-" + "ab" * 16 + "?v=1") == "ab" * 16


def test_times(spark):
    assert timewin.day_window(date(2026, 9, 11)) == (datetime(2026, 9, 10, 15), datetime(2026, 9, 11, 14, 59, 59))
    assert value(spark, timewin.local_date_of_text(F.col("c0")), "20260910T150000Z") == date(2026, 9, 11)
    assert value(spark, timewin.local_date_of_text(F.col("c0")), "2026") is None
    assert timewin.slices(spark, *timewin.day_window(date(2026, 9, 11))).count() == 96
    assert timewin.week_start(date(2026, 9, 13)) == date(2026, 9, 7)


def test_bisection_of_a_full_day(spark):
    first, last = timewin.day_window(date(2026, 9, 11))
    rows = spark.range(620).select((F.lit(first) + F.make_dt_interval(secs=F.col("id") * 86399 / 619)).cast("timestamp_ntz").alias("seen_ts"))
    found = windows.bisect(rows, first, last, 250, 4).collect()
    assert len(found) == 7 and not any(r.truncated for r in found)


def test_load_keeps_the_first_day(spark, tmp_path):
    path = f"file://{tmp_path}/articles"
    schema = "url string, kst_date date, pos int"
    one = spark.createDataFrame([("a", date(2026, 9, 10), 1), ("a", date(2026, 9, 10), 2), ("", date(2026, 9, 10), 3)], schema)
    two = spark.createDataFrame([("a", date(2026, 9, 11), 1), ("b", date(2026, 9, 11), 2)], schema)
    assert tuple(load.load(spark, one, path, "pos").first()) == (1, 1, 1)
    assert tuple(load.load(spark, two, path, "pos").first()) == (1, 1, 2)
    assert tuple(load.load(spark, two, path, "pos").first()) == (0, 2, 2)
    assert {(r.url, str(r.kst_date)) for r in spark.read.parquet(path).collect()} == {("a", "2026-09-10"), ("b", "2026-09-11")}


def test_sources(spark, tmp_path):
    items = {"articles": [{"url": "https://www.A.kr:443/1", "title": "A &amp; B", "seendate": "20260911T010203Z", "domain": "", "language": "Korean"}, {"url": " ", "title": "x"}]}
    (tmp_path / "list.json").write_text(json.dumps(items))
    row = src.normalised(src.captured_list(spark, f"file://{tmp_path}/list.json")).first()
    assert (row.url, row.title, row.domain, row.seendate) == ("https://www.A.kr/1", "A & B", "a.kr", "20260911T010203Z")

    def line(code, title):
        f = [""] * 27
        f[1], f[3], f[4], f[25], f[26] = "20260911010000", "A.kr", "https://a.kr/1", f"srclc:{code};eng:x", f"<PAGE_TITLE>{title}</PAGE_TITLE>"
        return "\t".join(f)

    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        z.writestr("a.csv", "\n".join([line("kor", "AI &#44508;제"), line("kor", "none"), line("eng", "AI"), line("kor", "AIR"), "short"]))
    (tmp_path / "s.zip").write_bytes(data.getvalue())
    kept, counts = src.parse_slices(src.slice_lines(spark, f"file://{tmp_path}/s.zip"), r"(?<![a-z])ai(?![a-z])")
    assert [r.title for r in kept.collect()] == ["AI 규제"] and tuple(counts.first()) == (3, 1)


def test_settings(tmp_path):
    (tmp_path / "a.json").write_text('{"x": {"y": 1, "z": [1]}}')
    (tmp_path / "b.json").write_text('{"x": {"z": []}}')
    found = src.settings(str(tmp_path / "a.json"), str(tmp_path / "b.json"), str(tmp_path / "none.json"))
    assert found == {"x": {"y": 1, "z": []}} and src.setting(found, "x.z", [9]) == [] and src.setting(found, "x.q", 7) == 7
    assert src.overridden(found, {"HEADWATER_CFG__x__y": "5"})["x"]["y"] == 5
