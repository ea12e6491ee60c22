"""Literal rows for decisions, checks, brief, report, sources, messages and settings."""

import io
import json
import urllib.error
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from headwater import settings
from headwater.functions import text, timewin
from headwater.operators import brief, decisions, grouping, judging, load, quality, report, series
from headwater.plans import catalog
from headwater.sinks import messages
from headwater.sources import listing
from headwater.sources import articles as src

DAY = date(2026, 9, 11)


def values(spark, rows, *columns):
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_prose(spark):
    c = F.col("c")
    given = ["— 제목", "제목 —", "a — b", "GPT‑5 😀 x", " ,, a ,b,, ", None]
    assert values(spark, given, text.clean_prose(c)) == ["제목", "제목", "a, b", "GPT-5 x", "a,b", ""]
    assert values(spark, ["끝났다", "끝?", "", "a —"], text.sentence(c)) == ["끝났다.", "끝?", "", "a."]
    assert values(spark, ["abcdefgh", "abcd", "abc  efgh", None], text.capped(c, 7)) == ["abcd...", "abcd", "abc...", ""]
    long_ = "말 " * 40
    assert values(spark, ["[단독] <속보> 〔AI〕 (1) 새 모델 - 한국일보", "제목 | 매체…", "— 제목", long_, "x" * 70], text.trimmed_headline(c)) == ["(1) 새 모델", "제목", "제목", ("말 " * 30).strip(), "x" * 60]
    assert values(spark, ["— 제목", " "], text.headline_sentence(c, F.lit(1))) == ["'제목' 소식이 한 곳에서 나왔다", "'제목을 알 수 없는 기사' 소식이 한 곳에서 나왔다"]
    assert values(spark, ["&amp;lt; &lt;", "&amp;#39;s", '" a " b', "“ a ”", "it ' s ' x", " - ", "a , b ( c )"], text.clean_title(c)) == ["&lt; <", "'s", '"a" b', "“a”", "it 's' x", "-", "a, b (c)"]


def test_particles_numbers_and_widths(spark):
    c = F.col("c")
    assert values(spark, ["구글", "애플", "서울", "한국", "나무", "GPT4", "AI", "LLM", "BERT8"], text.particle(c, "으로", "로", "flmnrsx")) == ["로", "로", "로", "으로", "로", "로", "로", "으로", "로"]
    assert [report.particle(w, "으로", "로") for w in ("구글", "한국", "나무", "GPT4", "LLM", "BERT8", "")] == ["로", "으로", "로", "로", "으로", "로", "로"]
    assert values(spark, ["3.0", "3.46", "2.25"], text.one_decimal(c.cast("double")))[:2] == ["3", "3.5"]
    assert [brief.number(x) for x in (30, 30.46, "4")] == ["30", "30.5", "4"]
    assert values(spark, ["상태 ok", "ａ", "", None], text.display_width(c)) == [7, 2, 0, 0]
    assert values(spark, [" 12 ", "-3", "1.5", "x", "", None], text.as_count(c)) == [12, -3, None, None, None, None]
    assert values(spark, ["1.5", "x"], text.as_float(c)) == [1.5, None]
    assert values(spark, ['{"id": "x", "url": "u"}', "no", None], text.json_field(c, "none", "url")) == ["u", None, None]
    assert values(spark, ["secret-token", "short", " ", None], text.masked(c)) == ["se****", "****", "(없음)", "(없음)"]
    assert values(spark, ["call secret-token now"], text.scrubbed(c, ["secret-token", "now", ""])) == ["call se**** now"]
    lists = spark.createDataFrame([(["a", "b", "c", "d"],), (["a"],), ([],)], "c array<string>")
    assert [tuple(r) for r in lists.select(text.sample(c), text.keyword_line(c, 2)).collect()] == [("a, b, c 외 1건", "a · b 외 2개"), ("a", "a"), ("", "")]
    assert values(spark, ["2026-09-11"], text.weekday_label(c.cast("date"))) == ["2026-09-11 금요일"]
    assert timewin.days_between(date(2026, 9, 2), date(2026, 8, 31)) == [date(2026, 8, 31), date(2026, 9, 1), date(2026, 9, 2)]
    assert timewin.local_today(datetime(2026, 9, 10, 15)) == DAY == timewin.shifted(date(2026, 9, 10), 1)


def titles(spark, rows):
    df = spark.createDataFrame([(DAY, i, t, d) for i, (t, d) in enumerate(rows)], "kst_date date, pos long, title string, domain string")
    return df.withColumn("url", F.concat(F.lit("https://a.kr/"), "pos")).withColumn("tokens", text.tokens(F.col("title")))


def test_groups_of_copies_and_outlets(spark):
    rows = [("one two three four", "a.kr"), ("five six seven eight", ""), ("one two three nine", "b.kr"), ("one two three four", "a.kr"), ("four three two one", "c.kr"), ("five six seven eight", "")]
    t = titles(spark, rows)
    assert {r.pos: r.group_id for r in grouping.greedy_groups(t).collect()} == {0: 0, 2: 0, 3: 0, 4: 0, 1: 1, 5: 1}
    assert {r.group_id: r.medoid for r in grouping.medoids(grouping.greedy_groups(t), t).collect()} == {0: 0, 1: 1}
    found = {r.group_id: r for r in grouping.shaped_groups(t, ["one"], ["five"]).collect()}
    assert (found[0].place, found[0].kind, found[0].domain_count, found[0].article_count) == (1, "policy", 3, 4)
    assert (found[1].place, found[1].kind, found[1].domain_count, found[1].headline) == (2, "tool", 0, "'five six seven eight' 소식을 2개 매체가 다뤘다")
    assert found[0].urls == [f"https://a.kr/{i}" for i in (0, 2, 3, 4)]


def test_answers_of_a_model(spark):
    rows = [("정부 규제 발표", "a.kr"), ("새 도구 공개", "b.kr"), ("새 도구 공개함", ""), ("주식", "c.kr"), ("규제 규제안", "d.kr"), ("새 도구 출시", "e.kr")]
    own = titles(spark, rows).select("kst_date", (F.col("pos") + 1).cast("int").alias("n"), "url", "title", "domain")
    answer = {"판단": [{"번호": 1, "채택": True, "이유": " 좋다 "}, {"번호": "2", "채택": "true"}, {"번호": 3, "채택": 1}, {"번호": 4, "채택": False}, {"번호": 5, "채택": False}, {"번호": 5, "채택": True}, {"번호": 99, "채택": True}, {"번호": "x", "채택": True}], "묶음": [{"번호들": [1, 4, 99], "종류": "none", "제목": "규제 — 소식"}, {"번호들": [1, "2", 2, 3], "종류": "TOOL", "제목": ""}]}
    answers = spark.createDataFrame([(DAY, "말: " + json.dumps(answer, ensure_ascii=False) + " 끝"), (date(2026, 9, 12), "죄송"), (date(2026, 9, 13), "{}")], "kst_date date, body string")
    found = decisions.model_verdicts(answers, own)
    assert [(r.n, r.verdict, r.reason, r.said) for r in found.orderBy("n").collect()] == [
        (1, "kept", "좋다", True), (2, "kept", decisions.REASONS["kept"], True), (3, "kept", decisions.REASONS["kept"], True),
        (4, "dropped", decisions.REASONS["dropped"], True), (5, "kept", decisions.REASONS["kept"], True), (6, "dropped", decisions.REASONS["unsaid"], False),
    ]
    groups = decisions.model_groups(answers, found, ["규제"], ["도구"]).orderBy("group_id").collect()
    assert [(r.group_id, r.kind, r.headline, [int(u[-1]) + 1 for u in r.urls]) for r in groups] == [(0, "policy", "규제, 소식", [1]), (1, "tool", "'새 도구 공개' 소식이 한 곳에서 나왔다", [2, 3]), (2, "policy", "'규제 규제안' 소식이 한 곳에서 나왔다", [5])]
    bad = spark.createDataFrame([(DAY, '{"decisions": [{"index": 50, "keep": true}]}')], "kst_date date, body string")
    assert decisions.model_verdicts(bad, own).collect() == []


def test_decisions_are_reused_until_something_changes(spark, tmp_path):
    days = [date(2026, 9, d) for d in (10, 11)]
    rows = [(d, i, f"https://a.kr/{d.day}/{i}", t, datetime(2026, 9, 10, i)) for d in days for i, t in enumerate(["AI news", "stock AI", "rain"])]
    a = spark.createDataFrame(rows, "kst_date date, pos long, url string, title string, seen_ts timestamp_ntz")
    store = judging.tables(spark, f"file://{tmp_path}/decisions")
    words = judging.Words(["AI"], ["stock"], ["law"], ["tool"])
    run = lambda df, **k: {r.kst_date.day: r.reason for r in judging.judge_days(store, df, days, words, **k).collect()}
    a = a.withColumn("domain", F.lit("a.kr"))
    read = lambda: sorted(tuple(r) for r in store.read("decisions").collect())
    assert run(a) == {10: "none", 11: "none"} and run(a) == {10: "", 11: ""}
    first = read()
    assert len(first) == 6 and sum(r[1] == "kept" for r in first) == 2
    more = a.union(a.where("pos = 0 and day(kst_date) = 11").withColumn("url", F.lit("https://a.kr/new")).withColumn("pos", F.lit(9).cast("long")))
    assert run(more) == {10: "", 11: "count"}
    assert len(read()) == 7 and [r for r in read() if r[-1].day == 10] == [r for r in first if r[-1].day == 10]
    changed = more.withColumn("url", F.when(F.col("pos") == 9, "https://a.kr/other").otherwise(F.col("url")))
    assert run(changed) == {10: "", 11: "links"} and run(changed, wanted="llm") == {10: "backend", 11: "backend"} and run(changed, wanted="llm", force=True) == {10: "forced", 11: "forced"}
    # what the rules decided is never told as the model's, and asking the model again changes nothing
    told = {r.kst_date.day: (r.backend, r.requested_backend, r.fallback_reason) for r in store.read("runs").collect()}
    assert told == {d: ("rules", "llm", "no answer has landed") for d in (10, 11)} and run(changed, wanted="llm") == {10: "", 11: ""}
    # a day without articles any more is stored as an empty one
    assert run(changed.where("day(kst_date) = 10"), wanted="llm") == {10: "", 11: "count"} and {r[-1].day for r in read()} == {10}
    assert [r.kst_date.day for r in judging.stored_groups(store).collect()] == [10] and sorted(d.day for d in store.days()) == [10, 11]
    heads, links = decisions.flat_groups(spark.createDataFrame([(DAY, 0, "a — b", ["x", "y"], "ODD"), (DAY, 1, "c", [], "tool")], "kst_date date, group_id int, headline string, urls array<string>, kind string"))
    again = decisions.regrouped(heads, links)
    assert [(r.headline, r.kind, r.urls) for r in again.orderBy("group_id").collect()] == [("a, b", "other", ["x", "y"]), ("c", "tool", [])]
    kept = load.positioned(store.read("decisions").where("day(kst_date) = 10").withColumn("pos", F.col("position")))
    row = decisions.nested(kept, again.withColumn("kst_date", F.lit(days[0]))).first()
    assert [x.url[-1] for x in row.kept] == ["0"] and [x.reason for x in row.dropped] == ["exclude:stock", "no_interest"] and [g.urls for g in row.groups] == [["x", "y"], []]


def healthy(spark, **changes):
    rows = [{"url": f"https://a{i}.kr/{i}", "title": f"AI {i}", "domain": f"a{i}.kr", "seendate": f"2026091{0 if i else 1}T1{5 if i else 4}0000Z"} for i in range(3)]
    for k, v in changes.items():
        rows[1][k] = v
    return spark.createDataFrame(rows, "url string, title string, domain string, seendate string")


def by_name(df):
    return {r.check: (r.status, r.n, r.value, r.note) for r in df.collect()}


def test_checks_of_what_was_collected(spark):
    day, full = F.lit(DAY), spark.createDataFrame([(False, False)], "truncated boolean, blocked boolean")
    told = lambda **k: spark.createDataFrame([{"dropped_no_url": 0, "stray_dropped": 0, "duplicated": 0, "merged_distinct_urls": 0, **k}])
    assert {v[0] for v in by_name(quality.collected(healthy(spark), day, full)).values()} == {"ok"}
    assert by_name(quality.collected(healthy(spark).limit(0), day, full))["count"][0] == "fail"
    assert by_name(quality.collected(healthy(spark), day))["windows"][0] == "warn"
    capped = spark.createDataFrame([(True, False), (True, True), (False, None)], "truncated boolean, blocked boolean")
    assert by_name(quality.collected(healthy(spark), day, capped))["windows"] == ("fail", 1, None, "blocked=1")
    assert by_name(quality.collected(healthy(spark, seendate="20260912T150000Z"), day, full))["dates"][:3] == ("fail", 1, 0.333333)
    assert by_name(quality.collected(healthy(spark, seendate="soon"), day, full))["dates"][0] == "fail"
    blank = by_name(quality.collected(healthy(spark, seendate=" "), day, full))
    assert (blank["dates"][0], blank["fields"]) == ("ok", ("fail", 1, None, "url=0;title=0;domain=0;seendate=1"))
    # what the collector dropped is judged apart from what is in the list
    assert by_name(quality.collected(healthy(spark), day, full, told(stray_dropped=1)))["dates"][:3] == ("fail", 0, 0.25)
    many = healthy(spark).crossJoin(spark.range(10)).withColumn("url", F.concat("url", F.lit("/"), "id"))
    assert by_name(quality.collected(many, day, full, told(stray_dropped=1, duplicated=4, merged_distinct_urls=2)))["dates"][:3] == ("warn", 0, round(1 / 31, 6))
    assert by_name(quality.collected(healthy(spark, url="http://www.a0.kr/0/?utm_source=x"), day, full))["duplicates"][:2] == ("fail", 1)


def test_checks_of_what_was_stored(spark):
    day = F.lit(DAY)
    a = healthy(spark)
    daily = lambda *n: spark.createDataFrame([(date(2026, 9, 12 - len(n) + i), x) for i, x in enumerate(n)], "kst_date date, n long")
    judged = lambda *v: spark.createDataFrame([(x,) for x in v], "verdict string")
    found = by_name(quality.loaded(a, a, daily(3, 3, 3, 3), judged("kept", "dropped", "kept"), day))
    assert [v[0] for v in found.values()] == ["ok"] * 5 and found["volume"][1:3] == (3, 1.0)
    found = by_name(quality.loaded(a, a.limit(2), daily(6, 6, 6, 3), judged("dropped", "dropped", "dropped"), day))
    assert (found["load"][:2], found["volume"][:3], found["dropped"][:3], found["judged"][:2]) == (("warn", -1), ("warn", 3, 0.5), ("warn", 3, 1.0), ("fail", 1))
    found = by_name(quality.loaded(a, a, daily(3), judged(), day))
    assert (found["history"][0], found["volume"][0], found["dropped"][0], found["judged"][0]) == ("warn", "ok", "ok", "ok")
    assert series.recent_average(daily(1, 2, 3, 4), since=F.lit(date(2026, 9, 9)), least=1).where(F.col("kst_date") == day).first().avg_n == 2.5
    summary = quality.summary(quality.loaded(a, a.limit(2), daily(6, 6, 6, 3), judged("dropped"), day)).first()
    assert (summary.n_fail, summary.exit_code) == (1, 1)
    lines = [r.line for r in quality.table_lines(quality.collected(a, day)).orderBy("place").collect()]
    assert lines[0].startswith("점검       상태") and set(lines[1]) == {"-", " "} and len(lines) == 7


def test_brief(spark):
    groups = spark.createDataFrame([(DAY, 0, "규제 소식", ["https://www.a.kr:443/1", "https://m.a.kr/2", "https://b.kr/3"], "policy"), (DAY, 1, "도구", ["https://c.kr/1"], "tool"), (DAY, 2, "", [], "other"), (DAY, 3, "큰 소식", ["https://d.kr/1", "https://e.kr/1"], "ODD")], "kst_date date, group_id int, headline string, urls array<string>, kind string")
    known = spark.createDataFrame([("https://d.kr/1", "E.kr")], "url string, domain string")
    later = spark.createDataFrame([("https://d.kr/1", "z.kr"), ("https://b.kr/3", "")], "url string, domain string")
    p = brief.prepared(groups, brief.domain_map(known, later))
    rows = [r.asDict() for r in p.orderBy("place").collect()]
    assert [(r["group_id"], r["domain_count"], r["article_count"], r["kind"]) for r in rows] == [(0, 2, 3, "policy"), (3, 1, 2, "other"), (1, 1, 1, "tool")]
    assert rows[0]["link"] == "https://www.a.kr/1" and rows[1]["domains"] == ["e.kr"] and rows[0]["headline"] == "규제 소식."
    shown = [r.asDict() for r in brief.sections(p, 2).collect()]
    told = brief.notes(p, 2).first().asDict()
    assert (told["total"], told["multi"], told["shown"], told["cut"], told["too_few"]) == (3, 1, 2, True, False)
    out = brief.build("2026-09-11 금요일", shown, {"article_count": 12, "avg_7d": 10.0, "days_used": 7, "first_seen": [f"k{i}" for i in range(10)]}, told)
    assert out["markdown"].startswith("## 2026-09-11 금요일 AI 뉴스 브리핑\n\n규제 소식.\n어제 이 소식을 다룬 매체가 2곳으로 가장 많았다.\n링크: https://www.a.kr/1\n\n어제 모인 기사는 12건이다. 최근 7일 평균 10건보다 2건 많다.\n어제 나온 소식은 3개이고 두 곳 이상이 함께 다룬 소식은 1개였다. 브리핑에는 2개만 올렸다.\n")
    assert "k7 외 2개" in out["markdown"] and "### 그 밖의 묶음\n\n- 큰 소식.\n  매체 1곳 · https://d.kr/1\n" in out["markdown"] and out["markdown"].endswith("\n") and out["group_shown"] == 2
    quiet = brief.build("2026-09-11 금요일", [], {"article_count": 0, "avg_7d": 5.0})
    assert quiet["summary_line"].endswith("모이지 않았다.") and "###" not in quiet["markdown"]
    assert brief.volume_sentence(5, 0, 0).endswith("견주지 않았다.") and brief.volume_sentence(5, 5.5) == "어제 모인 기사는 5건이다. 최근 7일 평균 5.5건과 비슷하다." and brief.volume_sentence(None, 3) == ""


def test_report(spark):
    days = [date(2026, 9, 7), date(2026, 9, 9)]
    groups = spark.createDataFrame([(days[0], days[1], 0, "도구 — 공개", "tool", ["b", "a"]), (days[0], days[0], 3, "도구, 공개", "tool", ["https://a.kr:443/1", "b"]), (days[0], days[0], 1, " — ", "tool", ["x"]), (days[0], days[1], 2, "새 도구", "tool", [])], "week date, kst_date date, group_id int, headline string, kind string, urls array<string>")
    merged = report.merge_headlines(groups)
    assert [(r.headline, r.first_date, r.urls) for r in merged.orderBy("first_date").collect()] == [("도구, 공개", days[0], ["https://a.kr:443/1", "b", "a"]), ("새 도구", days[1], [])]
    lines = [r.line for r in report.group_lines(merged).orderBy("line_no").collect()]
    assert lines == ["- 09-07 도구, 공개 (기사 3건, 대표 링크 https://a.kr/1)", "- 09-09 새 도구 (대표 링크가 없다)"]
    a = spark.createDataFrame([(date(2026, 9, d), t) for d, t in ((7, "구글 AI"), (8, "구글"), (2, "AI"), (13, "AI"), (14, "AI"))], "kst_date date, title string")
    entries = report.keyword_entries({"keywords": {"list": [{"keyword": "구글", "roman": "Google"}, "AI", "none", "AI"]}})
    assert [e["name"] for e in entries] == ["구글", "AI", "none"] and report.keyword_entries({}) == []
    rows = [r.asDict() for r in report.week_rows(a, entries, date(2026, 9, 7), 5).collect()]
    assert [(r["keyword"], r["this_week"], r["last_week"], r["delta_text"], r["note"]) for r in rows] == [("AI", 2, 1, "+1", ""), ("구글", 2, 0, "+2", "new")]
    words = report.markdown(date(2026, 9, 7), rows, {"tool": lines}, 20, 12, ["2026-09-08"], source="s")
    assert "AI가 남긴 기사는 20건, 지난주는 12건이다. 8건 늘었다." in words and "키워드는 AI로 2건이다. 지난주보다 1건 늘었다." in words and "키워드는 구글이다." in words and "| AI | 2 | 1 | +1 |" in words
    alone = report.markdown(date(2026, 9, 7), rows, {}, 20, None)
    assert "견주지 않는다." in alone and "| AI | 2 |" in alone and "올라온" not in alone
    commented = words.replace(">\n>", "> 내가 쓴 글\n> 둘째 줄")
    assert report.human_comments(commented) == ["> 내가 쓴 글", "> 둘째 줄"] and report.human_comments(words) == [] and report.human_comments("") == []
    newer = words.replace("20건", "21건")
    assert "> 내가 쓴 글\n> 둘째 줄" in report.replaced(commented, newer) and report.replaced(words, newer) is None and report.replaced(words, newer, True) == newer == report.replaced(None, newer)
    assert [d.day for d in report.week_days(date(2026, 9, 10))] == list(range(7, 14))
    picture = report.bar_chart(rows, hangul=False)
    assert ">Google<" in picture and ">구글<" not in picture and picture.count("<rect") == 4 and ">구글<" in report.bar_chart(rows)
    weeks = spark.createDataFrame([(date(2026, 9, d), "kept", f"u{d}") for d in (1, 8, 9, 22)], "kst_date date, verdict string, url string")
    assert [(r.n_kept, r.last_kept, r["diff"]) for r in report.weekly_volume(weeks).orderBy("week").collect()] == [(1, None, None), (2, 1, 1), (1, None, None)]


class Answer(io.BytesIO):
    status = 200


def test_lists_of_a_service(spark):
    assert listing.address("AI OR 인공지능", "20260910150000", "20260911145959", 9, "http://x").startswith("http://x?query=AI%20OR%20%EC%9D%B8")
    slept, bodies = [], [b"", b"<html>", urllib.error.HTTPError("u", 429, "busy", {}, io.BytesIO(b"wait")), b'{"articles": [{"title": "a\tb"}]}']

    def opener(request, timeout):
        found = bodies.pop(0)
        if isinstance(found, Exception):
            raise found
        return Answer(found)

    assert listing.fetch("http://x", opener, 5, (30, 90, 180, 300), slept.append) == {"articles": [{"title": "a\tb"}]}
    assert slept == [5, 30, 90, 180]
    bodies[:] = [b""] * 3
    with pytest.raises(listing.RateLimited):
        listing.fetch("http://x", opener, 0, (1, 0, 2), slept.append)
    bodies[:] = [urllib.error.HTTPError("u", 500, "no", {}, io.BytesIO(b""))]
    with pytest.raises(listing.FetchError) as told:
        listing.fetch("http://x", opener, 0)
    assert not isinstance(told.value, listing.RateLimited)
    assert listing.parse("[1]") == {"articles": [1]}
    with pytest.raises(listing.RateLimited):
        listing.parse("3")
    rows = [("a", '{"articles":[{"url":"u","title":"x\ty"},{"url":""}]}'), ("b", '[{"url":"v"}]'), ("c", " "), ("d", "<html>"), ("e", '{"articles":'), ("f", "{}")]
    found = listing.parsed_answers(spark.createDataFrame(rows, "k string, body string"))
    assert {r.k: (r.state, len(r.articles)) for r in found.collect()} == {"a": ("ok", 2), "b": ("ok", 1), "c": ("rate_limited", 0), "d": ("rate_limited", 0), "e": ("rate_limited", 0), "f": ("ok", 0)}
    assert tuple(listing.counted_items(found).first()) == (3, 1)
    assert [(r.k, r.place, r.url) for r in listing.in_source_order(found, 1).orderBy("k").collect()] == [("a", 0, "u"), ("b", 0, "v")]


def test_downloads_land_and_gate_the_day(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.zip").write_bytes(b"one")
    slices = spark.createDataFrame([(str(i), f"file://{tmp_path}/in/{i}.zip") for i in (1, 2)], "stamp string, url string")
    found = {r.stamp: (r.state, r.bytes) for r in listing.download(slices, f"file://{tmp_path}/out").collect()}
    assert found == {"1": ("landed", 3), "2": ("missing", 0)} and (tmp_path / "out/1.zip").read_bytes() == b"one"
    expected, landed = slices.select("stamp"), slices.where("stamp = '1'").select("stamp")
    assert [r.stamp for r in src.missing_slices(expected, landed, 1).collect()] == ["2"]
    with pytest.raises(RuntimeError):
        src.missing_slices(expected, landed, 0)


def test_messages_and_pages(tmp_path):
    assert messages.message(None)["text"] and messages.message("x") == {"text": "x"} and messages.message({"markdown": "m"}) == {"text": "m"}
    assert messages.message({"markdown": "m", "slack_blocks": [1], "summary_line": "s"}) == {"blocks": [1], "text": "s"}
    sent = []
    poster = lambda url, body: sent.append(body) or (500, f"bad {url} " + "x" * 300)
    assert messages.send("x", "https://hook/secret")["status"] == "dry_run" and messages.send("x", None, False)["status"] == "skipped"
    out = messages.send("x", "https://hook/secret", False, poster)
    assert out["status"] == "failed" and "secret" not in out["response"] and len(out["response"]) == 200 and sent == [{"text": "x"}]
    kinds = [b["type"] for b in messages.blocks("# a\n#### b\n> c\n* d\n1) e\n---\nplain **bold** [l](http://x) ![p](y.png)\n\n")]
    assert kinds == ["heading_1", "heading_3", "quote", "bulleted_list_item", "numbered_list_item", "divider", "paragraph"]
    parts = messages.blocks("plain **bold** [l](http://x) ![p](y.png)")[0]["paragraph"]["rich_text"]
    assert [(p["text"]["content"], p["annotations"]["bold"], (p["text"]["link"] or {}).get("url")) for p in parts] == [("plain ", False, None), ("bold", True, None), (" ", False, None), ("l", False, "http://x"), (" ", False, None), ("p", False, None)]
    assert len(messages.pieces("x" * 4001)) == 3
    bodies = messages.page_requests("p", "t", "\n".join("- x" for _ in range(250)))
    assert [len(b["children"]) for b in bodies] == [100, 100, 50] and "parent" in bodies[0] and "parent" not in bodies[1]
    one = lambda i, body, page: (200, '{"id": "new"}') if i < 1 else (400, "no token-123")
    assert messages.send_page("p", "t", "- x\n" * 150, one, False, "token-123") == {"status": "partial", "sent": 1, "page_id": "new", "code": 400, "response": "no to****"}
    assert messages.send_page("p", "t", "x", one, False)["status"] == "sent" and messages.send_page("p", "t", "x")["status"] == "dry_run"
    assert messages.failure(ValueError("x")) == "ValueError: x" and messages.failure({"checks": [{"check": "dates", "status": "fail"}, {"check": "b", "status": "ok"}]}) == "dates" and messages.failure("y") == "y"
    assert open(messages.save_text("é", f"{tmp_path}/a/b.md"), encoding="utf-8").read() == "é\n"


def test_audit_document(spark, tmp_path):
    windows = spark.createDataFrame([("a", "b", 3), ("b", "c", 4)], "start string, end string, count int")
    messages.raw_audit(windows, spark.createDataFrame([(2,)], "duplicated int"), "AI", f"file://{tmp_path}/raw")
    assert sorted((r.start, r["count"], r.duplicated, r.query) for r in spark.read.json(f"file://{tmp_path}/raw").collect()) == [("a", 3, 2, "AI"), ("b", 4, 2, "AI")]


def test_settings(tmp_path):
    (tmp_path / "config").mkdir()
    (tmp_path / "config/settings.json").write_text('{"brief": {"max_groups": 7}, "paths": {"raw_dir": "/abs"}}')
    (tmp_path / "config/keywords.json").write_text('{"keywords": ["AI", {"keyword": "구글"}, "AI", 3], "exclude": []}')
    env = {"HEADWATER_MAXRECORDS": "100", "HEADWATER_DRY_RUN": "아니오", "HEADWATER_QUERY": " ", "HEADWATER_CFG__judge__model": "m", "HEADWATER_CFG__report__x": "[1]", "NOTION_TOKEN": "t"}
    found = settings.load(str(tmp_path), env)
    assert (found["maxrecords"], found["notify"]["dry_run"], found["query"], found["judge"]["model"], found["report"]["x"], found["brief"]["max_groups"], found["brief"]["min_groups"]) == (100, False, "", "m", [1], 7, 3)
    assert found["paths"]["raw_dir"] == "/abs" and found["paths"]["briefs_dir"] == f"{tmp_path.resolve()}/data/briefs" and found["secrets"] == {"slack_webhook": False, "notion_token": True, "notion_parent_page_id": False}
    assert settings.watch_keywords(found) == ["AI", "구글"] and settings.word_list(found, "exclude", ["x"]) == [] and settings.word_list(found, "interest", ["x"]) == ["x"]
    for bad in ({"HEADWATER_MAXRECORDS": "many"}, {"HEADWATER_DRY_RUN": "maybe"}):
        with pytest.raises(ValueError):
            settings.load(str(tmp_path), bad)
    assert settings.placed({"a": {"b": 1}}, "a.c.d", 2) == {"a": {"b": 1, "c": {"d": 2}}}


def test_names_of_queries_and_sql_are_the_same():
    from headwater.plans import daily  # noqa: F401

    assert set(catalog.QUERIES) == set(catalog.SQL)
