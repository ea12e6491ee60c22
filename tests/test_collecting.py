"""The slice source with its gate and its stream, and the frontier of windows with blocked ones and empty days."""

import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from headwater.functions import timewin
from headwater.operators import frontier
from headwater.sources import listing, slicesource
from headwater.sources.articles import parse_slices

DAY = date(2026, 9, 11)
FIRST, LAST = timewin.day_window(DAY)
STAMPS = slicesource.stamps_between(FIRST.strftime(slicesource.FORM), LAST.strftime(slicesource.FORM))


def line(i, title, code="kor"):
    columns = [""] * 27
    columns[1], columns[3], columns[4] = STAMPS[i], "A.kr", f"https://a.kr/{i}/{len(title)}"
    columns[25], columns[26] = f"srclc:{code};eng:x", f"<PAGE_TITLE>{title}</PAGE_TITLE>"
    return "\t".join(columns)


def land(folder, stamps, name="{}.translation.gkg.csv.zip"):
    folder.mkdir(exist_ok=True)
    for s in stamps:
        i = STAMPS.index(s)
        with zipfile.ZipFile(folder / name.format(s), "w") as z:
            z.writestr("x.csv", "\n".join([line(i, "AI 소식 &amp; 더"), line(i, "AIR"), line(i, "다른 소식"), line(i, "AI", "eng"), line(i, "인공&#51648;능"), "broken\tline"]))


def test_a_day_of_slices(spark, tmp_path):
    land(tmp_path / "l", STAMPS[:90])
    rows = slicesource.read_day(spark, f"file://{tmp_path}/l", DAY)
    kept, counts = parse_slices(rows, r"(?<![a-z])AI(?![a-z])|인공지능")
    assert counts.first()[:2] == (90 * 4, 90 * 2) and {r.title for r in kept.collect()} == {"AI 소식 & 더", "인공지능"}
    assert kept.first().domain == "a.kr" and len(STAMPS) == 96
    # three are no archives: nine are missing
    for s in STAMPS[:3]:
        (tmp_path / "l" / f"{s}.translation.gkg.csv.zip").write_bytes(b"not a zip")
    with pytest.raises(Exception, match="9 of 96 slices are missing"):
        slicesource.read_day(spark, f"file://{tmp_path}/l", DAY).count()
    assert slicesource.read_day(spark, f"file://{tmp_path}/l", DAY, 9).count() == 87 * 6
    with pytest.raises(Exception, match="96 of 96"):
        slicesource.read_day(spark, f"file://{tmp_path}/nothing", DAY).count()


def test_conditions_on_the_stamp_choose_files(spark, tmp_path):
    slicesource.register(spark)
    land(tmp_path / "l", STAMPS[:6], "{}.ZIP")
    (tmp_path / "l" / "other.txt").write_text("x")
    rows = spark.read.format("slices").option("path", f"file://{tmp_path}/l").load()
    for condition, want in (
        (F.col("stamp") >= STAMPS[4], STAMPS[4:6]), (F.col("stamp") > STAMPS[4], STAMPS[5:6]), (F.col("stamp") <= STAMPS[1], STAMPS[:2]), (F.col("stamp") < STAMPS[1], STAMPS[:1]),
        (F.col("stamp") == STAMPS[2], STAMPS[2:3]), (F.col("stamp").isin(STAMPS[0], STAMPS[3]) & (F.col("stamp") > STAMPS[0]), STAMPS[3:4]), (F.col("stamp").startswith("x"), []),
    ):
        own = rows.where(condition)
        assert sorted({r.stamp for r in own.select("stamp").collect()}) == want
        # a partition for each file that is read
        if want and len(want) < 3 and condition is not None:
            assert own.rdd.getNumPartitions() <= 2
    with pytest.raises(Exception, match="path"):
        spark.read.format("slices").load().count()


def test_the_stream_waits_for_late_slices(tmp_path):
    land(tmp_path / "l", STAMPS[:3] + STAMPS[4:6])
    reader = slicesource.SliceStream({"path": f"file://{tmp_path}/l", "patience": "3"})
    names = lambda a, b: [STAMPS.index(p.stamp) for p in reader.partitions(a, b)]
    zero, one = reader.initialOffset(), reader.latestOffset()
    assert names(zero, one) == [0, 1, 2]
    land(tmp_path / "l", STAMPS[3:4])
    two = reader.latestOffset()
    assert names(one, two) == [3, 4, 5] and names(two, two) == []
    # a gap is passed over once it is more than three slices behind
    land(tmp_path / "l", STAMPS[7:10])
    assert reader.latestOffset() == two
    land(tmp_path / "l", STAMPS[10:11])
    assert names(two, reader.latestOffset()) == [7, 8, 9, 10]


class Source:
    """620 articles evenly over the day, and a window that may be refused."""

    def __init__(self, refused=(), n=620):
        self.refused, self.n = refused, n

    def __call__(self, start, end, cap):
        if (start, end) in self.refused or start in self.refused:
            raise listing.RateLimited("asked too often")
        step = timedelta(days=1) / max(self.n, 1)
        times = [(i, (FIRST + step * i).strftime("%Y%m%d%H%M%S")) for i in range(self.n)]
        rows = [{"url": f"https://a{i % 5}.kr/n?id={i}", "title": f"AI {i}", "seendate": at} for i, at in times if start <= at <= end]
        return {"articles": rows[::-1][:cap]}


def test_a_full_day_is_halved(spark, tmp_path):
    found, answers = frontier.collect(spark, Source(), FIRST, LAST, f"file://{tmp_path}/a", 250)
    rows = {r.n: r for r in found.collect()}
    assert len(rows) == 7 and {n for n, r in rows.items() if r.split} == {1, 2, 3} and not any(r.truncated or r.blocked for r in rows.values())
    assert frontier.items(answers).select("url").distinct().count() == 620
    # no deeper than asked
    shallow, _ = frontier.collect(spark, Source(), FIRST, LAST, f"file://{tmp_path}/b", 250, depth=1)
    assert sorted((r.n, r.truncated, r.reason) for r in shallow.collect() if r.truncated) == [(n, True, "the deepest level is reached") for n in (2, 3)]


def test_a_refused_half_stays_blocked_and_the_other_goes_on(spark, tmp_path):
    middle = (FIRST + timedelta(seconds=int((LAST - FIRST).total_seconds()) // 2)).strftime("%Y%m%d%H%M%S")
    found, answers = frontier.collect(spark, Source([middle]), FIRST, LAST, f"file://{tmp_path}/a", 250)
    rows = {r.n: r for r in found.collect()}
    assert set(rows) == {1, 2, 3, 4, 5} and rows[3].blocked and rows[3].reason == "asked too often" and not rows[3].split
    assert sorted(r.state for r in answers.collect()) == ["ok"] * 4 + ["rate_limited"]
    with pytest.raises(frontier.Blocked, match="asked too often"):
        frontier.collect(spark, Source([FIRST.strftime("%Y%m%d%H%M%S")]), FIRST, LAST, f"file://{tmp_path}/b", 250)


class EmptyOnce:
    """Says nothing the first time, as it leaves a mark in a folder that all tasks see."""

    def __init__(self, mark, body):
        self.mark, self.body = mark, body

    def __call__(self, start, end, cap):
        from pathlib import Path

        if not Path(self.mark).exists():
            Path(self.mark).write_text("asked")
            return {"articles": []}
        return self.body


def test_an_empty_day_is_asked_for_again(spark, tmp_path):
    one = '{"articles": [{"url": "u", "title": "t", "seendate": "20260911T000000Z"}]}'
    found, answers = frontier.collect(spark, EmptyOnce(str(tmp_path / "m"), one), FIRST, LAST, f"file://{tmp_path}/a")
    assert [(r.n, r["count"]) for r in found.collect()] == [(1, 1)] and frontier.items(answers).first().url == "u"
    nothing, _ = frontier.collect(spark, Source(n=0), FIRST, LAST, f"file://{tmp_path}/b")
    assert [(r["count"], r.blocked) for r in nothing.collect()] == [(0, False)]
    with pytest.raises(frontier.Blocked, match="isn't a list"):
        frontier.collect(spark, EmptyOnce(str(tmp_path / "m"), "<html>busy"), FIRST, LAST, f"file://{tmp_path}/c")


def test_a_short_window_is_not_halved(spark, tmp_path):
    at = datetime(2026, 9, 10, 15)
    found, _ = frontier.collect(spark, Source(), at, at + timedelta(seconds=1), f"file://{tmp_path}/a", 1)
    assert [(r.truncated, r.reason) for r in found.collect()] == [(True, "the window can't be halved")]
