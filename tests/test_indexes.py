"""The automaton of keywords against both matchers, and the index of keys behind a load."""

import random
from datetime import date

from pyspark.sql import functions as F

from headwater.functions import automaton, keywords
from headwater.operators import keyindex, load

DAY = date(2026, 9, 10)


def test_the_automaton_finds_what_the_matchers_find(spark, monkeypatch):
    rng = random.Random(1)
    parts = ["AI", "ai", "openai", "AIR", " ", " ", "-", "메타", "메타버스", "구글", "구", "법", "이", "3", "é", "GPT-4", ".", "데이터"]
    titles = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)] + ["", None, "메타버스 메타", "메타버스"]
    words = ["AI", "ai", "GPT-4", "메타", "메타버스", "구글", "구", "법", "데이터", " ", "", "openai", "é", "4", ".", "이 "]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "pos int, title string").repartition(3)
    plain = {}
    for rule, one in (("counts", keywords.counts), ("classifies", keywords.classifies)):
        plain[rule] = {r.pos: [i for i in range(len(words)) if r[f"k{i}"]] for r in rows.select("pos", *[one(F.col("title"), w).alias(f"k{i}") for i, w in enumerate(words)]).collect()}
        (found,) = automaton.with_keywords(rows, words, rule)
        assert found.columns == ["pos", "title", "found"] and {r.pos: r.found for r in found.collect()} == plain[rule]
    longest = {r.pos: (r.keyword, r.hits) for r in rows.select("pos", keywords.first_of(F.col("title"), words).alias("keyword"), keywords.hits(F.col("title"), words).alias("hits")).collect()}
    assert {r.pos: (r.keyword, r.hits) for r in automaton.classified(rows, words).collect()} == longest
    whole = sorted(automaton.keyword_counts(rows, words).collect())
    monkeypatch.setattr(automaton, "BLOCK", 3)
    assert sorted(automaton.keyword_counts(rows, words).collect()) == whole
    assert {r.keyword: r.n for r in whole}["AI"] == sum(0 in x for x in plain["counts"].values())
    assert automaton.classified(rows, []).where("hits > 0 or keyword is not null").collect() == []
    assert automaton.keyword_counts(rows.limit(0), ["a"]).collect() == [("a", 0)]


def test_fifty_thousand_keywords_in_one_pass(spark):
    words = [f"w{i}" for i in range(50_000)]
    rows = spark.range(2000).select(F.format_string("w%d and w%d, xw%d", F.col("id"), F.col("id") * 20, F.col("id")).alias("title"), (F.col("id") % 2).alias("day"))
    found = {(r.keyword, r.day): r.n for r in automaton.counted(rows, words, "day").collect()}
    want = {}
    for i in range(2000):
        for w in {i, 20 * i}:
            want[f"w{w}", i % 2] = want.get((f"w{w}", i % 2), 0) + 1
    assert found == want


def batch(spark, links, day=DAY):
    return spark.createDataFrame([(u, i, day) for i, u in enumerate(links)], "url string, pos int, kst_date date")


def test_a_load_reads_the_buckets_of_its_own_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyindex, "PER_BUCKET", 20)
    path = f"file://{tmp_path}/t"
    told = lambda rows: tuple(load.load(spark, rows, path, "pos").first())
    assert told(batch(spark, [f"u{i}" for i in range(300)] + ["u1", "", None, " "])) == (300, 1, 300)
    index = keyindex.KeyIndex(spark, path, "url")
    few = index.versions.latest()[1]["buckets"]
    assert told(batch(spark, [f"u{i}" for i in range(250, 1250)])) == (950, 50, 1250)
    state = index.versions.latest()[1]
    assert state["keys"] == 1250 and state["buckets"] > few and not state["loading"]
    # one link: the plan reads one of many folders, and no file of the table
    one = index.fresh(batch(spark, ["u7"]), state)
    read = one.inputFiles()
    assert read and len({f.split("bucket=")[1].split("/")[0] for f in read}) == 1 and all("_keys/" in f for f in read) and one.collect() == []
    assert told(batch(spark, ["u7", "new"], date(2026, 9, 11))) == (1, 1, 1251) and told(batch(spark, [])) == (0, 0, 1251)
    assert {r.url: r.kst_date for r in spark.read.parquet(path).collect()}["u7"] == DAY and spark.read.parquet(path).count() == 1251


def test_a_load_that_stopped_halfway_is_mended(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    load.load(spark, batch(spark, ["a", "b"]), path, "pos")
    index = keyindex.KeyIndex(spark, path, "url")
    number, state = index.versions.latest()
    # rows are in the table, but their keys aren't
    index.versions.commit(number, {**state, "loading": True})
    batch(spark, ["c"]).write.mode("append").partitionBy("kst_date").parquet(path)
    assert tuple(load.load(spark, batch(spark, ["c", "d"]), path, "pos").first()) == (1, 1, 4)
    # a table from before there were keys
    other = f"file://{tmp_path}/old"
    batch(spark, ["a", "b"]).write.partitionBy("kst_date").parquet(other)
    assert tuple(load.load(spark, batch(spark, ["b", "c"]), other, "pos").first()) == (1, 1, 3)
    monkeypatch.setattr(keyindex, "LOADS", 1)
    assert tuple(load.load(spark, batch(spark, ["x"]), other, "pos").first()) == (1, 0, 4)
    assert keyindex.KeyIndex(spark, other, "url").versions.latest()[1]["loads"] == 0
    assert tuple(load.load(spark, batch(spark, ["x", "a"]), other, "pos").first()) == (0, 2, 4)
    empty = f"file://{tmp_path}/empty"
    assert tuple(load.load(spark, batch(spark, []), empty, "pos").first()) == (0, 0, 0) and spark.read.schema("url string").parquet(empty).count() == 0
