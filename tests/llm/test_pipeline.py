import random

import corpus_pipeline as pipeline
from headwater.llm import quality_rules
from tests.llm import brute

STOP = ["the", "of", "and", "to"]


def texts(seed=3):
    rng = random.Random(seed)
    prose = lambda n: [rng.choice(STOP) if rng.random() < 0.3 else f"word{rng.randrange(4000)}" for _ in range(n)]
    whole, passage, leak = prose(200), prose(60), prose(30)
    near = whole[:100] + ["changed"] + whole[101:]
    clean = [prose(150) for _ in range(6)]
    rows = [None, "", "too short", "## " * 100, whole, near, whole, clean[0] + passage, clean[1] + passage, clean[2] + leak + clean[3], *clean[4:]]
    return [t if t is None or isinstance(t, str) else " ".join(t) for t in rows], " ".join(leak)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), True, "row") for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, kept boolean, verdict string")


def test_keep_is_the_verdict_of_the_query(spark):
    docs = frame(spark, texts()[0])
    want = {r.doc_id for r in quality_rules.quality_rules(docs).collect() if r.kept}
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == want == set(range(4, 12))
    assert quality_rules.keep(docs.limit(0)).collect() == []


def test_stages(spark, tmp_path):
    rows, leak = texts()
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, found = docs.columns, []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert i == len(pipeline.STAGES) - 1 or docs.columns == columns
        found.append({r.doc_id: r for r in docs.collect()})
    ids = [sorted(x) for x in found]
    near = brute.jaccard([(d, rows[d]) for d in ids[0]])
    assert ids[0] == list(range(4, 12)) and ids[1] == sorted({least for _, least in near.values()}) == [4, 7, 8, 9, 10, 11]
    plain = brute.substring_dedup([(d, rows[d]) for d in ids[1]])
    assert {d: brute.sha(b" ".join(r.text.encode().split())) for d, r in found[2].items()} == {d: x[2] for d, x in plain.items()}
    assert all(r.n_chars == len(r.text) for r in found[2].values()) and plain[8][1] == 60
    assert ids[3] == [4, 7, 8, 10, 11] == ids[4]
    assert all(r.text_sha256 == brute.sha(found[3][d].text.encode()) for d, r in found[4].items())
    assert sorted(pipeline.run(spark, str(tmp_path)).collect()) == sorted(found[4].values())
