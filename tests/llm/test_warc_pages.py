"""A page_id with several payloads: only rows whose payload came before are revisits."""

import hashlib

from headwater.llm import warc


def test_unique_payload_of_a_repeated_page_id_is_archived(spark):
    rows = [(1, "u", "same"), (2, "u", "same"), (2, "u", "own text"), (3, "u", "own"), (None, "u", "same"), (None, "u", "null's own")]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(1, "same", "revisit"), (2, "same", "revisit"), (2, "own text", "response"), (3, "own", "response"), (None, "same", "response"), (None, "null's own", "response")]
    digest = lambda t: warc.base32(hashlib.sha1(t.encode()).digest())
    assert sorted((str(r.page_id), r.payload_digest, r.record_type, r.payload_bytes) for r in found) == sorted((str(p), digest(t), kind, len(t)) for p, t, kind in want)


def test_repeated_rows_of_the_first_page(spark):
    """One response, and the others of its payload revisit it."""
    rows = [(1, "b", "same"), (1, "a", "same"), (1, "a", "same"), (2, "c", "same"), (None, "n", "x"), (None, "n", "x")]
    found = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in found) == [("1", "response", "None"), ("1", "revisit", "1"), ("1", "revisit", "1"), ("2", "revisit", "1"), ("None", "response", "None"), ("None", "revisit", "None")]


def test_a_task_for_each_archive(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE", 1)
    folder, files = warc.write(spark.createDataFrame([(i, None, f"page {i}") for i in range(5)], "page_id long, url string, html string"))
    table = warc.read(spark, folder, files)
    assert table.rdd.getNumPartitions() == files.count()
    assert sorted(r.page_id for r in table.collect()) == list(range(5))
