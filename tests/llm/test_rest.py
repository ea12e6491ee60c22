import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from headwater.llm import bpe, class_lm, decontaminate, quality_rules, sharding, token_counts, tokenizer_files, warc

ODD = [None, "", " \n\t ", "a<|endoftext|>b", "it's I'LL we've", "日本語 １２３", "é ß İ", "a  b   c\t\td\r\n", "😀😀 x👍🏽", "\x00\x01", "x" * 3000, "  " * 200, "the cat " * 60]
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def frame(spark, texts=ODD):
    return spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, w int")


def test_bpe_is_the_library(spark):
    own = Tokenizer.from_file(tokenizer_files.path("byte_bpe_50k.json"))
    for r in bpe.encode_decode(frame(spark)).collect():
        want = own.encode(ODD[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want
        assert r.decoded == own.decode(want, skip_special_tokens=False) == (ODD[r.doc_id] or "")
    assert bpe.encode_decode(frame(spark).limit(0)).collect() == []


def test_token_counts_are_the_library(spark):
    own = Tokenizer.from_file(tokenizer_files.path("word_bpe_49k.json"))
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.token_counts(frame(spark)).collect()}
    assert found == {i: (len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(ODD)}


def test_token_counts_of_a_model_file_and_of_repeated_rows(spark):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=tokenizer_files.path("piece_bpe_32k.model"))
    found = {r.doc_id: r.n_tokens for r in token_counts.token_counts(frame(spark), "piece_bpe_32k.model").collect()}
    assert found == {i: len(own.encode(t or "")) for i, t in enumerate(ODD)}
    rows = spark.createDataFrame([(None, "a b"), (None, "a b"), (None, "other"), (3, "a b")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_bytes) for r in token_counts.token_counts(rows).collect()) == [("3", 3), ("None", 3), ("None", 3), ("None", 5)]
    assert token_counts.token_counts(rows.limit(0)).collect() == []


def test_the_table_holds_the_frequent_runs_of_the_corpus(spark, monkeypatch):
    texts = ["the cat the dog"] * 30 + ["the odd one " + "x" * 90] * 9
    assert token_counts.frequent(frame(spark, texts), 3) == [b"the", b"cat", b"dog"]
    # a sample of a few rows, or of none, changes the table but no result
    monkeypatch.setattr(token_counts, "SAMPLE_ROWS", 4)
    sampled = token_counts.token_counts(frame(spark)).collect()
    monkeypatch.setattr(token_counts, "TABLE_WORDS", 0)
    assert sorted(sampled) == sorted(token_counts.token_counts(frame(spark)).collect())
    plain = token_counts.token_counts(frame(spark)).collect()
    monkeypatch.setattr(token_counts, "TABLE_WORDS", 50)
    assert sorted(plain) == sorted(token_counts.token_counts(frame(spark)).collect())


def test_warc_round_trip(spark, monkeypatch):
    html = ["<p>a</p>", None, "", "<p>a</p>", "x\r\n\r\ny" * 400_000, "é"]
    pages = spark.createDataFrame([(i, None if i == 2 else f"http://a/{i} z", h, "q") for i, h in enumerate(html)], "page_id long, url string, html string, digest string")
    first = {}
    for r in sorted(warc.round_trip(pages).collect()):
        data = (html[r.page_id] or "").encode()
        seen = first.setdefault(data, r.page_id)
        want = (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if seen == r.page_id else "revisit", None if seen == r.page_id else seen)
        assert (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) == want
    assert warc.round_trip(pages.limit(0)).collect() == []
    folder, files = warc.write(pages)
    chunks = warc.read(spark, folder, files).where("page_id = 4").orderBy("chunk_no").collect()
    assert len(chunks) > 1 and max(len(r.chunk) for r in chunks) <= warc.CHUNK and b"".join(r.chunk for r in chunks) == html[4].encode()


def test_sharding(spark):
    rows = sharding.shard(frame(spark, ["a", None, "é"] * 300), 8).collect()
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert all((r.size, r.text_crc32) == (len(t) + 1, zlib.crc32(t)) for r in rows for t in [(["a", "", "é"][r.doc_id % 3]).encode()])
    weighted = [r.shard for r in sharding.shard(frame(spark, ["a"] * 2000), 2, [3.0, 1.0]).collect()]
    assert 0.7 < weighted.count(0) / 2000 < 0.8


def plain_shard(key, names, weights):
    """Rendezvous hashing by the definition, over the public hash function."""
    draws = []
    for i, (name, w) in enumerate(zip(names, weights, strict=True)):
        h = xxhash.xxh64_intdigest(name.encode(), xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42))
        draws.append((-math.log(((h >> 11) + 0.5) / 2**53) / w, i))
    return min(draws)[1]


def test_sharding_against_the_definition(spark):
    rows = [(i * 7 - 50, "a", "s", 1) for i in range(300)] + [(None, "x", "s", 1), (None, "y", "s", 1), (4, "b", "s", 1), (4, "b", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")
    weights = [1.0, 2.0, 0.5]
    for r in sharding.shard(docs, 3, weights).collect():
        key = -(2**63) if r.doc_id is None else r.doc_id
        assert r.shard == plain_shard(key, sharding.names(3), weights)
        assert r.grown_shard == plain_shard(key, sharding.names(4), [*weights, 1.0])
    assert sharding.shard(docs.limit(0), 3).collect() == []


def lower(t):
    return bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode())


def test_class_lm(spark):
    rng = random.Random(2)
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    texts = [" ".join(rng.choice(side) for _ in range(60)) for side in [a, b] * 60] + [None, "new WORDS", "A1 a2"]
    docs = frame(spark, texts)
    found = class_lm.score(docs, class_lm.fit(docs, top=64, classes=8)).collect()
    train = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 7 != 2]
    count = {}
    for i in train:
        for w in [*WORDS.findall(lower(texts[i])), b"\n"]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    for r in found:
        tokens = [*WORDS.findall(lower(texts[r.doc_id])), b"\n"]
        base = sum(np.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in tokens)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id not in train, len(tokens), sum(w in count for w in tokens), n)
        assert r.base_score == pytest.approx(base)
    held = [r for r in found if r.held_out and r.n_tokens > 50]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_decontaminate(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("ab") + str(rng.randrange(30))
    items = [" ".join(word() for _ in range(k)) for k in (3, 9, 10, 11, 40, 0)] + [None]
    texts = [*ODD, *[" ".join([word() for _ in range(20)] + items[rng.randrange(5)].upper().split()[: rng.randrange(1, 40)] + [word() for _ in range(15)]) for _ in range(60)]]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    cut = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", lower(t).decode())
    for r in decontaminate.decontaminate(frame(spark, texts), bench).collect():
        w, hit, ids = cut(texts[r.doc_id]), set(), set()
        for i, item in enumerate(map(cut, items)):
            m = min(10, len(item))
            keys = {tuple(item[j : j + m]) for j in range(len(item) - m + 1)} if m else set()
            for j in range(len(w) - m + 1):
                if m and tuple(w[j : j + m]) in keys:
                    hit.update(range(j, j + m))
                    ids.add(str(i))
        assert (r.n_words, r.n_hit, r.item_ids, r.contaminated) == (len(w), len(hit), sorted(ids), bool(hit))
    assert decontaminate.decontaminate(frame(spark), bench.limit(0)).where("contaminated").count() == 0


def test_decontaminate_rows_by_their_texts(spark):
    """Rows without a doc_id, with one in common, repeated, empty tables, a very long text, and joins without broadcasts."""
    item = " ".join(f"b{i}" for i in range(14))
    bench = spark.createDataFrame([(1, item), (2, "short one"), (3, None), (4, "...")], "item_id long, text string")
    long_text = "x y " * 60_000 + item
    rows = [(None, "A " + item.upper()), (None, "clean text"), (5, item[:40]), (5, "a SHORT, one"), (6, item), (6, item), (7, long_text), (8, ""), (9, None)]
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, n_hit int, item_ids string")
    want = sorted([("None", 15, 14, ["1"]), ("None", 2, 0, []), ("5", 13, 12, ["1"]), ("5", 3, 2, ["2"]), ("6", 14, 14, ["1"]), ("6", 14, 14, ["1"]), ("7", 120_014, 14, ["1"]), ("8", 0, 0, []), ("9", 0, 0, [])])
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        before, decontaminate.BROADCAST_BYTES = decontaminate.BROADCAST_BYTES, limit
        try:
            found = sorted((str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in decontaminate.decontaminate(docs, bench).collect())
        finally:
            decontaminate.BROADCAST_BYTES = before
        assert found == want
    assert decontaminate.decontaminate(docs.limit(0), bench).collect() == []


def test_quality_counts(spark):
    rng = random.Random(6)
    texts = [*ODD, *[" ".join(rng.choice("abcdefgh#") for _ in range(rng.randrange(3, 90))).replace("c", "\n") for _ in range(60)]]
    prose = lambda n: " ".join(rng.choice(["The", "of", "and", "el", "und"]) if rng.random() < 0.4 else f"word{rng.randrange(999)}" for _ in range(n))
    texts += [prose(80), "\n".join("- " + prose(9) for _ in range(9)), "\n".join(prose(9) + " ..." for _ in range(9)), "\n".join([prose(9)] * 3 + [prose(60)]), prose(60) + " #*$%&|<>#*$%&", prose(49), prose(12) * 8, prose(70).replace("word", "longerlongerlongerword")]
    kept: list[bool] = []
    for r in quality_rules.quality_rules(frame(spark, texts)).collect():
        t = texts[r.doc_id] or ""
        w = [x.decode() for x in WORDS.findall(t.encode())]
        g = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        again = {p for i, x in enumerate(g) if g.count(x) > 1 for p in range(i, i + 3)}
        lines = [x for x in t.split("\n") if WORDS.search(x.encode())]
        low = [x.lower().rstrip(".,!?;:") for x in w]
        stops = sum(x in quality_rules.STOP_WORDS for x in low)
        bullets = sum(bool(re.match("[ \t]*[-*\u2022]", x)) for x in lines)
        ends = sum(bool(re.search("(\\.\\.\\.|\u2026)[ \t\r]*$", x)) for x in lines)
        symbols, repeats = sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines))
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        fits = 2 * len(w) <= sum(map(len, w)) <= 15 * len(w) and 5 * symbols <= len(w) and 25 * stops >= len(w) and 2 * repeats <= len(lines) and 10 * bullets <= 9 * len(lines) and 2 * ends <= len(lines)
        assert (r.base_failed, r.kept) == (failed, not failed and fits)
        kept.append(r.kept)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
    assert 0 < sum(kept) < len(kept)
