"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most r bits apart have a point between them that is at most r // 2 bits from the one and at most
r - r // 2 from the other. Every distinct fingerprint therefore sends all its variants in a ball of radius r - r // 2 (65 for
r = 2), and those who meet at a variant are candidates. A variant can be met by no more fingerprints than its
ball has points, so no group grows with the data. In each, all are linked to the smallest one that is within r // 2 of the
variant: any two that have that variant between them come together so, and no pairs are written.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm import common
from headwater.llm.textarrays import U64

#: Shingles whose hashes are counted at a time.
BLOCK = 1 << 16
SEED = 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: bytes, n: int = 3) -> int:
    """The SimHash of a text's shingles of ``n`` words, repeats included, each bit by the majority of the shingles' hashes; 0 without words."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = max(1, len(words) - n + 1)
    starts, ends = starts[:size].tolist(), ends[-size:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, size, BLOCK):
        h = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > size, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(x.as_buffer().to_pybytes(), n) for x in batch.column(1)], U64).view(np.int64)
        yield pa.record_batch([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])


def ball(radius: int) -> np.ndarray:
    """All masks of 64 bits with at most ``radius`` ones, by number of ones."""
    masks = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(64), k)]
    return np.array(masks, U64)


def _variants(batches: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    masks = ball(radius)
    step = max(1, (1 << 18) // len(masks))
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for at in range(0, len(fps), step):
            own = fps[at : at + step]
            variants = (own.view(U64)[:, None] ^ masks[None, :]).reshape(-1).view(np.int64)
            yield pa.record_batch([pa.array(variants), pa.array(np.repeat(own, len(masks)))], names=["variant", "fp"])


def links(prints: DataFrame, radius: int) -> DataFrame:
    """(u, v): links between distinct fingerprints (``fp``) at most ``radius`` bits apart that join all who are so linked."""
    inner = radius // 2
    met = prints.select("fp").distinct().mapInArrow(lambda batches: _variants(batches, radius - inner), "variant long, fp long")
    apart = F.bit_count(F.col("variant").bitwiseXOR(F.col("fp")))
    w = Window.partitionBy("variant").orderBy(apart > inner, "fp")
    pairs = met.withColumn("u", F.first("fp").over(w)).where("u <> fp").select("u", F.col("fp").alias("v")).distinct()
    # where nobody is near enough to the variant, who comes first may lie further than the radius from the others
    return pairs.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def simhash_groups(docs: DataFrame, radius: int = 2, n: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document, linked where fingerprints differ in at most ``radius`` bits.

    Words are stretches of bytes other than ASCII white space, with A to Z in lower case. A text of fewer than ``n`` words is one
    shingle; a null, empty or blank text has fingerprint 0, which is linked like any other. component_id is the smallest doc_id that
    links reach. Equal fingerprints are one class, however many documents have them. Rows with a null doc_id are linked too, but
    never name a component; one of such rows alone has a null component_id. Repeated rows and rows that share a doc_id have a result each.
    Other columns of ``docs`` may have any name and are let go.
    """
    common.shared_folder(docs.sparkSession)
    own = common.texts(docs).select("doc_id", F.col("text").cast("binary").alias("text"))
    prints = own.mapInArrow(lambda batches: _fingerprints(batches, n), "doc_id long, fp long").checkpoint()
    classes = prints.groupBy("fp").agg(F.min(F.when(F.col("doc_id") != common.NO_ID, F.col("doc_id"))).alias("least")).checkpoint()
    labels = common.components(links(classes, radius))
    rooted = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    found = rooted.join(named, "root").select("fp", "component_id")
    return prints.join(found, "fp").select(common.real_id(), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
