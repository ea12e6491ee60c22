"""Sharding by rendezvous hashing over weighted shards.

Each shard draws a number for a key; the one with the least -ln(u) / weight gets the
row. The draw depends on the key and the shard's name alone, so a further shard takes rows only into
itself, and a shard's rows move only when it goes. Slots number the rows of a
shard without gaps: blocks of hashed keys are counted, their counts summed up over the blocks, and rows numbered in
their block, so no task holds a shard. Null texts have no bytes; a null doc_id
is a key of its own; repeated rows go to one shard and get slots of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headwater.llm import common

#: Blocks of a shard that are numbered apart.
BLOCKS = 1024


def rendezvous(key: Column, shards: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    """The place in ``shards`` of the one that wins the key."""
    weights = [1.0] * len(shards) if weights is None else list(weights)
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards) or min(weights) <= 0:
        raise ValueError("shards need distinct names and positive weights")
    table = F.array(*[F.struct(F.lit(s).alias("name"), F.lit(float(w)).alias("weight"), F.lit(i).alias("shard")) for i, (s, w) in enumerate(zip(shards, weights, strict=True))])
    # 53 bits, shifted by a half so that neither 0 nor 1 comes out
    draw = lambda name: (F.shiftrightunsigned(F.xxhash64(key, name), 11).cast("double") + 0.5) / float(2**53)
    return F.array_min(F.transform(table, lambda x: F.struct((-F.log(draw(x["name"])) / x["weight"]).alias("cost"), x["shard"].alias("shard"))))["shard"]


def names(n: int) -> list[str]:
    return [f"shard-{i}" for i in range(n)]


def shard(docs: DataFrame, n: int = 8, weights: Sequence[float] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard, the shard if there were one more of weight 1."""
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(common.NO_ID))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        rendezvous(key, names(n), weights).alias("shard"),
        rendezvous(key, names(n + 1), None if weights is None else [*weights, 1.0]).alias("grown_shard"),
        F.pmod(F.xxhash64(key, F.lit("block")), F.lit(BLOCKS)).cast("int").alias("block"),
    )
    counts = docs.select(rendezvous(key, names(n), weights).alias("shard"), F.pmod(F.xxhash64(key, F.lit("block")), F.lit(BLOCKS)).cast("int").alias("block")).groupBy("shard", "block").agg(F.count("*").alias("rows"))
    # n * BLOCKS rows at most
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    order = Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")
    placed = rows.withColumn("nth", F.row_number().over(order)).join(F.broadcast(first), ["shard", "block"])
    return placed.select(common.real_id(), "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("first") + F.col("nth") - 1).cast("long").alias("slot"), "grown_shard")
