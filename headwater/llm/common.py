"""What the operators share: tables, bucket counts, the shared folder, connected components."""

from __future__ import annotations

import tempfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside operators.
NO_ID = -(2**63)
#: Bytes of input that one bucket of a packed exchange is meant to hold, and what it may hold where there would be over ``MANY`` buckets.
BUCKET_BYTES, LARGE_BUCKET, MANY = 16 << 20, 128 << 20, 60_000
#: Sizes from which a planner's figure is a product or a default.
GUESSED = 1 << 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see; one of our own only where a local session has none, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="headwater-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Deletes a folder of the shared file system, whichever it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def buckets(df: DataFrame) -> int:
    """How many buckets a packed exchange over ``df`` gets: by the planner's size of the input, and not fewer than the session's shuffle partitions.

    Beyond ``MANY`` the buckets grow to ``LARGE_BUCKET`` first, then their number goes on; there is no upper end.
    An input that the planner can't judge, such as rows of the driver or a join, is measured.
    """
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size >= GUESSED:
        size = df.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 8)).first()[0] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(size // BUCKET_BYTES, max(MANY, size // LARGE_BUCKET))) | 1


def chunk_bytes(n: int, usual: int) -> int:
    """Bytes of text that a map task packs at a time: more where there are many buckets, so that a blob still holds several entries."""
    return max(usual, min(64 << 20, n << 10))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, nulls replaced by NO_ID and the empty text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def identified(docs: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` with a long column that is the same for rows equal in doc_id and text, differs for all others and sorts by doc_id.

    Where each doc_id has one text, null as one of them, it is the doc_id (NO_ID for null) and the second result is None. Else rows
    are numbered in the order of doc_id and two 64-bit hashes of the text; the second result is the table (``name``, doc_id) of the numbers.
    Whether an id recurs is told by the ids alone; texts are read and hashed for it only where one does.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marks = {"_row_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_row_a": F.xxhash64(text), "_row_b": F.xxhash64(F.lit(1), text)}
    if docs.select(marks["_row_doc"].alias("_row_doc")).groupBy("_row_doc").count().where("count > 1").isEmpty():
        return docs.withColumn(name, marks["_row_doc"]), None
    hashes = docs.select(*[c.alias(k) for k, c in marks.items()])
    differ = (F.min("_row_a") != F.max("_row_a")) | (F.min("_row_b") != F.max("_row_b"))
    if hashes.groupBy("_row_doc").agg(differ.alias("differ")).where("differ").isEmpty():
        return docs.withColumn(name, marks["_row_doc"]), None
    shared_folder(docs.sparkSession)
    keys = hashes.distinct().orderBy(*marks).withColumn(name, F.monotonically_increasing_id()).checkpoint()
    marked = docs.withColumns(marks).join(keys, list(marks)).select(*docs.columns, name)
    return marked, keys.select(name, F.col("_row_doc").alias("doc_id"))


def real_id(name: str = "doc_id") -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name)).alias(name)


def doc_bucket(n: int) -> Column:
    """The bucket of a document; ``doc_buckets`` is the same for arrays."""
    x = F.col("doc_id")
    return F.pmod(x.bitwiseXOR(F.shiftright(x, 15)).bitwiseXOR(F.shiftright(x, 32)), F.lit(n)).cast("int").alias("bucket")


def doc_buckets(ids: np.ndarray, n: int) -> np.ndarray:
    x = ids.astype(np.int64)
    return (x ^ (x >> 15) ^ (x >> 32)) % n


def components(edges: DataFrame, left: str = "u", right: str = "v", rounds: int = 60) -> DataFrame:
    """(node, label) with the least node of each connected component, by alternating large-star and small-star steps.

    Edges are an undirected list without an order; nodes are longs. Each round is one
    job whose result goes to the shared checkpoint folder, so no round depends on the
    executors of an earlier one. A hub's edges are combined map-side to a minimum first.
    """
    shared_folder(edges.sparkSession)
    pairs = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        after = small.checkpoint()
        same = after.count() == pairs.count() and after.join(pairs, ["u", "v"], "left_anti").isEmpty()
        pairs = after
        if same:
            break
    else:
        raise RuntimeError("the components did not settle")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("label")).union(pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
