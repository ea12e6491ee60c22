"""Cleaning of a corpus in stages: each keeps or changes documents, and the last encodes them."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.llm import bpe, common, decontaminate, jaccard_join, quality_rules, substring_dedup


#: The column that tells rows apart inside a stage.
ROW = "_row"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what the rules reject."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id. Rows that share a doc_id, or have none, are of one group only by their texts."""
    own, _ = common.identified(docs, ROW)
    texts = own.select(F.col(ROW).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = jaccard_join.linked_rows(texts, common.buckets(common.texts(docs)), percent=80, n=5)
    first = found.where("component_id = doc_id").select(F.col("doc_id").alias(ROW)).distinct()
    return own.join(first, ROW, "left_semi").dropDuplicates([ROW]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; a document stays while it has words. Untouched texts, null ones among them, stay as they are."""
    return substring_dedup.cut_documents(docs, window=20)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a window of a benchmark item, each row by its own text. Null and empty texts hold none and stay; other columns may have any name."""
    own, _ = common.identified(docs, ROW)
    hits = decontaminate.hits(own.select(F.col(ROW).alias("doc_id"), "text"), common.table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias(ROW)).distinct()
    return own.join(hits, ROW, "left_anti").select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids and the digest of the text that they decode to. A null text has no tokens and the digest of the empty text; other columns are let go."""
    found = bpe.encode_decode(docs, "byte_bpe_50k.json")
    ids = found.select("doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("text_sha256"))
    return ids


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontaminate", benchmark_free),
    ("bpe", encoded),
]

#: Byte-pair encoding is not expressible in SQL; the stages before it are tested against their own SQL or brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages; each result is written to the shared folder and read again, and goes once the next one is written."""
    folder = posixpath.join(common.shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = common.table(spark, sf_dir, "documents")
    last = None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(out := f"{folder}/{i}-{name}")
            docs = spark.read.parquet(out)
            if last:
                common.remove_folder(spark, last)
            last = out
    return docs
