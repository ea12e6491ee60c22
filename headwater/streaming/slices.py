"""Slices as a stream: counts by event time, and keep-first loading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.operators import load


def slice_counts(events: DataFrame, at: str = "ts", width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Rows of each slice. In append and update mode the watermark lets slices go once they are too late to change; complete mode keeps all of them."""
    timed = events.withColumn("at", F.col(at).cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", width)).agg(F.count("*").alias("n")).select(F.date_format("window.start", "yyyyMMddHHmmss").alias("stamp"), "n")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs a stream of complete results over what has landed; the executors write each result in place of the one before."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    stream.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(path)


def load_first(stream: DataFrame, path: str, checkpoint: str, *order: str) -> None:
    """Appends links not stored yet. A batch given twice finds its own rows and adds none, so the load is exact."""

    def add(batch: DataFrame, _: int) -> None:
        load.load(batch.sparkSession, batch, path, *order)

    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)
