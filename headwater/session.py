"""Session settings that the engine relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "headwater", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and measurements; on a cluster pass the cluster's own session to the operators."""
    builder = SparkSession.builder.appName(app).master(f"local[{cores or os.cpu_count()}]")
    settings = {
        "spark.sql.shuffle.partitions": str(cores or os.cpu_count()),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``. Only a local session may go without and gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="headwater-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one for what a query writes on its way; it goes when the session's process ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, for plans that read it several times."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
