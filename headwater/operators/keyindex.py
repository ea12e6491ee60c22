"""The keys of a table in buckets, so that a load asks only the buckets that its own rows fall into.

Beside a table lies ``<path>_keys`` with its keys by bucket, and a numbered state (``Versions``) that says which folder
of keys counts, how many buckets it has and how many keys. The number of buckets grows with the keys, so a bucket stays small, and a load
of n rows reads n buckets at most, whatever the table has grown to. Appended files are merged when buckets are dealt
anew, once the keys have doubled or after ``LOADS`` loads, which reads the keys alone.

A load marks the state before it appends anything and clears the mark with the new number of keys. One that finds the mark knows that a load
stopped halfway, and makes the keys anew from the table before it goes on.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headwater.session import settled
from headwater.sinks.versions import Versions

#: Keys that a bucket is meant to hold at most, loads between merges, and the fewest and most buckets.
PER_BUCKET, LOADS, FEWEST, MOST = 50_000, 200, 16, 1 << 16


class KeyIndex:
    def __init__(self, spark: SparkSession, path: str, key: str):
        self.spark, self.path, self.key, self.folder = spark, path, key, f"{path}_keys"
        self.versions = Versions(spark, f"{self.folder}/_versions")

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int").alias("bucket")

    def state(self, table: DataFrame | None) -> dict:
        """The state to work from; made from the table where there is none, or where a load stopped halfway."""
        _, state = self.versions.latest()
        if state and not state["loading"]:
            return state
        return self.rebuilt(None if table is None else table.select(self.key))

    def rebuilt(self, keys: DataFrame | None) -> dict:
        """Deals the keys into buckets anew, in a folder of their own, and forgets the folder before."""
        number, before = self.versions.latest()
        n = 0 if keys is None else keys.count()
        buckets = FEWEST
        while buckets < MOST and n > buckets * PER_BUCKET // 2:
            buckets *= 2
        name = f"keys-{uuid.uuid4().hex}"
        if n:
            keys.select(self.key, self._bucket(buckets)).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.folder}/{name}")
        state = {"folder": name, "buckets": buckets, "keys": n, "loads": 0, "loading": False}
        self._commit(number, state)
        if before.get("folder"):
            path = self.versions._path("../" + before["folder"])
            self.versions._system().delete(path, True)
        return state

    def _commit(self, number: int, state: dict) -> None:
        if not self.versions.commit(number, state):
            raise RuntimeError("another load of this table is running")
        self.versions.forget(3)

    def fresh(self, rows: DataFrame, state: dict) -> DataFrame:
        """Rows whose key isn't stored, with their bucket. Reads the folders of the rows' own buckets and no others."""
        marked = rows.withColumn("bucket", self._bucket(state["buckets"]))
        system = self.versions._system()
        base = self.versions._path("../" + state["folder"])
        if not state["keys"] or not system.exists(base):
            return marked
        # at most as many as there are buckets
        touched = {f"bucket={r.bucket}" for r in marked.select("bucket").distinct().collect()}
        paths = [f"{self.folder}/{state['folder']}/{x.getPath().getName()}" for x in system.listStatus(base) if x.getPath().getName() in touched]
        if not paths:
            return marked
        known = self.spark.read.schema(f"`{self.key}` string").parquet(*paths)
        return marked.join(known, self.key, "left_anti")

    def add(self, fresh: DataFrame, write, state: dict) -> dict:
        """Appends settled rows by ``write`` and their keys, between two states."""
        number, _ = self.versions.latest()
        n = fresh.count()
        if not n:
            return state
        self._commit(number, {**state, "loading": True})
        write(fresh.drop("bucket"))
        fresh.select(self.key, "bucket").repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.folder}/{state['folder']}")
        new = {**state, "keys": state["keys"] + n, "loads": state["loads"] + 1, "loading": False}
        self._commit(number + 1, new)
        if new["loads"] >= LOADS or (new["keys"] > new["buckets"] * PER_BUCKET and new["buckets"] < MOST):
            stored = self.spark.read.schema(f"`{self.key}` string").parquet(f"{self.folder}/{new['folder']}")
            new = self.rebuilt(stored)
        return new


def load(spark: SparkSession, new: DataFrame, path: str, rows: DataFrame, key: str, partition: str) -> tuple[int, int]:
    """Appends those of ``rows`` (one for each key) whose key the table lacks; how many, and how many it has then."""
    index = KeyIndex(spark, path, key)
    state = index.state(_table(spark, path))
    fresh = settled(index.fresh(rows, state).select(*new.columns, "bucket"))
    after = index.add(fresh, lambda df: df.write.mode("append").partitionBy(partition).parquet(path), state)
    return after["keys"] - state["keys"], after["keys"]


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None
