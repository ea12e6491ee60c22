"""Operators with state: late titles placed into their day's groups, and keywords that are seen for the first time."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from headwater.operators.grouping import THRESHOLD

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Groups(StatefulProcessor):
    """The groups of a day so far: for each token the titles that have it, and for each title its group and number of tokens.

    A title is compared only with those that share a token with it. Its place never changes later, so what comes out is
    what the batch gives, if titles come in the day's order.
    """

    def __init__(self, threshold: float):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.members = handle.getMapState("members", "token string", "titles array<int>")
        self.titles = handle.getMapState("titles", "title int", "group_id int, n int")
        self.sizes = handle.getValueState("sizes", "titles int, groups int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("pos")
        titles, groups = self.sizes.get() if self.sizes.exists() else (0, 0)
        # what this batch has looked up or changed; written back once
        members: dict[str, list[int]] = {}
        known: dict[int, tuple[int, int]] = {}
        out, first = [], titles
        for tokens in new["tokens"]:
            tokens = list(dict.fromkeys(tokens))
            both: Counter[int] = Counter()
            for t in tokens:
                if t not in members:
                    members[t] = list(self.members.getValue((t,))[0]) if self.members.containsKey((t,)) else []
                both.update(members[t])
            best, score = None, -1.0
            scores: dict[int, float] = {}
            for i, shared in both.items():
                if i not in known:
                    known[i] = tuple(self.titles.getValue((i,)))
                g, n = known[i]
                s = shared / (len(tokens) + n - shared)
                if s >= self.threshold - 1e-12:
                    scores[g] = max(scores.get(g, 0.0), s)
            for g in sorted(scores):
                if scores[g] > score:
                    best, score = g, scores[g]
            own = groups if best is None else best
            groups += best is None
            known[titles] = (own, len(tokens))
            for t in tokens:
                members[t].append(titles)
            titles += 1
            out.append(own)
        for t, own in members.items():
            if own and own[-1] >= first:
                self.members.updateValue((t,), (own,))
        for i in range(first, titles):
            self.titles.updateValue((i,), known[i])
        self.sizes.update((titles, groups))
        yield pd.DataFrame({"kst_date": [key[0]] * len(new), "pos": new["pos"].to_numpy(), "group_id": out})

    def close(self) -> None:
        return None


class FirstSeen(StatefulProcessor):
    """The last day of each keyword. A timer forgets it once the days to look back over have passed."""

    def __init__(self, lookback: int):
        self.lookback = lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "day timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("at")
        last = pd.Timestamp(self.last.get()[0]) if self.last.exists() else None
        seen = []
        for at, n in zip(new["at"], new["n"], strict=True):
            if n > 0:
                if last is None or at - last > timedelta(days=self.lookback):
                    seen.append((key[0], at.date(), n))
                last = at if last is None else max(last, at)
        if last is not None:
            self.last.update((last.to_pydatetime(),))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int((last.to_pydatetime().replace(tzinfo=timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1000) + (self.lookback + 1) * 86_400_000)
        yield pd.DataFrame(seen, columns=["keyword", "kst_date", "n"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.last.clear()
        yield pd.DataFrame({"keyword": pd.Series(dtype=object), "kst_date": pd.Series(dtype=object), "n": pd.Series(dtype="int64")})

    def close(self) -> None:
        return None


def late_groups(titles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """kst_date, pos and group_id of a stream of titles (kst_date, pos, tokens), each placed against all that came before it on its day.

    The state of a day is its titles and tokens. Copies of a title join its group, as nothing is more similar.
    """
    rows = titles.select("kst_date", "pos", "tokens")
    return rows.groupBy("kst_date").transformWithStateInPandas(Groups(threshold), "kst_date date, pos long, group_id long", "Append", "None")


def late_first_seen(counts: DataFrame, lookback: int = 7) -> DataFrame:
    """keyword, kst_date and n of a stream of counts (keyword, kst_date, n): days on which a keyword occurs and in the days before didn't.

    Days of a keyword have to come in order, a day in one piece; the state of a keyword that isn't seen any more goes with the watermark.
    """
    timed = counts.select("keyword", F.col("kst_date").cast("timestamp").alias("at"), "n").withWatermark("at", "0 seconds")
    return timed.groupBy("keyword").transformWithStateInPandas(FirstSeen(lookback), "keyword string, kst_date date, n long", "Append", "EventTime")


@contextmanager
def state_store(spark: SparkSession):
    """Operators with state need this store; other streams of the session keep theirs."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def run(landed: DataFrame, made: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> DataFrame:
    """Runs ``made`` over what has landed, a file at a time, into the table at ``path``. A batch given twice writes its own folder again."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    spark = landed.sparkSession
    with state_store(spark):
        made(landed).writeStream.outputMode("append").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).drop("batch")
