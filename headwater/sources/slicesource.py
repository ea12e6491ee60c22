"""Landed slice files as a Spark data source: a partition for each file, ranges of stamps pushed down, and a stream by stamps.

    register(spark)
    spark.read.format("slices").option("path", "file:///landed").load().where("stamp >= '20260910150000'")

A file is a zip archive named by the 14 digits of its slice, ``<stamp>...zip``; its first member has a line for each article. Options: ``path``
(any folder that pyarrow's file systems reach), ``first`` and ``last`` (stamps, both inside), ``minutes`` of a slice (15) and
``max_missing``: if given, first and last have to be as well, and a read with more slices of that range missing than that fails as a whole. A
file that isn't a zip archive is missing. As a stream: ``patience``, how many slices a missing one is waited for (8).
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, timedelta

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from headwater.functions import timewin

FORM = "%Y%m%d%H%M%S"
LINES = 4096


class SlicesMissing(RuntimeError):
    pass


class Slice(InputPartition):
    def __init__(self, stamp: str, place: str):
        super().__init__(stamp)
        self.stamp, self.place = stamp, place


def stamps_between(first: str, last: str, minutes: int = 15) -> list[str]:
    """Stamps of the slices that begin in [first, last]."""
    step = timedelta(minutes=minutes)
    a, b = datetime.strptime(first, FORM), datetime.strptime(last, FORM)
    at = datetime.min + -(-(a - datetime.min) // step) * step
    out = []
    while at <= b:
        out.append(at.strftime(FORM))
        at += step
    return out


def _is_archive(file) -> bool:
    try:
        return zipfile.is_zipfile(file)
    except ValueError:  # shorter than the end of an archive
        return False


class Landed:
    """The files of a folder by stamp."""

    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        if not self.options.get("path"):
            raise ValueError("the option path is missing")
        self.minutes = int(self.options.get("minutes", 15))

    def files(self) -> dict[str, str]:
        system, folder = fs.FileSystem.from_uri(self.options["path"])
        found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        named = ((re.match(r"(\d{14}).*\.zip$", f.base_name, re.I), f.path) for f in found if f.is_file)
        return {m[1]: p for m, p in sorted(((m, p) for m, p in named if m), key=lambda x: x[1])}

    def usable(self, place: str) -> bool:
        system, _ = fs.FileSystem.from_uri(self.options["path"])
        with system.open_input_file(place) as f:
            return _is_archive(f)

    def lines(self, part: Slice) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(self.options["path"])
        with system.open_input_file(part.place) as f:
            if not _is_archive(f):
                return
            f.seek(0)
            with zipfile.ZipFile(f) as z:
                if not z.namelist():
                    return
                with z.open(z.namelist()[0]) as member:
                    lines: list[str] = []
                    for line in io.TextIOWrapper(member, "utf-8", errors="replace", newline="\n"):
                        lines.append(line.rstrip("\n"))
                        if len(lines) == LINES:
                            yield self._batch(part.stamp, lines)
                            lines = []
                    if lines:
                        yield self._batch(part.stamp, lines)

    @staticmethod
    def _batch(stamp: str, lines: list[str]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([stamp] * len(lines), pa.string()), pa.array(lines, pa.string())], names=["stamp", "line"])


class SliceReader(DataSourceReader):
    def __init__(self, options: dict):
        self.landed = Landed(options)
        own = self.landed.options
        self.first, self.last, self.some = own.get("first", ""), own.get("last", "9" * 14), None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Conditions on the stamp choose files; all others are left to Spark."""
        for f in filters:
            if getattr(f, "attribute", None) != ("stamp",):
                yield f
            elif isinstance(f, EqualTo | In):
                values = set(f.value if isinstance(f, In) else [f.value])
                self.some = values if self.some is None else self.some & values
            elif isinstance(f, GreaterThan | GreaterThanOrEqual):
                self.first = max(self.first, f.value + ("" if isinstance(f, GreaterThanOrEqual) else "\0"))
            elif isinstance(f, LessThan | LessThanOrEqual):
                if isinstance(f, LessThan):
                    yield f
                self.last = min(self.last, f.value)
            else:
                yield f

    def partitions(self) -> list[Slice]:
        files = self.landed.files()
        own = self.landed.options
        if "max_missing" in own:
            due = stamps_between(own["first"], own["last"], self.landed.minutes)
            missing = [s for s in due if s not in files or not self.landed.usable(files[s])]
            if len(missing) > int(own["max_missing"]):
                raise SlicesMissing(f"{len(missing)} of {len(due)} slices are missing, {own['max_missing']} may be: {', '.join(missing[:5])}")
        return [Slice(s, p) for s, p in sorted(files.items()) if self.first <= s <= self.last and (self.some is None or s in self.some)]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self.landed.lines(partition)


class SliceStream(DataSourceStreamReader):
    """Offsets are stamps. The stream goes on to a slice once all before it have landed, or are more than ``patience`` slices behind the newest."""

    def __init__(self, options: dict):
        self.landed = Landed(options)
        self.patience = int(self.landed.options.get("patience", 8))

    def initialOffset(self) -> dict:
        return {"stamp": self.landed.options.get("first", "")}

    def latestOffset(self) -> dict:
        stamps = [s for s in sorted(self.landed.files()) if s >= self.landed.options.get("first", "")]
        if not stamps:
            return self.initialOffset()
        newest = datetime.strptime(stamps[-1], FORM)
        given_up = (newest - timedelta(minutes=self.landed.minutes) * self.patience).strftime(FORM)
        there = set(stamps)
        last = None
        for s in stamps_between(stamps[0], stamps[-1], self.landed.minutes):
            if s not in there and s >= given_up:
                break
            last = s
        # past the slice, so that an end isn't read again as the next start
        return {"stamp": last + "~"} if last else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        return [Slice(s, p) for s, p in sorted(self.landed.files().items()) if start["stamp"] <= s < end["stamp"]]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        return self.landed.lines(partition)

    def commit(self, end: dict) -> None:
        return None


class SliceSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "slices"

    def schema(self) -> str:
        return "stamp string, line string"

    def reader(self, schema) -> SliceReader:
        return SliceReader(dict(self.options))

    def streamReader(self, schema) -> SliceStream:
        return SliceStream(dict(self.options))


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets Spark hand conditions to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(SliceSource)


def _zipped(batches, folder: str) -> Iterator[pa.RecordBatch]:
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(place, recursive=True)
    for batch in batches:
        for stamp, lines in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            # a repeated task writes the same bytes to the same place
            with system.open_output_stream(f"{place}/{stamp}.zip", compression=None) as out:
                with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(zipfile.ZipInfo(f"{stamp}.csv"), "".join(f"{x}\n" for x in lines))
        yield pa.record_batch([batch.column(0)], names=["stamp"])


def land(lines: DataFrame, folder: str) -> int:
    """Writes ``lines`` (stamp, pos, line) as slice files, each by one task in the order of ``pos``; how many."""
    rows = lines.groupBy("stamp").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]).alias("lines"))
    return rows.mapInArrow(lambda b: _zipped(b, folder), "stamp string").count()


def read_day(spark: SparkSession, folder: str, day: date, max_missing: int = 8, minutes: int = 15) -> DataFrame:
    """Lines (stamp, line) of a local day's slices; the read fails with ``SlicesMissing`` in its words if more than ``max_missing`` are missing."""
    register(spark)
    first, last = (t.strftime(FORM) for t in timewin.day_window(day))
    own = spark.read.format("slices").option("path", folder).option("first", first).option("last", last)
    return own.option("max_missing", max_missing).option("minutes", minutes).load()
