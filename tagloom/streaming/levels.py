"""A change log in levels: folders of micro-batches, and sorted runs that merge several of them.

``stream_upsert`` writes one folder per micro-batch. ``compact`` merges every ``fan`` neighbours of one level into a run
of the next, so a log of n batches is read as at most some ``fan * log_fan(n)`` runs, and a row is written again once
per level. A run holds one row per key, in ranges of the key. It counts once it is whole (its ``_SUCCESS`` file), and
then takes the place of what it merged; a compaction that broke off is written again. The newest batch may still be
written again by its stream and is never merged. One compaction runs at a time; readers and the stream need not wait.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.streaming.upsert import ARRIVAL, merge_log


@dataclass(frozen=True, order=True)
class Run:
    """Batches ``first`` to ``last`` merged; level 0 is a batch itself."""

    first: int
    last: int
    level: int

    def within(self, other: Run) -> bool:
        return self != other and other.first <= self.first and self.last <= other.last and self.level < other.level


class ChangeLog:
    """The batches below ``log`` (of rows of ``schema``) and the runs below ``runs``, a folder of their own.

    Later batches win; within a batch the later row by ``order_by``, then the one read later. ``mode`` is that of
    :func:`merge_log` and holds for every merge of this log.
    """

    def __init__(self, spark: SparkSession, log: str, runs: str, schema: T.StructType, key: Sequence[str], order_by: Sequence[str] = (), mode: str = "update"):
        self.spark, self.log, self.runs = spark, log.rstrip("/"), runs.rstrip("/")
        self.schema, self.key, self.order_by, self.mode = schema, list(key), list(order_by), mode
        self._hadoop, self._conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()

    def held(self) -> list[Run]:
        """The runs that make the log, oldest first: each batch is in exactly one."""
        return self._outer(self._whole())

    def read(self) -> DataFrame:
        """All rows that are still to be merged, with the number of their (last) batch."""
        return self._rows(self.held())

    def merge(self, base: DataFrame | None) -> DataFrame:
        """The table that ``base`` and the log make."""
        return merge_log(base, self.read(), self.key, self.order_by, self.mode)

    def compact(self, fan: int = 8) -> list[Run]:
        """Merge until no level has ``fan`` runs; the runs written. The newest batch stays as it is."""
        if fan < 2:
            raise ValueError("a run merges at least two")
        written = []
        while True:
            held = self.held()
            levels: dict[int, list[Run]] = {}
            for run in held[:-1]:
                levels.setdefault(run.level, []).append(run)
            full = next((runs[:fan] for _, runs in sorted(levels.items()) if len(runs) >= fan), None)
            if full is None:
                return written
            merged = Run(full[0].first, full[-1].last, full[0].level + 1)
            rows = merge_log(None, self._rows(full), self.key, self.order_by, self.mode).withColumn("batch_id", F.lit(merged.last).cast("long"))
            ranges = rows.withColumn(ARRIVAL, F.lit(0).cast("long")).repartitionByRange(*self.key).sortWithinPartitions(*self.key)
            ranges.write.mode("overwrite").parquet(self._path(merged))
            written.append(merged)

    def vacuum(self) -> list[Run]:
        """Delete what runs have taken the place of, once no reader that began before uses it."""
        every = self._whole()
        held = set(self._outer(every))
        gone = [run for run in every if run not in held]
        for run in gone:
            path = self._hadoop.Path(self._path(run))
            path.getFileSystem(self._conf).delete(path, True)
        return gone

    def _whole(self) -> list[Run]:
        batches = [Run(int(name[9:]), int(name[9:]), 0) for name in self._listed(self.log) if name.startswith("batch_id=")]
        merged = [Run(*map(int, name.split("-"))) for name in self._listed(self.runs) if name.count("-") == 2]
        return sorted(run for run in batches + merged if self._exists(f"{self._path(run)}/_SUCCESS"))

    def _outer(self, runs: list[Run]) -> list[Run]:
        """The runs that lie in no other one, in one pass: by start, the widest first."""
        out: list[Run] = []
        for run in sorted(runs, key=lambda r: (r.first, -r.last, -r.level)):
            if not out or not run.within(out[-1]):
                out.append(run)
        return out

    def _rows(self, runs: list[Run]) -> DataFrame:
        kept = T.StructType([*self.schema.fields, T.StructField(ARRIVAL, T.LongType())])
        stored = T.StructType([*kept.fields, T.StructField("batch_id", T.LongType())])
        batches = [self._path(r) for r in runs if not r.level]
        merged = [self._path(r) for r in runs if r.level]
        parts = []
        if batches:
            parts.append(self.spark.read.schema(stored).option("basePath", self.log).parquet(*batches))
        if merged:
            parts.append(self.spark.read.schema(stored).parquet(*merged))
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], stored)

    def _path(self, run: Run) -> str:
        return f"{self.runs}/{run.first}-{run.last}-{run.level}" if run.level else f"{self.log}/batch_id={run.first}"

    def _exists(self, path: str) -> bool:
        found = self._hadoop.Path(path)
        return found.getFileSystem(self._conf).exists(found)

    def _listed(self, folder: str) -> list[str]:
        path = self._hadoop.Path(folder)
        return [s.getPath().getName() for s in path.getFileSystem(self._conf).listStatus(path)] if self._exists(folder) else []
