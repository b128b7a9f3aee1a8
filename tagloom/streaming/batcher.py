"""Stateful micro-batching of streams with count, distinct-id and weight caps, by a latency timer or by event windows.

The open batch of a key is kept in columns: every micro-batch adds one entry to the state, the JSON text of its rows, and
reads back only the counters (and the ids met, where distinct ids are capped). A batch that fills up within a micro-batch
never enters the state. Batches are cut on whole columns: where the next one ends is found by searching running totals.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tagloom.session import ROCKSDB_PROVIDER, STATE_PROVIDER

# Send the processor to the executors by value, so they need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Shortest and longest wait before a partly filled batch is emitted, and the default.
MIN_LATENCY_MS, MAX_LATENCY_MS, LATENCY_MS = 10, 10 * 86_400_000, 5_000

# Keep NULL fields and microseconds in the JSON text of rows.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def batch_end(
    weights: np.ndarray, fresh: np.ndarray, held: tuple[int, int, int], caps: tuple[int, int, int], before: bool
) -> tuple[int, bool]:
    """How many of the next rows go into the open batch, and whether it is full then.

    ``fresh`` marks rows whose id the batch has not met, ``held`` is what it holds (rows, weight, ids), ``caps`` the caps of
    each. A batch is full with the row that reaches a cap; with ``before`` that row opens the next one, unless the batch is
    empty.
    """
    n, weight, ids = held
    total = len(weights)
    first = min(
        max(0, caps[0] - n - 1),
        int(np.searchsorted(np.cumsum(weights), caps[1] - weight)),
        int(np.searchsorted(np.cumsum(fresh), caps[2] - ids)),
    )
    if before:
        # The cap that a first row reaches alone is seen again at the second one.
        first = max(first, 1) if n == 0 else first
        return (total, False) if first >= total else (first, True)
    return (total, False) if first >= total else (first + 1, True)


class BatchProcessor(StatefulProcessor):
    """Holds the open batch of one key; it never grows past the caps."""

    def __init__(self, key: Sequence[str], caps: tuple[int, int, int], latency_ms: int, before: bool, window: str | None):
        self.key, self.caps, self.latency_ms, self.before, self.window = list(key), caps, latency_ms, before, window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getListState("chunks", "items string")
        self.sums = handle.getValueState("sums", "n long, weight long, marks string")
        self.deadline = handle.getValueState("deadline", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        n, weight, marks = self.sums.get() if self.sums.exists() else (0, 0, "")
        met = set(marks.split("\n")) if marks else set()
        stored = started = n > 0
        changed = False
        # What the open batch takes from these rows; its earlier rows stay in the state until it is full.
        held: list[str] = []
        for frame in rows:
            items, weights, ids = frame["item_json"].to_numpy(), frame["item_weight"].to_numpy(np.int64), frame["item_mark"].to_numpy()
            at, full_ones, changed = 0, [], changed or len(items) > 0
            while at < len(items):
                # A batch takes at most the rows that its size leaves room for: only these are looked at.
                near = slice(at, at + max(1, self.caps[0] - n) + 1)
                fresh = np.zeros(len(items[near]), np.int64)
                if self.caps[2] < np.iinfo(np.int64).max:
                    # Each id where it is first seen, up to the one that reaches the cap.
                    new: set[str] = set()
                    for i, mark in enumerate(ids[near].tolist()):
                        if len(met) + len(new) >= self.caps[2]:
                            break
                        if mark not in met and mark not in new:
                            new.add(mark)
                            fresh[i] = 1
                taken, full = batch_end(weights[near], fresh, (n, weight, len(met)), self.caps, self.before)
                if taken:
                    part = slice(at, at + taken)
                    held.extend(items[part].tolist())
                    n, weight = n + taken, weight + int(weights[part].sum())
                    met.update(ids[near][:taken][fresh[:taken] == 1].tolist())
                    at += taken
                if full:
                    full_ones.append(self._stored() + held if stored else held)
                    n, weight, met, held, stored, started = 0, 0, set(), [], False, False
            if full_ones:
                yield self._batches(key, full_ones, "full")
        if not changed:
            return
        if held:
            self.chunks.appendValue(("\n".join(held),))
        if n:
            self.sums.update((n, weight, "\n".join(sorted(met))))
        if self.window is not None:
            if not self.deadline.exists():
                self._set_timer(int(key[self.key.index(self.window)]))
        elif n and not started:
            self._set_timer(timerValues.getCurrentProcessingTimeInMs() + self.latency_ms)
        elif not n:
            self._drop_timer()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.deadline.clear()
        if self.sums.exists():
            yield self._batches(key, [self._stored()], "window" if self.window is not None else "stale")

    def _stored(self) -> list[str]:
        """The rows of the open batch that are in the state; it is forgotten there."""
        items = [line for (chunk,) in self.chunks.get() for line in chunk.split("\n")]
        self.chunks.clear()
        self.sums.clear()
        return items

    def _batches(self, key, batches: list[list[str]], reason: str) -> pd.DataFrame:
        """Whole batches as output rows."""
        names = {k: [v] * len(batches) for k, v in zip(self.key, key)}
        return pd.DataFrame({**names, "items": batches, "n": list(map(len, batches)), "reason": reason})

    def _set_timer(self, at: int) -> None:
        self._drop_timer()
        self.handle.registerTimer(at)
        self.deadline.update((at,))

    def _drop_timer(self) -> None:
        if self.deadline.exists():
            self.handle.deleteTimer(self.deadline.get()[0])
            self.deadline.clear()

    def close(self) -> None:
        pass


def _batched(
    df: DataFrame,
    key: Sequence[str],
    size: int,
    distinct: str | None,
    max_distinct: int,
    weight: str | None,
    max_weight: int,
    flush_before: bool,
    shards: int,
    latency_ms: int = 0,
    window: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    if size < 1:
        raise ValueError("the batch size must be positive")
    if df.sparkSession.conf.get(STATE_PROVIDER) != ROCKSDB_PROVIDER:
        raise ValueError("stateful batching needs the RocksDB state store: call tagloom.session.configure first")
    rest = [f for f in df.schema.fields if f.name not in key and f.name != "_at"]
    item = T.StructType(rest)
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    packed = df.select(
        *key,
        F.pmod(F.xxhash64(*hashable), F.lit(shards)).alias("shard"),
        F.to_json(F.struct(*[f.name for f in rest]), _JSON).alias("item_json"),
        (F.coalesce(F.col(weight).cast("long"), F.lit(0)) if weight else F.lit(0).cast("long")).alias("item_weight"),
        (F.to_json(F.struct(distinct), _JSON) if distinct else F.lit("")).alias("item_mark"),
        *([at.alias("item_at")] if at is not None else []),
    )
    keys = [*key, "shard"]
    output = T.StructType(
        [packed.schema[k] for k in keys]
        + [T.StructField("items", T.ArrayType(T.StringType())), T.StructField("n", T.LongType()), T.StructField("reason", T.StringType())]
    )
    most = np.iinfo(np.int64).max
    caps = (size, max_weight if weight else int(most), max_distinct if distinct else int(most))
    processor = BatchProcessor(keys, caps, latency_ms, flush_before, window)
    mode = "EventTime" if window is not None else "ProcessingTime"
    batches = packed.groupBy(*keys).transformWithStateInPandas(processor, output, "Append", mode)
    return batches.withColumn("items", F.transform("items", lambda x: F.from_json(x, item, _JSON)))


def group_into_batches_stream(
    df: DataFrame,
    key: Sequence[str],
    size: int = 1000,
    max_latency_ms: int = LATENCY_MS,
    distinct: str | None = None,
    max_distinct: int = 10_000,
    weight: str | None = None,
    max_weight: int = 2**31,
    flush_before: bool = False,
    shards: int = 1,
) -> DataFrame:
    """Batches of a stream: (key..., shard, items, n, reason).

    A batch is emitted when it is full, or ``max_latency_ms`` after its first row. ``distinct`` caps the different ids in
    a batch and ``weight`` the sum of a column. A batch is full once a cap is reached; with ``flush_before`` it is
    emitted ahead of the row that would reach it. A key that dominates the stream is spread over ``shards``, each with its
    own open batch.
    """
    if not MIN_LATENCY_MS <= max_latency_ms <= MAX_LATENCY_MS:
        raise ValueError(f"the latency must lie between {MIN_LATENCY_MS} and {MAX_LATENCY_MS} ms")
    return _batched(df, key, size, distinct, max_distinct, weight, max_weight, flush_before, shards, max_latency_ms)


def group_into_window_batches(
    df: DataFrame,
    key: Sequence[str],
    event_time: str,
    window_ms: int,
    delay_ms: int = 30_000,
    lateness_ms: int = 0,
    size: int = 1000,
    distinct: str | None = None,
    max_distinct: int = 10_000,
    weight: str | None = None,
    max_weight: int = 2**31,
    flush_before: bool = False,
    shards: int = 1,
) -> DataFrame:
    """Batches of a stream that keep to event windows: (key..., window_end, shard, items, n, reason).

    ``event_time`` is a column of epoch milliseconds. A batch holds rows of one window only. It is emitted when it is full,
    or, with the reason ``window``, when the stream's time (its latest event less ``delay_ms``) has passed the window's
    end by ``lateness_ms``: rows that arrive until then are taken, later ones are dropped and counted by Spark. The
    watermark trails by delay and lateness together, so that it reaches the window's end at that very time.
    """
    if window_ms < 1 or delay_ms < 0 or lateness_ms < 0:
        raise ValueError("the window must be positive; delay and lateness must not be negative")
    at = F.col(event_time)
    ended = df.withColumn("window_end", (F.floor(at / window_ms) + 1).cast("long") * window_ms).withColumn("_at", F.timestamp_millis(at))
    stamped = ended.withWatermark("_at", f"{delay_ms + lateness_ms} milliseconds")
    return _batched(
        stamped, [*key, "window_end"], size, distinct, max_distinct, weight, max_weight, flush_before, shards, window="window_end", at=F.col("_at")
    )
