"""Streaming writes: an idempotent change log per micro-batch, merged when the table is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators.upsert import dedupe_latest
from tagloom.session import small_side


ARRIVAL = "_arrival"


def stream_upsert(df: DataFrame, log: str, checkpoint: str, available_now: bool = False, **trigger) -> StreamingQuery:
    """Write every micro-batch to its own folder of the change log.

    A batch costs as much as its own rows, whatever the size of the table. A batch that runs again replaces
    its folder, so nothing is applied twice. ``_arrival`` numbers the rows of a batch in the order they were read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn(ARRIVAL, F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        trigger = {"availableNow": True}
    return (writer.trigger(**trigger) if trigger else writer).start()


def merge_log(
    base: DataFrame | None, log: DataFrame, key: Sequence[str], order_by: Sequence[str] = (), mode: str = "update"
) -> DataFrame:
    """The table that base and change log make: later batches win, within a batch the later row by ``order_by``, and of
    rows that it leaves equal the one that was read later.

    ``update`` takes the last set value of every field, ``replace`` the last row (fields that it lacks are NULL then).
    The result has the base's columns, then those that only the log has. Only base rows with a key in the log are
    merged; the others pass by.
    """
    if mode not in ("update", "replace"):
        raise ValueError(f"unknown mode: {mode}")
    columns = [c for c in log.columns if c not in ("batch_id", ARRIVAL)]
    order = ["batch_id", *order_by, *([ARRIVAL] if ARRIVAL in log.columns else [])]
    rows = log.withColumn("batch_id", F.col("batch_id").cast("long"))
    untouched = None
    if base is not None:
        columns = [*base.columns, *[c for c in columns if c not in base.columns]]
        written = small_side(log.select(*key).distinct())
        untouched = base.join(written, list(key), "left_anti")
        touched = base.join(written, list(key), "left_semi")
        rows = rows.unionByName(touched.withColumn("batch_id", F.lit(-1).cast("long")), allowMissingColumns=True)
    merged = _merged(rows, columns, key, order, mode)
    return merged if untouched is None else untouched.unionByName(merged, allowMissingColumns=True).select(*columns)


def _merged(rows: DataFrame, columns: Sequence[str], key: Sequence[str], order: Sequence[str], mode: str) -> DataFrame:
    if mode == "replace":
        return dedupe_latest(rows, key, order).select(*columns)
    at = F.struct(*order)
    fields = [c for c in columns if c not in key]
    merged = rows.groupBy(*key).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in fields]
    )
    return merged.select(*columns)
