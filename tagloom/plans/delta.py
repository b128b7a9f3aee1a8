"""Incremental reads: the rows changed since the persisted timestamp."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.reads import list_resource
from tagloom.operators.state import record_delta, split_table_name, stored_timestamp
from tagloom.request import Request
from tagloom.session import materialize

# Fixed value: how far before the persisted timestamp a read starts, in milliseconds.
DEFAULT_OFFSET_MS = 1


def delta_read(
    table: DataFrame,
    request: Request,
    state: DataFrame,
    state_table: str,
    identifier: str,
    offset_ms: int = DEFAULT_OFFSET_MS,
    full_override: bool = False,
    fields: Mapping[str, Column] | None = None,
    timestamps: Mapping[str, Column] | None = None,
    key: str = "id",
) -> DataFrame:
    """Rows of the request from ``max(1, stored - offset)`` on; ``first_n`` keeps the first of those by ``key``.

    A later lower end of the request stays in force, and so does its upper end. The stored timestamp is a
    scalar subquery, so the read is one lazy plan and the lower end still reaches the scan.
    """
    if table.isStreaming:
        raise ValueError("a delta read is a batch read: a stream keeps its own place (see watch)")
    first_n = request.first_n
    rows = list_resource(table, replace(request, first_n=0), fields, timestamps)
    kept = lambda rows: rows.orderBy(key).limit(first_n) if first_n > 0 else rows
    if full_override:
        return kept(rows)
    db, name = split_table_name(state_table)
    own = state.where((F.col("dbName") == db) & (F.col("tableName") == name))
    stored = own.select(stored_timestamp(identifier)).scalar()
    lower = F.greatest(F.lit(1).cast("long"), stored - F.lit(offset_ms))
    if timestamps and "lastUpdatedTime" in timestamps:
        rows = rows.where(timestamps["lastUpdatedTime"] >= F.timestamp_millis(lower).cast("timestamp_ntz"))
    return kept(rows.where(F.col("lastUpdatedTime") >= lower))


def delta_cycle(
    table: DataFrame,
    request: Request,
    state: DataFrame,
    state_table: str,
    identifier: str,
    offset_ms: int = DEFAULT_OFFSET_MS,
    full_override: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(rows, state rows to append): one delta read and the mark that the next one starts from.

    The rows are written to the work folder, and the mark is taken from what was written: a row that arrives in between
    is in neither and comes with the next read.
    """
    rows = materialize(delta_read(table, request, state, state_table, identifier, offset_ms, full_override), "delta")
    return rows, record_delta(rows, state_table, identifier, full_override=full_override)
