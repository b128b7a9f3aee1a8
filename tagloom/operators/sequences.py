"""Sequence rows: nested bodies, long cells, wide rows; upsert and delete by row number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.batching import group_into_batches
from tagloom.operators.upsert import delete_by_key, upsert
from tagloom.session import small_side

SEQ, ROW, COLUMN = "externalId", "rowNumber", "column"
VALUES = ("d", "l", "s")


def bodies_to_cells(bodies: DataFrame) -> DataFrame:
    """Nested bodies (externalId, columns, rows) as one line per cell: (externalId, rowNumber, column, d, l, s)."""
    rows = bodies.select(SEQ, "columns", F.explode("rows").alias("_row"))
    cells = rows.select(
        SEQ, F.col("_row.rowNumber").alias(ROW), "columns", F.posexplode("_row.values").alias("_at", "_cell")
    )
    return cells.select(SEQ, ROW, F.get("columns", F.col("_at")).alias(COLUMN), *[f"_cell.{v}" for v in VALUES])


def rows_to_cells(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Typed rows as cells: ``columns`` maps a column to the kind of its value (d, l or s)."""

    def cell(name: str, kind: str) -> Column:
        slots = {"d": "double", "l": "bigint", "s": "string"}
        values = [(F.col(name) if v == kind else F.lit(None)).cast(slots[v]).alias(v) for v in VALUES]
        return F.struct(F.lit(name).alias(COLUMN), *values)

    cells = F.explode(F.array(*[cell(n, k) for n, k in columns.items()]))
    return rows.select(SEQ, ROW, cells.alias("_cell")).select(SEQ, ROW, "_cell.*")


def cells_to_rows(cells: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cells as typed rows, one column per entry of ``columns``; the rows keep no order."""
    picked = [F.max(F.when(F.col(COLUMN) == n, F.col(k))).alias(n) for n, k in columns.items()]
    return cells.groupBy(SEQ, ROW).agg(*picked)


def rows_to_bodies(rows: DataFrame, columns: dict[str, str], max_rows: int = 10_000) -> DataFrame:
    """Typed rows as bodies of at most ``max_rows`` rows: (externalId, batch, columns, rows)."""
    slots = {"d": "double", "l": "bigint", "s": "string"}

    def cell(name: str, kind: str) -> Column:
        values = [(F.col(name) if v == kind else F.lit(None)).cast(slots[v]).alias(v) for v in VALUES]
        return F.struct(*values)

    nested = rows.select(
        SEQ, F.col(ROW).cast("long").alias(ROW), F.array(*[cell(n, k) for n, k in columns.items()]).alias("values")
    )
    batches = group_into_batches(nested, [SEQ], max_rows, [ROW])
    names = F.array(*[F.lit(n) for n in columns])
    return batches.select(SEQ, "batch", names.alias("columns"), F.array_sort("items").alias("rows"))


def read_sequence_rows(
    cells: DataFrame,
    requests: DataFrame,
    columns: Sequence[str] | None = None,
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Cells of the requested sequences, optionally of some columns and of row numbers in ``[start, end)``."""
    rows = cells
    if columns is not None:
        rows = rows.where(F.col(COLUMN).isin(*columns))
    if start is not None:
        rows = rows.where(F.col(ROW) >= start)
    if end is not None:
        rows = rows.where(F.col(ROW) < end)
    return rows.join(small_side(requests.select(SEQ).distinct()), SEQ, "left_semi")


def read_rows_wide(
    rows: DataFrame,
    requests: DataFrame | None,
    columns: Sequence[str],
    start: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Typed rows of the requested sequences, some columns and row numbers in ``[start, end)`` only, without cells."""
    found = rows.select(SEQ, ROW, *columns)
    if start is not None:
        found = found.where(F.col(ROW) >= start)
    if end is not None:
        found = found.where(F.col(ROW) < end)
    # A row without any of the columns set has no cell to return.
    found = found.where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull())
    return found if requests is None else found.join(requests.select(SEQ).distinct(), SEQ, "left_semi")


def upsert_sequence_rows(cells: DataFrame, incoming: DataFrame) -> DataFrame:
    """Cells after a write: a cell is replaced where (sequence, row, column) is written."""
    return upsert(cells, incoming, [SEQ, ROW, COLUMN], mode="replace", keep=())


def delete_sequence_rows(rows: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(remaining, deleted) after removing listed row numbers: ``listed`` has (externalId, rows array) or rowNumber."""
    if "rows" in listed.columns:
        listed = listed.select(SEQ, F.explode("rows").alias(ROW))
    return delete_by_key(rows, listed, [SEQ, ROW])
