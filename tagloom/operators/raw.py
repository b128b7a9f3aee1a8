"""Raw rows: (dbName, tableName, key) with dynamic columns as JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.reads import list_resource
from tagloom.request import Request
from tagloom.session import small_side

KEY = ["dbName", "tableName", "key"]


def read_raw(
    raw: DataFrame,
    db: str,
    table: str,
    request: Request | None = None,
    timestamps: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Rows of one table; a partitioned layout is pruned to its folder. ``columns`` projects the dynamic fields."""
    if not isinstance(db, str) or not isinstance(table, str) or not db or not table:
        raise ValueError("both a database and a table name are required")
    request = request or Request()
    named = request.with_filter("dbName", db).with_filter("tableName", table)
    rows = list_resource(raw, named, timestamps=timestamps, key="key")
    wanted = request.root.get("columns")
    return project_columns(rows, wanted) if wanted else rows


def project_columns(raw: DataFrame, columns: str) -> DataFrame:
    """Only the listed dynamic fields (comma-joined), as string columns; one parse per row."""
    names = [c.strip() for c in columns.split(",") if c.strip()]
    fixed = [c for c in raw.columns if c != "columns"]
    return raw.select(*fixed, F.json_tuple("columns", *names).alias(*names))


def list_databases(raw: DataFrame) -> DataFrame:
    return raw.select("dbName").distinct()


def list_tables(raw: DataFrame, databases: DataFrame) -> DataFrame:
    """Tables of the given databases."""
    pairs = raw.select("dbName", "tableName").distinct()
    return pairs.join(small_side(databases.select("dbName").distinct()), "dbName", "left_semi")


def raw_requests(
    config: DataFrame, keys: Sequence[str], splitter: str = r"\.", columns: Sequence[str] = ()
) -> DataFrame:
    """Read requests from (key, value) pairs: the value split into database and table; shorter values are skipped."""
    parts = F.split("value", splitter)
    asked = config.where(F.col("key").isin(*keys)).select("key", parts.alias("_p")).where(F.size("_p") >= 2)
    return asked.select(
        F.col("key").alias("request_id"),
        F.get("_p", F.lit(0)).alias("dbName"),
        F.get("_p", F.lit(1)).alias("tableName"),
        F.lit(",".join(columns) or None).cast("string").alias("columns"),
    )


def read_many_raw(raw: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows of every requested table: (request_id, row...); a table asked for twice comes twice.

    A request with a column list gets only those dynamic fields, as they are stored.
    """
    wanted = F.col("columns") if "columns" in requests.columns else F.lit(None).cast("string")
    asked = requests.select("request_id", "dbName", "tableName", F.transform(F.split(wanted, ","), lambda c: F.trim(c)).alias("_wanted"))
    found = raw.join(small_side(asked), ["dbName", "tableName"])
    cut = F.to_json(F.map_filter(F.from_json("columns", "map<string,variant>"), lambda k, _: F.array_contains("_wanted", k)))
    return found.withColumn("columns", F.when(F.col("_wanted").isNull(), F.col("columns")).otherwise(cut)).select("request_id", *raw.columns)
