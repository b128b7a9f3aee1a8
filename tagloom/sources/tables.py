"""Stored resource tables: snapshot folders with the layouts the reads prune on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Partition columns of the resources whose reads prune folders.
LAYOUTS = {"raw_rows": ["dbName", "tableName"], "datapoints": ["day"]}


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored table; giving the schema saves the look into the files."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_snapshot(df: DataFrame, path: str, resource: str | None = None) -> DataFrame:
    """Write a new snapshot folder (never over the one being read) in the resource's layout, and read it back.

    Data points are laid out by UTC day and raw rows by database and table. Rows are gathered by layout with a
    rebalance, which splits a day or table that holds most of the rows over many tasks and joins small ones.
    """
    layout = LAYOUTS.get(resource or "", [])
    if resource == "datapoints" and "day" not in df.columns:
        df = df.withColumn("day", F.to_date(F.timestamp_millis("timestamp")))
    writer = df.hint("rebalance", *layout).write.partitionBy(*layout) if layout else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_days(points: DataFrame, start: int, end: int) -> DataFrame:
    """Points of ``[start, end)`` from the day layout: the range also picks the day folders."""
    day = lambda ms: F.to_date(F.timestamp_millis(F.lit(ms)))
    return points.where(
        (F.col("day") >= day(start))
        & (F.col("day") <= day(end - 1))
        & (F.col("timestamp") >= start)
        & (F.col("timestamp") < end)
    )
