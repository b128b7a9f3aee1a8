"""Batches of rows per key: exact sizes, with no task that ever holds a whole key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.columns import utc_day
from tagloom.session import materialize

# A key with more rows than this is cut into slices of about this many rows.
HOT_ROWS = 1_000_000


def running_totals(
    df: DataFrame, key: Sequence[str], order_by: Sequence[str], weights: Mapping[str, Column], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Sums over the rows that come earlier in the same key: one column per entry of ``weights``.

    The order is ``order_by`` at every size and for every type. Keys are counted first, with a map-side partial count.
    The rows of keys above ``hot_rows`` are put into ranges of the full order (key, then ``order_by``) at sampled
    quantiles, so outliers do not make a range larger. They are written once with the number of their range; every range
    is summed by a task of its own and shifted by the totals of the ranges before it. Other keys need one window.
    """
    names = list(weights)
    keyed = df.select(
        "*", F.struct(*key).alias("_key"), *[w.cast("long").alias(f"_w_{n}") for n, w in weights.items()]
    )
    counted = keyed.groupBy("_key").agg(F.count("*").alias("_rows"))
    hot = materialize(counted.where(F.col("_rows") > hot_rows), "hot-keys")
    before = W.partitionBy("_key").orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    summed = lambda window: [F.coalesce(F.sum(f"_w_{n}").over(window), F.lit(0)).alias(n) for n in names]
    rows = hot.agg(F.sum("_rows")).first()[0]
    if rows is None:
        return keyed.select(*df.columns, *summed(before))
    listed = hot.select("_key")
    ranges = 2 * -(-rows // hot_rows)
    sliced = keyed.join(listed, "_key", "left_semi").repartitionByRange(ranges, "_key", *order_by)
    # The bounds are sampled, so both uses below must see the same run: it is written.
    sliced = materialize(sliced.withColumn("_slice", F.spark_partition_id()), "slices")
    totals = sliced.groupBy("_key", "_slice").agg(*[F.sum(f"_w_{n}").alias(f"_t_{n}") for n in names])
    earlier = W.partitionBy("_key").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    shifts = totals.select(
        "_key", "_slice", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_s_{n}") for n in names]
    )
    inside = W.partitionBy("_key", "_slice").orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    local = sliced.select(*df.columns, "_key", "_slice", *[c.alias(f"_l_{n}") for c, n in zip(summed(inside), names)])
    spread = local.join(shifts, ["_key", "_slice"]).select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_s_{n}")).alias(n) for n in names]
    )
    rest = keyed.join(listed, "_key", "left_anti").select(*df.columns, *summed(before))
    return rest.unionByName(spread)


def assign_batches(
    df: DataFrame, key: Sequence[str], size: int, order_by: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``batch``: 0, 1, ... per key, every batch full but the last one."""
    numbered = running_totals(df, key, order_by, {"_before": F.lit(1)}, hot_rows)
    return numbered.withColumn("batch", F.floor(F.col("_before") / F.lit(size)).cast("long")).drop("_before")


def group_into_batches(
    df: DataFrame,
    key: Sequence[str],
    size: int = 1000,
    order_by: Sequence[str] = ("id",),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Arrays of at most ``size`` rows per key: (key..., batch, items)."""
    if size < 1:
        raise ValueError("the batch size must be positive")
    rest = [c for c in df.columns if c not in key]
    assigned = assign_batches(df, key, size, order_by, hot_rows)
    return assigned.groupBy(*key, "batch").agg(F.collect_list(F.struct(*rest)).alias("items"))


def explode_batches(batches: DataFrame, items: str = "items") -> DataFrame:
    """Rows of an already batched table; a narrow step, so no shuffle comes before the write."""
    return batches.select(F.explode(items).alias("_row")).select("_row.*")


def shard_and_batch(
    items: DataFrame, shards: int = 10, size: int = 4000, id_col: str = "id", hashed: bool = True
) -> DataFrame:
    """Spread items over ``shards`` by id, then batch each shard: (shard, batch, items)."""
    value = F.xxhash64(id_col) if hashed else F.col(id_col)
    sharded = items.withColumn("shard", F.pmod(value, F.lit(shards)).cast("long"))
    return group_into_batches(sharded, ["shard"], size, [id_col])


def batch_datapoints(
    points: DataFrame,
    max_points: int = 200_000,
    max_series: int = 10_000,
    direct_min: int = 50_000,
    shards: int = 10,
    series: str = "externalId",
    hashed: bool = True,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Give every point a write batch: adds (day, level, shard, part, batch).

    A series day with at least ``direct_min`` points is cut into batches of ``max_points`` of its own
    (level ``series``). Smaller series days are put together per day and shard (level ``day``), in series
    order, so that no batch passes ``max_points`` points or ``max_series`` series.
    """
    if not 0 < direct_min < max_points:
        raise ValueError("direct_min must lie below max_points")
    dated = points.withColumn("day", utc_day(F.col("timestamp")))
    groups = materialize(dated.groupBy(series, "day").agg(F.count("*").alias("_points")), "series-days")

    large = groups.where(F.col("_points") >= direct_min).select(series, "day")
    own = dated.join(large, [series, "day"], "left_semi")
    direct = assign_batches(own, [series, "day"], max_points, ["timestamp"], hot_rows).select(
        *dated.columns,
        F.lit("series").alias("level"),
        F.lit(None).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("part"),
        "batch",
    )

    value = F.xxhash64(series) if hashed else F.col(series)
    small = groups.where(F.col("_points") < direct_min).withColumn(
        "shard", F.pmod(value, F.lit(shards)).cast("long")
    )
    counts = {"_points_before": F.col("_points"), "_series_before": F.lit(1)}
    packed = running_totals(small, ["day", "shard"], [series], counts, hot_rows)
    # A batch starts within a step of max_points - direct_min and ends with a group below direct_min.
    plan = packed.select(
        series,
        "day",
        F.lit("day").alias("level"),
        "shard",
        F.floor(F.col("_series_before") / max_series).cast("long").alias("part"),
        F.floor(F.col("_points_before") / (max_points - direct_min)).cast("long").alias("batch"),
    )
    return direct.unionByName(dated.join(plan, [series, "day"]))


def batch_sequences(
    bodies: DataFrame,
    max_items: int,
    max_cells: int,
    shards: int = 1,
    id_col: str = "id",
    cells: Column | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Give every sequence body a write batch by item count and by cells (rows x columns).

    A batch closes at the body that reaches the cell cap, so only its last body may pass the cap; a batch
    holds at most ``max_items`` bodies. Adds (shard, cells, part, batch).
    """
    size = F.size("rows") * F.size("columns") if cells is None else cells
    sized = bodies.withColumn("cells", size.cast("long")).withColumn(
        "shard", F.pmod(F.col(id_col), F.lit(shards)).cast("long")
    )
    counts = {"_items_before": F.lit(1), "_cells_before": F.col("cells")}
    counted = running_totals(sized, ["shard"], [id_col], counts, hot_rows)
    return counted.select(
        *sized.columns,
        F.floor(F.col("_items_before") / max_items).cast("long").alias("part"),
        F.floor(F.col("_cells_before") / max_cells).cast("long").alias("batch"),
    )
