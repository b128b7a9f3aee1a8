"""DataFrame helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a slice that one task sorts without trouble.
SLICE_ROWS = 100_000


def ranked(df: DataFrame, groups: list[str], slice_of: Column, order: list[str], weight: Column) -> DataFrame:
    """Add ``before`` (weights of the earlier rows of the group) and ``total`` (of the whole group).

    Rows of a group follow each other by ``slice_of``, then by ``order`` inside a slice. A slice is summed by its own
    task and shifted by the pre-aggregated slices before it, so a group that holds a third of all rows is not one task.
    Null group values form a group. Rows equal in ``order`` come in any order.
    """
    sliced = df.withColumn("_slice", slice_of).withColumn("_weight", weight.cast("long"))
    keys = [F.col(g) for g in groups]
    sums = sliced.groupBy(*keys, "_slice").agg(F.sum("_weight").alias("_sum"))
    along = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_shift"),
        F.sum("_sum").over(Window.partitionBy(*keys)).alias("total"),
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_local", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    same = F.col("_slice") == F.col("_s")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (
        local.join(shifts, same)
        .withColumn("before", F.col("_local") + F.col("_shift"))
        .drop("_slice", "_weight", "_local", "_s", "_shift", *[f"_g{i}" for i in range(len(groups))])
    )


def hex_slice(digest: str, rows: int = 0) -> Column:
    """The first hexadecimal digits of a digest as a number: slices in the order of the digest.

    There are 256 of them, and 16 times as many as often as it takes for ``rows`` rows to make slices of at most
    ``SLICE_ROWS``; the order of the rows is the same with any number.
    """
    digits = 2
    while digits < 7 and rows > SLICE_ROWS * 16**digits:
        digits += 1
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: inside a lambda it would be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)
