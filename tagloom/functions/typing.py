"""Casting of dynamic raw values to a type, with rejects."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _value(row: Column, name: str, kind: str) -> Column:
    """One value of a parsed row, cast where its kind allows it."""
    return F.try_variant_get(row, f"$['{name}']", kind)


def _kind(row: Column, name: str) -> Column:
    return F.schema_of_variant(_value(row, name, "variant"))


def _is_number(kind: Column) -> Column:
    return kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")


def to_double(row: Column, name: str) -> Column:
    """A number, or a string that holds one; anything else is NULL."""
    kind = _kind(row, name)
    return F.when(_is_number(kind) | (kind == "STRING"), _value(row, name, "double"))


def to_boolean(row: Column, name: str) -> Column:
    """A boolean; a number is true when it equals 1; a string is true when it spells ``true`` in any case."""
    kind = _kind(row, name)
    return (
        F.when(kind == "BOOLEAN", _value(row, name, "boolean"))
        .when(_is_number(kind), _value(row, name, "double") == 1.0)
        .when(kind == "STRING", F.lower(_value(row, name, "string")) == "true")
    )


CASTS = {"double": to_double, "boolean": to_boolean}


def type_raw(raw: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Add one typed column per entry of ``types``; rows where any cast fails go to the second result."""
    typed = typed_rows(raw, types)
    return typed.where(~F.col("_rejected")).drop("_rejected"), typed.where("_rejected").drop("_rejected")


def typed_rows(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One typed column per entry of ``types``, and ``_rejected``: whether any cast of the row failed.

    ``inline`` makes the parse and the casts steps that no later filter is pushed through, so each runs once per row.
    """
    parsed = raw.select(*raw.columns, F.inline(F.array(F.struct(F.try_parse_json("columns").alias("_row")))))
    casts = F.struct(*[CASTS[kind](F.col("_row"), n).alias(n) for n, kind in types.items()])
    typed = parsed.select(*raw.columns, F.inline(F.array(casts)))
    failed = F.lit(False)
    for name in types:
        failed = failed | F.col(name).isNull()
    return typed.withColumn("_rejected", failed)
