"""Delimited text files as rows of string maps."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.columns import strip

# The byte order mark, and the characters trimmed from names and cells (U+0000 to U+0020).
BLANKS = "".join(map(chr, range(0x21)))
BOM = "﻿"


def _cut(line: Column, delimiter: str) -> Column:
    return F.split(line, "\\Q" + delimiter + "\\E", -1)


def read_header(spark: SparkSession, path: str) -> str:
    """First line of the first file by name, without a byte order mark."""
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        return ""
    line = spark.read.text(files[0]).first()
    return line["value"].removeprefix(BOM) if line else ""


def parse_delimited(lines: DataFrame, header: str, delimiter: str = ";", column: str = "value") -> DataFrame:
    """Text lines as ``row``: a map from trimmed header names to trimmed cells.

    Lines equal to the header are dropped, and so are lines of one cell without any letter. Short lines are
    padded with empty text; cells beyond the header are named ``col_<i>``; cells of the same name are
    concatenated in order. Quotes have no meaning.
    """
    if len(delimiter) != 1:
        raise ValueError("the delimiter must be one character")
    names = [n.strip(BLANKS) for n in header.split(delimiter)]
    cells = _cut(F.regexp_replace(column, "^" + BOM, ""), delimiter)
    kept = lines.select(cells.alias("_cells")).where(
        ((F.size("_cells") > 1) | F.get("_cells", F.lit(0)).rlike(r"\p{IsAlphabetic}"))
        & (F.array_join("_cells", delimiter) != F.lit(header))
    )
    return kept.select(_row(F.col("_cells"), names).alias("row"))


def _row(cells: Column, names: list[str]) -> Column:
    places: dict[str, list[int]] = {}
    for i, name in enumerate(names):
        places.setdefault(name, []).append(i)
    cell = lambda i: strip(F.coalesce(F.get(cells, F.lit(i)), F.lit("")))
    # A header name may itself look like the name of an extra cell: then that cell belongs to it.
    own = {}
    for name, at in places.items():
        own[name] = reduce(lambda a, b: F.concat(a, b), [cell(i) for i in at])
        if name.startswith("col_") and name[4:].isdigit() and int(name[4:]) >= len(names):
            own[name] = F.concat(own[name], cell(int(name[4:])))
    known = F.create_map(*[x for name, value in own.items() for x in (F.lit(name), value)])
    numbered = F.transform(cells, lambda c, i: F.struct(F.concat(F.lit("col_"), i.cast("string")), strip(c)))
    extra = F.slice(numbered, len(names) + 1, F.greatest(F.size(cells) - len(names), F.lit(0)))
    taken = [n for n in own if n.startswith("col_")]
    if taken:
        extra = F.filter(extra, lambda e: ~e["col1"].isin(*taken))
    return F.when(F.size(cells) > len(names), F.map_concat(known, F.map_from_entries(extra))).otherwise(known)


def read_delimited(
    spark: SparkSession, path: str, delimiter: str = ";", header: str | None = None
) -> DataFrame:
    """Rows of all files that match ``path``. A given header makes every line data; no match gives no rows."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "row map<string,string>")
    return parse_delimited(lines, header if header is not None else read_header(spark, path), delimiter)


def as_columns(rows: DataFrame, names: list[str]) -> DataFrame:
    """The named map entries as columns."""
    return rows.select(*[F.try_element_at("row", F.lit(n)).alias(n) for n in names])
