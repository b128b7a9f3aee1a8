"""A small state store of high marks, and the persisted timestamp of incremental reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.columns import iso_instant
from tagloom.operators.keyed import KeyedTable, Written, create
from tagloom.operators.upsert import dedupe_latest, upsert
from tagloom.session import small_side

DEFAULT_TIMESTAMP = 1


def _set(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("key").isNotNull() & F.col("high").isNotNull())


def get_high(state: DataFrame, keys: DataFrame) -> DataFrame:
    """The mark of every asked key; NULL for an unknown one."""
    return keys.select("key").join(state.select("key", "high"), "key", "left")


def set_high(state: DataFrame, pairs: DataFrame, order_by: str) -> DataFrame:
    """Overwrite marks, also by lower ones. The last pair of a key by ``order_by`` wins; unset ones are skipped."""
    last = dedupe_latest(_set(pairs), ["key"], [order_by, "high"])
    return upsert(state, last.select("key", "high"), ["key"])


def expand_high(state: DataFrame, pairs: DataFrame) -> DataFrame:
    """Raise marks: the higher of the stored and the given value."""
    both = state.select("key", "high").unionByName(_set(pairs).select("key", "high"))
    return both.groupBy("key").agg(F.max("high").alias("high"))


def delete_state(state: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop marks; an unset or blank key is skipped."""
    listed = keys.select("key").where(F.trim("key") != "").distinct()
    return state.join(small_side(listed), "key", "left_anti")


class StateStore:
    """High marks in a stored table. Every change is one commit: of two concurrent ones the later is applied to what the
    earlier left, so :meth:`expand` never lowers a mark, and a reader sees whole changes only."""

    def __init__(self, table: KeyedTable):
        self.table = table

    @classmethod
    def create(cls, spark: SparkSession, path: str, parts: int = 16) -> StateStore:
        return cls(create(spark.createDataFrame([], "key string, high long"), path, ["key"], parts))

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> StateStore:
        return cls(KeyedTable(spark, path))

    def get(self, keys: DataFrame) -> DataFrame:
        """The mark of every asked key; only the parts that can hold them are read."""
        return get_high(self.table.read_for(keys.where(F.col("key").isNotNull())), keys)

    def set(self, pairs: DataFrame, order_by: str) -> Written:
        return self.table.write(lambda stored, given: set_high(stored, given, order_by), _set(pairs))

    def expand(self, pairs: DataFrame) -> Written:
        highest = _set(pairs).groupBy("key").agg(F.max("high").alias("high"))
        return self.table.write(expand_high, highest)

    def delete(self, keys: DataFrame) -> Written:
        return self.table.write(delete_state, keys.select("key").where(F.trim("key") != "").distinct())


def split_table_name(table_name: str) -> tuple[str, str]:
    parts = table_name.split(".")
    if len(parts) != 2 or not all(parts):
        raise ValueError("the state table must be named db.table")
    return parts[0], parts[1]


def check_identifier(identifier: str) -> str:
    if not identifier or len(identifier) > 999:
        raise ValueError("the identifier must have 1 to 999 characters")
    return identifier


def stored_timestamp(identifier: str) -> Column:
    """Aggregate over raw state rows: the timestamp of the newest row of the identifier, 1 if there is none."""
    check_identifier(identifier)
    fields = F.from_json("columns", "identifier string, timestamp double")
    own = (fields["identifier"] == identifier) & fields["timestamp"].isNotNull()
    newest = F.max_by(fields["timestamp"], F.when(own, F.col("lastUpdatedTime")))
    # Half a millisecond rounds up. max_by skips rows whose order value is NULL.
    return F.coalesce(F.floor(newest + 0.5), F.lit(DEFAULT_TIMESTAMP)).cast("long")


def read_timestamp(raw: DataFrame, table_name: str, identifier: str) -> DataFrame:
    """The persisted timestamp of an identifier: one row, newest by the row's lastUpdatedTime."""
    db, table = split_table_name(table_name)
    rows = raw.where((F.col("dbName") == db) & (F.col("tableName") == table))
    return rows.agg(stored_timestamp(identifier).alias("timestamp"))


def timestamp_row(
    marks: DataFrame, table_name: str, identifier: str, now_ms: Column | None = None, column: str = "timestamp"
) -> DataFrame:
    """Raw rows that persist timestamps; append them to the state table."""
    db, table = split_table_name(table_name)
    check_identifier(identifier)
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    at = F.col(column)
    return marks.select(
        F.lit(db).alias("dbName"),
        F.lit(table).alias("tableName"),
        F.concat(F.lit(identifier + "_"), now.cast("string")).alias("key"),
        F.to_json(
            F.struct(
                F.lit(identifier).alias("identifier"),
                at.alias("timestamp"),
                iso_instant(at).alias("utc"),
                F.lit("Delta read timestamp").alias("comment"),
            )
        ).alias("columns"),
        now.alias("lastUpdatedTime"),
    )


def record_delta(
    rows: DataFrame,
    table_name: str,
    identifier: str,
    now_ms: Column | None = None,
    full_override: bool = False,
    column: str = "lastUpdatedTime",
) -> DataFrame:
    """State rows to append after a delta read: the highest time read; none for an empty or a full read."""
    mark = rows.agg(F.max(column).alias("timestamp")).where(F.col("timestamp").isNotNull())
    if full_override:
        mark = mark.where(F.lit(False))
    return timestamp_row(mark, table_name, identifier, now_ms)
