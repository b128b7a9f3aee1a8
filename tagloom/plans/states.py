"""Queries of the state operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators import state
from tagloom.plans.registry import query
from tagloom.session import work_path
from tagloom.sources.views import Views


def marks(v: Views) -> DataFrame:
    """Stored high marks: the last time of every series, errors left out."""
    seen = v.events().where("type <> 'error'")
    return seen.groupBy(F.col("source").alias("key")).agg(F.max("lastUpdatedTime").alias("high"))


def mark_pairs(v: Views) -> DataFrame:
    """Marks to write: the error times of other series, in event order; some without key or value."""
    errors = v.table("events").where("event_type = 'error'")
    return errors.select(
        F.when(F.col("value") >= 1, F.concat(F.lit("u:"), F.col("user_id") + 20)).alias("key"),
        F.when(F.col("value") <= 489, F.unix_millis(F.col("ts").cast("timestamp"))).alias("high"),
        F.col("event_id").alias("ord"),
    )


@query(
    "state_get_high",
    "SELECT 'u:' || c_custkey AS key, high FROM customer LEFT JOIN marks ON key = 'u:' || c_custkey",
    ("marks",),
)
def state_get_high(v):
    keys = v.table("customer").select(F.concat(F.lit("u:"), F.col("c_custkey")).alias("key"))
    return state.get_high(marks(v), keys)


@query(
    "state_set_high",
    """SELECT key, coalesce(p.high, m.high) AS high FROM marks m FULL OUTER JOIN (
           SELECT key, arg_max(high, ord) AS high FROM mark_pairs WHERE key IS NOT NULL AND high IS NOT NULL GROUP BY 1) p
       USING (key)""",
    ("marks", "mark_pairs"),
)
def state_set_high(v):
    return state.set_high(marks(v), mark_pairs(v), "ord")


@query(
    "state_expand_high",
    """SELECT key, max(high) AS high FROM (SELECT key, high FROM marks UNION ALL
           SELECT key, high FROM mark_pairs WHERE key IS NOT NULL AND high IS NOT NULL) GROUP BY 1""",
    ("marks", "mark_pairs"),
)
def state_expand_high(v):
    return state.expand_high(marks(v), mark_pairs(v))


@query("state_delete", "SELECT * FROM marks WHERE key NOT IN (SELECT key FROM mark_pairs WHERE key IS NOT NULL)", ("marks", "mark_pairs"))
def state_delete(v):
    return state.delete_state(marks(v), mark_pairs(v).select(F.coalesce("key", F.lit(" ")).alias("key")))


@query(
    "state_store",
    """SELECT 'u:' || c_custkey AS key, high FROM customer LEFT JOIN (
           SELECT key, max(high) AS high FROM (SELECT key, high FROM marks UNION ALL
               SELECT key, high FROM mark_pairs WHERE key IS NOT NULL AND high IS NOT NULL)
           WHERE key NOT IN (SELECT 'u:' || c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1)
       ON key = 'u:' || c_custkey""",
    ("marks", "mark_pairs"),
)
def state_store(v):
    """Marks set, raised and dropped in a stored table, then asked for: one commit each."""
    store = state.StateStore.create(v.spark, work_path(v.spark, "state-store"))
    store.set(marks(v).withColumn("ord", F.lit(0)), "ord")
    store.expand(mark_pairs(v))
    customer = v.table("customer").select(F.concat(F.lit("u:"), F.col("c_custkey")).alias("key"), "c_acctbal")
    store.delete(customer.where("c_acctbal < 0"))
    return store.get(customer)


_ISO = "strftime(make_timestamp({0} * 1000), '%Y-%m-%dT%H:%M:%S') || CASE WHEN {0} % 1000 = 0 THEN 'Z' ELSE printf('.%03dZ', {0} % 1000) END"


@query(
    "delta_record",
    f"""SELECT 'state' AS dbName, 'delta' AS tableName, 'click_1700000000000' AS key, 'click' AS identifier,
               m::BIGINT AS timestamp, {_ISO.format("m")} AS utc
        FROM (SELECT max(lastUpdatedTime) AS m FROM ev WHERE type = 'click')""",
    ("ev",),
)
def delta_record(v):
    events = v.events()
    read = state.record_delta(events.where("type = 'click'"), "state.delta", "click", F.lit(1_700_000_000_000))
    empty = state.record_delta(events.where("type = 'nothing'"), "state.delta", "nothing", F.lit(1_700_000_000_000))
    return _opened(read.unionByName(empty))


@query(
    "delta_timestamp_write",
    f"""SELECT 'state' AS dbName, 'delta' AS tableName, 'sync_1700000000000' AS key, 'sync' AS identifier,
               lastUpdatedTime AS timestamp, {_ISO.format("lastUpdatedTime")} AS utc FROM ev""",
    ("ev",),
)
def delta_timestamp_write(v):
    written = v.events().select(F.col("lastUpdatedTime").alias("timestamp"))
    return _opened(state.timestamp_row(written, "state.delta", "sync", F.lit(1_700_000_000_000)))


def _opened(rows: DataFrame) -> DataFrame:
    fields = F.from_json("columns", "identifier string, timestamp long, utc string")
    return rows.select(
        "dbName", "tableName", "key", fields["identifier"].alias("identifier"), fields["timestamp"].alias("timestamp"), fields["utc"].alias("utc")
    )
