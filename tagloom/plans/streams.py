"""Queries of the streaming operators, over landing folders derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.batching import group_into_batches
from tagloom.plans.copy import copy_series
from tagloom.plans.reads import JAN_5, JAN_10
from tagloom.plans.registry import query
from tagloom.plans.writes import _incoming_points
from tagloom.request import Request
from tagloom.session import work_path
from tagloom.sources.views import Views
from tagloom.streaming.batcher import group_into_batches_stream, group_into_window_batches
from tagloom.streaming.event_time import event_time_ms, read_with_late_rows, window_count, window_runs, with_event_time, write_with_late_rows
from tagloom.streaming.landing import land, read_landing, run_available, run_until_drained
from tagloom.streaming.levels import ChangeLog
from tagloom.streaming.slices import watch_slices
from tagloom.streaming.upsert import merge_log, stream_upsert
from tagloom.streaming.watch import watch

EVENT = ["id", "externalId", "type", "source", "value", "lastUpdatedTime"]
HOUR_MS, DAY_MS, DELAY_MS = 3_600_000, 86_400_000, 30_000


def _landed(v: Views, df: DataFrame, order_by: str, max_files: int | None = None) -> DataFrame:
    """The rows as a stream of files, each holding one range of ``order_by``."""
    path = land(df, work_path(v.spark, "landing"), order_by)
    return read_landing(v.spark, path, df.schema, max_files)


def _in_parts(v: Views, df: DataFrame, order_by: str, stream: Callable[[DataFrame], DataFrame], parts: int = 2) -> DataFrame:
    """The result of a stream that is started again for each of ``parts`` ranges of ``order_by`` as it arrives."""
    landing, (out, checkpoint) = work_path(v.spark, "landing"), _paths(v)
    cuts = df.approxQuantile(order_by, [i / parts for i in range(1, parts)], 0.01)
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:]):
        inside = F.lit(True) if low is None else F.col(order_by) > low
        land(df.where(inside if high is None else inside & (F.col(order_by) <= high)), landing, order_by)
        found = run_available(stream(read_landing(v.spark, landing, df.schema)), out, checkpoint)
    return found


def _paths(v: Views) -> tuple[str, str]:
    return work_path(v.spark, "out"), work_path(v.spark, "stream")


@query(
    "watch_resource",
    f"""SELECT id, externalId, type, source, value, lastUpdatedTime
        FROM ev WHERE type IN ('click', 'view') AND lastUpdatedTime >= {JAN_5} AND lastUpdatedTime < {JAN_10}""",
    ("ev",),
)
def watch_resource(v):
    """Files arrive between two runs of one watch; the second one reads the new files only."""
    (out, checkpoint), folder = _paths(v), work_path(v.spark, "landing")
    events = v.events().select(*EVENT)
    request = Request({"type": ["click", "view"], "lastUpdatedTime": {"min": JAN_5, "max": JAN_10}})
    middle = JAN_5 + 2 * DAY_MS
    for part in (events.where(F.col("lastUpdatedTime") < middle), events.where(F.col("lastUpdatedTime") >= middle)):
        land(part, folder, "lastUpdatedTime")
        watch(v.spark, folder, events.schema, "events", request, out, checkpoint, available_now=True, max_files=2).awaitTermination()
    return v.spark.read.schema(events.schema).parquet(out)


@query(
    "watch_slices",
    f"""SELECT id, externalId, type, source, value, lastUpdatedTime
        FROM ev WHERE source IS NOT NULL AND lastUpdatedTime >= {JAN_5} AND lastUpdatedTime < {JAN_10}""",
    ("ev",),
)
def watch_by_slices(v):
    """Two runs of one watch by time: the second one goes on where the slices of the first ended."""
    out, checkpoint = _paths(v)
    events = v.events().select(*EVENT)
    request = Request({"lastUpdatedTime": {"min": JAN_5, "max": JAN_10}})
    for end in (JAN_5 + 2 * DAY_MS, None):
        table = lambda: events.where(F.col("source").isNotNull())
        watch_slices(v.spark, table, "events", request, out, checkpoint, available_now=True, end=end).awaitTermination()
    return v.spark.read.schema(events.schema).parquet(out).select(*EVENT)


@query(
    "event_time",
    """SELECT 'events' AS resource, externalId, lastUpdatedTime AS event_time FROM ev
       UNION ALL SELECT 'datapoint_batches', externalId, min(timestamp) FROM dp GROUP BY externalId
       UNION ALL SELECT 'sequence_rows', 's:' || l_orderkey || '/' || l_linenumber, 1
       FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)""",
    ("ev", "dp"),
)
def event_time(v):
    def stamped(df: DataFrame, resource: str, name="externalId") -> DataFrame:
        return with_event_time(df, resource).select(
            F.lit(resource).alias("resource"), F.expr(name).alias("externalId"), F.unix_millis("event_time").alias("event_time")
        )

    batches = group_into_batches(v.datapoints(), ["externalId"], 1000, ["timestamp"])
    firsts = batches.groupBy("externalId").agg(F.min(event_time_ms("datapoint_batches")).alias("event_time"))
    firsts = firsts.select(F.lit("datapoint_batches").alias("resource"), "externalId", "event_time")
    rows = stamped(v.sequence_rows(), "sequence_rows", "concat(externalId, '/', rowNumber)")
    return stamped(v.events(), "events").unionByName(firsts).unionByName(rows)


_WINDOWS = """SELECT (lastUpdatedTime // {w} * {w})::BIGINT AS window_start, type, count(*) AS count FROM ev GROUP BY ALL"""


@query("tumbling_count_batch", _WINDOWS.format(w=HOUR_MS), ("ev",))
def tumbling_count_batch(v):
    return window_count(with_event_time(v.events(), "events"), "1 hour", ("type",))


@query(
    "tumbling_count",
    f"""SELECT * FROM ({_WINDOWS.format(w=HOUR_MS)})
        WHERE window_start + {HOUR_MS} <= (SELECT max(lastUpdatedTime) FROM ev) - {DELAY_MS}""",
    ("ev",),
)
def tumbling_count(v):
    """All windows that close before the watermark; the open ones stay in the state."""
    events = v.events().select("type", "lastUpdatedTime")
    stream = with_event_time(_landed(v, events, "lastUpdatedTime"), "events")
    return run_available(window_count(stream, "1 hour", ("type",)), *_paths(v))


@query(
    "stateful_batches",
    """SELECT type, count(*) AS rows, (count(*) // 300)::BIGINT AS full_batches, true AS within_size,
              sum(id)::BIGINT AS ids, sum(id * id % 1000003)::BIGINT AS mixed_ids FROM ev GROUP BY type""",
    ("ev",),
)
def stateful_batches(v):
    stream = _landed(v, v.events().select("type", "id"), "id")
    batches = run_until_drained(group_into_batches_stream(stream, ["type"], 300, 10), *_paths(v))
    return _batch_facts(batches, ["type"], "id", 300)


def _batch_facts(batches: DataFrame, key: list[str], number: str, size: int) -> DataFrame:
    """Per key: rows, full batches, whether all kept the size, and two sums over the delivered items."""
    each = lambda f: F.aggregate(F.transform("items", lambda x: f(x[number])), F.lit(0).cast("long"), lambda a, x: a + x)
    return batches.groupBy(*key).agg(
        F.sum("n").alias("rows"),
        F.count_if(F.col("reason") == "full").alias("full_batches"),
        (F.max(F.size("items")) <= size).alias("within_size"),
        F.sum(each(lambda x: x)).alias("ids"),
        F.sum(each(lambda x: x * x % 1000003)).alias("mixed_ids"),
    )


@query(
    "stateful_batches_windows",
    f"""SELECT type, (lastUpdatedTime // {DAY_MS} + 1) * {DAY_MS} AS window_end, count(*) AS rows,
               (count(*) // 40)::BIGINT AS full_batches, true AS within_size, sum(id)::BIGINT AS ids, sum(id * id % 1000003)::BIGINT AS mixed_ids
        FROM ev GROUP BY 1, 2 HAVING window_end <= (SELECT max(lastUpdatedTime) FROM ev) - {DELAY_MS + HOUR_MS}""",
    ("ev",),
)
def stateful_batches_windows(v):
    """Batches per type and day that stay open over restarts, until the day and an hour of lateness are over."""
    events = v.events().select("type", "id", "lastUpdatedTime")
    batches = _in_parts(
        v, events, "lastUpdatedTime",
        lambda s: group_into_window_batches(s, ["type"], "lastUpdatedTime", DAY_MS, DELAY_MS, HOUR_MS, size=40),
    )
    # Windows that are open at the end have delivered their full batches only.
    end = events.agg(F.max("lastUpdatedTime")).first()[0]
    closed = batches.where(F.col("window_end") <= (end or 0) - DELAY_MS - HOUR_MS)
    return _batch_facts(closed, ["type", "window_end"], "id", 40)


@query(
    "stateful_batches_datapoints",
    f"""SELECT (timestamp // {DAY_MS} + 1) * {DAY_MS} AS window_end, count(*) AS rows, count(DISTINCT externalId) AS series,
               sum(timestamp)::HUGEINT::VARCHAR AS times, true AS within_caps FROM dp GROUP BY 1
        HAVING window_end <= (SELECT max(timestamp) FROM dp) - {DELAY_MS}""",
    ("dp",),
)
def stateful_batches_datapoints(v):
    """Batches of points per day, below 100 points and 40 series each."""
    points = v.datapoints()
    found = _in_parts(
        v, points, "timestamp",
        lambda s: group_into_window_batches(
            s, [], "timestamp", DAY_MS, DELAY_MS, size=100, distinct="externalId", max_distinct=40, flush_before=True, shards=4
        ),
    )
    end = points.agg(F.max("timestamp")).first()[0]
    return _point_facts(found.where(F.col("window_end") <= (end or 0) - DELAY_MS))


def _point_facts(batches: DataFrame) -> DataFrame:
    """Per window: points, series, the sum of all times, and whether all batches kept below the caps.

    Points are added up within their batch: a batch is opened into its series only, and what it has once stands on the first
    of these rows.
    """
    times = F.aggregate("items.timestamp", F.lit(0).cast("long"), lambda total, x: total + F.coalesce(x, F.lit(0).cast("long")))
    sums = batches.select("window_end", "n", F.size("items").alias("rows"), times.alias("times"), F.array_distinct("items.externalId").alias("ids"))
    opened = sums.select("window_end", "n", "rows", "times", F.size("ids").alias("n_ids"), F.posexplode("ids").alias("at", "id"))
    once = lambda c: F.sum(F.when(F.col("at") == 0, c))
    return opened.groupBy("window_end").agg(
        once(F.col("rows")).alias("rows"),
        F.countDistinct("id").alias("series"),
        once(F.col("times").cast("decimal(38,0)")).cast("string").alias("times"),
        ((F.max("n") < 100) & (F.max("n_ids") < 40)).alias("within_caps"),
    )


@query(
    "stateful_batches_cells",
    """SELECT shard, count(*) AS sequences, sum(l_orderkey)::BIGINT AS ids, sum(n * 6)::BIGINT AS cells, true AS within_caps FROM (
           SELECT l_orderkey, l_orderkey % 4 AS shard, count(*) AS n FROM seq GROUP BY ALL) GROUP BY 1""",
    ("seq",),
)
def stateful_batches_cells(v):
    rows = v.sequence_rows().withColumn("id", F.substring("externalId", 3, 20).cast("long"))
    bodies = rows.groupBy("id").agg((F.count("*") * 6).alias("cells")).withColumn("shard_id", F.col("id") % 4)
    batches = group_into_batches_stream(
        _landed(v, bodies, "id"), ["shard_id"], 200, 10, weight="cells", max_weight=2000
    )
    found = run_until_drained(batches, *_paths(v))
    weight = F.aggregate("items", F.lit(0).cast("long"), lambda total, x: total + x["cells"])
    # The body that reaches the cap may pass it; all before it stay below.
    before = weight - F.element_at("items", -1)["cells"]
    return found.groupBy(F.col("shard_id").alias("shard")).agg(
        F.sum("n").alias("sequences"),
        F.sum(F.aggregate("items", F.lit(0).cast("long"), lambda total, x: total + x["id"])).alias("ids"),
        F.sum(weight).alias("cells"),
        ((F.max("n") <= 200) & (F.max(before) < 2000)).alias("within_caps"),
    )


POINTS_WRITTEN = """SELECT source AS externalId, lastUpdatedTime AS timestamp,
              CASE WHEN type = 'purchase' THEN value + 1 ELSE value END AS valueNum FROM ev
       UNION ALL SELECT source, lastUpdatedTime - 1000000000, value FROM ev WHERE type = 'signup'"""


@query(
    "streaming_upsert",
    POINTS_WRITTEN,
    ("ev",),
)
def streaming_upsert(v):
    """Several micro-batches into a change log, merged with the stored points."""
    incoming = _incoming_points(v)
    log, checkpoint = _paths(v)
    stream = _landed(v, incoming, "timestamp", max_files=1)
    stream_upsert(stream, log, checkpoint, available_now=True).awaitTermination()
    return merge_log(v.datapoints(), v.spark.read.parquet(log), ["externalId", "timestamp"], mode="replace")


@query("streaming_upsert_levels", POINTS_WRITTEN, ("ev",))
def streaming_upsert_levels(v):
    """Points arrive in five runs of one stream; after each the change log is compacted, and at last merged."""
    incoming, landing = _incoming_points(v), work_path(v.spark, "landing")
    log, checkpoint = _paths(v)
    changes = ChangeLog(v.spark, log, work_path(v.spark, "runs"), incoming.schema, ["externalId", "timestamp"], mode="replace")
    cuts = sorted(set(incoming.approxQuantile("timestamp", [0.2, 0.4, 0.6, 0.8], 0.01)))
    for low, high in zip([float("-inf"), *cuts], [*cuts, float("inf")]):
        land(incoming.where((F.col("timestamp") > low) & (F.col("timestamp") <= high)), landing, "timestamp")
        stream_upsert(read_landing(v.spark, landing, incoming.schema), log, checkpoint, available_now=True).awaitTermination()
        changes.compact(fan=2)
    return changes.merge(v.datapoints())


@query(
    "late_data",
    f""", m AS (SELECT max(CASE WHEN type <> 'error' THEN lastUpdatedTime END) - {DELAY_MS} AS early,
                       max(lastUpdatedTime) - {DELAY_MS} AS late FROM ev),
          w AS (SELECT (lastUpdatedTime // {HOUR_MS} * {HOUR_MS})::BIGINT AS window_start, type FROM ev)
       SELECT window_start, count(*) AS count FROM w, m
       WHERE window_start + {HOUR_MS} <= late AND (type <> 'error' OR window_start + {HOUR_MS} > early) GROUP BY 1""",
    ("ev",),
)
def late_data(v):
    """Errors arrive after everything else: those of closed windows are dropped, the rest still count."""
    events = v.events().select("type", "lastUpdatedTime")
    landing = work_path(v.spark, "landing")
    out, checkpoint = _paths(v)
    for part in ("type <> 'error'", "type = 'error'"):
        land(events.where(part), landing, "lastUpdatedTime")
        stream = with_event_time(read_landing(v.spark, landing, events.schema), "events")
        found = run_available(window_count(stream, "1 hour"), out, checkpoint)
    return found


@query(
    "late_rows",
    f""", m AS (SELECT max(CASE WHEN type <> 'error' THEN lastUpdatedTime END) - {DELAY_MS} AS early FROM ev)
       SELECT id, type, lastUpdatedTime, type = 'error' AND (lastUpdatedTime // {HOUR_MS} + 1) * {HOUR_MS} <= early AS late FROM ev, m""",
    ("ev",),
)
def late_rows(v):
    """Errors arrive after everything else: those of closed windows are delivered apart, so that none is lost."""
    events = v.events().select("id", "type", "lastUpdatedTime")
    landing, (out, checkpoint) = work_path(v.spark, "landing"), _paths(v)
    for part in ("type <> 'error'", "type = 'error'"):
        land(events.where(part), landing, "lastUpdatedTime")
        stream = read_landing(v.spark, landing, events.schema)
        write_with_late_rows(stream, "lastUpdatedTime", HOUR_MS, out, checkpoint, DELAY_MS, available_now=True).awaitTermination()
    return read_with_late_rows(v.spark, out)


@query(
    "series_copy_stream",
    "SELECT * FROM dp UNION ALL SELECT 'copy:' || externalId, timestamp, valueNum FROM dp",
    ("dp",),
)
def series_copy_stream(v):
    log, checkpoint = _paths(v)
    stream = _landed(v, v.datapoints(), "timestamp", max_files=2)
    copy_series(stream, lambda name: F.concat(F.lit("copy:"), name), log, checkpoint)
    return merge_log(v.datapoints(), v.spark.read.parquet(log), ["externalId", "timestamp"], mode="replace")


@query(
    "run_report_stream",
    f"""SELECT (lastUpdatedTime // {DAY_MS} * {DAY_MS})::BIGINT AS window_start, 'pipeline:events' AS externalId,
               'SUCCESS' AS status, 'Number of data objects upserted: ' || count(*) AS message
        FROM ev GROUP BY 1 HAVING window_start + {DAY_MS} <= (SELECT max(lastUpdatedTime) FROM ev) - {DELAY_MS}""",
    ("ev",),
)
def run_report_stream(v):
    stream = with_event_time(_landed(v, v.events().select("lastUpdatedTime"), "lastUpdatedTime"), "events")
    return run_available(window_runs(stream, "pipeline:events", duration="1 day"), *_paths(v))
