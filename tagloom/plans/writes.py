"""Queries of the write, delete and batching operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators import batching, files, hierarchy, keyed, reads, sequences, series, upsert
from tagloom.operators.raw import KEY
from tagloom.plans.reads import cells
from tagloom.plans.registry import query
from tagloom.session import work_path
from tagloom.sources.views import Views

ASSET = ["id", "externalId", "name", "description", "parentExternalId", "source", "dataSetId"]
_MERGED = """SELECT coalesce(a.id, i.id) AS id, externalId, {fields}
    FROM ast a FULL OUTER JOIN ast_in i USING (externalId)"""
_UPDATE = ", ".join(f"coalesce(i.{c}, a.{c}) AS {c}" for c in ASSET[2:])
_REPLACE = ", ".join(f"CASE WHEN i.id IS NOT NULL THEN i.{c} ELSE a.{c} END AS {c}" for c in ASSET[2:])


@query("upsert_update", _MERGED.format(fields=_UPDATE), ("ast_in",))
def upsert_update(v):
    return upsert.upsert(v.assets(), v.assets_incoming(), ["externalId"]).select(*ASSET)


@query("upsert_keyed", _MERGED.format(fields=_UPDATE), ("ast_in",))
def upsert_keyed(v):
    """The same write on a stored table: only the parts of the written keys are rewritten."""
    table = keyed.create(v.assets().select(*ASSET), work_path(v.spark, "keyed-assets"), ["externalId"], parts=16)
    table.upsert(v.assets_incoming().select(*ASSET))
    return table.read()


@query(
    "upsert_replace",
    """SELECT id, externalId, name, description, parentExternalId, source, dataSetId FROM ast
       UNION ALL SELECT 900000000 + c_custkey, 'new:' || c_custkey, c_name, NULL, NULL, NULL, NULL FROM customer""".replace(
        "FROM ast\n", "FROM ast WHERE externalId NOT LIKE 'customer:%'\n"
    )
    + """ UNION ALL SELECT a.id, a.externalId, upper(a.name), NULL, NULL, NULL, a.dataSetId FROM ast a
          WHERE externalId LIKE 'customer:%'""",
    ("ast",),
)
def upsert_replace(v):
    tree = v.assets()
    customers = tree.where(F.col("externalId").startswith("customer:"))
    changed = customers.select("externalId", F.upper("name").alias("name"), "dataSetId")
    added = v.table("customer").select(
        (F.col("c_custkey") + 900_000_000).alias("id"),
        F.concat(F.lit("new:"), F.col("c_custkey")).alias("externalId"),
        F.col("c_name").alias("name"),
    )
    incoming = changed.unionByName(added, allowMissingColumns=True)
    return upsert.upsert(tree, incoming, ["externalId"], mode="replace").select(*ASSET)


@query(
    "ensure_external_id",
    """SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey END AS id, s_name AS name,
              CASE WHEN s_nationkey < 5 THEN 'supplier:' || s_suppkey
                   WHEN s_acctbal < 0 THEN sha256('{"name":"' || s_name || '"}') END AS externalId
       FROM supplier""",
)
def ensure_external_id(v):
    rows = v.table("supplier").select(
        F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).alias("id"),
        F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") < 5, F.concat(F.lit("supplier:"), F.col("s_suppkey"))).alias("externalId"),
    )
    return upsert.ensure_external_id(rows)


@query(
    "dedupe_incoming",
    "SELECT externalId, rowNumber, quantity, extendedprice, discount, tax, returnflag, linestatus FROM seq",
    ("seq",),
)
def dedupe_incoming(v):
    return v.sequence_rows()


_BARE_EVENT = ["id", "externalId", "type", "source", "value"]


@query(
    "write_direct",
    """SELECT id, externalId, type, source, CASE WHEN type IN ('click', 'signup') THEN value * 2 ELSE value END AS value
       FROM ev""",
    ("ev",),
)
def write_direct(v):
    events = v.events().select(*_BARE_EVENT)
    stored = events.where("type <> 'signup'")
    given = events.where("type IN ('click', 'signup')").withColumn("value", F.col("value") * 2)
    batches = batching.group_into_batches(given, ["type"], 400).withColumn(
        "items", F.transform("items", lambda e: e.withField("type", F.col("type")))
    )
    return upsert.upsert(stored, batching.explode_batches(batches), ["externalId"], mode="replace")


@query(
    "raw_upsert",
    """SELECT dbName, tableName, key, CASE WHEN tableName = 'O' THEN '0' ELSE custkey END AS custkey FROM raw
       UNION ALL SELECT 'archive', tableName, key, custkey FROM raw WHERE tableName = 'F'""",
    ("raw",),
)
def raw_upsert(v):
    rows = v.raw()
    zeroed = rows.where("tableName = 'O'").withColumn("columns", F.lit('{"custkey":0}'))
    archived = rows.where("tableName = 'F'").withColumn("dbName", F.lit("archive"))
    written = upsert.upsert(rows, zeroed.unionByName(archived), KEY)
    return written.select(*KEY, F.get_json_object("columns", "$.custkey").alias("custkey"))


@query(
    "raw_upsert_keyed",
    """SELECT dbName, tableName, key, CASE WHEN tableName = 'O' THEN '0' ELSE custkey END AS custkey FROM raw
       WHERE tableName <> 'P'
       UNION ALL SELECT 'archive', tableName, key, custkey FROM raw WHERE tableName = 'F'""",
    ("raw",),
)
def raw_upsert_keyed(v):
    """Two upserts and a delete of raw rows in a stored table."""
    rows = v.raw()
    table = keyed.create(rows, work_path(v.spark, "keyed-raw"), KEY, parts=16)
    table.upsert(rows.where("tableName = 'O'").withColumn("columns", F.lit('{"custkey":0}')))
    table.upsert(rows.where("tableName = 'F'").withColumn("dbName", F.lit("archive")))
    table.delete(rows.where("tableName = 'P'"))
    return table.read().select(*KEY, F.get_json_object("columns", "$.custkey").alias("custkey"))


def _incoming_points(v: Views) -> DataFrame:
    events = v.events()
    point = lambda kind, shift, plus: events.where(F.col("type") == kind).select(
        F.col("source").alias("externalId"),
        (F.col("lastUpdatedTime") + shift).alias("timestamp"),
        (F.col("value") + plus).alias("valueNum"),
    )
    return point("purchase", 0, 1).unionByName(point("signup", -1_000_000_000, 0))


@query(
    "datapoints_upsert",
    """SELECT source AS externalId, lastUpdatedTime AS timestamp,
              CASE WHEN type = 'purchase' THEN value + 1 ELSE value END AS valueNum FROM ev
       UNION ALL SELECT source, lastUpdatedTime - 1000000000, value FROM ev WHERE type = 'signup'""",
    ("ev",),
)
def datapoints_upsert(v):
    return series.upsert_datapoints(v.datapoints(), _incoming_points(v))


@query(
    "datapoints_upsert_by_id",
    """SELECT source AS externalId, lastUpdatedTime AS timestamp,
              CASE WHEN type = 'purchase' THEN value + 1 ELSE value END AS valueNum FROM ev
       UNION ALL SELECT source, lastUpdatedTime - 1000000000, value FROM ev WHERE type = 'signup'""",
    ("ev",),
)
def datapoints_upsert_by_id(v):
    """Points that name their series by id only."""
    ids = v.events().select("source").distinct().select(F.col("source").alias("externalId"), F.substring("source", 3, 20).cast("long").alias("id"))
    given = _incoming_points(v).select(F.substring("externalId", 3, 20).cast("long").alias("id"), F.lit(None).cast("string").alias("externalId"), "timestamp", "valueNum")
    return series.upsert_datapoints(v.datapoints(), given, headers=ids)


@query(
    "upsert_by_id",
    """SELECT id, externalId, CASE WHEN id % 3 = 0 THEN 'changed' ELSE name END AS name FROM ast""",
    ("ast",),
)
def upsert_by_id(v):
    """Incoming rows with an id and no externalId change the stored rows."""
    tree = v.assets().select("id", "externalId", "name")
    given = tree.where("id % 3 = 0").select("id", F.lit(None).cast("string").alias("externalId"), F.lit("changed").alias("name"))
    return upsert.upsert(tree, given, ["externalId"])


@query(
    "files_write_then_read",
    """SELECT 'f:' || page_id AS externalId, CASE WHEN page_id % 7 > 0 THEN md5(html) END AS digest FROM pages
       UNION ALL SELECT 'new:' || page_id, md5(url) FROM pages WHERE page_id % 11 = 0""",
)
def files_write_then_read(v):
    """A written file comes back with its binary, also under a header that has no id yet."""
    pages = v.table("pages")
    headers = pages.select(F.col("page_id").alias("id"), F.concat(F.lit("f:"), "page_id").alias("externalId"), F.col("url").alias("name"))
    binaries = pages.where("page_id % 7 > 0").select(F.col("page_id").alias("id"), F.concat(F.lit("f:"), "page_id").alias("externalId"), F.col("html").cast("binary").alias("binary"))
    added = pages.where("page_id % 11 = 0").select(F.concat(F.lit("new:"), "page_id").alias("externalId"), F.col("url").alias("name"), F.col("url").cast("binary").alias("binary"))
    stored, kept, _ = files.write_files(headers, binaries, added)
    return files.read_files(stored, kept).select("externalId", F.md5("binary").alias("digest"))


@query(
    "datapoints_batch_by_day",
    """, d AS (SELECT user_id, ts, epoch_us(ts) // 86400000000 * 86400000 AS day FROM events),
       g AS (SELECT user_id, day, count(*) AS n FROM d GROUP BY ALL),
       big AS (SELECT day, 'series' AS level, NULL::BIGINT AS shard, 0 AS part, user_id AS series,
                      (row_number() OVER (PARTITION BY user_id, day ORDER BY ts) - 1) // 8 AS batch
               FROM d JOIN g USING (user_id, day) WHERE n >= 5),
       small AS (SELECT day, 'day' AS level, user_id % 3 AS shard, user_id AS series, n,
                        coalesce(sum(n) OVER w, 0) AS points_before, count(*) OVER w AS series_before
                 FROM g WHERE n < 5
                 WINDOW w AS (PARTITION BY day, user_id % 3 ORDER BY user_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       SELECT day, level, shard, part, batch, min(series) AS first_series, count(DISTINCT series) AS series,
              count(*) AS points
       FROM big GROUP BY day, level, shard, part, batch, series
       UNION ALL
       SELECT day, level, shard, series_before // 20, points_before // 3, min(series), count(*), sum(n)::BIGINT
       FROM small GROUP BY ALL""".replace(", d AS", "WITH d AS", 1),
)
def datapoints_batch_by_day(v):
    points = v.table("events").select(
        "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.col("value").alias("valueNum")
    )
    batched = batching.batch_datapoints(points, 8, 20, 5, 3, series="user_id", hashed=False)
    own = F.when(F.col("level") == "series", F.col("user_id"))
    return (
        batched.groupBy("day", "level", "shard", "part", "batch", own.alias("own"))
        .agg(
            F.min("user_id").alias("first_series"),
            F.countDistinct("user_id").alias("series"),
            F.count("*").alias("points"),
        )
        .drop("own")
    )


@query(
    "sequence_rows_upsert",
    """SELECT externalId, rowNumber, "column", CASE WHEN s = 'R' AND "column" = 'returnflag' THEN NULL ELSE d END AS d,
              CASE WHEN s = 'R' AND "column" = 'returnflag' THEN 'returned' ELSE s END AS s FROM cells
       UNION ALL SELECT externalId, rowNumber, 'comment', NULL, 'returned' FROM seq WHERE returnflag = 'R'""",
    ("cells",),
)
def sequence_rows_upsert(v):
    stored = cells(v)
    returned = v.sequence_rows().where("returnflag = 'R'").select("externalId", "rowNumber")
    incoming = returned.select(
        "*",
        F.explode(F.array(F.lit("returnflag"), F.lit("comment"))).alias("column"),
        F.lit(None).cast("double").alias("d"),
        F.lit(None).cast("long").alias("l"),
        F.lit("returned").alias("s"),
    )
    return sequences.upsert_sequence_rows(stored, incoming).drop("l")


@query(
    "sequence_batches",
    """, b AS (SELECT l_orderkey AS id, count(*) AS n_rows, count(*) * 6 AS cells FROM seq GROUP BY 1),
       w AS (SELECT *, id % 4 AS shard, coalesce(sum(cells) OVER w, 0) AS cb, count(*) OVER w AS ib FROM b
             WINDOW w AS (PARTITION BY id % 4 ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
       SELECT shard, ib // 150 AS part, (cb // 2000)::BIGINT AS batch, count(*) AS sequences, sum(cells)::BIGINT AS cells,
              min(id) AS first_id
       FROM w GROUP BY ALL""",
    ("seq",),
)
def sequence_batches(v):
    rows = v.sequence_rows().withColumn("id", F.substring("externalId", 3, 20).cast("long"))
    bodies = rows.groupBy("id").agg(F.count("*").alias("n_rows"))
    batched = batching.batch_sequences(bodies, 150, 2000, shards=4, cells=F.col("n_rows") * 6)
    return batched.groupBy("shard", "part", "batch").agg(
        F.count("*").alias("sequences"), F.sum("cells").alias("cells"), F.min("id").alias("first_id")
    )


@query(
    "items_shard_and_batch",
    """SELECT shard, batch, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM (
           SELECT id, id % 10 AS shard, (row_number() OVER (PARTITION BY id % 10 ORDER BY id) - 1) // 300 AS batch FROM ev)
       GROUP BY ALL""",
    ("ev",),
)
def items_shard_and_batch(v):
    batches = batching.shard_and_batch(v.events().select("id"), 10, 300, hashed=False)
    return _summary(batches, "shard")


def _summary(batches: DataFrame, key: str) -> DataFrame:
    ids = F.col("items.id")
    return batches.select(
        key,
        "batch",
        F.size("items").cast("long").alias("n"),
        F.array_min(ids).alias("first_id"),
        F.array_max(ids).alias("last_id"),
    )


@query(
    "group_into_batches",
    """SELECT type, batch, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM (
           SELECT id, type, (row_number() OVER (PARTITION BY type ORDER BY id) - 1) // 1000 AS batch FROM ev)
       GROUP BY ALL""",
    ("ev",),
)
def group_into_batches(v):
    return _summary(batching.group_into_batches(v.events().select("id", "type", "value"), ["type"], hot_rows=1500), "type")


@query(
    "delete_by_items",
    """SELECT id, externalId, type, id IN (SELECT id FROM items WHERE id IS NOT NULL)
              OR externalId IN (SELECT externalId FROM items WHERE externalId IS NOT NULL) AS deleted FROM ev""",
    ("ev", "items"),
)
def delete_by_items(v):
    remaining, deleted = upsert.delete(v.events().select("id", "externalId", "type"), v.event_items())
    return remaining.withColumn("deleted", F.lit(False)).unionByName(deleted.withColumn("deleted", F.lit(True)))


@query(
    "delete_assets_recursive",
    """SELECT externalId, name, rootExternalId = 'region:1' OR externalId = 'nation:0'
              OR coalesce(parentExternalId, '') = 'nation:0' AS deleted FROM ast""",
    ("ast",),
)
def delete_assets_recursive(v):
    items = v.spark.createDataFrame([("region:1",), ("nation:0",)], "externalId string")
    remaining, deleted = hierarchy.delete_assets(v.assets(), items)
    both = remaining.withColumn("deleted", F.lit(False)).unionByName(deleted.withColumn("deleted", F.lit(True)))
    return both.select("externalId", "name", F.col("deleted").cast("boolean").alias("deleted"))


@query(
    "delete_series_cascade",
    """SELECT externalId, name, count(*) AS points FROM ts_head JOIN dp USING (externalId)
       WHERE externalId NOT IN (SELECT 'u:' || c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY ALL""",
    ("ts_head", "dp"),
)
def delete_series_cascade(v):
    items = v.table("customer").where("c_acctbal < 0")
    items = items.select(F.concat(F.lit("u:"), F.col("c_custkey")).alias("externalId"))
    headers, points = upsert.delete_series(v.series(), v.datapoints(), items)
    counts = points.groupBy("externalId").agg(F.count("*").alias("points"))
    return headers.select("externalId", "name").join(counts, "externalId")


@query(
    "raw_delete_rows",
    """SELECT key, tableName FROM raw WHERE NOT (priority = '1-URGENT')""",
    ("raw",),
)
def raw_delete_rows(v):
    rows = v.raw()
    urgent = rows.where(F.get_json_object("columns", "$.priority") == "1-URGENT").select(*KEY)
    return upsert.delete_by_key(rows, urgent, KEY)[0].select("key", "tableName")


@query(
    "sequence_rows_delete",
    """SELECT externalId, rowNumber, returnflag FROM seq
       WHERE rowNumber NOT IN (1, 2) OR l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    ("seq",),
)
def sequence_rows_delete(v):
    listed = v.table("orders").where("o_orderstatus = 'F'")
    listed = listed.select(
        F.concat(F.lit("s:"), F.col("o_orderkey")).alias("externalId"),
        F.array(F.lit(1), F.lit(2)).cast("array<bigint>").alias("rows"),
    )
    remaining, _ = sequences.delete_sequence_rows(v.sequence_rows(), listed)
    return remaining.select("externalId", "rowNumber", "returnflag")


@query(
    "files_write",
    """SELECT page_id AS id, 'f:' || page_id AS externalId, url AS name, 'text/plain' AS mimeType,
              octet_length(encode(url))::BIGINT AS written_bytes, octet_length(encode(url))::BIGINT AS stored_bytes
       FROM pages
       UNION ALL SELECT NULL, 'd:' || doc_id, 'document', 'text/plain', octet_length(encode(text)), octet_length(encode(text))
       FROM documents""",
)
def files_write(v):
    pages = v.files().select(
        "externalId",
        F.lit(None).cast("long").alias("id"),
        F.lit(None).cast("string").alias("name"),
        F.lit("text/plain").alias("mimeType"),
        F.encode("name", "UTF-8").alias("binary"),
    )
    documents = v.table("documents").select(
        F.concat(F.lit("d:"), F.col("doc_id")).alias("externalId"),
        F.lit(None).cast("long").alias("id"),
        F.lit("document").alias("name"),
        F.lit("text/plain").alias("mimeType"),
        F.encode("text", "UTF-8").alias("binary"),
    )
    _, stored, written = files.write_files(v.files(), v.file_binaries(), pages.unionByName(documents))
    kept = stored.select("externalId", F.octet_length("binary").cast("long").alias("stored_bytes"))
    return written.join(kept, "externalId").select(
        "id", "externalId", "name", "mimeType", F.octet_length("binary").cast("long").alias("written_bytes"), "stored_bytes"
    )


@query(
    "run_report",
    """SELECT 'pipeline:events' AS externalId, 'SUCCESS' AS status, 'Number of data objects upserted: ' || count(*) AS message
       FROM ev""",
    ("ev",),
)
def run_report(v):
    return upsert.pipeline_run(v.events(), "pipeline:events", "SUCCESS")


@query(
    "create_run",
    """SELECT 'pipeline:' || event_type AS externalId, 'SEEN' AS status, 'seen ' || count(*) AS message FROM events
       GROUP BY event_type
       UNION ALL SELECT 'pipeline:nothing', 'SUCCESS', 'Number of data objects deleted: 0'""",
)
def create_run(v):
    path = work_path(v.spark, "runs")
    events = v.events()
    counted = events.groupBy("type").agg(F.count("*").alias("n"))
    runs = counted.select(
        F.concat(F.lit("pipeline:"), "type").alias("externalId"),
        F.lit("SEEN").alias("status"),
        F.concat(F.lit("seen "), F.col("n").cast("string")).alias("message"),
    )
    upsert.append_runs(runs, path)
    upsert.append_runs(upsert.pipeline_run(events.where("type = 'nothing'"), "pipeline:nothing", "SUCCESS", "deleted"), path)
    return v.spark.read.parquet(path)


@query("asset_upsert_validated", _MERGED.format(fields=_UPDATE), ("ast_in",))
def asset_upsert_validated(v):
    return hierarchy.write_assets(v.assets(), v.assets_incoming(), "rootExternalId").select(*ASSET)


@query(
    "relationships_by_ids",
    """SELECT 'r:' || o_orderkey AS externalId, 'customer:' || o_custkey AS sourceExternalId,
              'o:' || o_orderkey AS targetExternalId FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def relationships_by_ids(v):
    urgent = v.table("orders").where("o_orderpriority = '1-URGENT'")
    items = urgent.select(F.concat(F.lit("r:"), F.col("o_orderkey")).alias("externalId"))
    return reads.retrieve(v.relationships(), items).select("externalId", "sourceExternalId", "targetExternalId")


@query(
    "labels_and_data_sets",
    """SELECT DISTINCT 'type:' || p_type AS externalId, p_type AS name FROM part
       UNION ALL SELECT 'ds:' || r_regionkey, r_name FROM region""",
)
def labels_and_data_sets(v):
    sets = v.data_sets().select("externalId", F.try_element_at("metadata", F.lit("region")).alias("name"))
    return reads.list_resource(v.labels()).unionByName(sets)
