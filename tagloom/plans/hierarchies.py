"""Queries of the hierarchy and comparison operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators import compare, hierarchy
from tagloom.plans.registry import query
from tagloom.sources.views import Views

FIELDS = ["externalId", "name", "parentExternalId", "description", "source", "dataSetId"]
_SAME = " AND ".join(f"a.{f} IS NOT DISTINCT FROM i.{f}" for f in FIELDS)


@query("hierarchy_levels", "SELECT externalId, root, depth, path FROM lvl", ("lvl",))
def hierarchy_levels(v):
    return hierarchy.hierarchy_levels(v.assets()).withColumn("path", F.array_join("path", "/"))


@query(
    "asset_aggregated_properties",
    """SELECT externalId, name, depth, path, (SELECT count(*) FROM ast c WHERE c.parentExternalId = ast.externalId)
              AS childCount FROM ast JOIN lvl USING (externalId)""",
    ("lvl",),
)
def asset_aggregated_properties(v):
    found = hierarchy.asset_properties(v.assets())
    return found.select("externalId", "name", "depth", F.array_join("path", "/").alias("path"), "childCount")


@query(
    "topological_order",
    """SELECT externalId, CASE WHEN parentExternalId IS NULL OR parentExternalId LIKE 'region:%' THEN 0 ELSE 1 END::BIGINT
              AS level FROM ast WHERE parentExternalId IS NOT NULL""",
    ("ast",),
)
def topological_order(v):
    below = v.assets().where(F.col("parentExternalId").isNotNull())
    return hierarchy.topological_level(below).select("externalId", "level")


def bad_batch(v: Views) -> DataFrame:
    """Customers with broken references: no externalId, own parent, listed twice, and one two-cycle per nation."""
    c = v.table("customer")
    ends = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"))
    name = lambda column: F.concat(F.lit("customer:"), F.col(column))
    parent = (
        F.when(F.col("c_custkey") == F.col("lo"), name("hi"))
        .when(F.col("c_custkey") == F.col("hi"), name("lo"))
        .when(F.col("c_acctbal") > 9500, name("c_custkey"))
        .otherwise(name("lo"))
    )
    at_end = (F.col("c_custkey") == F.col("lo")) | (F.col("c_custkey") == F.col("hi"))
    rows = c.join(ends, "c_nationkey").select(
        F.when((F.col("c_acctbal") >= 0) | at_end, name("c_custkey")).alias("externalId"),
        F.col("c_name").alias("name"),
        parent.alias("parentExternalId"),
        (~at_end & (F.col("c_mktsegment") == "BUILDING") & F.col("c_acctbal").between(0, 9500)).alias("_twice"),
    )
    twice = rows.where("_twice")
    return rows.unionByName(twice).drop("_twice")


@query(
    "validate_assets",
    """WITH e AS (SELECT c_nationkey, min(c_custkey) AS lo, max(c_custkey) AS hi FROM customer GROUP BY 1),
       c AS (SELECT *, c_custkey IN (lo, hi) AS at_end, 'customer:' || c_custkey AS ext FROM customer JOIN e USING (c_nationkey))
       SELECT 'missing_external_id' AS rule, NULL AS externalId, c_name AS name, 1 AS copies FROM c
       WHERE c_acctbal < 0 AND NOT at_end
       UNION ALL SELECT 'self_reference', ext, c_name, 1 FROM c WHERE c_acctbal > 9500 AND NOT at_end
       UNION ALL SELECT 'duplicate', ext, c_name, 2 FROM c
       WHERE c_mktsegment = 'BUILDING' AND c_acctbal BETWEEN 0 AND 9500 AND NOT at_end
       UNION ALL SELECT 'cycle', ext, c_name, 1 FROM c WHERE at_end""",
)
def validate_assets(v):
    return hierarchy.validate_assets(bad_batch(v))


@query(
    "detect_cycles",
    """SELECT 'customer:' || min(c_custkey) AS externalId FROM customer GROUP BY c_nationkey
       UNION ALL SELECT 'customer:' || max(c_custkey) FROM customer GROUP BY c_nationkey""",
)
def detect_cycles(v):
    batch = bad_batch(v)
    return hierarchy.detect_cycles(batch.where("externalId <> parentExternalId"))


def unlinked(v: Views) -> DataFrame:
    """Trees with faults: region 2 without its nations, and rich customers of region 3 without a parent."""
    accounts = v.table("customer").select(
        F.concat(F.lit("customer:"), F.col("c_custkey")).alias("externalId"), "c_acctbal"
    )
    tree = v.assets().join(accounts, "externalId", "left")
    lost = (F.col("rootExternalId") == "region:2") & F.col("externalId").startswith("nation:")
    loose = (F.col("rootExternalId") == "region:3") & (F.coalesce("c_acctbal", F.lit(0.0)) > 9500)
    return tree.where(~lost).withColumn("parentExternalId", F.when(~loose, F.col("parentExternalId"))).drop("c_acctbal")


@query(
    "check_referential_integrity",
    """, b AS (SELECT rootExternalId, 'invalid_parent' AS rule, externalId FROM ast
               WHERE rootExternalId = 'region:2' AND externalId LIKE 'customer:%'
               UNION ALL
               SELECT rootExternalId, 'root_count', externalId FROM ast LEFT JOIN customer ON externalId = 'customer:' || c_custkey
               WHERE rootExternalId = 'region:3' AND (parentExternalId IS NULL OR c_acctbal > 9500)),
       r AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY externalId) AS rn, count(*) OVER (PARTITION BY rule) AS n
             FROM b)
       SELECT rootExternalId, rule, n AS count, string_agg(externalId, ',' ORDER BY externalId) AS samples
       FROM r WHERE rn <= 10 AND (rule = 'invalid_parent' OR n <> 1) GROUP BY ALL""",
    ("ast",),
)
def check_referential_integrity(v):
    return hierarchy.check_integrity(unlinked(v), "rootExternalId")


_CHANGES = f"""
    SELECT CASE WHEN i.id IS NULL THEN 'delete' WHEN a.id IS NULL THEN 'insert' WHEN {_SAME} THEN 'unchanged'
                ELSE 'update' END AS change, rootExternalId, externalId, coalesce(i.description, '') AS description
    FROM ast a FULL OUTER JOIN ast_in i USING (rootExternalId, externalId)"""


@query("compare_collections", _CHANGES, ("ast_in",))
def compare_collections(v):
    found = compare.compare(v.assets(), v.assets_incoming(), ["rootExternalId", "externalId"])
    return found.select("change", "rootExternalId", "externalId", F.coalesce("description", F.lit("")).alias("description"))


@query("change_counts", f"SELECT change, count(*) AS rows FROM ({_CHANGES}) GROUP BY 1", ("ast_in",))
def change_counts(v):
    return compare.change_counts(v.assets(), v.assets_incoming(), ["rootExternalId", "externalId"])


@query(
    "compare_duplicates",
    """SELECT CASE WHEN c_acctbal > 9000 THEN 'invalid' ELSE 'unchanged' END AS change, externalId,
              CASE WHEN c_acctbal > 9000 THEN 2 ELSE 1 END AS copies
       FROM ast LEFT JOIN customer ON externalId = 'customer:' || c_custkey""",
    ("ast",),
)
def compare_duplicates(v):
    tree = v.assets()
    rich = v.table("customer").where("c_acctbal > 9000")
    rich = rich.select(F.concat(F.lit("customer:"), F.col("c_custkey")).alias("externalId"))
    copies = tree.join(rich, "externalId", "left_semi").withColumn("name", F.lit("copy"))
    found = compare.compare(tree, tree.unionByName(copies), ["rootExternalId", "externalId"])
    return found.groupBy("change", "externalId").agg(F.count("*").alias("copies"))


@query(
    "asset_equals",
    f"SELECT externalId, {_SAME} AS equal FROM ast a JOIN ast_in i USING (externalId)".replace(
        "a.externalId IS NOT DISTINCT FROM i.externalId AND ", ""
    ),
    ("ast_in",),
)
def asset_equals(v):
    sides = [v.assets(), v.assets_incoming()]
    left, right = [df.select("externalId", compare.fingerprint(df, [*FIELDS, "metadata"]).alias(f"_p{i}")) for i, df in enumerate(sides)]
    return left.join(right, "externalId").select("externalId", (F.col("_p0") == F.col("_p1")).alias("equal"))


@query(
    "synchronize_hierarchies",
    "SELECT externalId, name, parentExternalId, description, source, dataSetId FROM ast_in",
    ("ast_in",),
)
def synchronize_hierarchies(v):
    _, _, table = compare.synchronize(v.assets(), v.assets_incoming(), "rootExternalId")
    return table.select(*FIELDS)


@query(
    "asset_lookup",
    """SELECT a.id, a.externalId, a.name, r.name AS rootName FROM ast a
       LEFT JOIN (SELECT * FROM ast WHERE id = rootId) r ON a.rootId = r.id""",
    ("ast",),
)
def asset_lookup(v):
    return hierarchy.build_asset_lookup(v.assets()).select("id", "externalId", "name", "rootName")
