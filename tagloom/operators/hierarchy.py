"""Asset trees: levels and paths, order of writing, validation, subtree deletes, root lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators.reads import retrieve
from tagloom.operators.upsert import upsert
from tagloom.session import materialize, small_side

NODE, PARENT = "externalId", "parentExternalId"
SAMPLES = 10
#: Levels below the listed nodes that a subtree is looked for in one by one.
FEW_LEVELS = 4


def _climb(nodes: DataFrame, paths: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Follow parent links upwards, doubling the distance in every round.

    ``nodes`` has (node, ptr, flag), one row per node. Every row comes to cover its node and 2^r - 1 ancestors:
    ``top`` is the last of them, ``hops`` its distance, ``path`` the nodes in between from the node upwards,
    ``flag`` whether any of them is flagged, and ``ptr`` the next ancestor, NULL at the end. A tree of depth d
    takes log2(d) rounds; a round joins only the rows that are still climbing and writes only those. ``path`` stays
    empty unless ``paths`` is set, and rows of a cycle would double it in every round: ask for it only where it is used.

    Returns (finished rows, rows that never finish because they lead into a cycle, or None).
    """
    own = F.array("node") if paths else F.array().cast("array<string>")
    state = materialize(nodes, "nodes").select(
        "node", "ptr", "flag", F.col("node").alias("top"), F.lit(0).cast("long").alias("hops"), own.alias("path")
    )
    finished = [state.where(F.col("ptr").isNull())]
    climbing = state.where(F.col("ptr").isNotNull())
    everything, left = state, None
    while True:
        above = everything.select(
            F.col("node").alias("_node"), *[F.col(c).alias(f"_{c}") for c in ("ptr", "flag", "top", "hops", "path")]
        )
        joined = climbing.join(above, F.col("ptr") == F.col("_node"), "left").select(
            "node",
            F.col("_ptr").alias("ptr"),
            (F.col("flag") | F.coalesce("_flag", F.lit(False))).alias("flag"),
            # A parent outside the given nodes ends the climb at the node below it.
            F.coalesce("_top", "top").alias("top"),
            F.when(F.col("_node").isNull(), F.col("hops")).otherwise(F.col("hops") + 1 + F.col("_hops")).alias("hops"),
            F.concat("path", F.coalesce("_path", F.array().cast("array<string>"))).alias("path"),
        )
        written = materialize(joined, "climb")
        finished.append(written.where(F.col("ptr").isNull()))
        climbing = written.where(F.col("ptr").isNotNull())
        before, left = left, climbing.count()
        if left == 0 or left == before:
            # While an open chain remains, every round finishes some row; no progress means only cycles remain.
            break
        everything = reduce(DataFrame.unionByName, finished, climbing)
    return reduce(DataFrame.unionByName, finished), (climbing if left else None)


def _nodes(assets: DataFrame, flag=None) -> DataFrame:
    parent = F.when(F.col(PARENT) != "", F.col(PARENT))
    return assets.select(
        F.col(NODE).alias("node"), parent.alias("ptr"), (F.lit(False) if flag is None else flag).alias("flag")
    )


def hierarchy_levels(assets: DataFrame) -> DataFrame:
    """(externalId, root, depth, path) of every node; a node whose parent is not given counts as a root.

    The nodes must be unique. A cycle is an error.
    """
    done, cyclic = _climb(_nodes(assets))
    if cyclic is not None:
        raise ValueError("the parent links contain a cycle")
    return done.select(
        F.col("node").alias(NODE),
        F.col("top").alias("root"),
        F.col("hops").alias("depth"),
        F.reverse("path").alias("path"),
    )


def asset_properties(assets: DataFrame) -> DataFrame:
    """Assets with depth, path and childCount."""
    children = (
        assets.where(F.col(PARENT) != "").groupBy(F.col(PARENT).alias(NODE)).agg(F.count("*").alias("childCount"))
    )
    levels = hierarchy_levels(assets).select(NODE, "depth", "path")
    return (
        assets.join(levels, NODE, "left")
        .join(children, NODE, "left")
        .withColumn("childCount", F.coalesce("childCount", F.lit(0)))
    )


def topological_level(assets: DataFrame) -> DataFrame:
    """Assets with the level they can be written at: parents before children, a parent outside the batch is met."""
    done, cyclic = _climb(_nodes(assets), paths=False)
    if cyclic is not None:
        raise ValueError("the parent links contain a cycle")
    return assets.join(done.select(F.col("node").alias(NODE), F.col("hops").alias("level")), NODE, "left")


def detect_cycles(assets: DataFrame) -> DataFrame:
    """Members of cycles of parent links; nodes that only hang below a cycle are not members."""
    unique = assets.select(NODE, PARENT).where(F.col(NODE).isNotNull()).dropDuplicates([NODE])
    _, cyclic = _climb(_nodes(unique), paths=False)
    if cyclic is None:
        return unique.select(NODE).where(F.lit(False))
    # The nodes reached by going up 1, 2, 4, ... steps never grow in number. Once a doubling reaches as many as
    # before, going up only permutes them: they are the members.
    links = cyclic.select("node", "ptr")
    reached = links.select("ptr").distinct().count()
    while True:
        further = links.select(F.col("node").alias("ptr"), F.col("ptr").alias("_next"))
        links = materialize(links.join(further, "ptr").select("node", F.col("_next").alias("ptr")), "cycle")
        before, reached = reached, links.select("ptr").distinct().count()
        if reached == before:
            return links.select(F.col("ptr").alias(NODE)).distinct()


def validate_assets(assets: DataFrame, cycles: bool = True) -> DataFrame:
    """Broken rules of one batch: (rule, externalId, name, copies)."""
    # Every rule reads the batch again: write the three columns they need once.
    assets = materialize(assets.select(NODE, PARENT, "name"), "batch")
    row = lambda rule: (F.lit(rule).alias("rule"), NODE, "name", F.lit(1).cast("long").alias("copies"))
    missing = assets.where(F.col(NODE).isNull()).select(*row("missing_external_id"))
    own_parent = assets.where(F.col(NODE) == F.col(PARENT)).select(*row("self_reference"))
    twice = (
        assets.where(F.col(NODE).isNotNull())
        .groupBy(NODE)
        .agg(F.count("*").alias("copies"), F.min("name").alias("name"))
        .where(F.col("copies") > 1)
        .select(F.lit("duplicate").alias("rule"), NODE, "name", "copies")
    )
    found = missing.unionByName(own_parent).unionByName(twice)
    if not cycles:
        return found
    # A row that is its own parent is reported by its own rule.
    others = assets.where((F.col(NODE) != F.col(PARENT)) | F.col(PARENT).isNull())
    members = detect_cycles(others)
    names = others.groupBy(NODE).agg(F.min("name").alias("name"))
    cyclic = names.join(members, NODE, "left_semi")
    return found.unionByName(cyclic.select(*row("cycle")))


def check_integrity(assets: DataFrame, key: str) -> DataFrame:
    """Broken rules per hierarchy: (key, rule, count, samples); at most ten samples each.

    Every hierarchy needs exactly one root, and the parent of every other node.
    """
    rooted = F.coalesce(F.col(PARENT), F.lit("")) == ""
    roots = assets.where(rooted).select(key, NODE)
    counts = assets.groupBy(key).agg(F.sum(F.when(rooted, 1).otherwise(0)).alias("count"))
    wrong_roots = counts.where(F.col("count") != 1).select(key, F.lit("root_count").alias("rule"), "count")
    lost = assets.where(~rooted).join(
        assets.select(key, F.col(NODE).alias(PARENT)).distinct(), [key, PARENT], "left_anti"
    )
    lost_counts = lost.groupBy(key).agg(F.count("*").alias("count")).select(
        key, F.lit("invalid_parent").alias("rule"), "count"
    )
    shown = roots.select(key, F.lit("root_count").alias("rule"), NODE).unionByName(
        lost.select(key, F.lit("invalid_parent").alias("rule"), NODE)
    )
    first = W.partitionBy(key, "rule").orderBy(NODE)
    samples = (
        shown.withColumn("_rn", F.row_number().over(first))
        .where(F.col("_rn") <= SAMPLES)
        .groupBy(key, "rule")
        .agg(F.concat_ws(",", F.sort_array(F.collect_list(NODE))).alias("samples"))
    )
    return (
        wrong_roots.unionByName(lost_counts)
        .join(samples, [key, "rule"], "left")
        .select(key, "rule", F.col("count").cast("long").alias("count"), F.coalesce("samples", F.lit("")).alias("samples"))
    )


def build_asset_lookup(assets: DataFrame) -> DataFrame:
    """Every asset with an id, plus ``rootName``: the name of the row its rootId points to, NULL if unknown."""
    known = assets.where(F.col("id").isNotNull())
    roots = known.where(F.col("rootId") == F.col("id")).select("rootId", F.col("name").alias("rootName"))
    return known.join(small_side(roots), "rootId", "left").select(*assets.columns, "rootName")


def subtrees(assets: DataFrame, items: DataFrame, levels: int = FEW_LEVELS) -> DataFrame:
    """(externalId) of the listed assets and all nodes below them, also of a cycle that they lead into.

    Goes down ``levels`` levels from the listed nodes: each reads the links of the table and moves only what it finds.
    If the trees go on, all nodes not met yet climb towards a met one at doubling distances, so a chain of any depth
    takes a logarithm of rounds.
    """
    links = assets.select(NODE, F.col(PARENT).alias("_up")).where(F.col(NODE).isNotNull())
    level = materialize(retrieve(assets, items).select(NODE).where(F.col(NODE).isNotNull()).distinct(), "listed")
    met = level
    for _ in range(levels):
        above = small_side(level.select(F.col(NODE).alias("_up")))
        below = links.where("_up <> ''").join(above, "_up", "left_semi").select(NODE).distinct()
        level = materialize(below.join(met, NODE, "left_anti"), "below")
        if level.isEmpty():
            return met
        met = met.unionByName(level)
    marked = links.dropDuplicates([NODE]).join(small_side(met.withColumn("_met", F.lit(True))), NODE, "left")
    nodes = marked.select(
        F.col(NODE).alias("node"), F.when(F.col("_met").isNull() & (F.col("_up") != ""), F.col("_up")).alias("ptr"), F.col("_met").isNotNull().alias("flag")
    )
    # A met node climbs no further. Rows that never finish lead into a cycle without one: they stay.
    done, _ = _climb(nodes, paths=False)
    return done.where("flag").select(F.col("node").alias(NODE))


def delete_assets(assets: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(remaining, deleted) after removing the listed assets with their whole subtrees."""
    gone = small_side(subtrees(assets, items))
    return assets.join(gone, NODE, "left_anti"), assets.join(gone, NODE, "left_semi")


def write_assets(
    current: DataFrame, incoming: DataFrame, hierarchy_key: str | None = None, mode: str = "update"
) -> DataFrame:
    """The asset table after writing one batch as a unit: any broken rule fails the write.

    With ``hierarchy_key`` the batch holds several hierarchies and each is also checked for one root and
    valid parents.
    """
    incoming = materialize(incoming, "batch")
    broken = validate_assets(incoming).select("rule", F.coalesce(NODE, "name").alias("sample"))
    if hierarchy_key is not None:
        broken = broken.unionByName(check_integrity(incoming, hierarchy_key).select("rule", F.col("samples").alias("sample")))
    first = broken.limit(SAMPLES).collect()
    if first:
        raise ValueError("the asset batch is not valid: " + "; ".join(f"{r['rule']}: {r['sample']}" for r in first))
    return upsert(current, incoming, [NODE], mode)
