"""Three-way comparison of two asset collections, and making one equal to the other."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import map_entries_sorted
from tagloom.operators.hierarchy import NODE, check_integrity, delete_assets
from tagloom.operators.upsert import dedupe_latest, upsert
from tagloom.session import materialize, small_side

# The fields that make two assets equal.
EQUALITY_FIELDS = (
    "externalId",
    "name",
    "parentExternalId",
    "description",
    "metadata",
    "source",
    "dataSetId",
    "labels",
)


def equality_text(df: DataFrame, fields: Sequence[str] = EQUALITY_FIELDS) -> Column:
    """The equality fields as one text. Unset and empty text differ, except for the name; map order is ignored."""

    def normal(name: str) -> Column:
        kind = df.schema[name].dataType.typeName()
        if kind == "map":
            return map_entries_sorted(F.col(name))
        if kind == "array":
            return F.coalesce(F.col(name), F.array())
        return F.coalesce(F.col(name), F.lit("")) if name == "name" else F.col(name)

    return F.to_json(F.struct(*[normal(f).alias(f) for f in fields]))


def fingerprint(df: DataFrame, fields: Sequence[str] = EQUALITY_FIELDS) -> Column:
    """Digest of the equality fields."""
    return F.sha2(equality_text(df, fields), 256)


def classify(
    current: DataFrame, incoming: DataFrame, key: Sequence[str], fields: Sequence[str] = EQUALITY_FIELDS
) -> DataFrame:
    """(key, change, rows) for every key of either side, from one partially aggregated shuffle of digests.

    Only the two rows of one key are ever compared. A digest is two 64-bit hashes: fixed-width values keep
    the aggregation hash-based.
    """

    def side(df: DataFrame, given: int) -> DataFrame:
        text = equality_text(df, [f for f in fields if f in df.columns])
        return df.select(
            *key, F.lit(given).alias("_given"), F.xxhash64(text).alias("_p"), F.xxhash64(F.lit(1), text).alias("_q")
        )

    is_given = F.col("_given") == 1
    both = side(current, 0).unionByName(side(incoming, 1))
    stats = both.groupBy(*key).agg(
        F.sum("_given").alias("_in"),
        F.sum(1 - F.col("_given")).alias("_cur"),
        *[F.max(F.when(is_given, F.col(c))).alias(f"_in{c}") for c in ("_p", "_q")],
        *[F.max(F.when(~is_given, F.col(c))).alias(f"_cur{c}") for c in ("_p", "_q")],
    )
    same = (F.col("_in_p") == F.col("_cur_p")) & (F.col("_in_q") == F.col("_cur_q"))
    change = (
        F.when(F.col("_in") > 1, "invalid")
        .when(F.col("_in") == 0, "delete")
        .when(F.col("_cur") != 1, "insert")
        .when(same, "unchanged")
        .otherwise("update")
    )
    rows = F.when(F.col("_in") == 0, F.col("_cur")).otherwise(F.col("_in"))
    return stats.select(*key, change.alias("change"), rows.alias("rows"))


def compare(
    current: DataFrame, incoming: DataFrame, key: Sequence[str], fields: Sequence[str] = EQUALITY_FIELDS
) -> DataFrame:
    """Rows with their change: ``delete`` carries stored rows, every other change the incoming ones.

    Copies of one incoming key cannot be compared: all of them come out once, as ``invalid``, to be upserted.
    """
    changes = classify(current, incoming, key, fields).drop("rows")
    names = [f"_k{i}" for i in range(len(key))]
    changes = changes.select("change", *[F.col(k).alias(n) for k, n in zip(key, names)])
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)]
    columns = [c for c in current.columns if c in incoming.columns]
    given = incoming.select(*columns).join(changes, same)
    gone = current.select(*columns).join(changes.where(F.col("change") == "delete"), same)
    return given.unionByName(gone).select("change", *columns)


def change_counts(
    current: DataFrame, incoming: DataFrame, key: Sequence[str], fields: Sequence[str] = EQUALITY_FIELDS
) -> DataFrame:
    """Number of rows per change; needs no join back to the rows."""
    return classify(current, incoming, key, fields).groupBy("change").agg(F.sum("rows").alias("rows"))


def limit_to_data_sets(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored assets in the data sets of the input; data set 0 in the input means assets without a data set."""
    asked = incoming.select(F.coalesce("dataSetId", F.lit(0)).alias("_set")).distinct()
    tagged = current.withColumn("_set", F.coalesce("dataSetId", F.lit(0)))
    return tagged.join(small_side(asked), "_set", "left_semi").select(*current.columns)


def synchronize(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    fields: Sequence[str] = EQUALITY_FIELDS,
    by_data_set: bool = True,
    check: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(upserts, deletes, new table): stored hierarchies made equal to the input, per root ``key``.

    Only hierarchies named by the input are touched. Deletes take their subtrees, after the upserts have
    moved whatever the input keeps.
    """
    incoming = materialize(incoming, "batch")
    if check:
        broken = check_integrity(incoming, key).limit(10).collect()
        if broken:
            raise ValueError("invalid hierarchies: " + "; ".join(f"{r[key]} {r['rule']}" for r in broken))
    scope = limit_to_data_sets(current, incoming) if by_data_set else current
    roots = small_side(incoming.select(key).distinct())
    scope = scope.join(roots, key, "left_semi")
    # Both results are read several times below; written tables keep their plans apart.
    changes = materialize(compare(scope, incoming, [key, NODE], fields), "changes")
    upserts = changes.where(F.col("change").isin("insert", "update", "invalid")).drop("change")
    deletes = changes.where(F.col("change") == "delete").drop("change")
    # Copies of one key are all reported; the table can hold one of them, the same one in every run.
    present = [f for f in fields if f in upserts.columns]
    single = dedupe_latest(upserts, [NODE], [fingerprint(upserts, present).desc()])
    written = materialize(upsert(current, single, [NODE], mode="replace"), "synchronized")
    remaining, _ = delete_assets(written, deletes.select(NODE))
    return upserts, deletes, remaining
