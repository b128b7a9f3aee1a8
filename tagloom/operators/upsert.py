"""Writes as joins: upsert, delete, external ids, run rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.columns import all_of
from tagloom.operators.reads import retrieve, without
from tagloom.session import is_small, materialize

# Statuses a pipeline run may report.
RUN_STATUSES = ("SUCCESS", "SEEN")


def dedupe_latest(df: DataFrame, key: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last by ``order_by``. The rank limit also runs before the shuffle."""
    latest = W.partitionBy(*key).orderBy(*[F.desc(c) if isinstance(c, str) else c for c in order_by])
    return df.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1").drop("_rn")


def ensure_external_id(df: DataFrame, deterministic: bool = True, id_col: str = "id") -> DataFrame:
    """Give rows with neither id nor externalId one: a digest of the row, or a random UUID.

    Equal rows are numbered, and the second and later ones have the number in their digest, so each gets its own.
    Use the digest wherever the result feeds more than one action: a UUID changes when a task runs again.
    """
    if deterministic:
        rest = [c for c in df.columns if c != "externalId"]
        digest = F.sha2(F.to_json(F.struct(*rest)), 256)
    else:
        digest = F.uuid()
    missing = F.col("externalId").isNull()
    if id_col in df.columns:
        missing = missing & F.col(id_col).isNull()
    if not deterministic:
        return df.withColumn("externalId", F.when(missing, digest).otherwise(F.col("externalId")))
    bare = df.where(missing).withColumn("_digest", digest)
    bare = bare.withColumn("_copy", F.row_number().over(W.partitionBy("_digest").orderBy("_digest")))
    again = F.sha2(F.concat_ws(":", "_digest", "_copy"), 256)
    named = bare.withColumn("externalId", F.when(F.col("_copy") == 1, F.col("_digest")).otherwise(again))
    return df.where(~missing).unionByName(named.drop("_digest", "_copy"))


def addressed(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows with the externalId that the table has for their id, where they carry an id only."""
    if "externalId" not in incoming.columns:
        incoming = incoming.withColumn("externalId", F.lit(None).cast(current.schema["externalId"].dataType))
    by_id = F.col("externalId").isNull() & F.col("id").isNotNull()
    bare = incoming.where(by_id)
    if bare.isEmpty():
        return incoming
    ids = bare.select(F.col("id").alias("_id")).distinct()
    known = current.select(F.col("id").alias("_id"), F.col("externalId").alias("_known"))
    if is_small(ids):
        # At most one stored row per id: what is found is as small as what was asked for.
        known = F.broadcast(known.join(F.broadcast(ids), "_id", "left_semi"))
    named = bare.join(known, F.col("id") == F.col("_id"), "left").withColumn("externalId", F.col("_known"))
    return incoming.where(~by_id).unionByName(named.select(*incoming.columns))


def targeted(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming rows with ``_target``: the key of the row they are written to (:func:`stored_key`).

    A row is written to the stored row with its externalId, else to the stored row with its id, else it is new. A stored
    row is known by its externalId, or by its id where it has none. Naming two stored rows at once fails the job.
    """
    kinds = {c: current.schema[c].dataType for c in ("externalId", "id")}
    named = incoming
    for c, kind in kinds.items():
        given = F.col(c) if c in incoming.columns else F.lit(None)
        named = named.withColumn(f"_given_{c}", given.cast(kind))
    own = stored_key("_given_externalId", "_given_id")
    named = named.withColumn("_target", own)
    if named.where(F.col("_given_id").isNotNull()).isEmpty():
        return named.drop("_given_externalId", "_given_id")
    ids = named.select(F.col("_given_id").alias("_id")).where("_id IS NOT NULL").distinct()
    names = named.select(F.col("_given_externalId").alias("_name")).where("_name IS NOT NULL").distinct()
    by_id = current.where(F.col("id").isNotNull()).select(F.col("id").alias("_id"), stored_key("externalId", "id").alias("_by_id"))
    by_name = current.where(F.col("externalId").isNotNull()).select(F.col("externalId").alias("_name"), F.col("id").alias("_its_id"))
    if is_small(ids) and is_small(names):
        # At most one stored row per id or name: what is found is as small as what was asked for.
        by_id = F.broadcast(by_id.join(F.broadcast(ids), "_id", "left_semi"))
        by_name = F.broadcast(by_name.join(F.broadcast(names), "_name", "left_semi"))
    by_name = by_name.withColumn("_has_name", F.lit(True))
    met = named.join(by_id, F.col("_given_id") == F.col("_id"), "left").join(by_name, F.col("_given_externalId") == F.col("_name"), "left")
    two = F.col("_has_name") & F.col("_by_id").isNotNull() & (F.col("_by_id") != F.col("_target"))
    wrong = F.raise_error(F.format_string("id %s and externalId %s name two stored rows", F.col("_given_id").cast("string"), F.col("_given_externalId")))
    target = F.when(two, wrong.cast("string")).when(F.col("_has_name"), F.col("_target"))
    return met.withColumn("_target", target.otherwise(F.coalesce("_by_id", "_target"))).select(*incoming.columns, "_target")


def stored_key(name: str, number: str) -> Column:
    """How a stored row is known: by its externalId, else by its id; NULL if it has neither."""
    by_number = F.concat(F.lit("id:"), F.col(number).cast("string"))
    return F.coalesce(F.concat(F.lit("name:"), F.col(name).cast("string")), by_number)


def require_one_row_per_key(rows: DataFrame, key: Sequence[str]) -> None:
    """Fail if several rows have one key; rows without a key are told apart. Counted with map-side partial counts."""
    named = rows.where(all_of(F.col(c).isNotNull() for c in key))
    twice = named.groupBy(*key).count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"several incoming rows are written to one row: {[tuple(r)[:-1] for r in twice]}; see dedupe_latest")


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    mode: str = "update",
    merge_maps: bool = False,
    keep: Sequence[str] = ("id", "externalId"),
) -> DataFrame:
    """The table after writing ``incoming``, which must hold one row per stored row (see :func:`dedupe_latest`); it fails
    if it holds more.

    With the key ``externalId``, rows meet by id where a side has no externalId (:func:`targeted`).
    ``update`` overwrites only fields that are set; ``replace`` takes the whole incoming row but keeps the
    columns of ``keep``. A small incoming side is broadcast, so the stored table is not shuffled at all;
    otherwise both sides meet in one full outer join.
    """
    if mode not in ("update", "replace"):
        raise ValueError(f"unknown mode: {mode}")
    key = list(key)
    columns = current.columns
    stored = current
    if key == ["externalId"] and "id" in columns:
        incoming = targeted(current, incoming)
        stored, key = current.withColumn("_target", stored_key("externalId", "id")), ["_target"]

    def given(name: str) -> Column:
        kind = current.schema[name].dataType
        if name not in incoming.columns:
            return F.lit(None).cast(kind)
        same = incoming.schema[name].dataType.simpleString() == kind.simpleString()
        return F.col(name) if same else F.col(name).cast(kind)

    fresh = incoming.select(
        *key, F.lit(True).alias("_new"), *[given(c).alias(f"_n_{c}") for c in columns if c not in key]
    )

    def merged(name: str) -> Column:
        if name in key:
            return F.col(name)
        old, new = F.col(name), F.col(f"_n_{name}")
        if mode == "update" and merge_maps and current.schema[name].dataType.typeName() == "map":
            kept = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key(new, k), F.lit(False)))
            return F.when(new.isNotNull() & old.isNotNull(), F.map_concat(kept, new)).otherwise(F.coalesce(new, old))
        if mode == "update" or name in keep:
            return F.coalesce(new, old)
        return F.when(F.col("_new"), new).otherwise(old)

    result = [merged(c).alias(c) for c in columns]
    # Written once, the incoming rows are not computed again for each of their uses.
    fresh = materialize(fresh, "incoming")
    require_one_row_per_key(fresh, key)
    if not is_small(fresh):
        return stored.join(fresh, key, "full_outer").select(*result)
    written = stored.join(F.broadcast(fresh), key, "left").select(*result)
    known = stored.select(*key).join(F.broadcast(fresh.select(*key)), key, "left_semi")
    added = fresh.join(known, key, "left_anti").select(
        *[(F.col(c) if c in key else F.col(f"_n_{c}")).alias(c) for c in columns]
    )
    return written.unionByName(added)


def delete(
    table: DataFrame, items: DataFrame, keys: Sequence[str] = ("id", "externalId")
) -> tuple[DataFrame, DataFrame]:
    """(remaining, deleted) after removing the rows whose id or externalId is listed."""
    return without(table, items, keys), retrieve(table, items, keys=keys)


def delete_by_key(table: DataFrame, rows: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(remaining, deleted) after removing the rows with a listed composite key."""
    listed = rows.select(*key).distinct()
    listed = F.broadcast(listed) if is_small(listed) else listed
    return table.join(listed, list(key), "left_anti"), table.join(listed, list(key), "left_semi")


def delete_series(
    headers: DataFrame, points: DataFrame, items: DataFrame, series: str = "externalId"
) -> tuple[DataFrame, DataFrame]:
    """(headers, points) after deleting series: their points go with them."""
    remaining, deleted = delete(headers, items)
    return remaining, delete_by_key(points, deleted.select(series), [series])[0]


def pipeline_run(written: DataFrame, external_id: str, status: str, verb: str = "upserted") -> DataFrame:
    """One run row for a finished write; a batch write of nothing still reports 0."""
    if status not in RUN_STATUSES:
        raise ValueError(f"the status must be one of {RUN_STATUSES}")
    return written.agg(F.count("*").alias("n")).select(*run_columns(external_id, status, verb, F.col("n")))


def run_columns(external_id: str, status: str, verb: str, count: Column) -> list[Column]:
    """The columns of a run row."""
    return [
        F.lit(external_id).alias("externalId"),
        F.lit(status).alias("status"),
        F.format_string("Number of data objects %s: %d", F.lit(verb), count).alias("message"),
    ]


def write_with_run(rows: DataFrame, path: str, runs_path: str, external_id: str, status: str = "SUCCESS") -> int:
    """Write rows and report the run with their number, counted while they are written. A failed write reports nothing."""
    counter = Observation()
    rows.observe(counter, F.count("*").alias("n")).write.parquet(path)
    written = counter.get["n"]
    one = rows.sparkSession.range(1)
    append_runs(one.select(*run_columns(external_id, status, "upserted", F.lit(written))), runs_path)
    return written


def append_runs(runs: DataFrame, path: str) -> None:
    """Append run rows as given."""
    runs.select("externalId", "status", "message").write.mode("append").parquet(path)
