"""Files: headers and their binaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.batching import assign_batches
from tagloom.operators.reads import list_many, list_resource
from tagloom.operators.upsert import addressed, upsert
from tagloom.request import Request
from tagloom.session import is_small, small_side


def read_files(headers: DataFrame, binaries: DataFrame, request: Request | None = None) -> DataFrame:
    """Headers that match, each with its binary (by id); a header without a binary stays."""
    return attach_binaries(list_resource(headers, request), binaries)


def read_many_files(
    headers: DataFrame, binaries: DataFrame, requests: DataFrame, equals: Mapping[str, Column]
) -> DataFrame:
    """Files of a table of requests: (request_id, header..., binary)."""
    return attach_binaries(list_many(headers, requests, equals), binaries)


def read_file_batches(
    headers: DataFrame, binaries: DataFrame, requests: DataFrame, equals: Mapping[str, Column], size: int
) -> DataFrame:
    """Files of a table of requests with the number of their batch: (request_id, batch, header..., binary).

    A request's batches hold ``size`` files by id, the last one the rest. Headers are numbered alone, before their
    binaries come to them.
    """
    numbered = assign_batches(list_many(headers, requests, equals), ["request_id"], size, ["id"])
    return attach_binaries(numbered, binaries)


def attach_binaries(headers: DataFrame, binaries: DataFrame) -> DataFrame:
    """Headers with their binary, NULL without one: by id, or by externalId where neither side has an id yet.

    A few headers are sent to the binaries, which then stay put.
    """
    named = F.concat(F.lit("x:"), F.col("externalId"))
    place = F.coalesce(F.concat(F.lit("i:"), F.col("id").cast("string")), named)
    own = F.concat(F.lit("i:"), F.col("id").cast("string"))
    headers = headers.withColumn("_place", place if "externalId" in headers.columns else own)
    payload = binaries.select(
        (place if "externalId" in binaries.columns else own).alias("_place"),
        *[c for c in binaries.columns if c not in ("id", "externalId")],
    )
    columns = ["id", *[c for c in headers.columns if c not in ("id", "_place")], *[c for c in payload.columns if c != "_place"]]
    if not is_small(headers):
        return headers.join(payload, "_place", "left").select(*columns)
    found = payload.join(F.broadcast(headers), "_place")
    with_binary = payload.select("_place").join(F.broadcast(headers.select("_place").distinct()), "_place", "left_semi")
    bare = headers.join(with_binary, "_place", "left_anti").drop("_place")
    return found.select(*columns).unionByName(bare, allowMissingColumns=True)


def write_files(
    headers: DataFrame, binaries: DataFrame, containers: DataFrame, check: bool = True
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(headers, binaries, written) after writing containers: header fields with ``binary``.

    A container may name its file by externalId or by id alone. A new header without an id keeps its binary under its
    externalId. A written binary replaces the stored one as a whole, so stored binaries only meet the written keys. Every
    container is joined back to its stored header by externalId; a container without one fails the job when
    ``check`` is set.
    """
    if "id" in containers.columns:
        containers = addressed(headers, containers)
    fields = [c for c in headers.columns if c in containers.columns]
    stored = upsert(headers, containers.select(*fields), ["externalId"])
    given = containers.where(F.col("binary").isNotNull()).select("externalId", "binary")
    keys = small_side(given.select("externalId"))
    ids = stored.select("externalId", "id").join(keys, "externalId", "left_semi")
    fresh = given.join(ids, "externalId")
    replaced = binaries.join(keys, "externalId", "left_anti")
    kept = replaced.unionByName(fresh, allowMissingColumns=True).select(*binaries.columns)
    written = containers.select("externalId", "binary").join(
        stored.withColumn("_stored", F.lit(True)), "externalId", "left"
    )
    if check:
        failure = F.raise_error(F.lit("a written file has no stored header"))
        written = written.withColumn("_stored", F.coalesce("_stored", failure))
    return stored, kept, written.where("_stored").drop("_stored")
