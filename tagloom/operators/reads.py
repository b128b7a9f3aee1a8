"""Reads of one resource: by request, by a table of requests, by ids, and their counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import DAY_MS, all_of
from tagloom.operators.batching import group_into_batches, running_totals
from tagloom.request import Request
from tagloom.session import materialize, salt_count, small_side


def list_resource(
    table: DataFrame,
    request: Request | None = None,
    fields: Mapping[str, Column] | None = None,
    timestamps: Mapping[str, Column] | None = None,
    key: str = "id",
) -> DataFrame:
    """Rows that match the request; an empty request means all. ``first_n`` keeps the first by ``key``."""
    request = request or Request()
    rows = table.where(request.condition(fields, timestamps))
    if request.items:
        rows = retrieve(rows, _items_frame(table, request.items))
    return rows.orderBy(key).limit(request.first_n) if request.first_n > 0 else rows


def aggregate(
    table: DataFrame,
    request: Request | None = None,
    fields: Mapping[str, Column] | None = None,
    timestamps: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Number of rows that match the request: one row."""
    return list_resource(table, request, fields, timestamps).agg(F.count("*").alias("count"))


def _items_frame(table: DataFrame, items: Sequence[Mapping]) -> DataFrame:
    return table.sparkSession.createDataFrame(
        [(i.get("id"), i.get("externalId")) for i in items], "id long, externalId string"
    )


#: Root parameters that bound the time, as ``filter.lastUpdatedTime`` does.
ROOT_TIMES = ("minLastUpdatedTime", "maxLastUpdatedTime")


def parse_requests(
    requests: DataFrame,
    equals: Sequence[str],
    json_col: str = "request",
    metadata_keys: Sequence[str] = (),
    root_keys: Sequence[str] = (),
) -> DataFrame:
    """A column of request JSON as a table of requests: one column per filter key, ``min`` and ``max``.

    A list value means any-of, and ``items`` names rows by ``id`` or ``externalId`` (both must then be keys of
    ``equals``): such a request becomes one row per combination, under one request id. An empty list matches nothing.
    The root parameters ``minLastUpdatedTime`` and ``maxLastUpdatedTime`` narrow the time range; those named by
    ``root_keys`` become columns of text. Malformed JSON, an unknown filter or an unknown parameter fails the job instead
    of widening the request.
    """
    rest = [F.col(c) for c in requests.columns if c != json_col]
    # Every step stands behind a generator, so the text is parsed, and the body taken apart, once.
    body = requests.select(*rest, F.inline(F.array(F.struct(F.try_parse_json(json_col).alias("_body")))))
    part = lambda path, kind: F.try_variant_get("_body", path, kind)
    members = "map<string,variant>"
    opened = body.select(
        *rest,
        F.inline(
            F.array(
                F.struct(
                    part("$", members).alias("_root"),
                    part("$.filter", members).alias("_filter"),
                    part("$.filter.metadata", members).alias("_metadata"),
                    part("$.filter.lastUpdatedTime", members).alias("_time"),
                    part("$.items", "array<struct<id:string,externalId:string>>").alias("_items"),
                )
            )
        ),
    )
    keys = lambda of: F.coalesce(F.map_keys(of), F.array().cast("array<string>"))
    listed = lambda names: F.array(*map(F.lit, names)).cast("array<string>")
    strange = F.concat(
        F.array_except(keys("_root"), listed(("filter", "items", *ROOT_TIMES, *root_keys))),
        F.array_except(keys("_filter"), listed([*equals, "metadata", "lastUpdatedTime"])),
        F.array_except(keys("_metadata"), listed(metadata_keys)),
        F.array_except(keys("_time"), listed(("min", "max"))),
    )
    problem = F.when(F.col("_root").isNull(), "a request is not a JSON object").when(
        F.size(strange) > 0, F.concat(F.lit("unknown parts of a request: "), F.array_join(strange, ", "))
    )
    checked = opened.where(F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True)))

    def member(of: str, name: str, kind: str) -> Column:
        return F.try_variant_get(F.try_element_at(of, F.lit(name)), "$", kind)

    def values(name: str) -> Column:
        kind = F.schema_of_variant(F.try_element_at("_filter", F.lit(name)))
        several = F.array_distinct(member("_filter", name, "array<string>"))
        return F.when(kind.startswith("ARRAY"), several).otherwise(F.array(member("_filter", name, "string")))

    parsed = checked.select(
        *rest,
        *[values(k).alias(f"_v_{k}") for k in equals],
        "_items",
        *[member("_metadata", k, "string").alias(k) for k in metadata_keys],
        *[member("_root", k, "string").alias(k) for k in root_keys],
        F.greatest(member("_time", "min", "bigint"), member("_root", ROOT_TIMES[0], "bigint")).alias("min"),
        F.least(member("_time", "max", "bigint"), member("_root", ROOT_TIMES[1], "bigint")).alias("max"),
    )
    for k in equals:
        parsed = parsed.withColumn(f"_v_{k}", F.explode(f"_v_{k}"))
    parsed = parsed.withColumn("_item", F.explode(F.coalesce(F.array_distinct("_items"), F.array(F.lit(None).cast("struct<id:string,externalId:string>")))))
    item = {"id": F.col("_item.id"), "externalId": F.when(F.col("_item.id").isNull(), F.col("_item.externalId"))}
    unnamed = [k for k in item if k not in equals]
    if unnamed:
        failure = F.raise_error(F.lit(f"items need the keys id and externalId; missing: {unnamed}"))
        parsed = parsed.where(F.when(F.col("_item").isNotNull(), failure.cast("boolean")).otherwise(F.lit(True)))
    return parsed.select(
        *rest,
        *[F.coalesce(item[k], F.col(f"_v_{k}")).alias(k) if k in item else F.col(f"_v_{k}").alias(k) for k in equals],
        *metadata_keys,
        *root_keys,
        "min",
        "max",
    )


def dyadic_cover(low: Column, high: Column, levels: int) -> Column:
    """The fewest dyadic nodes (level, node) that make up low..high: at most two of a level. ``node`` covers the numbers
    that begin with it when their last ``level`` bits are cut off."""
    node = lambda level, number: F.struct(level.cast("int").alias("level"), number.alias("node"))
    empty = F.array().cast("array<struct<level:int,node:bigint>>")

    def step(state: Column, level: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        left = (lo <= hi) & (lo % 2 == 1)
        right = (lo <= hi) & (hi % 2 == 0) & ~(left & (lo == hi))
        found = F.concat(
            state["nodes"], F.when(left, F.array(node(level, lo))).otherwise(empty), F.when(right, F.array(node(level, hi))).otherwise(empty)
        )
        # Both ends move inwards over what was taken, then up one level.
        up = lambda x: F.floor(x / 2).cast("long")
        return F.struct(up(lo + 1).alias("lo"), up(hi - 1).alias("hi"), found.alias("nodes"))

    start = F.struct(low.cast("long").alias("lo"), high.cast("long").alias("hi"), empty.alias("nodes"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda state: state["nodes"])


def list_many(
    table: DataFrame,
    requests: DataFrame,
    equals: Mapping[str, Column],
    time: str = "lastUpdatedTime",
    request_id: str = "request_id",
    bucket_ms: int = DAY_MS,
    timestamps: Mapping[str, Column] | None = None,
    key: Sequence[str] = ("id",),
) -> DataFrame:
    """Evaluate every request on its own: (request_id, row...); overlapping requests give a row several times.

    ``equals`` names the request columns compared for equality and the table expression of each; a NULL in the
    request means no such filter. ``min`` and ``max`` bound ``time`` inclusively, NULL means open; a row without a
    time matches requests that leave both open. Several rows of one request id are one request that takes any of them:
    a row of the table that several of them match is delivered once. Rows are told apart by ``key``, which must
    be unique; it is only needed where rows of one request differ in more than the values they compare.

    Requests fall into shapes by the filters they set. A row offers one join key per shape in use, so all shapes are
    answered by one equi join in one pass over the table. A request that only bounds the time is cut into
    dyadic nodes of time buckets (at most two of a size), and a row offers the nodes it lies in, of the sizes in use:
    open, wide and narrow ranges all meet their rows by equal keys. A node of many buckets, and the node of all
    rows, is split over as many salts as its share of the time asks for, so no key grows with the table. If every request
    bounds the time, the common range also goes to the table as a plain filter, on the stored timestamp where
    ``timestamps`` names it.
    """
    asked, several = _asked(requests, list(equals), request_id)
    if several is None:
        return _hits(table, asked, equals, time, request_id, bucket_ms, timestamps).select(request_id, *table.columns)
    single = _hits(table, asked.join(several, request_id, "left_anti"), equals, time, request_id, bucket_ms, timestamps)
    any_of = _hits(table, asked.join(several, request_id, "left_semi"), equals, time, request_id, bucket_ms, timestamps)
    return single.unionByName(any_of.dropDuplicates([request_id, *key])).select(request_id, *table.columns)


def _asked(requests: DataFrame, names: Sequence[str], request_id: str) -> tuple[DataFrame, DataFrame | None]:
    """The distinct rows of the requests with the filters they set, as bits, in ``_shape``; and the ids of the requests
    whose rows may meet a row of the table twice, if there are any."""
    mask = F.lit(0)
    for i, name in enumerate(names):
        mask = mask + F.when(F.col(name).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0))
    asked = requests.select(request_id, *names, "min", "max").distinct().withColumn("_shape", mask)
    asked = materialize(asked, "requests")
    own = asked.groupBy(request_id).agg(
        F.count("*").alias("_rows"), F.countDistinct("_shape").alias("_shapes"), F.countDistinct(F.struct("min", "max")).alias("_ranges")
    )
    several = own.where((F.col("_rows") > 1) & ((F.col("_shapes") > 1) | (F.col("_ranges") > 1))).select(request_id)
    if several.isEmpty():
        return asked, None
    return asked, small_side(materialize(several, "any-of"))


def _hits(
    table: DataFrame,
    asked: DataFrame,
    equals: Mapping[str, Column],
    time: str,
    request_id: str,
    bucket_ms: int,
    timestamps: Mapping[str, Column] | None,
) -> DataFrame:
    """(request_id, row...) once per row of ``asked`` that a row of the table matches."""
    names = list(equals)
    bucket = lambda ms: F.floor(ms / F.lit(bucket_ms)).cast("long")
    timed = F.col("_shape") == 0
    known = asked.agg(
        F.collect_set("_shape").alias("shapes"),
        F.when(F.count("min") == F.count("*"), F.min("min")).alias("min"),
        F.when(F.count("max") == F.count("*"), F.max("max")).alias("max"),
        F.min(F.when(timed, F.least(bucket(F.col("min")), bucket(F.col("max"))))).alias("first"),
        F.max(F.when(timed, F.greatest(bucket(F.col("min")), bucket(F.col("max"))))).alias("last"),
    ).first()
    shapes = sorted(known["shapes"]) or [0]
    if known["min"] is not None or known["max"] is not None:
        common = Request().with_filter(time, {"min": known["min"], "max": known["max"]})
        table = table.where(common.condition(timestamps=timestamps))
    # Buckets are counted from the one before the first that a request names; all earlier and all later times share one.
    first, last = (known["first"], known["last"]) if known["first"] is not None else (0, 0)
    span = last - first + 2
    number = lambda b: F.least(F.greatest(b - F.lit(first - 1), F.lit(0)), F.lit(span))
    top = span.bit_length()
    salts = salt_count(table.sparkSession)
    # How many salts a node of a level has: its part of the span in parts of the whole; the node of all rows is ``top``.
    share = [min(salts, -(-salts * (1 << level) // (span + 1))) for level in range(top)] + [salts]
    sized = F.array(*[F.lit(n) for n in share])
    low, high = F.col("min"), F.col("max")
    no_node = F.lit(None).cast("struct<level:int,node:bigint>")
    everything = F.struct(F.lit(top).cast("int").alias("level"), F.lit(0).cast("long").alias("node"))
    begin = F.when(low.isNotNull(), number(bucket(low))).otherwise(F.lit(0))
    end = F.when(high.isNotNull(), number(bucket(high))).otherwise(F.lit(span))
    cover = dyadic_cover(begin, end, top - 1)
    nodes = F.when(~timed, F.array(no_node)).when(low.isNull() & high.isNull(), F.array(everything)).otherwise(cover)
    if 0 in shapes:
        asked = asked.withColumn("_node", F.explode(nodes))
        levels = sorted(r[0] for r in asked.where(timed).select("_node.level").distinct().collect())  # at most 64 numbers
        copies = F.when(timed, F.sequence(F.lit(0), F.element_at(sized, F.col("_node.level") + 1) - 1)).otherwise(F.array(F.lit(0)))
        asked = asked.withColumn("_salt", F.explode(copies))
    else:
        levels, asked = [], asked.withColumn("_node", no_node).withColumn("_salt", F.lit(0))
    asked = asked.select(
        F.col(request_id),
        F.col("_shape").alias("_r_shape"),
        F.col("_node.level").alias("_r_level"),
        F.col("_node.node").alias("_r_node"),
        F.col("_salt").alias("_r_salt"),
        *[F.col(n).alias(f"_r_{n}") for n in names],
        low.alias("_r_min"),
        high.alias("_r_max"),
    )
    at = number(bucket(F.col(time)))

    def offer(shape: int, level: int | None = None) -> Column:
        spread = level is not None and share[level] > 1
        own = F.pmod(F.col("_row_salt"), F.lit(share[level])) if spread else F.lit(0)
        node = F.lit(None) if level is None else F.lit(0) if level == top else F.shiftright(at, level)
        return F.struct(
            F.lit(shape).alias("shape"),
            F.lit(level).cast("int").alias("level"),
            node.cast("long").alias("node"),
            own.cast("int").alias("salt"),
            *[
                (equals[n] if shape >> i & 1 else F.lit(None).cast(asked.schema[f"_r_{n}"].dataType)).alias(n)
                for i, n in enumerate(names)
            ],
        )

    offers = [offer(s) for s in shapes if s] + [offer(0, level) for level in levels]
    hashable = [f.name for f in table.schema.fields if "map<" not in f.dataType.simpleString()]
    salted = table.withColumn("_row_salt", F.xxhash64(*hashable)) if levels else table
    if len(offers) == 1:
        offered = salted.withColumn("_offer", offers[0])
        if levels:
            same = [F.col(f"_offer.{c}") == F.col(f"_r_{c}") for c in ("node", "salt")]
        else:
            same = [F.col(f"_offer.{n}") == F.col(f"_r_{n}") for i, n in enumerate(names) if shapes[0] >> i & 1]
    else:
        offered = salted.withColumn("_offer", F.explode(F.array(*offers))) if offers else salted.withColumn("_offer", offer(0))
        compared = ("shape", *(("level", "node", "salt") if levels else ()), *names)
        same = [F.col(f"_offer.{c}").eqNullSafe(F.col(f"_r_{c}")) for c in compared]
    within = (F.col("_r_min").isNull() | (F.col(time) >= F.col("_r_min"))) & (F.col("_r_max").isNull() | (F.col(time) <= F.col("_r_max")))
    # Nodes and salts multiply the requests, which the size that Spark estimates from their file does not show: left
    # to itself it may broadcast all of them.
    return offered.join(small_side(asked, merge=True), all_of(same) & within).select(request_id, *table.columns)


# The ends of a range that is open there.
_FIRST_MS, _LAST_MS = -(2**63), 2**63 - 1


def summarize_many(
    table: DataFrame,
    requests: DataFrame,
    equals: Mapping[str, Column],
    time: str = "lastUpdatedTime",
    request_id: str = "request_id",
    timestamps: Mapping[str, Column] | None = None,
    key: Sequence[str] = ("id",),
) -> DataFrame:
    """(request_id, count, first, last): the rows that :func:`list_many` delivers for each request counted, with their
    earliest and latest ``time``; requests without hits are left out.

    Rows and requests are never paired, so wide ranges cost no more than narrow ones. The times of the rows that share
    the compared values stand in one order with the ends of the requests. The rows that come before an end are counted by
    running totals; a request has those between its two ends. Only requests whose rows may meet a row of the
    table twice are listed.
    """
    asked, several = _asked(requests, list(equals), request_id)
    if several is None:
        return _ranked(table, asked, equals, time, request_id, timestamps)
    single = _ranked(table, asked.join(several, request_id, "left_anti"), equals, time, request_id, timestamps)
    listed = _hits(table, asked.join(several, request_id, "left_semi"), equals, time, request_id, DAY_MS, timestamps)
    listed = listed.select(request_id, F.col(time).cast("long").alias("_t"), *[F.col(k).alias(f"_u_{k}") for k in key])
    listed = listed.dropDuplicates([request_id, *[f"_u_{k}" for k in key]]).groupBy(request_id)
    return single.unionByName(listed.agg(F.count("*").alias("count"), F.min("_t").alias("first"), F.max("_t").alias("last")))


def _ranked(
    table: DataFrame,
    asked: DataFrame,
    equals: Mapping[str, Column],
    time: str,
    request_id: str,
    timestamps: Mapping[str, Column] | None,
) -> DataFrame:
    """(request_id, count, first, last) of requests none of which meets a row of the table twice."""
    unbounded = F.col("min").isNull() & F.col("max").isNull()
    known = asked.agg(
        F.collect_set("_shape").alias("shapes"),
        F.when(F.count("min") == F.count("*"), F.min("min")).alias("min"),
        F.when(F.count("max") == F.count("*"), F.max("max")).alias("max"),
        F.count_if(unbounded).alias("unbounded"),
    ).first()
    shapes = sorted(known["shapes"]) or [0]
    if known["min"] is not None or known["max"] is not None:
        common = Request().with_filter(time, {"min": known["min"], "max": known["max"]})
        table = table.where(common.condition(timestamps=timestamps))

    def offer(shape: int) -> Column:
        compared = lambda i, n: equals[n] if shape >> i & 1 else F.lit(None).cast(asked.schema[n].dataType)
        return F.struct(F.lit(shape).alias("shape"), *[compared(i, n).alias(n) for i, n in enumerate(equals)])

    rows = table.select(F.col(time).cast("long").alias("_t"), F.explode(F.array(*map(offer, shapes))).alias("_values"))
    asked = asked.select(request_id, "min", "max", F.struct(F.col("_shape").alias("shape"), *equals).alias("_values"))
    if shapes != [0]:
        rows = rows.join(small_side(asked.select("_values").distinct()), "_values", "left_semi")
    rows = rows.groupBy("_values", "_t").agg(F.count("*").alias("_n"))
    low = F.struct(F.coalesce(F.col("min").cast("long"), F.lit(_FIRST_MS)).alias("_t"), F.lit(0).alias("_place"))
    high = F.struct(F.coalesce(F.col("max").cast("long"), F.lit(_LAST_MS)).alias("_t"), F.lit(2).alias("_place"))
    ends = asked.select(request_id, "_values", F.inline(F.array(low, high)), F.lit(0).cast("long").alias("_n"))
    # Of equal times the lower end stands before the rows and the upper end after them.
    marks = materialize(rows.withColumn("_place", F.lit(1)).unionByName(ends, allowMissingColumns=True), "marks")
    timed = marks.where(F.col("_t").isNotNull())
    totals = materialize(running_totals(timed, ["_values"], ["_t", "_place"], {"_before": F.col("_n")}), "totals")
    before = lambda place: F.max(F.when(F.col("_place") == place, F.col("_before")))
    met = totals.where("_place <> 1").groupBy(request_id, "_values").agg(before(0).alias("_low"), before(2).alias("_high"))
    met = met.where(F.col("_high") > F.col("_low"))
    times = totals.where("_place = 1")
    first = times.select("_values", F.col("_before").alias("_low"), F.col("_t").alias("first"))
    last = times.select("_values", (F.col("_before") + F.col("_n")).alias("_high"), F.col("_t").alias("last"))
    found = met.join(first, ["_values", "_low"]).join(last, ["_values", "_high"])
    found = found.select(request_id, (F.col("_high") - F.col("_low")).alias("count"), "first", "last")
    if known["unbounded"]:
        untimed = marks.where(F.col("_t").isNull()).select("_values", F.col("_n").alias("count"))
        none = F.lit(None).cast("long")
        untimed = asked.where(unbounded).join(untimed, "_values").select(request_id, "count", none.alias("first"), none.alias("last"))
        found = found.unionByName(untimed)
    return found.groupBy(request_id).agg(F.sum("count").alias("count"), F.min("first").alias("first"), F.max("last").alias("last"))


def list_batches(
    table: DataFrame,
    requests: DataFrame,
    equals: Mapping[str, Column],
    size: int,
    time: str = "lastUpdatedTime",
    request_id: str = "request_id",
    order_by: Sequence[str] = ("id",),
    key: Sequence[str] = ("id",),
) -> DataFrame:
    """The rows of :func:`list_many` as arrays of at most ``size`` rows per request."""
    rows = list_many(table, requests, equals, time, request_id, key=key)
    return group_into_batches(rows, [request_id], size, order_by)


def aggregate_many(
    table: DataFrame,
    requests: DataFrame,
    equals: Mapping[str, Column],
    time: str = "lastUpdatedTime",
    request_id: str = "request_id",
    key: Sequence[str] = ("id",),
) -> DataFrame:
    """Number of matching rows per request; a request without hits counts 0."""
    hits = summarize_many(table, requests, equals, time, request_id, key=key).select(request_id, F.col("count").alias("n"))
    return (
        requests.select(request_id)
        .distinct()
        .join(hits, request_id, "left")
        .select(request_id, F.coalesce("n", F.lit(0)).alias("count"))
    )


def item_keys(items: DataFrame, column: str) -> DataFrame | None:
    """The distinct set values of one id column of an item table."""
    if column not in items.columns:
        return None
    return items.select(column).where(F.col(column).isNotNull()).distinct()


def _marked(table: DataFrame, items: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    hit = F.lit(False)
    for column in keys:
        wanted = item_keys(items, column) if column in table.columns else None
        if wanted is not None:
            flag = f"_hit_{column}"
            table = table.join(small_side(wanted.withColumn(flag, F.lit(True))), column, "left")
            hit = hit | F.coalesce(F.col(flag), F.lit(False))
    return table, hit


def retrieve(
    table: DataFrame, items: DataFrame, anti: bool = False, keys: Sequence[str] = ("id", "externalId")
) -> DataFrame:
    """Rows whose id or externalId is listed, each once. ``anti`` returns the listed items that are unknown."""
    if not anti:
        marked, hit = _marked(table, items, keys)
        return marked.where(hit).select(*table.columns)
    listed = [k for k in keys if k in items.columns]
    unknown = items.select(*listed).distinct()
    for column in [k for k in listed if k in table.columns]:
        # Only the hits travel: the listed keys meet the table's key column, then leave the item list.
        known = table.select(column).join(small_side(item_keys(items, column)), column, "left_semi").distinct()
        unknown = unknown.join(known, column, "left_anti")
    return unknown.select(*listed)


def without(table: DataFrame, items: DataFrame, keys: Sequence[str] = ("id", "externalId")) -> DataFrame:
    """Rows whose id and externalId are both not listed."""
    for column in keys:
        wanted = item_keys(items, column)
        if wanted is not None:
            table = table.join(small_side(wanted), column, "left_anti")
    return table
