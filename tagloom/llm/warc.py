"""Not-modified revisits of a web archive resolved to the full response they stand for.

A revisit joins, as of its time, the latest earlier full response (status 200) of the same canonical URL. Validators are
checked in the order entity tag, modification date, payload digest: the first that both records carry decides. A
verified revisit gets the response's payload and headers, overlaid with the headers that a 304 answer may update.

The as-of join shuffles narrow rows (ids, times, headers, digests), never payloads. A URL's captures are cut into slices
of time; each slice looks back inside itself and takes the rest from the last response of earlier slices, found on
pre-aggregated rows. So a URL with a third of all captures isn't one task.

Defined cases: null URL or time: ``missing`` (such a response is no candidate); equal times: the higher record id counts
as later; repeated records give repeated rows; null or empty headers: no validators; header names ignore case, repeated
names are kept; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The headers that a 304 answer may carry for the stored response (RFC 9110, 15.4.5, and RFC 6265).
UPDATABLE = ("cache-control", "content-location", "date", "etag", "expires", "set-cookie", "vary")
SLICE_SECONDS = 86_400


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path without end slashes, sorted query without ``utm_*``; no scheme, no fragment."""
    rest = F.regexp_replace(F.split_part(F.trim(url), F.lit("#"), F.lit(1)), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    place = F.split_part(rest, F.lit("?"), F.lit(1))
    authority = F.split_part(place, F.lit("/"), F.lit(1))
    path = F.regexp_replace(F.substring(place, F.length(authority) + 1, F.length(place)), r"/+$", "")
    query = F.substring(rest, F.length(place) + 2, F.length(rest))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.startswith("utm_")))
    asked = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.concat(F.regexp_replace(F.lower(authority), r"^www\.|:(80|443)$", ""), path, asked)


def _entries(headers: Column) -> Column:
    """Sorted (lower-case name, value) pairs of a header map."""
    pairs = F.transform(F.map_entries(headers), lambda e: F.struct(F.lower(e["key"]).alias("k"), e["value"].alias("v")))
    return F.array_sort(F.coalesce(pairs, F.array().cast("array<struct<k:string,v:string>>")))


def _header(entries: Column, name: str) -> Column:
    return F.get(F.filter(entries, lambda e: e["k"] == name), F.lit(0))["v"]


def _tag(entries: Column) -> Column:
    return F.regexp_replace(_header(entries, "etag"), r"^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Resolve the revisits of ``records``.

    ``records``: record_id, url, captured_at (seconds), kind (``response`` or ``revisit``), status, headers (map),
    payload_digest, payload_length. Returns one row per revisit: record_id, url_key, captured_at, response_id, outcome
    (``etag``, ``last-modified``, ``digest``, ``unverified``, ``mismatch`` or ``missing``), headers (merged pairs, or
    null unless verified), payload_digest and payload_length of the response (null unless verified).
    """
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    rows = records.where((F.col("kind") == "revisit") | full).select(
        "record_id",
        canonical_url(F.col("url")).alias("url_key"),
        F.col("captured_at").cast("long").alias("captured_at"),
        (F.col("kind") == "revisit").alias("is_revisit"),
        _entries(F.col("headers")).alias("headers"),
        "payload_digest",
        "payload_length",
    )
    placed = F.col("url_key").isNotNull() & F.col("captured_at").isNotNull()
    body = F.struct("captured_at", "record_id", "headers", "payload_digest", "payload_length")
    timed = rows.where(placed).withColumn("_slice", F.floor(F.col("captured_at") / SLICE_SECONDS))
    timed = timed.withColumn("_found", F.when(~F.col("is_revisit"), body))
    last = timed.groupBy("url_key", "_slice").agg(F.max("_found").alias("_last"))
    earlier = Window.partitionBy("url_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("url_key", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    # At one time, the response with the higher id counts as later than the revisit, hence not as earlier.
    inside = Window.partitionBy("url_key", "_slice").orderBy("captured_at", "record_id").rowsBetween(Window.unboundedPreceding, -1)
    seen = timed.withColumn("_near", F.last("_found", ignorenulls=True).over(inside)).where("is_revisit")
    known = seen.join(carried, ["url_key", "_slice"]).withColumn("_hit", F.coalesce("_near", "_carried"))
    lost = rows.where("is_revisit").where(~F.coalesce(placed, F.lit(False))).withColumn("_hit", F.lit(None).cast(known.schema["_hit"].dataType))
    columns = ["record_id", "url_key", "captured_at", "headers", "payload_digest", "_hit"]
    joined = known.select(*columns).unionByName(lost.select(*columns))
    mine, theirs = F.col("headers"), F.col("_hit.headers")

    def checked(a: Column, b: Column, name: str) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, F.lit(name)).otherwise("mismatch"))

    outcome = F.when(F.col("_hit").isNull(), "missing").otherwise(
        F.coalesce(
            checked(_tag(mine), _tag(theirs), "etag"),
            checked(_header(mine, "last-modified"), _header(theirs, "last-modified"), "last-modified"),
            checked(F.col("payload_digest"), F.col("_hit.payload_digest"), "digest"),
            F.lit("unverified"),
        )
    )
    fresh = F.filter(mine, lambda e: e["k"].isin(*UPDATABLE))
    merged = F.array_sort(F.concat(F.filter(theirs, lambda e: ~F.exists(fresh, lambda f: f["k"] == e["k"])), fresh))
    good = F.col("outcome").isin("etag", "last-modified", "digest")
    return joined.withColumn("outcome", outcome).select(
        "record_id",
        "url_key",
        "captured_at",
        F.col("_hit.record_id").alias("response_id"),
        "outcome",
        F.when(good, merged).alias("headers"),
        F.when(good, F.col("_hit.payload_digest")).alias("payload_digest"),
        F.when(good, F.col("_hit.payload_length")).alias("payload_length"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Archive records over ``pages``: a full response per page, a revisit of it under a variant of its URL (with every
    kind of validator), and for a third of the pages a revisit of one common URL, whose response is captured again for
    every hundredth page."""
    i, at = F.col("page_id"), F.col("page_id") * 10
    digest, length = F.md5("html"), F.length("html").cast("long")
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"'))
    dated = F.concat(F.lit("day "), (i % 365).cast("string"))
    none = F.lit(None).cast("string")
    number = lambda kind: F.concat(F.lpad(i.cast("string"), 12, "0"), F.lit(kind))
    form = i % 6
    hub = F.lit("http://hub.example.net/index")

    def record(kind_of_id, url, when, kind, headers, its_digest, its_length):
        return F.struct(
            number(kind_of_id).alias("record_id"), url.alias("url"), when.alias("captured_at"), F.lit(kind).alias("kind"),
            F.lit(200 if kind == "response" else 304).alias("status"), headers.alias("headers"),
            its_digest.alias("payload_digest"), its_length.alias("payload_length"),
        )

    full = F.create_map(
        F.lit("ETag"), tag, F.lit("Last-Modified"), dated, F.lit("Content-Type"), F.lit("text/html"),
        F.lit("Date"), at.cast("string"),
    )
    later = (at + 7).cast("string")
    again = (
        F.when(form.isin(0, 5), F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("date"), later, F.lit("content-type"), F.lit("none")))
        .when(form == 1, F.create_map(F.lit("LAST-MODIFIED"), dated, F.lit("Date"), later))
        .when(form == 2, F.create_map(F.lit("ETag"), F.lit('"other"'), F.lit("Date"), later))
        .otherwise(F.create_map(F.lit("Date"), later))
    )
    variant = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("#again"))
    fixed = F.create_map(F.lit("ETag"), F.lit('"hub"'), F.lit("Date"), later)
    made = F.array(
        record("a", F.col("url"), at, "response", full, digest, length),
        record("b", variant, F.when(form == 5, at - 3).otherwise(at + 7), "revisit", again, F.when(form == 3, digest), F.lit(None).cast("long")),
        F.when(i % 3 == 0, record("c", hub, at + 5, "revisit", fixed, none, F.lit(None).cast("long"))),
        F.when(i % 100 == 0, record("d", hub, at + 1, "response", fixed, digest, length)),
    )
    return pages.select(F.explode(made).alias("r")).where("r IS NOT NULL").select("r.*")


def op1_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Every revisit of the archive over ``pages``, resolved; headers as text."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = resolve_revisits(captures(pages))
    pairs = F.transform("headers", lambda e: F.concat(e["k"], F.lit("="), e["v"]))
    return found.withColumn("headers", F.array_join(pairs, "; "))


OP1_SQL = r"""
WITH p AS (
  SELECT page_id AS i, page_id * 10 AS t, url, md5(html) AS digest, length(html) AS len, lpad(CAST(page_id AS VARCHAR), 12, '0') AS n,
         '"' || substr(md5(html), 1, 12) || '"' AS tag, 'day ' || (page_id % 365) AS dated
  FROM pages),
r AS (
  SELECT n || 'a' AS id, url, t AS at, false AS rev, tag AS etag, dated AS lm, digest, len, CAST(t AS VARCHAR) AS date, 'text/html' AS ct FROM p
  UNION ALL
  SELECT n || 'b', regexp_replace(url, '#.*$', '') || '#again', CASE WHEN i % 6 = 5 THEN t - 3 ELSE t + 7 END, true,
         CASE WHEN i % 6 IN (0, 5) THEN 'W/' || tag WHEN i % 6 = 2 THEN '"other"' END, CASE WHEN i % 6 = 1 THEN dated END,
         CASE WHEN i % 6 = 3 THEN digest END, NULL, CAST(t + 7 AS VARCHAR), NULL FROM p
  UNION ALL
  SELECT n || 'c', 'http://hub.example.net/index', t + 5, true, '"hub"', NULL, NULL, NULL, CAST(t + 7 AS VARCHAR), NULL FROM p WHERE i % 3 = 0
  UNION ALL
  SELECT n || 'd', 'http://hub.example.net/index', t + 1, false, '"hub"', NULL, digest, len, CAST(t + 7 AS VARCHAR), NULL FROM p WHERE i % 100 = 0),
u AS (SELECT *, regexp_replace(split_part(trim(url), '#', 1), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM r),
v AS (SELECT *, split_part(rest, '?', 1) AS place, split_part(split_part(rest, '?', 1), '/', 1) AS auth FROM u),
w AS (
  SELECT *, list_sort(list_filter(string_split(substr(rest, length(place) + 2), '&'), lambda x: x != '' AND NOT starts_with(x, 'utm_'))) AS q,
         regexp_replace(lower(auth), '^www\.|:(80|443)$', '', 'g') || regexp_replace(substr(place, length(auth) + 1), '/+$', '') AS hp
  FROM v),
k AS (SELECT *, hp || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS key FROM (SELECT * EXCLUDE (len), len AS plen FROM w)),
j AS (
  SELECT a.*, b.id AS rid, b.etag AS betag, b.lm AS blm, b.digest AS bdigest, b.plen AS blen, b.ct AS bct, b.date AS bdate
  FROM (SELECT *, struct_pack(p := "at", q := id) AS s FROM k WHERE rev) a
  ASOF LEFT JOIN (SELECT *, struct_pack(p := "at", q := id) AS s FROM k WHERE NOT rev) b ON a.key = b.key AND a.s > b.s),
o AS (
  SELECT *, CASE WHEN rid IS NULL THEN 'missing'
    WHEN etag IS NOT NULL AND betag IS NOT NULL THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(betag, '^W/', '') THEN 'etag' ELSE 'mismatch' END
    WHEN lm IS NOT NULL AND blm IS NOT NULL THEN CASE WHEN lm = blm THEN 'last-modified' ELSE 'mismatch' END
    WHEN digest IS NOT NULL AND bdigest IS NOT NULL THEN CASE WHEN digest = bdigest THEN 'digest' ELSE 'mismatch' END
    ELSE 'unverified' END AS outcome
  FROM j)
SELECT id AS record_id, key AS url_key, "at" AS captured_at, rid AS response_id, outcome,
  CASE WHEN outcome IN ('etag', 'last-modified', 'digest') THEN array_to_string(list_filter([
    'content-type=' || bct, 'date=' || coalesce(date, bdate), 'etag=' || coalesce(etag, betag), 'last-modified=' || blm], lambda x: x IS NOT NULL), '; ') END AS headers,
  CASE WHEN outcome IN ('etag', 'last-modified', 'digest') THEN bdigest END AS payload_digest,
  CASE WHEN outcome IN ('etag', 'last-modified', 'digest') THEN blen END AS payload_length
FROM o
"""
