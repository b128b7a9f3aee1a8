"""Queries of entity matching and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.annotate import annotate
from tagloom.operators.matching import fit_matcher, match_entities, match_rows
from tagloom.plans.registry import query
from tagloom.sources.views import Views

_WORDS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"
_PAIRS = "list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1])"
_CUT = """list_transform(flatten(list_transform({0}, lambda w: regexp_extract_all(w, '(\\p{{N}}+|\\p{{L}}+)'))),
    lambda w: regexp_replace(w, '^0+([0-9])', '\\1'))"""


def _match_sql(sources: str, targets: str, kind: str, k: int, threshold: float = 0.0) -> str:
    """Score every pair that shares a feature, keep the best k by (score, target)."""
    words = _CUT.format("w") if kind == "bigram-extra-tokenizers" else "w"
    found = "c" if kind == "simple" else f"c || {_PAIRS.format('c')}"
    weight = "ln((n + 1) / (df + 1)) + 1" if kind == "frequency-weighted-bigram" else "1.0"
    return f"""
    , raw_sides AS (SELECT 0 AS side, id::VARCHAR AS id, {_WORDS.format("name")} AS w FROM ({sources})
                UNION ALL SELECT 1, id::VARCHAR, {_WORDS.format("name")} FROM ({targets})),
    sides AS (SELECT side, id, list_sort(list_distinct({found})) AS f FROM (SELECT side, id, {words} AS c FROM raw_sides)),
    sets AS (SELECT DISTINCT side, f FROM sides),
    model AS (SELECT token, count(*)::DOUBLE AS df FROM (SELECT unnest(f) AS token FROM sets) GROUP BY 1),
    weights AS (SELECT token, {weight} AS w FROM model, (SELECT count(*)::DOUBLE AS n FROM sets)),
    vec AS (SELECT side, f, token, w FROM (SELECT side, f, unnest(f) AS token FROM sets) JOIN weights USING (token)),
    norm AS (SELECT side, f, sum(w * w) AS n2 FROM vec GROUP BY ALL),
    dots AS (SELECT s.f AS sf, t.f AS tf, sum(s.w * t.w) AS dot FROM vec s JOIN vec t USING (token)
             WHERE s.side = 0 AND t.side = 1 GROUP BY ALL),
    scores AS (SELECT sf, tf, round(dot / sqrt(a.n2 * b.n2), 9) AS score FROM dots
               JOIN norm a ON a.f = sf AND a.side = 0 JOIN norm b ON b.f = tf AND b.side = 1),
    ranked AS (SELECT sf, id AS target_id, score, row_number() OVER (PARTITION BY sf ORDER BY score DESC, id) AS rank
               FROM scores JOIN sides ON sides.f = tf AND side = 1 WHERE score >= {threshold}
               QUALIFY rank <= {k})
    SELECT id AS source_id, target_id, round(score, 6) AS score, rank FROM sides JOIN ranked ON sf = f WHERE side = 0
    """.replace(", raw_sides AS", "WITH raw_sides AS", 1)


def _sources(v: Views) -> DataFrame:
    return v.table("part").select(
        F.col("p_partkey").cast("string").alias("id"), F.upper(F.regexp_replace("p_name", " ", "-")).alias("name")
    )


def _targets(v: Views) -> DataFrame:
    return v.table("part").select(F.col("p_name").alias("id"), F.col("p_name").alias("name")).distinct()


_SRC = "SELECT p_partkey AS id, upper(replace(p_name, ' ', '-')) AS name FROM part"
_TGT = "SELECT DISTINCT p_name AS id, p_name AS name FROM part"


def _rounded(found: DataFrame) -> DataFrame:
    return found.withColumn("score", F.round("score", 6))


@query("match_entities", _match_sql(_SRC, _TGT, "simple", 1))
def match_simple(v):
    return _rounded(match_entities(_sources(v), _targets(v), [("name", "name")]))


@query("match_entities_bigram", _match_sql(_SRC, _TGT, "bigram", 3, 0.3))
def match_bigram(v):
    found = match_entities(_sources(v), _targets(v), [("name", "name")], "bigram", 3, 0.3)
    return _rounded(found)


_MIXED = "SELECT p_partkey AS id, p_brand || ' ' || p_type || ' ' || p_name AS name FROM part"
_BRANDS = "SELECT DISTINCT p_brand || ' ' || p_name AS id, p_brand || ' ' || p_name AS name FROM part"


@query("match_entities_weighted", _match_sql(_MIXED, _BRANDS, "frequency-weighted-bigram", 2))
def match_weighted(v):
    part = v.table("part")
    text = lambda *columns: F.concat_ws(" ", *columns)
    sources = part.select(F.col("p_partkey").cast("string").alias("id"), text("p_brand", "p_type", "p_name").alias("name"))
    targets = part.select(text("p_brand", "p_name").alias("id"), text("p_brand", "p_name").alias("name")).distinct()
    return _rounded(match_entities(sources, targets, [("name", "name")], "frequency-weighted-bigram", 2))


_TAGS = "SELECT s_suppkey AS id, s_name AS name FROM supplier"
_NUMBERED = "SELECT 'IA-' || s_suppkey AS id, 'IA-' || s_suppkey || '_SUPPLIER' AS name FROM supplier"


@query("match_entities_extra_tokenizers", _match_sql(_TAGS, _NUMBERED, "bigram-extra-tokenizers", 1))
def match_extra(v):
    supplier = v.table("supplier")
    sources = supplier.select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    code = F.concat(F.lit("IA-"), F.col("s_suppkey"))
    targets = supplier.select(code.alias("id"), F.concat(code, F.lit("_SUPPLIER")).alias("name"))
    return _rounded(match_entities(sources, targets, [("name", "name")], "bigram-extra-tokenizers"))


_NAMED = "SELECT c_custkey AS id, c_name AS name FROM customer"
_CODES = "SELECT c_custkey AS id, 'customer ' || lpad(c_custkey::VARCHAR, 9, '0') || ' account' AS name FROM customer"


_PLACES = "SELECT o_orderkey AS id, 'order place ' || o_orderkey AS name FROM orders"
_STOPS = """SELECT 'st' || c_custkey AS id, 'stop place x' || c_custkey || CASE WHEN c_custkey % 3 = 0 THEN ' ' || c_nationkey ELSE '' END AS name
    FROM customer"""


@query("match_entities_shared_word", _match_sql(_PLACES, _STOPS, "simple", 2))
def match_shared_word(v):
    """All names of both sides hold the word ``place``, most share nothing else: it is met in its first blocks only."""
    key, nation = F.col("c_custkey"), F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit(" "), "c_nationkey")).otherwise("")
    sources = v.spread("orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("order place "), "o_orderkey").alias("name")
    )
    targets = v.spread("customer").select(F.concat(F.lit("st"), key).alias("id"), F.concat(F.lit("stop place x"), key, nation).alias("name"))
    return _rounded(match_entities(sources, targets, [("name", "name")], max_matches=2))


@query("match_entities_common_token", _match_sql(_NAMED, _CODES, "simple", 1))
def match_common_token(v):
    """Every name of both sides holds the word ``customer``; the number decides."""
    customer = v.spread("customer")
    key = F.col("c_custkey").cast("string")
    sources = customer.select(key.alias("id"), F.col("c_name").alias("name"))
    targets = customer.select(key.alias("id"), F.concat(F.lit("customer "), F.lpad(key, 9, "0"), F.lit(" account")).alias("name"))
    return _rounded(match_entities(sources, targets, [("name", "name")]))


@query(
    "match_generic",
    """SELECT p_partkey, p_name, p_brand, lower(p_name) AS target_id, 1.0::DOUBLE AS score, 1 AS matches FROM part
       WHERE p_size > 10
       UNION ALL SELECT p_partkey, p_name, p_brand, NULL, NULL, 0 FROM part WHERE p_size <= 10""",
)
def match_generic(v):
    part = v.table("part").select("p_partkey", "p_name", "p_brand", "p_size")
    via = lambda rows: F.when(F.col("p_size") > 10, F.upper("p_name")).otherwise("???")
    found = match_rows(part, _targets(v), via, "name")
    best = F.get("matches", F.lit(0))
    return found.select(
        "p_partkey",
        "p_name",
        "p_brand",
        best["target_id"].alias("target_id"),
        F.round(best["score"], 6).alias("score"),
        F.size("matches").alias("matches"),
    )


@query(
    "match_generic_fields",
    """WITH t AS (SELECT DISTINCT p_brand AS brand, p_type AS kind FROM part WHERE p_size > 10)
       SELECT p_partkey, p_brand || '/' || p_type AS target_id, 1.0::DOUBLE AS score FROM part
       SEMI JOIN t ON p_brand = brand AND p_type = kind""",
)
def match_generic_fields(v):
    """Parts matched by brand and type together; those whose pair is a target find it with score 1."""
    part = v.table("part").select("p_partkey", "p_brand", "p_type", "p_size")
    pairs = part.where("p_size > 10").select("p_brand", "p_type").distinct()
    targets = pairs.select(F.concat_ws("/", "p_brand", "p_type").alias("id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))
    found = match_rows(part, targets, lambda rows: [F.lower("p_brand"), F.upper("p_type")], ["brand", "kind"], threshold=0.999)
    best = F.get("matches", F.lit(0))
    return found.where(F.size("matches") > 0).select("p_partkey", best["target_id"].alias("target_id"), F.round(best["score"], 6).alias("score"))


@query(
    "fit_matcher",
    f"""WITH sides AS (SELECT DISTINCT 0 AS side, list_sort(list_distinct({_WORDS.format("name")})) AS f FROM ({_SRC})
            UNION ALL SELECT DISTINCT 1, list_sort(list_distinct({_WORDS.format("name")})) FROM ({_TGT}))
        SELECT token, count(*) AS entities, sum(side)::BIGINT AS targets, 1.0::DOUBLE AS weight
        FROM (SELECT side, unnest(f) AS token FROM sides) GROUP BY token""",
)
def fit_matcher_query(v):
    return fit_matcher(_sources(v), _targets(v), [("name", "name")])


_DOC_RUNS = f"""
    WITH d AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
         e AS (SELECT item_id, {_WORDS.format("text")} AS name FROM benchmark),
         p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM d)"""


@query(
    "annotate_documents",
    _DOC_RUNS
    + """SELECT doc_id AS document_id, item_id AS entity_id, count(*) AS matches, min(pos) - 1 AS first_position
         FROM p JOIN e ON w[pos] = name[1] AND w[pos + 1] = name[2] AND list_slice(w, pos, pos + len(name) - 1) = name
         WHERE len(name) >= 2 GROUP BY ALL""",
)
def annotate_documents(v):
    return annotate(v.spread("documents"), v.table("benchmark"), "text", entity_id="item_id")


@query(
    "annotate_documents_partial",
    _DOC_RUNS
    + """, g AS (SELECT DISTINCT item_id, array_to_string(list_slice(name, i, i + 3), ' ') AS gram
                 FROM (SELECT item_id, name, unnest(range(1, len(name) - 2)) AS i FROM e))
         SELECT doc_id AS document_id, item_id AS entity_id, count(DISTINCT pos) AS matches, min(pos) - 1 AS first_position
         FROM p JOIN g ON array_to_string(list_slice(w, pos, pos + 3), ' ') = gram WHERE pos <= len(w) - 3 GROUP BY ALL""",
)
def annotate_documents_partial(v):
    return annotate(v.spread("documents"), v.table("benchmark"), "text", 4, True, entity_id="item_id")
