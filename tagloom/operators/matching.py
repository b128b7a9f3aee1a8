"""Entity matching: the best targets of every source by cosine similarity of name features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.functions.columns import bigrams, split_letters_digits, tokens
from tagloom.operators.batching import running_totals
from tagloom.session import materialize, salt_count, small_side

# The feature types of a matcher.
FEATURE_TYPES = ("simple", "bigram", "frequency-weighted-bigram", "bigram-extra-tokenizers")

#: Targets in the first block of a token's postings.
FIRST_BLOCK = 32

# A token of more entities than this is joined apart from the others.
COMMON_ENTITIES = 10_000


def features(fields: Sequence[Column], feature_type: str = "simple") -> Column:
    """Sorted distinct features of the matched fields; a feature of a later field does not meet one of an earlier."""
    if feature_type not in FEATURE_TYPES:
        raise ValueError(f"unknown feature type: {feature_type}")
    parts = []
    for i, text in enumerate(fields):
        words = tokens(F.coalesce(text, F.lit("")))
        if feature_type == "bigram-extra-tokenizers":
            words = split_letters_digits(words)
        if feature_type != "simple":
            words = F.concat(words, bigrams(words))
        parts.append(words if i == 0 else _of_field(words, i))
    return F.array_sort(F.array_distinct(F.concat(*parts)))


def _of_field(words: Column, number: int) -> Column:
    """Features marked with the number of their field."""
    return F.transform(words, lambda word: F.concat(F.lit(f"{number}\x1f"), word))


def fit_matcher(
    sources: DataFrame,
    targets: DataFrame,
    match_fields: Sequence[tuple[str, str]],
    feature_type: str = "simple",
) -> DataFrame:
    """The model, a small table to keep: (token, entities, targets, weight).

    ``entities`` and ``targets`` count the distinct feature sets of both sides and of the targets that hold the
    token. The weight is 1, or the inverse document frequency for the frequency-weighted type.
    """
    src = sources.select(features([F.col(s) for s, _ in match_fields], feature_type).alias("f"))
    tgt = targets.select(features([F.col(t) for _, t in match_fields], feature_type).alias("f"))
    return _fitted(src, tgt, feature_type)


def _fitted(src: DataFrame, tgt: DataFrame, feature_type: str) -> DataFrame:
    """The model of two tables of feature sets ``f``."""
    sides = src.select("f").distinct().withColumn("t", F.lit(0)).unionByName(tgt.select("f").distinct().withColumn("t", F.lit(1)))
    model = (
        sides.select("t", F.explode("f").alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("entities"), F.sum("t").alias("targets"))
    )
    if feature_type != "frequency-weighted-bigram":
        return model.withColumn("weight", F.lit(1.0))
    total = sides.select(F.count("*").cast("double")).scalar()
    return model.withColumn("weight", F.log((total + 1) / (F.col("entities") + 1)) + 1)


def _vectors(sets: DataFrame, model: DataFrame) -> DataFrame:
    """(f, norm2, found, rest) of feature sets: the features some target has, rarest first, as (targets, token, w2) in
    ``found``, and the sum of squared weights from each of them to the end in ``rest``."""
    exploded = sets.select("f", F.explode("f").alias("token"))
    # A token that most names hold would be one task of a shuffled join: the frequent ones are few and join by themselves.
    common = F.coalesce("entities", F.lit(0)) >= COMMON_ENTITIES
    known = lambda rows: rows.select("token", "targets", "weight")
    frequent = small_side(known(model.where(common)))
    rest = exploded.join(frequent.select("token"), "token", "left_anti").join(known(model.where(~common)), "token", "left")
    weighed = exploded.join(frequent, "token").unionByName(rest)
    w2 = F.coalesce(F.col("weight") * F.col("weight"), F.lit(1.0))
    entry = F.when(F.col("targets") > 0, F.struct("targets", "token", w2.alias("w2")))
    vectors = weighed.groupBy("f").agg(
        F.array_sort(F.collect_list(entry)).alias("found"), F.sum(w2).alias("norm2")
    )
    tail = lambda at: F.slice("found", at + 1, F.size("found"))
    rest = F.transform("found", lambda _, at: F.aggregate(tail(at), F.lit(0.0), lambda total, x: total + x["w2"]))
    return vectors.withColumn("rest", rest)


def _postings(candidates: DataFrame, model: DataFrame, first_block: int) -> tuple[DataFrame, DataFrame]:
    """((token, level, _tf, _tids, _tnorm2), (token, blocks)): the targets of every token in blocks.

    A token's targets stand by norm, then id, in blocks of ``first_block`` rows, as many again, twice and four times as
    many, and so on: even the most common token has some thirty. A block is known by its least, second least and
    greatest norm, its least id, and the least id among the rows of least norm.
    """
    norms = _vectors(candidates.select("f"), model).select("f", F.col("norm2").alias("_tnorm2"))
    rows = candidates.join(norms, "f").select(
        F.explode("f").alias("token"), F.col("f").alias("_tf"), "_tids", "_tnorm2", F.col("_tids")[0].alias("_first")
    )
    ranked = running_totals(rows, ["token"], ["_tnorm2", "_first"], {"_rank": F.lit(1)})
    doubled = F.floor(F.log2(F.col("_rank") / first_block)) + 1
    level = F.when(F.col("_rank") < first_block, F.lit(0)).otherwise(doubled).cast("int")
    postings = materialize(ranked.withColumn("level", level).drop("_rank"), "postings")
    by_norm = postings.groupBy("token", "level", "_tnorm2").agg(F.min("_first").alias("_first"))
    leading = W.partitionBy("token", "level").orderBy("_tnorm2")
    second = by_norm.withColumn("_rn", F.row_number().over(leading)).where("_rn = 2").select("token", "level", F.col("_tnorm2").alias("second"))
    facts = by_norm.groupBy("token", "level").agg(
        F.min("_tnorm2").alias("low"), F.max("_tnorm2").alias("high"), F.min("_first").alias("tid"), F.min_by("_first", "_tnorm2").alias("low_tid")
    )
    facts = facts.join(second, ["token", "level"], "left")
    blocks = facts.groupBy("token").agg(
        F.array_sort(F.collect_list(F.struct("level", "low", "second", "high", "tid", "low_tid"))).alias("blocks")
    )
    return postings.drop("_first"), blocks


def _rounded_up(bound: Column) -> Column:
    """Rounded like a score, so that a target below the bound never scores more."""
    return F.round(bound + 1e-12, 9)


def _probes() -> Column:
    """All (token, level, round, bound, tid) of a source: the blocks of its features, the round that looks at each, and
    the best score that a target first met there can have.

    Of such a target the source shares no rarer feature, so their product is at most the ``rest`` from this one on, and at
    most the target's own squared norm. Features come in rounds of 1, 1, 2, 4, ... and each goes on by one block a round.
    """

    def of_feature(x: Column, at: Column) -> Column:
        reach = F.get("rest", at)
        start = F.when(at == 0, F.lit(0)).otherwise(F.floor(F.log2(at.cast("double"))) + 1).cast("int")

        def of_block(b: Column) -> Column:
            best = (
                F.when(b["high"] <= reach, F.sqrt(b["high"] / F.col("norm2")))
                .when(b["low"] >= reach, reach / F.sqrt(F.col("norm2") * b["low"]))
                .otherwise(F.sqrt(reach / F.col("norm2")))
            )
            bound = _rounded_up(best)
            # Where norms only lower the score, rows of the second norm do not reach the bound.
            next_one = F.coalesce(_rounded_up(reach / F.sqrt(F.col("norm2") * b["second"])), F.lit(-1.0))
            tid = F.when((b["low"] >= reach) & (next_one < bound), b["low_tid"]).otherwise(b["tid"])
            return F.struct(
                x["token"].alias("token"), b["level"].alias("level"), (start + b["level"]).alias("round"), bound.alias("bound"), tid.alias("tid")
            )

        return F.transform(x["blocks"], of_block)

    return F.flatten(F.transform("found", of_feature))


def match_entities(
    sources: DataFrame,
    targets: DataFrame,
    match_fields: Sequence[tuple[str, str]],
    feature_type: str = "simple",
    max_matches: int = 1,
    threshold: float = 0.0,
    source_id: str = "id",
    target_id: str = "id",
    model: DataFrame | None = None,
    first_block: int = FIRST_BLOCK,
) -> DataFrame:
    """(source_id, target_id, score, rank): the best targets that share a feature and reach the threshold.

    Exact, without dropping common features. Sources with the same features are matched once, as are sources of equal
    norm that differ only in features that no target has; of targets with the same features only the first
    ``max_matches`` by id can ever be returned. Each source then meets the targets through its rarest feature first, and of a feature's targets the block of least norm first. A block is
    joined only while a target first met in it could still beat the matches found (by score, then id) or reach the
    threshold; so a word that all names share is met in its first block, and the rest of its targets are never paired.
    """
    source_features = features([F.col(s) for s, _ in match_fields], feature_type)
    target_features = features([F.col(t) for _, t in match_fields], feature_type)
    weighted = feature_type == "frequency-weighted-bigram"
    # Written tables carry their size, so Spark itself broadcasts the small ones in the joins below.
    listed = materialize(sources.select(F.col(source_id).alias("_sid"), source_features.alias("f")), "sources")
    offered = materialize(targets.select(F.col(target_id).alias("_tid"), target_features.alias("f")), "targets")
    own = model is None
    model = materialize(_fitted(listed, offered, feature_type) if own else model, "matcher")

    first = W.partitionBy("f").orderBy("_tid")
    candidates = (
        offered.withColumn("_rn", F.row_number().over(first))
        .where(F.col("_rn") <= max_matches)
        .groupBy("f")
        .agg(F.sort_array(F.collect_list("_tid")).alias("_tids"))
    )
    candidates = materialize(candidates, "candidates")
    postings, blocks = _postings(candidates, model, first_block)
    vectors = _vectors(listed.select("f").distinct(), model).where(F.size("found") > 0)
    slim = F.transform("found", lambda x: F.struct(x["token"].alias("token"), x["w2"].alias("w2")))
    # Only the features that targets have, and the norm, decide a match: sources that agree in them are matched once.
    # From here on they go by a digest.
    digest = F.unhex(F.sha2(F.to_json(F.struct(slim.alias("found"), "norm2")), 256))
    vectors = materialize(vectors.withColumn("s", digest), "vectors")
    profiles = materialize(vectors.drop("f").dropDuplicates(["s"]), "open")
    kept = {"_worst": F.lit(None).cast("double"), "_worst_tid": F.lit(None).cast(candidates.schema["_tids"].dataType.elementType)}

    def alive(probe: Column) -> Column:
        beats = F.col("_worst").isNull() | (probe["bound"] > F.col("_worst")) | (
            (probe["bound"] == F.col("_worst")) & (probe["tid"] < F.col("_worst_tid"))
        )
        return (probe["bound"] >= F.lit(threshold)) & beats

    ranking = W.partitionBy("s").orderBy(F.desc("score"), "_tid")

    def meet(probes: DataFrame, best: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        """The best matches after these (s, norm2, found, token, level) too, and the worst of them where all are found."""
        # Pairs cost far more than probes: spread the probes evenly, whatever their tokens.
        probes = probes.repartition(salt_count(probes.sparkSession), "s", "token")
        shared = F.array_intersect("found.token", "_tf")
        met = probes.join(postings, ["token", "level"]).withColumn("_shared", shared)
        # A pair is met once: through the first feature it shares.
        met = met.where(F.element_at("_shared", 1) == F.col("token"))
        dot = F.size("_shared").cast("double")
        if weighted:
            common = F.filter("found", lambda x: F.array_contains(F.col("_shared"), x["token"]))
            dot = F.aggregate(common, F.lit(0.0), lambda total, x: total + x["w2"])
        scored = (
            met.select("s", F.round(dot / F.sqrt(F.col("norm2") * F.col("_tnorm2")), 9).alias("score"), "_tids")
            .where(F.col("score") >= threshold)
            .select("s", "score", F.explode("_tids").alias("_tid"))
        )
        if best is not None:
            scored = scored.unionByName(best.select("s", "score", "_tid"))
        ranked = scored.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= max_matches)
        best = materialize(ranked, "best")
        return best, best.where(F.col("rank") == max_matches).select("s", F.col("score").alias("_worst"), F.col("_tid").alias("_worst_tid"))

    # The first round needs no bounds: every source looks at the first block of its rarest feature.
    best, worst = meet(profiles.select("s", "norm2", slim.alias("found"), F.col("found")[0]["token"].alias("token"), F.lit(0).alias("level")), None)
    reached = lambda reach: _rounded_up(F.sqrt(reach / F.col("norm2"))) >= F.greatest(F.lit(threshold), F.coalesce("_worst", F.lit(0.0)))
    # A feature of a model of its own has as many postings as ``targets`` says: within one block, the first one is all.
    deeper = (F.col("found")[0]["targets"] >= first_block) if own else F.lit(True)
    more = (deeper & reached(F.col("rest")[0])) | ((F.size("found") > 1) & reached(F.get("rest", F.lit(1))))
    left = profiles.join(worst, "s", "left").where(more)
    # Only sources that could still find better are given the posting blocks of their features.
    entries = left.select("s", F.posexplode("found").alias("at", "x")).select("s", "at", "x.token", "x.w2").join(blocks, "token", "left")
    entry = F.struct("at", "token", "w2", F.coalesce("blocks", F.array().cast(blocks.schema["blocks"].dataType)).alias("blocks"))
    entries = entries.groupBy("s").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    left = left.drop("found").join(entries, "s").withColumn("probes", _probes())
    left = left.withColumn("probes", F.filter("probes", lambda p: (p["round"] > 0) & alive(p)))
    open_sources = materialize(left.select("s", "norm2", slim.alias("found"), "probes", *kept).where(F.size("probes") > 0), "open")
    settled = [best.join(open_sources.select("s"), "s", "left_anti")]
    best = best.join(open_sources.select("s"), "s", "left_semi")
    while True:
        number = open_sources.agg(F.min(F.array_min("probes.round"))).first()[0]
        if number is None:
            break
        due = F.filter("probes", lambda p: p["round"] == number)
        probes = open_sources.select("s", "norm2", "found", F.explode(due).alias("p")).select("s", "norm2", "found", "p.token", "p.level")
        best, worst = meet(probes, best)
        # Still open: blocks left whose targets could reach the threshold and beat the worst match kept.
        left = open_sources.drop(*kept).join(worst, "s", "left")
        left = left.withColumn("probes", F.filter("probes", lambda p: (p["round"] > number) & alive(p)))
        open_sources = materialize(left.where(F.size("probes") > 0), "open")
        settled.append(best.join(open_sources.select("s"), "s", "left_anti"))
        best = best.join(open_sources.select("s"), "s", "left_semi")
    found = reduce(DataFrame.unionByName, settled)
    return listed.join(vectors.select("s", "f"), "f").join(found, "s").select(
        F.col("_sid").alias("source_id"), F.col("_tid").alias("target_id"), "score", "rank"
    )


def match_rows(
    rows: DataFrame,
    targets: DataFrame,
    via: Callable[[DataFrame], Column | Sequence[Column]],
    target_field: str | Sequence[str],
    feature_type: str = "simple",
    max_matches: int = 1,
    threshold: float = 0.0,
    target_id: str = "id",
) -> DataFrame:
    """Rows of any kind with ``matches``, an array of (target_id, score), best first; empty without a match.

    ``via`` gives the text to match for a row, or one text per entry of ``target_field``. Rows with the same texts
    share one match; a row whose texts are all NULL has none.
    """
    given, names = via(rows), [target_field] if isinstance(target_field, str) else list(target_field)
    given = [given] if isinstance(given, Column) else list(given)
    if len(given) != len(names):
        raise ValueError("one text per matched field is needed")
    fields = [f"_f{i}" for i in range(len(given))]
    texted = rows.withColumn("_text", F.struct(*[text.alias(name) for text, name in zip(given, fields)]))
    some = F.coalesce(*[F.col(f"_text.{name}") for name in fields]).isNotNull()
    distinct = texted.where(some).select(F.col("_text").alias("texts")).distinct().select("texts", "texts.*")
    found = match_entities(
        distinct,
        targets,
        list(zip(fields, names)),
        feature_type,
        max_matches,
        threshold,
        source_id="texts",
        target_id=target_id,
    )
    lists = found.groupBy(F.col("source_id").alias("_text")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "target_id", "score"))).alias("_m")
    )
    none = F.array().cast(lists.schema["_m"].dataType)
    joined = texted.join(lists, "_text", "left").withColumn("_m", F.coalesce("_m", none))
    return joined.select(
        *rows.columns,
        F.transform("_m", lambda m: F.struct(m["target_id"].alias("target_id"), m["score"].alias("score"))).alias(
            "matches"
        ),
    )
