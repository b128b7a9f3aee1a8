"""Personal data, and the terms that disclose it, found and sanitised with DataFrame functions only.

1. Entities. E-mail and IP addresses, card and phone numbers, by pattern and check (length, Luhn, parts). Positions are
   code points: the pieces between matches and the matches themselves give them by running length.
2. Co-occurrence. Over the D different texts of the corpus (copies of one text count once), n(c) have entity c, n(t) have
   term t and n(c, t) have both, wherever they stand; pointwise mutual information PMI = log2(n(c, t) * D / (n(c) * n(t)))
   is how much t tells of c, IC = log2(D / n(c)) is all there is.
3. Sanitisation. A term with PMI >= ``DISCLOSES`` * IC discloses c if as many common texts have a chance of at most
   ``CHANCE`` when c and t are independent (Chernoff's bound with e = n(c) * n(t) / D texts expected); one common text can
   do. Wherever it stands in a document that has c, it is removed if it tells nearly all (``REMOVES``), else generalised to
   its kind. Documents without entities are left alone.

Entities that stand in the same texts have the same counts and go on as one group, so a text full of entities of its own
makes one pair per term. As n(c, t) is at most the lesser of n(c) and n(t), terms too common to reach the share are left
out before pairs are formed, which loses nothing. Counts are pre-aggregated. Inside one text, positions are added up in
blocks of about the root of the number of matches (``running``).

Defined cases: null and empty texts have no spans; a null id is kept; rows equal in id and text share their spans; an
empty table gives no rows; other columns do not matter (``sanitised`` keeps them, and sets ``n_chars`` if present).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.frames import let
from tagloom.session import materialize, small_side

# The patterns of the contract. Possessive repeats never give back what a later part could use, and a
# repeat starts where its run of characters does (or where the last match ended), so long runs take linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
TERM = r"\p{L}[\p{L}\p{N}]{3,}+"
DISCLOSES, REMOVES, CHANCE = 0.8, 0.95, 0.05
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"
_PLACE = "array<struct<value:string,start:int,end:int>>"
_ADDED = "array<struct<start:int,end:int,removed:boolean>>"


def blocks(values: Column) -> Column:
    """``values`` (bound, not empty) cut into blocks of about the root of their number."""
    width = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(values))).cast("int"))
    return let(width, lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / w).cast("int")), lambda i: F.slice(values, i * w + 1, w)))


def running(values: Column, merge: Callable[[Column, Column], Column], begin: int) -> Column:
    """Running results of ``merge`` over an array of whole numbers, each with its own element.

    An array that grows by an element is copied, so it grows inside blocks only: n ** 1.5 copies for n elements.
    """

    def fold(part: Column, first: Column) -> Column:
        step = lambda acc, v: let(merge(acc["at"], v), lambda now: F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out")))
        return F.aggregate(part, F.struct(first.alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def all_of(cut: Column) -> Column:
        totals = F.transform(cut, lambda part: F.aggregate(part, F.lit(begin), lambda a, b: merge(a, b)))
        before = F.concat(F.array(F.lit(begin)), fold(totals, F.lit(begin)))
        return F.flatten(F.zip_with(cut, F.slice(before, F.lit(1), F.size(cut)), fold))

    return let(values, lambda v: F.when(F.size(v) > 0, let(blocks(v), all_of)).otherwise(F.array().cast("array<int>")))


def _ends(text: Column, pattern: str, found: Column) -> Column:
    """Ends of the matches ``found`` in code points: lengths of what lies between and of matches, added up."""
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    return running(F.zip_with(gaps, found, lambda g, v: F.length(g) + F.length(v)), lambda a, b: a + b, 0)


def places(text: Column, pattern: str) -> Column:
    """Matches of ``pattern`` with start and end (exclusive) in code points."""

    def placed(found: Column) -> Column:
        place = lambda v, end: F.struct(v.alias("value"), (end - F.length(v)).alias("start"), end.alias("end"))
        return F.when(F.size(found) > 0, F.zip_with(found, _ends(text, pattern, found), place).cast(_PLACE)).otherwise(F.array().cast(_PLACE))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _luhn(digits: Column) -> Column:
    each = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(value, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Spans (start, rank, end, kind, value) of personal data, by start, then kind as listed."""
    def of(rank: int, kind: str) -> Column:
        spans = F.filter(places(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))
        span = lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value"))
        return F.transform(spans, span).cast(_SPAN)

    found = [of(rank, kind) for rank, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, spans, text) of every row; mark is a digest of the text, which is kept only where it has spans."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text", F.when(F.col("text").rlike("[0-9@]"), base_spans(F.col("text"))).otherwise(F.array().cast(_SPAN)).alias("spans"))
    return rows.select("doc_id", "mark", "spans", F.when(F.size("spans") > 0, F.col("text")).alias("text"))


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def term_counts(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, n_t): in how many different texts a term stands."""
    copied = found.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select(F.col("mark").alias("copied"))
    copied = small_side(materialize(copied, "copied"), max_rows=4_000_000)  # one number each
    texts = docs.select(F.coalesce(text_col, F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    words = texts.join(copied, F.col("mark") == F.col("copied"), "left").select("copied", F.explode(_terms(F.col("text"))).alias("term"))
    rows = words.groupBy("term", "copied").agg(F.count("*").alias("n"))
    return rows.groupBy("term").agg(F.sum(F.when(F.col("copied").isNull(), F.col("n")).otherwise(1)).alias("n_t"))


def disclosing(found: DataFrame, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(mark, term, share): terms of a text that disclose an entity of it, and the greatest share PMI / IC of what they tell."""
    d = F.lit(float(found.select("mark").distinct().count()))
    seen = found.where(F.size("spans") > 0)
    name = lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))
    held = materialize(seen.select("mark", F.explode(F.transform("spans", name)).alias("entity")).distinct(), "held")
    group = F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("mark")), F.bit_xor(F.xxhash64("mark", F.lit(1))))
    groups = materialize(held.groupBy("entity").agg(group.alias("group"), F.count("*").alias("n_c")), "groups")
    holders = held.join(small_side(groups), "entity").select("mark", "group", "n_c").distinct()
    terms = seen.select("mark", F.explode(_terms(F.col("text"))).alias("term")).distinct()
    counted = terms.join(term_counts(found, docs, text_col), "term")
    told = lambda both: F.log2(both * d / (F.col("n_c") * F.col("n_t")))
    least = DISCLOSES * F.log2(d / F.col("n_c"))
    pairs = holders.join(counted, "mark").where((F.col("n_c") < d) & (told(F.least("n_c", "n_t")) >= least))
    pairs = materialize(pairs.select("mark", "group", "n_c", "term", "n_t"), "pairs")
    both = F.col("n_ct")
    expected = F.col("n_c") * F.col("n_t") / d
    telling = pairs.groupBy("group", "n_c", "term", "n_t").agg(F.count("*").alias("n_ct"))
    telling = telling.where((told(both) >= least) & (both * F.log(both / expected) - both + expected >= -math.log(CHANCE)))
    telling = small_side(materialize(telling.select("group", "term", (told(both) / F.log2(d / F.col("n_c"))).alias("share")), "disclosing"))
    return pairs.select("mark", "group", "term").join(telling, ["group", "term"]).groupBy("mark", "term").agg(F.max("share").alias("share"))


def _standing(text: Column, spans: Column, wanted: Column) -> Column:
    """Places (start, end, removed) outside all spans of the terms that ``wanted`` (term -> removed) has."""

    def told(found: Column) -> Column:
        place = lambda v, end: F.struct((end - F.length(v)).alias("start"), end.alias("end"), F.try_element_at(wanted, F.lower(v)).alias("removed"))
        return F.filter(F.zip_with(found, _ends(text, TERM, found), place), lambda t: t["removed"].isNotNull())

    return outside(let(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), told), spans)


def outside(terms: Column, spans: Column) -> Column:
    """The places of ``terms`` that no span overlaps. Both are sorted into one array; a place is free if no span before it
    ends behind its start and the next span does not start before its end."""
    far = 2**31 - 1
    as_span = lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("own"), s["end"].alias("end"), F.lit(None).cast("boolean").alias("removed"))
    as_term = lambda t: F.struct(t["start"].alias("start"), F.lit(1).alias("own"), t["end"].alias("end"), t["removed"].alias("removed"))

    def free(every: Column) -> Column:
        ends = running(F.transform(every, lambda e: F.when(e["own"] == 0, e["end"]).otherwise(0)), F.greatest, 0)
        starts = F.transform(F.reverse(every), lambda e: F.when(e["own"] == 0, e["start"]).otherwise(far))
        ahead = F.reverse(running(starts, F.least, far))
        met = F.arrays_zip(every.alias("e"), ends.alias("behind"), ahead.alias("ahead"))
        kept = F.filter(met, lambda m: (m["e"]["own"] == 1) & (m["behind"] <= m["e"]["start"]) & (m["ahead"] >= m["e"]["end"]))
        return F.transform(kept, lambda m: F.struct(m["e"]["start"].alias("start"), m["e"]["end"].alias("end"), m["e"]["removed"].alias("removed"))).cast(_ADDED)

    return let(F.array_sort(F.concat(F.transform(spans, as_span), F.transform(terms, as_term))), free)


def all_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, spans, added): base spans of every row, and the added ones (start, end, removed) of terms."""
    found = materialize(entities(docs, id_col, text_col), "entities")
    telling = disclosing(found, docs, text_col).select("mark", F.struct("term", F.col("share") >= REMOVES).alias("t"))
    wanted = small_side(materialize(telling.groupBy(F.col("mark").alias("_mark")).agg(F.map_from_entries(F.collect_list("t")).alias("wanted")), "wanted"))
    none = F.array().cast(_ADDED)
    told = found.where(F.size("spans") > 0).join(wanted, F.col("mark") == F.col("_mark"), "left")
    added = F.when(F.col("wanted").isNotNull(), _standing(F.col("text"), F.col("spans"), F.col("wanted"))).otherwise(none)
    told = told.select("doc_id", "mark", "spans", added.alias("added"))
    return told.unionByName(found.where(F.size("spans") == 0).select("doc_id", "mark", "spans", none.alias("added")))


def sanitise(text: Column, spans: Column, added: Column) -> Column:
    """The text with every span replaced: by its kind, ``[TERM]``, or nothing if removed; overlapping spans once."""
    marked = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))
    terms = F.transform(added, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(s["removed"], "").otherwise("[TERM]").alias("put")))

    def block(cut: Column) -> Column:
        # One section of the text per block: a place in a text is found by counting from its start.
        first = cut[0]["at"]
        section = F.substring(text, first + 1, F.greatest(F.element_at(cut, -1)["start"] - first, F.lit(0)))

        def piece(s: Column, within: Column) -> Column:
            gap = F.substring(within, s["at"] - first + 1, F.greatest(s["start"] - s["at"], F.lit(0)))
            return F.concat(gap, F.when(s["start"] >= s["at"], s["put"]).otherwise(""))

        return let(section, lambda within: F.array_join(F.transform(cut, lambda s: piece(s, within)), ""))

    def replaced(every: Column) -> Column:
        ends = running(F.transform(every, lambda s: s["end"]), F.greatest, 0)
        return let(ends, lambda e: F.concat(joined(every, e), F.substring(text, F.element_at(e, -1) + 1, F.length(text))))

    def joined(every: Column, ends: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), ends)
        steps = F.zip_with(every, F.slice(before, F.lit(1), F.size(every)), lambda s, at: F.struct(at.alias("at"), s["start"].alias("start"), s["put"].alias("put")))
        return F.array_join(F.transform(let(steps, blocks), block), "")

    return let(F.array_sort(F.concat(marked, terms)), lambda every: F.when(F.size(every) > 0, replaced(every)).otherwise(text))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; texts without them stay as they are."""
    spans = all_spans(docs).where("size(spans) > 0").dropDuplicates(["doc_id", "mark"])
    spans = small_side(materialize(spans.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "spans", "added"), "spans"))
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce("row.text", F.lit(""))) == F.col("_mark"))
    text = F.when(F.col("spans").isNotNull(), sanitise(F.col("row.text"), F.col("spans"), F.col("added"))).otherwise(F.col("row.text"))
    joined = rows.join(spans, same, "left").withColumn("_text", text)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_text").alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            columns.append(F.when(F.col("spans").isNotNull(), F.length("_text").cast(kind)).otherwise(F.col("row.n_chars")).alias("n_chars"))
        else:
            columns.append(F.col(f"row.`{c}`"))
    return joined.select(*columns)


def op9_disclosure_spans(spark, sf_dir: str) -> DataFrame:
    """Counts and spans of personal data and disclosing terms of every document."""
    found = all_spans(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    entry = lambda kind, s: F.concat_ws(":", kind, s["start"].cast("string"), s["end"].cast("string"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.array_join(F.transform("spans", lambda s: entry(s["kind"], s)), ",")
    merged = F.array_sort(
        F.concat(
            F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))),
            F.transform("added", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["end"].alias("end"), F.lit("term").alias("kind"))),
        )
    )
    every = F.array_join(F.transform(merged, lambda s: entry(s["kind"], s)), ",")
    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"), every.alias("spans"))
