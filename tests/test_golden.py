"""Small cases with known results."""

import pytest
from pyspark.sql import functions as F

from tagloom.functions.typing import type_raw
from tagloom.operators import batching, compare, hierarchy, raw, reads, sequences, series, state, upsert
from tagloom.operators.annotate import annotate
from tagloom.operators.matching import match_entities
from tagloom.plans.delta import delta_cycle, delta_read
from tagloom.request import Request
from tagloom.sources.delimited import read_delimited
from tagloom.sources.tables import read_days, write_snapshot

BODY = "pump;place;note\np1;hall 4;seal worn\np2;yard;7 bar\n;no tag, still a line;checked\n"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def maps(df):
    return sorted((r["row"] for r in df.collect()), key=lambda m: sorted(m.items()))


def text_file(tmp_path, text, name="data.txt"):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


@pytest.mark.parametrize("prefix, tail", [("", ""), ("﻿", "\n   \n\n")])
def test_delimited_default_header(spark, tmp_path, prefix, tail):
    found = maps(read_delimited(spark, text_file(tmp_path, prefix + BODY + tail)))
    assert found == [
        {"pump": "p2", "place": "yard", "note": "7 bar"},
        {"pump": "", "place": "no tag, still a line", "note": "checked"},
        {"pump": "p1", "place": "hall 4", "note": "seal worn"},
    ]


def test_delimited_custom_header(spark, tmp_path):
    path = text_file(tmp_path, "﻿" + BODY)
    found = maps(read_delimited(spark, path, header="first;;last"))
    assert len(found) == 4
    assert {"first": "pump", "": "place", "last": "note"} in found


@pytest.mark.parametrize(
    "header, line, wanted",
    [
        ("x;x", "1;2", [{"x": "12"}]),
        ("x", "1;2", [{"x": "1", "col_1": "2"}]),
        ("x;y", "a", [{"x": "a", "y": ""}]),
        ("x;y", "1", []),
        ("col_1", "1;2", [{"col_1": "12"}]),
        ("x;y", "\t a ; b", [{"x": "a", "y": "b"}]),
    ],
)
def test_delimited_cells(spark, tmp_path, header, line, wanted):
    assert maps(read_delimited(spark, text_file(tmp_path, f"{header}\n{line}\n"))) == wanted


def test_delimiter_is_one_character(spark, tmp_path):
    with pytest.raises(ValueError):
        read_delimited(spark, text_file(tmp_path, BODY), ";;")


def test_delimited_without_files(spark, tmp_path):
    assert read_delimited(spark, str(tmp_path / "none*.txt")).count() == 0


ASSET = (
    "externalId string, name string, parentExternalId string, description string, "
    "metadata map<string,string>, labels array<string>"
)


def test_compare_cases(spark):
    row = lambda key, **set_: (
        key,
        set_.get("name", "n"),
        set_.get("parent"),
        set_.get("description"),
        set_.get("metadata"),
        set_.get("labels"),
    )
    current = [
        row("k1"),
        row("k2"),
        row("k3"),
        row("k5"),
        row("k6"),
        row("k7"),
        row("k8", labels=["a", "b"]),
        row("k9", metadata={"a": "1", "b": "2"}),
        row("k10"),
        row("k10"),
        row("k11", name=None, metadata={}, labels=[]),
    ]
    incoming = [
        row("k2"),
        row("k3", name="other"),
        row("k4"),
        row("k5"),
        row("k5"),
        row("k6"),
        row("k7", description=""),
        row("k8", labels=["b", "a"]),
        row("k9", metadata={"b": "2", "a": "1"}),
        row("k10"),
        row("k11", name=""),
    ]
    found = compare.compare(
        spark.createDataFrame(current, ASSET), spark.createDataFrame(incoming, ASSET), ["externalId"], ASSET_FIELDS
    )
    assert rows(found.groupBy("externalId", "change").count()) == sorted(
        [
            ("k1", "delete", 1),
            ("k2", "unchanged", 1),
            ("k3", "update", 1),
            ("k4", "insert", 1),
            ("k5", "invalid", 2),
            ("k6", "unchanged", 1),
            ("k7", "update", 1),
            ("k8", "update", 1),
            ("k9", "unchanged", 1),
            ("k10", "insert", 1),
            ("k11", "unchanged", 1),
        ],
        key=repr,
    )


ASSET_FIELDS = ["externalId", "name", "parentExternalId", "description", "metadata", "labels"]


@pytest.mark.parametrize("small", [True, False])
def test_upsert_modes(spark, monkeypatch, small):
    monkeypatch.setattr(upsert, "is_small", lambda df: small)
    schema = "id long, a string, b string, m map<string,string>"
    current = spark.createDataFrame([(1, "x", "y", {"k": "1", "l": "2"}), (3, "p", "q", None)], schema)
    incoming = spark.createDataFrame([(1, "z", None, {"k": "9"}), (2, "n", None, None)], schema)
    plain = lambda df: rows(df.select("id", "a", "b", F.to_json("m").alias("m")))
    kept = (3, "p", "q", None)
    assert plain(upsert.upsert(current, incoming, ["id"])) == sorted(
        [(1, "z", "y", '{"k":"9"}'), (2, "n", None, None), kept], key=repr
    )
    assert plain(upsert.upsert(current, incoming, ["id"], merge_maps=True))[0] == (1, "z", "y", '{"l":"2","k":"9"}')
    replaced = upsert.upsert(current, incoming, ["id"], mode="replace")
    assert plain(replaced) == sorted([(1, "z", None, '{"k":"9"}'), (2, "n", None, None), kept], key=repr)
    assert plain(upsert.upsert(replaced, incoming, ["id"], mode="replace")) == plain(replaced)


RAW = "dbName string, tableName string, key string, columns string, lastUpdatedTime long"


def test_delta(spark):
    stored = spark.createDataFrame([("db", "t", "a_1", '{"identifier":"a","timestamp":1000}', 5)], RAW)
    table = spark.createDataFrame([(t,) for t in (1, 998, 999, 1000, 5000, 6000)], "lastUpdatedTime long")
    times = lambda request, who="a", **kw: rows(delta_read(table, request, stored, "db.t", who, **kw))
    assert times(Request()) == [(1000,), (5000,), (6000,), (999,)]
    assert times(Request().with_filter("lastUpdatedTime", {"min": 5000})) == [(5000,), (6000,)]
    assert times(Request().with_filter("lastUpdatedTime", {"min": 2, "max": 5000})) == [(1000,), (5000,), (999,)]
    assert len(times(Request(), "b")) == 6
    assert len(times(Request(), full_override=True)) == 6
    none = delta_cycle(table, Request().with_filter("lastUpdatedTime", {"min": 9000}), stored, "db.t", "a")
    assert none[1].count() == 0
    assert delta_cycle(table, Request(), stored, "db.t", "a", full_override=True)[1].count() == 0
    _, mark = delta_cycle(table, Request(), stored, "db.t", "a")
    assert '"timestamp":6000' in mark.first()["columns"]
    assert '"utc":"1970-01-01T00:00:06Z"' in mark.first()["columns"]
    with pytest.raises(ValueError):
        delta_read(table, Request(), stored, "t", "a")
    with pytest.raises(ValueError):
        delta_read(table, Request(), stored, "db.t", "x" * 1000)


def test_newest_timestamp_is_by_row_time(spark):
    stored = spark.createDataFrame(
        [
            ("db", "t", "a_1", '{"identifier":"a","timestamp":50}', 9),
            ("db", "t", "a_2", '{"identifier":"a","timestamp":70}', 8),
            ("db", "t", "a_3", '{"identifier":"a"}', 10),
            ("db", "t", "a_4", '{"timestamp":99}', 11),
            ("db", "u", "a_5", '{"identifier":"a","timestamp":99}', 12),
        ],
        RAW,
    )
    assert rows(state.read_timestamp(stored, "db.t", "a")) == [(50,)]
    assert rows(state.read_timestamp(stored, "db.t", "b")) == [(1,)]


def test_state(spark):
    none = spark.createDataFrame([], "key string, high long")
    pair = lambda *highs: spark.createDataFrame(
        [("k", h, i) for i, h in enumerate(highs)], "key string, high long, ord int"
    )
    ten = state.set_high(none, pair(10), "ord")
    assert rows(ten) == [("k", 10)]
    assert rows(state.set_high(ten, pair(7, 5), "ord")) == [("k", 5)]
    assert rows(state.expand_high(ten, pair(5))) == [("k", 10)]
    assert rows(state.expand_high(ten, pair(20, None))) == [("k", 20)]
    keys = lambda *names: spark.createDataFrame([(n,) for n in names], "key string")
    assert rows(state.get_high(ten, keys("k", "u"))) == [("k", 10), ("u", None)]
    assert rows(state.delete_state(ten, keys(" ", "", None))) == [("k", 10)]
    assert rows(state.delete_state(ten, keys("k"))) == []


def test_typing(spark):
    values = ["1.5", '"2.5"', '"x"', "true", "1.0", "2.0", '"TRUE"', '"yes"', "null", "7", '"NaN "', '{"a":1}']
    table = spark.createDataFrame([(i, f'{{"v":{v}}}') for i, v in enumerate(values)], "i int, columns string")
    doubles, no_doubles = type_raw(table, {"v": "double"})
    assert rows(doubles.where("not isnan(v)").select("i", "v")) == [(0, 1.5), (1, 2.5), (4, 1.0), (5, 2.0), (9, 7.0)]
    assert rows(no_doubles.select("i")) == [(11,), (2,), (3,), (6,), (7,), (8,)]
    flags, no_flags = type_raw(table, {"v": "boolean"})
    assert [r for r in rows(flags.select("i", "v")) if r[1]] == [(3, True), (4, True), (6, True)]
    assert rows(no_flags.select("i")) == [(11,), (8,)]


def test_levels_and_cycles(spark):
    chain = [("n0", None, "n0")] + [(f"n{i}", f"n{i - 1}", f"n{i}") for i in range(1, 41)]
    tree = spark.createDataFrame(chain + [("x", "outside", "x")], "externalId string, parentExternalId string, name string")
    levels = {r["externalId"]: r for r in hierarchy.hierarchy_levels(tree).collect()}
    assert len(levels) == 42
    assert levels["n40"]["depth"] == 40 and levels["n40"]["root"] == "n0"
    assert levels["n40"]["path"] == [f"n{i}" for i in range(41)]
    assert levels["x"]["depth"] == 0 and levels["x"]["root"] == "x"
    assert hierarchy.detect_cycles(tree).count() == 0

    loops = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "d"), ("p", "q"), ("q", "p"), ("r", None)]
    loops += [(f"t{i}", f"t{i - 1}" if i else "p") for i in range(20)]
    bad = spark.createDataFrame([(*p, p[0]) for p in loops], tree.schema)
    assert rows(hierarchy.detect_cycles(bad)) == [("a",), ("b",), ("c",), ("p",), ("q",)]
    with pytest.raises(ValueError):
        hierarchy.hierarchy_levels(bad)


@pytest.mark.parametrize(
    "extra, rule",
    [
        (("a", "a", "self"), "self_reference"),
        ((None, "root", "none"), "missing_external_id"),
        (("child", "root", "twice"), "duplicate"),
    ],
)
def test_bad_batches_fail(spark, extra, rule):
    schema = "externalId string, parentExternalId string, name string"
    good = [("root", None, "r"), ("child", "root", "c"), ("grandchild", "child", "g")]
    current = spark.createDataFrame([], schema)
    assert hierarchy.write_assets(current, spark.createDataFrame(good, schema)).count() == 3
    with pytest.raises(ValueError, match=rule):
        hierarchy.write_assets(current, spark.createDataFrame([*good, extra], schema))


def test_cycle_fails(spark):
    batch = spark.createDataFrame(
        [("root", None, "r"), ("B", "root", "b"), ("B_A_A", "B_A_A_A", "c"), ("B_A_A_A", "B_A_A", "d")],
        "externalId string, parentExternalId string, name string",
    )
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.write_assets(batch.limit(0), batch)


def test_asset_lookup(spark):
    table = spark.createDataFrame(
        [(1, "Plant", 1, None), (2, "Hall", 1, 1), (3, "Yard", 1, 1), (4, "Lost", 9, 9), (None, "New", 1, 1)],
        "id long, name string, rootId long, parentId long",
    )
    found = hierarchy.build_asset_lookup(table).select("id", "name", "rootName")
    assert rows(found) == [
        (1, "Plant", "Plant"),
        (2, "Hall", "Plant"),
        (3, "Yard", "Plant"),
        (4, "Lost", None),
    ]


def test_synchronize_reaches_the_input(spark):
    schema = "id long, externalId string, name string, parentExternalId string, root string, dataSetId long"
    current = spark.createDataFrame(
        [(1, "r", "r", None, "r", None), (2, "a", "a", "r", "r", None), (3, "b", "b", "a", "r", None), (4, "o", "o", None, "o", 7)],
        schema,
    )
    incoming = spark.createDataFrame(
        [(None, "r", "r", None, "r", None), (None, "b", "moved", "r", "r", None), (None, "n", "n", "b", "r", None)], schema
    )
    fields = ["externalId", "name", "parentExternalId", "dataSetId"]
    upserts, deletes, table = compare.synchronize(current, incoming, "root", fields)
    assert rows(upserts.select("externalId")) == [("b",), ("n",)]
    assert rows(deletes.select("externalId")) == [("a",)]
    assert rows(table.select("id", "externalId", "name")) == sorted(
        [(1, "r", "r"), (3, "b", "moved"), (None, "n", "n"), (4, "o", "o")], key=repr
    )
    again = compare.change_counts(table.where("root = 'r'"), incoming, ["root", "externalId"], fields)
    assert rows(again) == [("unchanged", 3)]


def test_matching_fixture(spark):
    sources = spark.createDataFrame([(1, "70-FT-2204"), (2, "70-LT-2204"), (3, "518-Ø")], "id int, name string")
    targets = spark.createDataFrame([(1, "XV-70_FT_2204"), (2, "TAG_70_LT_2204")], "id int, externalId string")
    for kind in ("simple", "bigram", "frequency-weighted-bigram", "bigram-extra-tokenizers"):
        found = match_entities(sources, targets, [("name", "externalId")], kind)
        assert rows(found.select("source_id", "target_id")) == [(1, 1), (2, 2)], kind
    two = match_entities(sources, targets, [("name", "externalId")], "simple", 2)
    assert rows(two.select("source_id", "target_id", "rank")) == [(1, 1, 1), (1, 2, 2), (2, 1, 2), (2, 2, 1)]
    assert match_entities(sources, targets, [("name", "externalId")], threshold=0.99).count() == 0


def test_annotation_whole_and_partial(spark):
    documents = spark.createDataFrame(
        [(1, "Pump P-101 feeds pump p 101; valve."), (2, "p 101"), (3, "the PUMP P")], "doc_id int, text string"
    )
    names = spark.createDataFrame([(7, "PUMP P-101"), (8, "valve"), (9, "pump.p.101")], "id int, name string")
    assert rows(annotate(documents, names)) == [(1, 7, 2, 0), (1, 9, 2, 0)]
    partial = annotate(documents, names, partial=True)
    assert rows(partial.where("entity_id = 7")) == [(1, 7, 4, 0), (2, 7, 1, 0), (3, 7, 1, 1)]
    assert rows(annotate(documents, names, min_tokens=1).where("entity_id = 8")) == [(1, 8, 1, 7)]


def test_requests(spark):
    request = Request.from_json(
        '{"limit": 5, "filter": {"type": ["a", "b"], "metadata": {"k": "1"}, "lastUpdatedTime": {"max": 9}}, '
        '"items": [{"externalId": "x"}, {"id": 2}]}'
    )
    assert request.root == {"limit": 5} and request.metadata == {"k": "1"} and len(request.items) == 2
    table = spark.createDataFrame(
        [(1, "x", "a", {"k": "1"}, 9), (2, "y", "b", {"k": "1"}, 8), (3, "z", "a", {"k": "1"}, 1), (2, "w", "a", {}, 1)],
        "id long, externalId string, type string, metadata map<string,string>, lastUpdatedTime long",
    )
    assert rows(reads.list_resource(table, request).select("externalId")) == [("x",), ("y",)]
    assert reads.list_resource(table, Request(first_n=2)).count() == 2


def test_datapoint_reads(spark):
    points = spark.createDataFrame(
        [("a", t, float(t)) for t in range(10)] + [("b", t, float(t)) for t in range(5)],
        "externalId string, timestamp long, valueNum double",
    )
    items = spark.createDataFrame([("a", 2, 4), ("a", 3, 5), ("b", None, 1)], "externalId string, start long, end long")
    found = series.read_datapoints(points, items)
    assert rows(found.select("externalId", "timestamp")) == [("a", 2), ("a", 3), ("a", 3), ("a", 4), ("b", 0)]
    assert series.read_datapoints(points, limit=3).count() == 15
    assert series.read_datapoints(points, limit=3, limit_mode="per_series").count() == 6
    with pytest.raises(ValueError):
        series.read_datapoints(points, start=5, end=5)
    bad = points.withColumn("externalId", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="neither externalId nor id"):
        series.upsert_datapoints(points, bad).collect()


def test_day_layout_prunes(spark, tmp_path):
    day = 86_400_000
    points = spark.createDataFrame([("a", d * day + 5, 1.0) for d in range(6)], "externalId string, timestamp long, valueNum double")
    stored = write_snapshot(points, str(tmp_path / "dp"), "datapoints")
    found = read_days(stored, day, 3 * day)
    assert rows(found.select("timestamp")) == [(2 * day + 5,), (day + 5,)]
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan
    assert found.select("day").distinct().count() == 2


def test_raw_needs_names(spark):
    table = spark.createDataFrame([("d", "t", "k", '{"a":1,"b":2}', 1)], RAW)
    with pytest.raises(ValueError):
        raw.read_raw(table, "d", "")
    assert rows(raw.read_raw(table, "d", "t", Request(root={"columns": "b, a"})).select("b", "a")) == [("2", "1")]


def test_sequence_bodies(spark):
    cell = lambda d, s=None: (d, None, s)
    bodies = spark.createDataFrame(
        [("q", ["x", "y"], [(1, [cell(1.0), cell(None, "u")]), (2, [cell(None), cell(None)])])],
        "externalId string, columns array<string>, rows array<struct<rowNumber:long,values:array<struct<d:double,l:long,s:string>>>>",
    )
    cells = sequences.bodies_to_cells(bodies)
    assert rows(cells.select("rowNumber", "column", "d", "s")) == sorted(
        [(1, "x", 1.0, None), (1, "y", None, "u"), (2, "x", None, None), (2, "y", None, None)], key=repr
    )
    wide = sequences.cells_to_rows(cells, {"x": "d", "y": "s"})
    back = sequences.rows_to_bodies(wide, {"x": "d", "y": "s"})
    assert back.select("rows").first()[0] == bodies.select("rows").first()[0]


def test_external_ids(spark):
    table = spark.createDataFrame([(1, None, "a"), (None, "e", "b"), (None, None, "c")], "id long, externalId string, name string")
    for deterministic in (True, False):
        found = {r["name"]: r["externalId"] for r in upsert.ensure_external_id(table, deterministic).collect()}
        assert found["a"] is None and found["b"] == "e" and len(found["c"]) >= 32


def test_equal_rows_get_ids_of_their_own(spark):
    table = spark.createDataFrame([(None, None, "c")] * 3 + [(None, None, "d"), (4, None, "e")], "id long, externalId string, name string")
    found = upsert.ensure_external_id(table).collect()
    made = [r["externalId"] for r in found if r["id"] is None]
    assert len(found) == 5 and len(set(made)) == 4
    assert sorted(made) == sorted(r["externalId"] for r in upsert.ensure_external_id(table).collect() if r["id"] is None)


def test_rows_with_an_id_only_are_written_to_its_row(spark):
    stored = spark.createDataFrame([(7, "e7", "old"), (8, "e8", "old")], "id long, externalId string, name string")
    given = spark.createDataFrame([(7, None, "new"), (9, None, "added"), (None, "e8", "new")], stored.schema)
    for mode in ("update", "replace"):
        assert rows(upsert.upsert(stored, given, ["externalId"], mode)) == [(7, "e7", "new"), (8, "e8", "new"), (9, None, "added")]


@pytest.mark.parametrize("small", [True, False])
def test_upsert_finds_rows_by_id(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(upsert, "is_small", lambda *a, **k: False)
    kind = "id long, externalId string, name string"
    stored = spark.createDataFrame([(7, None, "old"), (8, "e8", "b"), (None, "e9", "c"), (None, None, "d")], kind)
    write = lambda given, **k: rows(upsert.upsert(stored, spark.createDataFrame(given, kind), ["externalId"], **k))
    assert write([(7, None, "new")]) == rows(stored.where("id is null or id <> 7").union(spark.createDataFrame([(7, None, "new")], kind)))
    assert {r for r in write([(7, "e7", "new"), (10, None, "x")]) if r[0] in (7, 10)} == {(7, "e7", "new"), (10, None, "x")}
    assert (11, "e9", "c") in write([(11, "e9", None)])  # an id for a row without one
    assert len(write([(None, None, "new"), (None, None, "new")])) == 6  # rows without a key are new
    for twice in ([(None, "e8", "x"), (8, None, "y")], [(8, "e8", "x"), (8, "e8", "x")], [(None, "z", "x"), (None, "z", "y")], [(12, None, "x"), (12, None, "y")]):
        with pytest.raises(ValueError, match="several incoming rows"):
            write(twice)
    with pytest.raises(Exception, match="name two stored rows"):
        write([(7, "e8", "x")])


def test_points_with_an_id_only(spark):
    points = spark.createDataFrame([("a", 1, 1.0)], "externalId string, timestamp long, valueNum double")
    headers = spark.createDataFrame([(5, "a")], "id long, externalId string")
    given = spark.createDataFrame([(5, None, 1, 2.0), (5, None, 2, 3.0)], "id long, externalId string, timestamp long, valueNum double")
    assert rows(series.upsert_datapoints(points, given, headers=headers)) == [("a", 1, 2.0), ("a", 2, 3.0)]
    lost = spark.createDataFrame([(None, None, 1, 2.0)], given.schema)
    assert rows(series.upsert_datapoints(points, lost, check=False)) == [("a", 1, 1.0)]


REQUESTS = "request_id long, request string"


def test_requests_are_never_widened(spark):
    table = spark.createDataFrame([(1, "e1", "x", 5), (2, "e2", "y", None), (3, "e3", "z", 9)], "id long, externalId string, type string, lastUpdatedTime long")
    fields = {"type": F.col("type"), "id": F.col("id").cast("string"), "externalId": F.col("externalId")}

    def hits(text):
        asked = reads.parse_requests(spark.createDataFrame([(1, text)], REQUESTS), list(fields))
        return sorted(r["id"] for r in reads.list_many(table, asked, fields).collect())

    assert hits("{}") == [1, 2, 3]
    assert hits('{"filter":{"type":["x","y","x"]}}') == [1, 2]
    assert hits('{"filter":{"type":[]}}') == []
    assert hits('{"filter":{"lastUpdatedTime":{"min":6}}}') == [3]
    assert hits('{"filter":{"lastUpdatedTime":{"min":-9000000000000000000,"max":9000000000000000000}}}') == [1, 3]
    assert hits('{"items":[{"id":2},{"externalId":"e3"},{"id":77}]}') == [2, 3]
    assert hits('{"filter":{"type":"z"},"items":[{"id":2},{"id":3}]}') == [3]
    assert hits('{"minLastUpdatedTime":6}') == [3]
    assert hits('{"filter":{"lastUpdatedTime":{"min":1}},"maxLastUpdatedTime":8}') == [1]
    limited = reads.parse_requests(spark.createDataFrame([(1, '{"limit":3}')], REQUESTS), list(fields), root_keys=["limit"])
    assert limited.first()["limit"] == "3"
    for bad in ("{", "[1]", '{"filter":{"colour":"x"}}', '{"limit":3}', '{"filter":{"metadata":{"k":"v"}}}', '{"filter":{"lastUpdatedTime":{"from":1}}}'):
        with pytest.raises(Exception, match="request"):
            hits(bad)


def test_delta_limits_after_the_mark(spark):
    stored = spark.createDataFrame([("db", "t", "a_1", '{"identifier":"a","timestamp":6}', 5)], RAW)
    table = spark.createDataFrame([(1, 1), (2, 10), (3, 20)], "id long, lastUpdatedTime long")
    assert rows(delta_read(table, Request(first_n=1), stored, "db.t", "a")) == [(2, 10)]


def test_delta_mark_covers_the_rows_returned(spark, tmp_path):
    stored = spark.createDataFrame([("db", "t", "a_1", '{"identifier":"a","timestamp":6}', 5)], RAW)
    path = str(tmp_path / "t")
    spark.createDataFrame([(2, 10), (3, 20)], "id long, lastUpdatedTime long").write.parquet(path)
    found, mark = delta_cycle(spark.read.parquet(path), Request(), stored, "db.t", "a")
    spark.createDataFrame([(4, 30)], "id long, lastUpdatedTime long").write.mode("append").parquet(path)
    assert rows(found) == [(2, 10), (3, 20)] and '"timestamp":20' in mark.first()["columns"]


def test_column_lists_are_per_request(spark):
    table = spark.createDataFrame([("d", "t", "k", '{"a":1,"b":"2","c":{"x":[1]}}', 1)], RAW)
    asked = spark.createDataFrame([(1, "d", "t", "a, c"), (2, "d", "t", None)], "request_id long, dbName string, tableName string, columns string")
    found = {r["request_id"]: r["columns"] for r in raw.read_many_raw(table, asked).collect()}
    assert found == {1: '{"a":1,"c":{"x":[1]}}', 2: '{"a":1,"b":"2","c":{"x":[1]}}'}


def test_time_ranges_reach_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    points = events.select(F.col("user_id").cast("string").alias("externalId"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), F.col("value").alias("valueNum"), "ts")
    found = series.read_datapoints(points, None, 1704412800000, 1704844800000, stored=F.col("ts"))
    pushed = found._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_empty_write_reports_zero(spark, tmp_path):
    table = spark.createDataFrame([], "a int")
    assert rows(upsert.pipeline_run(table, "p", "SEEN")) == [("p", "SEEN", "Number of data objects upserted: 0")]
    with pytest.raises(ValueError):
        upsert.pipeline_run(table, "p", "FAILED")
    some = spark.range(7)
    assert upsert.write_with_run(some, str(tmp_path / "t"), str(tmp_path / "runs"), "p") == 7
    assert spark.read.parquet(str(tmp_path / "runs")).first()["message"] == "Number of data objects upserted: 7"


def test_batches_without_keys(spark):
    table = spark.createDataFrame([(None, i) for i in (*range(4), None)] + [("k", i) for i in range(3)], "key string, id long")
    found = batching.group_into_batches(table, ["key"], 2, hot_rows=2)
    assert rows(found.select("key", F.size("items"))) == [("k", 1), ("k", 2), (None, 1), (None, 2), (None, 2)]
