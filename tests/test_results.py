import json

import pytest
from pyspark.sql import functions as F

from pointlake.operators import results
from pointlake.sources.responses import read_responses

def documents(spark, *docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, doc string")
    return results.parse_documents(df, "doc")


def one(*series, **more):
    return {"results": [{"series": list(series), **more}]}


def flat(spark, doc, columns, tags=(), precision=None):
    df = results.flatten_responses(documents(spark, doc), columns, tags, precision)
    return df.orderBy("result_index", "series_index", "row_index")


def table(name="fan", columns=("time", "load"), values=(), **more):
    return {"name": name, "columns": list(columns), "values": [list(v) for v in values], **more}


@pytest.mark.parametrize(
    "doc", [{}, {"results": None}, one(), {"results": [{}, {"series": None}]}, one(table()), one({"name": "fan", "columns": ["load"]})]
)
def test_no_rows(spark, doc):
    assert flat(spark, doc, {"load": "double"}).count() == 0


@pytest.mark.parametrize(
    "texts, precision, expected",
    [
        (["2031-02-03T04:05:06Z", "2031-02-03T04:05:06.7Z", "1969-12-31T23:59:59.999999999Z"], None,
         [1927857906 * 10**9, 19278579067 * 10**8, -1]),
        ([-3, 0, 1987654321], "s", [-3 * 10**9, 0, 1987654321 * 10**9]),
        ([7, "8"], "h", [7 * 3600 * 10**9, 8 * 3600 * 10**9]),
        ([1987654321012345678, -1], None, [1987654321012345678, -1]),
    ],
)
def test_times(spark, texts, precision, expected):
    doc = one(table(values=[(t, i / 4) for i, t in enumerate(texts)]))
    rows = flat(spark, doc, {"time": "bigint", "load": "double"}, precision=precision).collect()
    assert [(r.time_ns, r.load) for r in rows] == [(t, i / 4) for i, t in enumerate(expected)]


SITES = {"east": [0.5, 0.25, 8.0], "north": [3.5], "west": []}
GROUPED = one(*[table(columns=["load"], values=[[v] for v in values], tags={"site": site}) for site, values in SITES.items()])


def test_groups(spark):
    rows = flat(spark, GROUPED, {"load": "double"}, ["site"]).collect()
    assert [(r.site, r.load) for r in rows] == [(site, v) for site, values in SITES.items() for v in values]


@pytest.mark.parametrize("site", [*SITES, "south"])
def test_group_of_response(spark, site):
    found = results.group_of_response(documents(spark, GROUPED), {"site": site})
    rows = results.flatten_responses(found, {"load": "double"}).orderBy("row_index").collect()
    assert [r.load for r in rows] == SITES.get(site, [])


@pytest.mark.parametrize("matcher", [{}, {"floor": "east"}, {"site": "east", "floor": "1"}])
def test_groups_of_other_tags(spark, matcher):
    found = results.group_of_response(documents(spark, GROUPED), matcher)
    assert results.flatten_responses(found, {"load": "double"}).count() == 0


def test_group_without_tags(spark):
    doc = documents(spark, one(table(values=[("2031-02-03T04:05:06Z", 1.5)])))
    found = results.group_of_response(doc, {"site": "east"})
    assert results.flatten_responses(found, {"load": "double"}).count() == 0


def test_first_matching_series_wins(spark):
    doc = one(
        table("m1", ["v"], [[1]], tags={"t": "x"}), table("m2", ["v"], [[2]], tags={"t": "x"})
    )
    found = results.group_of_response(documents(spark, doc), {"t": "x"})
    assert [r.v for r in results.flatten_responses(found, {"v": "int"}).collect()] == [1]


def test_tags_replace_columns_and_come_from_the_first_series(spark):
    doc = one(
        table(columns=["t", "v"], values=[["col", 1]], tags={"t": "tag"}),
        table(columns=["t", "v"], values=[["col", 2]], tags={"t": "other", "u": "late"}),
    )
    rows = flat(spark, doc, {"t": "string", "v": "int"}, ["t", "u"]).collect()
    assert [(r.t, r.u, r.v) for r in rows] == [("tag", None, 1), ("other", None, 2)]


def test_short_rows_and_repeated_columns(spark):
    doc = one(table(columns=["a", "b", "a"], values=[[1, 2, 3], [4]]))
    rows = flat(spark, doc, {"a": "int", "b": "int"}).collect()
    assert [(r.a, r.b) for r in rows] == [(3, 2), (None, None)]


def test_statements(spark):
    doc = {
        "results": [
            {"series": [table(columns=["v"], values=[[1]])]},
            {"series": [table(columns=["v"], values=[[2]])]},
        ]
    }
    rows = results.flatten_responses(documents(spark, doc), {"v": "int"})
    first, second = results.split_results(rows, 2)
    assert [r.v for r in first.collect()] == [1] and [r.v for r in second.collect()] == [2]
    alone = results.flatten_responses(documents(spark, GROUPED), {"load": "double"})
    assert results.split_results(alone, 1).count() == 4
    with pytest.raises(Exception, match="exactly one result, but got 2"):
        results.assert_single(documents(spark, doc)).collect()
    assert results.assert_single(documents(spark, GROUPED)).count() == 1


def test_errors(spark):
    docs = documents(
        spark, {"results": [{"error": "no such pump"}, {}]}, {"error": "cannot read this"}, GROUPED,
        {"results": [{}, {}, {"error": "third"}]},
    )
    rows = results.error_rows(docs).orderBy("id").collect()
    assert [(r.id, r.result_index, r.error) for r in rows] == [
        (0, 0, "no such pump"), (1, None, "cannot read this"), (3, 2, "third"),
    ]
    for number, message in ((0, "no such pump"), (1, "cannot read"), (3, "third")):
        with pytest.raises(Exception, match=message):
            results.assert_no_errors(docs.filter(f"id = {number}")).collect()
    assert results.assert_no_errors(docs.filter("id = 2")).count() == 1


def test_absent_columns_and_unreadable_documents(spark):
    doc = one(table(columns=["a"], values=[[1, 99], [2]]))
    assert [(r.a, r.b) for r in flat(spark, doc, {"a": "int", "b": "int"}).collect()] == [(1, None), (2, None)]
    texts = ["{\"results\": [{}]}", "oops", "[1]", "{\"results\": ", None]
    df = results.parse_documents(spark.createDataFrame(list(enumerate(texts)), "id int, doc string"), "doc")
    assert {r.id: r.error for r in results.error_rows(df).collect()} == dict.fromkeys((1, 2, 3), "not a response document")
    with pytest.raises(Exception, match="not a response document"):
        results.assert_no_errors(df).collect()


@pytest.mark.parametrize(
    "text", ["2031-02-03T04:05:06.7.8Z", "2031-02-03T04:05:06+01:00", "2031-02-03T04:05:06.0123456789Z", "noon", "9" * 19]
)
def test_unreadable_times_are_null(spark, text):
    doc = one(table(values=[(text, 1)]))
    assert flat(spark, doc, {"load": "double"}, precision="s").first().time_ns is None


def test_documents_over_several_lines(spark, tmp_path):
    doc = one({"columns": ["site", "floors", "closed"], "values": [["east", 3, False], ["north", None, True]]})
    (tmp_path / "d.json").write_text(json.dumps(doc, indent=2))
    rows = read_responses(
        spark, str(tmp_path / "d.json"), {"site": "string", "floors": "int", "closed": "boolean"}, whole_files=True,
    ).orderBy("row_index").collect()
    assert [(r.site, r.floors, r.closed) for r in rows] == [("east", 3, False), ("north", None, True)]


@pytest.fixture
def points(spark):
    rows = [(t, i, float(i * 10 % 7)) for t in ("a", "b", None) for i in range(25)]
    return spark.createDataFrame(rows, "tag string, time_ns bigint, v double").repartition(3)


@pytest.mark.parametrize("descending", [False, True])
def test_nested_groups(points, descending):
    rows = results.groups(points, "m", ["tag"], "10ns", descending=descending).collect()
    assert len(rows) == 9 and all(len(r.rows) <= 10 for r in rows)
    for r in rows:
        times = [x.time_ns for x in r.rows]
        assert times == sorted(range(r.bucket, min(r.bucket + 10, 25)), reverse=descending)
        assert (r.first_time, r.last_time) == (min(times), max(times))


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_groups_depend_on_the_rows_only(spark, points, partitions):
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(partitions)}
    old = {k: spark.conf.get(k) for k in settings}
    want = sorted(map(str, results.groups(points, "m", ["tag"], "7ns").collect()))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = results.groups(points.repartition(partitions), "m", ["tag"], "7ns")
        assert sorted(map(str, found.collect())) == want
        series = results.series_rows(points.repartition(partitions), "m", ["tag"], "7ns")
        assert series.count() == len(want)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_copies_of_a_row_are_kept(spark):
    df = spark.sql("SELECT 'a' tag, 1L time_ns, 2.0D v FROM range(100)")
    nested = results.groups(df, "m", ["tag"], "1s").collect()
    assert sum(len(r.rows) for r in nested) == 100


def test_series_documents_flatten_back(spark, points):
    series = results.series_rows(points, "m", ["tag"], "6ns")
    docs = results.response_documents(series.filter("tag IS NOT NULL"), ["tag"])
    back = results.flatten_responses(
        results.parse_documents(docs.withColumnRenamed("tag", "kind"), "document"),
        {"v": "double"}, ["tag"],
    )
    want = points.filter("tag IS NOT NULL").select("tag", "time_ns", "v")
    got = back.select("tag", "time_ns", "v")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_group_of_a_table(points):
    assert results.group(points, ["tag"], {"tag": "a"}).count() == 25
    assert results.group(points, ["tag"], {"tag": "z"}).count() == 0
    assert results.group(points, ["tag"], {}).count() == 0
    assert results.group(points, ["tag"], {"tag": "a", "x": "1"}).count() == 0
    assert results.group(points, [], {}).count() == 0
    assert points.filter(F.col("tag").isNull()).count() == 25


# -- columns named by the data ----------------------------------------------------------


def typed(spark, *docs):
    df = spark.createDataFrame([(i, json.dumps(d) if not isinstance(d, str) else d) for i, d in enumerate(docs)], "id int, doc string")
    return results.parse_documents(df, "doc", typed=True)


@pytest.mark.parametrize(
    "cells, kind, expected",
    [
        ([1, -7, None], "bigint", [1, -7, None]),
        ([1, 0.25, 1e300], "double", [1.0, 0.25, 1e300]),
        ([12345678901234567890123], "double", [1.2345678901234568e22]),
        ([True, None, False], "boolean", [True, None, False]),
        (["a", None, ""], "string", ["a", None, ""]),
        ([True, 1], "string", ["true", "1"]),
        ([1, "1"], "string", ["1", "1"]),
        ([{"q": [1, "x"]}, "y"], "string", ['{"q":[1,"x"]}', "y"]),
        ([None, None], "string", [None, None]),
    ],
)
def test_kinds_widen(spark, cells, kind, expected):
    df = results.flatten_responses(typed(spark, one(table(columns=["v"], values=[[c] for c in cells]))))
    assert dict(df.dtypes)["v"] == kind
    assert [r.v for r in df.orderBy("row_index").collect()] == expected


def test_found_columns_equal_declared_ones(spark):
    docs = [
        one(*[table(values=[(10 * i, i / 4)], tags={"site": s}) for i, s in enumerate(["e", "n"])]),
        one(table(columns=["load", "time", "state"], values=[[2, "2031-02-03T04:05:06Z", "on"], [3]], tags={"site": "w", "bay": "1"})),
        one(table(columns=["never"])), {"results": None},
    ]
    found = results.flatten_responses(typed(spark, *docs))
    declared = results.flatten_responses(
        documents(spark, *docs), {"load": "double", "state": "string"}, ["bay", "site"]
    )
    assert found.columns == declared.columns and found.dtypes == declared.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, declared.collect()))
    # Documents whose cells are text give columns of text.
    plain = results.flatten_responses(documents(spark, *docs))
    assert dict(plain.dtypes)["load"] == "string" and plain.columns == found.columns


def test_names_of_the_data_go_first(spark):
    doc = one(table(columns=["name", "id", "Load", "load", "row_index", "_id"], values=[["cpu", 5, 1, 2, 3, 4]]))
    df = results.flatten_responses(typed(spark, doc))
    row = df.first()
    values = dict(zip(df.columns, row, strict=True))
    assert values == {
        "__id": 0, "result_index": 0, "series_index": 0, "_row_index": 0, "_name": "fan", "time_ns": None,
        "name": "cpu", "id": 5, "Load": 1, "load": 2, "row_index": 3, "_id": 4,
    }


def test_repeated_columns_and_short_rows(spark):
    doc = one(table(columns=["a", "b", "a"], values=[["text", 2, 3], [4]]))
    df = results.flatten_responses(typed(spark, doc))
    assert dict(df.dtypes)["a"] == "bigint"
    assert [(r.a, r.b) for r in df.orderBy("row_index").collect()] == [(3, 2), (None, None)]


def test_a_tag_in_place_of_a_column(spark):
    doc = one(table(columns=["t", "v"], values=[[1, 1]], tags={"t": "tag"}))
    other = one(table(columns=["t", "v"], values=[[7, 2]]))
    rows = results.flatten_responses(typed(spark, doc, other)).orderBy("id").collect()
    assert [(r.t, r.v) for r in rows] == [("tag", 1), ("7", 2)]


def test_statements_with_columns_of_their_own(spark):
    doc = {"results": [
        {"series": [table(columns=["v"], values=[[1]])]}, {},
        {"series": [table(columns=["w", "time"], values=[["x", 5]], tags={"s": "t"})]},
    ]}
    first, second, third = results.flatten_statements(typed(spark, doc))
    assert "v" in first.columns and "w" not in first.columns and first.first().v == 1
    assert second.count() == 0
    assert (third.first().w, third.first().s, third.first().time_ns) == ("x", "t", 5)
    alone = results.flatten_statements(typed(spark, one(table(columns=["v"], values=[[0.5]]))))
    assert alone.first().v == 0.5


def test_no_documents_and_too_many_columns(spark):
    nothing = typed(spark, one()).where("false")
    assert results.result_columns(nothing) == {}
    empty = results.flatten_responses(nothing)
    assert empty.count() == 0 and "time_ns" in empty.columns
    wide = typed(spark, one(table(columns=[f"c{i}" for i in range(30)], values=[[1] * 30])))
    with pytest.raises(ValueError, match="declare the wanted ones"):
        results.result_columns(wide, limit=29)


def test_series_and_groups_of_typed_documents(spark):
    points = spark.createDataFrame([("a", 1, 0.5, True), ("b", 2, None, False)], "tag string, time_ns bigint, v double, f boolean")
    series = results.series_rows(points, "m", ["tag"], "1h", typed=True)
    parsed = results.parse_documents(results.response_documents(series, ["tag"]).select("document"), "document", typed=True)
    back = results.flatten_responses(parsed)
    assert sorted((r.tag, r.time_ns, r.v, r.f) for r in back.collect()) == [("a", 1, 0.5, True), ("b", 2, None, False)]
    picked = results.flatten_responses(results.group_of_response(parsed, {"tag": "b"}))
    assert [r.time_ns for r in picked.collect()] == [2]


def test_reading_undeclared_responses(spark, folder):
    docs = [one(table(values=[(5, 1)], tags={"site": "e"})), one(table(values=[(6, 1.5)], tags={"site": "n"}))]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(folder + "/in")
    rows = read_responses(spark, folder + "/in").orderBy("time_ns").collect()
    assert [(r.site, r.time_ns, r.load) for r in rows] == [("e", 5, 1.0), ("n", 6, 1.5)]
    spark.createDataFrame([('{"results":[{"error":"broken"}]}',)], "value string").write.text(folder + "/bad")
    with pytest.raises(Exception, match="broken"):
        read_responses(spark, folder + "/bad").collect()
