import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pointlake.functions.predicate import Expression, parse_where, time_bounds
from pointlake.model import POINT_SCHEMA, FieldType, MeasurementSchema, NanoTime
from pointlake.sources.tables import to_point_form

ROWS = [
    (1, "a", "a", 1.0, 10, True, 1_000),
    (2, "b", "x", 2.0, 20, False, 2_000),
    (3, "ab", "ab", 0.0, 30, True, 3_500),
    (4, None, "y", None, None, None, 4_000),
]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        ROWS, "id int, t string, u string, f double, i bigint, b boolean, time_ns bigint"
    )


def ids(df, build):
    return sorted(r.id for r in df.filter(parse_where(build, df)).collect())


@pytest.mark.parametrize(
    "build, expected",
    [
        (lambda e: e.tag("t").equals.value("a"), [1]),
        (lambda e: e.tag("t").not_equal.value("a"), [2, 3]),
        (lambda e: e.field("i").gt.value(10), [2, 3]),
        (lambda e: e.field("i").gte.value(20), [2, 3]),
        (lambda e: e.field("i").lt.value(20), [1]),
        (lambda e: e.field("i").lte.value(20), [1, 2]),
        (lambda e: e.field("i").plus.value(5).equals.value(15), [1]),
        (lambda e: e.field("i").minus.value(5).equals.value(15), [2]),
        (lambda e: e.field("i").times.value(2).equals.value(60), [3]),
        (lambda e: e.field("i").div.field("f").equals.value(10), [1, 2]),
        (lambda e: e.field("b").equals.value(True), [1, 3]),
        (lambda e: e.tag("t").matches.value(re.compile("^a")), [1, 3]),
        (lambda e: e.tag("t").doesnt_match.value(re.compile("^a")), [2]),
        (lambda e: e.tag("t").equals.tag("u"), [1, 3]),
        (lambda e: e.field("time_ns").gt.value(NanoTime(2_000)), [3, 4]),
        (lambda e: e.field("time_ns").equals.value(NanoTime(3_500)), [3]),
        # AND binds tighter than OR, * tighter than +, arithmetic tighter than comparison.
        (
            lambda e: e.tag("t").equals.value("b").or_.tag("t").equals.value("a")
            .and_.field("i").gt.value(99),
            [2],
        ),
        (
            lambda e: e.exp(lambda d: d.tag("t").equals.value("b").or_.tag("t").equals.value("a"))
            .and_.field("i").gt.value(99),
            [],
        ),
        (lambda e: e.value(1).plus.field("f").times.value(2).equals.value(5), [2]),
    ],
)
def test_operators(df, build, expected):
    assert ids(df, build) == expected


def test_values_are_never_text_of_the_query(df):
    assert ids(df, lambda e: e.tag("t").equals.value("a' OR '1'='1")) == []
    assert ids(df, lambda e: e.tag("t").equals.value("GAZP()\\' or 1=1 --")) == []


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, "x")], ["id", 'my `"tag.x'])
    assert ids(df, lambda e: e.tag('my `"tag.x').equals.value("x")) == [1]


class Slashed:
    def __str__(self):
        return "/^a/"


def test_values_by_their_text(df):
    assert ids(df, lambda e: e.tag("t").matches.value(Slashed())) == [1, 3]


def test_bad_values():
    with pytest.raises(ValueError):
        Expression().field("f").equals.value(None)
    with pytest.raises(ValueError):
        Expression().field("f").matches.value(re.compile("a", re.IGNORECASE))
    with pytest.raises(ValueError):
        Expression().field("f").matches.value(re.compile("(?i)a"))


def test_incomplete_chain(df):
    with pytest.raises(ValueError):
        Expression().field("f").equals.to_column(df)


@pytest.mark.parametrize(
    "symbol, ns, expected",
    [
        ("gt", 1_500, [2, 3]),
        ("gt", 2_000, [3]),
        ("gte", 1_500, [2, 3]),
        ("gte", 2_000, [2, 3]),
        ("lt", 2_500, [1, 2]),
        ("lt", 2_000, [1]),
        ("lte", 2_500, [1, 2]),
        ("lte", 2_000, [1, 2]),
        ("equals", 2_500, []),
        ("equals", 2_000, [2]),
        ("not_equal", 2_500, [1, 2, 3]),
        ("not_equal", 2_000, [1, 3]),
    ],
)
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_nanoseconds_against_timestamps(spark, symbol, ns, expected, kind):
    df = spark.sql(
        f"SELECT id, CAST(timestamp_micros(id) AS {kind}) ts FROM VALUES (1), (2), (3) AS v(id)"
    )
    chain = getattr(Expression().field("ts"), symbol)
    assert ids(df, chain.value(NanoTime(ns))) == expected


def test_time_on_the_left(spark):
    df = spark.sql("SELECT id, timestamp_micros(id) ts FROM VALUES (1), (2), (3) AS v(id)")
    assert ids(df, lambda e: e.value(NanoTime(2_000)).lt.field("ts")) == [3]


def test_other_forms(df):
    assert ids(df, "i > 10 AND b") == [3]
    assert ids(df, F.col("i") > 10) == [2, 3]
    assert ids(df, Expression().field("i").gt.value(10)) == [2, 3]


def test_map_form(spark, df):
    schema = MeasurementSchema(
        "m", {"f": FieldType.FLOAT, "b": FieldType.BOOLEAN, "i": FieldType.INTEGER}, ("t",)
    )
    points = to_point_form(df, schema, keep=["id"])
    assert ids(points, lambda e: e.tag("t").equals.value("a")) == [1]
    assert ids(points, lambda e: e.field("f").gte.value(1).and_.field("i").lt.value(20)) == [1]
    assert ids(points, lambda e: e.field("b").equals.value(False)) == [2]


def test_datetimes(spark):
    df = spark.sql("SELECT 1 id, TIMESTAMP_NTZ'2024-01-01 00:00:00' ts")
    assert ids(df, lambda e: e.field("ts").equals.value(datetime(2024, 1, 1))) == [1]


def test_numeric_tag_columns_bear_any_text(spark):
    df = spark.createDataFrame([(8, 1), (-3, 2), (None, 3)], "t bigint, id int")
    for text, ids in (("8", [1]), ("-3", [2]), ("08", []), ("eight", []), ("9" * 30, []), ("", [])):
        found = df.filter(Expression().tag("t").equals.value(text).to_column(df))
        assert [r.id for r in found.collect()] == ids
    assert df.filter(Expression().tag("t").not_equal.value("eight").to_column(df)).count() == 2


def test_map_integers_are_compared_exactly(spark):
    value = lambda **v: {"f": None, "i": None, "s": None, "b": None, **v}
    rows = [
        ("m", {"a": value(i=2**53 + 1), "b": value(i=2**53)}, 1), ("m", {"a": value(i=2**53), "b": value(f=2.0**53)}, 2),
        ("m", {"a": value(s="x"), "b": value(s="x")}, 3), ("m", {"a": value(f=0.5), "b": value(s="0.5")}, 4),
    ]
    points = [("db", None, m, {}, f, t) for m, f, t in rows]
    df = spark.createDataFrame(points, POINT_SCHEMA)

    def found(build):
        return sorted(r.time_ns for r in df.filter(build(Expression()).to_column(df)).collect())

    assert found(lambda e: e.field("a").equals.value(2**53 + 1)) == [1]
    assert found(lambda e: e.field("a").gte.value(2**53)) == [1, 2]
    assert found(lambda e: e.field("a").equals.field("b")) == [2, 3]
    assert found(lambda e: e.field("a").lt.value(0.75)) == [4]
    assert found(lambda e: e.field("a").equals.value("x")) == [3]


def test_time_bounds():
    bounds = lambda build: time_bounds(build)
    assert bounds(lambda e: e.field("time_ns").gt.value(5).and_.field("time_ns").lte.value(9)) == (6, 10)
    assert bounds(lambda e: e.value(7).gte.field("time_ns").and_.tag("x").equals.value("y")) == (None, 8)
    assert bounds(lambda e: e.field("time_ns").equals.value(4)) == (4, 5)
    assert bounds(lambda e: e.field("time_ns").gt.value(5).or_.tag("x").equals.value("y")) == (None, None)
    assert bounds(lambda e: e.field("time_ns").plus.value(1).gt.value(5)) == (None, None)
    assert bounds("time_ns > 5") == (None, None)
