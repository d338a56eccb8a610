from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from pointlake.functions import timecol
from pointlake.model import NanoTime, Precision

NS = 1475985480231035677


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "stamp, expected",
    [
        ("2016-10-09T03:58:00.231035677Z", NS),
        ("2015-08-18T00:00:00Z", 1439856000000000000),
        ("2016-09-25T16:12:51.787Z", 1474819971787000000),
        ("2009-10-04T08:55:41.002Z", 1254646541002000000),
        ("1969-12-31T23:59:59.5Z", -500000000),
        ("wut", None),
    ],
)
def test_from_iso(spark, stamp, expected):
    assert one(spark, timecol.from_iso(F.lit(stamp))) == expected


@pytest.mark.parametrize(
    "value, unit, expected",
    [
        (NS, "n", NS),
        (1475985480231035, "u", 1475985480231035000),
        (1475985480231, "ms", 1475985480231000000),
        (1475985480, "s", 1475985480000000000),
        (24599758, "m", 1475985480000000000),
        (409995, "h", 1475982000000000000),
    ],
)
def test_from_epoch(spark, value, unit, expected):
    assert one(spark, timecol.from_epoch(F.lit(value), unit)) == expected


@pytest.mark.parametrize(
    "ns, expected",
    [
        (
            1475121809084000000,
            ["1475121809084000000", "1475121809084000", "1475121809084", "1475121809",
             "24585363", "409756"],
        ),
        (
            1475985480231035600,
            ["1475985480231035600", "1475985480231035", "1475985480231", "1475985480",
             "24599758", "409995"],
        ),
    ],
)
def test_to_precision(spark, ns, expected):
    got = [
        one(spark, timecol.to_precision(F.lit(ns), u).cast("string"))
        for u in ("n", "u", "ms", "s", "m", "h")
    ]
    assert got == expected


def test_floor_division_is_exact(spark):
    big = 1475985480231999999
    assert one(spark, timecol.floor_div(F.lit(big), 1000)) == big // 1000
    assert one(spark, timecol.floor_div(F.lit(-1), 1000)) == -1
    assert one(spark, timecol.floor_div(F.lit(-1001), 1000)) == -2


def test_texts(spark):
    assert one(spark, timecol.nano_iso(F.lit(NS))) == "2016-10-09T03:58:00.231035677Z"
    assert one(spark, timecol.time_literal(F.lit(NS))) == "2016-10-09 03:58:00.231035677"
    assert one(spark, timecol.time_literal(F.lit(NS), 3)) == "2016-10-09 03:58:00.231"
    assert one(spark, timecol.nano_iso(F.lit(-1))) == "1969-12-31T23:59:59.999999999Z"


def test_digit_strings(spark):
    df = spark.createDataFrame([("1475985480231035600",)], "v string")
    row = timecol.from_nano_string(df, "v").selectExpr("time_ns", "unix_millis(time) ms").first()
    assert (row.time_ns, row.ms) == (1475985480231035600, 1475985480231)


def test_unknown_unit():
    with pytest.raises(ValueError):
        timecol.unit_ns("d")


@pytest.mark.parametrize(
    "text, seconds",
    [("10s", 10), ("7d", 604800), ("1w", 604800), ("36h", 129600), ("1h30m", 5400),
     ("168h0m0s", 604800), ("0s", 0), ("INF", 0), ("4m", 240)],
)
def test_durations(text, seconds):
    assert timecol.duration_ns(text) == seconds * 10**9


@pytest.mark.parametrize("text", ["", "7", "d", "7x", "1.5h"])
def test_bad_durations(text):
    with pytest.raises(ValueError):
        timecol.duration_ns(text)


@pytest.mark.parametrize(
    "seconds, text", [(604800, "168h0m0s"), (86400, "24h0m0s"), (0, "0s"), (90, "1m30s"), (5, "5s")]
)
def test_duration_text(spark, seconds, text):
    assert one(spark, timecol.duration_text(F.lit(seconds).cast("bigint"))) == text


def test_wall_times_do_not_depend_on_the_session_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00.123456' t")
    want = NanoTime.from_datetime(datetime(2024, 3, 10, 2, 30, 0, 123456))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            got = df.select(timecol.time_ns_of(df, "t").alias("ns"))
            assert got.first().ns == want
            back = got.select(timecol.to_timestamp_ntz(F.col("ns")).alias("t")).first().t
            assert back == datetime(2024, 3, 10, 2, 30, 0, 123456)
            assert one(spark, timecol.from_iso(F.lit("2024-03-10T02:30:00.123456Z"))) == want
            assert one(spark, timecol.nano_iso(F.lit(int(want)))).startswith("2024-03-10T02:30:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nano_time():
    assert NanoTime.from_string("1475985480231035600") == 1475985480231035600
    assert NanoTime.from_datetime(datetime(1970, 1, 1, 0, 0, 1, tzinfo=UTC)) == 10**9


def test_precision_names(spark):
    assert [timecol.unit_ns(p) for p in Precision] == [timecol.UNIT_NS[p.value] for p in Precision]
    assert one(spark, timecol.to_precision(F.lit(NS), Precision.SECONDS)) == 1475985480


def test_result_epoch(spark):
    df = spark.createDataFrame([(NS,)], "time_ns bigint")
    assert timecol.with_epoch(df, "ms").first().time == 1475985480231
    for none in (None, "n"):
        assert timecol.with_epoch(df, none).first().time == "2016-10-09T03:58:00.231035677Z"
