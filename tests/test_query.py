from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pointlake.model import FieldType, MeasurementSchema, NanoTime, RetentionPolicy, policy_table
from pointlake.operators import catalog, lifecycle, query
from pointlake.operators.shards import shard_id_of, shard_start_of
from pointlake.sources.line_protocol import parse_lines
from pointlake.sources.tables import points_from_table, points_of, to_point_form
from samples import FAN, PROBES, RAIN, READINGS, START_NS, STEP_NS, rain_points, readings, sample_lines


@pytest.fixture(scope="module")
def sample(spark):
    df = spark.createDataFrame([(x,) for x in sample_lines()], "value string")
    points, _ = parse_lines(df, database="db")
    return points.cache()


@pytest.fixture(scope="module")
def fan(sample):
    return points_of(sample, FAN)


def loads(site=None):
    return [(load, t) for _, s, load, t in readings("fan") if site in (None, s)]


# -- selection and aggregates ----------------------------------------------------------


def test_newest_first(fan):
    tagged = query.where(fan, lambda e: e.tag("site").equals.value("east"))
    rows = query.latest(tagged, 3).collect()
    assert [(r.load, r.time_ns) for r in rows] == loads("east")[::-1][:3]


@pytest.mark.parametrize("n", [1, 3])
def test_top(fan, n):
    rows = query.top(fan, "load", n, ["site"]).collect()
    for site in READINGS["fan"]:
        want = sorted(loads(site), key=lambda r: (-r[0], r[1]))[:n]
        assert sorted(((r.top, r.time_ns) for r in rows if r.site == site), key=lambda r: (-r[0], r[1])) == want


def test_top_without_tags(fan):
    rows = query.top(fan, "load", 2).collect()
    assert [r.top for r in rows] == sorted((load for load, _ in loads()), reverse=True)[:2]


def test_ties_go_to_the_earliest(spark):
    df = spark.createDataFrame(
        [("a", 5.0, 2, "x"), ("a", 5.0, 1, "z"), ("a", 5.0, 1, "y"), ("a", None, 0, "w")],
        "t string, v double, time_ns bigint, k string",
    )
    row = query.top(df, "v", 1, ["t"], ties=["k"]).collect()
    assert [(r.time_ns, r.top) for r in row] == [(1, 5.0)]


def test_mean(fan):
    want = {site: sum(v for v, _ in loads(site)) / n for site, n in READINGS["fan"].items()}
    for scale in (None, 2):
        rows = query.mean(fan, "load", ["site"], scale=scale).collect()
        assert {r.site: round(r["mean"], 9) for r in rows} == {s: round(v, 9) for s, v in want.items()}


def test_mean_by_time(fan):
    rows = query.mean(fan, "load", every="1ms", counted=True).collect()
    want: dict[int, list[float]] = {}
    for load, t in loads():
        want.setdefault(t - t % 10**6, []).append(load)
    assert len(want) == 3
    assert {r.time_ns: (round(r["mean"], 9), r.n) for r in rows} == {
        t: (round(sum(v) / len(v), 9), len(v)) for t, v in want.items()
    }


@pytest.mark.parametrize("values", [[0.001], [1e17, 3e17], [0.125, 0.25, 1e-9]])
def test_means_keep_small_and_large_values(spark, values):
    df = spark.createDataFrame([("a", v) for v in values], "t string, v double")
    assert query.mean(df, "v", ["t"]).first()["mean"] == pytest.approx(sum(values) / len(values), rel=1e-12)


def test_buckets_before_the_epoch(spark):
    df = spark.createDataFrame([(-1, 1.0), (0, 3.0), (-1000, 5.0)], "time_ns bigint, v double")
    rows = query.mean(df, "v", every="1u").collect()
    assert {r.time_ns: r["mean"] for r in rows} == {-1000: 3.0, 0: 3.0}


def test_mean_ignores_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0), ("b", None)], "t string, v double")
    rows = query.mean(df, "v", ["t"], scale=2).collect()
    assert {r.t: r["mean"] for r in rows} == {"a": 2.0, "b": None}


def test_since(spark, fan):
    now = NanoTime(START_NS + 10 * STEP_NS)
    assert query.since(fan, "250u", now).count() == 1
    assert query.since(fan, "1ms", now).count() == sum(t > now - 10**6 for _, t in loads())
    assert query.since(fan, "10s", NanoTime(START_NS + 20 * 10**9)).count() == 0
    stamps = spark.sql("SELECT current_timestamp() - INTERVAL 5 SECOND ts")
    assert query.since(stamps, "10s", time="ts").count() == 1
    assert query.since(stamps, "1s", time="ts").count() == 0


def test_bound_parameters(spark, fan):
    text = "SELECT * FROM {t} WHERE site = :site AND load >= :least"
    least = sorted(load for load, _ in loads("north"))[5]
    got = query.bound_query(spark, text, {"site": "north", "least": least}, t=fan)
    assert got.count() == sum(load >= least for load, _ in loads("north"))
    sly = query.bound_query(spark, text, {"site": "x' OR 'y' < 'z", "least": 0}, t=fan)
    assert sly.count() == 0


def test_missing_measurement(spark):
    empty = query.empty_measurement(spark, FAN)
    assert empty.count() == 0 and empty.columns == ["time_ns", "site", "load"]


def test_order_of_groups(fan):
    rows = query.order_groups(fan, ["site"]).collect()
    assert [(r.site, -r.time_ns) for r in rows] == sorted((r.site, -r.time_ns) for r in rows)


def test_select(fan):
    assert query.select_all(fan).columns[0] == "time_ns"
    assert query.select_columns(fan, "load").columns == ["load"]


# -- listings ---------------------------------------------------------------------------


def test_listings(sample):
    assert [r.name for r in catalog.show_measurements(sample).collect()] == sorted(READINGS)
    assert [r.name for r in catalog.show_databases(sample).collect()] == ["db"]
    keys = sorted(f"{machine},site={site}" for machine, sites in READINGS.items() for site in sites)
    assert [r.key for r in catalog.show_series(sample).collect()] == keys
    one = [r.key for r in catalog.show_series(sample, "db", "mill").collect()]
    assert one == [k for k in keys if k.startswith("mill")]
    assert catalog.show_series(sample, "elsewhere").count() == 0


def test_series_of_points(spark):
    rows = spark.createDataFrame([(p["measurement"], p["tags"]) for p in rain_points()],
                                 "measurement string, tags map<string,string>")
    keys = ["probes,basin=upper,depth\\ class=deep", "probes,basin=upper,depth\\ class=flat",
            "rain,basin=lower", "rain,basin=upper"]
    assert [r.key for r in catalog.show_series(rows).collect()] == keys
    kept = lifecycle.drop_series(rows, "probes", lambda e: e.tag("depth class").equals.value("deep"))
    assert [r.key for r in catalog.show_series(kept).collect()] == keys[1:]
    assert RAIN.field_names == ["depth", "kind of day"] and PROBES.tag_names == ["basin", "depth class"]


def test_series_key_escapes(spark):
    df = spark.createDataFrame([("a b", "x=1,y")], "t string, `u v` string")
    assert catalog.table_series(df, "my meas", ["t", "u v"]).first().key == (
        "my\\ meas,t=a\\ b,u\\ v=x\\=1\\,y"
    )


POLICIES = [
    RetentionPolicy("db", "autogen", is_default=True),
    RetentionPolicy("db", "7d", duration_s=604800, shard_s=86400),
    RetentionPolicy("db", "hourly", duration_s=3600, shard_s=5400),
]


def test_policies(spark):
    rows = catalog.show_retention_policies(policy_table(spark, POLICIES), "db").collect()
    assert [tuple(r) for r in rows] == [
        ("autogen", "0s", "168h0m0s", 1, True),
        ("7d", "168h0m0s", "24h0m0s", 1, False),
        ("hourly", "1h0m0s", "1h30m0s", 1, False),
    ]
    assert catalog.show_retention_policies(policy_table(spark, POLICIES), "x").count() == 0


def placed(spark, rows):
    return spark.createDataFrame(
        [(db, rp, int(NanoTime.from_datetime(datetime.fromisoformat(t)))) for db, rp, t in rows],
        "db string, rp string, time_ns bigint",
    )


def test_shards(spark):
    points = placed(
        spark,
        [
            ("db", "autogen", "2019-05-06T00:00:00"),
            ("db", "autogen", "2019-05-12T23:59:59"),
            ("db", "autogen", "2019-05-13T00:00:00"),
            ("db", "7d", "2019-06-13T05:00:00"),
            ("other", "autogen", "2019-05-06T00:00:00"),
        ],
    )
    rows = catalog.show_shards(points, POLICIES, "db").orderBy("start_time").collect()
    day = datetime.fromisoformat
    assert [(r.retention_policy, r.start_time, r.end_time, r.expiry_time, r.n) for r in rows] == [
        ("autogen", day("2019-05-06"), day("2019-05-13"), day("2019-05-13"), 2),
        ("autogen", day("2019-05-13"), day("2019-05-20"), day("2019-05-20"), 1),
        ("7d", day("2019-06-13"), day("2019-06-14"), day("2019-06-21"), 1),
    ]
    assert all(r.database == "db" and r.owners is None and r.shard_group == r.id for r in rows)
    first = rows[0].id
    start = shard_start_of(NanoTime.from_datetime(day("2019-05-08")), 604800)
    assert first == shard_id_of("db", "autogen", start)
    kept = lifecycle.drop_shard(points, POLICIES, first)
    left = catalog.show_shards(kept, POLICIES, "db")
    assert first not in [r.id for r in left.collect()]
    assert {r.id for r in left.collect()} == {r.id for r in rows[1:]}
    assert kept.count() == 3


# -- lifecycle --------------------------------------------------------------------------


def test_unknown_conditions_keep_rows(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "t string, id int")
    kept = lifecycle.drop_series(df, where=lambda e: e.tag("t").equals.value("a"))
    assert [r.id for r in kept.collect()] == [2]
    with pytest.raises(ValueError):
        lifecycle.drop_series(df)


def test_drops(sample):
    everything, fans = len(readings()), len(readings("fan"))
    assert lifecycle.drop_measurement(sample, "fan").count() == everything - fans
    assert lifecycle.drop_measurement(sample, "fan", "elsewhere").count() == everything
    assert lifecycle.drop_database(sample, "db").count() == 0
    assert lifecycle.drop_retention_policy(sample, "db", "7d").count() == everything
    by_tag = lifecycle.drop_series(sample, where=lambda e: e.tag("site").equals.value("east"))
    assert by_tag.count() == sum(site != "east" for _, site, _, _ in readings())


def test_retention(spark):
    points = placed(
        spark,
        [
            ("db", "7d", "2024-01-01T00:00:00"),
            ("db", "7d", "2024-01-08T00:00:00"),
            ("db", "7d", "2024-01-07T23:59:59"),
            ("db", "autogen", "1999-01-01T00:00:00"),
            ("db", "unknown", "1999-01-01T00:00:00"),
            ("db", None, "1999-01-01T00:00:00"),
        ],
    )
    kept = lifecycle.apply_retention(points, POLICIES, datetime(2024, 1, 15))
    assert kept.columns == points.columns
    assert sorted((r.rp or "") for r in kept.collect()) == ["", "7d", "autogen", "unknown"]
    table = lifecycle.apply_retention(points, policy_table(spark, POLICIES), datetime(2024, 1, 15))
    assert table.count() == 4


def test_default_policy(spark):
    points = placed(
        spark,
        [("db", None, "2024-01-01T00:00:00"), ("db", "7d", "2024-01-01T00:00:00"),
         ("none", None, "2024-01-01T00:00:00")],
    )
    for policies in (POLICIES, policy_table(spark, POLICIES)):
        routed = lifecycle.route_default_policy(points, policies)
        assert sorted((r.db, r.rp or "") for r in routed.collect()) == [
            ("db", "7d"), ("db", "autogen"), ("none", ""),
        ]
    with pytest.raises(ValueError):
        lifecycle.route_default_policy(
            points, [*POLICIES, RetentionPolicy("db", "second", is_default=True)]
        )


UPSERT = "t string, time_ns bigint, v double, s string"


def test_upsert(spark):
    existing = spark.createDataFrame(
        [("a", 1, 1.0, "x"), ("a", 2, 2.0, "y"), (None, 1, 3.0, None)], UPSERT
    )
    incoming = spark.createDataFrame(
        [("a", 1, 9.0, None), ("b", 1, 4.0, "n"), (None, 1, None, "z")], UPSERT
    )
    rows = lifecycle.upsert_points(existing, incoming, ["t"], ["v", "s"]).collect()
    assert sorted(((r.t or "", r.time_ns, r.v, r.s) for r in rows)) == [
        ("", 1, 3.0, "z"), ("a", 1, 9.0, "x"), ("a", 2, 2.0, "y"), ("b", 1, 4.0, "n"),
    ]
    again = lifecycle.upsert_points(
        lifecycle.upsert_points(existing, incoming, ["t"], ["v", "s"]), incoming, ["t"], ["v", "s"]
    )
    assert again.count() == 4


def test_upsert_in_order_of_writes(spark):
    existing = spark.createDataFrame([("a", 1, 1.0, "x")], UPSERT)
    incoming = spark.createDataFrame(
        [("a", 1, 5.0, None, 2), ("a", 1, 7.0, "late", 1), ("a", 1, 6.0, None, 2)],
        UPSERT + ", seq bigint",
    )
    row = lifecycle.upsert_points(existing, incoming, ["t"], ["v", "s"], "seq").collect()
    assert [(r.v, r.s) for r in row] == [(6.0, "late")]


def test_points_from_table(spark):
    df = spark.sql("SELECT 1 id, 2L user, 3.5D v, 7 n, true b, TIMESTAMP_NTZ'2024-01-01' ts")
    got = points_from_table(df, "m", {"who": "user"}, ["v", "n", "b"], "ts", keep=["id"])
    row = got.first()
    assert (row.measurement, row.who, row.v, row.n, row.b) == ("m", "2", 3.5, 7, True)
    assert row.time_ns == 1704067200 * 10**9
    schema = MeasurementSchema("m", {"v": FieldType.INTEGER, "n": FieldType.FLOAT}, ("user",))
    typed = points_from_table(df, "m", ["user"], ["v", "n"], "ts", schema=schema).first()
    assert (typed.v, typed.n) == (3, 7.0)
    seconds = spark.sql("SELECT 'a' t, 1D v, 5 at")
    assert points_from_table(seconds, "m", ["t"], ["v"], "at", "s").first().time_ns == 5 * 10**9
    text = spark.sql("SELECT 'a' t, 1D v, '2031-02-03T04:05:06Z' at")
    assert points_from_table(text, "m", ["t"], ["v"], "at").first().time_ns == 1927857906 * 10**9


def test_point_forms(spark, fan):
    mapped = to_point_form(fan, FAN, db="db", rp="r")
    assert mapped.columns == ["db", "rp", "measurement", "tags", "fields", "time_ns"]
    back = points_of(mapped, FAN)
    assert back.exceptAll(fan.select(back.columns)).count() == 0
    assert back.count() == len(readings("fan"))
    assert mapped.filter(F.col("tags")["site"] == "south").count() == READINGS["fan"]["south"]
