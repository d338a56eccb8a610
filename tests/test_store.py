from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pointlake.model import POINT_SCHEMA, FieldType, MeasurementSchema, NanoTime, RetentionPolicy
from pointlake.operators.shards import shard_id_of, shard_start_of
from pointlake.sinks.store import (
    MeasurementRef,
    Store,
    overlapping,
    path_part,
    read_measurement,
    write_points,
)
from pointlake.sources.tables import to_point_form

PERF = MeasurementSchema(
    "perf", {"cpu": FieldType.FLOAT, "note": FieldType.STRING}, ("host",), database="db"
)
POLICIES = (
    RetentionPolicy("db", "autogen", is_default=True),
    RetentionPolicy("db", "7d", duration_s=604800, shard_s=86400),
)
COLUMNS = "time_ns bigint, host string, cpu double, note string"


def at(text):
    return int(NanoTime.from_datetime(datetime.fromisoformat(text)))


ROWS = [
    (at("2024-01-01T00:00:00"), "a", 1.0, "x"),
    (at("2024-01-03T00:00:00"), "b", 2.0, None),
    (at("2024-01-08T00:00:00"), "a", 3.0, "y"),
    (at("2024-01-16T12:00:00"), None, 4.0, "z"),
]


@pytest.fixture
def store(spark, folder):
    return Store(spark, folder + "/store", POLICIES, database="db")


@pytest.fixture
def filled(spark, store):
    store.append(spark.createDataFrame(ROWS, COLUMNS), PERF)
    return store


def rows_of(df):
    return sorted((r.time_ns, r.host, r.cpu, r.note) for r in df.collect())


def test_roundtrip(filled):
    assert rows_of(filled.read("perf", PERF)) == ROWS
    mondays = [at(t) // 10**9 for t in ("2024-01-01", "2024-01-08", "2024-01-15")]
    assert filled.shard_starts("perf") == mondays


def test_names(spark, store):
    assert store.resolve("perf") == MeasurementRef("perf", "autogen", "db")
    assert store.resolve(MeasurementRef("perf", "7d")).policy == "7d"
    with pytest.raises(ValueError):
        MeasurementRef("")
    with pytest.raises(ValueError):
        Store(spark, "x").resolve("perf")
    assert path_part('a/b=c%"d e') == "a%2Fb%3Dc%25%22d e"


def test_odd_names(spark, store):
    odd = MeasurementRef('my /meas="x"*', 'po"licy', "d b")
    df = spark.createDataFrame(ROWS, COLUMNS)
    store.append(df, PERF, odd)
    assert rows_of(store.read(odd, PERF)) == ROWS
    assert store.targets() == [odd]


def test_missing_measurement(store):
    assert store.read("nothing", PERF).count() == 0
    assert store.read("nothing", PERF).columns == PERF.struct_type.names


def test_time_range_prunes(filled):
    start, end = NanoTime(at("2024-01-02")), NanoTime(at("2024-01-08"))
    got = read_measurement(filled, "perf", PERF, start=start, end=end)
    assert rows_of(got) == [ROWS[1]]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan
    assert "GreaterThanOrEqual(time_ns" in plan


def test_tag_filter_reaches_the_scan(filled):
    got = filled.read("perf", PERF).filter(F.col("host") == "a").select("cpu")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(host,a)" in plan
    assert "ReadSchema: struct<host:string,cpu:double>" in plan


def test_missing_times_get_one_write_time(spark, store):
    df = spark.createDataFrame([(None, "a", 1.0, None), (None, "b", 2.0, None)], COLUMNS)
    write_points(df, store, PERF, write_time=datetime(2024, 1, 1))
    assert {r.time_ns for r in store.read("perf", PERF).collect()} == {at("2024-01-01")}


def test_precision(spark, store):
    df = spark.createDataFrame([(1704067200, "a", 1.0, None)], COLUMNS)
    write_points(df, store, PERF, precision="s", retention_policy="7d")
    got = read_measurement(store, "perf", PERF, rp="7d")
    assert got.first().time_ns == at("2024-01-01")


def test_points_of_several_measurements(spark, store):
    other = MeasurementSchema("disk", {"free": FieldType.INTEGER}, ("host",), database="db")
    perf = to_point_form(spark.createDataFrame(ROWS, COLUMNS), PERF, db="db")
    disk = to_point_form(
        spark.createDataFrame([(5, "a", 7)], "time_ns bigint, host string, free bigint"), other
    )
    store.append_points(perf.unionByName(disk), [PERF, other])
    assert rows_of(store.read("perf", PERF)) == ROWS
    assert [tuple(r) for r in store.read("disk", other).select("host", "free").collect()] == [
        ("a", 7)
    ]


CPU_TEXT = MeasurementSchema("perf", {"cpu": FieldType.STRING}, ("host",))


def cpu_points(spark, rows, **more):
    return to_point_form(spark.createDataFrame(rows, "time_ns bigint, host string, cpu string"), CPU_TEXT, **more)


def test_points_that_cannot_be_stored(spark, store, folder):
    good, bad = (1, "a", "1.5"), (2, "b", "high")
    disk = cpu_points(spark, [good], measurement=F.lit("disk"))
    points = disk.unionByName(cpu_points(spark, [good, bad]))
    with pytest.raises(Exception, match="high"):
        store.append_points(points, [PERF])
    # Nothing of the batch has been written.
    assert store.targets() == []
    store.append_points(points, [PERF], reject_path=folder + "/rejects")
    assert rows_of(store.read("perf", PERF)) == [(1, "a", 1.5, None)]
    assert [tuple(r) for r in store.read("disk").select("host", "cpu").collect()] == [("a", "1.5")]
    reasons = [r.reason for r in spark.read.parquet(folder + "/rejects").collect()]
    assert reasons == ["Expected numeric value for db.perf.cpu, but got 'high'"]


def test_points_are_updated_and_go_to_their_policy(spark, store):
    for value in ("1.5", "2.5"):
        store.write_points(cpu_points(spark, [(1, "a", value)], rp="7d"), [PERF])
        store.write_points(cpu_points(spark, [(1, "a", value), (3, "b", "4")]), [PERF])
    assert rows_of(store.read(MeasurementRef("perf", "7d"), PERF)) == [(1, "a", 2.5, None)]
    assert rows_of(store.read("perf", PERF)) == [(1, "a", 2.5, None), (3, "b", 4.0, None)]
    assert store.databases() == ["db"] and store.measurements() == ["perf"]


def test_undeclared_points_take_their_own_types(spark, store):
    kinds = [
        ("db", None, "m", {"t": "x"}, {"n": {"i": 4}, "x": {"f": 0.5}, "s": {"s": "q"}, "b": {"b": True}}, 1),
        ("db", None, "m", {"u": "y"}, {"n": {"f": 2.5}, "s": {"i": 7}}, 2),
    ]
    whole = lambda v: {"f": None, "i": None, "s": None, "b": None, **v}
    rows = [(d, r, m, t, {k: whole(v) for k, v in f.items()}, n) for d, r, m, t, f, n in kinds]
    store.write_points(spark.createDataFrame(rows, POINT_SCHEMA))
    got = store.read("m").orderBy("time_ns").select("t", "u", "n", "x", "s", "b").collect()
    assert [tuple(r) for r in got] == [("x", None, 4.0, 0.5, "q", True), (None, "y", 2.5, None, "7", None)]


@pytest.mark.parametrize(
    "kind, value, message",
    [("string", "high", "Expected float"), ("boolean", True, "Expected float"), ("double", float("nan"), "Expected float")],
)
def test_wide_values_are_checked(spark, store, kind, value, message):
    df = spark.createDataFrame([(1, "a", value)], f"time_ns bigint, host string, cpu {kind}")
    with pytest.raises(Exception, match=message):
        store.append(df, PERF)


def test_wide_columns_are_checked_and_integers_floored(spark, store):
    schema = MeasurementSchema("m", {"n": FieldType.INTEGER}, ())
    store.append(spark.createDataFrame([(1, -1.5)], "time_ns bigint, n double"), schema)
    assert store.read("m").first().n == -2
    with pytest.raises(ValueError, match="extra"):
        store.append(spark.createDataFrame([(1, 2, 3)], "time_ns bigint, n bigint, extra bigint"), schema)


def test_upsert_without_time_keeps_what_is_stored(spark, filled):
    moment = datetime(2024, 1, 9)
    change = [(None, "a", 7.0, None), (ROWS[2][0], "a", 8.0, None), (None, "q", 9.0, "w")]
    for _ in range(2):
        filled.upsert(spark.createDataFrame(change, COLUMNS), PERF, write_time=moment)
    now = at("2024-01-09T00:00:00")
    want = [ROWS[0], ROWS[1], (ROWS[2][0], "a", 8.0, "y"), (now, "a", 7.0, None), (now, "q", 9.0, "w"), ROWS[3]]
    assert rows_of(filled.read("perf", PERF)) == sorted(want)


def test_buckets_outlive_their_policy(spark, store, folder):
    weekly = store
    weekly.append(spark.createDataFrame(ROWS, COLUMNS), PERF)
    daily = Store(spark, store.root, [RetentionPolicy("db", "autogen", shard_s=86_400, is_default=True)], "db")
    daily.append(spark.createDataFrame([(ROWS[0][0] + 5, "d", 6.0, None)], COLUMNS), PERF)
    start, end = NanoTime(at("2024-01-03T00:00:00")), NanoTime(at("2024-01-08T00:00:00"))
    assert rows_of(daily.read("perf", PERF, start=start, end=end)) == [ROWS[1]]
    daily.upsert(spark.createDataFrame([(ROWS[1][0], "b", 5.0, "new")], COLUMNS), PERF)
    want = [ROWS[0], (ROWS[0][0] + 5, "d", 6.0, None), (ROWS[1][0], "b", 5.0, "new"), *ROWS[2:]]
    assert rows_of(daily.read("perf", PERF)) == want == rows_of(weekly.read("perf", PERF))
    # The week that was touched is stored in days now, the others as they were.
    assert sorted(length for length, _ in daily.buckets("perf")) == [86_400] * 2 + [604_800] * 2


@pytest.mark.parametrize(
    "wanted, stored, found",
    [
        ([(10, 20)], [(10, 0), (10, 10), (10, 20), (10, 30)], [(10, 20)]),
        ([(10, 20)], [(70, 0), (10, 60), (10, 70)], [(10, 60), (70, 0)]),
        ([(10, 20)], [(5, 25), (5, 30), (40, -20)], [(5, 25)]),
        ([(10, 20), (10, 90)], [(100, 0), (300, 0), (10, 300)], [(100, 0), (300, 0)]),
        ([], [(10, 0)], []),
    ],
)
def test_overlapping_buckets(wanted, stored, found):
    assert overlapping(wanted, stored) == found


def test_time_conditions_prune(filled):
    middle = at("2024-01-08T00:00:00")
    found = [
        filled.read("perf", PERF, where=lambda e: e.field("time_ns").gte.value(middle).and_.tag("host").equals.value("a")),
        filled.since("perf", "3d", PERF, now=NanoTime(at("2024-01-10T00:00:00"))),
    ]
    for df in found:
        assert rows_of(df.filter("host = 'a'")) == [ROWS[2]]
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [isnotnull((shard" in plan, plan


def test_delete_by_condition_alone(spark, filled):
    other = MeasurementSchema("disk", {"free": FieldType.INTEGER}, ("bay",), database="db")
    filled.append(spark.createDataFrame([(5, "a", 7)], "time_ns bigint, bay string, free bigint"), other)
    filled.delete(where=lambda e: e.tag("host").equals.value("a"))
    assert rows_of(filled.read("perf", PERF)) == [ROWS[1], ROWS[3]]
    assert filled.read("disk", other).count() == 1
    with pytest.raises(ValueError):
        filled.delete(PERF, "perf")


def test_replace_from(spark, filled):
    start = NanoTime(at("2024-01-03T00:00:00"))
    new = [(at("2024-01-04T00:00:00"), "n", 1.0, None)]
    filled.replace_from(spark.createDataFrame(new, COLUMNS), PERF, "perf", start)
    assert rows_of(filled.read("perf", PERF)) == [ROWS[0], *new]
    assert len(filled.buckets("perf")) == 1


def test_upsert_touches_only_its_buckets(spark, filled):
    before = {
        r.f for r in filled.read("perf", PERF).filter(f"time_ns >= {at('2024-01-08')}")
        .select(F.input_file_name().alias("f")).collect()
    }
    change = [
        (at("2024-01-03T00:00:00"), "b", 9.0, None),
        (at("2024-01-04T00:00:00"), "c", 5.0, "new"),
    ]
    for _ in range(2):
        filled.upsert(spark.createDataFrame(change, COLUMNS), PERF)
        assert rows_of(filled.read("perf", PERF)) == sorted([ROWS[0], change[0], change[1],
                                                            ROWS[2], ROWS[3]])
    after = {
        r.f for r in filled.read("perf", PERF).filter(f"time_ns >= {at('2024-01-08')}")
        .select(F.input_file_name().alias("f")).collect()
    }
    assert before == after


def test_upsert_into_nothing(spark, store):
    store.upsert(spark.createDataFrame(ROWS, COLUMNS), PERF)
    assert rows_of(store.read("perf", PERF)) == ROWS
    store.upsert(spark.createDataFrame([], COLUMNS), PERF)
    assert rows_of(store.read("perf", PERF)) == ROWS


def test_delete(filled):
    filled.delete(PERF, "perf", lambda e: e.tag("host").equals.value("a"))
    assert rows_of(filled.read("perf", PERF)) == [ROWS[1], ROWS[3]]
    # The bucket of 2024-01-08 lost its only point.
    assert len(filled.shard_starts("perf")) == 2
    filled.delete(PERF, "perf", "cpu > 0")
    assert filled.read("perf", PERF).count() == 0


def test_drops(spark, filled):
    filled.append(spark.createDataFrame(ROWS, COLUMNS), PERF, MeasurementRef("perf", "7d"))
    filled.append(spark.createDataFrame(ROWS, COLUMNS), PERF, MeasurementRef("other"))
    number = shard_id_of("db", "autogen", shard_start_of(at("2024-01-09"), 604800))
    assert shard_id_of("a/b", "c", 0) != shard_id_of("a", "b/c", 0)
    filled.drop_shard(number)
    assert rows_of(filled.read("perf", PERF)) == [ROWS[0], ROWS[1], ROWS[3]]
    assert rows_of(filled.read("other", PERF)) == [ROWS[0], ROWS[1], ROWS[3]]
    assert rows_of(filled.read(MeasurementRef("perf", "7d"), PERF)) == ROWS
    filled.drop_retention_policy("7d")
    assert filled.read(MeasurementRef("perf", "7d"), PERF).count() == 0
    filled.drop_measurement("perf")
    assert filled.read("perf", PERF).count() == 0
    assert filled.read("other", PERF).count() == 3
    filled.drop_database("db")
    assert filled.read("other", PERF).count() == 0


def test_retention_removes_whole_buckets(spark, filled):
    kept = MeasurementRef("perf", "7d")
    filled.append(spark.createDataFrame(ROWS, COLUMNS), PERF, kept)
    now = datetime(2024, 1, 16)
    filled.apply_retention(now)
    assert rows_of(filled.read("perf", PERF)) == ROWS
    assert rows_of(filled.read(kept, PERF)) == ROWS[3:]
    df = filled.read(kept, PERF)
    assert df.filter(filled.keep_valid(kept, datetime(2024, 1, 24))).count() == 0
    assert df.filter(filled.keep_valid(kept, datetime(2024, 1, 20))).count() == 1
    assert filled.read("perf", PERF).filter(filled.keep_valid("perf", now)).count() == 4


def test_aggregate_kept_as_measurement(spark, filled):
    mean = MeasurementSchema("mean_perf", {"mean": FieldType.FLOAT}, (), database="db")
    rows = spark.createDataFrame([(at("2024-01-01"), 2.0)], "time_ns bigint, mean double")
    for _ in range(2):
        filled.write_into(rows, mean, MeasurementRef("mean_perf", "7d"))
    assert filled.read(MeasurementRef("mean_perf", "7d"), mean).count() == 1


def test_hot_bucket_is_split_between_files(spark, store):
    """One bucket holds nearly all rows; it must not be written by a single task."""
    limits = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100k",
    }
    old = {k: spark.conf.get(k) for k in limits}
    hot = spark.range(200_000, numPartitions=4).select(
        (F.lit(at("2024-01-01")) + F.col("id")).alias("time_ns"),
        F.concat(F.lit("h"), F.col("id") % 7).alias("host"),
        F.rand(7).alias("cpu"),
        F.lit(None).cast("string").alias("note"),
    )
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        store.append(hot, PERF)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = store.read("perf", PERF)
    assert got.count() == 200_000
    assert got.select(F.input_file_name()).distinct().count() > 1


# -- many measurements at once -----------------------------------------------------------


def many(spark, n, value=0.0):
    """``n`` measurements with a tag and a field of their own each, and a common one."""
    rows = [
        ("db", None if i % 3 else "7d", f"m{i}", {"host": "a", f"t{i % 5}": "x"}, {"v": (value + i, None, None, None), f"f{i % 7}": (None, i, None, None)}, at("2024-01-01") + k)
        for i in range(n) for k in range(2)
    ]
    return spark.createDataFrame(rows, POINT_SCHEMA)


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    work()
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("known_new", [True, False])
def test_jobs_do_not_grow_with_the_measurements(spark, folder, known_new):
    counts = {}
    for n in (3, 30):
        store, points = Store(spark, f"{folder}/store{n}", POLICIES, database="db"), many(spark, n)
        counts[n] = jobs_of(spark, f"{folder}-{n}", lambda s=store, p=points: s.write_points(p, known_new=known_new))
        assert len(store.targets()) == n
        for i in range(n):
            rows = store.read(MeasurementRef(f"m{i}", "autogen" if i % 3 else "7d"))
            # Only its own columns, though all measurements share files of one write.
            assert set(rows.columns) == {"time_ns", "host", f"t{i % 5}", "v", f"f{i % 7}"}
        assert [r.v for r in rows.collect()] == [float(n - 1)] * 2
    assert counts[3] == counts[30]


def test_many_measurements_are_updated(spark, store):
    store.write_points(many(spark, 12))
    daily = Store(spark, store.root, (POLICIES[0], RetentionPolicy("db", "7d", 604800, 3600)), database="db")
    daily.write_points(many(spark, 12, value=100.0).filter("measurement != 'm0'"))
    for i in range(12):
        target = MeasurementRef(f"m{i}", "autogen" if i % 3 else "7d")
        assert [r.v for r in daily.read(target).collect()] == [i + (100.0 if i else 0.0)] * 2
        lengths = {b[0] for b in daily.buckets(target)}
        assert lengths == ({604800} if i % 3 else {3600} if i else {86400})


def test_columns_that_do_not_agree(spark, store):
    rows = [
        ("db", None, "a", {"x": "1"}, {"v": (1.5, None, None, None)}, 1), ("db", None, "b", {"X": "2"}, {"v": (None, None, "text", None)}, 2),
        ("db", None, "c", {"v": "tag"}, {"x": (None, 7, None, None)}, 3), ("db", None, "d", {"rp": "odd", "shard": "s"}, {"v": (2.5, None, None, None)}, 4),
        ("db", None, "e", {}, {}, 5),
    ]
    for _ in range(2):
        store.write_points(spark.createDataFrame(rows, POINT_SCHEMA).repartition(2))
    found = {m: store.read(m).first().asDict() for m in store.measurements()}
    assert found == {
        "a": {"time_ns": 1, "x": "1", "v": 1.5}, "b": {"time_ns": 2, "X": "2", "v": "text"}, "c": {"time_ns": 3, "v": "tag", "x": 7},
        "d": {"time_ns": 4, "rp": "odd", "v": 2.5, **({"shard": found["d"]["shard"]} if "shard" in found["d"] else {})}, "e": {"time_ns": 5},
    }


def test_a_group_is_as_wide_as_allowed(spark, store, monkeypatch):
    from pointlake.sinks import store as module

    monkeypatch.setattr(module, "MAX_COLUMNS", 6)
    store.write_points(many(spark, 9))
    assert len(store.targets()) == 9 and store.read("m8").count() == 2


# -- from the files themselves ------------------------------------------------------------


def test_stats_come_from_the_footers(spark, filled):
    filled.append(spark.createDataFrame(ROWS[:1], COLUMNS), PERF, MeasurementRef("other/one", "7d"))
    stats = filled.bucket_stats()
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(time_ns), MAX(time_ns)]" in plan
    found = sorted((r.measurement, r.rp, r.shard_s, r.n, r.first_ns, r.last_ns) for r in stats.collect())
    assert found == sorted([
        ("perf", "autogen", 604800, 2, ROWS[0][0], ROWS[1][0]), ("perf", "autogen", 604800, 1, ROWS[2][0], ROWS[2][0]),
        ("perf", "autogen", 604800, 1, ROWS[3][0], ROWS[3][0]), ("other/one", "7d", 86400, 1, ROWS[0][0], ROWS[0][0]),
    ])
    assert filled.bucket_stats("none").count() == 0
    listed = {(r.retention_policy, r.n) for r in filled.show_shards("db").collect()}
    assert listed == {("autogen", 2), ("autogen", 1), ("7d", 1)}
    # Other reads stay as they were.
    assert "FileScan parquet" in filled.read("perf", PERF)._jdf.queryExecution().executedPlan().toString()


def test_stats_of_nothing(store):
    assert store.bucket_stats().count() == 0 and store.show_shards().count() == 0


def test_writes_return_their_counts(spark, store, folder):
    points = cpu_points(spark, [(1, "a", "1.5"), (2, "b", "high"), (3, "c", "low")])
    found = store.append_points(points, [PERF], reject_path=folder + "/rejects")
    assert found == {"points": 3, "good": 1, "wrong_type": 2}
    assert spark.read.parquet(folder + "/rejects").count() == 2


def scanned(df):
    """Rows that the scan of a plan gives, after skipping row groups."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("Scan parquet"):
            return node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]


def test_tag_filters_skip_row_groups(spark, folder):
    """Values that every row group has smaller and larger ones of: only a filter tells them apart."""
    rows = spark.range(40_000).selectExpr("id AS time_ns", "sha2(cast(id AS string), 256) AS host", "cast(id AS double) AS cpu", "'' AS note")
    wanted = rows.where("time_ns = 31234").first().host
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(256 << 10))
    try:
        counts = {}
        for filters in (False, True):
            store = Store(spark, f"{folder}/{filters}", POLICIES, database="db", tag_filters=filters)
            # Not sorted by host: as files of many writes are, taken together.
            laid = store._typed(rows, PERF, NanoTime(0)).selectExpr("*", "604800 AS shard_s", "0 AS shard")
            store._writer(laid.coalesce(1), PERF).partitionBy("shard_s", "shard").parquet(store.path_of(store.resolve("perf")))
            found = store.read("perf", PERF, where=lambda e: e.tag("host").equals.value(wanted))
            counts[filters] = scanned(found)
            assert [r.time_ns for r in found.collect()] == [31234]
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert counts[True] < counts[False] / 3


# -- the table of series -------------------------------------------------------------------


def listed(store, name="perf", **times):
    return sorted(((r.host or "-", r.first_ns, r.last_ns, r.n_points) for r in store.show_series(name, **times).collect()))


def series_in(store, schema=PERF):
    points = store.read(schema.measurement, schema)
    grouped = points.groupBy("host").agg(F.min("time_ns").alias("a"), F.max("time_ns").alias("b"), F.count("*").alias("n"))
    return sorted((r.host or "-", r.a, r.b, r.n) for r in grouped.collect())


def test_series_follow_every_write(spark, folder):
    store = Store(spark, folder + "/store", POLICIES, database="db", series_table=True)
    assert store.show_series("perf").count() == 0
    store.append(spark.createDataFrame(ROWS, COLUMNS), PERF)
    assert listed(store) == series_in(store) and len(listed(store)) == 3
    store.append(spark.createDataFrame([(ROWS[0][0] + 1, "a", 9.0, None)], COLUMNS), PERF)
    assert listed(store) == series_in(store)
    # The same point again, and a new series.
    write_points(spark.createDataFrame([ROWS[0], (ROWS[0][0], "new", 1.0, None)], COLUMNS), store, PERF)
    assert listed(store) == series_in(store) and len(listed(store)) == 4
    store.delete(PERF, "perf", lambda e: e.tag("host").equals.value("new"))
    assert listed(store) == series_in(store) and len(listed(store)) == 3
    store.delete(None, "perf", lambda e: e.tag("host").equals.value("b"))
    assert listed(store) == series_in(store) and [r[0] for r in listed(store)] == ["-", "a"]
    early = listed(store, end=NanoTime(at("2024-01-05")))
    assert [r[0] for r in early] == ["a"] and early[0][2] < at("2024-01-08")
    store.drop_shard(shard_id_of("db", "autogen", at("2024-01-15") // 10**9))
    assert listed(store) == series_in(store) and [r[0] for r in listed(store)] == ["a"]
    files = store.show_series("perf").inputFiles()
    assert files and all("/_series/" in f for f in files)
    assert [t.name for t in store.targets()] == ["perf"] and store.bucket_stats().count() == 2
    store.drop_measurement("perf")
    assert store.show_series("perf").count() == 0


def test_series_of_many_measurements(spark, folder):
    store = Store(spark, folder + "/store", POLICIES, database="db", series_table=True)
    store.append_points(many(spark, 5))
    store.write_points(many(spark, 5, value=3.0))
    for i in range(5):
        target = MeasurementRef(f"m{i}", "autogen" if i % 3 else "7d")
        rows = store.show_series(target).collect()
        assert [(r.host, r[f"t{i % 5}"], r.n_points, r.last_ns - r.first_ns) for r in rows] == [("a", "x", 2, 1)]
