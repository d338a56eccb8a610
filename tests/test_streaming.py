import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pointlake.functions.timecol import to_timestamp
from pointlake.model import FieldType, MeasurementSchema, NanoTime, RetentionPolicy
from pointlake.operators.query import mean
from pointlake.sinks.store import MeasurementRef, Store
from pointlake.sources.tables import to_point_form
from pointlake.streaming import downsample, intake, partials
from pointlake.streaming.intake import stream_points

CPU = MeasurementSchema("cpu", {"value": FieldType.FLOAT}, ("host",), database="db")
HOURLY = MeasurementSchema(
    "hourly", {"mean": FieldType.FLOAT, "n": FieldType.INTEGER}, ("host",), database="db"
)
COLUMNS = "time_ns bigint, host string, value double"
HOUR = 3_600 * 10**9
START = int(NanoTime.from_datetime(datetime(2024, 1, 1)))


def arrive(spark, folder, rows):
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(folder)


def stream_of(spark, folder, **options):
    reader = spark.readStream.schema(COLUMNS)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(folder)


def run_standing(spark, store, source, checkpoint, **options):
    query = downsample.continuous_downsample(
        stream_of(spark, source, **options),
        "hourly_cpu", "value", "1h", MeasurementRef("hourly"), store, HOURLY, checkpoint,
        watermark="2h", scale=2,
    )
    query.awaitTermination()


def means(df):
    return sorted((r.time_ns, r.host, r["mean"], r.n) for r in df.collect())


def test_standing_query_equals_batch_over_restarts(spark, folder):
    store = Store(spark, folder + "/store", database="db")
    source, checkpoint = folder + "/in", folder + "/ck"
    first = [(START + i * HOUR // 4, "ab"[i % 2], float(i)) for i in range(20)]
    arrive(spark, source, first)
    run_standing(spark, store, source, checkpoint)
    # More points of open buckets arrive after a restart from the checkpoint.
    second = [(START + i * HOUR // 4 + 1, "ab"[i % 2], float(i)) for i in range(16, 30)]
    arrive(spark, source, second)
    run_standing(spark, store, source, checkpoint)
    run_standing(spark, store, source, checkpoint)
    batch = mean(
        spark.createDataFrame(first + second, COLUMNS), "value", ["host"], "1h", scale=2,
        counted=True,
    )
    assert means(store.read("hourly", HOURLY)) == means(batch)


def test_points_behind_the_watermark_wait_for_a_resample(spark, folder):
    store = Store(spark, folder + "/store", database="db")
    source, checkpoint = folder + "/in", folder + "/ck"
    arrive(spark, source, [(START, "a", 1.0), (START + 10 * HOUR, "a", 5.0)])
    run_standing(spark, store, source, checkpoint)
    arrive(spark, source, [(START + 11 * HOUR, "a", 6.0)])
    run_standing(spark, store, source, checkpoint)
    late = [(START + 1, "a", 3.0)]
    arrive(spark, source, late)
    run_standing(spark, store, source, checkpoint)
    assert (START, "a", 1.0, 1) in means(store.read("hourly", HOURLY))
    points = spark.read.parquet(source)
    target = store.read("hourly", HOURLY).select("time_ns", "host", "mean")
    again = downsample.resample(
        points, target, "value", "1h", "1d", NanoTime(START + 12 * HOUR), ["host"], scale=2
    )
    assert sorted((r.time_ns, r["mean"]) for r in again.collect()) == [
        (START, 2.0), (START + 10 * HOUR, 5.0), (START + 11 * HOUR, 6.0),
    ]


def test_windows_are_buckets(spark, folder):
    rows = [(START + i * 10**9 * 77, "a", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, COLUMNS)
    windows = downsample.windowed_mean(df, "value", "7m", ["host"], None, scale=2)
    buckets = mean(df, "value", ["host"], "7m", scale=2, counted=True)
    assert means(windows) == means(buckets)


def test_resample_keeps_older_buckets(spark):
    points = spark.createDataFrame(
        [(START + i * HOUR, "a", float(i)) for i in range(10)], COLUMNS
    )
    target = spark.createDataFrame(
        [(START + i * HOUR, -1.0) for i in range(8)], "time_ns bigint, mean double"
    )
    now = NanoTime(START + 9 * HOUR + HOUR // 2)
    got = downsample.resample(points, target, "value", "1h", "3h", now, scale=2)
    assert sorted((r.time_ns - START) // HOUR for r in got.collect()) == list(range(10))
    values = {(r.time_ns - START) // HOUR: r["mean"] for r in got.collect()}
    assert values == {**{i: -1.0 for i in range(6)}, 6: 6.0, 7: 7.0, 8: 8.0, 9: 9.0}
    assert downsample.resample_start("1h", "3h", now) == START + 6 * HOUR


def test_resample_on_arrival(spark, folder):
    store = Store(spark, folder + "/store", database="db")
    source = folder + "/in"
    plain = MeasurementSchema("hourly", {"mean": FieldType.FLOAT}, ("host",), database="db")
    arrive(spark, source, [(START + i * HOUR, "a", float(i)) for i in range(10)])
    store.append(spark.read.parquet(source), CPU)
    query = downsample.resample_stream(
        stream_of(spark, source), "again", lambda start: store.read("cpu", CPU, start=start),
        "value", "1h", "3h", None, MeasurementRef("hourly"), store, plain, folder + "/ck",
        clock=lambda: datetime(2024, 1, 1, 9), scale=2,
    )
    query.awaitTermination()
    got = {(r.time_ns - START) // HOUR: r["mean"] for r in store.read("hourly", plain).collect()}
    assert got == {6: 6.0, 7: 7.0, 8: 8.0, 9: 9.0}


def test_checked_stream(spark, folder):
    carried = MeasurementSchema("cpu", {"value": FieldType.STRING}, ("host",))
    columns = "time_ns bigint, host string, value string"
    for i in range(3):
        spark.createDataFrame(
            [(i, "a", str(i)), (i, "b", "oops")], columns
        ).coalesce(1).write.mode("append").parquet(folder + "/in")
    for _ in range(2):
        stream = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(
            folder + "/in"
        )
        query = stream_points(
            to_point_form(stream, carried, db="db"), [CPU], folder + "/good", folder + "/bad",
            folder + "/ck",
        )
        query.awaitTermination()
    good = sorted(r.value for r in spark.read.text(folder + "/good").collect())
    assert good == [f"cpu,host=a value={i} {i}" for i in range(3)]
    bad = spark.read.parquet(folder + "/bad").collect()
    assert len(bad) == 3 and all("Expected numeric value for db.cpu.value" in r.reason for r in bad)


def test_interval_text():
    assert downsample.interval_text("1h") == "3600000000 microseconds"
    with pytest.raises(ValueError):
        downsample.interval_text("10ns")


def test_time_column_of_a_stream(spark):
    df = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' ts, TIMESTAMP_NTZ'2024-01-01' n")
    for name in ("ts", "n"):
        got = downsample.with_time_ns(df, name)
        assert got.first().time_ns == START
        assert got.select(to_timestamp(F.col("time_ns")).alias("t")).schema["t"].dataType.typeName(
        ) == "timestamp"


# -- means that take up late points -----------------------------------------------------


def run_exact(spark, store, source, folder, **options):
    query = partials.standing_mean(
        stream_of(spark, source, **options), "exact_cpu", "value", "1h", MeasurementRef("hourly"), store, HOURLY,
        folder + "/ck", folder + "/late", "2h",
    )
    query.awaitTermination()


def late_rows(spark, folder):
    kind = spark.createDataFrame([], COLUMNS).schema
    return partials.late_points(spark, folder + "/late", kind)


def test_late_points_are_in_the_means_and_kept_apart(spark, folder):
    store = Store(spark, folder + "/store", database="db")
    rows = [(START, "a", 0.1), (START + 5, None, 7.0), (START + 30 * HOUR, "a", 5.0)]
    arrive(spark, folder + "/in", rows)
    run_exact(spark, store, folder + "/in", folder)
    assert late_rows(spark, folder).count() == 0
    late = [(START + 1, "a", 0.2), (START + 2, "b", 1e300), (START + 3, "b", -1e300), (START + 4, "b", 1.5)]
    fine = [(START + 28 * HOUR, "a", 6.0), (START + 31 * HOUR, "a", 8.0), (None, "a", 9.0), (START + 28 * HOUR, "b", None)]
    arrive(spark, folder + "/in", late + fine)
    run_exact(spark, store, folder + "/in", folder)
    run_exact(spark, store, folder + "/in", folder)
    points = spark.read.parquet(folder + "/in").where("time_ns IS NOT NULL")
    batch = mean(points, "value", ["host"], "1h", counted=True, exact=True)
    key = lambda r: (r[0], r[1] or "", r[3])
    assert sorted(map(tuple, store.read("hourly", HOURLY).select("time_ns", "host", "mean", "n").collect()), key=key) == sorted(
        map(tuple, batch.select("time_ns", "host", "mean", "n").collect()), key=key
    )
    found = sorted((r.time_ns, r.host, r.value, r.batch) for r in late_rows(spark, folder).collect())
    assert found == sorted((*r, 1) for r in late)
    assert min(r.behind_ns for r in late_rows(spark, folder).collect()) == 27 * HOUR
    assert means(partials.means_of(store, HOURLY, MeasurementRef("hourly")).where("host = 'a'")) == means(batch.where("host = 'a'"))


def test_a_repeated_batch_changes_nothing(spark, folder):
    store, into = Store(spark, folder + "/store", database="db"), MeasurementRef("hourly")
    frames = [
        spark.createDataFrame([(START + i * HOUR // 3, "ab"[i % 2], 0.1 * i) for i in range(k, 30, 3)], COLUMNS) for k in range(3)
    ]
    for number in (0, 1, 1, 2, 2, 2):
        partials.add_points(store, frames[number], number, "value", "1h", HOURLY, into)
    # A batch that stopped after some of its rows were written: the rest is still of the batch before.
    partials.add_points(store, frames[0].where("host = 'a'"), 3, "value", "1h", HOURLY, into)
    partials.add_points(store, frames[0], 3, "value", "1h", HOURLY, into)
    whole = frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[0])
    want = means(mean(whole, "value", ["host"], "1h", counted=True, exact=True))
    assert means(store.read(into, HOURLY)) == want


def test_only_dirty_buckets_are_read(spark, folder):
    day = RetentionPolicy("db", "d", shard_s=86_400, is_default=True)
    store, into = Store(spark, folder + "/store", [day], database="db"), MeasurementRef("hourly")
    rows = [(START + i * 24 * HOUR, "a", float(i)) for i in range(6)]
    partials.add_points(store, spark.createDataFrame(rows, COLUMNS), 0, "value", "1h", HOURLY, into)
    dirty = spark.createDataFrame([(START + 2 * 24 * HOUR, "a", 1.0)], COLUMNS)
    state = partials.partials_schema(HOURLY)
    read = store.read_touched(dirty, state, partials.partials_of(into))
    assert len(read.inputFiles()) == 1 or read.count() == 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "shard" in plan.split("PartitionFilters")[1].split("]")[0]
    before = {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in store.read(into, HOURLY).inputFiles()}
    partials.add_points(store, dirty, 1, "value", "1h", HOURLY, into)
    after = {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in store.read(into, HOURLY).inputFiles()}
    assert len(set(before.items()) & set(after.items())) == 5
    assert {r["mean"] for r in store.read(into, HOURLY).collect()} == {0.0, 1.0, 1.5, 3.0, 4.0, 5.0}
    partials.forget_before(store, into, NanoTime(START + 3 * 24 * HOUR))
    assert partials.means_of(store, HOURLY, into).count() == 3 and store.read(into, HOURLY).count() == 6


def test_an_empty_batch(spark, folder):
    store, into = Store(spark, folder + "/store", database="db"), MeasurementRef("hourly")
    partials.add_points(store, spark.createDataFrame([], COLUMNS), 0, "value", "1h", HOURLY, into)
    assert store.read(into, HOURLY).count() == 0


# -- points that arrive again ------------------------------------------------------------


def send(spark, folder, rows, keep="1d", seq=False):
    """One more batch of ``(time_ns, host, value, seq)``; the lines it has written."""
    columns = "time_ns bigint, host string, value double, seq bigint"
    spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(folder + "/in")
    stream = spark.readStream.schema(columns).parquet(folder + "/in")
    points = to_point_form(stream, CPU, db="db", keep=["seq"])
    sent = Store(spark, folder + "/sent")
    query = stream_points(
        points, [CPU], folder + "/good", folder + "/bad", folder + "/ck", sent=sent, keep=keep, write_seq="seq" if seq else None
    )
    query.awaitTermination()
    batch = max(int(d.removeprefix("batch=")) for d in os.listdir(folder + "/good") if d.startswith("batch="))
    return sorted(r.value for r in spark.read.text(f"{folder}/good/batch={batch}").collect()), batch, sent


def test_repeated_points_give_one_line(spark, folder):
    rows = [(START + i, "ab"[i % 2], float(i), 0) for i in range(6)] + [(START, None, 1.5, 0), (None, "a", 1.0, 0)]
    first, _, _ = send(spark, folder, rows + rows[:3])
    assert len(first) == 8
    again, _, _ = send(spark, folder, rows)
    assert again == ["cpu,host=a value=1"]  # a point without time is a new one each time
    changed, _, _ = send(spark, folder, [(START, "a", 9.0, 0), (START + 1, "b", 1.0, 0)])
    assert changed == [f"cpu,host=a value=9 {START}"]
    # Back to the first value: that is a change too.
    back, _, _ = send(spark, folder, [(START, "a", 0.0, 0)])
    assert back == [f"cpu,host=a value=0 {START}"]
    assert send(spark, folder, [(START, "a", 0.0, 0)])[0] == []


def test_the_last_write_of_a_batch_wins(spark, folder):
    rows = [(START, "a", 5.0, 1), (START, "a", 2.0, 3), (START, "a", 9.0, 2)]
    assert send(spark, folder, rows, seq=True)[0] == [f"cpu,host=a value=2 {START}"]
    assert send(spark, folder, [(START, "a", 2.0, 4)], seq=True)[0] == []


def test_a_repeated_batch_sends_the_same_lines(spark, folder):
    send(spark, folder, [(START, "a", 1.0, 0), (START + 1, "a", 1.0, 0)])
    rows = [(START, "a", 2.0, 0), (START + 1, "a", 1.0, 0), (START + 2, "a", 3.0, 0)]
    lines, number, sent = send(spark, folder, rows)
    assert len(lines) == 2
    good = spark.createDataFrame(
        [(f"db\ncpu,host=a", t, f"cpu,host=a value={int(v)} {t}", None) for t, _, v, _ in rows],
        "series string, time_ns bigint, line string, _order bigint",
    )
    for _ in range(2):
        again = intake._without_repeats(good, number, sent, "1d", False)
        assert sorted(r.line for r in again.collect()) == lines


def test_old_points_are_forgotten(spark, folder):
    send(spark, folder, [(START, "a", 1.0, 0)], keep="2h")
    send(spark, folder, [(START + 10 * 24 * HOUR, "a", 1.0, 0)], keep="2h")
    assert len(send(spark, folder, [(START, "a", 1.0, 0), (START + 10 * 24 * HOUR, "a", 1.0, 0)], keep="2h")[0]) == 1
    assert Store(spark, folder + "/sent").shard_starts(intake.SENT_REF) == [
        s for s in Store(spark, folder + "/sent").shard_starts(intake.SENT_REF) if s * 10**9 > START + HOUR
    ]
