"""Deletes, retention, updates and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.timecol import bucket_start, duration_ns, to_precision
from pointlake.model import FieldType, MeasurementSchema, NanoTime, RetentionPolicy
from pointlake.operators import lifecycle
from pointlake.operators.shards import shard_id_of
from pointlake.plans.intake import HOURLY, STRICT, faulty_points
from pointlake.plans.registry import query
from pointlake.plans.tables import (
    EVENTS,
    K_SQL,
    MEAN_SQL,
    ORDERS,
    POLICIES,
    event_points,
    k_of_props,
    order_points,
    rounded_mean,
    table,
    with_wall_time,
)
from pointlake.session import fresh_path
from pointlake.sinks.store import MeasurementRef, Store
from pointlake.sources.line_protocol import read_line_protocol
from pointlake.sources.tables import to_point_form
from pointlake.streaming import downsample, partials
from pointlake.streaming.downsample import with_time_ns
from pointlake.streaming.intake import stream_points as start_stream_points


def placed_events(spark: SparkSession, sf_dir: str, rp: F.Column) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    return points.withColumns({"db": F.lit("app"), "rp": rp})


# -- deletes and retention -----------------------------------------------------------


@query("SELECT event_id FROM events WHERE NOT (event_type = 'click' AND user_id = 8)")
def drop_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    kept = lifecycle.drop_series(
        points,
        "events",
        lambda e: e.tag("event_type").equals.value("click").and_.tag("user_id").equals.value("8"),
    )
    return kept.select("event_id")


@query("SELECT event_id FROM events WHERE event_type <> 'error'")
def drop_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Here each event type is a measurement of its own."""
    points = table(spark, sf_dir, "events").withColumn("measurement", F.col("event_type"))
    return lifecycle.drop_measurement(points, "error").select("event_id")


@query("SELECT 'app' AS db, count(*) AS n FROM events")
def drop_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = event_points(spark, sf_dir).select(F.lit("app").alias("db"), "time_ns")
    orders = order_points(spark, sf_dir).select(F.lit("sales").alias("db"), "time_ns")
    kept = lifecycle.drop_database(events.unionByName(orders), "sales")
    return kept.groupBy("db").agg(F.count(F.lit(1)).alias("n"))


@query(
    "SELECT event_id FROM events"
    " WHERE date_trunc('week', ts) <> TIMESTAMP '2024-01-08 00:00:00'"
)
def drop_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = placed_events(spark, sf_dir, F.lit("autogen"))
    second_week = int(datetime.fromisoformat("2024-01-08T00:00:00+00:00").timestamp())
    number = shard_id_of("app", "autogen", second_week)
    return lifecycle.drop_shard(points, POLICIES, number).select("event_id")


@query(
    """
    SELECT event_id FROM events
    WHERE event_type <> 'error'
       OR ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 168 HOUR
    """
)
def apply_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors are under the policy ``7d``, everything else is kept forever."""
    rp = F.when(F.col("event_type") == "error", F.lit("7d")).otherwise(F.lit("autogen"))
    points = placed_events(spark, sf_dir, rp)
    return lifecycle.apply_retention(points, POLICIES, datetime(2024, 1, 31)).select("event_id")


@query("SELECT event_id FROM events WHERE event_type NOT IN ('error', 'view')")
def drop_retention_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rp = F.when(F.col("event_type").isin("error", "view"), F.lit("7d")).otherwise("autogen")
    points = placed_events(spark, sf_dir, rp)
    return lifecycle.drop_retention_policy(points, "app", "7d").select("event_id")


@query(
    """
    SELECT CASE WHEN event_type = 'error' THEN '7d' ELSE 'autogen' END AS rp, count(*) AS n
    FROM events GROUP BY 1
    """
)
def route_default_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = placed_events(
        spark, sf_dir, F.when(F.col("event_type") == "error", F.lit("7d"))
    )
    routed = lifecycle.route_default_policy(points, POLICIES)
    return routed.groupBy("rp").agg(F.count(F.lit(1)).alias("n"))


# -- updates -------------------------------------------------------------------------

KEYED_EVENTS = MeasurementSchema(
    "events",
    {"event_id": FieldType.INTEGER, "value": FieldType.FLOAT, "k": FieldType.INTEGER},
    ("event_type", "user_id"),
    database="app",
)
UPSERT_SQL = f"""
SELECT event_id, CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value,
       {K_SQL} AS k
FROM events
"""


def _purchases_again(points: DataFrame) -> DataFrame:
    """Every purchase once more, with another value and without ``k``."""
    again = points.filter(F.col("event_type") == "purchase")
    return again.select(
        "event_type", "user_id", "time_ns", (F.col("value") + 1).alias("value"),
        F.lit(None).cast("bigint").alias("k"),
    )


@query(UPSERT_SQL)
def upsert_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    merged = lifecycle.upsert_points(
        points, _purchases_again(points), KEYED_EVENTS.tags, ["event_id", "value", "k"]
    )
    return merged.select("event_id", "value", "k")


@query(UPSERT_SQL)
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a store; only the touched buckets are rewritten."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    points = event_points(spark, sf_dir, keep=["event_id"])
    store.append(points, KEYED_EVENTS)
    store.upsert(_purchases_again(points), KEYED_EVENTS)
    return store.read("events", KEYED_EVENTS).select("event_id", "value", "k")


WRITTEN_AT = datetime(2024, 1, 20, 12)


@query(
    f"""
    SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, epoch_us(ts) * 1000 AS time_ns,
           CASE WHEN event_type = 'purchase' AND ts < TIMESTAMP '2024-01-10' THEN value + 1 ELSE value END AS value
    FROM events
    UNION ALL
    SELECT 'purchase', CAST(user_id AS VARCHAR), epoch_us(TIMESTAMP '{WRITTEN_AT}') * 1000, max(value) + 1
    FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10' GROUP BY user_id
    """
)
def upsert_missing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases once more; those from 10 January on have lost their time."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    store.append(event_points(spark, sf_dir), EVENTS)
    late = F.col("time_ns") >= int(NanoTime.from_datetime(datetime(2024, 1, 10)))
    again = _purchases_again(event_points(spark, sf_dir)).withColumn("time_ns", F.when(~late, F.col("time_ns")))
    store.upsert(again, EVENTS, write_time=WRITTEN_AT)
    return store.read("events", EVENTS).select("event_type", "user_id", "time_ns", "value")


def _event_map_points(spark: SparkSession, sf_dir: str, **columns) -> DataFrame:
    return to_point_form(event_points(spark, sf_dir, keep=["event_id"]), EVENTS, db="app", **columns)


@query(f"SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, epoch_us(ts) * 1000 AS time_ns, value, {K_SQL} AS k FROM events")
def write_points_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing points again updates them; nothing is doubled."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    for _ in range(2):
        store.write_points(_event_map_points(spark, sf_dir), [EVENTS])
    return store.read("events", EVENTS).select("event_type", "user_id", "time_ns", "value", "k")


@query(
    "SELECT CASE WHEN event_type = 'error' THEN '7d' ELSE 'autogen' END AS rp, event_type, count(*) AS n,"
    " round(sum(value), 2) AS total FROM events GROUP BY ALL"
)
def write_points_by_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row's own policy says where it is stored."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    rp = F.when(F.col("event_type") == "error", F.lit("7d"))
    store.append_points(_event_map_points(spark, sf_dir, rp=rp), [EVENTS])
    tables = [
        store.read(MeasurementRef("events", name), EVENTS).withColumn("rp", F.lit(name)) for name in ("7d", "autogen")
    ]
    both = tables[0].unionByName(tables[1])
    return both.groupBy("rp", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(f"SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, epoch_us(ts) * 1000 AS time_ns, value, {K_SQL} AS k FROM events")
def write_points_undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No schema is declared; fields and tags are those of the points, and of the files."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    store.append_points(_event_map_points(spark, sf_dir))
    return store.read("events").select("event_type", "user_id", "time_ns", "value", "k")


@query(
    "SELECT event_id, CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value FROM events"
    " WHERE ts >= TIMESTAMP '2024-01-10 06:00:00' AND ts < TIMESTAMP '2024-01-19'"
)
def read_after_policy_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly buckets are read and updated under a policy of daily ones."""
    path = fresh_path(spark, "store")
    weekly = Store(spark, path, [RetentionPolicy("app", "autogen", is_default=True)], database="app")
    weekly.append(event_points(spark, sf_dir, keep=["event_id"]), KEYED_EVENTS)
    daily = Store(spark, path, [RetentionPolicy("app", "autogen", shard_s=86_400, is_default=True)], database="app")
    daily.upsert(_purchases_again(event_points(spark, sf_dir)).filter("time_ns % 2000 = 0"), KEYED_EVENTS)
    daily.upsert(_purchases_again(event_points(spark, sf_dir)), KEYED_EVENTS)
    start, end = (NanoTime.from_datetime(t) for t in (datetime(2024, 1, 10, 6), datetime(2024, 1, 19)))
    return daily.read("events", KEYED_EVENTS, start=start, end=end).select("event_id", "value")


@query(
    "SELECT 'app' AS db, 'events' AS name FROM events UNION SELECT 'app', 'logins' FROM events"
    " UNION SELECT 'sales', 'orders' FROM orders"
)
def list_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Databases and measurements of a store, from its directories."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    store.append(event_points(spark, sf_dir), EVENTS)
    store.append(event_points(spark, sf_dir).drop("measurement"), EVENTS, MeasurementRef("logins", "7d"))
    store.append(order_points(spark, sf_dir), ORDERS)
    rows = [(db, name) for db in store.databases() for name in store.measurements(db)]
    return spark.createDataFrame(rows, "db string, name string")


@query("SELECT event_id FROM events WHERE NOT (event_type = 'click' AND user_id = 8)")
def delete_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    store.append(event_points(spark, sf_dir, keep=["event_id"]), KEYED_EVENTS)
    store.delete(
        KEYED_EVENTS,
        "events",
        lambda e: e.tag("event_type").equals.value("click").and_.tag("user_id").equals.value("8"),
    )
    return store.read("events", KEYED_EVENTS).select("event_id")


@query(
    """
    SELECT 'user_' || user_id % 40 AS measurement, event_type, count(*) AS n,
           CAST(sum(CAST(CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY 1, 2
    """
)
def write_points_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty undeclared measurements in one write, then the clicks of all again with another value."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    name = F.concat(F.lit("user_"), (F.col("user_id").cast("bigint") % 40).cast("string"))
    events = event_points(spark, sf_dir)
    points = to_point_form(events, EVENTS, db="app", measurement=name)
    store.append_points(points)
    clicks = events.where("event_type = 'click'").withColumn("value", F.col("value") + 1)
    store.write_points(to_point_form(clicks, EVENTS, db="app", measurement=name))
    total = F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total")
    counts = [
        store.read(m).groupBy(F.lit(m).alias("measurement"), "event_type").agg(F.count(F.lit(1)).alias("n"), total)
        for m in store.measurements()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out


# -- streams -------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a file stream with ``time_ns`` and ``k``."""
    schema = table(spark, sf_dir, "events").schema
    raw = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return with_time_ns(raw, "ts").withColumn("k", k_of_props())


HOURLY_BY_TYPE = MeasurementSchema(
    "hourly",
    {"mean": FieldType.FLOAT, "n": FieldType.INTEGER},
    ("event_type",),
    database="app",
)


@query(
    f"""
    SELECT date_trunc('hour', ts) AS time, event_type, {MEAN_SQL} AS mean, count(*) AS n
    FROM events GROUP BY 1, 2
    """
)
def continuous_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    into = MeasurementRef("hourly", "7d")
    standing = downsample.continuous_downsample(
        event_stream(spark, sf_dir),
        name="hourly_events",
        field="value",
        every="1h",
        into=into,
        store=store,
        schema=HOURLY_BY_TYPE,
        checkpoint=fresh_path(spark, "checkpoint"),
        watermark="1d",
    )
    standing.awaitTermination()
    return with_wall_time(rounded_mean(store.read(into, HOURLY_BY_TYPE)))


@query(
    f"""
    WITH arrived AS (
      SELECT *, event_id % 4 = 0 AND date_trunc('hour', ts) + INTERVAL 1 HOUR
                <= (SELECT max(ts) FROM events WHERE event_id % 4 <> 0) - INTERVAL 1 DAY AS late
      FROM events
    )
    SELECT date_trunc('hour', ts) AS time, event_type, {MEAN_SQL} AS mean, count(*) AS n,
           count(*) FILTER (WHERE late) AS n_late
    FROM arrived GROUP BY 1, 2
    """
)
def downsample_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the events arrives after all others, most of it behind the watermark: the
    means hold all of them, and the late ones are counted."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    into, arriving, late_path = MeasurementRef("hourly", "7d"), fresh_path(spark, "arriving"), fresh_path(spark, "late")
    events = event_points(spark, sf_dir, keep=["event_id"]).select("time_ns", "event_type", "event_id", "value")
    checkpoint = fresh_path(spark, "checkpoint")
    for chosen in ("event_id % 4 <> 0", "event_id % 4 = 0"):
        events.where(chosen).coalesce(1).write.mode("append").parquet(arriving)
        standing = partials.standing_mean(
            spark.readStream.schema(events.schema).parquet(arriving), "hourly_late", "value", "1h", into, store,
            HOURLY_BY_TYPE, checkpoint, late_path, "1d",
        )
        standing.awaitTermination()
    late = partials.late_points(spark, late_path, events.schema)
    counts = late.groupBy(
        "event_type", bucket_start(F.col("time_ns"), duration_ns("1h")).alias("time_ns")
    ).agg(F.count(F.lit(1)).alias("n_late"))
    means = rounded_mean(store.read(into, HOURLY_BY_TYPE))
    return with_wall_time(means.join(counts, ["time_ns", "event_type"], "left").fillna(0, ["n_late"]))


RESAMPLE_SQL = f"""
SELECT date_trunc('hour', ts) AS time,
       CASE WHEN date_trunc('hour', ts) >= TIMESTAMP '2024-01-24 00:00:00'
            THEN {MEAN_SQL} ELSE 0 END AS mean
FROM events GROUP BY 1
"""


def _stale_target(points: DataFrame) -> DataFrame:
    """An hourly target that was never filled: zero everywhere."""
    hour = (to_precision(F.col("time_ns"), "h") * F.lit(3_600_000_000_000).cast("bigint"))
    return points.select(hour.alias("time_ns")).distinct().withColumn("mean", F.lit(0.0))


@query(RESAMPLE_SQL)
def resample_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir)
    recomputed = downsample.resample(
        points, _stale_target(points), "value", "1h", "168h", datetime(2024, 1, 31)
    )
    return with_wall_time(rounded_mean(recomputed))


@query(RESAMPLE_SQL)
def resample_standing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a standing query over a store."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    points = event_points(spark, sf_dir)
    store.append(points, EVENTS)
    into = MeasurementRef("hourly", "7d")
    store.append(_stale_target(points), HOURLY, into)
    standing = downsample.resample_stream(
        event_stream(spark, sf_dir),
        name="resample_hourly",
        read_source=lambda start: store.read("events", EVENTS, start=start),
        field="value",
        every="1h",
        span="168h",
        resample_every=None,
        into=into,
        store=store,
        schema=HOURLY,
        checkpoint=fresh_path(spark, "checkpoint"),
        clock=lambda: datetime(2024, 1, 31),
    )
    standing.awaitTermination()
    return with_wall_time(rounded_mean(store.read(into, HOURLY)))


STREAMED = MeasurementSchema(
    "events",
    {"value": FieldType.FLOAT, "event_id": FieldType.INTEGER},
    STRICT.tags,
    database="app",
)


@query(
    """
    SELECT event_id, value FROM events WHERE event_type <> 'error'
    """
)
def stream_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive with text in place of the number for the type ``error``."""
    carried = MeasurementSchema(
        "events", {"value": FieldType.STRING, "event_id": FieldType.INTEGER}, STRICT.tags
    )
    shown = F.when(F.col("event_type") == "error", F.lit("oops")).otherwise(
        F.col("value").cast("string")
    )
    arriving = event_stream(spark, sf_dir).withColumn("value", shown)
    good_path = fresh_path(spark, "lines")
    running = start_stream_points(
        to_point_form(arriving, carried, db="app"),
        [STREAMED],
        good_path,
        fresh_path(spark, "rejects"),
        fresh_path(spark, "checkpoint"),
    )
    running.awaitTermination()
    good, _ = read_line_protocol(spark, good_path, STREAMED, database="app")
    return good.select("event_id", "value")


@query(
    """
    SELECT event_id, value, count(*) AS n_lines FROM (
      SELECT event_id, value FROM events WHERE event_type <> 'error'
      UNION ALL
      SELECT event_id, CAST(value AS BIGINT) + 1000.5 FROM events WHERE event_type = 'purchase'
    ) GROUP BY event_id, value
    """
)
def stream_points_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events arrive three times, purchases with another value the second time and with that
    one again the third: every point gives a line, and every change one more."""
    arriving, good_path = fresh_path(spark, "arriving"), fresh_path(spark, "lines")
    checkpoint, rejects = fresh_path(spark, "checkpoint"), fresh_path(spark, "rejects")
    sent = Store(spark, fresh_path(spark, "sent"))
    carried = MeasurementSchema(
        "events", {"value": FieldType.STRING, "event_id": FieldType.INTEGER}, STRICT.tags
    )
    kind = F.col("event_type")
    events = event_points(spark, sf_dir, keep=["event_id"]).select("time_ns", *STRICT.tags, "event_id", "value")
    changed = F.when(kind == "purchase", F.rint("value") + F.lit(1000.5)).otherwise(F.col("value"))
    for again in (F.col("value"), changed, changed):
        text = F.when(kind == "error", F.lit("oops")).otherwise(again.cast("string"))
        events.withColumn("value", text).coalesce(1).write.mode("append").parquet(arriving)
        schema = spark.read.parquet(arriving).schema
        running = start_stream_points(
            to_point_form(spark.readStream.schema(schema).parquet(arriving), carried, db="app"),
            [STREAMED], good_path, rejects, checkpoint, sent=sent, keep="60d",
        )
        running.awaitTermination()
    good, _ = read_line_protocol(spark, good_path, STREAMED, database="app")
    return good.groupBy("event_id", "value").agg(F.count(F.lit(1)).alias("n_lines"))
