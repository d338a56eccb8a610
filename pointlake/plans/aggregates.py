"""Aggregates, groups and listings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.timecol import to_timestamp_ntz
from pointlake.model import NanoTime
from pointlake.operators import catalog
from pointlake.operators.query import mean, top
from pointlake.operators.results import groups as nested_groups
from pointlake.operators.shards import shard_id_of
from pointlake.plans.registry import query
from pointlake.plans.tables import (
    MEAN_SQL,
    ORDERS,
    POLICIES,
    event_points,
    order_points,
    rounded_mean,
    table,
    with_wall_time,
)
from pointlake.plans.tables import EVENTS
from pointlake.session import fresh_path
from pointlake.sinks.store import MeasurementRef, Store
from pointlake.sources.tables import to_point_form


@query(f"SELECT event_type, {MEAN_SQL} AS mean FROM events GROUP BY event_type")
def mean_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir)
    return rounded_mean(mean(points, "value", by=["event_type"]))


@query(
    f"""
    SELECT date_trunc('hour', ts) AS time, event_type, {MEAN_SQL} AS mean, count(*) AS n
    FROM events GROUP BY 1, 2
    """
)
def downsample_mean_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir)
    hourly = mean(points, "value", by=["event_type"], every="1h", counted=True)
    return with_wall_time(rounded_mean(hourly))


@query(
    """
    SELECT event_type, count(*) AS n,
           round(CAST(sum(CAST(round(value * 100) AS HUGEINT) * CASE k % 3 WHEN 0 THEN 1 WHEN 1 THEN 1099511627776
             ELSE 1208925819614629174706176 END) AS DOUBLE) / count(*) / 1099511627776, 3) AS mean
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS HUGEINT) AS k FROM events) GROUP BY event_type
    """
)
def mean_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of values some 24 digits apart, from exact sums."""
    far = F.round(F.col("value") * 100) * F.pow(F.lit(2.0), F.pmod("k", F.lit(3)) * 40)
    points = event_points(spark, sf_dir).withColumn("far", far)
    means = mean(points, "far", by=["event_type"], exact=True, counted=True)
    return means.select("event_type", "n", F.round(F.col("mean") / F.lit(float(2**40)), 3).alias("mean"))


def _top_sql(n: int) -> str:
    return f"""
    SELECT event_type, ts AS time, value AS top FROM (
      SELECT event_type, ts, value,
             row_number() OVER (PARTITION BY event_type ORDER BY value DESC, ts, user_id) AS r
      FROM events) ranked
    WHERE r <= {n}
    """


def _top(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    points = event_points(spark, sf_dir)
    best = top(points, "value", n, by=["event_type"], ties=["user_id"])
    return best.select(
        "event_type", to_timestamp_ntz(F.col("time_ns")).alias("time"), "top"
    )


@query(_top_sql(1))
def top_1_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 1)


@query(_top_sql(5))
def top_n_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(spark, sf_dir, 5)


DAILY_GROUPS_SQL = """
SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS bucket, min(ts) AS first_time, max(ts) AS last_time,
       string_agg(epoch_us(ts) * 1000 || '=' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR), ';'
                  ORDER BY ts {order}, value {order}) AS rows
FROM events GROUP BY 1, 2
"""


def _daily_groups(spark: SparkSession, sf_dir: str, descending: bool) -> DataFrame:
    points = event_points(spark, sf_dir).select("event_type", "time_ns", "value")
    nested = nested_groups(points, "events", ["event_type"], "1d", descending=descending)
    shown = F.transform(
        "rows",
        lambda r: F.concat(r["time_ns"].cast("string"), F.lit("="), r["value"].cast("decimal(18,2)").cast("string")),
    )
    return nested.select(
        "event_type",
        *[to_timestamp_ntz(F.col(c)).alias(c) for c in ("bucket", "first_time", "last_time")],
        F.array_join(shown, ";").alias("rows"),
    )


@query(DAILY_GROUPS_SQL.format(order="ASC"))
def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested rows of each tag set and day, in order, printed."""
    return _daily_groups(spark, sf_dir, descending=False)


@query(DAILY_GROUPS_SQL.format(order="DESC"))
def groups_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily_groups(spark, sf_dir, descending=True)


def _named_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both measurements with their places."""
    events = event_points(spark, sf_dir).select(
        F.lit("app").alias("db"), "measurement", "time_ns"
    )
    orders = order_points(spark, sf_dir).select(
        F.lit("sales").alias("db"), "measurement", "time_ns"
    )
    return events.unionByName(orders)


@query("SELECT DISTINCT 'app' AS name FROM events UNION SELECT DISTINCT 'sales' FROM orders")
def show_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.show_databases(_named_points(spark, sf_dir))


@query("SELECT DISTINCT event_type AS name FROM events")
def show_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Here each event type is a measurement of its own."""
    points = table(spark, sf_dir, "events").select(
        F.lit("app").alias("db"), F.col("event_type").alias("measurement")
    )
    return catalog.show_measurements(points, "app")


_ORDER_KEY_SQL = (
    r"'orders,o_orderpriority=' || replace(o_orderpriority, ' ', '\ ')"
    " || ',o_orderstatus=' || o_orderstatus"
)
_EVENT_KEY_SQL = "'events,event_type=' || event_type || ',user_id=' || user_id"


@query(
    f"""
    SELECT DISTINCT {_EVENT_KEY_SQL} AS key FROM events
    UNION SELECT DISTINCT {_ORDER_KEY_SQL} FROM orders
    """
)
def show_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = catalog.table_series(event_points(spark, sf_dir), "events", EVENTS.tags)
    orders = catalog.table_series(order_points(spark, sf_dir), "orders", ORDERS.tags)
    return events.unionByName(orders)


@query(f"SELECT DISTINCT {_ORDER_KEY_SQL} AS key FROM orders")
def show_series_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over map-form points of both measurements."""
    points = to_point_form(event_points(spark, sf_dir), EVENTS, db="app").unionByName(
        to_point_form(order_points(spark, sf_dir), ORDERS, db="sales")
    )
    return catalog.show_series(points, measurement="orders")


@query(
    """
    SELECT o_orderpriority AS name,
           (date_diff('day', min(o_orderdate), max(o_orderdate)) * 24) || 'h0m0s' AS duration,
           '168h0m0s' AS "shardGroupDuration",
           CAST(count(DISTINCT o_orderstatus) AS INTEGER) AS "replicaN",
           o_orderpriority = '1-URGENT' AS "default"
    FROM orders GROUP BY o_orderpriority
    """
)
def show_retention_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy table drawn from orders: one policy per priority, kept as long as the
    priority's orders span."""
    orders = table(spark, sf_dir, "orders")
    policies = orders.groupBy(F.col("o_orderpriority").alias("rp")).agg(
        F.lit("sales").alias("db"),
        (F.datediff(F.max("o_orderdate"), F.min("o_orderdate")) * 86_400)
        .cast("bigint")
        .alias("duration_s"),
        F.lit(7 * 86_400).cast("bigint").alias("shard_s"),
        F.countDistinct("o_orderstatus").cast("int").alias("replica_n"),
        (F.col("o_orderpriority") == "1-URGENT").alias("is_default"),
    )
    return catalog.show_retention_policies(policies, "sales")


SHARDS_SQL = """
    SELECT CAST('0x' || substr(md5('3/app/' || rp || '/' || CAST(epoch(start_time) AS BIGINT)),
                               1, 15) AS BIGINT) AS id,
           'app' AS database, rp AS retention_policy,
           CAST('0x' || substr(md5('3/app/' || rp || '/' || CAST(epoch(start_time) AS BIGINT)),
                               1, 15) AS BIGINT) AS shard_group,
           start_time,
           start_time + CASE WHEN rp = '7d' THEN INTERVAL 24 HOUR ELSE INTERVAL 168 HOUR END
             AS end_time,
           start_time + CASE WHEN rp = '7d' THEN INTERVAL 192 HOUR ELSE INTERVAL 168 HOUR END
             AS expiry_time,
           CAST(NULL AS VARCHAR) AS owners, n
    FROM (
      SELECT CASE WHEN event_type = 'error' THEN '7d' ELSE 'autogen' END AS rp,
             CAST(CASE WHEN event_type = 'error' THEN date_trunc('day', ts)
                       ELSE date_trunc('week', ts) END AS TIMESTAMP) AS start_time,
             count(*) AS n
      FROM events GROUP BY 1, 2) buckets
    """


@query(SHARDS_SQL)
def show_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir).select(
        F.lit("app").alias("db"),
        F.when(F.col("event_type") == "error", "7d").otherwise("autogen").alias("rp"),
        "time_ns",
    )
    return catalog.show_shards(points, POLICIES, "app")


@query(SHARDS_SQL)
def show_stored_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of a store, from the footers of its files."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app")
    points = event_points(spark, sf_dir)
    failed = F.col("event_type") == "error"
    store.append(points.where(~failed), EVENTS)
    store.append(points.where(failed), EVENTS, MeasurementRef("events", "7d"))
    return store.show_shards("app")


@query(
    """
    SELECT event_type, CAST(user_id AS VARCHAR) AS user_id, min(epoch_us(ts)) * 1000 AS first_ns,
           max(epoch_us(ts)) * 1000 AS last_ns, count(*) AS n_points
    FROM events WHERE NOT (event_type = 'click' AND user_id = 8) AND ts < TIMESTAMP '2024-01-22 00:00:00'
    GROUP BY 1, 2
    """
)
def show_stored_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series of a store after a delete and a dropped bucket, from its table of series."""
    store = Store(spark, fresh_path(spark, "store"), POLICIES, database="app", series_table=True)
    store.append(event_points(spark, sf_dir), EVENTS)
    store.delete(
        EVENTS, "events", lambda e: e.tag("event_type").equals.value("click").and_.tag("user_id").equals.value("8")
    )
    late = NanoTime.from_datetime(datetime(2024, 1, 22))
    for start in store.shard_starts("events"):
        if start * 10**9 >= int(late):
            store.drop_shard(shard_id_of("app", "autogen", start))
    return store.show_series("events")
