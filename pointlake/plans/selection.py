"""Selections and filters."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.timecol import to_precision
from pointlake.operators.query import (
    bound_query,
    latest,
    order_groups,
    run_all,
    select_all as all_columns,
    select_columns,
    since,
    where,
)
from pointlake.model import FieldType, MeasurementSchema
from pointlake.operators.results import group, split_results
from pointlake.plans.registry import query
from pointlake.plans.tables import event_points, table
from pointlake.session import fresh_path
from pointlake.sinks.store import Store


@query(
    """
    SELECT event_id, ts, user_id, value FROM events WHERE event_type = 'click'
    ORDER BY ts DESC, event_id DESC LIMIT 10
    """
)
def latest_by_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = where(
        table(spark, sf_dir, "events"), lambda e: e.tag("event_type").equals.value("click")
    )
    newest = latest(clicks, 10, "ts", ties=["event_id"])
    return select_columns(newest, "event_id", "ts", "user_id", "value")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def select_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_columns(table(spark, sf_dir, "events"), "ts")


@query("SELECT ts, event_type, value FROM events")
def select_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_columns(table(spark, sf_dir, "events"), "ts", "event_type", "value")


@query("SELECT epoch_us(ts) * 1000 AS time_ns, value FROM events WHERE event_type = 'refund'")
def select_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements nobody wrote give no rows and no error: here one looked for among the
    points, each event type being a measurement, and one looked for in a store that holds
    only the others."""
    points = event_points(spark, sf_dir)
    named = points.withColumn("measurement", F.col("event_type"))
    looked_for = where(named, lambda e: e.tag("measurement").equals.value("refund"))
    store = Store(spark, fresh_path(spark, "store"), database="app")
    stored = store.read("refund", MeasurementSchema("refund", {"value": FieldType.FLOAT}))
    return looked_for.select("time_ns", "value").unionByName(stored)


@query("SELECT event_id FROM events WHERE event_type = 'click' AND user_id = 8")
def where_tag_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = where(
        table(spark, sf_dir, "events"),
        lambda e: e.tag("event_type").equals.value("click").and_.tag("user_id").equals.value("8"),
    )
    return found.select("event_id")


@query("SELECT event_id FROM events WHERE ts = (SELECT max(ts) FROM events)")
def where_time_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    newest = events.agg(F.max("ts")).first()[0]
    return where(events, lambda e: e.field("ts").equals.value(newest)).select("event_id")


@query(
    """
    SELECT event_id, ts, value FROM events
    WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 36 HOUR AND value >= 12
    """
)
def where_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = since(table(spark, sf_dir, "events"), "36h", datetime(2024, 1, 30), "ts")
    found = where(recent, lambda e: e.field("value").gte.value(12))
    return found.select("event_id", "ts", "value")


@query(
    """
    SELECT event_id, event_type FROM events
    WHERE regexp_matches(event_type, '^(cl|vi)') AND NOT regexp_matches(event_type, 'k$')
    """
)
def where_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = where(
        table(spark, sf_dir, "events"),
        lambda e: e.tag("event_type")
        .matches.value(re.compile("^(cl|vi)"))
        .and_.tag("event_type")
        .doesnt_match.value(re.compile("k$")),
    )
    return found.select("event_id", "event_type")


@query(
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_extendedprice * (1 - l_discount) > 30000
       OR (l_quantity + l_tax >= 50 AND l_returnflag <> 'N')
    """
)
def where_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = where(
        table(spark, sf_dir, "lineitem"),
        lambda e: e.field("l_extendedprice")
        .times.exp(lambda d: d.value(1).minus.field("l_discount"))
        .gt.value(30000)
        .or_.exp(
            lambda d: d.field("l_quantity")
            .plus.field("l_tax")
            .gte.value(50)
            .and_.tag("l_returnflag")
            .not_equal.value("N")
        ),
    )
    return found.select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_returnflag = 'R') = TRUE")
def where_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    found = where(items, lambda e: e.field("returned").equals.value(True))
    return found.select("l_orderkey", "l_linenumber")


@query(
    """
    SELECT event_id FROM events
    WHERE event_type = 'click' OR (event_type = 'view' AND value >= 50)
    """
)
def where_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = where(
        table(spark, sf_dir, "events"),
        lambda e: e.tag("event_type")
        .equals.value("click")
        .or_.exp(
            lambda d: d.tag("event_type").equals.value("view").and_.field("value").gte.value(50)
        ),
    )
    return found.select("event_id")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity = l_linenumber")
def where_col_eq_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = where(
        table(spark, sf_dir, "lineitem"),
        lambda e: e.field("l_quantity").equals.field("l_linenumber"),
    )
    return found.select("l_orderkey", "l_linenumber")


@query(
    """
    SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_extendedprice / l_quantity < 1000 AND l_quantity <= 10 AND l_discount > 0.02
      AND l_tax < 0.06
    """
)
def where_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = where(
        table(spark, sf_dir, "lineitem"),
        lambda e: e.field("l_extendedprice")
        .div.field("l_quantity")
        .lt.value(1000)
        .and_.field("l_quantity")
        .lte.value(10)
        .and_.field("l_discount")
        .gt.value(0.02)
        .and_.field("l_tax")
        .lt.value(0.06),
    )
    return found.select("l_orderkey", "l_linenumber")


@query("SELECT event_id FROM events WHERE event_type = 'click' AND value >= 12")
def where_placeholders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bound_query(
        spark,
        "SELECT event_id FROM {events} WHERE event_type = :kind AND value >= :minimum",
        {"kind": "click", "minimum": 12},
        events=table(spark, sf_dir, "events"),
    )


@query(
    """
    SELECT CAST(0 AS BIGINT) AS result_index, event_id FROM events WHERE event_type = 'click'
    UNION ALL
    SELECT CAST(1 AS BIGINT), event_id FROM events WHERE event_type = 'view'
    """
)
def multi_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = run_all(
        spark,
        [
            "SELECT event_id FROM {events} WHERE event_type = 'click'",
            "SELECT event_id FROM {events} WHERE event_type = 'view'",
        ],
        events=table(spark, sf_dir, "events"),
    )

    def numbered(df: DataFrame, index: int) -> DataFrame:
        return df.select(F.lit(index).cast("bigint").alias("result_index"), "event_id")

    # One table of both results, split again into a table per statement.
    flat = numbered(first, 0).unionByName(numbered(second, 1))
    clicks, views = split_results(flat, 2)
    return numbered(clicks, 0).unionByName(numbered(views, 1))


@query("SELECT event_id, value FROM events WHERE event_type = 'view' AND user_id = 8")
def group_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    found = group(points, ["event_type", "user_id"], {"event_type": "view", "user_id": "8"})
    return found.select("event_id", "value")


@query("SELECT event_id, epoch_us(ts) // 1000 AS time, value FROM events")
def query_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir, keep=["event_id"])
    return points.select("event_id", to_precision(F.col("time_ns"), "ms").alias("time"), "value")


@query("SELECT event_type, user_id, epoch_us(ts) * 1000 AS time_ns, value FROM events")
def ordered_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = event_points(spark, sf_dir).withColumn("user_id", F.col("user_id").cast("bigint"))
    ordered = order_groups(points, ["event_type", "user_id"])
    return ordered.select("event_type", "user_id", "time_ns", "value")
