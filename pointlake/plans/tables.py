"""The test tables as points, and SQL text the checks share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pointlake.functions.timecol import to_timestamp_ntz
from pointlake.model import FieldType, MeasurementSchema, RetentionPolicy
from pointlake.sources.tables import points_from_table

EVENTS = MeasurementSchema(
    "events",
    {"value": FieldType.FLOAT, "k": FieldType.INTEGER},
    ("event_type", "user_id"),
    database="app",
)
ORDERS = MeasurementSchema(
    "orders",
    {"o_totalprice": FieldType.FLOAT, "o_orderkey": FieldType.INTEGER},
    ("o_orderstatus", "o_orderpriority"),
    database="sales",
)
POLICIES = (
    RetentionPolicy("app", "autogen", is_default=True),
    RetentionPolicy("app", "7d", duration_s=7 * 86_400, shard_s=86_400),
    RetentionPolicy("sales", "autogen", is_default=True),
)

# Means are compared to six decimals, as the order of a sum moves the last ones.
MEAN_SQL = "round(avg(value), 6)"
K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
VALUE_TEXT_SQL = r"regexp_replace(CAST(value AS VARCHAR), '\.0$', '')"
POINTS_SQL = f"""
SELECT 'events' AS measurement, event_type, CAST(user_id AS VARCHAR) AS user_id, value,
       {K_SQL} AS k, epoch_us(ts) * 1000 AS time_ns
FROM events
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of_props():
    return F.get_json_object("props", "$.k").cast("bigint")


def event_points(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """``events`` in the wide form."""
    events = table(spark, sf_dir, "events").withColumn("k", k_of_props())
    return points_from_table(
        events, "events", EVENTS.tags, ["value", "k"], "ts", schema=EVENTS, keep=keep
    )


def order_points(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return points_from_table(
        orders, "orders", ORDERS.tags, ["o_totalprice", "o_orderkey"], "o_orderdate",
        schema=ORDERS, keep=keep,
    )


def rounded_mean(df: DataFrame) -> DataFrame:
    return df.withColumn("mean", F.round("mean", 6))


def with_wall_time(df: DataFrame) -> DataFrame:
    """``time_ns`` as a ``time`` without zone."""
    others = [c for c in df.columns if c != "time_ns"]
    return df.select(to_timestamp_ntz(F.col("time_ns")).alias("time"), *others)
