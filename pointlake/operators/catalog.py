"""Listings: databases, measurements, series, policies and time buckets.

All are aggregates with a map-side part: what is shuffled is the distinct set, not
the points.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlake.functions.columns import ref, type_of
from pointlake.functions.lineformat import map_tag_pairs, series_key, wide_tag_pairs
from pointlake.functions.text import scalar_text
from pointlake.functions.timecol import SECOND_NS, duration_text, floor_div, to_timestamp_ntz
from pointlake.operators.shards import (
    Policies,
    shard_id,
    start_of,
    with_policy,
)


def _in_database(points: DataFrame, db: str | None) -> DataFrame:
    return points if db is None else points.filter(F.col("db") == db)


def show_databases(points: DataFrame) -> DataFrame:
    return points.select(F.col("db").alias("name")).distinct().orderBy("name")


def show_measurements(points: DataFrame, db: str | None = None) -> DataFrame:
    chosen = _in_database(points, db).select(F.col("measurement").alias("name"))
    return chosen.distinct().orderBy("name")


def show_series(
    points: DataFrame, db: str | None = None, measurement: str | None = None
) -> DataFrame:
    """Distinct series keys of map-form points."""
    chosen = _in_database(points, db)
    if measurement is not None:
        chosen = chosen.filter(F.col("measurement") == measurement)
    # The count is used, so the optimizer keeps this aggregate: keys are printed per series.
    distinct = chosen.groupBy("measurement", "tags").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    key = series_key(F.col("measurement"), map_tag_pairs(F.col("tags")))
    return distinct.select(key.alias("key")).distinct().orderBy("key")


def table_series(df: DataFrame, measurement: str, tags: Sequence[str]) -> DataFrame:
    """Distinct series keys of a wide table: the tag columns are made distinct first,
    keys are printed once per series."""
    distinct = df.select(*[ref(t) for t in tags]).distinct()
    texts = {t: scalar_text(ref(t), type_of(df, t)) for t in tags}
    key = series_key(F.lit(measurement), wide_tag_pairs(texts))
    return distinct.select(key.alias("key"))


def show_retention_policies(policies: DataFrame, db: str) -> DataFrame:
    """The policies of a database; ``policy_table`` makes the table of declared ones."""
    return policies.filter(F.col("db") == db).select(
        F.col("rp").alias("name"),
        duration_text(F.col("duration_s")).alias("duration"),
        duration_text(F.col("shard_s")).alias("shardGroupDuration"),
        F.col("replica_n").alias("replicaN"),
        F.col("is_default").alias("default"),
    )


def show_shards(points: DataFrame, policies: Policies, db: str | None = None) -> DataFrame:
    """Time buckets that hold points, with their number of points.

    Needs ``db, rp, time_ns``. A bucket expires its policy's duration after its end;
    an endless policy's bucket shows its end.
    """
    chosen = _in_database(points, db).select("db", "rp", "time_ns")
    placed = with_policy(chosen, policies)
    start = start_of(floor_div(F.col("time_ns"), SECOND_NS), F.col("shard_s"))
    buckets = placed.groupBy(
        "db", "rp", "shard_s", "duration_s", start.alias("start_s")
    ).agg(F.count(F.lit(1)).alias("n"))
    return shard_listing(buckets)


def shard_listing(buckets: DataFrame) -> DataFrame:
    """The listing of buckets ``db, rp, shard_s, duration_s, start_s, n``."""
    end = F.col("start_s") + F.col("shard_s")

    def wall(seconds):
        return to_timestamp_ntz(seconds * F.lit(SECOND_NS).cast("bigint"))

    number = shard_id(F.col("db"), F.col("rp"), F.col("start_s"))
    return buckets.select(
        number.alias("id"),
        F.col("db").alias("database"),
        F.col("rp").alias("retention_policy"),
        number.alias("shard_group"),
        wall(F.col("start_s")).alias("start_time"),
        wall(end).alias("end_time"),
        wall(end + F.col("duration_s")).alias("expiry_time"),
        F.lit(None).cast("string").alias("owners"),
        "n",
    )
