"""Deletes, retention and updates as points-to-points operators.

Each keeps or merges rows; ``sinks.store`` applies the same rules to stored
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.functions.columns import ref
from pointlake.functions.predicate import Where, parse_where
from pointlake.functions.timecol import SECOND_NS, floor_div, now_ns
from pointlake.operators.shards import (
    Policies,
    is_under,
    shard_id,
    start_of,
    with_default_policy,
    with_policy,
)


def keep_unless(df: DataFrame, dropped: Column) -> DataFrame:
    """Rows for which the condition is not true; an unknown condition keeps the row."""
    return df.filter(~F.coalesce(dropped, F.lit(False)))


def drop_series(
    points: DataFrame,
    measurement: str | None = None,
    where: Where | None = None,
    db: str | None = None,
) -> DataFrame:
    if measurement is None and where is None:
        raise ValueError("Name a measurement, a condition, or both")
    dropped = F.lit(True)
    if where is not None:
        dropped = dropped & parse_where(where, points)
    if measurement is not None:
        dropped = dropped & (F.col("measurement") == measurement)
    if db is not None:
        dropped = dropped & (F.col("db") == db)
    return keep_unless(points, dropped)


def drop_measurement(points: DataFrame, measurement: str, db: str | None = None) -> DataFrame:
    return drop_series(points, measurement, db=db)


def drop_database(points: DataFrame, db: str) -> DataFrame:
    return keep_unless(points, F.col("db") == db)


def drop_retention_policy(points: DataFrame, db: str, rp: str) -> DataFrame:
    """A dropped policy takes its points with it."""
    return keep_unless(points, (F.col("db") == db) & (F.col("rp") == rp))


def drop_shard(points: DataFrame, policies: Policies, number: int) -> DataFrame:
    """Points outside the bucket of that id. The id is computed per row from the
    bucket, so nothing is shuffled and the points are read once."""
    placed = with_policy(points, policies)
    start = start_of(floor_div(F.col("time_ns"), SECOND_NS), F.col("shard_s"))
    kept = keep_unless(placed, shard_id(F.col("db"), F.col("rp"), start) == F.lit(number))
    return kept.select(*[ref(c) for c in points.columns])


def apply_retention(
    points: DataFrame, policies: Policies, now: datetime | int | None = None
) -> DataFrame:
    """Points that their policy still keeps at ``now``; duration 0 keeps forever.

    Declared policies give a plain filter on ``db``, ``rp`` and ``time_ns``, which
    prunes stored partitions; a policy table is joined.
    """
    moment = now_ns(now)
    if not isinstance(policies, DataFrame):
        expired = F.lit(False)
        for policy in policies:
            if policy.duration_s:
                span = F.lit(policy.duration_s * SECOND_NS).cast("bigint")
                expired = expired | (is_under(policy) & (F.col("time_ns") < moment - span))
        return keep_unless(points, expired)
    placed = with_policy(points, policies)
    oldest = moment - F.col("duration_s") * F.lit(SECOND_NS).cast("bigint")
    expired = (F.col("duration_s") > 0) & (F.col("time_ns") < oldest)
    return keep_unless(placed, expired).select(*[ref(c) for c in points.columns])


def route_default_policy(points: DataFrame, policies: Policies) -> DataFrame:
    """Points without a policy take their database's default one."""
    routed = with_default_policy(points, policies).withColumn(
        "rp", F.coalesce("rp", "default_rp")
    )
    return routed.select(*[ref(c) for c in points.columns])


def upsert_points(
    existing: DataFrame,
    incoming: DataFrame,
    tags: Sequence[str],
    fields: Sequence[str],
    write_seq: str | None = None,
    time: str = "time_ns",
) -> DataFrame:
    """Points merged by series and time: per field the last written value wins, a field
    the newer point does not carry keeps its old value.

    ``existing`` counts as written first. ``write_seq`` names a column of ``incoming``
    that orders its writes (default: one write); of equal writes the largest value wins.
    Copies of a point are combined before the shuffle, so a key written very often
    sends one row per task.
    """
    keys = [ref(t) for t in tags] + [ref(time)]
    columns = [*tags, time, *fields]

    def numbered(df: DataFrame, seq: Column) -> DataFrame:
        have = [ref(c) for c in columns if c in df.columns]
        return df.select(*have, seq.cast("bigint").alias("_seq"))

    first = numbered(existing, F.lit(0))
    later = numbered(incoming, ref(write_seq) if write_seq else F.lit(1))
    merged = first.unionByName(later, allowMissingColumns=True)

    def last_value(name: str) -> Column:
        value = ref(name)
        if write_seq is None:
            # Two writes only: plain maxima, which hash aggregation can hold.
            newer = F.max(F.when(F.col("_seq") == 1, value))
            return F.coalesce(newer, F.max(F.when(F.col("_seq") == 0, value)))
        present = F.when(value.isNotNull(), F.struct(F.col("_seq"), value.alias("v")))
        return F.max(present)["v"]

    return merged.groupBy(*keys).agg(*[last_value(f).alias(f) for f in fields])
