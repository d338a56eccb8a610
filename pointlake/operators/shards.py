"""Time buckets of the store: (database, policy, start) with the policy's length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.functions.timecol import SECOND_NS, floor_div
from pointlake.model import WEEK_S, RetentionPolicy

Policies = DataFrame | Sequence[RetentionPolicy]

# Seconds from Monday 0001-01-01 to the epoch; bucket starts are counted from there,
# which makes week-long buckets start on Mondays.
ORIGIN_S = 62_135_596_800


def start_of(seconds: Column, shard_s: Column) -> Column:
    shift = F.pmod(F.lit(ORIGIN_S).cast("bigint"), shard_s)
    return seconds - F.pmod(seconds + shift, shard_s)


def shard_start_s(time_ns: Column, shard_s: int) -> Column:
    return start_of(floor_div(time_ns, SECOND_NS), F.lit(shard_s).cast("bigint"))


def shard_start_of(time_ns: int, shard_s: int) -> int:
    """The same on the driver, for a single instant."""
    seconds = time_ns // SECOND_NS
    return seconds - (seconds + ORIGIN_S) % shard_s


def shard_id(db: Column, rp: Column, start_s: Column) -> Column:
    """A number that depends on the bucket only, so ids stay the same when other
    buckets come and go, and no global ranking is needed. The text under the digest
    names the length of the database, so no two buckets share it."""
    digest = F.md5(F.concat_ws("/", F.length(db).cast("string"), db, rp, start_s.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def shard_id_of(db: str, rp: str, start_s: int) -> int:
    digest = hashlib.md5(f"{len(db)}/{db}/{rp}/{start_s}".encode()).hexdigest()
    return int(digest[:15], 16)


def is_under(policy: RetentionPolicy) -> Column:
    return (F.col("db") == policy.db) & (F.col("rp") == policy.name)


def _chosen(cases: Sequence[tuple[Column, Column]], default: Column) -> Column:
    out = default
    for condition, value in reversed(cases):
        out = F.when(condition, value).otherwise(out)
    return out


def with_policy(points: DataFrame, policies: Policies) -> DataFrame:
    """Adds ``duration_s`` and ``shard_s`` of each point's policy (defaults where the
    policy is unknown). Declared policies become expressions, so nothing is joined. A
    policy table is joined; the planner checks its size before it broadcasts it, and
    adaptive execution splits a hot (db, rp) otherwise."""
    forever, week = F.lit(0).cast("bigint"), F.lit(WEEK_S).cast("bigint")
    if not isinstance(policies, DataFrame):

        def looked_up(attribute: str, default: Column) -> Column:
            return _chosen(
                [(is_under(p), F.lit(getattr(p, attribute)).cast("bigint")) for p in policies],
                default,
            )

        return points.withColumns(
            {
                "duration_s": looked_up("duration_s", forever),
                "shard_s": looked_up("shard_s", week),
            }
        )
    known = policies.dropDuplicates(["db", "rp"])
    known = known.select("db", "rp", "duration_s", "shard_s")
    return points.join(known, ["db", "rp"], "left").withColumns(
        {
            "duration_s": F.coalesce("duration_s", forever),
            "shard_s": F.coalesce("shard_s", week),
        }
    )


def with_default_policy(points: DataFrame, policies: Policies) -> DataFrame:
    """Adds ``default_rp``, the default policy of each point's database."""
    if isinstance(policies, DataFrame):
        chosen = policies.filter("is_default").groupBy("db")
        return points.join(chosen.agg(F.min("rp").alias("default_rp")), "db", "left")
    cases = [
        (F.col("db") == db, F.lit(rp)) for db, rp in defaults_by_database(policies).items()
    ]
    return points.withColumn("default_rp", _chosen(cases, F.lit(None).cast("string")))


def defaults_by_database(policies: Iterable[RetentionPolicy]) -> dict[str, str]:
    chosen: dict[str, str] = {}
    for policy in policies:
        if policy.is_default:
            if chosen.setdefault(policy.db, policy.name) != policy.name:
                raise ValueError(f"Database {policy.db!r} has two default policies")
    return chosen
