"""Queries on wide measurement tables: selection, filters, order, aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.functions.columns import ref, type_of
from pointlake.functions.exactsum import band_sums, merged_bands
from pointlake.functions.predicate import Where, parse_where
from pointlake.functions.timecol import bucket_start, duration_ns, now_ns
from pointlake.model import MeasurementSchema, NanoTime


def select_all(df: DataFrame, time: str = "time_ns") -> DataFrame:
    """All columns, time first."""
    return df.select(ref(time), *[ref(c) for c in df.columns if c != time])


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[ref(n) for n in names])


def where(df: DataFrame, condition: Where) -> DataFrame:
    return df.filter(parse_where(condition, df))


def since(
    df: DataFrame,
    span: str,
    now: datetime | NanoTime | None = None,
    time: str = "time_ns",
) -> DataFrame:
    """``time > now - span``. On a timestamp column the bound is a timestamp literal,
    so the filter reaches the file scan."""
    kind = type_of(df, time)
    span_ns = duration_ns(span)
    if isinstance(kind, T.IntegralType):
        return df.filter(ref(time) > now_ns(now) - F.lit(span_ns).cast("bigint"))
    if now is None:
        start = F.timestamp_add(
            "MICROSECOND", F.lit(-(span_ns // 1_000)).cast("bigint"), F.current_timestamp()
        )
        if isinstance(kind, T.TimestampNTZType):
            start = F.timestamp_add(
                "MICROSECOND", F.lit(-(span_ns // 1_000)).cast("bigint"), F.localtimestamp()
            )
        return df.filter(ref(time) > start)
    instant = NanoTime.from_datetime(now) if isinstance(now, datetime) else now
    return where(df, lambda e: e.field(time).gt.value(NanoTime(instant - span_ns)))


def latest(
    df: DataFrame, n: int, time: str = "time_ns", ties: Sequence[str] = ()
) -> DataFrame:
    """The latest ``n`` rows, newest first; ``ties`` settles equal times."""
    return df.orderBy(ref(time).desc(), *[ref(t).desc() for t in ties]).limit(n)


def order_groups(
    df: DataFrame, tags: Sequence[str], time: str = "time_ns", descending: bool = True
) -> DataFrame:
    """Rows by tag set, and by time inside each. The sort is range-partitioned on tags
    and time together, so a hot tag set spreads over many tasks."""
    at = ref(time).desc() if descending else ref(time).asc()
    return df.orderBy(*[ref(t).asc() for t in tags], at)


def bound_query(
    spark: SparkSession, text: str, params: Mapping[str, object], **tables: DataFrame
) -> DataFrame:
    """Spark SQL with named parameters (``:name``) and tables (``{name}``); parameters
    are literals of the plan and never part of the text."""
    return spark.sql(text, args=dict(params), **tables)


def run_all(
    spark: SparkSession, texts: Sequence[str], params: Mapping[str, object] | None = None,
    **tables: DataFrame,
) -> list[DataFrame]:
    """Several statements in one call, one result each."""
    return [bound_query(spark, text, params or {}, **tables) for text in texts]


def empty_measurement(spark: SparkSession, schema: MeasurementSchema) -> DataFrame:
    """What a query on a measurement without points gives: no rows, declared columns."""
    return spark.createDataFrame([], schema.struct_type)


def exact_mean(value: Column, scale: int | None = None) -> Column:
    """Mean of the non-NULL values. With ``scale``, for values that are known to have no
    more decimals, the sum runs on decimals of that scale, so the result does not depend
    on how the rows are spread over tasks; a value with more decimals, or too large for
    the type, makes the mean NULL instead of another number."""
    if scale is None:
        return F.avg(value)
    exact = value.try_cast(T.DecimalType(38, scale))
    whole = F.count_if(value.isNotNull() & ~F.coalesce(exact.cast("double") == value.cast("double"), F.lit(False))) == 0
    return F.when(whole, F.try_divide(F.try_sum(exact).cast("double"), F.count(value)))


def mean(
    df: DataFrame,
    field: str,
    by: Sequence[str] = (),
    every: str | None = None,
    time: str = "time_ns",
    scale: int | None = None,
    counted: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Mean per tag set, per time bucket, or both. Buckets are aligned to the epoch and
    half-open; empty buckets do not appear. Partial means are combined before the shuffle.

    With ``exact``, the sums are those of whole numbers (``functions.exactsum``): the mean of
    any doubles has the same bits however the rows are spread. That costs a second, small shuffle.
    """
    keys = [ref(t) for t in by]
    if every is not None:
        keys = [bucket_start(ref(time), duration_ns(every)).alias("time_ns"), *keys]
    if exact:
        names = (["time_ns"] if every is not None else []) + list(by)
        rows = [F.count(F.lit(1)).alias("_rows")]
        sums = band_sums(df, ref(field), keys, rows)
        merged = merged_bands(sums, names, [F.sum("_rows").alias("n")])
        return merged.select(*[ref(c) for c in names], "mean", *(["n"] if counted else []))
    measures = [exact_mean(ref(field), scale).alias("mean")]
    if counted:
        measures.append(F.count(F.lit(1)).alias("n"))
    return df.groupBy(*keys).agg(*measures)


def top(
    df: DataFrame,
    field: str,
    n: int,
    by: Sequence[str] = (),
    time: str = "time_ns",
    ties: Sequence[str] = (),
) -> DataFrame:
    """The ``n`` largest values per tag set with their own times; equal values go to the
    earliest time, then to the smallest ``ties``. Spark keeps only ``n`` rows per tag
    set and task before the shuffle (WindowGroupLimit); without tags it is a top-k sort."""
    present = df.filter(ref(field).isNotNull())
    order = [ref(field).desc(), ref(time).asc(), *[ref(t).asc() for t in ties]]
    if by:
        ranked = Window.partitionBy(*[ref(t) for t in by]).orderBy(*order)
        present = (
            present.withColumn("_rank", F.row_number().over(ranked))
            .filter(F.col("_rank") <= n)
        )
    else:
        present = present.orderBy(*order).limit(n)
    return present.select(*[ref(t) for t in by], ref(time), ref(field).alias("top"))
