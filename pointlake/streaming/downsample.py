"""Standing downsampling, and recomputation of recent buckets."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pointlake.functions.columns import ref
from pointlake.functions.timecol import duration_ns, from_timestamp, to_timestamp
from pointlake.model import MeasurementSchema, NanoTime
from pointlake.operators.query import exact_mean, mean
from pointlake.sinks.store import MeasurementRef, Store


def interval_text(text: str) -> str:
    """A duration literal as Spark's interval text."""
    micros, rest = divmod(duration_ns(text), 1_000)
    if rest:
        raise ValueError(f"Streams work in microseconds; {text!r} is finer")
    return f"{micros} microseconds"


def windowed_mean(
    stream: DataFrame,
    field: str,
    every: str,
    by: Sequence[str] = (),
    watermark: str | None = "0s",
    time: str = "time_ns",
    scale: int | None = None,
) -> DataFrame:
    """Mean and count per bucket and tag set of a point stream, columns
    ``time_ns, <tags>, mean, n``."""
    timed = stream.withColumn("_at", to_timestamp(ref(time)))
    if watermark is not None:
        timed = timed.withWatermark("_at", interval_text(watermark))
    window = F.window("_at", interval_text(every))
    aggregated = timed.groupBy(window.alias("_window"), *[ref(t) for t in by]).agg(
        exact_mean(ref(field), scale).alias("mean"), F.count(F.lit(1)).alias("n")
    )
    start = F.unix_micros("_window.start") * F.lit(1_000).cast("bigint")
    return aggregated.select(start.alias("time_ns"), *[ref(t) for t in by], "mean", "n")


def continuous_downsample(
    stream: DataFrame,
    name: str,
    field: str,
    every: str,
    into: MeasurementRef,
    store: Store,
    schema: MeasurementSchema,
    checkpoint: str,
    watermark: str,
    resample_every: str | None = None,
    scale: int | None = None,
    time: str = "time_ns",
) -> StreamingQuery:
    """A named standing query: mean per bucket and tag set of ``schema``, kept up to date
    in a measurement of the store.

    Each micro-batch hands over the buckets it changed and updates them by series and
    time. A repeated batch writes the same values again, so a restart from the
    checkpoint loses and doubles nothing. The watermark bounds the state.
    """
    changed = windowed_mean(stream, field, every, schema.tag_names, watermark, time, scale)

    def update(batch: DataFrame, _: int) -> None:
        # The update reads the batch twice; keeping it avoids a second pass over the state.
        batch.persist()
        try:
            store.upsert(batch, schema, into)
        finally:
            batch.unpersist()

    writer = (
        changed.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(update)
    )
    if resample_every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval_text(resample_every)).start()


def resample(
    source: DataFrame,
    target: DataFrame,
    field: str,
    every: str,
    span: str,
    now: datetime | NanoTime,
    by: Sequence[str] = (),
    scale: int | None = None,
    time: str = "time_ns",
) -> DataFrame:
    """The target with its buckets of the last ``span`` recomputed from the source.

    Late points are taken up this way. The first recomputed bucket is the one that
    holds ``now - span``; it is recomputed whole.
    """
    start = F.lit(int(resample_start(every, span, now))).cast("bigint")
    fresh = mean(source.filter(ref(time) >= start), field, by, every, time, scale)
    kept = target.filter(F.col("time_ns") < start)
    return kept.select(fresh.columns).unionByName(fresh)


def resample_start(every: str, span: str, now: datetime | NanoTime) -> NanoTime:
    """Start of the bucket that holds ``now - span``."""
    moment = int(NanoTime.from_datetime(now) if isinstance(now, datetime) else now)
    first = moment - duration_ns(span)
    return NanoTime(first - first % duration_ns(every))


def resample_stream(
    arrivals: DataFrame,
    name: str,
    read_source: Callable[[NanoTime], DataFrame],
    field: str,
    every: str,
    span: str,
    resample_every: str | None,
    into: MeasurementRef,
    store: Store,
    schema: MeasurementSchema,
    checkpoint: str,
    clock: Callable[[], datetime],
    scale: int | None = None,
) -> StreamingQuery:
    """Recomputes the last ``span`` each time points have arrived, at most once per
    ``resample_every``, and puts the result in place of the target's span. ``read_source`` is given the
    start of the span, so it can read only the buckets from there on."""

    def update(_: DataFrame, __: int) -> None:
        start = resample_start(every, span, clock())
        recent = read_source(start)
        # In place of the whole span: a bucket whose points are gone goes too.
        store.replace_from(mean(recent, field, schema.tag_names, every, scale=scale), schema, into, start)

    writer = (
        arrivals.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(update)
    )
    if resample_every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval_text(resample_every)).start()


def with_time_ns(stream: DataFrame, time: str) -> DataFrame:
    """``time_ns`` from a timestamp column of a stream."""
    kind = stream.schema[time].dataType
    zone = stream.sparkSession.conf.get("spark.sql.session.timeZone")
    return stream.withColumn("time_ns", from_timestamp(ref(time), kind, zone))
