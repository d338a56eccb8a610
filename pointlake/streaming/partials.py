"""Standing means that take up points however late they are.

Each batch is summed up by bucket and tag set into exact sums (``functions.exactsum``), which are
added to a state in the store, beside the target. The buckets of the batch are then the dirty
ones: their means are formed again from the state, not from the points, and no other bucket is
read. No stream state and no watermark is needed for that; a watermark only says which points
count as late, and these are kept in a table of their own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pointlake.functions.columns import ref
from pointlake.functions.exactsum import BAND, DIGITS, SPECIAL, STATE, band_sums, merged_bands
from pointlake.functions.timecol import bucket_start, duration_ns
from pointlake.model import FieldType, MeasurementSchema, NanoTime
from pointlake.session import fresh_path
from pointlake.sinks.store import MeasurementRef, Store
from pointlake.streaming.batches import add_batch, added, current, high_before, note_high, state_schema
from pointlake.streaming.downsample import interval_text

ROWS = "_rows"
VALUES = {
    **{c: FieldType.INTEGER for c in STATE}, SPECIAL: FieldType.FLOAT, ROWS: FieldType.INTEGER,
}
FOLDS = {c: added for c in VALUES}


def partials_schema(schema: MeasurementSchema) -> MeasurementSchema:
    """The state of a target: sums for each of its points and each band of exponents."""
    return state_schema(f"{schema.measurement}_partials", VALUES, (*schema.tag_names, BAND), schema.database)


def partials_of(into: MeasurementRef) -> MeasurementRef:
    return MeasurementRef(f"{into.name}_partials", into.policy, into.db)


def add_points(
    store: Store, points: DataFrame, number: int, field: str, every: str, schema: MeasurementSchema,
    into: MeasurementRef, time: str = "time_ns",
) -> None:
    """Adds the points of a batch to the state and forms the means of their buckets again.

    ``schema`` is the target's: a field ``mean`` and, if wanted, ``n``, the number of points.
    Points without time belong to no bucket and are passed over.
    """
    spark, tags = points.sparkSession, list(schema.tag_names)
    timed = points.filter(ref(time).isNotNull())
    keys = [bucket_start(ref(time), duration_ns(every)).alias("time_ns"), *[ref(t).cast("string").alias(t) for t in tags]]
    sums = band_sums(timed, ref(field), keys, [F.count(F.lit(1)).alias(ROWS)]).withColumn(BAND, F.col(BAND).cast("string"))
    path = fresh_path(spark, "batch-sums")
    sums.write.parquet(path)
    batch = spark.read.schema(sums.schema).parquet(path)
    state, place = partials_schema(schema), partials_of(into)
    add_batch(store, batch, number, state, place, FOLDS)
    dirty = batch.select("time_ns", *[ref(t) for t in tags]).distinct()
    means = means_of(store, schema, into, dirty)
    store.upsert(means, schema, into)


def means_of(
    store: Store, schema: MeasurementSchema, into: MeasurementRef, dirty: DataFrame | None = None
) -> DataFrame:
    """The means that the state holds, of all buckets or of the dirty ones ``time_ns, <tags>``."""
    state, place = partials_schema(schema), partials_of(into)
    names = ["time_ns", *schema.tag_names]
    if dirty is None:
        stored = store.read(place, state)
    else:
        stored = store.read_touched(dirty, state, place)
        same = F.lit(True)
        wanted = dirty.select(*[ref(c).alias(f"_dirty_{i}") for i, c in enumerate(names)])
        for i, c in enumerate(names):
            same = same & ref(c).eqNullSafe(F.col(f"_dirty_{i}"))
        stored = stored.join(wanted, same, "left_semi")
    sums = current(stored, FOLDS).withColumn(BAND, F.col(BAND).cast("int"))
    counted = merged_bands(sums, names, [F.sum(ROWS).alias("n")])
    fields = [f for f in ("mean", "n") if f in schema.fields]
    return counted.select(*[ref(c) for c in names], *fields)


# -- late points -------------------------------------------------------------------------


def keep_late(
    store: Store, points: DataFrame, number: int, every: str, watermark: str, late_path: str, time: str = "time_ns"
) -> None:
    """Writes the points whose bucket had ended ``watermark`` before the latest time of all
    earlier batches, with ``behind_ns``, how far; a repeated batch writes the same directory."""
    high = high_before(store, f"{late_path}/progress", number)
    step = duration_ns(every)
    if high is None:
        late = points.filter(F.lit(False)).withColumn("behind_ns", F.lit(0).cast("bigint"))
    else:
        limit = F.lit(high - duration_ns(watermark)).cast("bigint")
        behind = limit - (bucket_start(ref(time), step) + F.lit(step).cast("bigint"))
        late = points.withColumn("behind_ns", behind).filter("behind_ns >= 0")
    late.write.mode("overwrite").parquet(f"{late_path}/points/batch={number}")
    note_high(store, f"{late_path}/progress", points, number, high, time)


def late_points(spark: SparkSession, late_path: str, schema: T.StructType) -> DataFrame:
    """All late points with ``behind_ns`` and their ``batch``."""
    kind = T.StructType([*schema.fields, T.StructField("behind_ns", T.LongType()), T.StructField("batch", T.LongType())])
    return spark.read.schema(kind).parquet(f"{late_path}/points")


def standing_mean(
    stream: DataFrame,
    name: str,
    field: str,
    every: str,
    into: MeasurementRef,
    store: Store,
    schema: MeasurementSchema,
    checkpoint: str,
    late_path: str | None = None,
    watermark: str = "0s",
    resample_every: str | None = None,
    time: str = "time_ns",
) -> StreamingQuery:
    """A named standing query: the mean of every bucket and tag set of ``schema``, kept right
    in a measurement of the store for all points that ever arrive.

    With ``late_path``, points that arrive behind the ``watermark`` are kept there too, to be
    counted or looked at; they are in the means like all others. A repeated batch changes nothing.
    """

    def update(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if late_path is not None:
                keep_late(store, batch, number, every, watermark, late_path, time)
            add_points(store, batch, number, field, every, schema, into, time)
        finally:
            batch.unpersist()

    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(update)
    if resample_every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval_text(resample_every)).start()


def forget_before(store: Store, into: MeasurementRef, moment: datetime | NanoTime) -> None:
    """Removes the state of the store's buckets that end by ``moment``: points from before start
    their bucket anew. The target keeps its points."""
    limit = int(NanoTime.from_datetime(moment) if isinstance(moment, datetime) else moment)
    store.drop_before(partials_of(into), NanoTime(limit))
