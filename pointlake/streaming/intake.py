"""A stream of raw points to checked lines and rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pointlake.functions.columns import ref
from pointlake.functions.lineformat import map_tag_pairs, series_key
from pointlake.functions.timecol import duration_ns
from pointlake.model import FieldType, MeasurementSchema, NanoTime, SchemaSet
from pointlake.operators.validate import check_lines
from pointlake.session import fresh_path
from pointlake.sinks.lines import mark_line_breaks
from pointlake.sinks.store import MeasurementRef, Store
from pointlake.streaming.batches import add_batch, before_batch, high_before, note_high, replaced, state_schema
from pointlake.streaming.downsample import interval_text

SENT = state_schema("sent", {"digest": FieldType.INTEGER}, ("series",), "sent")
SENT_REF = MeasurementRef("sent", "autogen", "sent")
SENT_FOLDS = {"digest": replaced}


def _without_repeats(good: DataFrame, number: int, sent: Store, keep: str, ordered: bool) -> DataFrame:
    """The last line of each series and time of a batch, if it is not the one that was sent last.

    What was sent is remembered by series and time, as a digest of the line, for points that are no more than
    ``keep`` behind the latest time of earlier batches; older ones count as new.
    """
    progress = f"{sent.root}/progress"
    high = high_before(sent, progress, number)
    oldest = None if high is None else high - duration_ns(keep)
    latest = F.max_by("line", F.struct("_order", "line")) if ordered else F.max("line")
    timed = good.filter("time_ns IS NOT NULL").groupBy("series", "time_ns").agg(latest.alias("line"))
    own = timed.select("time_ns", "series", "line", F.xxhash64("line").alias("digest"))
    recent = own if oldest is None else own.filter(F.col("time_ns") >= F.lit(oldest).cast("bigint"))
    if oldest is not None:
        sent.drop_before(SENT_REF, NanoTime(oldest))
    known = before_batch(sent.read_touched(recent, SENT, SENT_REF), number, SENT_FOLDS).select(
        "series", "time_ns", F.col("digest").alias("_sent")
    )
    if oldest is not None:
        known = known.filter(F.col("time_ns") >= F.lit(oldest).cast("bigint"))
    fresh = own.join(known, ["series", "time_ns"], "left").filter(~F.col("_sent").eqNullSafe(F.col("digest")))
    path = fresh_path(good.sparkSession, "fresh")
    fresh.select("line").unionByName(good.filter("time_ns IS NULL").select("line")).write.parquet(path)
    lines = good.sparkSession.read.schema("line STRING").parquet(path)
    add_batch(sent, recent.select("time_ns", "series", "digest"), number, SENT, SENT_REF, SENT_FOLDS)
    note_high(sent, progress, good, number, high, "time_ns")
    return lines


def stream_points(
    stream: DataFrame,
    schemas: SchemaSet | Sequence[MeasurementSchema],
    good_path: str,
    reject_path: str,
    checkpoint: str,
    name: str = "stream_points",
    precision: str = "n",
    database: str | None = None,
    every: str | None = None,
    sent: Store | None = None,
    keep: str = "1d",
    write_seq: str | None = None,
) -> StreamingQuery:
    """Map-form points checked as they arrive; good ones become lines, the others a
    table of ``line, reason``. Each batch writes directories of its own and overwrites
    them when it is repeated, so every point ends up in exactly one of them once.

    With ``sent``, a store of its own for what was sent, a point that arrives again gives no second
    line, and one whose fields have changed gives the new line. Of several writes of a point in one batch the
    last one counts: that with the largest ``write_seq``, a column of the stream, or else the
    largest line. Points further than ``keep`` behind earlier ones are forgotten, and count as new.
    """
    series = F.concat_ws("\n", F.coalesce("db", F.lit(database).cast("string")), "rp", series_key(F.col("measurement"), map_tag_pairs(F.col("tags"))))
    order = ref(write_seq) if write_seq else F.lit(None).cast("bigint")
    keys = stream.withColumns({"series": series, "_order": order}) if sent is not None else stream
    kept = ["series", "time_ns", "_order"] if sent is not None else []
    marked = mark_line_breaks(check_lines(keys, schemas, precision, database, keep=kept))

    def write(batch: DataFrame, number: int) -> None:
        # Checked once, into a table of the shared folder: a batch may be a whole backlog.
        spark = batch.sparkSession
        path = fresh_path(spark, "checked")
        failed = F.col("reason").isNotNull().alias("_failed")
        laid = batch.select("line", "reason", *kept, failed)
        laid.write.partitionBy("_failed").parquet(path)
        checked = spark.read.schema(laid.schema).parquet(path)
        good = checked.filter("NOT _failed")
        if sent is not None:
            good = _without_repeats(good, number, sent, keep, write_seq is not None)
        good.select(F.col("line").alias("value")).write.mode("overwrite").text(f"{good_path}/batch={number}")
        rejects = checked.filter("_failed").select("line", "reason")
        rejects.write.mode("overwrite").parquet(f"{reject_path}/batch={number}")

    writer = (
        marked.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval_text(every)).start()
