"""Places of rows within their key, without gathering a key in one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pointlake.llm.common import ready_workers, written

PLACE, PART = "__place", "__part"


def numbered(df: DataFrame, key: str, order: Sequence[str | Column], name: str, place: str = "place") -> DataFrame:
    """``df`` with ``place``: the 0-based place of a row among the rows of its key, in this order.

    ``key`` is a whole number without nulls. Rows are sorted over all tasks by key and order, so
    a key of any size is spread over tasks; every task counts its own rows, and only keys that
    run on from an earlier task get an offset: one row for each task at most. Equal rows are
    told apart by where they were read, so a row repeated without end is split as well.
    """
    ready_workers(df.sparkSession)
    by = [F.col(key).asc(), *order, F.col("__read").asc()]
    ranged = (
        df.withColumn("__read", F.monotonically_increasing_id())
        .repartitionByRange(*by).sortWithinPartitions(*by).drop("__read")
    )
    schema = T.StructType([*df.schema.fields, T.StructField(PLACE, T.LongType()), T.StructField(PART, T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = np.asarray(batch.column(key)).astype(np.int64)
            starts = np.r_[True, keys[1:] != keys[:-1]]
            first = np.flatnonzero(starts)
            places = np.arange(n) - np.repeat(first, np.diff(np.r_[first, n]))
            if keys[0] == last:
                places[: first[1] if len(first) > 1 else n] += seen
            last, seen = keys[-1], places[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places, pa.int64()), pa.array(np.full(n, part), pa.int64())],
                names=[*batch.schema.names, PLACE, PART],
            )

    counted = written(ranged.mapInArrow(count, schema), name)
    earlier = Window.partitionBy(key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    runs_on = (
        counted.groupBy(key, PART).agg(F.count("*").alias("__rows"))
        .select(key, PART, F.sum("__rows").over(earlier).alias("__offset")).where("__offset > 0")
    )
    # A task starts with one key, so no task has more than one row here.
    return (
        counted.join(F.broadcast(runs_on), [key, PART], "left")
        .select(*df.columns, (F.col(PLACE) + F.coalesce("__offset", F.lit(0))).alias(place))
    )
