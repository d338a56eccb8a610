"""State that batches of a stream add to, where a repeated batch changes nothing.

A row of the state holds its values before the last batch that touched it, what that batch
brought, and the batch's number. The next batch folds the two together and brings its own; the
same batch once more only brings its own again. So a batch that was cut off after any part of its
rows were written can be repeated whole, which is all that a stream ever does. The state
belongs to one checkpoint: batch numbers of another stream mean other batches.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.functions.columns import ref
from pointlake.model import FieldType, MeasurementSchema
from pointlake.sinks.store import MeasurementRef, Store

Fold = Callable[[Column, Column], Column]
BATCH = "batch"


def added(before: Column, brought: Column) -> Column:
    return F.when(before.isNull(), brought).otherwise(before + F.coalesce(brought, F.lit(0)))


def replaced(before: Column, brought: Column) -> Column:
    return F.coalesce(brought, before)


def state_schema(
    name: str, values: Mapping[str, FieldType], tags: tuple[str, ...], database: str | None
) -> MeasurementSchema:
    """A measurement with two columns for each value, and the number of the last batch."""
    fields = {f"{stage}_{v}": kind for v, kind in values.items() for stage in ("before", "brought")}
    return MeasurementSchema(name, {**fields, BATCH: FieldType.INTEGER}, tags, database)


def add_batch(
    store: Store,
    batch: DataFrame,
    number: int,
    schema: MeasurementSchema,
    target: MeasurementRef,
    folds: Mapping[str, Fold],
) -> None:
    """Adds the rows of a batch, one for each time and tag set, to the state in the store.
    Only the store's buckets that the batch falls into are read and rewritten."""
    keys = ["time_ns", *schema.tag_names]
    brought = batch.select(
        *[ref(k) for k in keys], *[ref(v).alias(f"brought_{v}") for v in folds], F.lit(number).cast("bigint").alias(BATCH)
    )

    def fold(stored: DataFrame, incoming: DataFrame) -> DataFrame:
        names = [f"{stage}_{v}" for v in folds for stage in ("before", "brought")]
        sides = [
            side.select(*[ref(k) for k in keys], F.struct(*[ref(n) for n in names], F.col(BATCH)).alias(name))
            for side, name in ((stored, "_old"), (incoming, "_new"))
        ]
        rows = sides[0].unionByName(sides[1], allowMissingColumns=True)
        # One row of either side: tags may be NULL, which a grouping takes as a value.
        rows = rows.groupBy(*[ref(k) for k in keys]).agg(
            F.first("_old", ignorenulls=True).alias("_old"), F.first("_new", ignorenulls=True).alias("_new")
        )
        old, new = F.col("_old"), F.col("_new")
        again = old[BATCH] == new[BATCH]
        out = []
        for v, how in folds.items():
            settled = how(old[f"before_{v}"], old[f"brought_{v}"])
            before = F.when(new.isNull() | again, old[f"before_{v}"]).otherwise(settled)
            out += [before.alias(f"before_{v}"), F.when(new.isNull(), old[f"brought_{v}"]).otherwise(new[f"brought_{v}"]).alias(f"brought_{v}")]
        return rows.select(*[ref(k) for k in keys], *out, F.coalesce(new[BATCH], old[BATCH]).alias(BATCH))

    store.merge(brought, schema, target, fold)


def current(state: DataFrame, folds: Mapping[str, Fold]) -> DataFrame:
    """The state's values after all batches."""
    values = [how(ref(f"before_{v}"), ref(f"brought_{v}")).alias(v) for v, how in folds.items()]
    kept = [c for c in state.columns if c != BATCH and not c.startswith(("before_", "brought_"))]
    return state.select(*[ref(c) for c in kept], *values)


def before_batch(state: DataFrame, number: int, folds: Mapping[str, Fold]) -> DataFrame:
    """The state's values as they were before a batch, whether or not it was added already."""
    own = F.col(BATCH) == number
    values = [
        F.when(own, ref(f"before_{v}")).otherwise(how(ref(f"before_{v}"), ref(f"brought_{v}"))).alias(v)
        for v, how in folds.items()
    ]
    kept = [c for c in state.columns if c != BATCH and not c.startswith(("before_", "brought_"))]
    return state.select(*[ref(c) for c in kept], *values)


# -- how far the batches have come -------------------------------------------------------


def high_before(store: Store, folder: str, number: int) -> int | None:
    """The latest time of all batches before this one; what lies further back is cleared away,
    as at most one batch is ever repeated."""
    batches = sorted(int(n.removeprefix("batch=")) for n in store.children(folder, "batch="))
    earlier = [b for b in batches if b < number]
    if not earlier:
        return None
    row = store.spark.read.schema("high bigint").parquet(f"{folder}/batch={earlier[-1]}").first()
    for old in earlier[:-2]:
        store.remove(f"{folder}/batch={old}")
    return row.high


def note_high(store: Store, folder: str, points: DataFrame, number: int, before: int | None, time: str) -> None:
    """Notes the latest time up to and with this batch."""
    high = points.agg(F.max(ref(time)).alias("high")).select(
        F.greatest(F.col("high"), F.lit(before).cast("bigint")).alias("high")
    )
    high.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={number}")
