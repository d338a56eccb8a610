"""What the text operators share: tables, batches, written intermediate tables, id ranges."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pointlake
from pointlake.session import fresh_path

# Words are runs of anything but ASCII white space.
WORD_BREAK = r"[\x20\x09-\x0D]+"
OTHER_SPACES = "\t\n\x0b\x0c\r"

# Documents per batch that a Python worker holds at a time; a batch also ends at the bytes.
BATCH_ROWS = 1_000
BATCH_BYTES = 4 << 20
# Documents per range of ids (see id_ranges).
RANGE_ROWS = 4_000
# Ranges are found with this relative error of a range's rank.
RANGE_ERROR = 0.05
# Bits of a map of keys at most (see likely).
MAP_BITS = 27


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ready_workers(spark: SparkSession) -> None:
    """Sends this package to the Python workers and bounds what they receive at once.

    The bounds hold for the session's later jobs.
    """
    if spark.sparkContext.applicationId not in _shipped:
        _shipped.add(spark.sparkContext.applicationId)
        top = Path(pointlake.__file__).resolve().parent
        folder = tempfile.mkdtemp()  # the driver's own; Spark serves the file to the executors
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(f"{folder}/pointlake.zip", "w") as archive:
            for file in sorted(top.rglob("*.py")):
                archive.write(file, file.relative_to(top.parent))
        spark.sparkContext.addPyFile(f"{folder}/pointlake.zip")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def likely(rows: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys are ``wanted`` and a few others, so that a join need not shuffle all rows: each wanted
    key sets a bit of a map that goes to all tasks, at most 2 ** MAP_BITS bits however many keys there are."""
    bits = min(MAP_BITS, max(15, (32 * wanted.count()).bit_length()))
    spot = F.xxhash64(*keys).bitwiseAND((1 << bits) - 1)
    part, bit = F.shiftright(spot, 15), spot.bitwiseAND((1 << 15) - 1)
    maps = wanted.groupBy(part.alias("__part")).agg(F.bitmap_construct_agg(bit).alias("__map"))
    byte = F.conv(F.hex(F.substring("__map", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    is_set = F.call_function("shiftright", byte, bit.bitwiseAND(7).cast("int")).bitwiseAND(1) == 1
    return rows.withColumn("__part", part).join(F.broadcast(maps), "__part").where(is_set).select(*rows.columns)


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_list(text: Column) -> Column:
    """The words of a text in order."""
    return F.array_remove(F.split(text, WORD_BREAK), "")


def parts_of(text: str) -> list[str]:
    """The words of a text with empty strings between them where spaces follow each other."""
    for space in OTHER_SPACES:
        if space in text:
            text = text.replace(space, " ")
    return text.split(" ")


def words_of(text: str | None) -> list[str]:
    """The words of a text; only ASCII white space parts them."""
    return [w for w in parts_of(text) if w] if text else []


def map_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """Applies a function to every Arrow batch; empty batches are skipped."""
    ready_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)

    return df.mapInArrow(run, schema)


def chunk_codes(texts: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray, np.ndarray]:
    """Distinct chunks between ASCII white space, the chunk of every place, and text offsets."""
    lists = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
    coded = lists.flatten().dictionary_encode()
    offsets = np.r_[0, np.cumsum(np.asarray(lists.value_lengths()))].astype(np.int64)
    return coded.dictionary, np.asarray(coded.indices).astype(np.int64), offsets


def chunked(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """``chunk_codes`` with the chunks as a list."""
    chunks, places, offsets = chunk_codes(texts)
    return chunks.to_numpy(zero_copy_only=False).tolist(), places, offsets


def unchunked(
    per_chunk: Sequence[Sequence[int]], places: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts in one array and their offsets, from those of each chunk."""
    sizes = np.fromiter(map(len, per_chunk), np.int64, len(per_chunk))
    flat = np.fromiter(chain.from_iterable(per_chunk), np.int32, int(sizes.sum()))
    first = np.cumsum(sizes) - sizes
    counts = sizes[places]
    ends = np.r_[0, np.cumsum(counts)]
    picked = flat[np.arange(ends[-1]) + np.repeat(first[places] - ends[:-1], counts)]
    return picked, ends[offsets]


def id_ranges(docs: DataFrame, id_column: str = "doc_id") -> list[int]:
    """Sorted first ids of consecutive ranges of about RANGE_ROWS documents each.

    The list has an entry for each few thousand documents: some hundred kilobytes for a
    billion. Null ids come before the first range.
    """
    ids = docs.select(F.col(id_column).cast("bigint").alias("id")).where("id IS NOT NULL")
    count = ids.count()
    parts = count // RANGE_ROWS
    if parts < 1:
        return []
    cuts = ids.agg(
        F.percentile_approx(
            "id", [i / (parts + 1) for i in range(1, parts + 1)], int((parts + 1) / RANGE_ERROR)
        )
    ).first()[0]
    return sorted(set(cuts))


def range_of(ids: np.ndarray, missing: np.ndarray, cuts: list[int]) -> np.ndarray:
    """The number of each id's range; null ids belong to the first."""
    number = np.searchsorted(np.asarray(cuts, np.int64), ids, side="right")
    return np.where(missing, 0, number).astype(np.int64)


def id_array(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids and which of them are null."""
    missing = np.asarray(column.is_null())
    return np.asarray(column.fill_null(0)).astype(np.int64), missing


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v
