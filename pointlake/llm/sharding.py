"""Shards of near equal bytes by best-fit-decreasing bin packing of whole groups.

Documents with equal texts are a group, and a group stays in one shard. Groups are packed twice.
First every task packs its share of the groups, largest first: each group enters the bin with
the tightest remaining capacity that holds it, found in a balanced tree over the remaining
capacities, and opens a new bin only where none does. These bins are a small part of a shard.
Then the bins themselves are packed the same way, on the driver, into shards of the smallest
capacity with which they all fit.

Two bins of a task together always hold more than one capacity, so there are at most twice the
bytes through the capacity, and one a task: the list on the driver is bounded by the number of
shards and of tasks, whatever the number of groups. An eighth of the small groups goes to bins
DUST times smaller, with which the last packing evens out what larger bins leave.

A group above the mean of the shards that are left has a shard of its own; the rest is spread
over the others. ``pack_to_capacity`` has no number of shards but a capacity, and makes few of them.

Cases: null texts are empty texts, of one group with these; null ids come first in a shard;
repeated rows belong to one group and have a slot each; fewer groups than shards leave shards
empty; an empty table gives an empty result; a column that is named like a result is replaced.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import ready_workers, text_of, written
from pointlake.llm.places import numbered

SHARDS = 40
ROW_BYTES = 16  # what a document takes besides its text
BINS = 50  # bins that a shard consists of, about
DUST = 64
GROUPS_PER_TASK = 200_000


class CapacityTree:
    """Bins by remaining capacity in a treap: balanced, as priorities are as good as random."""

    def __init__(self):
        self.root: list | None = None  # [key, priority, left, right]

    @staticmethod
    def _priority(key: tuple[int, int]) -> int:
        return zlib.crc32(b"%d:%d" % key)

    def insert(self, key: tuple[int, int]) -> None:
        """``key`` is (remaining capacity, bin)."""
        fresh = [key, self._priority(key), None, None]
        path, node = [], self.root
        while node is not None and node[1] >= fresh[1]:
            path.append(node)
            node = node[2] if key < node[0] else node[3]
        # What is below the place is split by the key into the two children.
        low, high = fresh, fresh
        low_side, high_side = 2, 3
        below = node
        while below is not None:
            if below[0] < key:
                low[low_side] = below
                low, low_side, below = below, 3, below[3]
            else:
                high[high_side] = below
                high, high_side, below = below, 2, below[2]
        low[low_side] = high[high_side] = None
        self._hang(path, key, fresh)

    def _hang(self, path: list, key: tuple[int, int], node: list | None) -> None:
        if not path:
            self.root = node
        elif key < path[-1][0]:
            path[-1][2] = node
        else:
            path[-1][3] = node

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns the bin with the least remaining capacity of at least ``size``."""
        best, node, least = None, self.root, (size, -1)
        while node is not None:
            if node[0] >= least:
                best, node = node[0], node[2]
            else:
                node = node[3]
        if best is not None:
            self._remove(best)
        return best

    def _remove(self, key: tuple[int, int]) -> None:
        path, node = [], self.root
        while node[0] != key:
            path.append(node)
            node = node[2] if key < node[0] else node[3]
        left, right = node[2], node[3]
        top: list = [None, 0, None, None]
        at, side = top, 2
        while left is not None and right is not None:
            if left[1] >= right[1]:
                at[side] = left
                at, side, left = left, 3, left[3]
            else:
                at[side] = right
                at, side, right = right, 2, right[2]
        at[side] = left if left is not None else right
        self._hang(path, key, top[2])


class Packer:
    """Best fit for sizes that come largest first."""

    def __init__(self, capacity: int, bins: int | None = None):
        self.capacity, self.limit, self.opened, self.tree = capacity, bins, 0, CapacityTree()

    def put(self, size: int) -> int | None:
        """The bin of a size; none if it fits in no bin and no further bin may be opened.

        A size above the capacity has a bin of its own.
        """
        found = self.tree.take_tightest(size) if size <= self.capacity else None
        if found is None:
            if self.opened == self.limit:
                return None
            found = (max(self.capacity, size), self.opened)
            self.opened += 1
        if found[0] > size:
            self.tree.insert((found[0] - size, found[1]))
        return found[1]


def best_fit(sizes: Iterable[int], capacity: int, bins: int | None = None) -> list[int] | None:
    """The bin of each size, in their order (largest first); none if ``bins`` do not suffice."""
    packer, out = Packer(capacity, bins), []
    for size in sizes:
        number = packer.put(size)
        if number is None:
            return None
        out.append(number)
    return out


def into_shards(sizes: list[int], shards: int) -> list[int]:
    """The shard of each size (largest first), for the smallest capacity that best fit manages with."""
    out, left = [], sum(sizes)
    # Sizes above the mean of what is left cannot share a shard without making it larger.
    while len(out) < len(sizes) and len(out) < shards - 1 and sizes[len(out)] * (shards - len(out)) >= left:
        left -= sizes[len(out)]
        out.append(len(out))
    alone, rest = len(out), sizes[len(out) :]
    if not rest:
        return out
    bins = shards - alone
    low = max(math.ceil(left / bins), rest[0])
    high, best = low + rest[0], None
    while (best := best_fit(rest, high, bins)) is None:
        high += rest[0]
    step = max(1, low // 200_000)
    while high - low > step:
        middle = (low + high) // 2
        found = best_fit(rest, middle, bins)
        if found is None:
            low = middle
        else:
            high, best = middle, found
    return [*out, *(alone + b for b in best)]


def group_of(text: str | Column) -> Column:
    """What equal texts share."""
    return F.substring(F.sha2(text_of(text), 256), 1, 32)


def size_of(text: str | Column) -> Column:
    return F.octet_length(text_of(text)).cast("bigint") + F.lit(ROW_BYTES)


def group_sizes(sized: DataFrame) -> DataFrame:
    """``group, bytes``; counted within tasks first, so a large group is one row of each."""
    return written(sized.groupBy("group").agg(F.sum("size").alias("bytes")), "shard-groups")


def _packed(groups: DataFrame, capacity: int, dust: int) -> DataFrame:
    """``group, bytes, bin`` after every task has packed its groups; ``bin`` is unique over all tasks."""
    ready_workers(groups.sparkSession)
    tasks = max(1, math.ceil(groups.count() / GROUPS_PER_TASK))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        large, small = Packer(capacity), Packer(dust)
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes = batch.column("bytes").to_pylist()
            fine = np.asarray(batch.column("fine")) if batch.num_rows else []
            bins = [
                first + 2 * small.put(s) + 1 if f and s <= dust else first + 2 * large.put(s)
                for s, f in zip(sizes, fine, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("bytes"), pa.array(bins, pa.int64())], names=["group", "bytes", "bin"]
            )

    ordered = (
        groups.select("group", "bytes", (F.pmod(F.xxhash64("group"), F.lit(8)) == 0).cast("int").alias("fine"))
        .repartition(tasks, "group").sortWithinPartitions(F.col("bytes").desc(), "group")
    )
    return written(ordered.mapInArrow(pack, "group string, bytes bigint, bin bigint"), "shard-bins")


def _joined(packed: DataFrame, bins: list[int], shards: list[int]) -> DataFrame:
    """``group, shard``. The table of bins is bounded by the numbers of shards and tasks."""
    table = pa.table({"bin": pa.array(bins, pa.int64()), "shard": pa.array(shards, pa.int32())})
    numbers = packed.sparkSession.createDataFrame(table)
    return packed.join(F.broadcast(numbers), "bin").select("group", "shard")


def pack_to_count(groups: DataFrame, shards: int) -> DataFrame:
    """``group, shard``: groups of near equal bytes in each of ``shards`` shards from 0 on."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(1, total // (shards * BINS))
    packed = _packed(groups, capacity, max(1, capacity // DUST))
    rows = packed.groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect()
    rows = sorted(((r.bytes, r.bin) for r in rows), key=lambda r: (-r[0], r[1]))
    return _joined(packed, [b for _, b in rows], into_shards([s for s, _ in rows], shards))


def pack_to_capacity(groups: DataFrame, capacity: int) -> DataFrame:
    """``group, shard``: shards of at most ``capacity`` bytes, as few as best fit manages with.

    A task's bins are shards, but for the one that may be less than half full: these are packed
    again, all tasks' together. A group above the capacity has a shard of its own.
    """
    packed = _packed(groups, capacity, 0)
    sums = written(packed.groupBy("bin").agg(F.sum("bytes").alias("bytes")), "shard-sums")
    rows = sorted(((r.bytes, r.bin) for r in sums.where(F.col("bytes") * 2 <= capacity).collect()), key=lambda r: (-r[0], r[1]))
    together = best_fit([s for s, _ in rows], capacity)
    names: dict[int, int] = {}
    for number, (_, b) in zip(together, rows, strict=True):
        names.setdefault(number, b)
    moved = pa.table({
        "bin": pa.array([b for _, b in rows], pa.int64()),
        "into": pa.array([names[t] for t in together], pa.int64()),
    })
    into = packed.sparkSession.createDataFrame(moved)
    # At most one row a task.
    named = packed.join(F.broadcast(into), "bin", "left").select("group", F.coalesce("into", "bin").alias("bin"))
    # Numbers without gaps from 0 on, in order of the bins.
    used = numbered(named.select("bin").distinct().select(F.lit(0).cast("bigint").alias("all"), "bin"), "all", [F.col("bin").asc()], "shard-names", "shard")
    return named.join(used.select("bin", F.col("shard").cast("int").alias("shard")), "bin").select("group", "shard")


def shard(
    docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None, text_column: str = "text"
) -> DataFrame:
    """``docs`` with ``shard``: whole groups of equal texts, packed by their bytes."""
    kept = [c for c in docs.columns if c.lower() != "shard"]
    grouped = docs.select(*kept, group_of(text_column).alias("__group"))
    return _sharded(grouped, docs.select(group_of(text_column).alias("group"), size_of(text_column).alias("size")), shards, capacity)


def _sharded(grouped: DataFrame, sized: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    groups = group_sizes(sized)
    packed = pack_to_count(groups, shards) if capacity is None else pack_to_capacity(groups, capacity)
    return grouped.join(packed, grouped["__group"] == packed["group"]).drop("__group", "group")


def write_shards(docs: DataFrame, folder: str, shards: int | None = SHARDS, capacity: int | None = None) -> None:
    """Writes the documents as Parquet, a folder for each shard; large shards have several files."""
    shard(docs, shards, capacity).hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)


def placed(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    Slots count the documents of a shard from 0 on, in order of their ids. The law is ``bytes``:
    sizes near equal; another number of shards packs anew, so ``grown_shard`` is null.
    """
    narrow = written(
        docs.select(
            F.col(id_column).alias("doc_id"), size_of(text_column).alias("size"),
            F.crc32(text_of(text_column)).alias("text_crc32"), group_of(text_column).alias("__group"),
        ),
        "shard-documents",
    )
    sharded = _sharded(narrow, narrow.select(F.col("__group").alias("group"), "size"), shards, None)
    slots = numbered(sharded, "shard", [F.col("doc_id").asc_nulls_first(), F.col("text_crc32").asc()], "shard-slots", "slot")
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
