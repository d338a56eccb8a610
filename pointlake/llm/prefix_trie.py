"""The trie of conversation prefixes, from sorted conversations and their common prefixes.

Every conversation is first rebuilt: it shares the opening turns of the conversation that leads
its family of five, and goes on with its own. The distinct rebuilt conversations are sorted over
all tasks. A task cuts its sorted rows into blocks of bounded bytes; in a block, the lengths of
the common prefixes of neighbours (LCPs) go into a sparse table of range minima. Each candidate
prefix then searches the left and the right end of its members on its own, by halving steps over
that table, and running sums over the rows of an interval give what a node reports.

* A prefix that touches an end of its block may go on in the next one. Such open prefixes, at
  most two a turn of depth for each block, are added up by their digest, and what the rows on
  both sides of a cut share is taken off once.
* Conversations are cut into pieces of PIECE_TURNS turns, so that no row and no task grows with a
  conversation. The pieces after the first are sorted below the digest of all turns before
  them; what lies below a piece is added by pointer doubling, a round for each doubling of pieces.
* Copies are counted before anything is sorted. The ids of members that end at a node are sorted
  over all tasks and joined to text there; only the last digest over these texts, which no one
  can compute in parts, reads them in one task, as a stream.

Cases: rows without ``conv_id`` belong to no conversation; null turns come first; null roles and
texts are empty; rows with equal turns are in order of the digest of role and text; repeated rows
are turns of their own; a conversation that is left without turns is a member of the root; an
empty table gives no nodes; only the four columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlake.llm.common import ready_workers, text_of, written
from pointlake.llm.places import numbered

FAMILY = 5
HEADS = 9  # a conversation shares fewer opening turns than this
PIECE_TURNS = 128
BLOCK_BYTES = 8 << 20
TURN_BYTES = 16  # of a turn's digest
CHUNK_BYTES = 64 << 10
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

RESULTS = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
)
PIECE = "piece bigint, r1 bigint, r2 bigint"
EDGE = f"struct<{PIECE.replace(' bigint', ': bigint')}, first: binary, last: binary, sizes: array<bigint>, ends: boolean>"
NODE = (
    "id string, parent string, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    f"n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, whole boolean, edge {EDGE}"
)


# -- rebuilt conversations ---------------------------------------------------------------


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, digest, n_bytes`` for every turn, and ``conv_id, n_turns``."""
    text, role = text_of("text"), text_of("role")
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.substring(F.sha2(said, 256), 1, 2 * TURN_BYTES).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    own = numbered(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest").asc()], "turns").drop("turn")
    lengths = written(own.groupBy("conv_id").agg((F.max("place") + 1).alias("n")), "conversations")
    shares = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEADS))
    family = lengths.select("*", (F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))).alias("base"), shares.alias("h"))
    convs = written(
        family.join(lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
        .select(
            "conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("head"), "n",
        )
        .select("*", (F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("n_turns")),
        "families",
    )
    rest = own.join(convs, "conv_id").where("place >= h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("head") + 1).alias("depth"), "digest", "n_bytes", "n_turns"
    )
    # At most HEADS - 1 turns of a leading conversation meet at most FAMILY conversations.
    opening = (
        own.where((F.pmod("conv_id", F.lit(FAMILY)) == 0) & (F.col("place") < HEADS - 1))
        .withColumnRenamed("conv_id", "base").join(convs, "base").where("place < head")
        .select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "n_bytes", "n_turns")
    )
    return rest.unionByName(opening), convs.select("conv_id", "n_turns")


def _link(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "piece", "seq")


def pieces_of(turns: DataFrame, convs: DataFrame, piece_turns: int = PIECE_TURNS) -> DataFrame:
    """``conv_id, piece, r1, r2, seq, sizes, goes_on, n1, n2``: conversations cut into pieces.

    ``seq`` holds the digests of a piece's turns, ``r1, r2`` stand for all pieces before it, and
    ``n1, n2`` for all up to it.
    """
    number = F.floor((F.col("depth") - 1) / piece_turns).cast("bigint")
    cut = (
        turns.groupBy("conv_id", number.alias("piece"))
        # At most piece_turns entries.
        .agg(
            F.sort_array(F.collect_list(F.struct("depth", "digest", "n_bytes"))).alias("turns"),
            F.max("n_turns").alias("n_turns"),
        )
        .select(
            "conv_id", "piece", F.unhex(F.array_join("turns.digest", "")).alias("seq"),
            F.col("turns.n_bytes").alias("sizes"), "n_turns",
        )
    )
    silent = convs.where("n_turns = 0").select(
        "conv_id", F.lit(0).cast("bigint").alias("piece"), F.unhex(F.lit("")).alias("seq"),
        F.array().cast("array<bigint>").alias("sizes"), "n_turns",
    )
    cut = written(cut.unionByName(silent), "pieces")
    goes_on = F.col("n_turns") > (F.col("piece") + 1) * piece_turns
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    short = cut.where(F.col("n_turns") <= piece_turns).select("*", zero.alias("r1"), zero.alias("r2"))
    # One row for piece_turns turns of the long ones.
    long = cut.where(F.col("n_turns") > piece_turns).select(
        "*", *[F.coalesce(F.bit_xor(_link(k)).over(before), zero).alias(f"r{k}") for k in (1, 2)]
    )
    return short.unionByName(long).select(
        "conv_id", "piece", "r1", "r2", "seq", "sizes", goes_on.alias("goes_on"),
        *[F.col(f"r{k}").bitwiseXOR(_link(k)).alias(f"n{k}") for k in (1, 2)],
    )


def ends_digests(pieces: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``key, ends_sha256``: the digest of the sorted ids of the conversations that end with a piece."""
    ready_workers(pieces.sparkSession)
    ended = pieces.where("NOT goes_on").select(_key().alias("key"), "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of at most chunk_bytes or so, from ids in order."""
        key, first, ids, size = None, 0, [], 0

        def chunk(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.string())], names=["key", "first", "ids"],
            )

        for batch in batches:
            out = []
            for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if k != key or size > chunk_bytes:
                    if ids:
                        out.append((key, first, ",".join(ids)))
                    key, first, ids, size = k, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if out:
                yield chunk(out)
        if ids:
            yield chunk([(key, first, ",".join(ids))])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, found = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k == key:
                    state.update(b",")
                else:
                    if state:
                        found.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())],
                names=["key", "ends_sha256"],
            )
            found = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    chunks = (
        ended.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
        .mapInArrow(join, "key string, first bigint, ids string")
    )
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(
        digest, "key string, ends_sha256 string"
    )


def _key() -> Column:
    parts = [F.col(c).cast("string") for c in ("piece", "r1", "r2")]
    return F.md5(F.concat(*[x for p in parts for x in (p, F.lit(":"))], F.hex("seq")))


# -- nodes of a block --------------------------------------------------------------------


def minima(values: np.ndarray) -> list[np.ndarray]:
    """The sparse table: entry i of level k is the least of 2^k values from i on."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        last, step = table[-1], 1 << (len(table) - 1)
        table.append(np.minimum(last[:-step], last[step:]))
    return table


def right_ends(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The last row that shares ``depth`` turns with each row."""
    at = rows.copy()
    for k in reversed(range(len(table))):
        step, level = 1 << k, table[k]
        fits = at + 1 < len(level)
        fits[fits] = level[at[fits] + 1] >= depths[fits]
        at[fits] += step
    return at


def left_ends(table: list[np.ndarray], rows: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The first row that shares ``depth`` turns with each row."""
    at = rows.copy()
    for k in reversed(range(len(table))):
        step, level = 1 << k, table[k]
        fits = at - step >= 0
        fits[fits] = level[at[fits] - step + 1] >= depths[fits]
        at[fits] -= step
    return at


def range_minimum(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    level = np.frexp((right - left + 1).astype(np.float64))[1] - 1
    out = np.empty(len(left), np.int64)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][left[own]], table[k][right[own] - (1 << k) + 1])
    return out


def common(a: bytes, b: bytes) -> int:
    """How many turns two pieces share at their start."""
    x, y = (np.frombuffer(v, np.uint64).reshape(-1, 2) for v in (a, b))
    n = min(len(x), len(y))
    other = np.flatnonzero((x[:n] != y[:n]).any(axis=1))
    return int(other[0]) if len(other) else n


def root_id(piece: int, r1: int, r2: int) -> str:
    """The node above the first turns of a piece."""
    return f"R{piece}:{r1}:{r2}"


def node_id(piece: int, r1: int, r2: int, prefix: bytes) -> str:
    if prefix:
        return hashlib.md5(f"{piece}:{r1}:{r2}:".encode() + prefix).hexdigest()
    # What stands for the earlier pieces is no node of its own, but sums of what lies below.
    return f"S{piece}:{r1}:{r2}" if piece else root_id(piece, r1, r2)


def nodes_of_block(rows: pa.Table, piece_turns: int) -> dict[str, list]:
    """The nodes of sorted rows, each at the first row of its interval."""
    n = rows.num_rows
    piece, r1, r2, w, conv, n1, n2, sub_children, sub_leaves, sub_saved = (
        np.asarray(rows.column(c).to_numpy(), np.int64)
        for c in ("piece", "r1", "r2", "w", "conv_id", "n1", "n2", "sub_children", "sub_leaves", "sub_saved")
    )
    goes_on = np.asarray(rows.column("goes_on").to_pylist(), bool)
    seqs, ends = rows.column("seq").to_pylist(), rows.column("ends_sha256").to_pylist()
    sizes = np.asarray(rows.column("sizes").combine_chunks().flatten(), np.int64)
    length = np.fromiter((len(s) // TURN_BYTES for s in seqs), np.int64, n)
    offset = np.r_[0, np.cumsum(length)]
    flat = np.frombuffer(b"".join(seqs), np.uint64).reshape(-1, 2)
    bytes_to = np.r_[0, np.cumsum(sizes)]

    # LCPs of neighbours; rows below different roots share nothing, not even the root.
    same = np.r_[False, (piece[1:] == piece[:-1]) & (r1[1:] == r1[:-1]) & (r2[1:] == r2[:-1])]
    least = np.where(same, np.minimum(length, np.r_[0, length[:-1]]), 0)
    first = np.cumsum(least) - least
    step = np.arange(least.sum()) - np.repeat(first, least)
    here, before = np.repeat(offset[:-1], least) + step, np.repeat(np.r_[0, offset[:-2]], least) + step
    unlike = (flat[here] != flat[before]).any(axis=1)
    lcp = least.copy()
    np.minimum.at(lcp, np.repeat(np.arange(n), least)[unlike], step[unlike])
    lcp = np.where(same, lcp, -1)
    table = minima(lcp)

    # Candidates: every prefix at the first row that has it.
    fresh = length - lcp
    start = np.cumsum(fresh) - fresh
    row = np.repeat(np.arange(n), fresh)
    depth = np.arange(fresh.sum()) - np.repeat(start, fresh) + np.repeat(lcp + 1, fresh)
    left, right = left_ends(table, row, depth), right_ends(table, row, depth)
    above = left_ends(table, row, np.maximum(depth - 1, 0))
    parent = np.where(depth > 0, start[above] + depth - 1 - (lcp[above] + 1), -1)

    total = bytes_to[offset[1:]] - bytes_to[offset[:-1]]
    known = bytes_to[offset[row] + np.maximum(depth - 1, 0)] - bytes_to[offset[row]]
    own = total - (bytes_to[offset[:-1] + np.maximum(lcp, 0)] - bytes_to[offset[:-1]])
    after = np.r_[lcp[1:], -1]
    leaf = ~goes_on & (after < length)

    def summed(values: np.ndarray, a: np.ndarray) -> np.ndarray:
        running = np.r_[0, np.cumsum(values)]
        return running[right + 1] - running[a]

    n_convs = summed(w, left)
    said = summed(w * total, left) - known * n_convs
    distinct = summed(own, left + 1) + total[left] - known
    children = np.bincount(parent[depth > 0], minlength=len(row))
    whole_row = depth == length[row]
    last = whole_row & goes_on[row]
    lowest = range_minimum(minima(conv), left, right)
    opened = (left == 0) | (right == n - 1)

    ids: dict[int, str] = {}

    def identity(c: int) -> str:
        if c not in ids:
            i, d = int(row[c]), int(depth[c])
            ids[c] = (
                root_id(int(piece[i]) + 1, int(n1[i]), int(n2[i])) if last[c]
                else node_id(int(piece[i]), int(r1[i]), int(r2[i]), seqs[i][: d * TURN_BYTES])
            )
        return ids[c]

    def above_of(c: int) -> str | None:
        d, p, i = depth[c], int(parent[c]), row[c]
        if d == 1:
            return root_id(int(piece[i]), int(r1[i]), int(r2[i]))
        return identity(p) if d > 1 and opened[p] else None

    # The parent of a piece's first turn is known by the digest of all pieces before it.
    direct = (depth > 1) & ~opened[parent]
    return {
        "id": [identity(c) if opened[c] or last[c] or depth[c] == 0 else None for c in range(len(row))],
        "parent": [above_of(c) for c in range(len(row))],
        "depth": (piece[row] * piece_turns + depth).tolist(),
        "conv_id": lowest.tolist(),
        "parent_conv_id": [v if k else None for v, k in zip(lowest[parent].tolist(), direct.tolist(), strict=True)],
        "n_convs": n_convs.tolist(),
        "n_children": (children + np.where(last, sub_children[row], 0)).tolist(),
        "n_leaves": (summed(leaf.astype(np.int64), left) + summed(sub_leaves, left)).tolist(),
        "saved_tokens": (said - distinct + summed(sub_saved, left)).tolist(),
        "ends_sha256": [ends[i] if e else None for i, e in zip(row.tolist(), whole_row.tolist(), strict=True)],
        "whole": (~opened & (depth > 0)).tolist(),
        "edge": [None] * len(row),
    }


def edge_of_block(rows: pa.Table) -> dict:
    """What the next block needs to know of this one, and the one before."""
    names = ("piece", "r1", "r2")
    head, tail = rows.slice(0, 1).to_pylist()[0], rows.slice(rows.num_rows - 1, 1).to_pylist()[0]
    return {
        "first": {"first": head["seq"], **{k: head[k] for k in names}},
        "last": {"last": tail["seq"], "sizes": tail["sizes"], "ends": not tail["goes_on"], **{k: tail[k] for k in names}},
    }


def node_batch(columns: dict[str, list]) -> pa.RecordBatch:
    edge = pa.struct([
        ("piece", pa.int64()), ("r1", pa.int64()), ("r2", pa.int64()), ("first", pa.binary()),
        ("last", pa.binary()), ("sizes", pa.list_(pa.int64())), ("ends", pa.bool_()),
    ])
    kinds = {"id": pa.string(), "parent": pa.string(), "ends_sha256": pa.string(), "whole": pa.bool_(), "edge": edge}
    return pa.RecordBatch.from_arrays(
        [pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()], names=list(columns)
    )


def nothing(columns: int) -> list[None]:
    return [None] * columns


def block_nodes(rows: DataFrame, piece_turns: int, block_bytes: int) -> DataFrame:
    """Nodes of all blocks and two edge rows for each."""
    ready_workers(rows.sparkSession)
    names = [c.strip().split(" ")[0] for c in NODE.split(", edge ")[0].split(",")] + ["edge"]

    def block(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        yield node_batch(nodes_of_block(table, piece_turns))
        edges = edge_of_block(table)
        columns = {k: nothing(2) for k in names}
        columns["edge"] = [edges["first"], edges["last"]]
        yield node_batch(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and size + batch.nbytes > block_bytes:
                yield from block(held)
                held, size = [], 0
            held.append(batch)
            size += batch.nbytes
        if held:
            yield from block(held)

    by = ["piece", "r1", "r2", "seq"]
    return written(rows.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(run, NODE), "trie-blocks")


def shared_at_cuts(found: DataFrame) -> DataFrame:
    """Rows that take off what the last row of a block and the first of the next count twice.

    One row a block goes through the sort of all cuts.
    """
    edges = found.where("edge IS NOT NULL").select("edge.*")
    # A block's first row sorts before its last one, or is the same row.
    order = Window.orderBy("piece", "r1", "r2", F.coalesce("first", "last"), F.col("last").asc_nulls_first())
    following = [F.lead(c).over(order).alias(f"next_{c}") for c in ("piece", "r1", "r2", "first")]
    cuts = (
        edges.select("*", *following)
        .where("last IS NOT NULL AND next_first IS NOT NULL AND piece = next_piece AND r1 = next_r1 AND r2 = next_r2")
        .select("piece", "r1", "r2", "last", "sizes", "ends", "next_first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                n = common(r["last"], r["next_first"])
                leaf = r["ends"] and len(r["last"]) == n * TURN_BYTES
                for d in range(n + 1):
                    out.append((
                        node_id(r["piece"], r["r1"], r["r2"], r["last"][: d * TURN_BYTES]),
                        -1 if d < n else 0, -1 if leaf else 0, sum(r["sizes"][max(d - 1, 0) : n]),
                    ))
            ids, *numbers = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.string()), *[pa.array(x, pa.int64()) for x in numbers]],
                names=["id", "n_children", "n_leaves", "saved_tokens"],
            )

    return cuts.mapInArrow(run, "id string, n_children bigint, n_leaves bigint, saved_tokens bigint")


def _merged(found: DataFrame) -> DataFrame:
    """The open nodes of all blocks, one row each."""
    parts = found.where("NOT whole").drop("edge", "whole", "parent_conv_id")
    return parts.unionByName(shared_at_cuts(found), allowMissingColumns=True).groupBy("id").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"),
    )


def _named(piece: Column, a: str, b: str) -> Column:
    return F.concat(F.lit("R"), piece.cast("string"), F.lit(":"), F.col(a).cast("string"), F.lit(":"), F.col(b).cast("string"))


def below_pieces(rows: DataFrame, piece_turns: int, block_bytes: int) -> DataFrame | None:
    """``root, sub_children, sub_leaves, sub_saved`` of all pieces but the first; none if there are none."""
    later = rows.where("piece >= 1")
    deepest = later.agg(F.max("piece")).first()[0]
    if deepest is None:
        return None
    found = block_nodes(later, piece_turns, block_bytes)
    local = _merged(found.where("edge IS NOT NULL OR id LIKE 'S%'")).where("id LIKE 'S%'").select(
        F.concat(F.lit("R"), F.substring("id", 2, 1 << 20)).alias("id"), "n_children", "n_leaves", "saved_tokens"
    )
    links = later.where("goes_on").select(
        _named(F.col("piece") + 1, "n1", "n2").alias("id"), _named(F.col("piece"), "r1", "r2").alias("up")
    ).distinct()
    sums = written(local.join(links, "id", "left"), "trie-roots")
    reach = 1
    while reach < deepest:
        gained = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            F.sum("n_leaves").alias("more_leaves"), F.sum("saved_tokens").alias("more_saved")
        )
        jump = sums.select(F.col("id").alias("up"), F.col("up").alias("next"))
        sums = written(
            sums.join(gained, "id", "left").join(jump, "up", "left").select(
                "id", "n_children", (F.col("n_leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"),
                F.col("next").alias("up"),
            ),
            "trie-roots",
        )
        reach *= 2
    return sums.select(
        F.col("id").alias("below"), F.col("n_children").alias("sub_children"),
        F.col("n_leaves").alias("sub_leaves"), F.col("saved_tokens").alias("sub_saved"),
    )


def trie(conversations: DataFrame, piece_turns: int = PIECE_TURNS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every distinct prefix of the rebuilt conversations, with its members (see RESULTS)."""
    turns, convs = rebuilt(conversations)
    pieces = written(pieces_of(turns, convs, piece_turns), "trie-pieces")
    rows = (
        pieces.groupBy("piece", "r1", "r2", "seq")
        .agg(
            F.count("*").alias("w"), F.min("conv_id").alias("conv_id"), F.max("goes_on").alias("goes_on"),
            F.max("sizes").alias("sizes"), F.max("n1").alias("n1"), F.max("n2").alias("n2"),
        )
        .withColumn("key", _key()).join(ends_digests(pieces), "key", "left").drop("key")
    )
    zero = F.lit(0).cast("bigint")
    none_below = [zero.alias(c) for c in ("sub_children", "sub_leaves", "sub_saved")]
    rows = written(rows, "trie-rows")
    below = below_pieces(rows.select("*", *none_below), piece_turns, block_bytes)
    if below is None:
        rows = rows.select("*", *none_below)
    else:
        under = F.when(F.col("goes_on"), _named(F.col("piece") + 1, "n1", "n2"))
        rows = rows.withColumn("below", under).join(below, "below", "left").drop("below").fillna(
            0, ["sub_children", "sub_leaves", "sub_saved"]
        )
    found = block_nodes(rows, piece_turns, block_bytes)
    whole = found.where("whole")
    merged = written(_merged(found).where("id NOT LIKE 'S%'"), "trie-open")
    named = merged.select("id", "conv_id").unionByName(whole.where("id IS NOT NULL").select("id", "conv_id"))
    above = named.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv"))
    columns = [c for c in RESULTS if c != "parent_conv_id"]
    waiting = whole.where("parent IS NOT NULL").select("parent", *columns).unionByName(merged.select("parent", *columns))
    placed = waiting.join(above, "parent", "left").withColumnRenamed("parent_conv", "parent_conv_id")
    done = whole.where("parent IS NULL").select(*RESULTS).unionByName(placed.select(*RESULTS))
    return done.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_MEMBERS)))
