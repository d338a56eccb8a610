"""Removal of repeated passages: bounded interval expansion on Burrows-Wheeler transforms.

A byte goes if a string of LENGTH bytes that covers it also starts elsewhere in the corpus.
Texts are cut into segments so that equal strings meet: every window of LENGTH bytes belongs
to the smallest hash among its pieces of PIECE bytes, which depends on the window alone;
consecutive windows with the same smallest piece are one segment. Two equal windows thus lie
in segments of one piece, and only segments that share their piece are ever compared.

Equal segments are counted, not compared: all windows of a segment that occurs twice are
repeated. The different segments of the pieces are dealt into blocks of bounded size. A
block's segments are one text with separators; its suffixes are sorted to a bounded depth,
and from the transform the common prefixes of neighbouring suffixes are derived breadth
first: the intervals of all strings of length l are extended backwards by one byte, every
right end that is met for the first time has common prefix l, and the expansion stops at
LENGTH. Ends never met have LENGTH bytes in common: these are the repeated windows.

A piece with more than MAX_VARIANTS different segments would not fit a block. Its windows are
keyed by their whole LENGTH bytes instead of by the piece, by two hashes: all that is left
of the interval of such a string is its size, which is counted with partial sums.

Cases: a null text is empty; texts shorter than LENGTH lose nothing; copies of a text, rows
repeated in the table included, lose every window; overlapping repeats within one text
count; an empty table gives an empty result. ``spans`` reads only the text; ``without_repeats``
keeps the documents' columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import likely, map_batches, mixed, ready_workers, text_of, written

LENGTH = 400
PIECE = 64
MAX_VARIANTS = 512
BLOCK_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
OTHER_BASE = np.uint64(0xD6E8FEB86659FD93)
SPREAD = mixed(np.arange(1, 257))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def window_hashes(data: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` bytes, from running sums of b[i] * base^i."""
    if len(data) < width:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(SPREAD[data] * _powers(base, len(data)), out=sums[1:])
    return mixed((sums[width:] - sums[:-width]) * _powers(_inverse(base), len(data) - width + 1))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values, by block prefixes and suffixes."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).reshape(-1)
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def segments_of(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece hash, first byte and length of the segments of one text."""
    pieces = window_hashes(data, PIECE)
    smallest = sliding_minimum(pieces, length - PIECE + 1)
    # A new segment where the minimum changes, or where its leftmost place has just been left.
    changed = (smallest[1:] != smallest[:-1]) | (pieces[: len(smallest) - 1] == smallest[:-1])
    starts = np.flatnonzero(np.r_[True, changed])
    ends = np.r_[starts[1:], len(smallest)] - 1 + length
    return smallest[starts], starts, ends - starts


def _segments(docs: DataFrame, text_column: str, length: int) -> DataFrame:
    """``piece, content, node, start, size``: the segments of every row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces, contents, starts, sizes, counts = [], [], [], [], []
        for text in batch.column(1).to_pylist():
            raw = text.encode()
            if len(raw) < length:
                counts.append(0)
                continue
            found = segments_of(np.frombuffer(raw, np.uint8), length)
            at, size = found[1].tolist(), found[2].tolist()
            contents.extend(xxhash.xxh3_64_intdigest(raw[a : a + n]) for a, n in zip(at, size, strict=True))
            pieces.append(found[0].view(np.int64))
            starts.append(found[1])
            sizes.append(found[2])
            counts.append(len(at))
        flat = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(flat(pieces, np.int64)), pa.array(np.array(contents, np.uint64).view(np.int64)),
                batch.column(0).take(pa.array(np.repeat(np.arange(len(counts)), counts))),
                pa.array(flat(starts, np.int32)), pa.array(flat(sizes, np.int32)),
            ],
            ["piece", "content", "node", "start", "size"],
        )

    text = text_of(text_column)
    return map_batches(
        docs.select(F.unhex(F.md5(text)).alias("node"), text.alias("text")), work,
        "piece bigint, content bigint, node binary, start int, size int",
    )


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by at least ``depth`` symbols (of 9 bits), and the ranks by the first 7."""
    n = len(text)
    padded = np.r_[text, np.zeros(7, text.dtype)].astype(np.int64)
    key = np.zeros(n, np.int64)
    for i in range(7):
        key = key << 9 | padded[i : i + n]
    order = np.argsort(key, kind="stable")
    key = key[order]
    fresh = np.r_[True, key[1:] != key[:-1]]
    first = fresh.copy()
    rank = np.zeros(n + depth + 7, np.int64)  # past the end: smaller than all
    rows = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(fresh, rows, 0)) + 1
    width = 7
    while width < depth:
        # Rows of groups that are still tied.
        tied = np.flatnonzero(~fresh | np.r_[~fresh[1:], False])
        if not len(tied):
            break
        place = order[tied]
        pair = rank[place] << 32 | rank[place + width]
        by = np.argsort(pair, kind="stable")
        order[tied], pair = place[by], pair[by]
        new = np.r_[True, pair[1:] != pair[:-1]]
        fresh[tied] = new
        rank[order[tied]] = np.maximum.accumulate(np.where(new, tied, 0)) + 1
        width *= 2
    return order, first


def repeated_rows(text: np.ndarray, length: int) -> np.ndarray:
    """For every position whether its next ``length`` symbols also start elsewhere.

    ``text`` ends with a symbol 0 that stands nowhere else.
    """
    order, first = suffix_order(text, length)
    n = len(order)
    bwt = text[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    forward = np.empty(n, np.int64)  # row of the suffix that is longer by one symbol
    forward[by_symbol] = np.arange(n)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    following, previous = np.full(n, n), np.full(n, -1)
    following[by_symbol[:-1]] = np.where(same, by_symbol[1:], n)
    previous[by_symbol[1:]] = np.where(same, by_symbol[:-1], -1)
    # met[r]: the common prefix of rows r - 1 and r is known to be below the level.
    met = np.r_[first, True]
    low = np.flatnonzero(first)
    high = np.r_[low[1:], n] - 1
    for _ in range(7, length):
        if not len(low):
            break
        single = low == high
        to = forward[low[single]]
        low, high = low[~single], high[~single]
        sizes = high - low + 1
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - sizes), sizes)
        last = forward[rows[following[rows] > np.repeat(high, sizes)]]
        begin = forward[rows[previous[rows] < np.repeat(low, sizes)]]
        # The extended intervals are disjoint, so their ends pair up in order.
        last.sort()
        begin.sort()
        low, high = np.r_[to, begin], np.r_[to, last]
        new = ~met[high + 1]
        low, high = low[new], high[new]
        met[high + 1] = True
    common = ~met
    out = np.zeros(n, bool)
    out[order] = common[:-1] | common[1:]
    return out


def block_windows(contents: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For every segment of a block, which of its windows stand twice or more in the block."""
    symbols = np.concatenate([np.r_[np.frombuffer(c, np.uint8).astype(np.uint16) + 2, np.uint16(1)] for c in contents])
    again = repeated_rows(np.r_[symbols, np.uint16(0)], length)
    out, at = [], 0
    for c in contents:
        out.append(again[at : at + len(c) - length + 1])
        at += len(c) + 1
    return out


def covered(windows: np.ndarray, length: int = LENGTH) -> list[tuple[int, int]]:
    """Byte ranges that the marked windows cover, neighbours joined."""
    starts = np.flatnonzero(windows)
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + length).tolist(), strict=True))


def _with_bytes(wanted: DataFrame, docs: DataFrame, text_column: str) -> DataFrame:
    """The segments ``piece, n, node, start`` with their bytes; a text is read once for all of its own."""
    lists = wanted.groupBy("node").agg(
        F.collect_list(F.struct("piece", "n", "start", "size", "variants")).alias("parts")
    )
    texts = docs.select(text_of(text_column).alias("text")).select(F.unhex(F.md5("text")).alias("node"), "text")
    one = texts.join(lists.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for node, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = text.encode()
            rows += [
                (p["piece"], p["n"], node, p["start"], p["variants"], raw[p["start"] : p["start"] + p["size"]])
                for p in parts
            ]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
            ["piece", "n", "node", "start", "variants", "bytes"],
        )

    return map_batches(
        one.join(lists, "node"), work, "piece bigint, n bigint, node binary, start int, variants bigint, bytes binary"
    )


RANGES = "node binary, low int, high int"


def _in_blocks(open_segments: DataFrame, blocks: int, length: int) -> DataFrame:
    """Repeated ranges of segments that occur once, from the transform of each block."""
    ready_workers(open_segments.sparkSession)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        found = block_windows(list(rows["bytes"]), length)
        for n, node, start, windows in zip(rows["n"], rows["node"], rows["start"], found, strict=True):
            if n == 1:
                out += [(node, start + a, start + b) for a, b in covered(windows, length)]
        return pd.DataFrame(out, columns=["node", "low", "high"])

    block = F.pmod(F.xxhash64("piece"), F.lit(blocks)).alias("block")
    return open_segments.select(block, "n", "node", "start", "bytes").groupBy("block").applyInPandas(work, RANGES)


def _by_whole_windows(crowded: DataFrame, length: int) -> DataFrame:
    """Repeated ranges in segments of pieces with too many variants, keyed by whole windows."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ones, others, nodes, starts, counts = [], [], [], [], []
        n, node, start, raw = (batch.column(batch.schema.get_field_index(c)) for c in ("n", "node", "start", "bytes"))
        for i, (at, content) in enumerate(zip(start.to_pylist(), raw.to_pylist(), strict=True)):
            data = np.frombuffer(content, np.uint8)
            ones.append(window_hashes(data, length).view(np.int64))
            others.append(window_hashes(data, length, OTHER_BASE).view(np.int64))
            starts.append(at + np.arange(len(ones[-1])))
            nodes.append(np.full(len(ones[-1]), i))
        rows = pa.array(np.concatenate(nodes))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(ones)), pa.array(np.concatenate(others)), n.take(rows), node.take(rows),
             pa.array(np.concatenate(starts).astype(np.int32))],
            ["one", "other", "n", "node", "low"],
        )

    windows = map_batches(crowded, work, "one bigint, other bigint, n bigint, node binary, low int")
    windows = written(windows, "suffix-windows")
    repeated = windows.groupBy("one", "other").agg(F.sum("n").alias("times")).where("times > 1").select("one", "other")
    return (
        windows.where("n = 1").join(repeated, ["one", "other"], "left_semi")
        .select("node", "low", (F.col("low") + length).cast("int").alias("high"))
    )


def spans(docs: DataFrame, text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """``node, spans``: the byte ranges to remove, by digest of the text. ``length`` is more than PIECE."""
    segments = written(_segments(docs, text_column, length), "suffix-segments")
    counted = segments.groupBy("piece", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("node", "start", "size")).alias("first")
    )
    counted = written(
        counted.select("piece", "content", "n", "first.node", "first.start", "first.size"), "suffix-counted"
    )
    # All windows of segments that occur twice.
    twice = counted.where("n > 1").select("piece", "content")
    # Not a semi join: Spark would move that below the filter, to all segments.
    whole = likely(segments, twice, ["piece", "content"]).join(twice, ["piece", "content"]).select(
        "node", F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high")
    )
    # Different segments of one piece.
    variants = counted.groupBy("piece").agg(F.count("*").alias("variants"), F.min("n").alias("least")).where(
        "variants > 1 AND least = 1"
    )
    variants = written(variants.select("piece", "variants"), "suffix-variants")
    open_segments = likely(counted, variants, ["piece"]).join(variants, "piece")
    with_bytes = written(_with_bytes(open_segments, docs, text_column), "suffix-bytes")
    crowded = F.col("variants") > MAX_VARIANTS
    total = with_bytes.where(~crowded).agg(F.sum(F.length("bytes"))).first()[0] or 0
    ranges = (
        whole.unionByName(_in_blocks(with_bytes.where(~crowded), 1 + total // BLOCK_BYTES, length))
        .unionByName(_by_whole_windows(with_bytes.where(crowded), length))
    )
    # Copies of a text name the same ranges.
    return ranges.distinct().groupBy("node").agg(F.collect_list(F.struct("low", "high")).alias("spans"))


def merged(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the ranges of one text."""
    out: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"]) for r in ranges or ()):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def _kept(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for low, high in runs:
        parts.append(raw[at:low])
        at = high
    return b"".join([*parts, raw[at:]])


def _located(docs: DataFrame, columns: list[str], text_column: str, length: int) -> DataFrame:
    found = written(spans(docs, text_column, length), "suffix-spans")
    own = F.unhex(F.md5(text_of(text_column)))
    return (
        docs.select(*columns, own.alias("__node"), text_of(text_column).alias("__text"))
        .join(found.withColumnRenamed("node", "__node").withColumnRenamed("spans", "__spans"), "__node", "left")
        .select(*columns, "__text", "__spans")
    )


def removals(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH
) -> DataFrame:
    """``<id>, n_bytes, n_removed, n_spans, kept_sha256`` of every document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            raw, runs = text.encode(), merged(ranges)
            removed = sum(high - low for low, high in runs)
            rows.append((len(raw), removed, len(runs), hashlib.sha256(_kept(raw, runs)).hexdigest()))
        columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns], [id_column, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        _located(docs, [id_column], text_column, length), work,
        f"`{id_column}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    )


def without_repeats(
    docs: DataFrame, text_column: str = "text", count_column: str = "n_chars", length: int = LENGTH
) -> DataFrame:
    """The documents with repeated passages of ``length`` bytes or more cut out; letters are cut whole or stay.

    ``count_column``, if there is one, holds the code points that are left.
    """
    others = [c for c in docs.columns if c not in (text_column, count_column)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("__text")
        kept = []
        for text, ranges in zip(batch.column(at).to_pylist(), batch.column(at + 1).to_pylist(), strict=True):
            if not ranges:
                kept.append(text)
                continue
            raw, runs = text.encode(), []
            inside = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
            for low, high in merged(ranges):
                while inside(low):
                    low += 1
                while inside(high):
                    high -= 1
                runs.append((low, max(low, high)))
            kept.append(_kept(raw, runs).decode())
        return pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(at)), pa.array(kept, pa.string())], [*others, text_column]
        )

    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in [*others, text_column])
    cut = map_batches(_located(docs, others, text_column, length), work, schema)
    if count_column in docs.columns:
        cut = cut.withColumn(count_column, F.length(text_column).cast(fields[count_column]))
    return cut.select(*docs.columns)
