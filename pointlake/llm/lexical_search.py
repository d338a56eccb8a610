"""Ranked lexical search over a K2-treap of the term-document grid.

A first pass cuts the texts into terms, on their bytes, and keeps for each document its length
and its counts of the terms that the items use. Sums over these rows give the statistics of the
corpus. A second pass deals the documents into blocks. The grid of a block has a row for each
term and a column for each document, like documents together; a cell holds the impact of the term
there. The K2-treap is the quadtree of that grid: a node for every square that holds anything,
with a byte for its four children, the place of the first of them, and the largest impact within,
stored as what it lacks of its parent's. Rows of one item lie beside each other, frequent ones
apart, and every band of a few rows has a square grid of its own, over all columns.

A query starts with all documents. A state is a range of documents with, for each term of an
item, the node whose square has the term's row and that range; the sum of their maxima bounds every
score in the range. The states with the highest bounds are opened first: the range is halved, and
all paths go down together. A range of one document has its exact score. States below the item's
k-th best score are dropped; at that score, only a smaller id can still win. Blocks of one task hand their
best documents on to the next, and the best of all tasks are ranked by item.

Items are worked off in sets of about ITEM_BYTES, a pass over the documents each, so what the
driver and the tasks hold of them is bounded. Terms meet by a 64-bit hash.

Cases: a null text has no terms; documents without a term of an item are not listed for it; an
item without terms, or with terms that no document has, gives no rows; rows of one ``item_id`` are
one item with all their terms; null ids count as the smallest; repeated documents are listed
each; empty tables give an empty result; only ids and texts are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pointlake.llm.common import id_array, map_batches, mixed, ready_workers, written

TOP = 10
ITEM_BYTES = 8 << 20
BLOCK_POINTS = 1_500_000
BLOCK_DOCS = 1 << 16
OPENED = 128  # states of an item that are opened at a time
SIGNS = 24  # frequent terms that decide which documents lie together
NO_ID = np.iinfo(np.int64).min

# -- terms -------------------------------------------------------------------------------

_byte = np.arange(256)
IS_TERM = (
    ((_byte >= 0x30) & (_byte <= 0x39)) | ((_byte >= 0x41) & (_byte <= 0x5A))
    | ((_byte >= 0x61) & (_byte <= 0x7A)) | (_byte >= 0x80)
)
LOWER = np.where((_byte >= 0x41) & (_byte <= 0x5A), _byte + 32, _byte)
BYTE_VALUE = mixed(LOWER.astype(np.uint64) + np.uint64(1))
BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, n.bit_length())
        _powers[:] = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers[0][:n], _powers[1][:n]


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The text and the hash of every term, in order."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    term = IS_TERM[data]
    # A term starts after a sign or with its text, and ends before a sign or with its text.
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(term & (cut[:-1] | ~np.r_[False, term[:-1]]))
    ends = np.flatnonzero(term & (cut[1:] | ~np.r_[term[1:], False])) + 1
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up, out=sums[1:])
    length = (ends - starts).astype(np.uint64)
    hashes = mixed((sums[ends] - sums[starts]) * down[starts] + length * np.uint64(BASE))
    return np.searchsorted(offsets, starts, side="right") - 1, hashes


@dataclass(frozen=True)
class Items:
    """Items and their terms: term t of item i has hash ``hashes[rows[t]]``."""

    ids: list[int | None]
    of: np.ndarray  # the item of each entry, ascending
    rows: np.ndarray  # the term of each entry
    hashes: np.ndarray  # ascending

    @staticmethod
    def read(table: pa.Table) -> Items:
        ids = table.column("item_id").to_pylist()
        names = sorted(set(ids), key=lambda i: (i is not None, i))
        number = {name: k for k, name in enumerate(names)}
        places, hashes = terms_of(table.column("text").combine_chunks())
        own = np.asarray([number[i] for i in ids], np.int64)[places]
        distinct, inverse = np.unique(hashes, return_inverse=True)
        pairs = np.unique(own * len(distinct) + inverse)
        return Items(names, pairs // max(len(distinct), 1), pairs % max(len(distinct), 1), distinct)


POSTINGS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"


def postings(docs: DataFrame, hashes: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, counts``: terms of each document, and how often those of ``hashes`` occur."""
    width = 1 << 20
    some = np.zeros(width, bool)
    some[hashes % np.uint64(width)] = True

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        places, found = terms_of(batch.column("text"))
        lengths = np.bincount(places, minlength=n)
        maybe = some[found % np.uint64(width)]
        places, found = places[maybe], found[maybe]
        rows = np.minimum(np.searchsorted(hashes, found), max(len(hashes) - 1, 0))
        known = hashes[rows] == found if len(hashes) else np.zeros(0, bool)
        pairs, counts = np.unique(places[known] * max(len(hashes), 1) + rows[known], return_counts=True)
        offsets = np.searchsorted(pairs, np.arange(n + 1) * max(len(hashes), 1)).astype(np.int32)
        lists = [
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32)))
            for v in (pairs % max(len(hashes), 1), counts)
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(lengths, pa.int64()), *lists], names=["doc_id", "n", "terms", "counts"]
        )

    return map_batches(docs, count, POSTINGS)


# -- the K2-treap ------------------------------------------------------------------------


def spread(values: np.ndarray) -> np.ndarray:
    """The bits of 31-bit numbers at every second place."""
    v = values.astype(np.uint64)
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555),
    ):
        v = (v | (v << np.uint64(shift))) & np.uint64(mask)
    return v.astype(np.int64)


SET_BITS = np.array([bin(i).count("1") for i in range(16)], np.int32)
BAND_BITS = 4


class K2Treap:
    """Maxima of all squares of sparse grids, level by level from whole grids down to their cells.

    Rows come in bands of 2^BAND_BITS. A band is a square grid whose rows are spread over its whole
    height, so that a few halvings tell them apart and what is left of a square is one row.
    ``children`` has a bit for each quarter (2 * lower rows + right columns) that holds
    anything, ``first`` the number of the first child's node, and ``lacks`` what a node's
    maximum lacks of its parent's.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int):
        self.depth = max(BAND_BITS, (width - 1).bit_length(), 1)
        code = (rows >> BAND_BITS << (2 * self.depth)) | (spread(self.height_of(rows)) << 1) | spread(columns)
        order = np.argsort(code, kind="stable")
        code, top = code[order], values[order].astype(np.int64)
        levels = []
        children = np.zeros(len(code), np.uint8)
        starts = np.zeros(len(code), np.int32)
        for _ in range(self.depth):
            above = code >> 2
            begin = np.flatnonzero(np.r_[True, above[1:] != above[:-1]])
            best = np.maximum.reduceat(top, begin)
            lacks = np.repeat(best, np.diff(np.r_[begin, len(code)])) - top
            levels.append((children, starts, lacks.astype(np.uint32) if best.max() < 1 << 32 else lacks))
            children = np.bitwise_or.reduceat((1 << (code & 3)).astype(np.uint8), begin)
            starts, code, top = begin.astype(np.int32), above[begin], best
        levels.append((children, starts, np.zeros(len(code), np.uint32)))
        levels.reverse()
        # The first nodes are those of the bands.
        self.bands, self.peaks = code, top
        after = np.cumsum([len(level[0]) for level in levels])
        self.children = np.concatenate([level[0] for level in levels])
        self.first = np.concatenate([s + np.int32(a) for (_, s, _), a in zip(levels, after, strict=True)])
        self.lacks = np.concatenate([level[2] for level in levels])

    def height_of(self, rows: np.ndarray) -> np.ndarray:
        """Where a row lies in its band's grid."""
        return (rows & ((1 << BAND_BITS) - 1)) << (self.depth - BAND_BITS)

    def roots(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which rows' bands hold anything, and the nodes of their grids."""
        band = rows >> BAND_BITS
        node = np.minimum(np.searchsorted(self.bands, band), len(self.bands) - 1)
        return self.bands[node] == band, node

    def halves(self, node: np.ndarray, lower: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For the left and the right columns of these rows: which nodes go on, and where."""
        mask, quarter = self.children[node], (2 * lower).astype(np.uint8)
        left = self.first[node] + SET_BITS[mask & ((1 << quarter) - 1).astype(np.uint8)]
        has_left, has_right = (mask >> quarter) & 1, (mask >> (quarter + np.uint8(1))) & 1
        return [(has_left == 1, left), (has_right == 1, left + has_left)]


@dataclass
class Best:
    """The best documents of each item so far."""

    k: int
    item: np.ndarray
    score: np.ndarray
    doc: np.ndarray
    least: np.ndarray  # the k-th best score of each item, 0 without one
    last: np.ndarray  # its document

    @staticmethod
    def none(items: int, k: int) -> Best:
        empty = np.zeros(0, np.int64)
        return Best(k, empty, empty, empty, np.zeros(items, np.int64), np.full(items, NO_ID))

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        item, score, doc = (np.r_[a, b] for a, b in ((self.item, item), (self.score, score), (self.doc, doc)))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        begin = np.searchsorted(item, item, side="left")
        kept = np.arange(len(item)) - begin < self.k
        self.item, self.score, self.doc = item[kept], score[kept], doc[kept]
        last = np.flatnonzero(np.arange(len(item)) - begin == self.k - 1)
        self.least[item[last]], self.last[item[last]] = score[last], doc[last]

    def open(self, item: np.ndarray, bound: np.ndarray, smallest: np.ndarray) -> np.ndarray:
        """Which ranges, with their smallest documents, can still hold one of the best."""
        least = self.least[item]
        return (bound > least) | ((bound == least) & (least > 0) & (smallest < self.last[item]))


class Ranges:
    """The documents of all ranges that halving a block gives: the smallest of each."""

    def __init__(self, ids: np.ndarray, depth: int):
        self.depth = depth
        levels = [np.r_[ids, np.full((1 << depth) - len(ids), np.iinfo(np.int64).max)]]
        for _ in range(depth):
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        # Level k, with 2^k ranges, starts at 2^k - 1.
        self.least = np.concatenate(levels[::-1])

    def smallest(self, level: np.ndarray, start: np.ndarray) -> np.ndarray:
        return self.least[(1 << level) - 1 + (start >> (self.depth - level))]


def within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def descend(treap: K2Treap, ids: np.ndarray, of: np.ndarray, rows: np.ndarray, best: Best, opened: int = OPENED) -> None:
    """Best first over the ranges of documents for all items; the entries of an item lie together.

    ``ids`` are the documents of the columns. States are item, level, first column and bound,
    and point to their entries: node, place of the row, maximum.
    """
    present, node = treap.roots(rows)
    of, node, height, top = of[present], node[present].astype(np.int32), treap.height_of(rows[present]), treap.peaks[node[present]]
    height = height.astype(np.int32)
    if not len(of):
        return
    ranges = Ranges(ids, treap.depth)
    begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    count = np.diff(np.r_[begin, len(of)])
    item, level, start = of[begin], np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    bound = np.add.reduceat(top, begin)
    while len(item):
        live = np.flatnonzero(best.open(item, bound, ranges.smallest(level, start)))
        order = live[np.lexsort((start[live], -bound[live], item[live]))]
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order], side="left")
        now, later = order[rank < opened], order[rank >= opened]
        if not len(now):
            break
        own = count[now]
        here = np.repeat(begin[now], own) + within(own)
        state = np.repeat(np.arange(len(now)), own)
        low, places, maxima = treap.depth - 1 - level[now], height[here], top[here]
        fresh = []
        for half, (has, child) in enumerate(treap.halves(node[here], (places >> low[state]) & 1)):
            child, value = child[has], maxima[has] - treap.lacks[child[has]]
            total = np.bincount(state[has], minlength=len(now))
            ends = np.cumsum(total)
            running = np.r_[0, np.cumsum(value)]
            sums = running[ends] - running[ends - total]
            fresh.append([
                item[now], level[now] + 1, start[now] + (half << low), sums, total, ends - total, child, places[has], value,
            ])
        for part in fresh:
            leaf = (part[1] == treap.depth) & (part[4] > 0)
            if leaf.any():
                best.add(part[0][leaf], part[3][leaf], ids[part[2][leaf]])
        parts = [[x[later] for x in (item, level, start, bound, count, begin)] + [node, height, top]]
        for part in fresh:
            on = (part[1] < treap.depth) & (part[4] > 0)
            on[on] = best.open(part[0][on], part[3][on], ranges.smallest(part[1][on], part[2][on]))
            kept = np.repeat(part[5][on], part[4][on]) + within(part[4][on])
            states = [x[on] for x in part[:5]]
            parts.append([*states, np.cumsum(states[4]) - states[4], *(x[kept] for x in part[6:])])
        # Entries of states that are gone stay until they are half of all.
        if len(node) > 2 * int(parts[0][4].sum()) + 4096:
            old = parts[0]
            kept = np.repeat(old[5], old[4]) + within(old[4])
            parts[0] = [*old[:5], np.cumsum(old[4]) - old[4], *(x[kept] for x in old[6:])]
        base = np.cumsum([0, *(len(p[6]) for p in parts[:-1])])
        for p, b in zip(parts, base, strict=True):
            p[5] = p[5] + b
        item, level, start, bound, count, begin, node, height, top = (np.concatenate(x) for x in zip(*parts, strict=True))


# -- the search --------------------------------------------------------------------------


def impacts(weights: np.ndarray, counts: np.ndarray, lengths: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term adds to the score of a document of that length, in whole numbers."""
    if 90 * int(lengths.max(initial=0)) * documents < 1 << 63:
        scaled = (90 * lengths * documents) // terms
    else:
        scaled = np.array([90 * n * documents // terms for n in lengths.tolist()], np.int64)
    return weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * (10 + scaled)))


def row_order(items: Items, frequency: np.ndarray, documents: int) -> np.ndarray:
    """The grid row of each term: frequent terms first, then by the first item that has them."""
    first = np.full(len(items.hashes), len(items.ids))
    np.minimum.at(first, items.rows, items.of)
    frequent = frequency * 50 >= documents
    frequent[np.argsort(-frequency, kind="stable")[:SIGNS]] = True
    order = np.lexsort((items.hashes, -frequency, np.where(frequent, 0, first), ~frequent))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place


def column_order(own: np.ndarray, rows: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The documents of a block so that like ones lie together: by which of the most frequent
    terms they hold, most frequent first, then by length. Ranges then bound their scores well."""
    signs = np.zeros(len(ids), np.int64)
    for sign in range(SIGNS):
        signs[own[rows == sign]] |= 1 << (SIGNS - 1 - sign)
    return np.lexsort((ids, lengths, signs))


def search_block(block: pa.Table, items: Items, weights: np.ndarray, place: np.ndarray, documents: int, terms: int, best: Best) -> None:
    """Builds the block's K2-treap and lets all items look for their best documents in it."""
    ids, missing = id_array(block.column("doc_id").combine_chunks())
    ids = np.where(missing, NO_ID, ids)
    lists = block.column("terms").combine_chunks()
    own = np.repeat(np.arange(len(ids)), np.diff(np.asarray(lists.offsets)))
    term = np.asarray(lists.flatten()).astype(np.int64)
    counts = np.asarray(block.column("counts").combine_chunks().flatten()).astype(np.int64)
    lengths = np.asarray(block.column("n").to_numpy()).astype(np.int64)
    value = impacts(weights[term], counts, lengths[own], documents, terms)
    some = value > 0
    if not some.any():
        return
    own, rows, value = own[some], place[term[some]], value[some]
    order = column_order(own, rows, lengths, ids)
    column = np.empty(len(order), np.int64)
    column[order] = np.arange(len(order))
    treap = K2Treap(rows, column[own], value, len(ids))
    present = np.zeros(len(place), bool)
    present[rows] = True
    kept = present[place[items.rows]]
    descend(treap, ids[order], items.of[kept], place[items.rows[kept]], best)


def best_documents(
    found: DataFrame, items: Items, frequency: np.ndarray, documents: int, terms: int, k: int, points: int = BLOCK_POINTS
) -> DataFrame:
    """``item_id, doc_id, score``: the best documents of every task for each item."""
    ready_workers(found.sparkSession)
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)
    place = row_order(items, frequency, documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, size, docs = Best.none(len(items.ids), k), [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size, docs = size + len(batch.column("terms").flatten()), docs + batch.num_rows
            if size >= points or docs >= BLOCK_DOCS:
                search_block(pa.Table.from_batches(held), items, weights, place, documents, terms, best)
                held, size, docs = [], 0, 0
        if held:
            search_block(pa.Table.from_batches(held), items, weights, place, documents, terms, best)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([items.ids[i] for i in best.item.tolist()], pa.int64()),
                pa.array([None if d == NO_ID else d for d in best.doc.tolist()], pa.int64()), pa.array(best.score, pa.int64()),
            ],
            names=["item_id", "doc_id", "score"],
        )

    return found.where("n > 0").mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents with the highest scores of each item.

    Scores are whole numbers; equal scores are in order of the ids.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    asked = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text")
    size = asked.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    sets = max(1, math.ceil(2 * size / ITEM_BYTES))
    results = []
    for number in range(sets if size else 0):
        own = Items.read(asked.where(F.pmod(F.xxhash64("item_id"), F.lit(sets)) == number).toArrow())
        found = written(postings(texts, own.hashes), "postings")
        documents, terms = found.where("n > 0").agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        frequency = np.zeros(len(own.hashes), np.int64)
        # At most one row for each term of the items.
        for r in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            frequency[r.term] = r["count"]
        results.append(written(best_documents(found, own, frequency, documents, terms, k), "best-documents"))
    if not results:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    merged = results[0]
    for more in results[1:]:
        merged = merged.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first())
    ranked = merged.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score")
    return ranked.where(F.col("rank") <= k)
