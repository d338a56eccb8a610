"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is the weighted set of its runs of five words (a shorter text is one run), weighted
by how often they stand in it. ProbMinHash signs it: every run sends out points of a Poisson
process with its weight as rate; each point falls on one of REGISTERS registers, which keeps
the earliest, and a run stops when its next point is later than all registers. Two texts
agree in a register with the probability Jaccard similarity

    J(x, y) = sum over common i of 1 / sum_j max(x_j / x_i, y_j / y_i).

Signatures are cut into BANDS bands; texts that share a band are candidates. Of those, pairs that agree in fewer than
MIN_AGREEING registers are let go, and a link is what the exact J of two whole texts confirms
to be THRESHOLD or more. A pair of J = 0.8 shares no band once in 38,000 times, and agrees in
fewer registers once in a hundred million.

Equal texts are one node from the start, so copies make no pairs. In a bucket of a band every
node is held against one pivot, the node that has most company in its buckets: of a group of copies, the text they
were made from or the nearest to it. That links most of the group at once, and says of every node which
of the pivot's runs it misses and which it has of its own: its marks. Two nodes are the nearer the more marks they
share, and their counts say how many they need in common for J = 0.8; two that need none are linked to the
pivot, but for some with repeats, which meet without a mark. The others meet in the rarest of their marks only (see
``marks_of_nodes``), and only if they are not of one component by then: in STAR_ROUNDS rounds every node of a mark is
held against the most popular node of its largest component, then what is of other components
is compared in pairs. So no link between different texts that share a band is lost for the classes, while a
large group of near copies that differ each in their own way costs one comparison for each node, and
nodes that are far from the pivot and from each other meet only where they share a rare mark.

Cases: a null text is empty; texts without words are equal to each other; equal texts have
similarity 1; repeated rows are copies; null ids count as larger than all others for the
representative; an empty table gives an empty result; only id and text are read by
``classes``; ``representatives`` keeps the documents' columns, whatever they are called but ``__own``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pointlake.llm.common import likely, map_batches, mixed, text_of, words_of, written
from pointlake.llm.components import connected

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
MIN_AGREEING = 42  # of J = 0.8, 64 registers agree on average, give or take 3.6
STAR_ROUNDS = 2
CACHE_ENTRIES = 150_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _likely(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of ``nodes`` and a few others, so that a join need not shuffle all texts."""
    return likely(texts, nodes, ["node"])


class Shingles:
    """Weighted word runs of texts, as hashes; word hashes are kept between texts."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes and how often each stands in the text."""
        words = words_of(text)
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        known = self.known
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word.encode())
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(SHINGLE, len(hashes))
        if not width:
            return np.zeros(1, np.uint64), np.ones(1)
        runs = np.zeros(len(hashes) - width + 1, np.uint64)
        for i in range(width):
            runs = mixed(runs * MULTIPLIER + hashes[i : len(hashes) - width + 1 + i])
        values, counts = np.unique(runs, return_counts=True)
        return values, counts.astype(np.float64)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures of weighted sets, one row each; all sets advance together."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(v) for v, _ in sets])
    key = np.concatenate([v for v, _ in sets])
    rate = np.concatenate([w for _, w in sets])
    earliest = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    time, point = np.zeros(len(key)), 0
    while len(key):
        point += 1
        draw = mixed(key + np.uint64(point * int(MULTIPLIER) & (1 << 64) - 1))
        # An exponential step; the low bits choose the register.
        time = time - np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(np.float64) / 2.0**53) / rate
        alive = time < latest[owner]
        owner, key, rate, time, draw = owner[alive], key[alive], rate[alive], time[alive], draw[alive]
        if not len(key):
            break
        slot = owner * registers + (mixed(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, slot, time)
        won = earliest[slot] == time
        winner[slot[won]] = key[won]
        touched = np.unique(owner)
        latest[touched] = earliest.reshape(n, registers)[touched].max(axis=1)
    return winner.reshape(n, registers)


def bands_of(signature: np.ndarray) -> np.ndarray:
    """A hash for every band of every signature."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    out = np.zeros(parts.shape[:2], np.uint64)
    for i in range(ROWS):
        out = mixed(out * MULTIPLIER + parts[:, :, i])
    return out


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The exact probability Jaccard similarity of two weighted sets."""
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    with np.errstate(divide="ignore"):
        ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    below = np.cumsum(x)  # of those whose x_j / x_i is the larger: ratio_j <= ratio_i
    above = y.sum() - np.cumsum(y)
    last = np.searchsorted(ratio, ratio, side="right") - 1
    common = (x > 0) & (y > 0)
    if not common.any():
        return 0.0
    at = last[common]
    return float(np.sum(1.0 / (below[at] / x[common] + above[at] / y[common])))


def node_of(text: Column) -> Column:
    """Equal texts are one node: the digest of the text."""
    return F.unhex(F.md5(text))


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``node, id, bands, signature`` of every document; 16 bits of each register."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingles = Shingles()
        signed = signatures([shingles(t) for t in batch.column(2).to_pylist()])
        found = bands_of(signed)
        offsets = pa.array(np.arange(len(found) + 1, dtype=np.int32) * BANDS)
        lists = pa.ListArray.from_arrays(offsets, pa.array(found.reshape(-1).view(np.int64)))
        ends = pa.array(np.arange(len(signed) + 1, dtype=np.int32) * REGISTERS)
        short = pa.ListArray.from_arrays(ends, pa.array(mixed(signed).astype(np.uint16).view(np.int16).reshape(-1)))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), lists, short], ["node", "id", "bands", "signature"]
        )

    text = text_of(text_column)
    return map_batches(
        docs.select(node_of(text).alias("node"), F.col(id_column).cast("bigint").alias("id"), text.alias("text")),
        work, "node binary, id bigint, bands array<bigint>, signature array<smallint>",
    )


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nodes with the signatures and texts of both."""
    one = lambda side: texts.select(
        F.col("node").alias(side), F.struct("signature", "text").alias(f"of_{side}")
    )
    return (
        pairs.join(one("a"), "a").join(one("b"), "b")
        .select("a", "b", "of_a.signature", F.col("of_b.signature").alias("other"), "of_a.text", F.col("of_b.text").alias("text_b"))
    )


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes whose whole texts are similar enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        registers = [np.asarray(batch.column(i).flatten()).reshape(-1, REGISTERS) for i in (2, 3)]
        close = (registers[0] == registers[1]).sum(1) >= MIN_AGREEING
        batch = batch.filter(pa.array(close))
        shingles, known = Shingles(), {}

        def weighted(node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
            if node not in known:
                known[node] = shingles(text)
            return known[node]

        near = [
            similarity(weighted(a, x), weighted(b, y)) >= THRESHOLD - 1e-9
            for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5)), strict=True)
        ]
        return batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    return map_batches(_with_texts(pairs, texts), work, "a binary, b binary")


COMPARED = (
    "node binary, pivot binary, near boolean, missing int, extra int, repeats int, size int, over int, under int, own array<bigint>, lost array<bigint>, "
    "often array<bigint>, again array<bigint>"
)


def differences(node: tuple[np.ndarray, np.ndarray], pivot: tuple[np.ndarray, np.ndarray]) -> tuple:
    """``missing, extra, repeats, size, over, under, own`` of a node against a pivot (see ``compared``)."""
    _, at, of = np.intersect1d(node[0], pivot[0], assume_unique=True, return_indices=True)
    apart = (node[1][at] - pivot[1][of]).astype(np.int64)
    alien = np.ones(len(node[0]), bool)
    alien[at] = False
    extra = int(alien.sum())
    over = int(np.maximum(apart, 0).sum()) + int(node[1][alien].sum()) - extra
    return (
        len(pivot[0]) - len(at), extra, int(node[1].sum()) - len(node[0]), len(pivot[0]),
        over, int(np.maximum(-apart, 0).sum()), node[0][alien].view(np.int64),
    )


def _lists(arrays: Sequence[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Nodes ``a`` held against their pivots ``b``, with what sets them apart: ``missing`` runs of the
    pivot, the ``own`` runs that it lacks and their number ``extra``, ``repeats`` of runs within
    the node, ``size``, the distinct runs of the pivot, and by how much runs of both stand more often
    (``over``) or less often (``under``) in the node; own runs that stand twice count as over. ``lost`` are the
    missing runs, ``often`` the own ones that stand more than once, ``again`` how often beyond that."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        shingles, known = Shingles(), {}

        def weighted(node: bytes, text: str) -> tuple[np.ndarray, np.ndarray]:
            if node not in known:
                known[node] = shingles(text)
            return known[node]

        rows = []
        for a, b, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, 5)), strict=True):
            node, pivot = shingles(x) if a != b else weighted(a, x), weighted(b, y)
            lost = np.setdiff1d(pivot[0], node[0], assume_unique=True).view(np.int64)
            some = (node[1] > 1) & np.isin(node[0], pivot[0], assume_unique=True, invert=True)
            rows.append((
                similarity(node, pivot) >= THRESHOLD - 1e-9, *differences(node, pivot), lost,
                node[0][some].view(np.int64), node[1][some].astype(np.int64) - 1,
            ))
        near, missing, extra, repeats, size, over, under, own, lost, often, again = zip(*rows, strict=True) if rows else [()] * 11
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(near, pa.bool_()), *[pa.array(v, pa.int32()) for v in (missing, extra, repeats, size, over, under)],
             *map(_lists, (own, lost, often, again))],
            ["node", "pivot", "near", "missing", "extra", "repeats", "size", "over", "under", "own", "lost", "often", "again"],
        )

    return map_batches(_with_texts(pairs, texts), work, COMPARED)


def _pivot_pairs(members: DataFrame) -> DataFrame:
    """Every member ``a`` of a bucket with the bucket's most popular one ``b``: the node that has
    most company in all its buckets. Of a group of copies that is the text they were made from, or the nearest."""
    pivots = (
        members.groupBy("band", "hash").agg(F.max(F.struct("company", "node")).alias("first"))
        .select("band", "hash", F.col("first.node").alias("pivot"))
    )
    return (
        members.join(pivots, ["band", "hash"]).where("node != pivot")
        .select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    )


PROFILE = ("home", "missing", "extra", "alone", "repeats", "size", "over", "under")


def profiles(held: DataFrame, company: DataFrame) -> DataFrame:
    """``pivot, node, company, <PROFILE>, burden``: ``alone`` counts the own runs that no other node of the pivot has,
    ``burden`` their repeats, ``home`` is the most popular of the node's pivots."""
    popular = held.select("node", "pivot").join(company.select(F.col("node").alias("pivot"), F.col("company").alias("n")), "pivot")
    homes = popular.groupBy("node").agg(F.max(F.struct("n", "pivot")).alias("top")).select("node", F.col("top.pivot").alias("home"))
    key = F.xxhash64("node").alias("key")
    tokens = held.select("pivot", key, F.explode("own").alias("run"), F.lit(0).cast("bigint").alias("again")).unionByName(
        held.select("pivot", key, F.explode(F.arrays_zip("often", "again")).alias("of")).select("pivot", "key", F.col("of.often").alias("run"), "of.again")
    )
    alone = (
        tokens.groupBy("pivot", "run")
        .agg(F.count(F.when(F.col("again") == 0, 1)).alias("n"), F.min("key").alias("key"), F.sum("again").alias("again")).where("n = 1")
        .groupBy("pivot", "key").agg(F.count("*").cast("int").alias("alone"), F.sum("again").alias("burden"))
    )
    return (
        held.drop("own", "lost", "often", "again", "near").withColumn("key", F.xxhash64("node")).join(alone, ["pivot", "key"], "left").drop("key")
        .withColumn("alone", F.coalesce("alone", F.lit(0))).withColumn("burden", F.coalesce("burden", F.lit(0)))
        .join(company, "node").join(homes, "node")
    )


def _of(side: str, name: str) -> Column:
    return F.col(f"{side}.{name}" if side else name)


def _own_part(side: str) -> Column:
    """What a node adds to the marks that it needs in common with any other, times 9."""
    return 5 * _of(side, "missing") + 4 * _of(side, "extra") - _of(side, "over")


def _kept_repeats(side: str) -> Column:
    """The repeats of the pivot's runs that a node has, as they stand in the pivot."""
    return _of(side, "repeats") + _of(side, "under") - _of(side, "over")


def _weight(side: str) -> Column:
    """All runs of a node with their repeats."""
    return _of(side, "size") - _of(side, "missing") + _of(side, "extra") + _of(side, "repeats")


def _needed(one: str, other: str) -> Column:
    """9 times the marks that two nodes of a pivot need in common for J >= 0.8, or less.

    Of n runs of the pivot they miss a and b, c of them both; they have u and v own runs, w in common.
    Then they share n - a - b + c + w runs, and a + b - 2c + u + v - 2w stand in one only. With the larger
    weight of each run, J is no more than the weight of runs in common among all; so these weigh 4
    times the others at least: 4 (a + b + u + v - 2c - 2w) <= n - a - b + c + w + q, where q are
    repeats of runs in common: no more than those of the pivot's runs that either has, and what both have over.
    By ``can_be_near`` the larger number of repeats of the two does as well.
    """
    kept = F.least(_kept_repeats(one), _kept_repeats(other))
    over = _of(one, "over") + _of(other, "over")
    q = F.least(kept + over, F.greatest(_of(one, "repeats"), _of(other, "repeats")))
    return _own_part(one) + _own_part(other) + over - _of(one, "size") - q


def can_be_near(one: str, other: str, burden: tuple[str, str] | None = None) -> Column:
    """Whether two nodes of a pivot can have J >= 0.8, by their profiles alone: the marks that they can have
    in common are the fewer of their missing runs, and of their own runs that are not theirs alone.

    A term of J is 1 / (p / x_i + q / y_i) at most, with p + q = 1 for the runs in common and what is in one only
    beside them; such means add up to no more than that of the sums. So J <= 1 / (1 + A / X + B / Y), where X
    and Y are what runs in common weigh in each text and A and B what the others weigh there: 1 each at least, and the
    ``burden`` of those that are theirs alone, where that is known.

    Nodes of one home are held against each other there only: a pivot that is not what they were made from says
    less of them."""
    both_miss = F.least(_of(one, "missing"), _of(other, "missing"))
    both_have = F.least(_of(one, "extra") - _of(one, "alone"), _of(other, "extra") - _of(other, "alone"))
    here = (_of(one, "home") != _of(other, "home")) | (_of(one, "home") == F.col("pivot"))
    a = _of(one, "extra") - both_have + _of(other, "missing") - both_miss
    b = _of(other, "extra") - both_have + _of(one, "missing") - both_miss
    if burden:
        a, b = a + F.col(burden[0]), b + F.col(burden[1])
    x, y = _weight(one) - a, _weight(other) - b
    apart = (x > 0) & (y > 0) & (4 * (a * y + b * x) <= x * y)
    return here & apart & (9 * (both_miss + both_have) >= _needed(one, other))


def least_shared(one: str, other: str) -> Column:
    """How many marks two nodes of a pivot need in common, 1 at least, for J >= 0.8."""
    return F.greatest(F.lit(1), F.ceil(_needed(one, other) / 9))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open_nodes(profiled: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes that can be near one of another component, with ``x``, their profile, ``need``, the marks that
    they need in common with any of those, and ``bare``, whether they need none with some. That holds
    for less when components are joined."""
    known = _labelled(profiled, labels)
    homes = labels.select(F.col("node").alias("pivot"), F.col("label").alias("led"))
    rows = (
        known.join(homes, "pivot", "left").withColumn("led", F.coalesce("led", "pivot")).withColumn("part", _own_part(""))
        .withColumn("beyond", F.col("part") - F.col("size") - _kept_repeats(""))
    )
    # A node of the pivot's component asks for those outside of it; any other may ask for all.
    bounds = (
        rows.groupBy("pivot").agg(
            F.min("part").alias("least"), F.min(F.when(F.col("label") != F.col("led"), F.col("part"))).alias("outside"),
            F.max("over").alias("most_over"), F.min("label").alias("low"), F.max("label").alias("high"),
        )
        .where("low != high").select("pivot", "least", "outside", "most_over")
    )
    # With c marks missed by both and w own ones in common, the other has c and w at least of its own.
    possible = F.expr("beyond <= 4 * missing + 5 * (extra - alone) + most_over") & (5 * F.expr("alone + burden") <= _weight(""))
    by_least = F.col("beyond") + F.when(F.col("label") == F.col("led"), F.col("outside")).otherwise(F.col("least"))
    by_marks = 9 * (F.col("beyond") - F.col("most_over")) / 5
    return (
        rows.join(bounds, "pivot").where(possible)
        .withColumn("need", F.greatest(F.lit(1), F.ceil(F.greatest(by_least, by_marks) / 9)))
        .select("pivot", "node", "company", F.struct(*PROFILE).alias("x"), "burden", "need", (by_least <= 0).alias("bare"))
    )


def marks_of_nodes(open_nodes: DataFrame, held: DataFrame) -> DataFrame:
    """``pivot, run, node, company, x, burden, left``: the marks in which open nodes meet.

    Marks that no other node has can not be in common. A node that needs m marks in common with any other meets each by
    one of all but m - 1 of the rest; the rarest are taken, and ``left`` counts those from this one on. Nodes that need
    none meet in a run of their own, with none left.
    """
    runs = held.select("pivot", "node", F.explode(F.concat("own", "lost")).alias("run")).join(
        open_nodes.select("pivot", "node", "need"), ["pivot", "node"]
    )
    shared = runs.groupBy("pivot", "run").agg(F.count("*").alias("n")).where("n > 1")
    # A node has as many rows here as its text and the pivot's have runs.
    of_node = Window.partitionBy("pivot", "node")
    runs = (
        runs.join(shared, ["pivot", "run"])
        .withColumn("place", F.row_number().over(of_node.orderBy("n", "run"))).withColumn("all", F.count("*").over(of_node))
        .where("place <= all - need + 1").select("pivot", "node", "run", (F.col("all") - F.col("place") + 1).alias("left"))
    )
    bare = open_nodes.where("bare").select("pivot", "node", F.lit(0).cast("bigint").alias("run"), F.lit(0).cast("bigint").alias("left"))
    return runs.unionByName(bare).join(open_nodes.select("pivot", "node", "company", "x", "burden"), ["pivot", "node"])


def _largest(runs: DataFrame) -> DataFrame:
    """``pivot, run, led`` of the runs in which components meet, ``led`` being the one with most nodes there."""
    return (
        runs.groupBy("pivot", "run", "label").agg(F.count("*").alias("n"))
        .groupBy("pivot", "run").agg(F.max(F.struct("n", "label")).alias("top"), F.count("*").alias("labels"))
        .where("labels > 1").select("pivot", "run", F.col("top.label").alias("led"))
    )


def _meet(columns: Sequence[str]) -> Column:
    """Whether two nodes of a mark can be near, as far as their profiles and places tell.

    The first common mark of two nodes, in the order that is one for all nodes of a pivot, has all others behind
    it; so they meet only where both have as many marks ``left``, with this one, as they need in common.
    Those that need none meet where none are left."""
    needed = _needed("x", "y")
    burden = ("burden", "burden_y") if "burden" in columns else None
    return (
        can_be_near("x", "y", burden) & (9 * F.least("left", "left_y") >= needed)
        & ((F.greatest("left", "left_y") == 0) == (needed <= 0))
    )


def _as_other(runs: DataFrame) -> DataFrame:
    """The rows with other names of all columns but those of the mark, ``y`` being the profile."""
    names = {"pivot": "pivot", "run": "run", "x": "y"}
    return runs.select(*[F.col(c).alias(names.get(c, f"{c}_y")) for c in runs.columns])


def _star_pairs(runs: DataFrame) -> DataFrame:
    """Nodes of a mark with the most popular one of its largest component."""
    led = runs.join(_largest(runs), ["pivot", "run"])
    first = [c for c in runs.columns if c not in ("pivot", "run", "company")]
    leaders = (
        led.where("label = led").groupBy("pivot", "run").agg(F.max(F.struct("company", *first)).alias("top"))
        .select("pivot", "run", *[f"top.{c}" for c in first])
    )
    return led.where("label != led").join(_as_other(leaders), ["pivot", "run"]).where(_meet(runs.columns))


def _sharing_pairs(runs: DataFrame) -> DataFrame:
    """Nodes of two components that meet in a mark: at least one is not of the mark's largest component."""
    led = runs.join(_largest(runs), ["pivot", "run"])
    once = (F.col("label_y") == F.col("led")) | (F.col("node") < F.col("node_y"))
    return led.where("label != led").join(_as_other(led.drop("led")).hint("merge"), ["pivot", "run"]).where(
        once & (F.col("label") != F.col("label_y")) & _meet(runs.columns)
    )


def node_classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """``node, label`` of the linked nodes, and ``node, id, copies`` of all nodes."""
    signed = written(sketches(docs, id_column, text_column), "near-sketches")
    nodes = written(
        signed.groupBy("node").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"),
            F.first("bands").alias("bands"), F.first("signature").alias("signature"),
        ),
        "near-nodes",
    )
    rows = nodes.select("node", F.posexplode("bands").alias("band", "hash"))
    shared = rows.groupBy("band", "hash").agg(F.count("*").alias("n")).where("n > 1")
    members = written(rows.join(shared, ["band", "hash"]), "near-members")
    company = written(members.groupBy("node").agg(F.sum("n").alias("company")), "near-company")
    texts = written(
        _likely(docs.select(node_of(text_of(text_column)).alias("node"), text_of(text_column).alias("text")), company)
        # Not a semi join: Spark would move that below the filter, to all texts.
        .join(company.select("node"), "node")
        .groupBy("node").agg(F.first("text").alias("text"))
        .join(nodes.select("node", "signature"), "node"),
        "near-texts",
    )
    held = written(compared(_pivot_pairs(members.join(company, "node")), texts), "near-held")
    labels = connected(held.where("near").select(F.col("node").alias("a"), F.col("pivot").alias("b")))
    profiled = written(profiles(held, company), "near-profiles")
    bare = nodes.drop("bands", "signature")
    open_nodes = written(_open_nodes(profiled, labels), "near-open")
    marks = written(marks_of_nodes(open_nodes, held), "near-marks")
    for turn in range(STAR_ROUNDS + 1):
        runs = written(_labelled(marks, labels), "near-runs")
        pairs = _star_pairs(runs) if turn < STAR_ROUNDS else _sharing_pairs(runs)
        more = written(confirmed(pairs.select(*_ordered("node", "node_y")).distinct(), texts), "near-links")
        if not more.isEmpty():
            # The components so far are stars of links themselves.
            stars = labels.where("node != label").select(F.col("label").alias("a"), F.col("node").alias("b"))
            labels = connected(stars.unionByName(more))
    return labels, bare


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, class_id, class_size, copies`` of every document.

    ``class_id`` is the smallest id of the documents that links and equality join,
    ``class_size`` their number, ``copies`` that of documents with this very text.
    """
    labels, nodes = node_classes(docs, id_column, text_column)
    known = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = known.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_node = written(
        known.join(sizes, "label").select("node", "class_id", "class_size", "copies"), "near-classes"
    )
    return (
        docs.select(F.col(id_column), node_of(text_of(text_column)).alias("node"))
        .join(of_node, "node").select(id_column, "class_id", "class_size", "copies")
    )


def representatives(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One document of every class: the smallest id, then the smallest digest of the text."""
    labels, nodes = node_classes(docs, id_column, text_column)
    first = F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "node")).alias("first")
    kept = written(
        nodes.join(labels, "node", "left").groupBy(F.coalesce("label", "node").alias("label")).agg(first)
        .select(F.col("first.node").alias("__node"), F.col("first.id").alias("__id")),
        "near-kept",
    )
    own = docs.withColumn("__own", node_of(text_of(text_column)))
    same = (F.col("__own") == F.col("__node")) & F.col(id_column).cast("bigint").eqNullSafe(F.col("__id"))
    # Repeated rows of the kept id and text are one document.
    return own.join(kept, same, "left_semi").dropDuplicates(["__own"]).drop("__own")
