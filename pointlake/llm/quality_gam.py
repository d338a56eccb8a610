"""Quality classifier: an additive model with pairwise interactions, boosted in cycles.

Every text has a few numeric features. Their values are put into quantile bins, and the model
is a table per feature and a table per chosen pair of features: the log odds of label 1 are
the sum of the table entries of a document's bins. Training goes round the features again
and again; each turn fits a shallow tree to the residuals by the feature's bins and adds a
little of it to the table. Then the pairs whose best tree explains most of what is left are
trained the same way on coarser bins. Scoring adds table entries, vectorised by batch.

The model is fitted on the driver to at most TRAIN_ROWS labelled documents, those with the
smallest digests of their ids; features of all documents are computed and scored by tasks.
Labels, language, source and id are no features.

Cases: null texts are empty and are scored like any text; without training labels, or with
labels of one kind only, every score is the (smoothed) share of label 1; repeated labels
of a document count once, by their mean; documents without label are scored, labels without
document ignored; repeated rows score alike; an empty table gives an empty result; the result
holds the id and its own columns, so other columns cannot clash.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import map_batches, text_of, words_of

TRAIN_ROWS = 20_000
BINS, PAIR_BINS = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 150, 60, 6
RATE = 0.1
LEAVES = 4
MIN_LEAF = 5
SMOOTHING = 1.0
FEATURES = (
    "words", "word_length", "upper", "symbols", "exclaimed", "digits", "distinct_words",
    "top_word", "word_again", "distinct_runs", "lines", "line_again", "stops", "bars", "other_signs", "odd_ends",
)
SYMBOLS = "#*$%&<>"


def features_of(text: str) -> list[float]:
    """The features of one whole text, in order of FEATURES."""
    words = words_of(text)
    n, chars = max(len(words), 1), max(len(text), 1)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    letters = sum(map(len, words))
    signs = {s: text.count(s) for s in SYMBOLS}
    symbols = sum(signs.values())
    runs = max(len(words) - 2, 0)
    upper = sum(len(w) for w in counts.elements() if len(w) > 1 and w.isupper())
    return [
        np.log1p(len(words)),
        letters / n,
        upper / max(letters, 1),
        symbols / chars,
        text.count("!") / n,
        sum(text.count(d) for d in "0123456789") / chars,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:], words[2:], strict=False))) / runs if runs else 1.0,
        len(lines) / n,
        (len(lines) - len(set(lines))) / max(len(lines), 1),
        (text.count(".") + text.count("?")) / n,
        text.count("|") / n,
        sum(text.count(s) for s in "@=/_{}[]~^\\") / chars,
        sum(not w[-1].isalnum() for w in words) / n,
    ]


@dataclass
class Model:
    """Bin limits and tables; the log odds are ``base`` plus one entry of every table."""

    base: float
    limits: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_limits: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, values: np.ndarray) -> np.ndarray:
        odds = np.full(len(values), self.base)
        for j, (limits, entries) in enumerate(zip(self.limits, self.tables, strict=True)):
            odds += entries[np.searchsorted(limits, values[:, j], side="right")]
        for (a, b), entries in zip(self.pairs, self.pair_tables, strict=True):
            odds += entries[
                np.searchsorted(self.pair_limits[a], values[:, a], side="right"),
                np.searchsorted(self.pair_limits[b], values[:, b], side="right"),
            ]
        return 1.0 / (1.0 + np.exp(-odds))


def _limits(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins, method="nearest"))


def _gain(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    return grad * grad / (hess + SMOOTHING)


def shallow_tree(grad: np.ndarray, hess: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Leaf values by bin: the best splits, up to LEAVES leaves, of per-bin sums."""
    leaves = [(0, len(grad))]
    while len(leaves) < LEAVES:
        best, found = 1e-9, None
        for low, high in leaves:
            if high - low < 2:
                continue
            g, h, c = (np.cumsum(x[low:high]) for x in (grad, hess, count))
            gains = _gain(g[:-1], h[:-1]) + _gain(g[-1] - g[:-1], h[-1] - h[:-1]) - _gain(g[-1], h[-1])
            gains = np.where((c[:-1] >= MIN_LEAF) & (c[-1] - c[:-1] >= MIN_LEAF), gains, 0)
            at = int(np.argmax(gains))
            if gains[at] > best:
                best, found = gains[at], (low, high, low + at + 1)
        if found is None:
            break
        low, high, cut = found
        leaves.remove((low, high))
        leaves += [(low, cut), (cut, high)]
    out = np.zeros(len(grad))
    for low, high in leaves:
        out[low:high] = grad[low:high].sum() / (hess[low:high].sum() + SMOOTHING)
    return out


def pair_tree(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cut of both features into four leaves, as a table, and its gain."""
    sums = [np.pad(np.cumsum(np.cumsum(x, 0), 1), ((1, 0), (1, 0))) for x in (grad, hess)]
    rows, columns = grad.shape
    total = _gain(sums[0][-1, -1], sums[1][-1, -1])
    cuts = [
        [s[1:rows, 1:columns], s[1:rows, -1:] - s[1:rows, 1:columns], s[-1:, 1:columns] - s[1:rows, 1:columns],
         s[-1, -1] - s[1:rows, -1:] - s[-1:, 1:columns] + s[1:rows, 1:columns]]
        for s in sums
    ]
    if rows < 2 or columns < 2:
        return np.zeros_like(grad), 0.0
    gains = sum(_gain(g, h) for g, h in zip(*cuts, strict=True)) - total
    at = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = [g[at] / (h[at] + SMOOTHING) for g, h in zip(*cuts, strict=True)]
    out = np.empty_like(grad)
    i, j = at[0] + 1, at[1] + 1
    out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = values
    return out, float(gains[at])


def fit(values: np.ndarray, labels: np.ndarray) -> Model:
    """The model of labelled feature rows."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    model = Model(float(np.log(share / (1 - share))))
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    width = values.shape[1]
    model.limits = [_limits(values[:, j], BINS) for j in range(width)]
    bins = [np.searchsorted(model.limits[j], values[:, j], side="right") for j in range(width)]
    sizes = [len(x) + 1 for x in model.limits]
    model.tables = [np.zeros(s) for s in sizes]
    odds = np.full(len(labels), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-odds))
        return labels - p, p * (1 - p)

    counts = [np.bincount(b, minlength=s) for b, s in zip(bins, sizes, strict=True)]
    for _ in range(ROUNDS):
        for j in range(width):
            grad, hess = (np.bincount(bins[j], x, sizes[j]) for x in slopes())
            step = RATE * shallow_tree(grad, hess, counts[j])
            model.tables[j] += step
            odds += step[bins[j]]
    model.pair_limits = [_limits(values[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(model.pair_limits[j], values[:, j], side="right") for j in range(width)]
    sizes = [len(x) + 1 for x in model.pair_limits]

    def sums(a: int, b: int) -> list[np.ndarray]:
        cell = coarse[a] * sizes[b] + coarse[b]
        return [np.bincount(cell, x, sizes[a] * sizes[b]).reshape(sizes[a], sizes[b]) for x in slopes()]

    gains = {pair: pair_tree(*sums(*pair))[1] for pair in combinations(range(width), 2)}
    model.pairs = [p for p in sorted(gains, key=lambda p: (-gains[p], p))[:PAIRS] if gains[p] > 0]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (a, b), entries in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * pair_tree(*sums(a, b))[0]
            entries += step
            odds += step[coarse[a], coarse[b]]
    return model


def fold_of(id_column: str | Column) -> Column:
    """The checksum of the id as text, modulo 3; fold 1 is held out."""
    key = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Model:
    """A model of the labelled documents outside the held-out fold."""
    key = labels[id_column]
    chosen = (
        labels.where(key.isNotNull() & labels[label_column].isNotNull() & (fold_of(key) != 1))
        .groupBy(key.alias("__id")).agg((F.avg(label_column) >= 0.5).cast("int").alias("__label"))
        .orderBy(F.md5(F.col("__id").cast("string"))).limit(TRAIN_ROWS)
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = [features_of(t) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.float64()))], ["label", "values"])

    sample = docs.select(F.col(id_column).alias("__id"), text_of(text_column).alias("__text")).join(
        F.broadcast(chosen), "__id"  # TRAIN_ROWS rows at most
    )
    rows = map_batches(sample.select("__label", "__text"), work, "label int, values array<double>").toPandas()
    values = np.array(rows["values"].tolist(), float).reshape(len(rows), len(FEATURES))
    order = np.lexsort((*values.T, rows["label"].to_numpy()))
    return fit(values[order], rows["label"].to_numpy(float)[order])


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``<id>, held_out, score, predicted`` of every document."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([features_of(t) for t in batch.column(2).to_pylist()])
        scores = model.score(values)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
            [id_column, "held_out", "score", "predicted"],
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, (fold_of(id_column) == 1).alias("held_out"), text_of(text_column).alias("__text")),
        work, f"`{id_column}` {kind}, held_out boolean, score double, predicted int",
    )
