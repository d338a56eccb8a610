"""The additive model on planted effects and on the labelled table, held out."""

import random
import zlib

import numpy as np
from cases import documents, empty, frame, prose

from pointlake.llm import quality_gam


def rank_quality(scores, labels):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(len(scores))
    good = labels == 1
    return (rank[good].sum() - good.sum() * (good.sum() - 1) / 2) / (good.sum() * (~good).sum())


def test_tables_and_pairs_learn_planted_effects():
    rng = np.random.default_rng(5)
    values = rng.normal(size=(4000, 4))
    odds = 3 * (np.abs(values[:, 0]) < 0.7) - 1.5 + 4 * (values[:, 1] > 0) * (values[:, 2] > 0) - 1
    labels = (rng.random(4000) < 1 / (1 + np.exp(-odds))).astype(float)
    model = quality_gam.fit(values[:3000], labels[:3000])
    assert model.pairs[0] == (1, 2)
    truth = rank_quality(odds[3000:], labels[3000:])
    assert rank_quality(model.score(values[3000:]), labels[3000:]) > truth - 0.02


def test_a_tree_cuts_where_the_gain_is():
    grad, hess = np.array([-5.0, -5, 4, 4, 4, -5]), np.full(6, 10.0)
    table = quality_gam.shallow_tree(grad, hess, np.full(6, 50))
    assert (np.sign(table) == [-1, -1, 1, 1, 1, -1]).all() and len(set(table)) == 3


def labelled():
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(240):
        good = i % 3 > 0
        text = prose(i, rng.randrange(30, 200))
        rows.append((i, text if good else " ".join(w + "%%%" for w in text.split()), "a"))
        labels.append((i, int(good)))
    return rows, labels


def test_held_out_documents(spark):
    rows, labels = labelled()
    docs = frame(spark, [*rows, *documents()])
    table = spark.createDataFrame([*labels, (5, 1), (None, 1), (7, None), (99_999, 0)], "doc_id long, quality int")
    found = quality_gam.score(docs, quality_gam.train(docs, table)).collect()
    assert len(found) == len(rows) + len(documents())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    truth = dict(labels)
    held = [(r.score, truth[r.doc_id]) for r in found if r.held_out and r.doc_id in truth and r.doc_id >= 20]
    assert rank_quality(np.array([s for s, _ in held]), np.array([q for _, q in held])) > 0.98


def test_held_out_labels_are_not_seen(spark):
    rows, labels = labelled()
    docs = frame(spark, rows)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in labels]
    models = [quality_gam.train(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (labels, turned)]
    assert all((a == b).all() for a, b in zip(models[0].tables, models[1].tables, strict=True))


def test_no_labels_one_label_no_documents(spark):
    docs = frame(spark, documents())
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality_gam.score(docs, quality_gam.train(docs, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "doc_id long, quality int")
    assert all(r.score > 0.5 for r in quality_gam.score(docs, quality_gam.train(docs, ones)).collect())
    model = quality_gam.train(empty(spark), ones)
    assert quality_gam.score(empty(spark), model).count() == 0
