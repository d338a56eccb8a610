"""Targets and selections of the mix against sorting."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from cases import DOCS, documents, empty, frame
from pyspark.sql import functions as F

from pointlake.llm import mixing, queries


def digest(i):
    return int(hashlib.md5(("null" if i is None else str(i)).encode()).hexdigest()[:15], 16)


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def expected(rows):
    totals = defaultdict(int)
    for _, text, source in rows:
        totals[source] += size(text)
    names = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(totals.values()) - sum(3 * totals[s] for s in capped)
        weights = sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and rest * weight[s] > 3 * totals[s] * weights}
        if not over:
            break
        capped |= over
    target = {s: float(3 * totals[s]) if s in capped else rest * weight[s] / weights for s in names}
    out = []
    for s in names:
        own = [(digest(i), i, size(t)) for i, t, x in rows if x == s]
        rounds = int(target[s] // totals[s]) if totals[s] else 0
        budget = int(target[s]) - rounds * totals[s]
        for h, i, n in own:
            upto = sum(m for g, _, m in own if g <= h)
            out.append((str(i), n, totals[s], round(target[s], 6), n * (rounds + (upto <= budget))))
    return sorted(out)


ROWS = [*documents(), *[(1000 + i, "w " * (i % 7), f"s{i % 11}" if i % 3 else "a") for i in range(300)]]


@pytest.mark.parametrize("levels", [mixing.LEVEL_BITS, (2, 3, 5, 50)], ids=["wide", "narrow"])
def test_mix(spark, levels, monkeypatch):
    monkeypatch.setattr(mixing.thresholds, "__defaults__", (levels,))
    found = mixing.mix(frame(spark, ROWS)).collect()
    got = sorted((str(r.doc_id), r["size"], r.source_size, round(r.target, 6), r["size"] * r.repeats) for r in found)
    assert got == expected(ROWS)


def test_sql(spark, folder):
    frame(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    found = queries.op10_mixing(spark, folder)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = duck.execute(queries.QUERIES["op10_mixing"].oracle)
    assert [d[0] for d in want.description] == found.columns
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in found.collect())


def test_documents_are_repeated(spark):
    docs = frame(spark, ROWS)
    taken = {}
    for r in mixing.mix(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.repeats
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in taken.items() if n}


def test_smaller_budgets_are_nested(spark):
    sized = spark.range(500).select(
        F.lit("s").alias("source"), mixing.hash_of("id").alias("hash"), (F.col("id") % 9).alias("size")
    )
    limits = []
    for target in (100.0, 700.5, 1500.0):
        targets = spark.createDataFrame([("s", 1994, target)], "source string, source_size long, target double")
        limits.append(mixing.thresholds(sized, targets).first().limit_hash)
    assert limits == sorted(limits) and limits[0] > 0


def test_without_words_and_without_rows(spark):
    blank = spark.createDataFrame([(1, "", "en", "a", 0, "", "", ""), (2, None, "en", None, 0, "", "", "")], DOCS)
    assert [r.repeats for r in mixing.mix(blank).collect()] == [0, 0] or mixing.mix(blank).count() == 2
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed_documents(empty(spark)).count() == 0
