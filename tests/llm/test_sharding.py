"""Packing against a plain best fit, and what the shards of documents must keep."""

import random
import zlib
from collections import defaultdict

import pytest
from cases import documents, empty, frame
from pyspark.sql import functions as F

from pointlake.llm import queries, sharding


def plain_best_fit(sizes, capacity):
    """Best fit by looking at every bin."""
    left, out = [], []
    for s in sizes:
        fits = [(r, i) for i, r in enumerate(left) if r >= s]
        if s <= capacity and fits:
            i = min(fits)[1]
            left[i] -= s
        else:
            i = len(left)
            left.append(max(capacity, s) - s)
        out.append(i)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_best_fit(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.choice([rng.randrange(16, 40), rng.randrange(16, 900)]) for _ in range(400)), reverse=True)
    for capacity in (100, 500, 3000):
        assert sharding.best_fit(sizes, capacity) == plain_best_fit(sizes, capacity)


def test_tree_stays_balanced():
    tree = sharding.CapacityTree()
    for i in range(20_000):
        tree.insert((i, i))

    def depth(node):
        return 0 if node is None else 1 + max(depth(node[2]), depth(node[3]))

    assert depth(tree.root) < 60
    assert [tree.take_tightest(5000) for _ in range(3)] == [(5000, 5000), (5001, 5001), (5002, 5002)]
    assert tree.take_tightest(20_000) is None


def test_into_shards():
    sizes = sorted([1000, *[random.Random(i).randrange(16, 80) for i in range(600)]], reverse=True)
    shards = sharding.into_shards(sizes, 8)
    filled = defaultdict(int)
    for s, b in zip(sizes, shards, strict=True):
        filled[b] += s
    assert sorted(filled) == list(range(8)) and max(filled.values()) - min(filled.values()) <= 16 * 8
    # One size above the mean is alone.
    sizes = [10_000, *sizes[1:]]
    shards = sharding.into_shards(sizes, 8)
    assert shards.count(shards[0]) == 1 and len(set(shards)) == 8
    assert sharding.into_shards([5, 4], 40) == [0, 1] and sharding.into_shards([], 40) == []


ROWS = [*documents(), *[(2000 + i, f"copied {'text ' * 30}", "a") for i in range(150)], *[(3000 + i, "w" * (i % 90), "b") for i in range(400)]]


def check(rows, found, shards):
    assert len(found) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in found) == want
    by_text, slots, filled = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in found:
        by_text[r.text_crc32, r["size"]].add(r.shard)
        slots[r.shard].append(r.slot)
        filled[r.shard] += r["size"]
        assert r.law == "bytes" and r.grown_shard is None
    assert all(len(s) == 1 for s in by_text.values()) and set(filled) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return filled


def test_documents(spark, folder, monkeypatch):
    frame(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    filled = check(ROWS, queries.op12_sharding(spark, folder).collect(), 40)
    # Texts above the mean are alone, the others near the mean of what is left.
    groups = defaultdict(int)
    for _, t, _ in ROWS:
        groups[t or ""] += len((t or "").encode()) + 16
    rest = sorted(v for v in filled.values() if v not in groups.values())
    assert len(rest) > 30 and rest[-1] - rest[0] < 100
    for tasks in (1, 60):
        monkeypatch.setattr(sharding, "GROUPS_PER_TASK", tasks)
        check(ROWS, sharding.placed(frame(spark, ROWS), 7).collect(), 7)


def test_reruns_agree(spark):
    runs = [sorted(map(str, sharding.placed(frame(spark, ROWS, n), 9).collect())) for n in (2, 5)]
    assert runs[0] == runs[1]


def test_to_capacity(spark, monkeypatch):
    monkeypatch.setattr(sharding, "GROUPS_PER_TASK", 80)
    capacity = 4000
    found = sharding.shard(frame(spark, ROWS), None, capacity).select("doc_id", "text", "shard").collect()
    filled, groups = defaultdict(int), defaultdict(set)
    for r in found:
        filled[r.shard] += len((r.text or "").encode()) + 16
        groups[r.text or ""].add(r.shard)
    assert len(found) == len(ROWS) and all(len(s) == 1 for s in groups.values())
    assert sorted(filled) == list(range(len(filled)))
    over = [s for s, v in filled.items() if v > capacity]
    assert all(sum(s in g for g in groups.values()) == 1 for s in over)
    assert sum(2 * v <= capacity for v in filled.values()) <= 1


def test_files(spark, folder):
    docs = frame(spark, ROWS).withColumn("shard", F.lit("clash"))
    sharding.write_shards(docs, f"{folder}/shards", 5)
    back = spark.read.parquet(f"{folder}/shards")
    assert set(back.columns) == set(docs.columns) and back.count() == len(ROWS)
    assert [r.shard for r in back.select("shard").distinct().orderBy("shard").collect()] == list(range(5))


def test_no_documents(spark):
    assert sharding.placed(empty(spark)).count() == 0
    assert sharding.shard(empty(spark), None, 100).count() == 0
