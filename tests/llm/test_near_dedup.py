"""Classes of near-duplicates against all pairs, similarity against its definition."""

import random

import numpy as np
import pytest
from cases import documents, empty, frame, prose
from pyspark.sql import functions as F

from pointlake.llm import components, near_dedup
from pointlake.llm.components import connected


def naive(a, b):
    a, b = (dict(zip(v.tolist(), w.tolist(), strict=True)) for v, w in (a, b))
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys())
    return total


def weighted(rng, n):
    return (
        np.array(sorted(rng.sample(range(40), n)), np.uint64),
        np.array([rng.choice([1, 1, 2, 5]) for _ in range(n)], float),
    )


def test_similarity_is_its_definition():
    rng = random.Random(3)
    for _ in range(60):
        a, b = weighted(rng, rng.randrange(1, 20)), weighted(rng, rng.randrange(1, 20))
        assert near_dedup.similarity(a, b) == pytest.approx(naive(a, b))
    assert near_dedup.similarity(a, a) == pytest.approx(1.0)


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = random.Random(4)
    a = weighted(rng, 18)
    b = (a[0][3:], a[1][3:] + np.array([0, 2] * 8)[: len(a[1]) - 3])
    found = near_dedup.signatures([a, b, a], registers=4000)
    assert (found[0] == found[2]).all()
    assert (found[0] == found[1]).mean() == pytest.approx(near_dedup.similarity(a, b), abs=0.04)


def test_sets_of_one_element_fill_all_registers():
    one = (np.array([7], np.uint64), np.ones(1))
    assert (near_dedup.signatures([one]) == 7).all()


def brute_classes(rows):
    sets = [near_dedup.Shingles()(t) for _, t, _ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if near_dedup.similarity(sets[i], sets[j]) >= near_dedup.THRESHOLD and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = {}
    for g, (i, _, _) in zip(group, rows, strict=True):
        ids.setdefault(g, []).append(i)
    smallest = lambda found: min((i for i in found if i is not None), default=None)
    return sorted((str(i), str(smallest(ids[g])), len(ids[g])) for g, (i, _, _) in zip(group, rows, strict=True))


def chain():
    """Each near its neighbours only, around a base that is near all: what pivots must join."""
    base = prose(20, 200).split()
    rows = [(100, " ".join(base), "s")]
    for k in range(12):
        words = list(base)
        for at in range(4):
            words[(k * 15 + at * 3) % 200] = f"edit{k}x{at}"
        rows.append((101 + k, " ".join(words), "s"))
    walk = list(prose(21, 200).split())
    for k in range(6):
        walk = [f"step{k}" if i == k * 30 + 5 else w for i, w in enumerate(walk)]
        rows.append((200 + k, " ".join(walk), "s"))
    return rows


@pytest.mark.parametrize("rows", [documents(), chain()], ids=["documents", "chain"])
def test_classes(spark, rows):
    found = near_dedup.classes(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in found) == brute_classes(rows)


def test_one_of_each_class_stays(spark):
    rows = documents()
    kept = near_dedup.representatives(frame(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted({c for _, c, _ in brute_classes(rows) if c != "None"} | {"None"})
    assert set(kept[0].asDict()) == set(frame(spark, rows).columns)


def test_empty(spark):
    assert near_dedup.classes(empty(spark)).count() == 0
    assert near_dedup.representatives(empty(spark)).count() == 0


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (200, 200)]
    found = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {**dict.fromkeys(range(41), 0), **dict.fromkeys((90, 95, 100), 90)}


KINDS = "home: binary, missing: int, extra: int, alone: int, repeats: int, size: int, over: int, under: int"


def test_profiles_rule_out_no_near_pair(spark):
    """Whatever two texts, by their counts against any third: J >= 0.8 is never ruled out."""
    rng, ruled_out, cases = random.Random(9), 0, []
    names = ("missing", "extra", "repeats", "size", "over", "under")
    for _ in range(1500):
        n = rng.randrange(8, 40)
        pivot = {k: rng.choice([1, 1, 1, 1, 20]) if rng.random() < 0.3 else 1 for k in range(n)}
        nodes = []
        for _ in range(2):
            node = dict(pivot)
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                how = rng.random()
                if how < 0.4 and node:
                    node.pop(rng.choice(list(node)))
                elif how < 0.8:
                    node[1000 + rng.randrange(12)] = rng.choice([1, 1, 3])
                else:
                    node[rng.choice(list(node) or [0])] = rng.choice([2, 19, 21])
            nodes.append(node)
        x, y = nodes
        if not x or not y:
            continue
        pair = [(np.array(sorted(v), np.uint64), np.array([v[k] for k in sorted(v)], float)) for v in (x, y)]
        base = (np.arange(n).astype(np.uint64), np.array([pivot[k] for k in range(n)], float))
        alone = [len(x.keys() - pivot.keys() - y.keys()), len(y.keys() - pivot.keys() - x.keys())]
        rows = [
            {"side": k, **dict(zip(names, near_dedup.differences(v, base)[:-1], strict=True)), "home": b"p", "alone": alone[k]}
            for k, v in enumerate(pair)
        ]
        j = near_dedup.similarity(*pair)
        cases.append((rows, j))
    df = spark.createDataFrame(
        [(b"p", *[tuple(r[k] for k in near_dedup.PROFILE) for r in rows], j) for rows, j in cases],
        f"pivot binary, x struct<{KINDS}>, y struct<{KINDS}>, j double",
    )
    for can, j in df.select(near_dedup.can_be_near("x", "y"), "j").collect():
        assert can or j < near_dedup.THRESHOLD
        ruled_out += not can
    assert ruled_out > 10


def crowd():
    """Two texts with many copies each, edited alone or in the same way, some far from their base."""
    rng, rows = random.Random(11), []
    for b in range(2):
        base = prose(50 + b, 160).split() if b == 0 else prose(50, 110).split() + prose(60, 50).split()
        rows.append((10_000 + b, " ".join(base), "s"))
        for k in range(40):
            words = list(base)
            for e in range(rng.randrange(0, 9)):
                words[rng.randrange(len(words))] = f"edit{b}x{k}x{e}" if rng.random() < 0.7 else f"same{rng.randrange(3)}"
            rows.append((100 * b + k, " ".join(words), "s"))
            if k % 8 == 0:
                words[5] = f"again{k}"
                rows.append((1000 + 100 * b + k, " ".join(words + words[:40] * (k % 16 == 0)), "s"))
    return rows


def test_a_crowd_of_copies(spark):
    rows = crowd()
    found = near_dedup.classes(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in found) == brute_classes(rows)


def test_few_texts_that_have_no_company_are_shuffled(spark):
    ids = spark.range(5000).select(F.unhex(F.md5(F.col("id").cast("string"))).alias("node"), F.col("id").cast("string").alias("text"))
    wanted = ids.where("CAST(text AS INT) % 7 = 0")
    found = {int(r.text) for r in near_dedup._likely(ids, wanted.select("node")).collect()}
    assert set(range(0, 5000, 7)) <= found and len(found) < 1000
    assert near_dedup._likely(ids, wanted.select("node").limit(0)).count() == 0


def test_stars_take_no_round(spark, monkeypatch):
    rounds, written = [], components.written
    monkeypatch.setattr(components, "written", lambda rows, name: rounds.append(name) or written(rows, name))
    stars = [(1, i) for i in range(2, 9)] + [(20, i) for i in range(21, 25)]
    found = components.connected(spark.createDataFrame(stars, "a long, b long")).collect()
    assert len(rounds) == 1 and {(r.node, r.label) for r in found} == {(b, a) for a, b in stars} | {(1, 1), (20, 20)}


def test_nodes_meet_where_enough_runs_are_left(spark):
    """Nodes that need 7 runs in common and have 3 make no pair, though rarer needs let their last runs in."""
    profile = (b"p", 0, 20, 0, 0, 100, 0, 0)
    own = {k: [f"rare{k}x{i}" for i in range(17)] + ["all1", "all2", "all3"] for k in range(30)}
    own[30], own[31] = ([f"seven{i}" if i > 3 else f"of{k}x{i}" for i in range(11)] + [f"late{k}x{i}" for i in range(9)] for k in (30, 31))
    numbers = {run: at for at, run in enumerate(dict.fromkeys(run for runs in own.values() for run in runs))}
    rows = [
        (b"p", numbers[run], bytes([k]), bytes([k]), profile, 20 - at) for k, runs in own.items() for at, run in enumerate(runs)
    ]
    runs = spark.createDataFrame(rows, f"pivot binary, run long, node binary, label binary, x struct<{KINDS}>, left long")
    assert runs.select(near_dedup.least_shared("x", "x").alias("need")).distinct().collect() == [(7,)]
    found = near_dedup._sharing_pairs(runs).select("node", "node_y").collect()
    assert {tuple(map(bytes, r)) for r in found} == {(bytes([30]), bytes([31]))}


def strangers():
    """Copies of a base with edits of many kinds, most of them too far from it and from each other."""
    rng, base = random.Random(13), prose(70, 120).split()
    rows = [(0, " ".join(base), "s")]
    for k in range(300):
        words = list(base)
        for e in range(rng.randrange(2, 7)):
            at, how = rng.randrange(len(words) - 1), rng.random()
            if how < 0.3:
                del words[at]
            elif how < 0.6:
                words[at : at + 2] = words[at : at + 2][::-1]
            else:
                words[at] = rng.choice(["the", "of", "and"]) if how < 0.8 else f"own{k}x{e}"
        rows.append((1 + k, " ".join(words), "s"))
    return rows


def lines():
    """Texts of one line over and over, with other lines that stand often in each alone."""
    line = prose(80, 3)
    return [(k, "\n".join([line] * (60 + k % 7) + [f"other{k} line{k}"] * (4 + k % 9)), "s") for k in range(60)]


@pytest.mark.parametrize("rows", [strangers(), lines()], ids=["strangers", "lines"])
def test_texts_that_are_alike_but_not_near_meet_seldom(spark, monkeypatch, rows):
    """No step holds a row for each pair of nodes or of their profiles."""
    sizes, written = {}, near_dedup.written
    monkeypatch.setattr(near_dedup, "written", lambda df, name: sizes.setdefault(name, []).append(df.count()) or written(df, name))
    confirmed = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda df, texts: sizes.setdefault("pairs", []).append(df.count()) or confirmed(df, texts))
    found = near_dedup.classes(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), str(r.class_id), r.class_size) for r in found) == brute_classes(rows)
    assert max(sizes.get("near-kinds", [0]) + sizes.get("pairs", [0])) <= 4 * len(rows), sizes


def test_weight_of_lone_runs_rules_out_no_near_pair(spark):
    """With what lone runs weigh beyond one each: J >= 0.8 is never ruled out."""
    rng, rows = random.Random(15), []
    for _ in range(600):
        base = {k: rng.choice([1, 1, 30]) for k in range(rng.randrange(6, 25))}
        nodes = []
        for side in range(2):
            node = {k: max(1, n + rng.choice([0, 0, -2, 5])) for k, n in base.items() if rng.random() < 0.95}
            node.update({1000 + 100 * side + i: rng.choice([1, 3, 9]) for i in range(rng.randrange(0, 4))})
            nodes.append(node)
        pivot = (np.array(sorted(base), np.uint64), np.array([base[k] for k in sorted(base)], float))
        pair = [(np.array(sorted(v), np.uint64), np.array([v[k] for k in sorted(v)], float)) for v in nodes]
        names = ("missing", "extra", "repeats", "size", "over", "under")
        profile = [dict(zip(names, near_dedup.differences(v, pivot)[:-1], strict=True)) | {"home": b"p"} for v in pair]
        lone = [[n for k, n in v.items() if k >= 1000] for v in nodes]
        for p, own in zip(profile, lone, strict=True):
            p["alone"] = len(own)
        rows.append((
            b"p", *[tuple(p[k] for k in near_dedup.PROFILE) for p in profile], *[sum(own) - len(own) for own in lone],
            near_dedup.similarity(*pair),
        ))
    df = spark.createDataFrame(rows, f"pivot binary, x struct<{KINDS}>, y struct<{KINDS}>, bx int, by int, j double")
    found = df.select(near_dedup.can_be_near("x", "y", ("bx", "by")).alias("can"), near_dedup.can_be_near("x", "y").alias("less"), "j").collect()
    assert all(r.can or r.j < near_dedup.THRESHOLD for r in found)
    assert sum(r.less and not r.can for r in found) > 5
