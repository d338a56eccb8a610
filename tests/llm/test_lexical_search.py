"""Terms, trees and rankings against plain counting."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from cases import documents, empty, frame, prose

from pointlake.llm import lexical_search, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(CAPITALS) for t in TERM.findall(text or "")]


def expected(rows, items, k=10):
    docs = [(i, Counter(terms(t))) for i, t, *_ in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, words = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for i, wanted in asked.items():
        scored = []
        for d, c, n in docs:
            m = 100 - 90 + (90 * n * n_docs) // words
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in wanted if c[t]
            )
            if score > 0:
                scored.append((-score, d is not None, d if d is not None else 0))
        out += [(i, r + 1, d if known else None, -s) for r, (s, known, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id bigint, text string, doc_id string")


ROWS = [
    *documents(), *[(1000 + i, prose(i % 60 + 100, 60, "abe"), "a") for i in range(300)],
    *[(5000 - i, "the same words as the others", "b") for i in range(80)], (1 << 40, "Ça ne Va PAS, ça-va? x1\x00y2", "b"),
]
ITEMS = [
    (1, "one TWO three"), (2, prose(130, 60, "abe")), (3, "the same words"), (3, "as others"), (4, "!? ..."), (5, None), (6, ""),
    (None, "ça va"), (7, "nowhere-else unseen"), (8, prose(1, 40)), (9, "ab be ea x1"), (-2, "σίσυφος 日本 Σίσυφος y2"),
]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("points, docs, sets", [(1_500_000, 1 << 16, 8 << 20), (40, 1 << 16, 8 << 20), (1 << 20, 1, 200)])
def test_against_counting(spark, points, docs, sets, monkeypatch):
    monkeypatch.setattr(lexical_search.best_documents, "__defaults__", (points,))
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", docs)
    monkeypatch.setattr(lexical_search, "ITEM_BYTES", sets)
    assert rows_of(lexical_search.search(frame(spark, ROWS), benchmark(spark, ITEMS))) == expected(ROWS, ITEMS)


def test_sql(spark, folder):
    frame(spark, ROWS).write.parquet(f"{folder}/documents.parquet")
    benchmark(spark, ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    want = duck.execute(queries.QUERIES["op13_lexical_search"].oracle)
    assert [d[0] for d in want.description] == ["item_id", "rank", "doc_id", "score"]
    assert sorted(want.fetchall(), key=str) == rows_of(queries.op13_lexical_search(spark, folder)) == expected(ROWS, ITEMS)


def test_terms_of_bytes():
    texts = ["Ab-cd", None, "", "ef", "gh ", "日本x Y", "\x7fé"]
    array = pa.array(["cut off", *texts])[1:]
    places, hashes = lexical_search.terms_of(array)
    plain = [(i, t) for i, text in enumerate(texts) for t in terms(text)]
    assert places.tolist() == [i for i, _ in plain]
    again = lexical_search.terms_of(pa.array([t for _, t in plain]))[1]
    assert (hashes == again).all() and len(set(hashes.tolist())) == len({t for _, t in plain})


@pytest.mark.parametrize("seed", range(5))
def test_treap(seed):
    """Best first gives what sorting gives, and every node's maximum is that of its square."""
    rng = np.random.default_rng(seed)
    height, width = int(rng.integers(1, 40)), int(rng.integers(1, 90))
    cells = np.unique(rng.integers(0, height * width, 300))
    rows, columns, values = cells // width, cells % width, rng.integers(1, 50, len(cells)) * (1 << int(rng.integers(0, 30)))
    treap = lexical_search.K2Treap(rows, columns, values, width)
    band, high = rows >> lexical_search.BAND_BITS, treap.height_of(rows)
    has, node = treap.roots(rows)
    top = treap.peaks[node]
    assert has.all()
    for level in range(treap.depth):
        shift = treap.depth - 1 - level
        halves = treap.halves(node, high >> shift & 1)
        side = columns >> shift & 1
        assert np.where(side, halves[1][0], halves[0][0]).all()
        node = np.where(side, halves[1][1], halves[0][1])
        top = top - treap.lacks[node].astype(np.int64)
        square = [
            values[(band == b) & (high >> shift == r) & (columns >> shift == c)].max()
            for b, r, c in zip(band, high >> shift, columns >> shift, strict=True)
        ]
        assert (top == square).all()
    of = np.repeat(np.arange(6), 4)
    asked = np.concatenate([rng.choice(height, 4) for _ in range(6)])
    grid = np.zeros((height, width), np.int64)
    grid[rows, columns] = values
    ids = rng.integers(0, 60, width)
    best = lexical_search.Best.none(6, 5)
    lexical_search.descend(treap, ids, of, asked, best, 2)
    found = sorted(zip(best.item.tolist(), (-best.score).tolist(), best.doc.tolist(), strict=True))
    want = []
    for i in range(6):
        scores = grid[asked[of == i]].sum(axis=0)
        want += [(i, *x) for x in sorted((-int(s), int(d)) for s, d in zip(scores, ids, strict=True) if s > 0)[:5]]
    assert found == sorted(want)


def test_large_counts():
    lengths = np.array([10**12, 5])
    found = lexical_search.impacts(np.array([7, 7]), np.array([3, 1]), lengths, 10**10, 10**13)
    m = [10 + 90 * n * 10**10 // 10**13 for n in lengths.tolist()]
    assert found.tolist() == [7 * (3 * 10**9 // (3000 + 8 * m[0])), 7 * (10**9 // (1000 + 8 * m[1]))]


def test_nothing(spark):
    assert lexical_search.search(empty(spark), benchmark(spark, ITEMS)).count() == 0
    assert lexical_search.search(frame(spark, ROWS), benchmark(spark, []).where("false")).count() == 0
    blank = [(1, "", "a"), (2, None, "a")]
    found = lexical_search.search(frame(spark, blank), benchmark(spark, ITEMS))
    assert found.count() == 0 and found.columns == ["item_id", "rank", "doc_id", "score"]
