"""Nodes of the trie against sets of prefixes, with pieces and blocks of any length."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from pointlake.llm import prefix_trie, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece string, depth string, id string"


def expected(rows):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append(((t is not None, t), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v, key=lambda x: (x[0][0], x[0][1] or 0, x[1]))] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[k] for k in children[p])
        leaves[p] = sum(leaves[k] for k in children[p]) if children[p] else 1
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children[p]), leaves[p], saved[p],
            hashlib.sha256(",".join(str(c) for c in sorted(m) if built[c] == p).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def found(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*prefix_trie.RESULTS).collect())


def frame(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(partitions)


def conversations(n=120, seed=3, longest=14):
    rng, rows = random.Random(seed), []
    for c in range(n):
        kind = rng.random()
        length = rng.randrange(1, longest) if kind < 0.8 else 1
        for t in range(length):
            hot = t < 2 and rng.random() < 0.7
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "hello" if hot else f"say {rng.randrange(3)} é"))
    copy = [r for r in rows if r[0] == 10]
    rows += [(500 + 5 * k, t, role, text) for k in range(25) for _, t, role, text in copy]
    rows += [(900, t, "user", f"x{t % 2}") for t in range(61)] + [(905, t, "user", f"x{t % 2}") for t in range(57)]
    rows += [
        (None, 0, "user", "lost"), (1000, None, None, None), (1000, 3, "user", None), (1000, 3, "user", "tie"),
        (1000, 3, "user", "tie"), (1003, 0, "user", ""), (-7, 0, "user", "below"), (-7, 1, "assistant", "zero"),
        (-10, 0, "user", "z" * 3000), (2**40 + 1, 0, "user", "big"),
    ]
    return rows


@pytest.mark.parametrize("piece_turns, block_bytes", [(128, 8 << 20), (128, 1), (3, 1), (1, 900), (4, 8 << 20)])
def test_against_sets(spark, piece_turns, block_bytes, monkeypatch):
    rows = conversations()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(prefix_trie, "ready_workers", lambda s: None)
    assert found(prefix_trie.trie(frame(spark, rows), piece_turns, block_bytes)) == expected(rows)


def test_sql(spark, folder):
    rows = conversations(60)
    frame(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    want = duck.execute(queries.QUERIES["op11_prefix_trie"].oracle)
    assert [d[0] for d in want.description] == list(prefix_trie.RESULTS)
    rows = sorted(tuple(-1 if v is None else v for v in r) for r in want.fetchall())
    assert rows == found(queries.op11_prefix_trie(spark, folder))


def test_one_conversation_and_none(spark):
    rows = [(4, 0, "user", "alone")]
    assert found(prefix_trie.trie(frame(spark, rows))) == expected(rows)
    assert prefix_trie.trie(frame(spark, rows).where("false")).count() == 0
    only_lost = [(None, 0, "user", "x")]
    assert prefix_trie.trie(frame(spark, only_lost)).count() == 0


def test_extents_equal_a_scan():
    rng = np.random.default_rng(1)
    values = rng.integers(-1, 5, 77)
    table = prefix_trie.minima(values)
    rows, depths = np.repeat(np.arange(77), 5), np.tile(np.arange(5), 77)
    right, left = prefix_trie.right_ends(table, rows, depths), prefix_trie.left_ends(table, rows, depths)
    for i, d, a, b in zip(rows, depths, left, right, strict=True):
        r = i
        while r + 1 < 77 and values[r + 1] >= d:
            r += 1
        low = i
        while low > 0 and values[low] >= d:
            low -= 1
        assert (a, b) == (low, r)
    assert (prefix_trie.range_minimum(table, left, right) == [values[a : b + 1].min() for a, b in zip(left, right, strict=True)]).all()
