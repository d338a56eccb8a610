"""Removed bytes against counting every string of the length."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from cases import documents, empty, frame, prose

from pointlake.llm import suffix_dedup

LENGTH = suffix_dedup.LENGTH


def expected(texts, length=LENGTH):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


def shared_passages():
    """One passage in many contexts, overlapping repeats, runs just at and below the length."""
    passage = prose(30, 200)
    exact, short = passage[:LENGTH], passage[:LENGTH - 1]
    rows = [(i, prose(100 + i, 30) + passage[i * 7 : 500 + i * 11] + prose(200 + i, 30), "s") for i in range(12)]
    rows += [(50, "q" + exact + "z", "s"), (51, "é" + exact + "é", "s"), (52, "w" + short + "v", "s")]
    rows += [(60, ("abc" * 300) + prose(31, 20), "s"), (61, prose(32, 90) + prose(33, 90) + prose(32, 90), "s")]
    return rows


@pytest.mark.parametrize("variants", [suffix_dedup.MAX_VARIANTS, 3], ids=["blocks", "crowded"])
@pytest.mark.parametrize("rows", [documents(), shared_passages()], ids=["documents", "passages"])
def test_removals(spark, rows, variants, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MAX_VARIANTS", variants)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    found = suffix_dedup.removals(frame(spark, rows)).collect()
    want = [(str(i), *e) for (i, _, _), e in zip(rows, expected([t for _, t, _ in rows]), strict=True)]
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(want)


@pytest.mark.parametrize("length", [80, 240, 500])
def test_other_lengths(spark, length, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 4000)
    rows = shared_passages() + documents()
    found = suffix_dedup.removals(frame(spark, rows), length=length).collect()
    want = [(str(i), *e) for (i, _, _), e in zip(rows, expected([t for _, t, _ in rows], length), strict=True)]
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(want)


def test_the_expansion_finds_repeated_strings():
    rng = random.Random(2)
    for length in (7, 8, 11, 20):
        text = np.array([rng.choice([2, 3]) for _ in range(300)] + [1] + [rng.choice([2, 3, 4]) for _ in range(200)] + [0], np.uint16)
        seen = Counter(tuple(text[i : i + length]) for i in range(len(text) - length + 1))
        want = [seen[tuple(text[i : i + length])] > 1 for i in range(len(text) - length + 1)]
        assert suffix_dedup.repeated_rows(text, length)[: len(want)].tolist() == want


def test_every_window_is_in_one_segment():
    data = np.frombuffer(prose(3, 900).encode(), np.uint8)
    _, starts, sizes = suffix_dedup.segments_of(data)
    windows = [w for s, n in zip(starts, sizes, strict=True) for w in range(s, s + n - LENGTH + 1)]
    assert windows == list(range(len(data) - LENGTH + 1))


def test_texts_are_cut_at_letters(spark):
    rows = shared_passages()
    kept = {r.doc_id: r for r in suffix_dedup.without_repeats(frame(spark, rows)).collect()}
    assert kept[50].text == "qz" and kept[51].text == "éé" and kept[51].n_chars == 2
    assert kept[52].text == dict((i, t) for i, t, _ in rows)[52]
    assert set(kept[50].asDict()) == set(frame(spark, rows).columns) and len(kept) == len(rows)


def test_empty(spark):
    assert suffix_dedup.removals(empty(spark)).count() == 0
    assert suffix_dedup.without_repeats(empty(spark)).count() == 0


def test_segments_that_stand_once_are_not_shuffled_to_be_joined(spark, monkeypatch):
    counts, likely = [], suffix_dedup.likely

    def counted(rows, wanted, keys):
        out = likely(rows, wanted, keys)
        counts.append((rows.count(), out.join(wanted, keys, "left_anti").count(), rows.join(wanted, keys, "left_semi").count(), out.count()))
        return out

    monkeypatch.setattr(suffix_dedup, "likely", counted)
    rows = [(i, prose(400 + i, 250), "s") for i in range(60)] + [(100, prose(400, 250), "s"), (101, "a" + prose(401, 250), "s")]
    found = suffix_dedup.removals(frame(spark, rows)).collect()
    by_id = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found}
    assert [by_id[i] for i, _, _ in rows] == expected([t for _, t, _ in rows])
    assert len(counts) == 2
    for everything, extra, wanted, kept in counts:
        assert 0 < wanted == kept - extra and extra < (everything - wanted) / 10 and wanted < everything / 10
