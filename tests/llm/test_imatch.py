"""Fingerprints: equal texts, edits, order of documents."""

import hashlib

import numpy as np
import pytest
from cases import documents, empty, frame, prose

from pointlake.llm import common, imatch


def expected(rows):
    rows = sorted(((i, t or "") for i, t, _ in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        quarter = len(text) // 4
        changed = text[: len(text) - quarter] + following[:quarter]
        out.append((str(i), len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("size", [2, 5, 4000])
def test_edits_and_neighbours(spark, size, monkeypatch):
    monkeypatch.setattr(common, "RANGE_ROWS", size)
    rows = [*documents(), *[(500 + i, prose(i, 60), "a") for i in range(40)]]
    found = imatch.with_edits(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.n_chars, r.edited_sha256) for r in found) == expected(rows)
    prints = {r.doc_id: r for r in found}
    assert prints[1].fingerprint == prints[2].fingerprint
    plain = {r.doc_id: r.fingerprint for r in imatch.fingerprints(frame(spark, rows)).collect()}
    assert all(plain[i] == prints[i].fingerprint for i in prints)
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_edited == imatch.likeness(r.fingerprint, r.edited_fingerprint)
    long = [r for r in found if r.n_chars > 200 and r.doc_id != 11]
    assert np.mean([r.near_edited for r in long]) > 0.15 > 0.05 > np.mean([r.near_next for r in long if r.doc_id not in (1, 2, 8)])


def test_document_frequencies_choose_the_lexicon(spark):
    rows = [(i, f"common {'half' if i % 2 else 'other'} rare{i} band{i % 40}", "a") for i in range(2000)]
    flags = imatch.lexicon(frame(spark, rows), band=(0.01, 0.3))
    inside = lambda word: bool(flags[imatch.Terms()(word) >> imatch.SHIFT][0])
    assert all(inside(f"band{k}") for k in range(40)) and not inside("common") and not inside("half")
    assert sum(inside(f"rare{i}") for i in range(2000)) < 20


def test_the_lexicon_has_the_terms_of_the_band_alone(spark, monkeypatch):
    monkeypatch.setattr(imatch, "HELD_TERMS", 500)
    # So many words of one document each that every bucket has as many of them as the floor asks for.
    rare = 4000
    rows = [(i, " ".join([f"band{i % 40}", "Common", *(f"r{i}x{k}" for k in range(rare))]), "a") for i in range(400)]
    docs = frame(spark, [*rows, (1000, None, "a"), (1001, "", "a")])
    found = imatch.lexicon(docs, band=(0.01, 0.3))
    assert set(found.terms.tolist()) == set(imatch.Terms()(" ".join(f"band{k}" for k in range(40))).tolist())
    assert found.of(imatch.Terms()(rows[0][1])).tolist() == imatch.Terms()("band0").tolist()


def test_likeness():
    flags = np.ones(1 << imatch.BUCKET_BITS, bool)
    make = lambda text: imatch.fingerprint(imatch.Terms()(text), flags)
    text = prose(1, 400)
    near, far = text.replace(text[:200], prose(9, 40)), prose(2, 400)
    assert imatch.likeness(make(text), make(text)) == 1
    assert imatch.likeness(make(text), make(near)) > 0.5 > 0.1 > imatch.likeness(make(text), make(far))
    assert make("") == "" and imatch.likeness("", make(text)) == 0 and imatch.likeness("", "") == 1
    assert make("a B") == make(" b\ta a")


def test_a_level_has_a_hash_for_each_of_24_lexicons():
    flags = np.ones(1 << imatch.BUCKET_BITS, bool)
    levels = imatch.fingerprint(imatch.Terms()(prose(1, 400)), flags).split(";")
    assert [len(level.split("=")[1].split(",")) for level in levels] == [24, 24]


def test_lone_and_empty(spark):
    lone = imatch.with_edits(frame(spark, [(3, "abcdefgh", "a")])).collect()
    assert len(lone) == 1 and lone[0].near_next == 1 and lone[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert imatch.with_edits(empty(spark)).count() == 0
    assert imatch.fingerprints(empty(spark)).count() == 0
