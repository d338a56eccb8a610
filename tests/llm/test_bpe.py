"""Token ids and token files against the library that wrote the vocabulary."""

import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, empty, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pointlake.llm import bpe, token_files

PATH = public_tokenizers.path(bpe.VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_padding()
LIBRARY.no_truncation()


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ODD = [
    "I'll 'S 'sss don't 12345", "<|endoftext|>x<|startoftext|> <|endoftext|", "ΟΔΟΣ Σ", "é ́x 각",
    "x　y\x1cz\x85q", "ab" * 3000, "haha" * 300 + "ha ha", "aaaaaaa aaaa", "ẞ ﬁ İ",
]


def ids_of(encoder, texts):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def assigned(text):
    return "".join(c for c in text if unicodedata.category(c) not in ("Cn", "Cs"))


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    assert ids_of(bpe.vocabulary(PATH), [text]) == ids_of(token_files.encoder(PATH), [text]) == [expected(text)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.text("abhtein.,'’ <|>\n", max_size=60)).map(assigned), min_size=1, max_size=8))
def test_any_texts(texts):
    want = [expected(t) for t in texts]
    assert ids_of(bpe.vocabulary(PATH), texts) == want
    assert ids_of(token_files.encoder(PATH), texts) == want


def test_caches_may_be_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "MERGED_WORDS", 2)
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 3)
    own, files = bpe.Vocabulary(PATH), token_files.Encoder(PATH)
    for text in ["one two three four", "five six one two", "three seven"]:
        assert ids_of(own, [text]) == ids_of(files, [text]) == [expected(text)]


def test_new_words_are_merged_in_one_call_and_few_are_kept(monkeypatch):
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 20)
    encoder, calls = token_files.Encoder(PATH), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: calls.append(words.to_pylist()) or learn(words))
    for _ in range(2):
        assert ids_of(encoder, ["Éà Word, word! x9", "other WORD İ."]) == [expected(t) for t in ("Éà Word, word! x9", "other WORD İ.")]
    assert [sorted(words) for words in calls] == [["other", "word", "éà"]]
    for k in range(30):
        text = " ".join(f"word {'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}{c}" for c in "abcdefghij")
        assert ids_of(encoder, [text]) == [expected(text)]
        assert len(encoder.words.words) == len(encoder.words.asked) == len(encoder.words.ends) - 1 <= 60
    assert sum("word" in words for words in calls) == 1


def test_encoding_and_decoding_of_a_table(spark):
    docs = frame(spark, documents())
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, bpe.roundtrip(docs).collect()))
    want = sorted((str(i), expected(t), LIBRARY.decode(expected(t), skip_special_tokens=False)) for i, t, _ in documents())
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_unknown_ids_are_left_out(spark):
    ids = spark.createDataFrame([(1, 3, [320, 999_999, -1]), (2, 0, [])], "doc_id long, n_tokens long, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(ids).collect()} == {1: LIBRARY.id_to_token(320), 2: ""}


def test_token_files(spark, folder, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 5)
    path = token_files.write_tokens(frame(spark, documents()), f"{folder}/tokens")
    rows = token_files.read_tokens(spark, path, with_ids=True).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _, _ in documents()), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    texts = sorted([*expected(t), token_files.END_ID] for _, t, _ in documents())
    assert sorted(r.ids for r in rows) == texts
    assert spark.read.parquet(f"{path}/manifest").count() > 1


def test_single_documents_of_a_file(spark, folder):
    path = token_files.write_tokens(frame(spark, documents()), f"{folder}/tokens")
    entry = spark.read.parquet(f"{path}/manifest").first()
    file = token_files.TokenFile(entry.file, token_files.read_bytes(f"{path}/dictionary"))
    place = file.index["id"].tolist().index(4)
    text = next(t for i, t, _ in documents() if i == 4)
    assert file.document(place).tolist() == [*expected(text), token_files.END_ID]
    with pytest.raises(ValueError):
        token_files.TokenFile(entry.file, b"another dictionary")


def test_empty_tables(spark, folder):
    assert bpe.decode(bpe.encode(empty(spark))).count() == 0
    path = token_files.write_tokens(empty(spark), f"{folder}/tokens")
    assert token_files.read_tokens(spark, path).count() == 0


def test_training_pieces_come_from_whole_documents_under_a_budget(spark, monkeypatch):
    rows = [(i, " ".join(["head"] * 3000 + [f"tail{i}"] * 500), "a") for i in range(4)]
    whole = token_files.training_pieces(frame(spark, rows), PATH, "doc_id", "text")
    encoder = token_files.encoder(PATH)
    found = token_files.documents_of(*encoder.encode(pa.array([t for _, t, _ in rows])))
    assert sorted(whole) == sorted(x[a : a + 8000] for x in found for a in range(0, len(x), 8000))
    monkeypatch.setattr(token_files, "TRAINING_BYTES", 30_000)
    some = token_files.training_pieces(frame(spark, rows), PATH, "doc_id", "text")
    assert 0 < sum(map(len, some)) <= 30_000 and set(some) < set(whole)


def test_documents_without_ids_of_their_own_are_spread(spark, folder, monkeypatch):
    """Half of the ids are missing and a third are one id: tasks and files stay alike."""
    monkeypatch.setattr(token_files, "FILE_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(None if i % 2 else 7 if i % 3 else i, f"some words {i % 50}", "a") for i in range(3000)]
        path = token_files.write_tokens(frame(spark, rows), f"{folder}/tokens")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = spark.read.parquet(f"{path}/manifest").collect()
    assert max(f.documents for f in files) <= 100
    parts = {p: sum(f.documents for f in files if f.part == p) for p in {f.part for f in files}}
    assert len(parts) == 4 and max(parts.values()) < 2 * 3000 / 4
    back = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in back] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i or 0))


def test_a_small_sample_is_the_dictionary(spark, folder):
    docs = frame(spark, documents())
    path = token_files.write_tokens(docs, f"{folder}/tokens")
    dictionary = token_files.read_bytes(f"{path}/dictionary")
    assert dictionary == b"".join(token_files.training_pieces(docs, PATH, "doc_id", "text"))[-token_files.DICTIONARY_BYTES :]
    packed = token_files.codec(dictionary)[0]
    one = dictionary[:400]
    assert len(packed.compress(one)) < len(token_files.codec(b"")[0].compress(one)) / 2
