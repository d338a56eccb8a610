"""Byte-pair encoding and decoding by batched numpy merge rounds.

The vocabulary file gives tokens, merges in order of rank, and special tokens. Texts are
normalised (composed, white space to one space, lower case), cut into words by the file's
pattern, and words are spelt in byte symbols. All new words of a batch then lie in one flat
symbol array: every round looks all neighbouring pairs up by binary search over the sorted
pair keys, takes each word's lowest rank and merges it. Words met before come from a bounded
cache. Decoding joins the tokens' strings as the vocabulary spells them.

Cases: null and empty texts encode to no ids and decode to the empty text; a text of any
length without white space is one flat array like any other; special tokens inside a text
become their ids; ids outside the vocabulary are left out when decoding; repeated rows encode alike;
an empty table gives an empty result; the results hold the id column and their own columns,
so other columns cannot clash.
"""

from __future__ import annotations

import functools
import gc
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import chunked, map_batches, unchunked

VOCABULARY = "word_bpe_49k.json"
END = "</w>"
NEVER = np.int64(1) << 40
# Words that a worker keeps; a full cache is emptied.
CACHE_ENTRIES = 120_000
# Words merged together: what the symbol arrays hold at a time.
MERGED_WORDS = 20_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """A vocabulary file as arrays, with what one worker has encoded so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        tokens: dict[str, int] = content["model"]["vocab"]
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        pattern = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # Letters and numbers as the installed Unicode tables have them.
        self.cut = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.cut_ascii = re.compile(pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9").replace(r"\s", r"\t-\r "))
        self.special = special
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        letters = byte_letters()
        self.inner = np.array([tokens[c] for c in letters], np.int64)
        self.final = np.array([tokens[c + END] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        left = np.array([tokens[a] for a, _ in merges], np.int64)
        right = np.array([tokens[b] for _, b in merges], np.int64)
        made = np.array([tokens[a + b] for a, b in merges], np.int64)
        keys = left << 32 | right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.made = made
        self.doubled = left == right
        # A merge whose token takes part in an earlier merge: then one at a time, from the left.
        first = np.full(max(tokens.values()) + 1, len(merges), np.int64)
        np.minimum.at(first, left, np.arange(len(merges)))
        np.minimum.at(first, right, np.arange(len(merges)))
        self.alone = first[made] < np.arange(len(merges))
        names = {**{i: t for t, i in tokens.items()}, **{i: t for t, i in special.items()}}
        self.names = pa.array([names.get(i) for i in range(max(names) + 1)])
        self.words: dict[str, tuple[int, ...]] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], NEVER)

    def merge(self, words: list[str]) -> list[tuple[int, ...]]:
        """The ids of every word, by merge rounds over all of them."""
        spelt = [w.encode() for w in words]
        sizes = np.array([len(s) for s in spelt])
        data = np.frombuffer(b"".join(spelt), np.uint8)
        symbols = self.inner[data]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.final[data[last]]
        word = np.repeat(np.arange(len(words)), sizes)
        rank = np.full(len(symbols), NEVER)
        inside = np.flatnonzero(word[:-1] == word[1:])
        rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            over = lowest == NEVER
            if over.any():
                gone = np.repeat(over, sizes)
                done.append((word[gone], symbols[gone]))
                symbols, word, rank = symbols[~gone], word[~gone], rank[~gone]
                lowest, sizes = lowest[~over], sizes[~over]
                if not len(symbols):
                    break
            each = np.repeat(lowest, sizes)
            hits = np.flatnonzero(rank == each)
            which = rank[hits]
            same_word = np.r_[False, word[hits[1:]] == word[hits[:-1]]]
            # Of overlapping pairs of one letter, every second is merged, from the left.
            joined = np.r_[False, np.diff(hits) == 1] & same_word & self.doubled[which]
            run = np.arange(len(hits))
            run -= np.maximum.accumulate(np.where(joined, 0, run))
            hits = hits[(run % 2 == 0) & ~(same_word & self.alone[which])]
            symbols[hits] = self.made[rank[hits]]
            stay = np.ones(len(symbols), bool)
            stay[hits + 1] = False
            moved = np.cumsum(stay) - 1
            symbols, word, rank = symbols[stay], word[stay], rank[stay]
            new = moved[hits]
            changed = np.unique(np.r_[new, new[new > 0] - 1])
            rank[changed] = NEVER
            changed = changed[changed < len(symbols) - 1]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed] = self.ranks(symbols[changed], symbols[changed + 1])
        of = np.concatenate([w for w, _ in done])
        ids = np.concatenate([s for _, s in done])
        order = np.argsort(of, kind="stable")
        counts = np.bincount(of, minlength=len(words)).tolist()
        flat, at, out = ids[order].tolist(), 0, []
        for n in counts:
            out.append(tuple(flat[at : at + n]))
            at += n
        return out

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # Letter by letter: a sigma at the end of a word is not special.
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def split(self, text: str) -> list[str]:
        """The words of a normalised text; most chunks are letters and a sign at the end."""
        if text.isalpha():
            return [text]
        if text.isascii():
            return self.cut_ascii.findall(text)
        if text[:-1].isalpha() and text[-1] in ".,;:!?":
            return [text[:-1], text[-1]]
        return self.cut.findall(text)

    def cut_chunk(self, chunk: str) -> list[str | int]:
        """Words and ids of special tokens of a chunk between white space."""
        if "<" not in chunk:
            return self.split(self.normal(chunk))
        out: list[str | int] = []
        for piece in self.special_cut.split(chunk):
            if piece in self.special:
                out.append(self.special[piece])
            else:
                out.extend(self.split(self.normal(piece)))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the offsets of each text's."""
        chunks, places, offsets = chunked(texts)
        gc.disable()  # nothing here is cyclic, and walking the cache takes longer than filling it
        try:
            cuts = [self.cut_chunk(c) for c in chunks]
            if len(self.words) > CACHE_ENTRIES:
                self.words = {}
            known = self.words
            fresh = list({w for cut in cuts for w in cut if w not in known and isinstance(w, str)})
            for at in range(0, len(fresh), MERGED_WORDS):
                part = fresh[at : at + MERGED_WORDS]
                known.update(zip(part, self.merge(part), strict=True))
            ids = [
                known[cut[0]] if len(cut) == 1 and isinstance(cut[0], str)
                else tuple(chain.from_iterable((w,) if isinstance(w, int) else known[w] for w in cut))
                for cut in cuts
            ]
            return unchunked(ids, places, offsets)
        finally:
            gc.enable()

    def decode(self, ids: pa.ListArray) -> pa.Array:
        flat = ids.flatten()
        known = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.names))), flat, None)
        strings = self.names.take(known)
        lists = pa.ListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))].astype(np.int32)), strings
        )
        if strings.null_count:
            lists = pa.array([[s for s in row if s is not None] for row in lists.to_pylist()], lists.type)
        return pc.binary_join(lists, " ")


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(
    docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``<id>, n_tokens, ids``: the token ids of every whole text."""
    path = path or public_tokenizers.path(VOCABULARY)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = vocabulary(path).encode(batch.column(1))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), lists], [id_column, "n_tokens", "ids"]
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, F.col(text_column).alias("__text")), work,
        f"`{id_column}` {kind}, n_tokens bigint, ids array<int>",
    )


def roundtrip(
    docs: DataFrame, path: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``<id>, n_tokens, ids, decoded``."""
    path = path or public_tokenizers.path(VOCABULARY)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        ids, offsets = words.encode(batch.column(1))
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), lists, words.decode(lists)],
            [id_column, "n_tokens", "ids", "decoded"],
        )

    kind = docs.schema[id_column].dataType.simpleString()
    return map_batches(
        docs.select(id_column, F.col(text_column).alias("__text")), work,
        f"`{id_column}` {kind}, n_tokens bigint, ids array<int>, decoded string",
    )


def decode(encoded: DataFrame, path: str | None = None, id_column: str = "doc_id") -> DataFrame:
    """``<id>, n_tokens, ids, decoded``: the text that the ids spell."""
    path = path or public_tokenizers.path(VOCABULARY)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        decoded = vocabulary(path).decode(batch.column(2))
        return pa.RecordBatch.from_arrays([*batch.columns, decoded], [id_column, "n_tokens", "ids", "decoded"])

    kind = encoded.schema[id_column].dataType.simpleString()
    return map_batches(
        encoded.select(id_column, "n_tokens", "ids"), work,
        f"`{id_column}` {kind}, n_tokens bigint, ids array<int>, decoded string",
    )
