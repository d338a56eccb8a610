"""Document fingerprints by I-Match: hashes of sorted terms from randomised lexicons.

Terms are lower-case words. Their document frequencies over the whole corpus are counted by
64-bit hash; the lexicon holds the terms whose share of documents lies within a band, so
neither function words nor words of few documents count. Every term of the lexicon stands in
BAND[0] of the documents at least, so it has at most (mean distinct terms of a document) /
BAND[0] terms, whatever the corpus.
A document's terms of the lexicon are made distinct and sorted; each of LEXICONS random
subsets of the lexicon selects some of them, and what it selects is hashed. A subset keeps
one term in 2^level, for two neighbouring levels by which about one to four terms are
selected, so that long and short documents are alike in how much an edit changes.

The likeness of two fingerprints is the share of equal hashes among the subsets that select
terms of either, at the levels both have.

Cases: null texts are empty; a text without terms of the lexicon is fingerprinted by all its
terms, and one without terms has an empty fingerprint that is like no other but itself;
equal texts have equal fingerprints; the next document is the next in order of id, null ids
first, repeated ids in order of text; a lone document is next to itself; an empty table
gives an empty result; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pointlake.llm.common import id_array, id_ranges, mixed, parts_of, range_of, ready_workers

# Buckets of term hashes in which a term is looked up first; most terms end there.
BUCKET_BITS = 18
# Share of documents that a term of the lexicon stands in.
BAND = (5e-4, 0.1)
LEXICONS = 24
# Odd factors: one random order of all terms for each lexicon.
FACTORS = mixed(np.arange(1, LEXICONS + 1)) | np.uint64(1)
CACHE_ENTRIES = 150_000
SHIFT = np.uint64(64 - BUCKET_BITS)
# Term hashes that a task holds before it adds them up and passes them on.
HELD_TERMS = 1 << 20


class Terms:
    """Term hashes of texts; hashes of words met before are kept."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct term hashes."""
        words = set(parts_of(text.lower())) if text else set()
        words.discard("")
        if len(self.known) > CACHE_ENTRIES:
            self.known = {}
        known = self.known
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word.encode())
        out = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        out.sort()
        return out


class Lexicon:
    """Sorted term hashes. Indexed by buckets it tells which of them hold terms at all."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms)
        self.flags = np.zeros(1 << BUCKET_BITS, bool)
        self.flags[(self.terms >> SHIFT).astype(np.int64)] = True

    def __getitem__(self, buckets: np.ndarray) -> np.ndarray:
        return self.flags[buckets.astype(np.int64)]

    def of(self, terms: np.ndarray) -> np.ndarray:
        """Those of the terms that are in the lexicon."""
        found = terms[self[terms >> SHIFT]]
        at = np.searchsorted(self.terms, found)
        return found[self.terms[at.clip(max=len(self.terms) - 1)] == found] if len(found) else found


def lexicon(docs: DataFrame, text_column: str = "text", band: tuple[float, float] = BAND) -> Lexicon:
    """The terms within the band; only they come to the driver."""
    ready_workers(docs.sparkSession)

    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["term", "documents"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, held, n = Terms(), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(terms(text))
                n += len(held[-1])
                if n >= HELD_TERMS:
                    yield summed(held)
                    held, n = [], 0
        if held:
            yield summed(held)

    total = docs.count()
    inside = (
        docs.select(text_column).mapInArrow(run, "term bigint, documents bigint")
        .groupBy("term").agg(F.sum("documents").alias("documents"))
        .where((F.col("documents") >= band[0] * total) & (F.col("documents") <= band[1] * total))
        .select("term").toPandas()
    )
    return Lexicon(inside["term"].to_numpy(np.int64).view(np.uint64))


def fingerprint(terms: np.ndarray, lexicon: Lexicon | np.ndarray) -> str:
    """``level=hash,hash,...;level=...``: a hash for each lexicon, empty where it selects none.

    An array has a flag for each bucket, and selects all terms of a bucket.
    """
    kept = lexicon.of(terms) if isinstance(lexicon, Lexicon) else terms[lexicon[(terms >> SHIFT).astype(np.int64)]]
    kept = kept if len(kept) else terms
    if not len(kept):
        return ""
    order = kept[None, :] * FACTORS[:, None]
    low = max(0, len(kept).bit_length() - 2)
    out = []
    for level in (low, low + 1):
        chosen = order < np.uint64(1 << (64 - level)) if level else np.ones(order.shape, bool)
        hashes = [
            f"{xxhash.xxh32_intdigest(kept[row].tobytes()):08x}" if some else ""
            for row, some in zip(chosen, chosen.any(1).tolist(), strict=True)
        ]
        out.append(f"{level}=" + ",".join(hashes))
    return ";".join(out)


def likeness(a: str, b: str) -> float:
    """Between 0 and 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    levels = [dict(x.split("=") for x in f.split(";") if x) for f in (a, b)]
    same = either = 0
    for level in levels[0].keys() & levels[1].keys():
        for x, y in zip(levels[0][level].split(","), levels[1][level].split(","), strict=True):
            either += bool(x or y)
            same += bool(x) and x == y
    return same / either if either else 0.0


def fingerprints(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """``<id>, fingerprint`` of every document."""
    ready_workers(docs.sparkSession)
    flags = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text_column))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms()
        for batch in batches:
            prints = [fingerprint(terms(t), flags.value) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], [id_column, "fingerprint"])

    return docs.select(id_column, F.col(text_column).alias("__text")).mapInArrow(
        run, f"`{id_column}` {kind}, fingerprint string"
    )


def beside_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``part, guest, id, text``, sorted: every document before its next.

    Consecutive ranges of ids are parts. The first document of each part also comes, as a
    guest, behind the part before it, and the first of all behind the last.
    """
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    ends = source.agg(F.min("id").alias("low"), F.count("*").alias("n"), F.count("id").alias("known")).first()
    cuts = [c for c in id_ranges(docs, id_column) if ends.n > ends.known or c > ends.low]
    shared = docs.sparkSession.sparkContext.broadcast(cuts)  # one number for each few thousand documents
    first_is_null, low = ends.n > ends.known, ends.low

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, missing = id_array(batch.column(0))
            part = range_of(ids, missing, shared.value)
            heads = np.flatnonzero(~missing & np.isin(ids, shared.value))
            first = np.flatnonzero(missing if first_is_null else ids == low)
            rows = np.r_[np.arange(len(ids)), heads, first]
            parts = np.r_[part, part[heads] - 1, np.full(len(first), len(shared.value))]
            guest = np.arange(len(rows)) >= len(ids)
            picked = pa.Table.from_batches([batch]).take(rows).combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts.astype(np.int64)), pa.array(guest), *(c.combine_chunks() for c in picked.columns)],
                ["part", "guest", "id", "text"],
            )

    dealt = source.mapInArrow(run, "part bigint, guest boolean, id bigint, text string")
    return dealt.repartition("part").sortWithinPartitions("part", "guest", "id", "text")


def edited(text: str, following: str) -> str:
    """The last quarter replaced by the start of the next document."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def with_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    ready_workers(docs.sparkSession)
    flags = docs.sparkSession.sparkContext.broadcast(lexicon(docs, text_column))
    names = [id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, flag = Terms(), flags.value
        held: tuple | None = None  # part, id, text, fingerprint of the last document
        for batch in batches:
            out: list[tuple] = []
            for part, guest, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None and guest:
                    continue  # a further row with the id that starts the next part
                own = fingerprint(terms(text), flag)
                if held is not None:
                    _, last, last_text, last_print = held
                    changed = edited(last_text, text)
                    changed_print = fingerprint(terms(changed), flag)
                    out.append((
                        last, len(last_text), hashlib.sha256(changed.encode()).hexdigest(), last_print,
                        changed_print, likeness(last_print, changed_print), likeness(last_print, own),
                    ))
                held = None if guest else (part, key, text, own)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)], names
            )

    return beside_next(docs, id_column, text_column).mapInArrow(
        run,
        f"`{id_column}` bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
