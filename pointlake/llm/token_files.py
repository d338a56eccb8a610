"""Token ids in binary files: one dictionary for all, every document compressed on its own.

Documents are sorted over all tasks by id. A task writes its share as files of bounded size, in
ascending id order:

    magic (8 bytes) | hash of the dictionary (8 bytes) | documents (8 bytes)
    index: per document id, whether it is null, tokens, end of its frame (8 bytes each)
    frames: per document its ids as little-endian 32-bit numbers, zstandard with the dictionary

so a document is read by its index entry and one frame. The dictionary is trained on
pieces from all places of DICTIONARY_SAMPLE documents with the smallest digests of their ids,
TRAINING_BYTES in all, and lies beside the files. A manifest table lists files with their documents and tokens; a file's name is
its writer's own, and only files in the manifest count, so a repeated task does no harm.

Cases: null and empty texts hold the end id alone; null ids come first; documents of one id are
all written, in order of the hash of their texts, and spread over tasks like others; an empty table gives no files and no rows; only the id
and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import gc
import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import Split

from pointlake.llm.bpe import byte_letters
from pointlake.llm.common import chunk_codes, map_batches, ready_workers, written
from pointlake.session import fresh_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MAGIC = b"tokfile1"
ENTRY = np.dtype([("id", "<i8"), ("null", "<i8"), ("tokens", "<i8"), ("end", "<i8")])
DICTIONARY_SAMPLE = 2_000
DICTIONARY_BYTES = 64 << 10
# Ids of one piece, and the bytes of all pieces that the trainer sees.
SAMPLE_IDS = 2_000
TRAINING_BYTES = 4 * SAMPLE_IDS * DICTIONARY_SAMPLE
LEVEL = 3
FEW_SAMPLES = 50
# A file ends with so many documents, or so many bytes of frames.
FILE_ROWS = 4_000
FILE_BYTES = 16 << 20
# Words, and chunks, in each generation of what a worker keeps; longer chunks are not kept.
CACHE_ENTRIES = 150_000
LONGEST_KEPT = 64
SIGNS = ".,;:!?"
# Letters below U+0250 are composed, and the lower case of these is one letter for Python and Arrow alike.
PLAIN = "".join(c for c in map(chr, range(0x250)) if c.lower().isalpha() and pc.utf8_lower(c).as_py() == c.lower())
PLAIN_CHUNK = f"^[{PLAIN}]+[{SIGNS}]?$"


class Kept:
    """A bounded cache in two generations: what the older one gives moves to the younger, and a
    full younger one takes the older one's place, so what is asked for often stays."""

    def __init__(self, entries: int):
        self.entries, self.young, self.old = entries, {}, {}

    def turn(self) -> None:
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young

    def all_of(self, keys: list[str]) -> list[bytes | None]:
        found = list(map(self.young.get, keys))
        old = self.old.get
        for i, value in enumerate(found):
            if value is None and (value := old(keys[i])) is not None:
                found[i] = self.young[keys[i]] = value
        return found


class Words:
    """Words and their ids as arrays. A batch adds what it had to look up; of more than twice CACHE_ENTRIES words,
    those stay that were asked for since the last time, the oldest CACHE_ENTRIES at most."""

    def __init__(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.ids, self.ends = np.zeros(0, "<u4"), np.zeros(1, np.int64)
        self.asked = np.zeros(0, bool)

    def places(self, words: pa.LargeStringArray, learn: Callable[[pa.LargeStringArray], tuple]) -> np.ndarray:
        """The place of each of these distinct words; ``learn`` gives the ids and ends of those that are new."""
        if len(self.words) > 2 * CACHE_ENTRIES:
            kept = np.flatnonzero(self.asked)[:CACHE_ENTRIES]
            self.words = self.words.take(pa.array(kept))
            self.ids, self.ends = gathered(self.ids, self.ends[kept], np.diff(self.ends)[kept])
            self.asked = np.zeros(len(kept), bool)
        at = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(at))
        places = np.asarray(at.fill_null(-1)).astype(np.int64)
        missing = places < 0
        places[missing] = np.arange(len(new)) + len(self.words)
        if len(new):
            ids, ends = learn(new)
            self.words = pa.concat_arrays([self.words, new])
            self.ends = np.r_[self.ends, ends[1:] + len(self.ids)]
            self.ids = np.r_[self.ids, ids]
            self.asked = np.r_[self.asked, np.zeros(len(new), bool)]
        self.asked[places] = True
        return places


class Encoder:
    """The library's tokenizer. White space parts texts for it, so distinct chunks are encoded once.

    Chunks of plain letters, with or without a sign at the end, are one or two words whatever
    else stands around: the words that are not known yet go to the library's merges in one call
    and are kept. All other chunks go through its whole encoding.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        # How the library spells the bytes of a word.
        self.spelling = dict(enumerate(byte_letters()))
        # The merges alone, of words with line breaks between them; a line break is one id, and of no word.
        line_break = self.spelling[ord("\n")]
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Split(line_break, "isolated")
        (self.between,) = (t.id for t in self.tokenizer.model.tokenize(line_break))
        signs = [[t.id for t in self.tokenizer.model.tokenize(c)] for c in SIGNS]
        self.sign_ids = np.array([i for ids in signs for i in ids], "<u4")
        self.sign_ends = np.cumsum([0, *map(len, signs)])
        # The number of the sign that a byte is; the last is that of all others.
        self.sign_of = np.full(256, len(SIGNS), np.int64)
        self.sign_of[[ord(c) for c in SIGNS]] = np.arange(len(SIGNS))
        self.words, self.chunks = Words(), Kept(CACHE_ENTRIES)

    def learn(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of plain letters in one array, and where each word's end, after a 0."""
        spelt = "\n".join(words.to_numpy(zero_copy_only=False)).encode().decode("latin-1").translate(self.spelling)
        ids = np.array(self.merges.encode_batch_fast([spelt], add_special_tokens=False)[0].ids, "<u4")
        breaks = ids == self.between
        before = np.r_[np.flatnonzero(breaks), len(ids)]
        return ids[~breaks], np.r_[0, before - np.arange(len(before))]

    def plain(self, chunks: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and first place and number of ids of the word and of the sign of each chunk of plain letters."""
        low = pc.utf8_lower(chunks)
        ends = np.frombuffer(low.buffers()[1], np.int64)[low.offset : low.offset + len(low) + 1]
        data = np.frombuffer(low.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        sign = self.sign_of[data[ends[1:] - 1]]
        signed = sign < len(SIGNS)
        letters = np.ones(len(data), bool)
        letters[ends[1:][signed] - 1] = False
        ends[1:] -= np.cumsum(signed)
        bodies = pa.LargeStringArray.from_buffers(len(low), pa.py_buffer(ends), pa.py_buffer(data[letters])).dictionary_encode()
        at = self.words.places(bodies.dictionary, self.learn)[np.asarray(bodies.indices)]
        signs = np.r_[self.sign_ends, self.sign_ends[-1]]
        first = np.stack([self.words.ends[at], len(self.words.ids) + signs[sign]], 1)
        sizes = np.stack([np.diff(self.words.ends)[at], np.diff(signs)[sign]], 1)
        return np.r_[self.words.ids, self.sign_ids], first, sizes

    def other(self, chunks: list[str]) -> list[bytes]:
        """The ids of any chunks as little-endian 32-bit numbers."""
        self.chunks.turn()
        ids = self.chunks.all_of(chunks)
        new = [i for i, found in enumerate(ids) if found is None]
        for i, found in zip(
            new, self.tokenizer.encode_batch_fast([chunks[i] for i in new], add_special_tokens=False), strict=True
        ):
            ids[i] = struct.pack(f"<{len(found.ids)}I", *found.ids)
            if len(chunks[i]) <= LONGEST_KEPT:
                self.chunks.young[chunks[i]] = ids[i]
        return ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the offsets of each text's."""
        chunks, places, offsets = chunk_codes(texts)
        gc.disable()  # nothing here is cyclic, and walking the caches takes long
        try:
            is_plain = pc.match_substring_regex(chunks, PLAIN_CHUNK)
            plain = np.asarray(is_plain)
            first, sizes = np.zeros((len(chunks), 2), np.int64), np.zeros((len(chunks), 2), np.int64)
            flat = np.zeros(0, "<u4")
            if plain.any():
                flat, first[plain], sizes[plain] = self.plain(chunks.filter(is_plain))
            found = self.other(chunks.filter(pc.invert(is_plain)).to_numpy(zero_copy_only=False).tolist())
            counts = np.fromiter(map(len, found), np.int64, len(found)) // 4
            first[~plain, 0], sizes[~plain, 0] = len(flat) + np.cumsum(counts) - counts, counts
            per_chunk, ends = gathered(np.r_[flat, np.frombuffer(b"".join(found), "<u4")], first.ravel(), sizes.ravel())
            ids, ends = gathered(per_chunk, ends[:-1:2][places], sizes.sum(1)[places])
            return ids, ends[offsets]
        finally:
            gc.enable()


def gathered(flat: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of these places and sizes behind each other, and where each ends, after a 0."""
    ends = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    return flat[np.arange(ends[-1]) + np.repeat(first - ends[:-1], sizes)], ends


def documents_of(ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The serialised ids of each text with the end id behind them."""
    end = np.array([END_ID], "<u4").tobytes()
    data = ids.astype("<u4").tobytes()
    return [data[4 * a : 4 * b] + end for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def train_dictionary(docs: DataFrame, path: str, id_column: str, text_column: str) -> bytes:
    """A dictionary from pieces of a bounded sample of documents; the pieces themselves where they are few."""
    samples = training_pieces(docs, path, id_column, text_column)
    if len(samples) < FEW_SAMPLES or sum(map(len, samples)) < FEW_SAMPLES * DICTIONARY_BYTES // 10:
        # Too little to train on: the sample itself is what documents are compressed against.
        return b"".join(samples)[-DICTIONARY_BYTES:]
    return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()


def training_pieces(docs: DataFrame, path: str, id_column: str, text_column: str) -> list[bytes]:
    """Pieces of whole sample documents, by their digests as far as TRAINING_BYTES go."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    ids = rows.select("id").where("id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.md5(F.col("id").cast("string")), "id").limit(DICTIONARY_SAMPLE)
    # Ids alone are sorted; the texts of DICTIONARY_SAMPLE of them are read.
    sample = rows.join(F.broadcast(chosen), "id", "left_semi")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = documents_of(*encoder(path).encode(batch.column(1)))
        step = 4 * SAMPLE_IDS
        pieces = [x[at : at + step] for x in found for at in range(0, len(x), step)]
        keys = [xxhash.xxh3_64_intdigest(x) >> 1 for x in pieces]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([len(x) for x in pieces], pa.int64()), pa.array(pieces, pa.binary())],
            ["key", "size", "ids"],
        )

    pieces = written(map_batches(sample, work, "key bigint, size bigint, ids binary"), "training-pieces")
    total = pieces.agg(F.sum("size")).first()[0] or 0
    # Digests are even: below this one lie about nine tenths of the budget.
    below = int((1 << 63) * min(1.0, 0.9 * TRAINING_BYTES / total)) if total > TRAINING_BYTES else 1 << 63
    out, left = [], TRAINING_BYTES
    for row in pieces.where(F.col("key") <= below - 1).orderBy("key", "ids").toLocalIterator():
        left -= row["size"]
        if left < 0:
            break
        out.append(bytes(row["ids"]))
    return out


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri)


def write_bytes(uri: str, data: bytes) -> None:
    store, path = _opened(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(path) as out:
        out.write(data)


def read_bytes(uri: str) -> bytes:
    store, path = _opened(uri)
    with store.open_input_file(path) as file:
        return file.read()


@functools.lru_cache(2)
def codec(dictionary: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return (
        zstandard.ZstdCompressor(level=LEVEL, dict_data=shared),
        zstandard.ZstdDecompressor(dict_data=shared),
    )


def write_tokens(
    docs: DataFrame,
    folder: str | None = None,
    path: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> str:
    """Writes the token files of all documents and returns their folder.

    ``folder`` must be reachable for driver and executors, and new.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path(VOCABULARY)
    folder = folder or fresh_path(spark, "tokens")
    dictionary = train_dictionary(docs, path, id_column, text_column)
    write_bytes(f"{folder}/dictionary", dictionary)
    digest = xxhash.xxh3_64_digest(dictionary)
    ready_workers(spark)
    rows = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"),
        F.xxhash64(text_column).alias("digest"), F.monotonically_increasing_id().alias("read"),
    )
    # Equal and missing ids are told apart by their texts and by where they were read, so a
    # task's share of the documents does not depend on the ids.
    order = [F.col("id").asc_nulls_first(), F.col("digest").asc(), F.col("read").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, pack = TaskContext.get().partitionId(), 0, codec(dictionary)[0]
        ids: list[int | None] = []
        tokens: list[int] = []
        frames: list[bytes] = []
        size = 0

        def file() -> pa.RecordBatch:
            entries = np.zeros(len(ids), ENTRY)
            entries["null"] = [i is None for i in ids]
            entries["id"] = [i or 0 for i in ids]
            entries["tokens"] = tokens
            entries["end"] = np.cumsum([len(f) for f in frames])
            name = f"{folder}/{part:08d}-{number:06d}-{uuid.uuid4().hex}.tok"
            head = MAGIC + digest + struct.pack("<q", len(ids))
            write_bytes(name, head + entries.tobytes() + b"".join(frames))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([number], pa.int64()), pa.array([name]),
                 pa.array([len(ids)], pa.int64()), pa.array([sum(tokens)], pa.int64())],
                ["part", "number", "file", "documents", "tokens"],
            )

        for batch in batches:
            found = documents_of(*encoder(path).encode(batch.column(1)))
            for i, text in zip(batch.column(0).to_pylist(), found, strict=True):
                ids.append(i)
                tokens.append(len(text) // 4)
                frames.append(pack.compress(text))
                size += len(frames[-1])
                if len(ids) >= FILE_ROWS or size >= FILE_BYTES:
                    yield file()
                    number, size = number + 1, 0
                    ids, tokens, frames = [], [], []
        if ids:
            yield file()

    ranged.mapInArrow(write, "part bigint, number bigint, file string, documents bigint, tokens bigint").write.parquet(
        f"{folder}/manifest"
    )
    return folder


class TokenFile:
    """One file: its index, and documents by position."""

    def __init__(self, uri: str, dictionary: bytes):
        self.data = read_bytes(uri)
        if self.data[:8] != MAGIC or self.data[8:16] != xxhash.xxh3_64_digest(dictionary):
            raise ValueError(f"{uri} was not written with this dictionary")
        (count,) = struct.unpack_from("<q", self.data, 16)
        self.index = np.frombuffer(self.data, ENTRY, count, 24)
        self.base = 24 + count * ENTRY.itemsize
        self.unpack = codec(dictionary)[1]

    def document(self, position: int) -> np.ndarray:
        start = self.base + (int(self.index["end"][position - 1]) if position else 0)
        frame = self.data[start : self.base + int(self.index["end"][position])]
        return np.frombuffer(self.unpack.decompress(frame), "<u4")


def read_tokens(spark: SparkSession, folder: str, id_column: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """``<id>, start, n_tokens, ids_crc32`` of every written document, with ``ids`` if asked.

    ``start`` counts the ids of all documents before it. The running sum goes over the
    manifest, which has a row for each file.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = written(
        manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start")), "token-starts"
    )
    dictionary = read_bytes(f"{folder}/dictionary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                file = TokenFile(name, dictionary)
                index = file.index
                starts = start + np.cumsum(index["tokens"]) - index["tokens"]
                tokens = [file.document(i) for i in range(len(index))]
                columns = [
                    pa.array(index["id"].astype(np.int64), mask=index["null"].astype(bool)),
                    pa.array(starts.astype(np.int64)), pa.array([len(t) for t in tokens], pa.int64()),
                    pa.array([zlib.crc32(t) for t in tokens], pa.int64()),
                ]
                names = [id_column, "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([t.astype(np.int64) for t in tokens], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"`{id_column}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    spread = files.select("file", "start").repartition(max(1, min(len(manifest.inputFiles()) * 4, 4096)), "file")
    return spread.mapInArrow(work, schema + (", ids array<bigint>" if with_ids else ""))
