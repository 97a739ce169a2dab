"""Token-id files: documents compressed one by one with a shared Zstandard dictionary, and an offset index for short access.

A file: ``CTOK0001``; the dictionary's hash (xxh64, 8 bytes), the width of an id in bytes, documents, ids, and where the
index begins (little-endian unsigned 64-bit each); then each document's ids (little-endian unsigned, 2 or 4 bytes each),
compressed apart; then the index, as Zstandard-compressed arrays end to end: doc ids (int64), null flags (uint8), ids before
the document in this file (uint64), offsets of the compressed documents and their end (uint64).
"""

from __future__ import annotations

import contextlib
import json
import struct
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cinderspark.llm.common import docs_of, partitions, rows
from cinderspark.llm.pretokens import split
from cinderspark.sources.tables import new_path, qualified, written

MAGIC = b"CTOK0001"
HEAD = "<8sQQQQQ"
HEAD_SIZE = struct.calcsize(HEAD)
SHARD_BYTES = 16 << 20


def byte_letters(spec: str) -> dict[int, str] | None:
    """The letter of each byte in a plain byte-level BPE file; None if the file changes text first or is of another kind."""
    told = json.loads(spec)
    model, cut = told["model"], told["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True) and not told["normalizer"] and not model.get("byte_fallback")
    if not plain:
        return None
    # the published rule of byte-level files: printable bytes stand for themselves, the others for code points from 256 on
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


class WordCoder:
    """Ids of a text by a ``tokenizers`` file: its words are split off, and the library encodes each new one.

    The file's pre-tokenizer cuts at the same places, and its merges never cross them, so words may be encoded apart. Words of
    a plain byte-level file go straight to the library's BPE model, which spares a third of the time a word that its whole
    chain takes; other files' words, and texts that hold an added token's string, go through the chain.
    """

    def __init__(self, spec: str, most: int = 450_000):
        self.coder = Tokenizer.from_str(spec)
        self.added = [t.content for t in self.coder.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self.coder.get_vocab_size() <= 1 << 16 else "<u4")
        self.letters = byte_letters(spec)
        self.model = self.coder.model
        self.letter = "H" if self.dtype.itemsize == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what was known before; what is still in use moves over
        self.most = most

    def words(self, listed: list[str]) -> list[list[int]]:
        if not self.letters:
            return [e.ids for e in self.coder.encode_batch_fast(listed, add_special_tokens=False)]
        spelled, letters = self.model.tokenize, self.letters
        return [[t.id for t in spelled(w.encode().decode("latin-1").translate(letters))] for w in listed]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned numbers."""
        if not text:
            return b""
        if any(t in text for t in self.added):
            return np.array(self.coder.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        words = split(text)
        new = set(words).difference(self.known)
        if new:
            if len(self.known) > self.most:
                self.older, self.known = self.known, {}
                new = set(words)
            known, older = self.known, self.older
            old = {w for w in new if w in older}  # (set.intersection would walk all of a dict)
            for w in old:
                known[w] = older[w]
            new -= old
            listed, letter = list(new), self.letter
            for w, ids in zip(listed, self.words(listed), strict=True):
                known[w] = array(letter, ids).tobytes()
        return b"".join(map(self.known.__getitem__, words))


_coders: dict[str, WordCoder] = {}


def coder_of(spec: str) -> WordCoder:
    """A process keeps its coder, and the words that it has seen."""
    if spec not in _coders:
        _coders.clear()
        _coders[spec] = WordCoder(spec)
    return _coders[spec]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and plain path of a Hadoop-style path with its scheme, as far as Arrow can reach it."""
    if ":/" not in path:
        raise ValueError(f"{path} names no file system")
    scheme, rest = path.split(":", 1)
    return fs.FileSystem.from_uri(f"{scheme}:{rest if rest.startswith('//') else '//' + rest}")


def train_dictionary(docs: DataFrame, spec: str, end_id: int, size: int = 65_536, most_docs: int = 3000, piece: int = 20_000) -> bytes:
    """A dictionary of ``size`` bytes, from the id arrays of about ``most_docs`` documents (by a hash of the id), whole.

    A long document's array is given to the training in pieces of ``piece`` bytes. With too little to learn from, the
    dictionary is empty and documents are compressed without one.
    """
    docs = docs.where("doc_id is not null")
    share = min(1.0, most_docs / max(docs.count(), 1))
    sample = docs.where((F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) / 1e6) < share)
    sent = docs.sparkSession.sparkContext.broadcast(spec)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(sent.value)
        end = np.array([end_id], coder.dtype).tobytes()
        for (text,) in rows(batches, "text"):
            data = coder.encode(text) + end
            yield pa.RecordBatch.from_arrays([pa.array([data[i : i + piece] for i in range(0, len(data), piece)], pa.binary())], names=["x"])

    samples = sample.select("text").mapInArrow(make, "x binary").toArrow().column("x").to_pylist()
    with contextlib.suppress(zstandard.ZstdError):
        if len(samples) >= 8:
            return zstandard.train_dictionary(min(size, sum(map(len, samples)) // 4), samples).as_bytes()
    return b""


def write_ids(docs: DataFrame, spec: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode each whole text, end it with ``end_id``, and write files in ascending id order under ``path``.

    Texts are range-partitioned by id, once, and sorted (repeated ids: by text; null ids come first); a task encodes its range and writes
    it in files of about 16 MB, each under a passing name that is then renamed, so that a task may be run again. Null text
    counts as empty: just the end id. Returns the manifest: ``file, first long`` (ids of all files before it), ``n_docs,
    n_ids``. An empty table gives an empty manifest.
    """
    spark = docs.sparkSession
    docs = docs_of(docs, id_col, text_col)
    dictionary, path = train_dictionary(docs, spec, end_id), qualified(spark, path)
    system, at = file_system(path)
    system.create_dir(at, recursive=True)
    with system.open_output_stream(f"{at}/dictionary") as out:
        out.write(dictionary)
    sent = spark.sparkContext.broadcast((spec, dictionary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, dictionary = sent.value
        coder, task, seq = coder_of(spec), TaskContext.get().partitionId(), 0
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if shared:
            shared.precompute_compress(level=3)
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=shared).compress
        end = np.array([end_id], coder.dtype).tobytes()
        ids, sizes, parts, size = [], [], [], 0

        def take() -> pa.RecordBatch:
            nonlocal seq, size
            name = f"ids-{task:07d}-{seq:07d}"
            n = np.array(sizes, np.int64)
            ends = HEAD_SIZE + np.cumsum([0, *map(len, parts)])
            index = b"".join([np.array([i or 0 for i in ids], "<i8").tobytes(), np.array([i is None for i in ids], np.uint8).tobytes(), (np.cumsum(n) - n).astype("<u8").tobytes(), ends.astype("<u8").tobytes()])
            head = struct.pack(HEAD, MAGIC, xxhash.xxh64_intdigest(dictionary), coder.dtype.itemsize, len(ids), int(n.sum()), int(ends[-1]))
            system, at = file_system(path)
            passing = f"{at}/.{name}-{uuid.uuid4().hex}"
            with system.open_output_stream(passing) as out:
                for x in (head, *parts, zstandard.ZstdCompressor(level=3).compress(index)):
                    out.write(x)
            system.move(passing, f"{at}/{name}")
            row = pa.RecordBatch.from_pydict({"file": [name], "task": [task], "seq": [seq], "n_docs": [len(ids)], "n_ids": [int(n.sum())]}, schema=pa.schema([("file", pa.string()), ("task", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
            ids.clear(), sizes.clear(), parts.clear()
            seq, size = seq + 1, 0
            return row

        for doc_id, text in rows(batches, "doc_id", "text"):
            data = coder.encode(text) + end
            ids.append(doc_id)
            sizes.append(len(data) // coder.dtype.itemsize)
            parts.append(squeeze(data))
            size += len(parts[-1]) + 24
            if size >= SHARD_BYTES:
                yield take()
        if ids:
            yield take()

    ordered = docs.repartitionByRange(partitions(docs), "doc_id").sortWithinPartitions("doc_id", "text")
    manifest = written(ordered.mapInArrow(run, "file string, task int, seq int, n_docs long, n_ids long"), "manifest")
    # ids before a task's files (a number for each task), and before a file among its task's
    before, total = [], 0
    for r in manifest.groupBy("task").agg(F.sum("n_ids").alias("n")).orderBy("task").collect():
        before.append((r["task"], total))
        total += r["n"]
    if not before:
        return manifest.select("file", F.lit(0).cast("long").alias("first"), "n_docs", "n_ids")
    own = F.sum("n_ids").over(W.partitionBy("task").orderBy("seq")) - F.col("n_ids")
    starts = spark.createDataFrame(before, "task int, start long")
    return manifest.withColumn("own", own).join(F.broadcast(starts), "task").select("file", (F.col("start") + F.col("own")).alias("first"), "n_docs", "n_ids")


class IdFile:
    """One file, opened for documents by position."""

    def __init__(self, path: str, name: str, dictionary: bytes | None = None):
        system, at = file_system(path)
        if dictionary is None:
            with system.open_input_file(f"{at}/dictionary") as f:
                dictionary = f.read()
        self.file = system.open_input_file(f"{at}/{name}")
        magic, known, width, self.n, self.n_ids, index = struct.unpack(HEAD, self.file.read_at(HEAD_SIZE, 0))
        if magic != MAGIC or known != xxhash.xxh64_intdigest(dictionary):
            raise ValueError(f"{name} is no id file of this dictionary")
        self.dtype = np.dtype(f"<u{width}")
        data = zstandard.ZstdDecompressor().decompress(self.file.read_at(self.file.size() - index, index), max_output_size=25 * self.n + 8)
        ids, null = np.frombuffer(data, "<i8", self.n), np.frombuffer(data, np.uint8, self.n, 8 * self.n)
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, null, strict=True)]
        self.before = np.frombuffer(data, "<u8", self.n, 9 * self.n).astype(np.int64)
        self.ends = np.frombuffer(data, "<u8", self.n + 1, 17 * self.n).astype(np.int64)
        self.grow = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None).decompress

    def ids(self, i: int) -> np.ndarray:
        """The ids of document ``i``: one short read."""
        return np.frombuffer(self.grow(self.file.read_at(int(self.ends[i + 1] - self.ends[i]), int(self.ends[i]))), self.dtype)


def read_ids(manifest: DataFrame, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_le`` of every document of the files in ``manifest``.

    ``start``: ids of all documents before; ``ids_le``: the ids as little-endian unsigned 32-bit numbers.
    """
    path = qualified(manifest.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, first in rows(batches, "file", "first"):
            f = IdFile(path, name)
            for lo in range(0, f.n, 500):
                hi = min(f.n, lo + 500)
                data = [f.ids(i).astype("<u4") for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids[lo:hi], pa.int64()), pa.array(f.before[lo:hi] + first), pa.array([len(d) for d in data], pa.int64()), pa.array([d.tobytes() for d in data], pa.binary())], names=["doc_id", "start", "n_tokens", "ids_le"])

    spread = manifest.select("file", "first").repartition(partitions(manifest), "file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_le binary")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files: where its ids start, how many they are, and their CRC-32."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    path = new_path(spark, "ids")
    manifest = write_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), spec, path)
    return read_ids(manifest, path).select("doc_id", "start", "n_tokens", F.crc32("ids_le").alias("ids_crc32"))
