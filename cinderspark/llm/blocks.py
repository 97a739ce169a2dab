"""Texts as blocks of word numbers, so that only each block's distinct words are shuffled.

A block is a run of documents of bounded size. Its words are numbered by falling frequency; the numbers, packed, are the
block's *frame* (one row). Its distinct words go out in *word rows*, one for each hash bucket, so that equal words of all
blocks meet in the task that holds their bucket; what is found there for them goes back to the block. A word that a third
of all tokens repeat is one entry a block, so no key is hot. Frame and word rows travel in one dataflow, without a second
reading of the texts, so a recomputed task can't disagree with itself.

Rows: ``key int`` (where to), ``block long``, ``bucket int`` (-1: the frame), ``data binary``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.llm.common import distinct, fresh, partitions, rows, trim, word_hashes

SCHEMA = pa.schema([("key", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
DDL = "key int, block long, bucket int, data binary"
#: Characters of text that close a block.
BLOCK_CHARS = 24_000_000


@lru_cache(1)
def _coders() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    """Made once a process: to make them costs more than to pack a small array."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays, compressed apart with their bytes in planes, which suits small numbers in wide types."""
    parts = []
    squeeze = _coders()[0].compress
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
        body = squeeze(np.ascontiguousarray(planes).tobytes())
        parts.append(a.dtype.str.encode().ljust(4) + len(a).to_bytes(8, "little") + len(body).to_bytes(8, "little") + body)
    return b"".join(parts)


def unpack(data: bytes) -> list[np.ndarray]:
    found, at = [], 0
    grow = _coders()[1].decompress
    while at < len(data):
        kind, n = np.dtype(data[at : at + 4].decode().strip()), int.from_bytes(data[at + 4 : at + 12], "little")
        size = int.from_bytes(data[at + 12 : at + 20], "little")
        body = grow(data[at + 20 : at + 20 + size], max_output_size=max(1, n * kind.itemsize))
        planes = np.frombuffer(body, np.uint8).reshape(kind.itemsize, n).T
        found.append(np.ascontiguousarray(planes).view(kind).reshape(n))
        at += 20 + size
    return found


def pack_words(words: list[bytes]) -> bytes:
    return pack(np.fromiter(map(len, words), np.uint32, len(words)), np.frombuffer(b"".join(words), np.uint8))


def unpack_words(data: bytes) -> list[bytes]:
    """The words of :func:`pack_words`; arrays packed after them are left alone."""
    sizes, body = unpack(data)[:2]
    body, ends = body.tobytes(), np.cumsum(sizes, dtype=np.int64).tolist()
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


class Words(defaultdict):
    """Word to its number, in order of first sight."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def bucket_of(word: bytes, n: int) -> int:
    return xxhash.xxh3_64_intdigest(word) % n


def numbered(split: Callable[[str], list]) -> Callable:
    """Numbers the tokens of a block's texts, as ``split`` gives them, in order of first sight."""

    def run(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list]:
        words, found = Words(), []
        for text in texts:
            tokens = split(text)
            found.append(np.fromiter(map(words.__getitem__, tokens), np.uint32, len(tokens)))
        return np.concatenate(found), np.array([len(x) for x in found], np.uint32), list(words)

    return run


def numbered_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Numbers the white-space-bounded words of a block's texts (A-Z lower-cased); with their hashes."""
    return numbered_hashes([t.encode() for t in texts])


def numbered_hashes(texts: list[bytes], most: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Word numbers in order of the words' hashes, words a text, words, and hashes; about ``most`` bytes are taken at a time."""
    parts, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size >= most:
            parts.append(word_hashes(held))
            held, size = [], 0
    if held or not parts:
        parts.append(word_hashes(held))
    value, at, number = distinct(np.concatenate([p[3] for p in parts]))
    begin = np.cumsum([0, *(len(p[3]) for p in parts)])
    part = np.searchsorted(begin, at, "right") - 1
    words: list[bytes] = [b""] * len(value)
    for k, (data, start, end, *_) in enumerate(parts):
        body, own = data.tobytes().lower(), np.flatnonzero(part == k)
        i = at[own] - begin[k]
        for w, a, b in zip(own.tolist(), start[i].tolist(), end[i].tolist(), strict=True):
            words[w] = body[a:b]
    return number.astype(np.uint32), np.concatenate([np.diff(p[4]) for p in parts]).astype(np.uint32), words, value


def to_blocks(docs: DataFrame, number: Callable[[list[str]], tuple], extra: Callable[[int | None, str], int] | None = None, most_chars: int = BLOCK_CHARS, buckets: int | None = None) -> DataFrame:
    """Frames and word rows of ``docs(doc_id, text)``; ``number`` gives a block's token numbers, tokens a text, tokens (str or bytes), and it may give their hashes, which then say the buckets.

    A frame packs doc ids, whether an id is null, tokens a document, token numbers, and the bucket of each number; then
    ``extra``'s number for each document. With ``extra``, word rows carry how often each word stands in documents whose
    number is 1.
    """
    buckets = buckets or min(4096, partitions(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        texts: list[str] = []
        chars = 0

        def take() -> pa.RecordBatch:
            nonlocal seq, chars
            block, seq = task << 24 | seq, seq + 1
            flat, sizes, words, *hashes = number(texts)
            marks = np.array([extra(i, t) if extra else 0 for i, t in zip(ids, texts, strict=True)], np.uint8)
            texts.clear()
            count = np.bincount(flat, minlength=len(words))
            order = np.argsort(-count, kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[order] = np.arange(len(words), dtype=np.uint32)
            listed = [w if isinstance(w, bytes) else w.encode() for w in (words[i] for i in order.tolist())]
            to = (hashes[0][order] % np.uint64(buckets)).astype(np.uint16) if hashes else np.fromiter((bucket_of(w, buckets) for w in listed), np.uint16, len(listed))
            flat = rank[flat]
            arrays = [np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], np.uint8), sizes, flat, to, marks]
            out = [((task + (seq - 1) * 7919) & 0x7FFFFFFF, block, -1, pack(*arrays))]  # blocks of a task go to different places
            learnt = np.bincount(flat[np.repeat(marks.astype(bool), sizes)], minlength=len(listed)).astype(np.uint32) if extra else None
            by = np.argsort(to, kind="stable")
            cuts = np.flatnonzero(np.diff(to[by])) + 1
            for part in np.split(by, cuts) if len(by) else ():
                data = pack_words([listed[i] for i in part.tolist()]) + (pack(learnt[part]) if extra else b"")
                out.append((int(to[part[0]]), block, int(to[part[0]]), data))
            ids.clear()
            chars = 0
            trim()
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), SCHEMA, strict=True)], schema=SCHEMA)

        for doc_id, text in rows(batches, "doc_id", "text"):
            ids.append(doc_id)
            texts.append(text or "")
            chars += len(texts[-1]) + 16
            if chars >= most_chars:
                yield take()
        if ids:
            yield take()

    return docs.mapInArrow(run, DDL)


def in_buckets(blocks: DataFrame, answer: Callable[[], Callable[[bytes], bytes]]) -> DataFrame:
    """Word rows answered where their bucket is; frames pass. ``answer()`` makes a task's function from word rows to answers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = None
        for batch in fresh(batches):
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16).to_pydict()
                if of is None and any(b >= 0 for b in part["bucket"]):
                    of = answer()
                part["data"] = [x if b < 0 else of(x) for b, x in zip(part["bucket"], part["data"], strict=True)]
                yield pa.RecordBatch.from_pydict(part, schema=SCHEMA)

    return by_bucket(blocks).mapInArrow(run, DDL)


def by_bucket(blocks: DataFrame) -> DataFrame:
    """Rows dealt by key, a partition for each bucket: hashed keys would leave some partitions empty and fill others twice."""
    n = partitions(blocks)
    return blocks.repartitionById(n, F.pmod("key", F.lit(n)))


class Frame:
    """A block that has its answers back: ``answers`` has one for each bucket, and ``order`` the words' numbers in that order."""

    def __init__(self, data: bytes):
        ids, null, self.sizes, self.numbers, to, self.marks = unpack(data)
        self.ids = [None if n else i for i, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.order = np.argsort(to, kind="stable")
        self.answers: list[bytes] = []


def out_of_blocks(answered: DataFrame, finish: Callable, ddl: str, frame_of: Callable = Frame) -> DataFrame:
    """``finish`` of each block, opened by ``frame_of``; one block is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame = None
        for batch in fresh(batches):
            for at in range(0, batch.num_rows, 16):
                part = batch.slice(at, 16)
                for block, bucket, data in zip(*(part.column(c).to_pylist() for c in ("block", "bucket", "data")), strict=True):
                    if bucket < 0:
                        if frame is not None:
                            yield from finish(frame)
                            frame = None
                            trim()
                        frame = frame_of(data)
                        frame.block = block
                    else:
                        frame.answers.append(data)
        if frame is not None:
            yield from finish(frame)

    n = partitions(answered)
    return answered.repartitionById(n, F.pmod(F.shiftright("block", 24) + F.col("block").bitwiseAND(F.lit((1 << 24) - 1)) * 7919, F.lit(n)).cast("int")).sortWithinPartitions("block", "bucket").mapInArrow(run, ddl)
