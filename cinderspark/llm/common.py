"""Shared pieces of the text operators: column choice, word hashes, packed arrays."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The white space that bounds words: space, and U+0009 to U+000D.
WS = " \t\n\x0b\x0c\r"
U64 = np.uint64
STEP, SALT = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)
MIX1, MIX2 = U64(0xFF51AFD7ED558CCD), U64(0xC4CEB9FE1A85EC53)


def docs_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text string`` of any table; other columns, whatever their names, are left behind."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain constants): spreads every input bit over the output."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(33))) * MIX1
        x = (x ^ (x >> U64(33))) * MIX2
        return x ^ (x >> U64(33))


def _table() -> np.ndarray:
    """A number for each byte; those of A-Z are those of a-z."""
    made = mix(np.arange(1, 257, dtype=U64) * SALT)
    made[65:91] = made[97:123]
    return made


BYTE, GAP = _table(), np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
BASE = 0x2545F4914F6CDD1D | 1
_powers: list[np.ndarray] = []


def powers(n: int) -> list[np.ndarray]:
    """BASE and its inverse (modulo 2^64) to the powers 0 to n - 1, made once a process and grown by steps of 2^18."""
    if not _powers or len(_powers[0]) < n:
        size = max(1, -(-n >> 18)) << 18
        with np.errstate(over="ignore"):
            _powers[:] = [np.cumprod(np.r_[U64(1), np.full(size - 1, U64(x))]) for x in (BASE, pow(BASE, -1, 1 << 64))]
    return _powers


def word_hashes(texts: list[bytes]) -> tuple:
    """The words of many texts at once: their bytes (A-Z lower-cased), starts, ends and 64-bit hashes, and the number of each text's first word.

    A word's hash is the sum of its bytes' numbers times the powers of BASE, taken from one running sum and finalised.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    edge = np.flatnonzero(np.diff(GAP[data], prepend=True))
    start, end = edge[::2], edge[1::2]
    up, down = powers(len(data))
    with np.errstate(over="ignore"):
        total = np.r_[U64(0), np.cumsum(BYTE[data] * up[: len(data)])]
        h = mix((total[end] - total[start]) * down[start] + (end - start).astype(U64) * STEP)
    return data, start, end, h, np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts)]))


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the place of one of each, and each element's number among them."""
    order = np.argsort(x)
    y = x[order]
    new = np.r_[True, y[1:] != y[:-1]] if len(y) else np.zeros(0, bool)
    number = np.empty(len(x), np.int64)
    number[order] = np.cumsum(new) - 1
    return y[new], order[new], number


def trim() -> None:
    """Give what a block has used back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, which begins and ends without freed memory."""
    trim()
    yield from batches
    trim()


def rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Python tuples of the named columns, a few hundred at a time so that a batch of long texts is not held twice."""
    for batch in fresh(batches):
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


class Out:
    """Collects rows and yields record batches of a bounded size."""

    def __init__(self, schema: pa.Schema, most_rows: int = 4000, most_bytes: int = 8 << 20):
        self.schema, self.most_rows, self.most_bytes = schema, most_rows, most_bytes
        self.rows: list[tuple] = []
        self.size = 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size

    def full(self) -> bool:
        return len(self.rows) >= self.most_rows or self.size >= self.most_bytes

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * len(self.schema)
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, self.schema, strict=True)], schema=self.schema)


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str, n: int):
    """crc32 of the id's decimal text, mod ``n``; -1 for a null id, which so belongs to no fold."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % n, F.lit(-1))
