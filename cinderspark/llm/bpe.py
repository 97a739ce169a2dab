"""Byte-level BPE: each distinct word is encoded once; decoding joins the token-byte table."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from cinderspark.llm.blocks import BLOCK_CHARS, Frame, in_buckets, numbered, out_of_blocks, pack, to_blocks, unpack, unpack_words
from cinderspark.llm.common import docs_of

IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
#: Token ids that are put together at a time.
STEP = 400_000
#: Words that a task remembers the ids of; beyond, it begins anew.
MOST_KNOWN = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file (base64 token, rank) of fixed size: the token-byte table."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text", decode: bool = False, most_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id, ids array<int>``: the BPE ids of each whole text, without special tokens; with ``decode``, also their bytes.

    Texts are split by ``pattern`` where they are; a block of documents becomes token numbers and its distinct words. The
    words are shuffled by hash, so that each distinct word is encoded once in the task that all its blocks' rows come to (which
    remembers a bounded number of words); the ids go back to the blocks and are put in place by position. Shuffled are packed numbers and distinct words, no texts.
    The rank table has a fixed size and is broadcast. Blocks have about ``most_chars`` characters: smaller ones need less memory
    and shuffle more words.

    Null or empty text has no ids. Null and repeated ids are kept: each row gives a row. Very long texts make a block of
    their own. An empty table gives an empty result. Other columns are ignored.
    """
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def answer():
        coder = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table.value, special_tokens={})
        known: dict[bytes, list[int]] = {}

        def of(data: bytes) -> bytes:
            found = []
            for word in unpack_words(data):
                ids = known.get(word)
                if ids is None:
                    if len(known) >= MOST_KNOWN:
                        known.clear()
                    ids = known[word] = coder.encode_ordinary(word.decode())  # (a match alone is one match)
                found.append(ids)
            sizes = np.fromiter(map(len, found), np.uint32, len(found))
            return pack(sizes, np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum())))

        return of

    find = regex.compile(pattern)
    blocks = to_blocks(docs_of(docs, id_col, text_col), numbered(lambda text: find.findall(text)), most_chars=most_chars)
    if not decode:
        return out_of_blocks(in_buckets(blocks, answer), _place, "doc_id long, ids array<int>")

    def both(frame: Frame) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(table.value)
        for part in _place(frame):
            yield pa.RecordBatch.from_arrays([*part.columns, decoded(part.column(1), tokens)], names=["doc_id", "ids", "decoded"])

    return out_of_blocks(in_buckets(blocks, answer), both, "doc_id long, ids array<int>, decoded binary")


def _place(frame: Frame) -> Iterator[pa.RecordBatch]:
    """The ids of a block's documents, from its words' ids."""
    parts = [unpack(a) for a in frame.answers]
    size = np.zeros(len(frame.order), np.int64)
    start = np.zeros(len(frame.order), np.int64)
    if parts:
        size[frame.order] = np.concatenate([p[0] for p in parts])
        start[frame.order] = np.cumsum(size[frame.order]) - size[frame.order]
    flat = np.concatenate([p[1] for p in parts]).astype(np.int32) if parts else np.zeros(0, np.int32)
    ends = np.cumsum(frame.sizes, dtype=np.int64)
    at = 0
    while at < len(frame.ids):
        lo = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, lo + STEP // 2, "right")))
        numbers = frame.numbers[lo : ends[to - 1]]
        n = size[numbers]
        cum = np.cumsum(n)
        values = flat[np.repeat(start[numbers] - (cum - n), n) + np.arange(int(cum[-1]) if len(cum) else 0)]
        doc_ends = np.r_[0, cum][ends[at:to] - lo]
        ids = pa.ListArray.from_arrays(pa.array(np.r_[0, doc_ends].astype(np.int32)), pa.array(values))
        yield pa.RecordBatch.from_arrays([pa.array(frame.ids[at:to], pa.int64()), ids], schema=IDS)
        at = to


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The token-byte table in order of id."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def decoded(lists: pa.ListArray, tokens: list[bytes]) -> pa.Array:
    """The token-byte table joined to each list of ids, by id, and the bytes put together by position."""
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    if len(values) and values.min() < 0:
        raise IndexError("token ids are not negative")
    valid = lists.is_valid().to_pylist()
    return pa.array([b"".join([tokens[i] for i in values[a:b].tolist()]) if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], valid, strict=True)], pa.binary())


def bpe_decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for; null ids give null, unknown ids raise ``IndexError``.

    The token-byte table (of fixed size, broadcast) is joined to the ids where they are.
    """
    table = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(table.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = decoded(part.column(part.schema.get_field_index(ids_col)), tokens)
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, out_col])

    return encoded.mapInArrow(decode, StructType([*encoded.schema.fields, StructField(out_col, BinaryType())]))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many ids its text has, and digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = bpe_encode(docs, path, decode=True)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed.cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
