"""Line de-duplication: range-partitioned line hashes, streamed in order, give keep bitmaps per document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cinderspark.llm.common import WS, Out, docs_of, partitions, rows
from cinderspark.sources.tables import written

LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32())])
FOUND = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("open", pa.bool_())])


#: Bytes of keep bitmaps that go to every task; more are joined by document.
MOST_SENT = 32 << 20


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which lines to keep: ``doc_id, keep`` of each document that loses lines, once.

    A line's key is the line stripped of ASCII white space and with A-Z lower-cased. Keys of at least ``min_chars`` code
    points found in at least ``min_docs`` documents lose all lines, except in the largest ``doc_id`` that holds them.
    ``keep`` is a zlib-compressed bitmap (bit i, most significant first, is line i) up to the last line that goes; lines after
    it stay.

    The key hashes (128 bits) are range-partitioned with the document, descending, and the position as secondary order: a
    key that holds a third of all lines is split over partitions, a task streams its runs and holds back only the lines of
    the first ``min_docs - 1`` documents of a run. Runs that touch a partition's ends come out undecided; their totals are
    aggregated apart (two keys a partition at most, so they can be broadcast) and decide them.

    Null text is one empty line. Rows with a null id count for no key and keep all lines. Rows that repeat an id count as
    one document, whose bitmap holds for each of them. An empty table gives an empty result. Other columns are ignored.
    """
    dropped = dropped_lines(docs_of(docs, id_col, text_col), min_chars, min_docs)
    return dropped.groupBy("doc_id").agg(F.collect_set("pos").alias("lost")).mapInArrow(_bitmaps, "doc_id long, keep binary")


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """``doc_id, pos`` of each line that goes."""
    spark = docs.sparkSession
    hashed = docs.where("doc_id is not null and text is not null").mapInArrow(_hash_lines(min_chars), "h1 long, h2 long, doc_id long, pos int")
    order = ["h1", "h2", F.col("doc_id").desc(), "pos"]
    ranged = hashed.repartitionByRange(partitions(hashed), *order).sortWithinPartitions(*order)
    found = ranged.mapInArrow(_stream(min_docs), "h1 long, h2 long, doc_id long, pos int, open boolean")
    undecided = found.where("open")
    totals = undecided.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last")).where(F.col("n") >= min_docs)
    # at most two keys a partition are open, so this table is bounded by twice the number of partitions
    late = undecided.join(F.broadcast(totals), ["h1", "h2"]).where("doc_id < last")
    return found.where("not open").select("doc_id", "pos").unionByName(late.select("doc_id", "pos"))


def _hash_lines(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        data, ids, pos = [], [], []

        def take():
            h = np.frombuffer(b"".join(data), ">i8").reshape(-1, 2).astype(np.int64)
            out = pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(ids, pa.int64()), pa.array(pos, pa.int32())], schema=LINES)
            data.clear(), ids.clear(), pos.clear()
            return out

        for doc_id, text in rows(batches, "doc_id", "text"):
            for i, line in enumerate(text.split("\n")):
                if len(line) >= min_chars and len(key := line.strip(WS)) >= min_chars:
                    data.append(digest(key.encode().lower()))
                    ids.append(doc_id)
                    pos.append(i)
            if len(ids) >= 50_000:
                yield take()
        if ids:
            yield take()

    return run


class _Run:
    """The run that a batch's end has cut: its key, its documents so far, and the lines that its end still decides."""

    def __init__(self, key, first: bool):
        self.key, self.first = key, first
        self.last_doc, self.n = None, 0
        self.witness: list[tuple] = []  # a line of each of the first min_docs documents
        self.held: list[tuple] = []


def _stream(min_docs: int):
    """Of sorted lines: those that go; and, as undecided, the first run of the partition and enough of the last to count it."""

    def out(cols, open_: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(pa.array(c) for c in cols), pa.array(np.full(len(cols[0]), open_))], schema=FOUND)

    def feed(run: _Run, cols, doc) -> Iterator[pa.RecordBatch]:
        """More lines of ``run``; a document's lines are next to each other."""
        new = np.r_[run.last_doc is None or doc[0] != run.last_doc, doc[1:] != doc[:-1]]
        rank = run.n + np.cumsum(new)
        run.n, run.last_doc = int(rank[-1]), doc[-1]
        if run.first:
            yield out(cols, True)
            return
        seen = np.flatnonzero(new & (rank <= min_docs))
        if len(seen):
            run.witness.append(tuple(c[seen] for c in cols))
        run.held.append((tuple(c.copy() for c in cols), rank))
        if run.n >= min_docs:
            for c, r in run.held:
                if (go := r > 1).any():
                    yield out([x[go] for x in c], False)
            run.held = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Run | None = None
        for batch in batches:
            if not (n := batch.num_rows):
                continue
            cols = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            h1, h2, doc, _ = cols
            starts = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
            ends = np.r_[starts[1:], n]
            at = 0
            if now is None:
                now = _Run((h1[0], h2[0]), True)
            if now.key == (h1[0], h2[0]):
                yield from feed(now, [c[: ends[0]] for c in cols], doc[: ends[0]])
                at = 1
            if at < len(starts):
                a, b = starts[at], starts[-1]
                if b > a:  # runs that begin and end within the batch
                    new_doc = np.r_[True, (doc[a + 1 : b] != doc[a : b - 1])]
                    new_doc[starts[at:-1] - a] = True
                    nth = np.cumsum(new_doc)
                    before = nth[starts[at:-1] - a] - 1
                    size = ends[at:-1] - starts[at:-1]
                    rank = nth - np.repeat(before, size)
                    go = (np.repeat(rank[ends[at:-1] - 1 - a], size) >= min_docs) & (rank > 1)
                    if go.any():
                        yield out([c[a:b][go] for c in cols], False)
                now = _Run((h1[b], h2[b]), False)
                yield from feed(now, [c[b:] for c in cols], doc[b:])
        if now is not None and not now.first:
            for c in [*now.witness, *(c for c, _ in now.held)]:
                yield out(c, True)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = Out(pa.schema([("doc_id", pa.int64()), ("keep", pa.binary())]))
    for doc_id, lost in rows(batches, "doc_id", "lost"):
        keep = np.ones((max(lost) + 8) // 8 * 8, bool)  # whole bytes: bits past the last line that goes are set
        keep[lost] = False
        made.add((doc_id, zlib.compress(np.packbits(keep).tobytes())), 100)
        if made.full():
            yield made.take()
    yield made.take()


def kept_lines(bits: bytes | None, text: str | None) -> tuple[str, int, int]:
    """``text`` without the lines that a keep bitmap drops; how many lines it had, and how many go."""
    text = text or ""
    if bits is None:
        return text, text.count("\n") + 1, 0
    lines = text.split("\n")
    keep = np.ones(len(lines), bool)
    told = np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8)).astype(bool)[: len(lines)]
    keep[: len(told)] = told
    gone = len(lines) - int(keep.sum())
    return "\n".join(line for line, k in zip(lines, keep.tolist(), strict=True) if k), len(lines), gone


def dedup_texts(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text", most_sent: int = MOST_SENT) -> DataFrame:
    """``docs`` (all columns) as ``row``, with each document's remaining ``text``, ``n_lines`` and ``n_dropped``.

    The bitmaps of :func:`line_dedup` are stored, and applied where the texts are: sent to every task while they are of at most
    ``most_sent`` bytes altogether, else joined by document. Rules are those of :func:`line_dedup`.
    """
    bits = written(line_dedup(docs, min_chars, min_docs, id_col, text_col), "keep")
    size = bits.agg(F.sum(F.length("keep") + 40).alias("n")).first()["n"] or 0
    kept = docs.select(F.struct(*(c for c in docs.columns if c != text_col)).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([kept.schema["row"], StructField("doc_id", LongType()), StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())])
    side = F.broadcast(bits) if size <= most_sent else bits.hint("shuffle_merge")
    return kept.join(side, "doc_id", "left").select("row", "doc_id", "text", "keep").mapInArrow(_apply, schema)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            out = [kept_lines(keep, text) for keep, text in zip(part.column("keep").to_pylist(), part.column("text").to_pylist(), strict=True)]
            made = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *made], names=["row", "doc_id", "text", "n_lines", "n_dropped"])


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many lines it has, how many go, and the SHA-256 of what stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return dedup_texts(docs).select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


_STRIPPED = r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
OP2_SQL = f"""
WITH lines AS (
  SELECT doc_id, pos, line, translate({_STRIPPED}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
keys AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT l.*, coalesce(l.doc_id < s.last, false) AS gone FROM lines l LEFT JOIN keys s USING (k))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
