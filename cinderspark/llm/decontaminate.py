"""Benchmark decontamination: a stored positional index of the training tokens, asked for the benchmark's word windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.llm.blocks import numbered_hashes, pack, pack_words, trim, unpack, unpack_words
from cinderspark.llm.common import distinct, docs_of, rows
from cinderspark.sources.tables import written

#: Bytes to words: A-Z lower-cased; ASCII other than letters and digits is a gap; all other characters are of words.
GAPS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Bytes of text that close a part of the index, windows asked in one pass, and postings of a list block.
PART_BYTES, ASKED, LIST_BLOCK = 2_000_000, 200_000, 2048
#: Pairs of a window and a place that are compared at a time.
STEP = 2_000_000
OUT = pa.schema([("part", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
DDL = "part long, row int, doc_id long, n_words long, n_hit long, items array<long>, spans array<struct<start:int,end:int>>"
INDEX = pa.schema([("part", pa.int64()), ("docs_", pa.binary()), ("terms", pa.binary()), ("words", pa.binary()), ("places", pa.binary())])


def plain(text: str | None) -> bytes:
    """A text's words, lower-cased, with a space for everything that is of no word."""
    return (text or "").encode().translate(GAPS)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The positional inverted index of ``docs``, stored in the shared folder, one row for a part of about 300,000 tokens.

    ``docs_`` packs the part's doc ids, whether each is null, and its words; ``terms`` the sorted term hashes, the lengths of
    their posting lists, where each block of postings begins, and the postings of a block; ``words`` the terms themselves; ``places`` all lists end to
    end, as steps, in blocks that can be read apart. Documents of a part follow each other with a place between them, so that
    no phrase crosses. Parts hold whole documents, so asking needs no shuffle of postings.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[bytes] = []
        size, part = 0, TaskContext.get().partitionId() << 24

        def take() -> pa.RecordBatch:
            flat, sizes, words, hashes = numbered_hashes(texts, 1 << 18)
            sizes = sizes.astype(np.int64)
            place = np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)
            order = np.argsort(flat, kind="stable")
            count = np.bincount(flat, minlength=len(words))
            first = np.cumsum(count) - count
            place = place[order]
            steps = np.diff(place, prepend=0)
            steps[first] = place[first]
            steps = steps.astype(np.uint32)
            blocks = [pack(steps[i : i + LIST_BLOCK]) for i in range(0, len(steps), LIST_BLOCK)]
            at = np.cumsum([0, *map(len, blocks)], dtype=np.uint32)
            cols = [pack(np.array([i or 0 for i in ids], np.int64), np.array([i is None for i in ids], np.uint8), sizes.astype(np.uint32)), pack(hashes, count.astype(np.uint32), at, np.array([LIST_BLOCK], np.uint32)), pack_words(words), b"".join(blocks)]
            ids.clear(), texts.clear()
            trim()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *(pa.array([c], pa.binary()) for c in cols)], schema=INDEX)

        for doc_id, text in rows(batches, "doc_id", "text"):
            texts.append(plain(text))
            ids.append(doc_id)
            size += len(texts[-1]) + 6
            if size >= PART_BYTES:
                yield take()
                size, part = 0, part + 1
        if ids:
            yield take()

    return written(docs_of(docs, id_col, text_col).mapInArrow(run, "part long, docs_ binary, terms binary, words binary, places binary"), "postings")


class Windows:
    """What is asked: distinct windows of term numbers (-1 past a window's size), the terms with their hashes, and the windows' items."""

    def __init__(self, items: list[tuple[int, str]], width: int = 13):
        flat, sizes, self.words, self.hashes = numbered_hashes([plain(t) for _, t in items])
        found, size, owner, at = [], [], [], 0
        for (item, _), n in zip(items, sizes.tolist(), strict=True):
            own = flat[at : at + n].astype(np.int64)
            at += n
            if not n:
                continue
            many = max(1, n - width + 1)
            found.append(np.lib.stride_tricks.sliding_window_view(own, width) if n >= width else np.r_[own, np.full(width - n, -1)][None])
            size += [min(n, width)] * many
            owner += [item] * many
        every = np.concatenate(found) if found else np.zeros((0, width), np.int64)
        self.windows, kept, number = np.unique(every, axis=0, return_index=True, return_inverse=True)
        self.sizes = np.array(size, np.int64)[kept]
        pairs = np.unique(np.stack([number.ravel(), np.array(owner, np.int64)], 1), axis=0)
        self.first, self.owner = np.searchsorted(pairs[:, 0], np.arange(len(kept) + 1)), pairs[:, 1]


class Part:
    """A part of the index, opened: terms at once, posting lists when they are asked for."""

    def __init__(self, docs_: bytes, terms: bytes, words: bytes, places: bytes):
        ids, null, sizes = unpack(docs_)
        self.ids = [None if n else i for i, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.sizes = sizes.astype(np.int64)
        self.start = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.hashes, count, self.at, (self.block,) = unpack(terms)
        self.count = count.astype(np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.words, self.places = words, places
        self.length = int((self.sizes + 1).sum())

    def terms_of(self, asked: Windows) -> np.ndarray:
        """The part's number of each asked term, -1 where it lacks it: found by hash, and compared as words."""
        if not len(self.hashes) or not len(asked.hashes):
            return np.full(len(asked.hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, asked.hashes), len(self.hashes) - 1)
        same = np.flatnonzero(self.hashes[at] == asked.hashes)
        found = np.full(len(asked.hashes), -1)
        if len(same):
            own = unpack_words(self.words)
            for i in same.tolist():
                if own[at[i]] == asked.words[i]:
                    found[i] = at[i]
        return found

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """The posting lists of some terms (ascending), end to end, as term * (length + 1) + place; only their blocks are read."""
        n = self.count[terms]
        ends = np.cumsum(n)
        i = np.repeat(self.first[terms] - (ends - n), n) + np.arange(int(n.sum()))
        blocks, _, which = distinct(i // int(self.block))
        read = [unpack(self.places[self.at[b] : self.at[b + 1]])[0] for b in blocks.tolist()]
        begin = np.cumsum([0, *map(len, read)])[:-1]
        total = np.cumsum(np.concatenate(read).astype(np.int64)[begin[which] + i % int(self.block)])
        before = np.where(ends > n, total[ends - n - 1], 0)
        return total - np.repeat(before, n) + np.repeat(terms, n) * (self.length + 1)

    def find(self, asked: Windows, slop: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window number, place) of every match, in groups.

        A window's lists are intersected from its rarest term on: each place of the rarest term is where the window would
        begin, less the term's offset; what the next rarest term's list lacks at its own offset goes, and so on. A window with
        a term that the part lacks is left out before any list is read. With ``slop``, a term may stand that many places before
        or after its own (proximity).
        """
        known = self.terms_of(asked)
        used = asked.windows >= 0
        term = np.where(used, known[asked.windows] if len(known) else -1, -1)
        alive = np.flatnonzero((term >= 0).sum(1) == asked.sizes)
        if not len(alive):
            return
        term, used, sizes = term[alive], used[alive], asked.sizes[alive]
        named = distinct(term[used])[0]
        keys = self.lists(named)
        begin = np.cumsum(self.count[named]) - self.count[named]
        length = np.where(used, self.count[term], np.iinfo(np.int64).max)
        order = np.argsort(length, axis=1, kind="stable")
        rarest = term[np.arange(len(alive)), order[:, 0]]
        many = self.count[rarest]
        wide = self.length + 1
        lo = 0
        while lo < len(alive):
            hi = max(lo + 1, int(np.searchsorted(np.cumsum(many[lo:]), STEP, "right")) + lo)
            group = np.arange(lo, hi)
            n = many[group]
            w = np.repeat(group, n)
            first = begin[np.searchsorted(named, rarest[group])]
            place = keys[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] - rarest[w] * wide - order[w, 0]
            ok = (place >= 0) & (place + sizes[w] <= self.length)
            w, place = w[ok], place[ok]
            for k in range(1, term.shape[1]):
                if not len(w):
                    break
                j = order[w, k]
                base = term[w, j] * wide
                low, high = np.maximum(place + j - slop, 0), np.minimum(place + j + slop, self.length)
                there = np.searchsorted(keys, base + low) < np.searchsorted(keys, base + high, "right")
                keep = there | (k >= sizes[w])
                w, place = w[keep], place[keep]
            if slop and len(w):  # all of it in one document
                doc = np.searchsorted(self.start, place, "right") - 1
                ok = place + sizes[w] <= self.start[doc] + self.sizes[doc]
                w, place = w[ok], place[ok]
            yield alive[w], place
            lo = hi


def ask_index(index: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = 13, slop: int = 0) -> DataFrame:
    """``doc_id, n_words, n_hit, items, spans`` of each indexed document.

    ``items``: ids of the benchmark items with a window in the document, ascending; ``spans``: runs of hit words (ends
    exclusive); ``n_hit``: their words. ``slop`` above 0 asks for proximity instead of the exact phrase. The benchmark is
    the stated query set: it is asked in groups of about 200,000 windows (20 MB), one pass over the index each, so that one
    group is broadcast at a time; a document's answers to several groups are merged. Items with a null id or no words have no
    window. Rows that repeat an id each give a row. An empty benchmark hits nothing; an empty index gives an empty result.
    """
    known = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).cast("string").alias("text")).where("item is not null and text is not null")
    passes, held, n = [], [], 0
    for row in known.toLocalIterator():
        held.append((row["item"], row["text"]))
        n += max(1, len(row["text"]) // 4)
        if n >= ASKED:
            passes.append(written(_ask(index, Windows(held, width), slop), "answers"))
            held, n = [], 0
    last = _ask(index, Windows(held, width), slop)
    if not passes:
        return last.drop("part", "row")
    for more in passes:
        last = last.unionByName(more)
    grouped = last.groupBy("part", "row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    # spans in order of start: one that begins within what is covered so far makes that longer
    step = lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(s)))
    merged = grouped.withColumn("spans", F.aggregate("spans", F.expr("cast(array() as array<struct<start:int,end:int>>)"), step))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]))
    return merged.select("doc_id", "n_words", hit.alias("n_hit"), "items", "spans")


def _ask(index: DataFrame, asked: Windows, slop: int) -> DataFrame:
    """A pass over the index for one group of windows."""
    sent = index.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for number, docs_, terms, words, places in rows(batches, "part", "docs_", "terms", "words", "places"):
            part = Part(docs_, terms, words, places)
            hit = np.zeros(part.length + 1, np.int32)
            pairs = []
            for w, place in part.find(asked, slop):
                np.add.at(hit, place, 1)
                np.add.at(hit, place + asked.sizes[w], -1)
                doc = np.searchsorted(part.start, place, "right") - 1
                doc, w = np.unique(np.stack([doc, w], 1), axis=0).T
                many = asked.first[w + 1] - asked.first[w]
                at = np.repeat(asked.first[w] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
                pairs.append(np.unique(np.stack([np.repeat(doc, many), asked.owner[at]], 1), axis=0))
            pairs = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
            hit = np.cumsum(hit)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8)))
            spans: dict[int, list] = {}
            for a, b in turn.reshape(-1, 2).tolist():
                i = int(np.searchsorted(part.start, a, "right")) - 1
                spans.setdefault(i, []).append({"start": a - int(part.start[i]), "end": b - int(part.start[i])})
            items: dict[int, list] = {}
            for i, item in pairs.tolist():
                items.setdefault(i, []).append(item)
            many = range(len(part.ids))
            cols = [[number] * len(many), list(many), part.ids, part.sizes.tolist(), [sum(s["end"] - s["start"] for s in spans.get(i, ())) for i in many], [items.get(i, []) for i in many], [spans.get(i, []) for i in many]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, OUT, strict=True)], schema=OUT)

    return index.mapInArrow(run, DDL)


def contaminated(found: DataFrame, least_part: int = 20):
    """Whether a document counts as contaminated: it has hit words, and they are one in ``least_part`` at least."""
    return (found["n_hit"] > 0) & (found["n_hit"] * least_part >= found["n_words"])


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, those within benchmark windows, and the items that it holds."""
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    found = ask_index(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(listed.cast("binary"), 256).alias("items_sha256"), contaminated(found).alias("contaminated"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
q AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, list_slice(w, i, i + least(len(w), 13) - 1) AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
h AS (SELECT p.doc_id, p.i, p.n, q.item_id FROM p JOIN q USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT k) AS c FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS k, string_agg(s, ',' ORDER BY s) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c, 0) AS n_hit, coalesce(k, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256,
       coalesce(c, 0) > 0 AND 20 * coalesce(c, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
