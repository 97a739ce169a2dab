"""Text scores by a probabilistic suffix tree over words, grown depth by depth from the whole corpus.

Symbols are words (A-Z lower-cased) and the end of a text, which also stands before its first word. A state is a context: the
last d words, for any d. The empty context has the word model's distribution. A context is kept where its next-symbol
distribution diverges from that of its longest kept suffix: n times the divergence, each occurrence judged by the others
(leave-one-out, so that chance repeats don't count), has to be above ``least_gain`` nats. A kept distribution is smoothed
toward that suffix (Witten and Bell), and a symbol is scored by the longest kept context before it.

Growth: a context gets longer ones while it has two next symbols, one of which occurs twice (else no longer context could pass
the test, or tell more), and not more than ``patience`` lengths in a row have failed. Depth has no bound; the rounds end when
no context can grow.

Each depth is one round trip: blocks of documents ask for their distinct (context, next) pairs, with counts of the teaching
texts; pairs meet by a hash of the context, where counts are summed, the test is made and probabilities are given back. The
pairs of a context whose last word is very frequent are split by the next symbol; first their totals meet, then their gains, so
that such a context is judged as any other.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.llm import blocks as B
from cinderspark.llm.common import STEP, U64, Out, distinct, docs_of, fold, mix, partitions, rows
from cinderspark.sources.tables import drop, written

#: Characters of a block; occurrences of a word from which its contexts are split; natural logarithms travel as whole thousandths.
BLOCK_CHARS, HOT, SCALE = 12_000_000, 1 << 23, 1000
#: Active positions for each bucket of a round, and the buckets that a round has at least: a block sends a row to each.
PER_BUCKET, LEAST_BUCKETS = 500_000, 64
STATS, TOTALS = -2, -3
KEPT, FEW, GROWS = 1, 2, 4
OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("known_words", pa.int64()), ("log_counts", pa.float64()), ("score", pa.float64())])
OUT_DDL = "doc_id long, n_words long, known_words long, log_counts double, score double"


def learns(doc_id: int | None, folds: int = 5, left_out: int = 1) -> bool:
    """Whether a document teaches: its fold is not the one left out; a null id has no fold and teaches nothing."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds != left_out


def _row(key: int, block: int, bucket: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"key": [key], "block": [block], "bucket": [bucket], "data": [data]}, schema=B.SCHEMA)


def _gathered(run: Callable) -> Callable:
    """A task that gives rows (key, block, bucket, data), as one that gives batches of many: each batch has its own cost."""

    def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(B.SCHEMA, 512, 4 << 20)
        for row in run(batches):
            out.add(row, len(row[3]))
            if out.full():
                yield out.take()
        if out.rows:
            yield out.take()

    return batches_of


def round_buckets(active: int, buckets: int) -> int:
    """Buckets of a round with so many active positions: blocks times buckets are rows, so late rounds have fewer."""
    return min(buckets, max(LEAST_BUCKETS, -(-active // PER_BUCKET)))


def _count_words(buckets: int):
    """Word rows answered with each word's count in teaching texts and its number (0 is the end sign); and the task's totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held: list[tuple] = []
        counts: Counter = Counter()
        for key, block, bucket, data in rows(batches, "key", "block", "bucket", "data"):
            if bucket < 0:
                yield key, block, bucket, data
            else:
                held.append((key, block, bucket, data))
                for w, n in zip(B.unpack_words(data), B.unpack(data)[2].tolist(), strict=True):
                    counts[w] += n
        if not held:
            return
        number = {w: 1 + held[0][2] + i * buckets for i, w in enumerate(sorted(counts))}
        stats = np.array([counts.total(), sum(n > 0 for n in counts.values()), max(counts.values())], np.int64)
        yield 0, TaskContext.get().partitionId(), STATS, stats.tobytes()
        for key, block, bucket, data in held:
            words = B.unpack_words(data)
            answer = B.pack(np.array([counts[w] for w in words], np.uint64), np.array([number[w] for w in words], np.uint64))
            yield key, block, bucket, answer
        B.trim()

    return _gathered(run)


class Open:
    """A block between rounds: its documents, and the positions whose contexts may still grow.

    ``live`` documents have such positions; ``stream`` is their words' local numbers, an end sign after each document. ``gid``
    and ``root`` are the words' numbers and their ``q`` by the word model. Of an active position: ``q``, the thousandths of ln P by the longest kept context so far, and how many lengths have failed.
    ``few`` marks positions whose word has followed its context less than twice.
    """

    FIELDS = ("ids", "null", "n_words", "known", "log_counts", "done", "marks", "gid", "root", "splits", "live", "stream", "active", "q", "fails", "few")

    def __init__(self, data: bytes | None = None, **arrays):
        got = arrays or dict(zip(self.FIELDS, B.unpack(data), strict=True))
        for k in self.FIELDS:
            setattr(self, k, got[k])
        self.answers: list[bytes] = []

    def pack(self) -> bytes:
        return B.pack(*(getattr(self, k) for k in self.FIELDS))

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each position of the stream: its live document's number, and the position where that document begins."""
        size = self.n_words[self.live].astype(np.int64) + 1
        doc = np.repeat(np.arange(len(size)), size)
        return doc, np.repeat(np.cumsum(size) - size, size)

    def begun(self) -> Open:
        """Before the first round all positions are active: what is plain from the stream isn't stored."""
        if len(self.live) and not len(self.active):
            self.active = np.arange(len(self.stream), dtype=np.uint32)
            self.q, self.fails, self.few = self.root[self.stream], np.zeros(len(self.stream), np.uint8), np.packbits(np.zeros(len(self.stream), bool))
        return self

    def pairs(self, depth: int, kinds: tuple[bool, ...] = (False, True)) -> Iterator[tuple]:
        """For unsplit contexts, then for split ones (or one of the ``kinds``): the active positions, and their distinct pairs sorted by context."""
        s = np.r_[len(self.gid) - 1, self.stream.astype(np.int64)]
        last = self.splits[s[self.active]]
        for split in kinds:
            at = np.flatnonzero((last > 1) == split)
            a = self.active[at].astype(np.int64)
            with np.errstate(over="ignore"):
                if depth == 1 and not split:  # contexts are words: their keys are sorted, not those of all positions
                    ctx, _, number = distinct(mix(self.gid + U64(1)))
                    number = number[s[a]]
                    used = np.bincount(number, minlength=len(ctx)) > 0
                    ctx, number = ctx[used], (np.cumsum(used) - 1)[number]
                else:
                    key = np.zeros(len(a), U64)
                    for k in range(1, depth + 1):
                        key = mix(key * STEP + self.gid[s[a + 1 - k]] + U64(1))
                    whole = key
                    if split:
                        key = mix(key + (self.gid[s[a + 1]] % last[at].astype(U64) + U64(1)) * STEP)
                    ctx, one, number = distinct(key)
            pair, at_pair, back = distinct(number.astype(U64) << U64(32) | s[a + 1].astype(U64))
            yield at, ctx, whole[one] if split else np.zeros(len(ctx), U64), (pair >> U64(32)).astype(np.int64), self.gid[(pair & U64(0xFFFFFFFF)).astype(np.int64)], at[at_pair], back

    def rows(self, depth: int, buckets: int, block: int, kinds: tuple[bool, ...] = (False, True)) -> Iterator[tuple]:
        """The block's questions about the active positions' contexts of ``depth`` words, by bucket."""
        teaches = self.marks[self.live][self.bounds()[0][self.active.astype(np.int64)]]
        for split, (at, ctx, whole, of, nxt, one, back) in zip(kinds, self.pairs(depth, kinds), strict=True):
            if not len(at):
                continue
            n = np.bincount(back, teaches[at], len(of)).astype(np.uint32)
            to = bucket_of_context(ctx, buckets)
            size = np.bincount(of, minlength=len(ctx))
            cut = np.r_[0, np.flatnonzero(np.diff(to)) + 1, len(ctx)]
            ends = np.r_[0, np.cumsum(size)]
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                p = slice(ends[a], ends[b])
                bucket = int(to[a])
                yield bucket, block, bucket + split * buckets, B.pack(ctx[a:b], whole[a:b], size[a:b].astype(np.uint32), nxt[p], n[p], self.q[one[p]])
        B.trim()

    def step(self, depth: int, patience: int) -> Open:
        """The answers about contexts of ``depth`` words taken in: what is settled is added up, the rest stays active."""
        if not len(self.live):
            return self
        parts = [B.unpack(a) for a in self.answers]
        p, flags = (np.concatenate([x[i] for x in parts]) if parts else np.zeros(0, k) for i, k in ((0, np.int16), (1, np.uint8)))
        q, fails, few, grows, start = self.q.copy(), self.fails.copy(), np.unpackbits(self.few, count=len(self.stream)).astype(bool), np.zeros(len(self.active), bool), 0
        for at, _, _, of, _, _, back in self.pairs(depth):
            f = flags[start : start + len(of)][back]
            q[at] = p[start : start + len(of)][back]
            fails[at] = np.where(f & KEPT, 0, fails[at] + 1)
            few[self.active[at].astype(np.int64)] |= (f & FEW) > 0
            grows[at] = (f & GROWS) > 0
            start += len(of)
        doc, begin = self.bounds()
        a = self.active.astype(np.int64)
        stay = grows & (fails < patience) & (a - begin[a] >= depth)
        stay &= ~np.where(a > begin[a], few[a - 1], False)  # the longer context itself has occurred once at most
        done = self.done.copy()
        done[self.live] += np.bincount(doc[a[~stay]], q[~stay].astype(np.int64), len(self.live))
        has = np.zeros(len(self.live), bool)
        has[doc[a[stay]]] = True
        kept = has[doc]
        place = np.cumsum(kept) - 1
        new = dict(zip(self.FIELDS, (getattr(self, k) for k in self.FIELDS), strict=True))
        new |= {"done": done, "live": self.live[has], "stream": self.stream[kept], "active": place[a[stay]].astype(np.uint32), "q": q[stay], "fails": fails[stay], "few": np.packbits(few[kept])}
        if not has.any():
            new |= {"gid": self.gid[:0], "root": self.root[:0], "splits": self.splits[:0]}
        return Open(**new)


def bucket_of_context(ctx: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the (mixed) context hashes, so that sorted contexts are in order of bucket."""
    return ((ctx >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)


def summed(ctx: np.ndarray, nxt: np.ndarray, n: np.ndarray, q: np.ndarray) -> tuple:
    """Pairs of many blocks put together: each row's pair; by pair n, q and its context's number; and the contexts."""
    with np.errstate(over="ignore"):
        _, at, pair = distinct(mix(ctx * STEP + mix(nxt + U64(1))))
    found, _, of = distinct(ctx[at])
    return pair, np.bincount(pair, n, len(at)).astype(np.int64), np.exp(q[at] / SCALE), of, found


def gains(n: np.ndarray, q: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """n ln(P / q) of each pair, P smoothed from all occurrences but the one judged; 0 where there is no other."""
    kinds = kinds - (n == 1)
    under = np.maximum(total - 1 + kinds, 1)
    over = np.maximum(n - 1, 0) + kinds * q
    return np.where((n > 0) & (over > 0), n * (np.log(np.maximum(over, 1e-300) / under) - np.log(q)), 0.0)


def answered(data: list[bytes], totals: dict[int, tuple[int, int, float, bool]], least_gain: float) -> list[bytes]:
    """For each block's pairs of a bucket: thousandths of ln P by the longest kept context, and the context's flags."""
    parts = [B.unpack(d) for d in data]
    each = [np.repeat(p[0], p[2]) for p in parts]
    back, n, q, of, ctx = summed(np.concatenate(each), np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts]).astype(np.int64), np.concatenate([p[5] for p in parts]).astype(np.float64))
    total, kinds = np.bincount(of, n).astype(np.int64), np.bincount(of, n > 0).astype(np.int64)
    gain = np.bincount(of, gains(n, q, total[of], kinds[of]))
    again = np.bincount(of, n >= 2) > 0  # of a longer context some next symbol has to occur twice, and so it has here
    if totals:  # split contexts: their own sums are a part only
        for i, c in enumerate(ctx.tolist()):
            total[i], kinds[i], gain[i], again[i] = totals[c]
    kept = (total >= 2) & (gain > least_gain)
    p = np.where(kept[of], (n + kinds[of] * q) / np.maximum(total + kinds, 1)[of], q)
    flags = kept[of] * KEPT + (n < 2) * FEW + (again & (kinds >= 2))[of] * GROWS
    whole_p, whole_f = np.maximum(np.rint(np.log(p) * SCALE), -32768).astype(np.int16)[back], flags.astype(np.uint8)[back]
    out, at = [], 0
    for e in each:
        out.append(B.pack(whole_p[at : at + len(e)], whole_f[at : at + len(e)]))
        at += len(e)
    return out


def _parts(data: list[bytes]) -> tuple:
    """Parts of split contexts, of a bucket: by pair n, q and its part's number; the parts, and the context of each."""
    parts = [B.unpack(d) for d in data]
    whole = dict(zip(np.concatenate([p[0] for p in parts]).tolist(), np.concatenate([p[1] for p in parts]).view(np.int64).tolist(), strict=True))
    _, n, q, of, ctx = summed(np.concatenate([np.repeat(p[0], p[2]) for p in parts]), np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts]).astype(np.int64), np.concatenate([p[5] for p in parts]).astype(np.float64))
    return n, q, of, ctx, pa.array([whole[c] for c in ctx.tolist()], pa.int64())


def _told(parts: DataFrame, *columns: str) -> DataFrame:
    """Rows for the buckets of ``parts`` (part, bucket), with the named sums of each part's context."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            part, *cols = (batch.column(c).to_numpy() for c in ("part", *columns))
            for b in np.unique(bucket).tolist():
                here = bucket == b
                yield b, 0, TOTALS, B.pack(part[here].view(np.uint64), *(c[here] for c in cols))

    return parts.select("part", "bucket", *columns).mapInArrow(_gathered(tell), B.DDL)


def _held(batches: Iterator[pa.RecordBatch]) -> tuple[dict[int, list], dict[int, tuple]]:
    """A task's questions by bucket, and what it is told of split contexts by part."""
    held: dict[int, list] = {}
    totals: dict[int, tuple] = {}
    for key, block, bucket, data in rows(batches, "key", "block", "bucket", "data"):
        if bucket == TOTALS:
            part, *cols = (a.tolist() for a in B.unpack(data))
            totals.update(zip(part, zip(*cols, strict=True), strict=True))
        else:
            held.setdefault(bucket, []).append((key, block, data))
    return held, totals


def _split_sums(hot: DataFrame, buckets: int) -> tuple[DataFrame, list[DataFrame]]:
    """What the parts of split contexts have to know, as rows for their buckets: n, kinds and gain of the whole context, and whether a next symbol occurs twice; and the working tables."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, _ = _held(batches)
        for bucket in sorted(held):
            n, _, of, ctx, whole = _parts([d for *_, d in held.pop(bucket)])
            cols = [whole, pa.array(ctx.view(np.int64)), pa.array(np.bincount(of, n).astype(np.int64)), pa.array(np.bincount(of, n > 0).astype(np.int64)), pa.array(bucket_of_context(ctx, buckets).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(cols, names=["whole", "part", "n", "k", "bucket"])

    def gain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, totals = _held(batches)
        for bucket in sorted(held):
            n, q, of, ctx, whole = _parts([d for *_, d in held.pop(bucket)])
            total, kinds = (np.array(x, np.int64) for x in zip(*(totals[c] for c in ctx.tolist()), strict=True))
            cols = [whole, pa.array(np.bincount(of, gains(n, q, total[of], kinds[of]))), pa.array((np.bincount(of, n >= 2) > 0).astype(np.int8))]
            yield pa.RecordBatch.from_arrays(cols, names=["whole", "gain", "again"])

    parts = written(B.by_bucket(hot).mapInArrow(count, "whole long, part long, n long, k long, bucket int"), "splits")
    sums = parts.groupBy("whole").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    parts_of = parts.select("whole", "part", "bucket").join(sums, "whole")
    gained = written(B.by_bucket(hot.unionByName(_told(parts_of, "n", "k"))).mapInArrow(gain, "whole long, gain double, again byte"), "gains")
    whole = gained.groupBy("whole").agg(F.sum("gain").alias("gain"), F.max("again").alias("again"))
    return _told(parts_of.join(whole, "whole"), "n", "k", "gain", "again"), [parts, gained]


def _asked(now: DataFrame, depth: int, buckets: int, least_gain: float, split: bool) -> DataFrame:
    """The answers about the contexts of ``depth`` words of all blocks that have active positions, written; those about split contexts wait for the contexts' sums."""

    def asks(*kinds: bool) -> DataFrame:
        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for block, data in rows(batches, "block", "data"):
                yield from Open(data).begun().rows(depth, buckets, block, kinds)

        return now.where("key > 0").select("block", "data").mapInArrow(_gathered(ask), B.DDL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        held, totals = _held(batches)
        for bucket in sorted(held):
            group = held.pop(bucket)
            for (key, block, _), data in zip(group, answered([d for *_, d in group], totals if bucket >= buckets else {}, least_gain), strict=True):
                yield key, block, bucket, data
        B.trim()

    every, tables = asks(False, True), []
    if split:
        told, tables = _split_sums(asks(True), buckets)
        every = every.unionByName(told)
    answers = written(B.by_bucket(every).mapInArrow(_gathered(run), B.DDL), "answers")  # (so that what was shuffled for them goes)
    for t in tables:
        drop(t)
    return answers


def _stepped(now: DataFrame, answers: DataFrame, depth: int, patience: int) -> DataFrame:
    """Blocks after the contexts of ``depth`` words."""

    def step(frame: Open) -> Iterator[pa.RecordBatch]:
        after = frame.begun().step(depth, patience)
        yield _row(len(after.active), frame.block, -1, after.pack())

    return B.out_of_blocks(now.unionByName(answers), step, B.DDL, Open)


def score_texts(docs: DataFrame, folds: int = 5, left_out: int = 1, id_col: str = "doc_id", text_col: str = "text", patience: int = 2, least_gain: float = 2.0, hot: int = HOT) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of each whole text.

    Learns from documents whose crc32 fold is not ``left_out``. ``base_score`` is the word model: sum over tokens of
    log10((c + 0.5) / (N + 0.5 (V + 1))), the end being one token a text. ``score`` is log10 of the tree's probability of the
    same tokens; a word that no text has taught has the word model's chance of one. Logarithms are rounded to thousandths.

    Null text counts as empty: the end alone. Null ids teach nothing. Rows that repeat an id each count and each give a row.
    An empty table gives an empty result. Each round's blocks are written to the shared folder, and those of the round before
    deleted.
    """
    spark = docs.sparkSession
    docs = docs_of(docs, id_col, text_col)
    n_texts = docs.where(~fold("doc_id", folds).isin(left_out, -1)).count()
    buckets = min(4096, partitions(docs))
    made = B.to_blocks(docs, B.numbered_words, extra=lambda doc_id, _: int(learns(doc_id, folds, left_out)), most_chars=BLOCK_CHARS, buckets=buckets)
    counted = written(B.by_bucket(made).mapInArrow(_count_words(buckets), B.DDL), "words")
    stats = np.array([np.frombuffer(r["data"], np.int64) for r in counted.where(F.col("bucket") == STATS).select("data").collect()]).reshape(-1, 3)
    train_tokens, distinct = int(stats[:, 0].sum()) + n_texts, int(stats[:, 1].sum()) + (n_texts > 0)
    split = bool(len(stats)) and max(n_texts, int(stats[:, 2].max())) > hot
    per_token = math.log(max(train_tokens + 0.5 * (distinct + 1), 0.5))

    def begin(frame: B.Frame) -> Iterator[pa.RecordBatch]:
        parts = [B.unpack(a) for a in frame.answers]
        count, gid = (_placed(frame.order, [p[i] for p in parts], np.uint64) for i in (0, 1))
        sizes = frame.sizes.astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        size = sizes + 1
        stream = np.full(int(size.sum()), len(gid), np.uint32)
        stream[np.arange(len(doc)) + doc] = frame.numbers
        per_doc = lambda x: np.bincount(doc, x, len(sizes))
        root = np.rint((np.log(np.r_[count.astype(np.float64), n_texts] + 0.5) - per_token) * SCALE).clip(-32768, 0).astype(np.int16)
        none = np.zeros(0, np.uint8)
        made = Open(
            ids=np.array([i or 0 for i in frame.ids], np.int64), null=np.array([i is None for i in frame.ids], np.uint8), n_words=frame.sizes, known=per_doc(count[frame.numbers] > 0).astype(np.uint32),
            log_counts=per_doc(np.log10(count.astype(np.float64) + 0.5)[frame.numbers]), done=np.zeros(len(sizes)), marks=frame.marks, gid=np.r_[gid, U64(0)], root=root,
            splits=np.minimum(1 + np.r_[count, U64(n_texts)] // U64(hot), 60_000).astype(np.uint16), live=np.arange(len(sizes), dtype=np.uint32), stream=stream,
            active=none.astype(np.uint32), q=none.astype(np.int16), fails=none, few=none,
        )
        yield _row(len(stream), frame.block, -1, made.pack())

    now = written(B.out_of_blocks(counted.where(F.col("bucket") != STATS), begin, B.DDL), "contexts")
    drop(counted)
    del made, counted
    depth = 0
    while active := now.agg(F.sum("key").alias("n")).first()["n"]:  # a frame's key counts its active positions
        depth += 1
        answers = _asked(now, depth, round_buckets(active, buckets), least_gain, split)
        after = written(_stepped(now, answers, depth, patience), "contexts")
        drop(now)
        drop(answers)
        now = after

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (data,) in rows(batches, "data"):
            f = Open(data)
            cols = [pa.array(f.ids, pa.int64(), mask=f.null.astype(bool)), f.n_words.astype(np.int64), f.known.astype(np.int64), f.log_counts, f.done / SCALE / math.log(10)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=OUT)

    scored = now.select("data").mapInArrow(finish, OUT_DDL)
    base = F.col("log_counts") + math.log10(n_texts + 0.5) - F.col("n_tokens") * (per_token / math.log(10))
    return scored.select("doc_id", (F.col("n_words") + 1).alias("n_tokens"), (F.col("known_words") + int(n_texts > 0)).alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"), "log_counts", "score").select("doc_id", "n_tokens", "n_known", "train_tokens", base.alias("base_score"), "score")


def _placed(order: np.ndarray, parts: list[np.ndarray], kind) -> np.ndarray:
    out = np.zeros(len(order), kind)
    if parts:
        out[order] = np.concatenate(parts)
    return out


def op7_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the word model's and the suffix tree's log10 probability of its text."""
    scored = score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
