"""Jaccard self-join of shingle sets: universe partition, pigeonhole, one-deletion neighbourhoods, exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinderspark.llm.common import SALT, STEP, U64, Out, docs_of, fresh, mix, partitions, rows, word_hashes
from cinderspark.operators.graph import connected_components
from cinderspark.sources.tables import drop, written

SKETCH_BITS = 512
#: Texts and shingles of a block: two blocks of a component meet in a task, which counts the links between them.
BLOCK_TEXTS, BLOCK_SHINGLES = 512, 1_000_000
#: So many ids of documents to verify go to every task, so that only their texts are shuffled; beyond, all texts are.
SENT_IDS = 1_000_000
#: ``kind``: twice the signature's spare number (see :func:`_rarest`), and 1 if it is of a segment itself.
SIG = pa.schema([("sig", pa.int64()), ("doc", pa.int64()), ("kind", pa.int16())])
#: The low bits of a signature are the number of its band, so that a document's signatures are told apart by bands.
BAND_BITS, MOST_SPARE = 7, 16_000


def _sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    _, _, _, h, first = word_hashes(texts)
    first = first.tolist()
    with np.errstate(over="ignore"):
        runs = np.full(max(0, len(h) - width + 1), U64(width) * SALT)
        for i in range(width):
            runs = runs * STEP + h[i : i + len(runs)]
        runs = mix(runs)
        found = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= width:
                x = np.sort(runs[a : b - width + 1])
                found.append(x[np.r_[True, x[1:] != x[:-1]]])
            elif b > a:
                one = np.full(1, U64(b - a) * SALT)
                for v in h[a:b]:
                    one = one * STEP + v
                found.append(mix(one))
            else:
                found.append(np.zeros(0, U64))
    return found


def shingle_sets(texts: list[str | None], width: int, most: int = 1 << 17) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its word shingles; of fewer than ``width`` words, the whole sequence is one.

    Words are hashed by sums of powers over all bytes of many texts at once, ``most`` bytes at a time unless one text is longer.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append((text or "").encode())
        size += len(held[-1]) + 1
        if size >= most:
            yield from _sets(held, width)
            held, size = [], 0
    if held:
        yield from _sets(held, width)


def with_sets(batches: Iterator[pa.RecordBatch], width: int, *names: str) -> Iterator[tuple]:
    """Rows of the named columns, the last of which is a text and comes as its set."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            *cols, texts = (part.column(n).to_pylist() for n in names)
            yield from zip(*cols, shingle_sets(texts, width), strict=True)


def run_frequencies(named: DataFrame, width: int, most_docs: int = 4000) -> tuple[float, ...]:
    """How many other documents hold the same run of 1, 2, 3 and 4 elements that follow each other in hash order, as segments do.

    Measured on about ``most_docs`` documents (by a hash of the id, whole texts) and scaled to all.
    """
    n = named.count()
    share = min(1.0, most_docs / max(n, 1))
    sample = named.where((F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1_000_000)) / 1e6) < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (x,) in with_sets(fresh(batches), width, "text"):
            total = np.zeros(len(x), U64)
            for s in range(1, 5):
                with np.errstate(over="ignore"):
                    total = mix(total[: max(0, len(x) - s + 1)] * STEP + x[s - 1 :])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), s, np.int32)), pa.array(total.view(np.int64))], names=["s", "k"])

    runs = sample.select("text").mapInArrow(run, "s int, k long").groupBy("s", "k").agg(F.count("*").alias("c"))
    got = {r["s"]: r["others"] for r in runs.groupBy("s").agg((F.sum(F.col("c") * (F.col("c") - 1)) / F.sum("c")).alias("others")).collect()}
    found = [got.get(s, 0.0) / max(share, 1e-9) for s in range(1, 5)]
    return tuple(round(float(min(found[: i + 1])), 6) for i in range(4))


#: What a signature that is shared costs, in signatures: it is written, met with its pivot, and may lead to a verification.
SHARED = 20.0
#: What one costs that is shared and left out again, and the documents a signature is met with that cost as much as itself.
STORED, MET = 4.0, 20.0


def _within(mean: float, most: int) -> tuple[float, float]:
    """Of a Poisson number: the chance that it is ``most`` at most, and the mean of what it has beyond."""
    k = np.arange(most + 1)
    chance = np.exp(k * math.log(max(mean, 1e-12)) - mean - np.cumsum(np.log(np.maximum(k, 1))))
    return min(1.0, float(chance.sum())), max(0.0, mean - most + float(((most - k) * chance).sum()))


class Plan:
    """How sets of a size band are cut: ``m`` segments of the hash universe, the first ``a`` with one-deletion neighbourhoods.

    Two sets that link differ in at most ``most`` elements. An exact segment differs in 1 element at least where it does not
    match, a deletion segment in 2; so with m + a > most some segment matches. ``slack`` is what m + a has beyond that: as
    many matches may be lost to empty segments, which are left out, and to a document's most frequent signatures (see
    :func:`_rarest`). Of all (m, a) the cheapest is taken by :meth:`cost`.
    """

    def __init__(self, band: int, low: int, high: int, num: int, den: int, others: tuple[float, ...]):
        self.low, self.high = low, high
        self.most = high * (den - num) // num
        self.salt = U64((band * 0x9E3779B97F4A7C15 + 0x51ED270B) & 0xFFFFFFFFFFFFFFFF)
        if not self.most:  # such sets link only if they are equal
            return
        h = self.most
        lengths = sorted({int(round(x)) for x in np.geomspace(max(1, (h + 2) // 2), 2 * h + 12, 48)} | {h + 1 + t for t in (0, 2, 4, 6, 9, 13, 18, 25, 34, 45, 60)})
        options = ((m, a) for m in lengths for t in (0, 1, 2, 3, 5, 8, 13, 21, 34) if (a := max(0, h + 1 - m) + (t if m <= h else 0)) <= m)
        _, self.m, self.a = min((self.cost(m, a, others), m, a) for m, a in options)
        self.slack = self.m + self.a - h - 1
        cuts = [-(-i * (1 << 32) // self.m) << 32 for i in range(self.m)]
        self.cuts = np.array(cuts, U64)

    def cost(self, m: int, a: int, others: tuple[float, ...]) -> float:
        """Signatures of a set, those expected to be shared (from the sampled frequencies of runs) beyond what slack takes, each by the documents it is met with, and a charge for the chance that its empty segments have to be listed too."""
        slack, mean = m + a - self.most - 1, (self.low + self.high) / 2 / m
        s = np.arange(int(mean + 8 * math.sqrt(mean)) + 8)
        chance = np.exp(s * math.log(mean) - mean - np.cumsum(np.log(np.maximum(s, 1))))
        fall = min(1.0, others[3] / others[2]) if others[2] else 0.0
        met = np.array([others[k - 1] if k <= 4 else others[3] * fall ** (k - 4) for k in s.tolist()])
        met[0] = 0.0
        shared = np.minimum(1.0, met)
        less = np.r_[0.0, 0.0, s[2:] * shared[1:-1]]
        thin = self.low / m
        lost = (m - a) * math.exp(-thin) + 2 * a * math.exp(-thin) * (1 + thin)
        tail, _ = _within(lost, slack)
        exact = (m - a) * (chance * shared).sum()
        _, rest = _within(lost + exact, slack)
        heavy = (chance * met).sum() / max((chance * shared).sum(), 1e-12)
        every = m + a * mean + STORED * exact + SHARED * (rest * (1 + heavy / MET) + a * (chance * (shared + less)).sum())
        return every + 2000 * max(0.0, 1 - tail)


@lru_cache(4)
def plans(num: int, den: int, others: tuple[float, ...] = (0.0,) * 4, growth: float = 1.25) -> tuple[np.ndarray, list[Plan]]:
    """Size bands (their first sizes) and plans; each band is a fixed part wider than the one before."""
    edges = [1]
    while edges[-1] < 1 << 31:
        edges.append(max(edges[-1] + 1, int(edges[-1] * growth)))
    assert len(edges) <= 1 << BAND_BITS
    return np.array(edges[:-1]), [_plan(i, a, b - 1, num, den, others) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]


class _plan:
    """A plan that is made when it is first asked for: bands of very large sets are rarely needed."""

    def __init__(self, *of):
        self.of, self.made = of, None
        self.high = of[2]

    def get(self) -> Plan:
        if self.made is None:
            self.made = Plan(*self.of)
        return self.made


def signatures(x: np.ndarray, num: int, den: int, others: tuple[float, ...] = (0.0,) * 4) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set's segments, and of their one-deletion neighbourhoods, in its own band and in those of smaller partners."""
    return spared_signatures(x, num, den, others)[:2]


def spared_signatures(x: np.ndarray, num: int, den: int, others: tuple[float, ...] = (0.0,) * 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`signatures`, and for each of the first ones how many such signatures of its band may be left out: what empty
    segments leave of the band's slack, 0 where they are listed and for segments with neighbourhoods."""
    edges, all_plans = plans(num, den, others)
    band = int(np.searchsorted(edges, len(x), "right")) - 1
    own, less, spare = [], [], []
    mixed = mix(x ^ SALT)
    low = U64((1 << BAND_BITS) - 1)
    with np.errstate(over="ignore"):
        total = np.r_[U64(0), np.cumsum(mixed)]
        for b in range(band, -1, -1):
            if b < band and all_plans[b].high * den < len(x) * num:
                break
            plan = all_plans[b].get()
            if not plan.most:
                break
            named = lambda h, b=b: h & ~low | U64(b)
            start = np.searchsorted(x, plan.cuts)
            end = np.r_[start[1:], len(x)]
            size, sums = end - start, total[end] - total[start]
            key = plan.salt + np.arange(plan.m, dtype=U64) * STEP
            lost = int((size[plan.a :] == 0).sum()) + 2 * int((size[: plan.a] <= 1).sum())
            every = lost > plan.slack
            listed = slice(None) if every else size > 0
            own.append(named(mix(sums + key))[listed])
            spare.append(np.where(np.arange(plan.m) < plan.a, 0, max(0, min(plan.slack - lost, MOST_SPARE))).astype(np.int16)[listed])
            if plan.a:
                stop = int(end[plan.a - 1])
                seg = np.repeat(np.arange(plan.a), size[: plan.a])
                gone = named(mix(sums[seg] - mixed[:stop] + key[seg]))
                less.append(gone if every else gone[size[seg] > 1])
    join = lambda parts, kind=U64: np.concatenate(parts) if parts else np.zeros(0, kind)
    return join(own), join(less), join(spare, np.int16)


def sketch(x: np.ndarray) -> list[int]:
    """Parities of the elements by 512 hash bins: two sets differ in at least as many elements as their sketches in bits."""
    odd = np.bincount((x & U64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def fine_sketch(x: np.ndarray) -> bytes:
    """Parities of the elements by as many hash bins as there are elements: a power of two, 512 at least."""
    bins = max(SKETCH_BITS, 1 << (len(x) - 1).bit_length()) if len(x) else SKETCH_BITS
    return np.packbits((np.bincount((x & U64(bins - 1)).astype(np.int64), minlength=bins) & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """The least number of elements that two sets differ in, by their fine sketches; the wider one is folded to the other's bins."""
    x, y = (np.frombuffer(s, np.uint64) for s in (a, b))
    if len(x) < len(y):
        x, y = y, x
    return int(np.bitwise_count(np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0) ^ y).sum())


def jaccard_components(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links``: connected documents whose shingle sets have den * |x & y| >= num * |x | y|.

    1. Equal sets are one class, by a 128-bit fingerprint with map-side minimum; the smallest id stands for a class.
    2. A class's segments (see :class:`Plan`) give 64-bit signatures. They are range-partitioned with the document as second
       key, so that a signature that very many share is split; a task streams its range and passes on shared ones. Of these
       a document leaves out its most frequent ones, as many as its plan can spare (see :func:`_rarest`).
    3. Each document is verified exactly with its two best pivots (the smallest documents of its shared signatures). Before
       a pair's texts are read, parity sketches as wide as the sets tell whether it can link; they never reject a linked pair.
    4. While documents of one signature are in different components, each is verified with one of the signature's smallest
       component, in rounds, until a round finds no link or few pairs are left; a parity sketch goes before, which never
       rejects a linked pair.
    5. What is still apart is compared pair by pair, in blocks of a signature's documents. Pairs within a component need no
       verification.
    6. Links lie within components, so they are counted there, all pairs of a component's classes block by block.

    So no link is lost, and components of n near copies cost a few verifications a document. Only ``n_links`` looks at all
    pairs of a component, in memory; where it isn't selected, step 6 is not run. ``n_links``: distinct other texts (as
    shingle sets) that link to the row's text; copies of the text itself are not among them.

    Null, empty and blank texts have no shingles, no link and their own id. Rows with a null id have no component. Rows that
    repeat an id are one document with the links of all its texts. An empty table gives an empty result.
    """
    docs = docs_of(docs, id_col, text_col)
    named = docs.where("doc_id is not null and text is not null")
    size = "doc_id long, n long, fp binary, sk array<bigint>, fine binary"
    members = written(named.mapInArrow(_measure(width), size), "sets")
    classes = members.where("n > 0").groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sk").alias("sk"), F.first("fine").alias("fine"))
    classes = written(classes, "classes")
    every = written(_shared_signatures(named, width, num, den), "every")
    shared = written(_rarest(every), "shared")
    drop(every)

    pivots = shared.where("own").groupBy("sig").agg(F.min("doc").alias("pivot"))
    stars = shared.join(pivots, "sig").where("doc <> pivot").groupBy("doc", "pivot").agg(F.count("*").alias("n"))
    best = W.partitionBy("doc").orderBy(F.desc("n"), "pivot")
    first = written(stars.withColumn("k", F.row_number().over(best)).where("k <= 2").select(F.col("doc").alias("a"), F.col("pivot").alias("b")), "pairs")
    sketches = classes.select(F.col("rep").alias("doc"), "n", "fine")
    links = _links(first, sketches, named, width, num, den)

    same_id = members.where("n > 0").join(classes.select("fp", "rep"), "fp").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    found = written(connected_components(links.unionByName(same_id)), "components")
    tested = [first.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))]
    sizes = classes.select(F.col("rep").alias("doc"), "n", "sk")
    by_pivot = True
    while True:
        open_ = _open(shared, found, sizes)
        if open_.isEmpty():
            drop(open_)
            break
        by_pivot = by_pivot and not _few(open_)
        pairs = (_with_pivot(open_, num, den) if by_pivot else _in_blocks(open_, num, den)).distinct()
        for t in tested:
            pairs = pairs.join(t, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        drop(open_)
        more = _links(pairs, sketches, named, width, num, den)
        if not more.isEmpty():
            found = written(_merged(found, more), "components")
        elif by_pivot:
            by_pivot = False
            tested.append(pairs)
            continue
        if not by_pivot:
            break
        tested.append(pairs)

    of_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("fp", "rep", "n", F.coalesce("component", "rep").alias("component_id"))
    degree = _link_counts(of_class, named, width, num, den)
    of_class = of_class.drop("rep", "n").join(degree, "fp", "left")
    linked = members.join(of_class, "fp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    other = docs.where("doc_id is null or text is null").mapInArrow(_measure(width), size)
    return linked.unionByName(other.select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def _open(shared: DataFrame, found: DataFrame, sizes: DataFrame) -> DataFrame:
    """``sig, doc, own, component, n, sk`` of signatures whose documents are in different components."""
    label = shared.join(found.withColumnRenamed("node", "doc"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    split = label.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.max("own").alias("any_own"), F.count("*").alias("holders")).where("lo <> hi and any_own").select("sig", "holders")
    return written(label.join(split, "sig").join(sizes, "doc"), "open")


def _few(open_: DataFrame) -> bool:
    """All pairs of one signature in different components are two a row at most: rounds of pivots would save nothing."""
    sizes = open_.groupBy("sig", "component").agg(F.count("*").cast("double").alias("c")).groupBy("sig").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"))
    found = sizes.agg(F.sum("n").alias("rows"), F.sum((F.col("n") * F.col("n") - F.col("same")) / 2).alias("pairs")).first()
    return found["pairs"] <= 2 * found["rows"]


def _close(num: int, den: int):
    """Documents u and w may link, as far as their sizes and sketches tell."""
    apart = sum((F.bit_count(F.col("u.sk")[i].bitwiseXOR(F.col("w.sk")[i])) for i in range(1, SKETCH_BITS // 64)), F.bit_count(F.col("u.sk")[0].bitwiseXOR(F.col("w.sk")[0])))
    return (apart * (den + num) <= (F.col("u.n") + F.col("w.n")) * (den - num)) & (F.least("u.n", "w.n") * den >= F.greatest("u.n", "w.n") * num)


def _pair_of(u: str, w: str) -> list:
    return [F.greatest(f"{u}.doc", f"{w}.doc").alias("a"), F.least(f"{u}.doc", f"{w}.doc").alias("b")]


def _with_pivot(open_: DataFrame, num: int, den: int) -> DataFrame:
    """Each document with the smallest one of its signature's smallest component, where that is another component."""
    pivot = open_.where("own").groupBy("sig").agg(F.min_by(F.struct("component", "doc", "n", "sk"), F.struct("component", "doc")).alias("p")).select("sig", "p.*")
    return open_.alias("u").join(pivot.alias("w"), (F.col("u.sig") == F.col("w.sig")) & (F.col("u.component") != F.col("w.component")) & _close(num, den)).select(*_pair_of("u", "w"))


def _in_blocks(open_: DataFrame, num: int, den: int) -> DataFrame:
    """All pairs of one signature in different components; documents of a signature meet in blocks of about 512."""
    dealt = open_.withColumn("blocks", F.ceil(F.col("holders") / BLOCK_TEXTS)).withColumn("block", F.expr("pmod(xxhash64(doc), blocks)"))
    spread = dealt.withColumn("o", F.explode(F.expr("sequence(0L, blocks - 1)"))).withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    u, w = spread.alias("u"), spread.alias("w")
    meet = (F.col("u.sig") == F.col("w.sig")) & (F.col("u.i") == F.col("w.i")) & (F.col("u.j") == F.col("w.j")) & (F.col("u.component") < F.col("w.component")) & (F.col("u.own") | F.col("w.own"))
    home = (F.col("u.i") == F.col("u.j")) | (F.col("u.block") != F.col("w.block"))
    return u.join(w, meet & home & _close(num, den)).select(*_pair_of("u", "w"))


def _merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """Components with more links, which join some of them: the graph of those is small."""
    own = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_"))
    of = more.join(own("a"), "a", "left").join(own("b"), "b", "left")
    united = connected_components(of.select(F.coalesce("a_", "a").alias("a"), F.coalesce("b_", "b").alias("b")))
    united = united.withColumnRenamed("component", "united")
    inner = found.join(united.withColumnRenamed("node", "component"), "component", "left").select("node", F.coalesce("united", "component").alias("component"))
    return inner.unionByName(united.join(found, "node", "left_anti").select("node", F.col("united").alias("component")))


def _batch(held: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _measure(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("fp", pa.binary()), ("sk", pa.list_(pa.int64())), ("fine", pa.binary())])
        held = []
        for doc_id, x in with_sets(fresh(batches), width, "doc_id", "text"):
            held.append((doc_id, len(x), xxhash.xxh3_128_digest(x.tobytes()), sketch(x), fine_sketch(x)))
            if len(held) >= 2000:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return run


def _shared_signatures(named: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``sig, doc, own`` of the classes' signatures that two documents share (and of those at the ends of ranges)."""
    others = run_frequencies(named, width)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("fp", pa.binary()), ("doc", pa.int64()), ("own", pa.binary()), ("less", pa.binary()), ("spare", pa.binary())])
        held, size = [], 0
        for doc_id, x in with_sets(fresh(batches), width, "doc_id", "text"):
            if len(x):
                own, less, spare = spared_signatures(x, num, den, others)
                held.append((xxhash.xxh3_128_digest(x.tobytes()), doc_id, own.tobytes(), less.tobytes(), spare.tobytes()))
                size += 10 * len(own) + 8 * len(less) + 40
            if size > 4 << 20:
                yield _batch(held, schema)
                held, size = [], 0
        if held:
            yield _batch(held, schema)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fresh(batches):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                docs = part.column("doc").to_numpy()
                for name in ("own", "less"):
                    data = part.column(name).to_pylist()
                    sig = np.frombuffer(b"".join(data), np.int64)
                    if len(sig):
                        doc = np.repeat(docs, [len(d) // 8 for d in data])
                        kind = np.zeros(len(sig), np.int16)
                        if name == "own":
                            kind = 2 * np.frombuffer(b"".join(part.column("spare").to_pylist()), np.int16) + np.int16(1)
                        yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(doc), pa.array(kind)], schema=SIG)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one signature that two documents share; the run in hand may go on in the next batch."""
        rest, first = None, True
        for batch in fresh(batches):
            if not batch.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(rest, cols, strict=True)]
            sig = cols[0]
            starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
            size = np.diff(np.r_[starts, len(sig)])
            keep = np.repeat(size > 1, size)
            if first:  # the first run may have begun in the partition before
                keep[: size[0]] = True
            end = starts[-1]
            if end == 0 and len(sig) > 100_000:  # one run so far: all of it is shared; its last row stays in hand
                end, first = len(sig) - 1, True
            elif end > 0:
                first = False
            keep = keep[:end]
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[:end][keep]) for c in cols], schema=SIG)
            rest = [c[end:].copy() for c in cols]
        if rest is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rest], schema=SIG)

    made = named.mapInArrow(make, "fp binary, doc long, own binary, less binary, spare binary")
    least = made.groupBy("fp").agg(F.min("doc").alias("doc"), *(F.min_by(c, "doc").alias(c) for c in ("own", "less", "spare")))
    sigs = least.select("doc", "own", "less", "spare").mapInArrow(spread, "sig long, doc long, kind short")
    order = ["sig", "doc"]
    return sigs.repartitionByRange(partitions(sigs), *order).sortWithinPartitions(*order).mapInArrow(share, "sig long, doc long, kind short")


def _rarest(every: DataFrame) -> DataFrame:
    """``sig, doc, own`` without each document's most frequent signatures, as many as are spare in a band, and without those that no two documents share then.

    Documents that link share more of a band's signatures than either has spare. So the rarest that they share is among the
    spare ones of neither, since frequencies, and the order of equal ones, are the same for both: they still meet there. What
    two documents share by chance is mostly among the frequent ones.
    """
    holders = every.groupBy("sig").agg(F.count("*").alias("holders"), F.max(F.col("kind") % 2).alias("any_own")).where("holders > 1 and any_own = 1").select("sig", "holders")
    met = every.join(holders, "sig").select("sig", "doc", F.expr("kind % 2 = 1").alias("own"), F.expr("shiftright(cast(kind as int), 1)").alias("spare"), "holders")
    often = W.partitionBy("doc", F.col("sig").bitwiseAND(F.lit((1 << BAND_BITS) - 1)), F.col("spare") > 0).orderBy(F.desc("holders"), "sig")
    rare = met.withColumn("place", F.row_number().over(often)).where("place > spare").select("sig", "doc", "own")
    rare = written(rare, "rare")
    still = rare.groupBy("sig").agg(F.count("*").alias("n"), F.max("own").alias("any_own")).where("n > 1 and any_own").select("sig")
    return rare.join(still, "sig").select("sig", "doc", "own")


def _likely(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that may link, as far as sizes and fine sketches (doc, n, fine) tell; none that links is left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in fresh(batches):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                a, b, m, n, x, y = (part.column(c).to_pylist() for c in ("a", "b", "m", "n", "x", "y"))
                keep = [i for i in range(len(a)) if min(m[i], n[i]) * den >= max(m[i], n[i]) * num and apart(x[i], y[i]) * (den + num) <= (m[i] + n[i]) * (den - num)]
                yield pa.RecordBatch.from_arrays([pa.array([c[i] for i in keep], pa.int64()) for c in (a, b)], names=["a", "b"])

    of = lambda c, n, x: sketches.select(F.col("doc").alias(c), F.col("n").alias(n), F.col("fine").alias(x))
    return pairs.select("a", "b").join(of("a", "m", "x"), "a").join(of("b", "n", "y"), "b").mapInArrow(run, "a long, b long").distinct()


def _links(pairs: DataFrame, sketches: DataFrame, named: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that link: those that sketches don't tell apart, verified; only the texts of these are shuffled."""
    likely = written(_likely(pairs, sketches, num, den), "likely")
    ids = written(likely.select(F.col("a").alias("doc_id")).unionByName(likely.select(F.col("b").alias("doc_id"))).distinct(), "ids")
    asked = named.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= SENT_IDS else named
    found = written(_verified(likely, asked, width, num, den), "links")
    drop(likely)
    drop(ids)
    return found


def _verified(pairs: DataFrame, named: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` whose sets link, by exact intersection.

    Each text travels to its pairs. A document ``b`` of very many pairs is copied, once for every 512 of them, so that they
    are dealt to as many tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in fresh(batches):
            yes = []
            for a, b, t, x in with_sets(iter([batch]), width, "a", "b", "t", "s"):
                if last[0] != (b, t):
                    last = ((b, t), next(shingle_sets([t], width)))
                y = last[1]
                if min(len(x), len(y)) * den < max(len(x), len(y)) * num or not len(x):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both * den >= (len(x) + len(y) - both) * num:
                    yes.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in yes], pa.int64()) for i in (0, 1)], names=["a", "b"])

    many = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK_TEXTS).alias("copies"))
    dealt = pairs.join(many, "b").withColumn("copy", F.expr("pmod(xxhash64(a), copies)")).drop("copies")
    right = many.join(named.select(F.col("doc_id").alias("b"), F.col("text").alias("t")), "b").withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)"))).drop("copies")
    left = dealt.join(named.select(F.col("doc_id").alias("a"), F.col("text").alias("s")), "a")
    return left.join(right, ["b", "copy"]).select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def links_between(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of ``right`` each of ``left`` links to, and the other way round; without ``right``, the other sets of ``left``.

    Elements that the same sets hold are one column with a weight, so that near copies are compared in what tells them apart.
    """
    sets = left if right is None else left + right
    size = np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), size)
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(element, kind="stable")
    held = np.bincount(element)
    with np.errstate(over="ignore"):
        holders = np.add.reduceat(mix((owner.astype(U64) + U64(1)) * STEP)[order], np.cumsum(held) - held)
    _, first, column, weight = np.unique(holders, return_index=True, return_inverse=True, return_counts=True)
    stands = np.zeros(len(held), bool)
    stands[first] = True
    kept = stands[element]
    columns, ends = column[element[kept]], np.cumsum(np.bincount(owner[kept], minlength=len(sets)))
    starts = np.r_[0, ends[:-1]]
    at = 0 if right is None else len(left)
    others, bounds, sizes = columns[starts[at] :], starts[at:] - starts[at], size[at:]
    mark, n_left, n_right = np.zeros(len(weight), np.int64), np.zeros(len(left), np.int64), np.zeros(len(sets) - at, np.int64)
    for i in range(len(left)):
        mine = columns[starts[i] : ends[i]]
        mark[mine] = weight[mine]
        both = np.add.reduceat(mark[others], bounds)
        mark[mine] = 0
        linked = both * den >= (size[i] + sizes - both) * num
        if right is None:
            linked[i] = False
        n_left[i] = linked.sum()
        n_right += linked
    return n_left, n_right


def _link_counts(of_class: DataFrame, named: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``fp, n_links`` of the classes (fp, rep, n, component_id) in components of several: each pair of blocks is one group of rows.

    A component's classes are dealt to blocks by hash; a class goes once to each block of its component, so rows grow by the
    number of blocks, and a large component is spread over as many tasks as it has pairs of blocks.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(pa.schema([("fp", pa.binary()), ("x", pa.binary())]))
        for (s,) in with_sets(fresh(batches), width, "text"):
            x = s.tobytes()
            out.add((xxhash.xxh3_128_digest(x), x), len(x))
            if out.full():
                yield out.take()
        yield out.take()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, held = Out(pa.schema([("fp", pa.binary()), ("n_links", pa.int64())])), None, []

        def finish() -> None:
            u, v = ([(fp, x) for fp, block, x in held if block == b] for b in key[1:])
            if key[1] == key[2]:
                v = []
            if not u or key[1] != key[2] and not v:
                return
            counts = links_between([x for _, x in u], [x for _, x in v] or None, num, den)
            for side, n in zip((u, v), counts, strict=True):
                for (fp, _), k in zip(side, n.tolist(), strict=False):
                    out.add((fp, k))

        for component, i, j, fp, block, x in rows(batches, "component_id", "i", "j", "fp", "block", "x"):
            if key != (component, i, j):
                if held:
                    finish()
                    if out.full():
                        yield out.take()
                key, held = (component, i, j), []
            held.append((fp, block, np.frombuffer(x, U64)))
        if held:
            finish()
        yield out.take()

    several = of_class.where("n > 0").groupBy("component_id").agg(F.count("*").alias("texts"), F.sum("n").alias("all")).where("texts > 1")
    blocks = F.ceil(F.greatest(F.col("texts") / BLOCK_TEXTS, F.col("all") / BLOCK_SHINGLES))
    placed = of_class.join(several.withColumn("blocks", blocks), "component_id").select("fp", "rep", "component_id", "blocks", F.expr("pmod(xxhash64(fp), blocks)").alias("block"))
    texts = named.join(placed.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    placed = placed.drop("rep").join(texts.mapInArrow(sets, "fp binary, x binary").groupBy("fp").agg(F.first("x").alias("x")), "fp")
    pairs = placed.withColumn("o", F.explode(F.expr("sequence(0L, blocks - 1)"))).select("component_id", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "fp", "block", "x")
    key = ["component_id", "i", "j"]
    counted = pairs.repartition(partitions(pairs), *key).sortWithinPartitions(*key).mapInArrow(count, "fp binary, n_links long")
    return counted.groupBy("fp").agg(F.sum("n_links").alias("n_links"))


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its number of shingles, the smallest document that links lead to, and how many other texts link to its own."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b, k = x.n AND k = y.n AS same FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
r AS (SELECT a AS d, least(a, min(b)) AS rep FROM l WHERE same GROUP BY a),
k AS (SELECT a AS d, count(DISTINCT coalesce(rep, b)) AS k FROM l LEFT JOIN r ON r.d = b WHERE NOT same GROUP BY a),
c AS (SELECT doc_id AS d, doc_id AS m FROM documents UNION SELECT l.b, c.m FROM c JOIN l ON l.a = c.d WHERE c.m < l.b)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, t.m AS component_id, coalesce(k.k, 0) AS n_links
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(m) AS m FROM c GROUP BY d) t USING (doc_id) LEFT JOIN k ON k.d = w.doc_id
"""
