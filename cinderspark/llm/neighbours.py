"""Approximate nearest neighbours: additive quantisation with full-dimensional codebooks, then exact reranking.

The index is kept in inverted lists, one for each word of the first codebook. A query is joined to its nearest lists, as many as
a bounded sample needs for the wanted recall, scored there by table lookup, and its best candidates are reranked exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cinderspark.sources.tables import written

FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


class Codebooks:
    """``m`` codebooks of ``k`` vectors in all dimensions; a vector is the sum of one word of each, chosen by beam search."""

    def __init__(self, words: np.ndarray):
        self.words = words  # (m, k, dim) float32
        self.flat = words.reshape(-1, words.shape[2])
        self.probes = words.shape[1]

    def lists(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` words of the first codebook that are nearest to each vector, nearest first."""
        far = (self.words[0] ** 2).sum(1) - 2 * x.astype(np.float32) @ self.words[0].T
        return np.argsort(far, axis=1, kind="stable")[:, :n].astype(np.int32)

    def tune(self, x: np.ndarray, recall: float, k: int = 5, most: int = 400) -> None:
        """How many lists to ask: so that ``recall`` of the sample's own nearest neighbours of ``most`` of its vectors are in them."""
        step = max(1, len(x) // most)
        own = np.arange(0, len(x), step)
        near = x[own] @ x.T
        near[np.arange(len(own)), own] = -np.inf
        best = np.argsort(-near, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
        home = self.lists(x, 1)[:, 0]
        order = self.lists(x[own], self.words.shape[1])
        place = np.argsort(order, axis=1)
        rank = np.sort(np.take_along_axis(place, home[best].astype(np.int64), 1).ravel())
        if len(rank):
            self.probes = int(rank[min(len(rank) - 1, int(recall * len(rank)))]) + 1

    def encode(self, x: np.ndarray, beam: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Codes (n, m) uint8 and the norms of what they stand for.

        Each of the ``beam`` best partial sums is extended by every word of the next codebook; the beam keeps the least errors.
        """
        m, k, dim = self.words.shape
        n = len(x)
        norms = (self.words**2).sum(2)
        rest = x[:, None, :].astype(np.float32)  # (n, beams, dim): what is still to be coded
        error = (rest**2).sum(2)
        codes = np.zeros((n, 1, 0), np.uint8)
        for i in range(m):
            cost = error[:, :, None] - 2 * (rest @ self.words[i].T) + norms[i]
            cost = cost.reshape(n, -1)
            keep = min(beam, cost.shape[1])
            best = np.argpartition(cost, keep - 1, axis=1)[:, :keep]
            error = np.take_along_axis(cost, best, 1)
            parent, word = best // k, best % k
            rest = np.take_along_axis(rest, parent[:, :, None], 1) - self.words[i][word]
            codes = np.concatenate([np.take_along_axis(codes, parent[:, :, None], 1), word[:, :, None].astype(np.uint8)], 2)
        best = error.argmin(1)
        rows = np.arange(n)
        return codes[rows, best], np.sqrt(np.maximum(((x - rest[rows, best]) ** 2).sum(1), 1e-12)).astype(np.float32)

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """Inner products of queries with every word: (q, m, k)."""
        return (queries.astype(np.float32) @ self.flat.T).reshape(len(queries), *self.words.shape[:2])


def fit_codebooks(x: np.ndarray, m: int = 8, k: int = 256, rounds: int = 12, seed: int = 3) -> Codebooks:
    """Residual codebooks by k-means, one after another; then all of them together by least squares on beam-search codes."""
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    rest, words = x.astype(np.float32).copy(), []
    for _ in range(m):
        c = rest[rng.choice(len(rest), k, replace=False)].copy()
        for _ in range(rounds):
            near = ((c**2).sum(1) - 2 * rest @ c.T).argmin(1)
            total = np.zeros_like(c)
            np.add.at(total, near, rest)
            n = np.bincount(near, minlength=k)
            c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], rest[rng.choice(len(rest), k)])
        near = ((c**2).sum(1) - 2 * rest @ c.T).argmin(1)
        words.append(c)
        rest -= c[near]
    books = Codebooks(np.stack(words).astype(np.float32))
    for _ in range(2):
        codes = np.concatenate([books.encode(x[i : i + 1024])[0] for i in range(0, len(x), 1024)])
        cols = codes.astype(np.int64) + np.arange(m) * k
        gram = np.zeros((m * k, m * k), np.float32)
        for i in range(m):
            for j in range(m):
                np.add.at(gram, (cols[:, i], cols[:, j]), 1)
        right = np.zeros((m * k, x.shape[1]), np.float32)
        for i in range(m):
            np.add.at(right, cols[:, i], x)
        gram[np.diag_indices(m * k)] += 0.1
        right += 0.1 * books.flat
        books = Codebooks(np.linalg.solve(gram, right).reshape(m, k, -1).astype(np.float32))
    return books


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v array<double>`` of the vectors that take part: not null, not zero, all components finite, of the usual length.

    The usual length is the most frequent one (ties: the longest).
    """
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    v = v.where(fine)
    usual = v.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return v.where(F.size("v") == (usual["n"] if usual else 0))


def build_index(vectors: DataFrame, sample_rows: int = 20_000, m: int = 8, recall: float = 0.985) -> tuple[DataFrame, Codebooks | None]:
    """The index of ``vec_id, v``: every row with its list, codes and stored norm, in the shared folder; and the codebooks.

    Codebooks are fitted on at most ``sample_rows`` unit vectors, the first by a hash of the id, and the number of lists to
    ask is chosen on them for the ``recall`` of lists; every row is indexed.
    """
    spark = vectors.sparkSession
    got = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow().column("v")
    if not len(got):
        return vectors.withColumns({"list": F.lit(0), "codes": F.lit(b""), "norm": F.lit(0.0).cast("float")}).limit(0), None
    x = np.array(got.combine_chunks().values.to_numpy()).reshape(len(got), -1)
    scale = np.abs(x).max(1, keepdims=True)
    x = x / scale
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    books = fit_codebooks(x, m)
    books.tune(x, recall)
    sent = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = unit(matrix(part.column("v")))
                codes, norm = sent.value.encode(x.astype(np.float32))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("v"), pa.array(sent.value.lists(x, 1)[:, 0]), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm, pa.float32())], names=["vec_id", "v", "list", "codes", "norm"])

    return written(vectors.mapInArrow(encode, "vec_id long, v array<double>, list int, codes binary, norm float"), "ann"), books


def matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that neither huge nor tiny components overflow."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def search(index: DataFrame, books: Codebooks | None, queries: DataFrame, k: int = 5, shortlist: int = 48, probes: int | None = None, rows_at_once: int = 8192, queries_at_once: int = 16_384) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest of each query (``vec_id, v``) but itself, nearest first, ties to the smaller id.

    Queries are joined to their ``probes`` nearest lists (by default as many as the index found to need; the number of words
    asks all). A list is cut into pieces of about ``rows_at_once`` rows and its queries into blocks, so that a list that holds
    a third of all vectors is many groups of bounded size. A group scores its codes by table lookup, over the stored norms, and
    reranks exactly, on the original vectors, the ``shortlist`` best of each query and all rows that tie with the last of
    them; its best ``k`` go on to one small aggregation. A query id that several rows have asks with the smallest vector. No
    usable vector: an empty result.
    """
    spark = index.sparkSession
    if books is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sent = spark.sparkContext.broadcast(books)
    probes = probes or books.probes
    cuts = {r["list"]: -(-r["n"] // rows_at_once) for r in index.groupBy("list").agg(F.count("*").alias("n")).collect()}  # a row a word
    pieces = F.coalesce(F.create_map(*(F.lit(v) for kv in cuts.items() for v in kv))[F.col("list")], F.lit(0)) if cuts else F.lit(0)
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asked.count() // queries_at_once))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                near = sent.value.lists(unit(matrix(part.column("v"))), probes)
                own = np.repeat(np.arange(part.num_rows), near.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(near.ravel(), pa.int32()), part.column("vec_id").take(pa.array(own)), part.column("v").take(pa.array(own))], names=["list", "vec_id", "v"])

    def group(rows: pa.Table, asked: pa.Table) -> pa.Table:
        books, out = sent.value, []
        if not rows.num_rows or not asked.num_rows:
            return FOUND.empty_table()
        vec, x = rows.column("vec_id").to_numpy(), matrix(rows.column("v").combine_chunks())
        ids, q = asked.column("vec_id").to_numpy(), matrix(asked.column("v").combine_chunks())
        codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(vec), -1)
        norm = rows.column("norm").to_numpy()
        length = np.sqrt((x * x).sum(1))
        for lo in range(0, len(ids), 64):
            own = ids[lo : lo + 64]
            table = books.tables(unit(q[lo : lo + 64]))
            near = sum(table[:, j][:, codes[:, j]] for j in range(codes.shape[1])) / norm
            near[own[:, None] == vec[None, :]] = -np.inf
            if len(vec) > shortlist:
                least = np.partition(near, len(vec) - shortlist, axis=1)[:, len(vec) - shortlist, None]
            else:
                least = np.full((len(own), 1), -np.inf)
            a, b = np.nonzero((near >= least) & (near > -np.inf))
            exact = np.concatenate([(q[lo + a[i : i + 100_000]] * x[b[i : i + 100_000]]).sum(1) / (np.sqrt((q[lo + a[i : i + 100_000]] ** 2).sum(1)) * length[b[i : i + 100_000]]) for i in range(0, len(a), 100_000)] or [np.zeros(0)])
            order = np.lexsort((vec[b], -exact, a))
            first = np.searchsorted(a[order], np.arange(len(own)))
            keep = order[np.arange(len(order)) - first[a[order]] < k]
            out.append(pa.Table.from_arrays([pa.array(own[a[keep]]), pa.array(vec[b[keep]]), pa.array(exact[keep])], schema=FOUND))
        return pa.concat_tables(out)

    piece = F.when(pieces > 1, F.pmod(F.xxhash64("vec_id", F.lit(3)), pieces)).otherwise(F.lit(0)).cast("int")
    left = index.withColumn("piece", piece).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.mapInArrow(deal, "list int, vec_id long, v array<double>").where(pieces > 0).withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(blocks)).cast("int"))
    key = ["list", "piece", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(group, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows of every row whose id is divisible by 50."""
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    index, books = build_index(vectors)
    return search(index, books, index.where("vec_id % 50 = 0").select("vec_id", "v"))
