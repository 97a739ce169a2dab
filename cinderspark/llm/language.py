"""Language identification by error-correcting output codes over hashed byte n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.llm.common import docs_of, fold, rows

#: Hash bins of the byte n-grams.
BINS = 4096
UNKNOWN = "und"
LETTER = regex.compile(r"[A-Za-z]|\p{L}")
OUT = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_()), ("codeword", pa.string()), ("distance", pa.float64()), ("near", pa.bool_())])


def features(texts: list[str]) -> np.ndarray:
    """One row a text: square roots of its hashed byte 2- and 3-gram counts, at length 1. Case of A-Z is ignored."""
    data = [b" " + t.encode().lower() + b" " for t in texts]
    owner = np.repeat(np.arange(len(data), dtype=np.int64), [len(d) for d in data])
    b = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    pair = b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA77)
    three = pair[:-1] + b[2:] * np.uint32(0xC2B2AE3D)
    counts = np.zeros(len(data) * BINS)
    for grams, n in ((pair ^ np.uint32(0x27D4EB2F), 2), (three, 3)):
        own = owner[: len(grams)]
        inside = own == owner[n - 1 :]
        grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        counts += np.bincount((own * BINS + (grams >> np.uint32(20)))[inside], minlength=len(counts))
    x = np.sqrt(counts).reshape(len(data), BINS).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def chunks(batches: Iterator[pa.RecordBatch], *names: str, most: int = 400_000, many: int = 64) -> Iterator[list[tuple]]:
    """Rows (the last named column is the text) in groups of bounded size; a longer text comes alone."""
    held, size = [], 0
    for row in rows(batches, *names):
        held.append(row)
        size += len(row[-1] or "")
        if size >= most or len(held) >= many:
            yield held
            held, size = [], 0
    if held:
        yield held


def codewords(k: int) -> np.ndarray:
    """``k`` rows of +1 and -1: the exhaustive code up to 7 classes, else seeded random columns, the best of 20 draws by least distance."""
    if k == 1:
        return np.ones((1, 1), np.int8)
    if k <= 7:
        columns = [(1, *rest) for rest in product((1, -1), repeat=k - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    rng, n, best, far = np.random.default_rng(10), int(np.ceil(10 * np.log2(k))), None, -1
    for _ in range(20):
        code = rng.choice(np.array([1, -1], np.int8), (k, n))
        apart = min(int((code[i + 1 :] != code[i]).sum(1).min()) for i in range(k - 1))
        if apart > far:
            best, far = code, apart
    return best


class LanguageModel:
    """Languages, their codewords, a weight vector and a reliability for each bit, and the distance that learnt texts keep to their codeword."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray, bias: np.ndarray, trust: np.ndarray):
        self.languages, self.code, self.weights, self.bias, self.trust = languages, code, weights, bias, trust
        self.reach = np.inf

    def losses(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Loss of each codeword for each row, and the bits' margins: logistic losses, weighted by the bits' reliability."""
        margin = x @ self.weights + self.bias
        against = np.logaddexp(0, -margin[:, None, :] * self.code[None, :, :].astype(np.float32))
        return (against * self.trust).sum(2), margin


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], rounds: int = 120) -> LanguageModel:
    """Logistic bit classifiers by accelerated gradient descent; a bit's reliability is its training accuracy's log-odds."""
    code = codewords(len(languages))
    want = code[y].astype(np.float32)
    share = 1 / np.maximum(np.bincount(y, minlength=len(languages)), 1)[y]
    share = (share / share.sum()).astype(np.float32)[:, None]
    w = np.zeros((x.shape[1], code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    v, vb, rate = np.zeros_like(w), np.zeros_like(bias), np.float32(60.0)
    for _ in range(rounds):
        wa, ba = w + 0.9 * v, bias + 0.9 * vb
        slope = -share * want / (1 + np.exp(np.clip(want * (x @ wa + ba), -30, 30)))
        v = 0.9 * v - rate * (x.T @ slope + 1e-5 * wa)
        vb = 0.9 * vb - np.float32(1.0) * slope.sum(0)
        w, bias = w + v, bias + vb
    right = ((x @ w + bias) * want > 0).mean(0)
    trust = np.log((right + 0.01) / (1.01 - right))
    model = LanguageModel(languages, code, w, bias, np.maximum(trust / max(trust.max(), 1e-6), 0.05).astype(np.float32))
    loss = np.concatenate([model.losses(x[i : i + 1024])[0] for i in range(0, len(x), 1024)])
    model.reach = float(loss.min(1)[loss.argmin(1) == y].max(initial=0.0))
    return model


def fit_languages(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_language: int = 1200, most_docs: int = 12_000) -> LanguageModel:
    """Learn from about ``per_language`` documents of each language (a bounded sample by a hash of the id, whole texts).

    Rows with null text, language or id teach nothing. The sample's features, made on the executors, come to the driver: 8
    KB a document, so of many languages each has fewer, ``most_docs`` altogether. The largest distance to the right codeword
    among them is the model's reach.
    """
    known = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("doc_id is not null and lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((0, 1), np.int8), np.zeros((BINS, 1), np.float32), np.zeros(1, np.float32), np.ones(1, np.float32))
    per_language = max(1, min(per_language, most_docs // len(languages)))
    part = F.create_map(*(F.lit(v) for k in languages for v in (k, min(1.0, per_language / counts[k]))))
    sample = known.where((F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6) < part[F.col("lang")])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in chunks(batches, "lang", "text"):
            x = features([t for _, t in held]).astype(np.float16)
            yield pa.RecordBatch.from_arrays([pa.array([lang for lang, _ in held]), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"])

    got = sample.mapInArrow(make, "lang string, x binary").toArrow()
    x = np.frombuffer(b"".join(got.column("x").to_pylist()), np.float16).reshape(-1, BINS).astype(np.float32)
    return fit(x, np.array([languages.index(v) for v in got.column("lang").to_pylist()]), languages)


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", margin: float = 0.5) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous, codeword, distance, near`` of each whole text, from the text alone.

    Each bit's classifier gives a margin; the codeword of least weighted loss wins. ``score`` is the winner's share of
    exp(-loss); ``ambiguous`` says that the runner-up is within ``margin`` of the winner's loss, or that the text has no
    letter; ``codeword`` shows the predicted bits; ``distance`` is the winner's loss, and ``near`` says that it is no larger
    than that of any learnt text. Null text, and text without a letter, is ``und`` with score 0, as is
    everything if nothing was learnt. Ties go to the first language in order of name. Each row gives a row. The model's
    size is fixed by the number of languages (16 KB a bit).
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for held in chunks(batches, "doc_id", "text"):
            spoken = [i for i, (_, t) in enumerate(held) if t and m.languages and LETTER.search(t)]
            lang, score, unsure, bits, far = [UNKNOWN] * len(held), [0.0] * len(held), [True] * len(held), [""] * len(held), [np.inf] * len(held)
            if spoken:
                loss, raw = m.losses(features([held[i][1] for i in spoken]))
                best = loss.argmin(1)
                weight = np.exp(-(loss - loss.min(1, keepdims=True)).astype(np.float64))
                ranked = np.sort(loss, axis=1)
                gap = ranked[:, 1] - ranked[:, 0] if loss.shape[1] > 1 else np.full(len(spoken), np.inf)
                for j, i in enumerate(spoken):
                    lang[i], score[i], unsure[i] = m.languages[best[j]], float(weight[j, best[j]] / weight[j].sum()), bool(gap[j] < margin)
                    bits[i] = "".join("1" if r > 0 else "0" for r in raw[j])
                    far[i] = float(loss[j, best[j]])
            near = [d <= m.reach and t != UNKNOWN for d, t in zip(far, lang, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in held], pa.int64()), pa.array(lang), pa.array(score), pa.array(unsure), pa.array(bits), pa.array(far), pa.array(near)], schema=OUT)

    return docs_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean, codeword string, distance double, near boolean")


def rejected(found: DataFrame):
    """Whether a text's language isn't told: it has no letter, or is farther from every codeword than any learnt text."""
    return (found["lang_pred"] == UNKNOWN) | ~found["near"]


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the predicted language, learnt outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit_languages(docs.where(fold("doc_id", 4) != 2))
    return predict_languages(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")
