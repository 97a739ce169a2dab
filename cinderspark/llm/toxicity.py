"""Toxic passages: maximal scoring segments over token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.llm.common import docs_of, fold, rows
from cinderspark.sources.tables import written

#: Bytes to tokens: A-Z lower-cased; ASCII other than letters, digits and the apostrophe is a gap.
GAPS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or b in b"'0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))
SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("evalue", pa.float64())])
OUT = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("n_tokens", pa.int32()), ("passages", pa.list_(SPAN))])
EULER = 0.5772156649015329


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(GAPS).split()


def forms_of(word: bytes) -> list[bytes]:
    """What is counted for a token: itself, and its first 4, 5 and 6 characters, which stand for inflected and compound words."""
    text = word.decode(errors="replace")
    return [word, *(b"%d^%s" % (n, text[:n].encode()) for n in (4, 5, 6) if len(text) > n)]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score) in linear time, by Ruzzo and Tompa's list of candidates.

    Only positive scores can begin a candidate, so the scan steps over them; what lies between is in the running sum.
    """
    total = np.cumsum(scores)
    found: list[list] = []  # start, end, sum before, sum at the end; link to the last candidate with a smaller sum before
    for i in np.flatnonzero(scores > 0).tolist():
        right = float(total[i])
        new = [i, i + 1, right - float(scores[i]), right, -1]
        while True:
            j = new[4] if new[4] >= 0 else len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new[0], new[2], new[4] = found[j][0], found[j][2], found[j][4]
            del found[j:]
            if new[4] < 0:
                found.append(new)
                break
    return [(a, b, hi - lo) for a, b, lo, hi, _ in found]


class Seen(dict):
    """Token to its score: the log-odds of its form that stands out most, either way, less the drift; remembered up to a bound."""

    def __init__(self, scores: dict[bytes, tuple[float, float]], drift: float):
        super().__init__()
        self.scores, self.drift = scores, drift

    def __missing__(self, word: bytes) -> float:
        if len(self) > 200_000:
            self.clear()
        found = [self.scores[f] for f in forms_of(word) if f in self.scores]
        s = self[word] = (max(found, key=lambda f: abs(f[0]))[1] if found else 0.0) - self.drift
        return s


def measures(normal: np.ndarray) -> np.ndarray:
    """Of the normal scores of a document's segments: 1, that of the best, and the surprise of the best r together, for the best r.

    Scores of segments of clean text are extreme values. The sum T of the r best of them is reached by chance with about
    exp(-T) T^(r-1) / (r! (r-1)!), so that passages which are weak one by one count together.
    """
    if not len(normal):
        return np.array([1.0, -5.0, -5.0])
    v = np.sort(normal)[::-1]
    r = np.arange(1, len(v) + 1)
    total = np.cumsum(v)
    lower = np.r_[0.0, np.cumsum(np.log(r))]  # ln of factorials
    fits = total > np.maximum(r - 1, 1e-9)
    surprise = np.where(fits, total - (r - 1) * np.log(np.maximum(total, 1e-9)) + lower[1:] + lower[:-1], -5.0)
    return np.array([1.0, np.clip(v[0], -5.0, 25.0), np.clip(surprise.max(), -5.0, 25.0)])


class ToxicityModel:
    """Log-odds of token forms with their z, the drift, the Gumbel parameters of clean text, and the calibration."""

    def __init__(self, scores: dict[bytes, tuple[float, float]], drift: float, lam: float, log_k: float):
        self.scores, self.lam, self.log_k = scores, lam, log_k
        self.weights = np.array([-3.0, 1.0, 1.0])
        self.seen = Seen(scores, drift)

    def segments(self, tokens: list[bytes]) -> tuple[list[tuple[int, int, float]], np.ndarray]:
        """All maximal segments, and their normal scores before K: lambda S - ln n."""
        if not tokens:
            return [], np.zeros(0)
        found = maximal_segments(np.fromiter(map(self.seen.__getitem__, tokens), np.float64, len(tokens)))
        return found, self.lam * np.array([v for *_, v in found]) - np.log(len(tokens))

    def passages(self, tokens: list[bytes], most_e: float = 0.05) -> tuple[np.ndarray, list[tuple]]:
        """A document's measures and its significant segments with their E-values."""
        found, normal = self.segments(tokens)
        normal = normal - self.log_k
        significant = [(a, b, v, float(np.exp(-x))) for (a, b, v), x in zip(found, normal.tolist(), strict=True) if x > -np.log(most_e)]
        return measures(normal), significant

    def probability(self, measures: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(measures @ self.weights, -35, 35)))


def log_odds(t, c, n_t: float, n_c: float, prior: float, least_z: float):
    """Columns of a form's z and log-odds, from its toxic and clean counts and all tokens' on each side.

    The log-odds have an informative Dirichlet prior, whose mass follows the form's share of all text; they are cut at 8 either
    way. z is the signed root of the likelihood ratio. Where it doesn't reach ``least_z`` either way, the log-odds are 0.
    """
    t, c = t.cast("double"), c.cast("double")
    alpha = prior * F.greatest(t + c, F.lit(0.5)) / (n_t + n_c)
    side = lambda n, total: F.log((n + alpha) / F.greatest(total + prior - n - alpha, F.lit(1.0)))
    odds = side(t, n_t) - side(c, n_c)
    expected = (t + c) * n_t / (n_t + n_c)
    part = lambda n, e: F.when(n > 0, n * F.log(n / F.greatest(e, F.lit(1e-9)))).otherwise(0.0)
    z = F.signum(odds) * F.sqrt(F.greatest(2 * (part(t, expected) + part(c, t + c - expected)), F.lit(0.0)))
    return z, F.when(F.abs(z) >= least_z, F.greatest(F.lit(-8.0), F.least(odds, F.lit(8.0)))).otherwise(0.0)


def token_model(forms: list[bytes], z: np.ndarray, odds: np.ndarray, clean: np.ndarray, n_c: float, drift: float) -> ToxicityModel:
    """Scores, and the lambda that solves sum p exp(lambda s) = 1 over clean text (p: forms' shares of clean tokens)."""
    score = odds - drift
    share = clean / max(n_c, 1.0)
    rest = max(1.0 - share.sum(), 0.05)
    lo, hi = 1e-3, 1.0
    total = lambda x: (share * np.exp(np.minimum(x * score, 700))).sum() + rest * np.exp(-x * drift)
    if not ((share > 0) & (score > 0)).any():
        lo = hi = 1.0
    while lo < hi and total(hi) < 1 and hi < 8:
        hi *= 2
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if total(mid) < 1 else (lo, mid)
    return ToxicityModel({f: (float(a), float(b)) for f, a, b in zip(forms, z, odds, strict=True) if b}, drift, float((lo + hi) / 2), 0.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_labels: int = 24_000, prior: float = 500.0, least_z: float = 4.0, drift: float = 0.1) -> ToxicityModel:
    """Learn from a sample of about ``most_labels`` labelled rows (by a hash of the id; their whole texts).

    The sample's ids and labels (16 bytes each, so of a known size) are broadcast to the texts. A null label, id or text
    teaches nothing; an id with several labels counts as toxic if one of them says so. All forms of the sample are counted,
    and each scores its own log-odds, toxic or clean, where its evidence reaches ``least_z`` (:func:`log_odds`), less
    ``drift``, so that chance doesn't add up; only forms whose log-odds are not 0 need to be kept, and nothing else selects
    them. Counts of two halves give
    two models, each measured on the other half, for the calibration; the final scores are of both.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    n = known.count()
    part = known.where((F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6) < min(1.0, most_labels / max(n, 1)))
    sample = docs_of(docs, id_col, text_col).where("text is not null").join(F.broadcast(part), "doc_id").select("y", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(2)).alias("half"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, totals = Counter(), [0] * 4

        def take():
            keys = list(seen)
            cols = [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.int32()), pa.array(list(seen.values()), pa.int64())]
            seen.clear()
            return pa.RecordBatch.from_arrays(cols, names=["word", "side", "n"])

        for y, half, text in rows(batches, "y", "half", "text"):
            side = int(2 * half + y)
            tokens = set(tokens_of(text))  # a repeated token counts once a text
            totals[side] += len(tokens)
            seen.update((f, side) for f in {f for t in tokens for f in forms_of(t)})
            if len(seen) > 300_000:
                yield take()
        seen.update({(b"", i): n for i, n in enumerate(totals)})
        yield take()

    sides = [F.sum(F.when(F.col("side") == i, F.col("n")).otherwise(0)).alias(f"s{i}") for i in range(4)]
    counted = written(sample.mapInArrow(count, "word binary, side int, n long").groupBy("word").agg(*sides), "forms")
    row = counted.where("word = X''").first()
    sums = [float(row[f"s{i}"]) for i in range(4)] if row else [0.0] * 4
    whole = lambda n: max(n, 1.0)
    splits = [((F.col("s1"), F.col("s0")), (sums[1], sums[0])), ((F.col("s3"), F.col("s2")), (sums[3], sums[2])), ((F.col("s1") + F.col("s3"), F.col("s0") + F.col("s2")), (sums[1] + sums[3], sums[0] + sums[2]))]
    cols = []
    for i, ((t, c), (n_t, n_c)) in enumerate(splits):
        z, odds = log_odds(t, c, whole(n_t), whole(n_c), prior, least_z)
        cols += [z.alias(f"z{i}"), odds.alias(f"o{i}"), c.cast("double").alias(f"c{i}")]
    got = counted.where("word <> X''").select("word", *cols).where("o0 <> 0 or o1 <> 0 or o2 <> 0").orderBy("word").toArrow()
    words = got.column("word").to_pylist()
    models = []
    for i, (_, (_, n_c)) in enumerate(splits):
        z, odds, clean = (got.column(f"{k}{i}").to_numpy() for k in "zoc")
        models.append(token_model(words, z, odds, np.where(odds != 0, clean, 0.0), n_c, drift))
    model = models[2]
    sent = docs.sparkSession.sparkContext.broadcast(models[:2])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(float(y), sent.value[1 - half].segments(tokens_of(text))[1].tolist()) for y, half, text in rows(batches, "y", "half", "text")]
        yield pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], k) for i, k in enumerate((pa.float64(), pa.list_(pa.float64())))], names=["y", "normal"])

    seen = sample.mapInArrow(measure, "y double, normal array<double>").toArrow()
    if not len(seen):
        return model
    y, normal = seen.column("y").to_numpy(), [np.array(v) for v in seen.column("normal").to_pylist()]
    best = [v.max() for v, t in zip(normal, y, strict=True) if t == 0 and len(v)]
    # extreme values of clean documents: lambda S - ln(K n) is Gumbel, whose median is -ln ln 2
    model.log_k = float(np.clip(np.median(best) + np.log(np.log(2)), -6.0, 3.0)) if best else 0.0
    model.weights = _logistic(np.array([measures(v - model.log_k) for v in normal]), y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Ridge logistic regression by Newton steps, halved until they help; slopes are not negative, so a more toxic measure never lowers a score."""
    w = np.zeros(x.shape[1])
    loss = lambda w: np.logaddexp(0, -(2 * y - 1) * (x @ w)).sum() + ridge * (w @ w) / 2
    now = loss(w)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
        size = 1.0
        while size > 1e-4:
            new = w - size * step
            new[1:] = np.maximum(new[1:], 0)
            if loss(new) < now - 1e-9:
                break
            size /= 2
        else:
            break
        w, now = new, loss(new)
    return w


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_tokens, passages`` of each whole text.

    ``passages`` are the maximal segments (token positions, end exclusive) whose E-value, the number of such segments that
    clean text of this length has by chance, is at most 0.05; ``score`` is the calibrated chance of a toxic label. Null and
    empty texts have no tokens and the score of a text without a passage. Each row gives a row. The model holds the
    forms that stand out in a bounded sample, and is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        held: list[tuple] = []

        def take():
            p = m.probability(np.array([x[1] for x in held]))
            spans = [[{"start": a, "end": b, "score": v, "evalue": e} for a, b, v, e in x[3]] for x in held]
            out = pa.RecordBatch.from_arrays([pa.array([x[0] for x in held], pa.int64()), pa.array(p), pa.array([x[2] for x in held], pa.int32()), pa.array(spans, pa.list_(SPAN))], schema=OUT)
            held.clear()
            return out

        for doc_id, text in rows(batches, "doc_id", "text"):
            tokens = tokens_of(text)
            measures, spans = m.passages(tokens)
            held.append((doc_id, measures, len(tokens), spans))
            if len(held) >= 2000:
                yield take()
        if held:
            yield take()

    return docs_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double, n_tokens int, passages array<struct<start:int,end:int,score:double,evalue:double>>")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the chance that it is toxic, learnt from labels outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(fold("doc_id", 4) != 2))
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
