"""Secret scans: fixed rules, and a character convolutional network over every candidate in its context.

Candidates are the rules' matches and all runs of key characters. The network scores each of them, whole: windows of a long
candidate overlap by half, and the highest counts. It learns from the rules' findings, as they are and re-spelled in other
alphabets and places, so that it doesn't depend on the rules' own formats.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.llm.common import docs_of, fresh, rows
from cinderspark.sources.tables import drop, written

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Candidates: runs of characters that keys are written in, 8 or more with a digit, 16 or more without.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])(?:(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{8,}|[A-Za-z+/_=-]{16,})")
KINDS = ("assign", "access", "hex", "model")
#: Characters of a window: before it, of the candidate, and after it. Longer candidates have several windows.
BEFORE, OF, AFTER = 20, 36, 8
#: Alphabets that findings are re-spelled in.
ALPHABETS = ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-")
WIDE = BEFORE + OF + AFTER
CLASSES = 48
OUT = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the rules' matches, in order; matches that are too short are dropped after matching."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _class_table() -> np.ndarray:
    """Character classes by rule: letters by five, upper and lower apart, digits by two, and each frequent sign."""
    table = np.full(128, 1, np.uint8)
    for i, c in enumerate(" \n=:\"'._-/+,;()[]{}<>"):
        table[ord(c)] = 2 + i
    for i in range(26):
        table[97 + i], table[65 + i] = 24 + i // 3, 33 + i // 4
    for i in range(10):
        table[48 + i] = 40 + i // 2
    return table


TABLE = _class_table()


def windows(text: str, start: int, end: int) -> list[bytes]:
    """The classes of a candidate and its surroundings, a window for each 18 characters beyond the first 36; those of the candidate itself are moved up by ``CLASSES``."""
    made = []
    for at in range(start, max(start + 1, end - OF // 2), OF // 2) if end - start > OF else (start,):
        lo, hi = at - BEFORE, at + OF + AFTER
        body = text[max(0, lo) : hi].encode("ascii", "replace")
        if end - at <= OF:  # what follows a short candidate stands behind its full width
            body = text[max(0, lo) : end].encode("ascii", "replace").ljust(OF + at - max(0, lo), b"\0") + text[end : end + AFTER].encode("ascii", "replace")
        codes = np.frombuffer(body.rjust(len(body) + max(0, -lo), b"\0").ljust(WIDE, b"\0"), np.uint8)
        x = TABLE[codes].copy()
        x[codes == 0] = 0
        x[max(0, start - lo) : min(WIDE, end - lo) if end - at > OF else BEFORE + end - at] += CLASSES
        made.append(x.tobytes())
    return made


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, whether a rule's match overlaps it) of the rules' matches and all runs of key characters, each once."""
    found = {(s, e): True for s, _, e in base}
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))  # the farthest end of the matches so far
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        before = bisect_left(starts, b)
        found.setdefault((a, b), before > 0 and reach[before - 1] > a)
    return [(a, b, y) for (a, b), y in found.items()]


def respelled(text: str, base: list[tuple[int, int, int]], others: list[tuple[int, int]], seed: int, copies: int = 2) -> Iterator[tuple[str, int, int]]:
    """Findings in other alphabets: in their own place, and in place of a candidate that is no finding; (text around, start, end)."""
    rng = random.Random(seed)
    for a, k, b in base:
        if k == 0:
            a = ASSIGN.match(text, a).start(2)
        for i in range(copies):
            letters = rng.choice(ALPHABETS)
            key = "".join(rng.choices(letters, k=min(64, max(16, b - a + rng.randint(-8, 8)))))
            x, y = rng.choice(others) if i % 2 and others else (a, b)
            before, after = text[max(0, x - 2 * BEFORE) : x], text[y : y + 2 * AFTER]
            yield before + key + after, len(before), len(before) + len(key)


class SecretNet:
    """Embedding and convolution in one (a table for each tap), ReLU, maximum over positions, one dense layer."""

    TAPS, FILTERS = 5, 24
    WEIGHTS = ("conv", "bias", "dense", "shift")

    def __init__(self, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.conv = rng.normal(0, 0.3, (self.TAPS, 2 * CLASSES, self.FILTERS)).astype(np.float32)
        self.bias = np.zeros(self.FILTERS, np.float32)
        self.dense = rng.normal(0, 0.3, self.FILTERS).astype(np.float32)
        self.shift = np.zeros(1, np.float32)
        self.scale, self.offset, self.threshold = 1.0, 0.0, 1.1  # untrained: nothing is added
        self.learnt = self.judged = 0  # windows that the weights, and that the threshold come from

    def forward(self, x: np.ndarray):
        n = WIDE - self.TAPS + 1
        h = self.bias + sum(self.conv[k][x[:, k : k + n]] for k in range(self.TAPS))
        where = h.argmax(1)
        top = np.take_along_axis(h, where[:, None], 1)[:, 0]
        return np.maximum(top, 0) @ self.dense + self.shift[0], top, where

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.concatenate([self.forward(x[i : i + 512])[0] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.offset, -30, 30)))

    def slope(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Gradient of the weighted log loss of some windows, and that loss."""
        z, top, where = self.forward(x)
        d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * weight).astype(np.float32)
        up = d[:, None] * self.dense * (top > 0)
        slope = {"conv": np.zeros_like(self.conv), "bias": up.sum(0), "dense": np.maximum(top, 0).T @ d, "shift": np.array([d.sum()])}
        f = np.broadcast_to(np.arange(self.FILTERS), where.shape)
        for k in range(self.TAPS):
            np.add.at(slope["conv"][k], (np.take_along_axis(x, where + k, 1), f), up)
        return slope, float((weight * (np.logaddexp(0, z) - y * z)).sum())

    def adam(self):
        """A function that takes one step of Adam after another."""
        m, v = ({k: np.zeros_like(getattr(self, k)) for k in self.WEIGHTS} for _ in range(2))
        t = 0

        def step(slope: dict[str, np.ndarray], rate: float) -> None:
            nonlocal t
            t += 1
            for k in self.WEIGHTS:
                m[k] = 0.9 * m[k] + 0.1 * slope[k]
                v[k] = 0.999 * v[k] + 0.001 * slope[k] ** 2
                getattr(self, k)[...] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

        return step

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 256, rate: float = 0.01) -> None:
        """Adam on the log loss, classes balanced."""
        rng, step = np.random.default_rng(1), self.adam()
        sides = [np.flatnonzero(y == s) for s in (0, 1)]
        for _ in range(steps):
            pick = np.concatenate([rng.choice(s, batch // 2) for s in sides])
            step(self.slope(x[pick], y[pick], np.full(len(pick), 1 / len(pick)))[0], rate)

    def calibrate(self, z: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float) -> None:
        """Platt scaling on the outputs of held-back documents' windows (``n`` times each), then the highest threshold that ``recall`` of their findings pass."""
        w = np.zeros(2)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(w[0] * z + w[1], -30, 30)))
            a = np.stack([z, np.ones_like(z)], 1)
            w = w - np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + 1e-3 * np.eye(2), a.T @ (n * (p - y)) + 1e-3 * w)
        self.scale, self.offset = float(w[0]), float(w[1])
        found, times = z[y == 1], n[y == 1]
        p = 1 / (1 + np.exp(-np.clip(self.scale * found + self.offset, -30, 30)))
        order = np.argsort(p)
        upto = np.cumsum(times[order])
        self.threshold = float(p[order][np.searchsorted(upto, int((1 - recall) * upto[-1]), "right")])


#: Steps of the network's output that held-back windows are counted in.
FINE = 1024


def _arrays(batches: Iterator[pa.RecordBatch], most: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and labels of stored rows."""
    for batch in fresh(batches):
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield np.frombuffer(b"".join(part.column("x").to_pylist()), np.uint8).reshape(-1, WIDE).astype(np.int64), part.column("y").to_numpy().astype(np.float32)


def _whole_slope(table: DataFrame, net: SecretNet, weight: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Gradient and loss over all rows of ``table``, ``weight`` by label: a sum for each task, and sums of these in eight tasks."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for x, y in _arrays(batches):
            slope, loss = net.slope(x, y, weight[y.astype(int)])
            flat = np.concatenate([*(slope[k].ravel() for k in net.WEIGHTS), [loss]]).astype(np.float64)
            total = flat if total is None else total + flat
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "s"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for at, s in rows(batches, "part", "s"):
            total = (at, np.frombuffer(s)) if total is None else (total[0], total[1] + np.frombuffer(s))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total[0]], pa.int32()), pa.array([total[1].tobytes()], pa.binary())], names=["part", "s"])

    ddl = "part int, s binary"
    got = table.mapInArrow(part, ddl).repartition(8, "part").sortWithinPartitions("part").mapInArrow(added, ddl).collect()
    total = sum(np.frombuffer(r["s"]) for r in sorted(got, key=lambda r: r["part"]))
    slope, at = {}, 0
    for k in net.WEIGHTS:
        size = getattr(net, k).size
        slope[k] = total[at : at + size].reshape(getattr(net, k).shape).astype(np.float32)
        at += size
    return slope, float(total[-1])


def _outputs(table: DataFrame, net: SecretNet) -> list:
    """How many rows of ``table`` have each label and output, in steps of 1 / FINE."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, y in _arrays(batches):
            z = np.floor(np.clip(net.forward(x)[0], -30, 30) * FINE).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(y.astype(np.int32)), pa.array(z)], names=["y", "z"])

    return table.mapInArrow(run, "y int, z int").groupBy("y", "z").agg(F.count("*").alias("n")).orderBy("y", "z").collect()


def fit_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_docs: int = 12_000, most_candidates: int = 20_000, recall: float = 0.95, passes: int = 6) -> SecretNet:
    """Train on the findings of the rules (label 1: a rule's match overlaps the candidate) in all documents, and on their re-spelled copies.

    The windows of all candidates (64 bytes each) are stored in the shared folder. Steps on a bounded sample of them (of about
    ``most_docs`` documents by a hash of the id, ``most_candidates`` windows at most) only give the weights to start from; then each of
    ``passes`` steps takes the gradient over all windows, classes balanced, and the weights of the least loss over all windows stay. A quarter of
    the documents is held back: all their windows calibrate the probability and choose the highest threshold at which
    ``recall`` of their findings is met. Without findings, or without others, the network stays untrained and adds nothing.
    """
    docs = docs_of(docs, id_col, text_col).where("doc_id is not null and text is not null")
    share = min(1.0, most_docs / max(docs.count(), 1))
    first = (F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1e6) < share
    seeded = docs.select("text", F.xxhash64("doc_id", F.lit(9)).alias("seed"), first.alias("first"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[tuple] = []
        take = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in got], k) for i, k in enumerate((pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.bool_()))], names=["x", "y", "back", "k", "first"])
        for seed, text, first in rows(batches, "seed", "text", "first"):
            base = base_spans(text)
            found = candidates(text, base)
            back = seed % 4 == 3
            got += [(x, int(y), back, seed ^ a, first) for a, b, y in found for x in windows(text, a, b)]
            others = [(a, b) for a, b, y in found if not y]
            got += [(x, 1, back, seed ^ ~i, first) for i, (t, a, b) in enumerate(respelled(text, base, others, seed)) for x in windows(t, a, b)]
            if len(got) >= 4000:
                yield take()
                got.clear()
        yield take()

    table = written(seeded.mapInArrow(make, "x binary, y int, back boolean, k long, first boolean"), "windows")
    net = SecretNet()
    n = {(r["back"], r["y"]): r["n"] for r in table.groupBy("back", "y").agg(F.count("*").alias("n")).collect()}
    got = table.where("first").orderBy(F.xxhash64("k"), "x").limit(most_candidates).toArrow()
    y, back = got.column("y").to_numpy().astype(np.float32), got.column("back").to_numpy()
    if sum(n.values()) < 40 or len(n) < 4:
        drop(table)
        return net
    if min(y[~back].sum(), (1 - y[~back]).sum()) >= 1:
        net.train(np.frombuffer(b"".join(got.column("x").to_pylist()), np.uint8).reshape(-1, WIDE).astype(np.int64)[~back], y[~back])
    taught, weight = table.where("not back").select("x", "y"), np.array([0.5 / n[False, 0], 0.5 / n[False, 1]])
    step, best = net.adam(), (np.inf, {})
    for i in range(passes + 1):
        slope, loss = _whole_slope(taught, net, weight)
        if loss < best[0]:
            best = loss, {k: getattr(net, k).copy() for k in net.WEIGHTS}
        if i < passes:
            step(slope, 0.003)
    vars(net).update(best[1])
    seen = _outputs(table.where("back").select("x", "y"), net)
    net.calibrate(np.array([r["z"] / FINE for r in seen]), np.array([r["y"] for r in seen]), np.array([r["n"] for r in seen]), recall)
    net.learnt, net.judged = n[False, 0] + n[False, 1], n[True, 0] + n[True, 1]
    drop(table)
    return net


def scan_secrets(docs: DataFrame, net: SecretNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` of each whole text: every rule's match, and each candidate that the network finds and no rule's match holds.

    ``score`` is the network's probability, for the rules' matches as well (null from an untrained network). Positions are
    code points, ends exclusive; order is by start, then kind (assign, access, hex, model). Null and empty texts have no
    spans. Each row gives a row; the network (20 KB) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        held: list[tuple[int | None, list, list]] = []  # id, rules' matches, candidates
        xs: list[bytes] = []
        many: list[int] = []  # windows of each candidate

        def take() -> pa.RecordBatch:
            p = np.zeros(0)
            if xs and net.threshold <= 1:
                x = np.frombuffer(b"".join(xs), np.uint8).reshape(-1, WIDE).astype(np.int64)
                p = np.maximum.reduceat(net.probability(x), np.cumsum(many) - many)
            score = iter(p.tolist())
            spans = []
            for _, base, found in held:
                of = {(a, b): next(score, None) for a, b, _ in found}
                made = [(a, k, b, of[a, b]) for a, k, b in base]
                made += [(a, 3, b, of[a, b]) for a, b, _ in found if of[a, b] is not None and of[a, b] >= net.threshold and not any(s <= a and b <= e for s, _, e in base)]
                spans.append([{"kind": KINDS[k], "start": a, "end": b, "score": s} for a, k, b, s in sorted(made, key=lambda m: m[:3])])
            out = pa.RecordBatch.from_arrays([pa.array([d for d, *_ in held], pa.int64()), pa.array(spans, OUT.field(1).type)], schema=OUT)
            held.clear(), xs.clear(), many.clear()
            return out

        for doc_id, text in rows(batches, "doc_id", "text"):
            text = text or ""
            base = base_spans(text)
            found = candidates(text, base)
            for a, b, _ in found:
                made = windows(text, a, b)
                xs += made
                many.append(len(made))
            held.append((doc_id, base, found))
            if len(held) >= 2000 or len(xs) >= 4000:
                yield take()
        if held:
            yield take()

    return docs_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many secrets each rule finds, a digest of those, and all spans with the network's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan_secrets(docs, fit_secrets(docs))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = text(F.filter("spans", lambda s: s["kind"] != "model"))
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), text("spans").alias("spans"))
