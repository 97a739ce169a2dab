"""The pixel classifier: a small fully connected network as column expressions, as vectorised batches, and its training."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, EmptyInputError

#: Hidden layer widths, classes, learning rate, steps, batch, and the part of samples that trains.
WIDTHS, CLASSES, RATE, STEPS, BATCH, TRAIN_PART = (7, 14, 7, 14, 7), 2, 0.001, 7001, 1000, 0.7
#: Fixed value: the largest float32, which stands in for infinity.
FLOAT_MAX = 3.4028234663852886e38


# --- pixels ---------------------------------------------------------------------------------------------------------------


def vectorise(tiles: DataFrame) -> DataFrame:
    """``raster_id, r, c, bands`` of tiles (raster_id, r0, c0, w, bands array<array<float>>), each band row by row."""
    first = F.element_at("bands", 1)
    at = tiles.withColumn("i", F.explode(F.sequence(F.lit(0), F.size(first) - 1)))
    return at.select("raster_id", (F.col("r0") + F.floor(F.col("i") / F.col("w"))).cast("int").alias("r"), (F.col("c0") + F.col("i") % F.col("w")).cast("int").alias("c"), F.transform("bands", lambda b: F.element_at(b, F.col("i") + 1)).alias("bands"))


def devectorise(pixels: DataFrame, value: str = "v") -> DataFrame:
    """``raster_id, w, values``: the pixels' values in one array a raster row, then row by row: the inverse of :func:`vectorise`."""
    lines = pixels.groupBy("raster_id", "r").agg(F.array_sort(F.collect_list(F.struct("c", F.col(value).alias("v")))).alias("line"))
    return lines.select("raster_id", "r", F.size("line").alias("w"), F.transform("line", lambda x: x["v"]).alias("values"))


def select_bands(bands: Column, indices: list[int]) -> Column:
    """The bands at 0-based ``indices``."""
    return F.array(*(bands[i] for i in indices))


def nan_to_number(bands: Column) -> Column:
    """NaN becomes 0, infinities the largest float32; null stays null."""
    clean = lambda x: F.when(F.isnan(x), 0.0).when(x > FLOAT_MAX, FLOAT_MAX).when(x < -FLOAT_MAX, -FLOAT_MAX).otherwise(x)
    return F.transform(bands, clean)


def standardise(bands: Column, mean: list[float], std: list[float]) -> Column:
    """(x - mean) / std by band; a std of 0 counts as 1."""
    pairs = F.array(*(F.struct(F.lit(float(m)).alias("m"), F.lit(float(s) or 1.0).alias("s")) for m, s in zip(mean, std, strict=True)))
    return F.zip_with(bands, pairs, lambda x, p: (x - p["m"]) / p["s"])


def any_valid(bands: Column) -> Column:
    return F.exists(bands, lambda x: ~F.isnan(x))


def all_valid(bands: Column) -> Column:
    return F.forall(bands, lambda x: ~F.isnan(x))


def band_stats(samples: DataFrame, bands: str = "b") -> DataFrame:
    """``band, mean, std`` (population; 0 becomes 1) of each position of an array column."""
    long = samples.select(F.posexplode(bands).alias("band", "x"))
    std = F.stddev_pop("x")
    return long.groupBy("band").agg(F.avg("x").alias("mean"), F.when(std == 0, 1.0).otherwise(std).alias("std"))


def split_rank(samples: DataFrame, order: list[Column], part: float = TRAIN_PART) -> DataFrame:
    """``samples`` with ``train``: the first floor(n * part) in order; an error if either side would be empty.

    Ranks without one task for all rows: rows are range-partitioned in order, ranked within, and moved on by the sizes of
    the partitions before (one number each).
    """
    n = samples.count()
    cut = int(n * part)
    if not 0 < cut < n:
        raise EmptyInputError(f"{n} samples can't be split at {part}")
    from cinderspark.sources.tables import written

    keyed = samples.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    keyed = written(keyed, "ranks")
    block = F.shiftright("_at", 33)
    sizes = keyed.groupBy(block.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row["p"], total))
        total += row["n"]
    before = samples.sparkSession.createDataFrame(starts, "_p long, _before long")
    rank = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return keyed.withColumn("_p", block).join(F.broadcast(before), "_p").withColumn("train", rank < cut).drop("_p", "_before", "_at")


# --- the network as expressions --------------------------------------------------------------------------------------------


def dense_layer(x: Column, weights: list[list[float]], bias: list[float], relu: bool = True) -> Column:
    """x . W + b, with W as rows for inputs, and optionally no less than 0."""
    out = []
    for j, b in enumerate(bias):
        z = F.lit(float(b))
        for i, row in enumerate(weights):
            z = z + x[i] * F.lit(float(row[j]))
        out.append(F.greatest(z, F.lit(0.0)) if relu else z)
    return F.array(*out)


def argmax(x: Column) -> Column:
    """The first position of the largest value, from 0."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


def predict(pixels: DataFrame, layers: list[tuple[list, list]], bands: str = "b") -> DataFrame:
    """``pixels`` with ``logits`` and ``pred``; each layer is a column of its own, so that no expression is repeated."""
    x = pixels.withColumn("_x0", F.col(bands))
    for i, (w, b) in enumerate(layers):
        x = x.withColumn(f"_x{i + 1}", dense_layer(F.col(f"_x{i}"), w, b, relu=i + 1 < len(layers)))
    x = x.withColumn("logits", F.col(f"_x{len(layers)}"))
    return x.withColumn("pred", argmax(F.col("logits"))).drop(*(f"_x{i}" for i in range(len(layers) + 1)))


def embed(pixels: DataFrame, layers: list[tuple[list, list]], depth: int, bands: str = "b") -> DataFrame:
    """``pixels`` with ``embedding``: the activations of hidden layer ``depth`` (from 1)."""
    x = pixels.withColumn("_x0", F.col(bands))
    for i, (w, b) in enumerate(layers[:depth]):
        x = x.withColumn(f"_x{i + 1}", dense_layer(F.col(f"_x{i}"), w, b))
    return x.withColumn("embedding", F.col(f"_x{depth}")).drop(*(f"_x{i}" for i in range(depth + 1)))


def accuracy(predicted: DataFrame, label: str, pred: str = "pred") -> DataFrame:
    return predicted.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


# --- the network as batches ------------------------------------------------------------------------------------------------


class Network:
    """Weights, the training statistics, and which bands go in."""

    def __init__(self, layers: list[tuple[np.ndarray, np.ndarray]], mean: np.ndarray, std: np.ndarray, bands: list[int] | None = None):
        self.layers = [(np.asarray(w, np.float64), np.asarray(b, np.float64)) for w, b in layers]
        self.mean, self.std, self.bands = np.asarray(mean, float), np.where(np.asarray(std, float) == 0, 1.0, std), bands

    def run(self, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Logits; with ``depth``, the activations of that hidden layer."""
        x = x[:, self.bands] if self.bands else x
        if x.shape[1] != len(self.mean):
            raise DataContractError(f"the model takes {len(self.mean)} bands, not {x.shape[1]}")
        x = (np.nan_to_num(x.astype(np.float32)).astype(float) - self.mean) / self.std
        for i, (w, b) in enumerate(self.layers[:depth]):
            x = x @ w + b
            if i + 1 < len(self.layers):
                x = np.maximum(x, 0)
        return x


def network_of(text: str, layers: list[tuple[np.ndarray, np.ndarray]]) -> Network:
    """A network from its stored hyper-parameters; models without a data schema are refused."""
    stored = json.loads(text)
    if "DATASET_SCHEMA" not in stored:
        raise EmptyInputError("the model was stored without DATASET_SCHEMA")
    return Network(layers, stored["data_mean"], stored["data_std"], stored["DATASET_SCHEMA"]["INPUT_BAND_INDICES"])


def hyperparameters(net: Network, label: str, label_index: int, rate: float = RATE) -> str:
    """The stored form: eleven keys."""
    widths = {f"NUM_N_L{i + 1}": len(b) for i, (_, b) in enumerate(net.layers[:-1])}
    bands = net.bands if net.bands is not None else list(range(len(net.mean)))
    return json.dumps({"data_mean": net.mean.tolist(), "data_std": net.std.tolist(), "lr": rate, **widths, "NUM_CLASSES": len(net.layers[-1][1]), "NUM_INPUT": len(net.mean), "DATASET_SCHEMA": {"INPUT_BAND_INDICES": bands, "LABEL_BAND_INDEX": label_index, "LABEL_NAME": label}})


def predict_batches(pixels: DataFrame, net: Network, bands: str = "b", depth: int | None = None) -> DataFrame:
    """``pixels`` with ``pred int`` (with ``depth``: ``embedding array<double>``), by Arrow batches; weights go out once."""
    sent = pixels.sparkSession.sparkContext.broadcast(net)
    name, kind = ("pred", "int") if depth is None else ("embedding", "array<double>")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            y = sent.value.run(np.stack(pdf[bands]) if len(pdf) else np.zeros((0, max(len(sent.value.mean), max(sent.value.bands or [0]) + 1))), depth)
            yield pdf.assign(**{name: y.argmax(1) if depth is None else list(y)})

    return pixels.mapInPandas(run, ", ".join([*(f"`{n}` {k}" for n, k in pixels.dtypes), f"{name} {kind}"]))


# --- training --------------------------------------------------------------------------------------------------------------


def initial_layers(inputs: int, rng: np.random.Generator, widths: tuple[int, ...] = WIDTHS, classes: int = CLASSES) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights from a normal cut at two deviations, of deviation 1 / sqrt(inputs); biases 0."""
    layers = []
    for a, b in zip((inputs, *widths), (*widths, classes), strict=True):
        w = rng.normal(size=(a, b))
        while (far := np.abs(w) > 2).any():
            w[far] = rng.normal(size=int(far.sum()))
        layers.append((w / np.sqrt(a), np.zeros(b)))
    return layers


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 0, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, save: Callable[[int, Network], None] | None = None, every: int = 100) -> tuple[Network, float]:
    """Adam on the mean softmax cross-entropy of shuffled batches; the first 70 % train, the rest gives the accuracy returned.

    ``save`` is called with every hundredth state, the first (before any step) and the last.
    """
    ok = ~np.isnan(x).any(1)
    x, y = x[ok], y[ok].astype(int)
    if not len(x):
        raise EmptyInputError("no sample has all bands")
    order = np.random.default_rng(seed).permutation(len(x))
    x, y, cut = x[order], y[order], int(len(x) * TRAIN_PART)
    if not 0 < cut < len(x):
        raise EmptyInputError(f"{len(x)} samples can't be split at {TRAIN_PART}")
    if cut < 2:
        raise DataContractError("fewer than two samples to train on")
    rng = np.random.default_rng(seed)
    mean, std = x[:cut].mean(0), x[:cut].std(0)
    net = Network(initial_layers(x.shape[1], rng), mean, std)
    z = (x - net.mean) / net.std
    state = [[np.zeros_like(p) for p in layer] + [np.zeros_like(p) for p in layer] for layer in net.layers]
    for t in range(1, steps + 1):
        if save and (t - 1) % every == 0:
            save(t - 1, net)
        pick = rng.choice(cut, min(batch, cut), replace=False)
        acts = [z[pick]]
        for i, (w, b) in enumerate(net.layers):
            h = acts[-1] @ w + b
            acts.append(np.maximum(h, 0) if i + 1 < len(net.layers) else h)
        e = np.exp(acts[-1] - acts[-1].max(1, keepdims=True))
        slope = e / e.sum(1, keepdims=True)
        slope[np.arange(len(pick)), y[pick]] -= 1
        slope /= len(pick)
        for i in reversed(range(len(net.layers))):
            grads = acts[i].T @ slope, slope.sum(0)
            if i:
                slope = (slope @ net.layers[i][0].T) * (acts[i] > 0)
            for j, g in enumerate(grads):
                m, v = state[i][j], state[i][2 + j]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.layers[i][j][...] -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    if save:
        save(steps, net)
    right = net.run(x[cut:]).argmax(1) == y[cut:]
    return net, float(right.mean())


def train_models(samples: DataFrame, keys: list[str], bands: str = "b", label: str = "landcover", steps: int = STEPS, seed: int = 0, checkpoints: str | None = None) -> DataFrame:
    """One network for each key: ``keys..., model string (JSON), n, accuracy``; a task trains one model.

    A model's samples must fit one task: they are what one network is trained on in memory by design. ``checkpoints``: a
    folder, reached from every executor, that gets the state of every hundredth step as ``<keys>-<step>.json``.
    """
    if checkpoints:
        from cinderspark.sources.tables import qualified

        checkpoints = qualified(samples.sparkSession, checkpoints)

    def stored(net: Network) -> str:
        return json.dumps({"mean": net.mean.tolist(), "std": net.std.tolist(), "layers": [[w.tolist(), b.tolist()] for w, b in net.layers]})

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        def save(step: int, net: Network) -> None:
            system, at = fs.FileSystem.from_uri(checkpoints)
            system.create_dir(at, recursive=True)
            with system.open_output_stream(f"{at}/{'-'.join(map(str, key))}-{step:05d}.json") as out:
                out.write(stored(net).encode())

        net, acc = fit_network(np.stack(pdf[bands]).astype(float), pdf[label].to_numpy(), seed, steps, save=save if checkpoints else None)
        text = stored(net)
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key, strict=True)}, "model": [text], "n": [len(pdf)], "accuracy": [acc]})

    kinds = dict(samples.dtypes)
    return samples.groupBy(*keys).applyInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "model string, n long, accuracy double"]))
