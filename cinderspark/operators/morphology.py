"""Erosion, dilation, opening and closing of binary rasters with a square of ones, on set cells or on dense tiles.

Offsets of a square of size k: erosion looks at -k//2 to k-1-k//2, dilation, its reflection, at -(k//2-1) to k//2 for even k
(-(k//2) to k//2 for odd k), so that opening never adds a cell. Cells outside the image are unset in every step, so closing by 4 always clears rows and columns 0 and 1 and
the last ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def erosion_offsets(k: int) -> list[int]:
    return list(range(-(k // 2), k - k // 2))


def dilation_offsets(k: int) -> list[int]:
    return [-d for d in reversed(erosion_offsets(k))]


def _spread(cells: DataFrame, offsets: list[int], height: int, width: int, keys: list[str]) -> DataFrame:
    """Every cell at each of the offsets' places (to which it is a neighbour), within the image."""
    d = F.array(*map(F.lit, offsets))
    moved = cells.withColumn("_dr", F.explode(d)).withColumn("_dc", F.explode(d))
    moved = moved.select(*keys, (F.col("r") + F.col("_dr")).alias("r"), (F.col("c") + F.col("_dc")).alias("c"))
    return moved.where((F.col("r") >= 0) & (F.col("r") < height) & (F.col("c") >= 0) & (F.col("c") < width))


def erode(cells: DataFrame, k: int, height: int, width: int, keys: tuple[str, ...] = ("y",)) -> DataFrame:
    """Cells whose whole square is set: each set cell counts for the places that see it, with map-side counts."""
    keys = list(keys)
    seen = _spread(cells, [-d for d in erosion_offsets(k)], height, width, keys)
    return seen.groupBy(*keys, "r", "c").agg(F.count("*").alias("_n")).where(F.col("_n") == k * k).select(*keys, "r", "c")


def dilate(cells: DataFrame, k: int, height: int, width: int, keys: tuple[str, ...] = ("y",)) -> DataFrame:
    """Cells that a set cell's square reaches."""
    return _spread(cells, [-d for d in dilation_offsets(k)], height, width, list(keys)).distinct()


def opening(cells: DataFrame, k: int, height: int, width: int, keys: tuple[str, ...] = ("y",)) -> DataFrame:
    return dilate(erode(cells, k, height, width, keys), k, height, width, keys)


def closing(cells: DataFrame, k: int, height: int, width: int, keys: tuple[str, ...] = ("y",)) -> DataFrame:
    return erode(dilate(cells, k, height, width, keys), k, height, width, keys)


def spatial_filter(cells: DataFrame, height: int, width: int, open_: int = 2, close: int = 4, keys: tuple[str, ...] = ("y",)) -> DataFrame:
    """Opening, then closing; a size of 0 leaves a step out. Cells must be distinct."""
    cells = opening(cells, open_, height, width, keys) if open_ else cells
    return closing(cells, close, height, width, keys) if close else cells


def dense(grid: np.ndarray, k: int, erosion: bool) -> np.ndarray:
    """One step on a dense grid; what lies outside is unset."""
    out = np.full(grid.shape, erosion)
    h, w = grid.shape
    offsets = erosion_offsets(k) if erosion else dilation_offsets(k)
    for dr in offsets:
        for dc in offsets:
            moved = np.zeros(grid.shape, bool)
            a, b = slice(max(0, dr), h + min(0, dr)), slice(max(0, dc), w + min(0, dc))
            moved[max(0, -dr) : h + min(0, -dr), max(0, -dc) : w + min(0, -dc)] = grid[a, b]
            out = out & moved if erosion else out | moved
    return out


def spatial_filter_tiles(cells: DataFrame, height: int, width: int, open_: int = 2, close: int = 4, tile: int = 256, keys: tuple[str, ...] = ("y",)) -> DataFrame:
    """:func:`spatial_filter` on dense tiles with a halo: one shuffle, in which border cells go to the neighbours too.

    The halo is what all steps can reach together (4 cells for the defaults); each step is clipped to the image.
    """
    keys = list(keys)
    sizes = [k for k in (open_, close) if k]
    halo = sum(k // 2 + max(0, k - 1 - k // 2) + 1 for k in sizes) if sizes else 0
    spread = lambda x: F.explode(F.sequence(F.floor((F.col(x) - halo) / tile), F.floor((F.col(x) + halo) / tile)))
    sent = cells.select(*keys, F.col("r").cast("int"), F.col("c").cast("int")).withColumn("_tr", spread("r")).withColumn("_tc", spread("c"))
    sent = sent.where((F.col("_tr") >= 0) & (F.col("_tc") >= 0) & (F.col("_tr") * tile < height) & (F.col("_tc") * tile < width))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tr, tc = key[-2:]
        r0, c0 = max(0, tr * tile - halo), max(0, tc * tile - halo)
        r1, c1 = min(height, (tr + 1) * tile + halo), min(width, (tc + 1) * tile + halo)
        grid = np.zeros((r1 - r0, c1 - c0), bool)
        grid[pdf["r"] - r0, pdf["c"] - c0] = True
        for k, steps in ((open_, (True, False)), (close, (False, True))):
            for erosion in steps if k else ():
                grid = dense(grid, k, erosion)
        r, c = np.nonzero(grid)
        r, c = r + r0, c + c0
        own = (r // tile == tr) & (c // tile == tc)
        out = {name: np.repeat(value, int(own.sum())) for name, value in zip(keys, key, strict=False)}
        return pd.DataFrame(out | {"r": r[own], "c": c[own]})

    kinds = dict(cells.dtypes)
    return sent.groupBy(*keys, "_tr", "_tc").applyInPandas(run, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "r int", "c int"]))
