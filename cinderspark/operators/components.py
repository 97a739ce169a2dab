"""Connected components of set cells: labels within tiles, then a graph of the labels that touch across tile borders."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.operators.graph import connected_components
from cinderspark.sources.tables import written

#: Half of the neighbours; the other half sees the same pairs.
FORWARD = {4: [(0, 1), (1, 0)], 8: [(0, 1), (1, 0), (1, 1), (1, -1)]}


def label_grid(grid: np.ndarray, connectivity: int = 8) -> np.ndarray:
    """For each set cell the smallest flat index of its component; -1 elsewhere. Minima spread and labels jump to their roots."""
    h, w = grid.shape
    label = np.where(grid, np.arange(h * w).reshape(h, w), -1)
    while True:
        new = label.copy()
        for dr, dc in FORWARD[connectivity]:
            a = (slice(0, h - dr), slice(max(0, -dc), w - max(0, dc)))
            b = (slice(dr, h), slice(max(0, dc), w + min(0, dc)))
            both = grid[a] & grid[b]
            least = np.minimum(new[a], new[b])
            new[a] = np.where(both, least, new[a])
            new[b] = np.where(both, np.minimum(least, new[b]), new[b])
        flat = new.ravel()
        on = flat >= 0
        flat[on] = flat[flat[on]]
        if (new == label).all():
            return new
        label = new


def components(cells: DataFrame, height: int, width: int, connectivity: int = 8, tile: int = 256) -> DataFrame:
    """``y, r, c, component`` of the distinct set cells (y, r, c): the component's smallest cell number (y, r, c in order).

    A task labels a tile; pairs of cells that touch across a border, and only those, are joined, and their labels' graph is
    solved by :func:`connected_components`, in rounds that grow with the logarithm of the tiles that a component crosses.
    """
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        y, tr, tc = key
        grid = np.zeros((min(tile, height - tr * tile), min(tile, width - tc * tile)), bool)
        r, c = pdf["r"].to_numpy() - tr * tile, pdf["c"].to_numpy() - tc * tile
        grid[r, c] = True
        root = label_grid(grid, connectivity)[r, c]
        rr, rc = root // grid.shape[1] + tr * tile, root % grid.shape[1] + tc * tile
        return pd.DataFrame({"y": np.full(len(r), y), "r": pdf["r"], "c": pdf["c"], "local": (np.int64(y) * height + rr) * width + rc})

    typed = cells.select(F.col("y").cast("int").alias("y"), F.col("r").cast("int").alias("r"), F.col("c").cast("int").alias("c"))
    tiled = typed.withColumn("tr", F.floor(F.col("r") / tile).cast("int")).withColumn("tc", F.floor(F.col("c") / tile).cast("int"))
    local = written(tiled.groupBy("y", "tr", "tc").applyInPandas(run, "y int, r int, c int, local long"), "labels")
    at = lambda x: F.col(x) % tile
    edge = local.where((at("r") == 0) | (at("r") == tile - 1) | (at("c") == 0) | (at("c") == tile - 1))
    steps = F.explode(F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in FORWARD[connectivity])))
    seen = edge.withColumn("s", steps).select("y", (F.col("r") + F.col("s.dr")).alias("r"), (F.col("c") + F.col("s.dc")).alias("c"), F.col("local").alias("a"))
    graph = connected_components(seen.join(edge, ["y", "r", "c"]).select("a", F.col("local").alias("b")).where("a <> b"))
    joined = local.join(graph.withColumnRenamed("node", "local"), "local", "left")
    return joined.select("y", "r", "c", F.coalesce("component", "local").alias("component"))


def component_areas(labelled: DataFrame, cell_area: float = 1.0) -> DataFrame:
    """``y, component, cells, area`` of each component."""
    n = F.count("*")
    return labelled.groupBy("y", "component").agg(n.alias("cells"), (n * F.lit(float(cell_area))).alias("area"))


def rings(edges: np.ndarray, joined_corners: bool = True) -> list[np.ndarray]:
    """Closed rings of directed unit edges (r0, c0, r1, c1) that have their cell on the right.

    Where two edges leave a corner, an 8-connected outline goes on to the far cell (a left turn), a 4-connected one stays
    with its cell (a right turn).
    """
    leaving: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r0, c0, r1, c1 in edges.tolist():
        leaving.setdefault((r0, c0), []).append((r1, c1))
    found = []
    while leaving:
        at = start = next(iter(leaving))
        came, ring = None, [start]
        while True:
            ways = leaving[at]
            if len(ways) > 1 and came is not None:
                turn = lambda to: came[0] * (to[1] - at[1]) - came[1] * (to[0] - at[0])  # noqa: B023, E731
                to = (max if joined_corners else min)(ways, key=turn)
            else:
                to = ways[0]
            ways.remove(to)
            if not ways:
                del leaving[at]
            came, at = (to[0] - at[0], to[1] - at[1]), to
            ring.append(at)
            if at == start:
                break
        ring = np.array(ring)
        step = np.diff(ring, axis=0)
        corner = np.r_[True, (step[1:] != step[:-1]).any(1), True]
        found.append(ring[corner])
    return found


def outlines(labelled: DataFrame, transform: tuple[float, ...] = (1, 0, 0, 0, 1, 0), connectivity: int = 8) -> DataFrame:
    """``y, component, cells, geom`` (WKB) of each component of cells (y, r, c, component): its outline with holes.

    Sides between a cell and one outside its component are found by an anti-join; only they reach the task that links a
    component's rings. ``transform``: a, b, c, d, e, f of x = a col + b row + c, y = d col + e row + f.
    """
    from cinderspark.operators.geometry import polygons_of_rings, to_wkb

    sides = F.array(*(F.struct(*(F.lit(v).alias(k) for k, v in zip(("dr", "dc", "r0", "c0", "r1", "c1"), x, strict=True))) for x in ((-1, 0, 0, 0, 0, 1), (0, 1, 0, 1, 1, 1), (1, 0, 1, 1, 1, 0), (0, -1, 1, 0, 0, 0))))
    each = labelled.withColumn("s", F.explode(sides)).withColumn("nr", F.col("r") + F.col("s.dr")).withColumn("nc", F.col("c") + F.col("s.dc"))
    other = labelled.select("y", F.col("r").alias("nr"), F.col("c").alias("nc"), "component")
    border = each.join(other, ["y", "nr", "nc", "component"], "left_anti")
    at = lambda rc, side: (F.col(rc) + F.col(f"s.{side}")).alias(side)
    border = border.select("y", "component", at("r", "r0"), at("c", "c0"), at("r", "r1"), at("c", "c1"))
    a, b, cc, d, e, f = transform

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = rings(pdf[["r0", "c0", "r1", "c1"]].to_numpy(), connectivity == 8)
        placed = [np.stack([a * x[:, 1] + b * x[:, 0] + cc, d * x[:, 1] + e * x[:, 0] + f], 1) for x in found]
        return pd.DataFrame({"y": [key[0]], "component": [key[1]], "geom": [to_wkb(polygons_of_rings(placed))]})

    made = border.groupBy("y", "component").applyInPandas(run, "y int, component long, geom binary")
    return made.join(component_areas(labelled).select("y", "component", "cells"), ["y", "component"]).select("y", "component", "cells", "geom")
