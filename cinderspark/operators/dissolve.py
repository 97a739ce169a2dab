"""Union of polygons by key: outlines are found cell by cell, and linked to rings where geometries are asked for.

A cell's task has all polygons that meet the cell. It cuts their sides where they meet each other and at the cell's border,
and keeps the pieces in the cell that have no polygon on their right (sides run with their polygon on the left). Together the
pieces of all cells are the union's outline, so its area is a sum over pieces, and no polygon is ever united with another.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError
from cinderspark.operators.geometry import Polygons, contains, from_wkb, measured, polygons_of_rings, ring_area, to_wkb

#: Digits that coordinates are rounded to, and how far beside a side its neighbours are looked for (parts of its length).
DIGITS, BESIDE = 9, 1e-6
SIDES = "x0 double, y0 double, x1 double, y1 double"


def sides_of(polygons: Polygons) -> np.ndarray:
    """Sides (n, 4) with the inside on the left: outsides counter-clockwise, holes clockwise."""
    found = []
    for p in polygons:
        for i, ring in enumerate(p):
            r = ring if (ring_area(ring) > 0) == (i == 0) else ring[::-1]
            found.append(np.c_[r[:-1], r[1:]])
    out = np.concatenate(found) if found else np.zeros((0, 4))
    return out[(out[:, :2] != out[:, 2:]).any(1)]


def _cuts(a: np.ndarray, box: tuple[float, float, float, float]) -> list[np.ndarray]:
    """For each side the parts of its length, within 0 and 1, where others meet it or the box's lines do."""
    p, d = a[:, :2], a[:, 2:] - a[:, :2]
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    length = (d**2).sum(1)
    near = 1e-9 * np.sqrt(length.max(initial=1.0))
    out: list[np.ndarray] = []
    step = max(1, 2_000_000 // max(1, len(a)))
    with np.errstate(divide="ignore", invalid="ignore"):
        for at in range(0, len(a), step):  # some sides against all
            own = slice(at, at + step)
            d_i, p_i, len_i = d[own, None], p[own, None], length[own, None]
            w = p[None] - p_i
            den = cross(d_i, d[None])
            t, u = cross(w, d[None]) / den, cross(w, d_i) / den
            t = np.where((den != 0) & (u >= -1e-12) & (u <= 1 + 1e-12), t, np.nan)
            parts = [t]
            for q in (p, a[:, 2:]):  # ends of others that lie on this side
                v = q[None] - p_i
                parts.append(np.where(np.abs(cross(d_i, v)) <= near * np.sqrt(len_i), (v * d_i).sum(2) / len_i, np.nan))
            for k in (0, 1):
                parts.append((np.array([box[k], box[k + 2]])[None] - p[own, k, None]) / d[own, k, None])
            every = np.concatenate(parts, 1)
            every[~((every > 1e-12) & (every < 1 - 1e-12))] = np.nan
            every = np.sort(np.round(every, 12), axis=1)
            for row, n in zip(every, np.isfinite(every).sum(1).tolist(), strict=True):
                t = row[:n]
                out.append(np.r_[0.0, t[np.r_[True, t[1:] != t[:-1]]] if n else t, 1.0])
    return out


def outline(polygons: list[Polygons], box: tuple[float, float, float, float]) -> np.ndarray:
    """The pieces (n, 4) of the polygons' common outline whose middle is in the box (upper borders excluded)."""
    every = [sides_of(g) for g in polygons]
    a = np.concatenate(every) if every else np.zeros((0, 4))
    meets = (np.maximum(a[:, 0], a[:, 2]) >= box[0]) & (np.minimum(a[:, 0], a[:, 2]) <= box[2]) & (np.maximum(a[:, 1], a[:, 3]) >= box[1]) & (np.minimum(a[:, 1], a[:, 3]) <= box[3])
    a = a[meets]
    if not len(a):
        return a
    pieces = []
    for side, t in zip(a, _cuts(a, box), strict=True):
        at = np.round(side[:2] + t[:, None] * (side[2:] - side[:2]), DIGITS)
        pieces.append(np.c_[at[:-1], at[1:]])
    a = np.unique(np.concatenate(pieces), axis=0)
    a = a[(a[:, :2] != a[:, 2:]).any(1)]
    middle, d = (a[:, :2] + a[:, 2:]) / 2, a[:, 2:] - a[:, :2]
    inside = (middle >= box[:2]).all(1) & (middle < box[2:]).all(1)
    a, middle, d = a[inside], middle[inside], d[inside]
    right = middle + BESIDE * np.c_[d[:, 1], -d[:, 0]]
    covered = np.zeros(len(a), bool)
    for g in polygons:
        covered |= contains(g, right)
    return a[~covered]


def union_outline(layer: DataFrame, key: str, cell: float, geom: str = "geom", most: int = 200) -> DataFrame:
    """``key, x0, y0, x1, y1``: the pieces of the outline of each key's union; null keys and empty geometries are left out.

    ``cell`` should be a little larger than usual polygons. A cell with more than ``most`` of them is cut into as many smaller
    ones as its count asks for; equal geometries of a key count once.
    """
    if cell <= 0:
        raise DataContractError("cells have a size")
    kind = dict(layer.dtypes)[key]
    boxes = measured(layer.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(geom).alias("geom")).dropDuplicates(["k", "geom"])).where("area_m2 > 0").select("k", "geom", "minx", "miny", "maxx", "maxy")
    span = lambda lo, hi, size: F.explode(F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size)))
    coarse = boxes.withColumn("gx", span("minx", "maxx", F.lit(float(cell)))).withColumn("gy", span("miny", "maxy", F.lit(float(cell))))
    dense = coarse.groupBy("k", "gx", "gy").agg(F.count("*").alias("n")).withColumn("cuts", F.ceil(F.sqrt(F.col("n") / most))).drop("n")
    cut = coarse.join(dense, ["k", "gx", "gy"]).withColumn("size", F.lit(float(cell)) / F.col("cuts"))
    within = lambda lo, hi, g: F.explode(F.sequence(F.greatest(F.floor(F.col(lo) / F.col("size")), F.col(g) * F.col("cuts")), F.least(F.floor(F.col(hi) / F.col("size")), (F.col(g) + 1) * F.col("cuts") - 1)))
    fine = cut.withColumn("hx", within("minx", "maxx", "gx")).withColumn("hy", within("miny", "maxy", "gy"))

    def run(at: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        k, hx, hy, size = at
        found = outline([from_wkb(g) for g in pdf["geom"]], (hx * size, hy * size, (hx + 1) * size, (hy + 1) * size))
        return pd.DataFrame({"k": [k] * len(found), **{c: found[:, i] for i, c in enumerate(("x0", "y0", "x1", "y1"))}})

    pieces = fine.select("k", "hx", "hy", "size", "geom").groupBy("k", "hx", "hy", "size").applyInPandas(run, f"k {kind}, {SIDES}")
    return pieces.withColumnRenamed("k", key)


def union_area(layer: DataFrame, key: str, cell: float, geom: str = "geom") -> DataFrame:
    """``key, area_m2`` of each key's union: a sum over the outline's pieces, which needs no task for a whole key."""
    p = union_outline(layer, key, cell, geom)
    return p.groupBy(key).agg((F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0")) / 2).alias("area_m2"))


def linked(a: np.ndarray) -> list[np.ndarray]:
    """Closed rings of directed pieces; where several leave a point, the sharpest turn to the left stays with the same polygon."""
    leaving: dict[tuple, list[tuple]] = {}
    for x0, y0, x1, y1 in a.tolist():
        leaving.setdefault((x0, y0), []).append((x1, y1))
    found = []
    while leaving:
        start = at = next(iter(leaving))
        ring, came = [start], None
        while True:
            ways = leaving.get(at)
            if not ways:
                raise DataContractError("the outline doesn't close")
            to = ways[0]
            if len(ways) > 1 and came is not None:
                turn = lambda q: np.arctan2(came[0] * (q[1] - at[1]) - came[1] * (q[0] - at[0]), came[0] * (q[0] - at[0]) + came[1] * (q[1] - at[1]))  # noqa: B023, E731
                to = max(ways, key=turn)
            ways.remove(to)
            if not ways:
                del leaving[at]
            came, at = (to[0] - at[0], to[1] - at[1]), to
            ring.append(at)
            if at == start:
                break
        r = np.array(ring)
        before, after = r[:-1] - np.roll(r[:-1], 1, 0), r[1:] - r[:-1]
        bend = np.abs(before[:, 0] * after[:, 1] - before[:, 1] * after[:, 0]) > 1e-9 * np.sqrt((before**2).sum(1) * (after**2).sum(1))
        r = r[:-1][bend]
        if len(r) > 2:
            found.append(np.r_[r, r[:1]])
    return found


def dissolve(layer: DataFrame, key: str, cell: float, geom: str = "geom") -> DataFrame:
    """``key, n_parts, geom``: the topological union of each key's polygons.

    Only the outline of a key's union, not its polygons, comes to the task that links its rings.
    """

    def run(at: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        polygons = polygons_of_rings(linked(pdf[["x0", "y0", "x1", "y1"]].to_numpy()))
        return pd.DataFrame({key: [at[0]], "n_parts": [len(polygons)], "geom": [to_wkb(polygons)]})

    return union_outline(layer, key, cell, geom).groupBy(key).applyInPandas(run, f"{key} {dict(layer.dtypes)[key]}, n_parts long, geom binary")
