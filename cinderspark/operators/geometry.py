"""Planar geometry on WKB: areas, boxes, hulls, overlaps and points in polygons, in NumPy.

A geometry in memory is a list of polygons; a polygon a list of rings (closed, n x 2), the first of them its outside.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Polygons = list[list[np.ndarray]]


def to_wkb(polygons: Polygons) -> bytes:
    """Well-known binary: one polygon as such, several or none as a multipolygon."""
    def one(rings: list[np.ndarray]) -> bytes:
        return struct.pack("<BII", 1, 3, len(rings)) + b"".join(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)

    return one(polygons[0]) if len(polygons) == 1 else struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(one, polygons))


def from_wkb(data: bytes | None) -> Polygons:
    """Polygons of a polygon or multipolygon in either byte order; of null, empty and other geometries, none."""
    def read(at: int) -> tuple[Polygons, int]:
        order = "<" if data[at] else ">"
        kind, n = struct.unpack_from(order + "II", data, at + 1)
        at += 9
        if kind & 0xFF == 3:
            rings = []
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", data, at)
                rings.append(np.frombuffer(data, order + "f8", 2 * m, at + 4).reshape(m, 2).astype(float))
                at += 4 + 16 * m
            return ([rings] if rings else []), at
        if kind & 0xFF == 6:
            found: Polygons = []
            for _ in range(n):
                part, at = read(at)
                found += part
            return found, at
        return [], at

    return read(0)[0] if data else []


def rectangle(minx: float, miny: float, maxx: float, maxy: float) -> Polygons:
    return [[np.array([[minx, miny], [maxx, miny], [maxx, maxy], [minx, maxy], [minx, miny]], float)]]


def ring_area(ring: np.ndarray) -> float:
    """Signed area by the shoelace sum; positive counter-clockwise. Coordinates are taken from the first point for accuracy."""
    x, y = (ring - ring[0]).T if len(ring) else (np.zeros(0), np.zeros(0))
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def area(polygons: Polygons) -> float:
    """Outsides less holes."""
    return sum(abs(ring_area(p[0])) - sum(abs(ring_area(h)) for h in p[1:]) for p in polygons)


def bounds(polygons: Polygons) -> tuple[float, float, float, float] | None:
    points = [p[0] for p in polygons]
    if not points:
        return None
    xy = np.concatenate(points)
    return (*map(float, xy.min(0)), *map(float, xy.max(0)))


def hull(points: np.ndarray) -> np.ndarray:
    """The convex hull's corners, counter-clockwise, closed."""
    p = np.unique(np.asarray(points, float), axis=0)
    if len(p) < 3:
        return np.r_[p, p[:1]]

    def half(order: np.ndarray) -> list:
        out: list = []
        for q in order:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (q[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (q[0] - out[-2][0]):
                out.pop()
            out.append(q)
        return out[:-1]

    ring = np.array(half(p) + half(p[::-1]))
    return np.r_[ring, ring[:1]]


def contains(polygons: Polygons, points: np.ndarray) -> np.ndarray:
    """Whether points are inside, by crossings of all rings; on the outline it may be either."""
    inside = np.zeros(len(points), bool)
    for ring in (r for p in polygons for r in p):
        a, b = ring[:-1], ring[1:]
        x, y = points[:, 0, None], points[:, 1, None]
        crosses = (a[:, 1] > y) != (b[:, 1] > y)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
        inside ^= ((crosses & (x < at)).sum(1) % 2).astype(bool)
    return inside


def _clip(ring: np.ndarray, other: np.ndarray) -> np.ndarray:
    """A convex ring cut to a counter-clockwise convex one (both open); in plain numbers, as rings have a handful of points."""
    points, sides = ring.tolist(), other.tolist()
    for i, (bx, by) in enumerate(sides):
        ax, ay = sides[i - 1]
        dx, dy = bx - ax, by - ay
        side = [dx * (y - ay) - dy * (x - ax) for x, y in points]
        out = []
        for j, (x, y) in enumerate(points):
            if side[j - 1] * side[j] < 0:
                px, py = points[j - 1]
                t = side[j - 1] / (side[j - 1] - side[j])
                out.append([px + (x - px) * t, py + (y - py) * t])
            if side[j] >= 0:
                out.append([x, y])
        points = out
        if not points:
            break
    return np.array(points).reshape(-1, 2)


def _fans(polygons: Polygons, origin: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """Signed triangles from ``origin`` that add up to the polygons (holes count against)."""
    out = []
    for p in polygons:
        for i, ring in enumerate(p):
            turn = (1 if ring_area(ring) > 0 else -1) * (1 if i == 0 else -1)
            for a, b in zip(ring[:-1], ring[1:], strict=True):
                t = np.array([origin, a, b])
                s = ring_area(np.r_[t, t[:1]])
                if s:
                    out.append((turn * np.sign(s), t if s > 0 else t[::-1]))
    return out


def _convex(polygons: Polygons) -> np.ndarray | None:
    """The open counter-clockwise ring of one convex polygon without holes; None for any other geometry."""
    if len(polygons) != 1 or len(polygons[0]) != 1:
        return None
    ring = polygons[0][0]
    d = ring[1:] - ring[:-1]
    e = np.roll(d, -1, 0)
    turn = d[:, 0] * e[:, 1] - d[:, 1] * e[:, 0]
    if not ((turn >= 0).all() or (turn <= 0).all()) or len(ring) > 12:  # (a longer ring may wind twice)
        return None
    if len(ring) > 5 and abs(np.arctan2(turn, (d * e).sum(1)).sum()) > 7:
        return None
    return ring[:-1] if turn.sum() > 0 else ring[-1:0:-1]


def shared_area(a: Polygons, b: Polygons) -> float:
    """The area of the intersection of any two polygons with holes: signed triangle fans, cut pair by pair; two convex ones are cut at once."""
    if not a or not b:
        return 0.0
    x, y = _convex(a), _convex(b)
    if x is not None and y is not None:
        cut = _clip(x, y)
        return abs(ring_area(np.r_[cut, cut[:1]])) if len(cut) > 2 else 0.0
    origin = np.array(bounds(a)[:2]) - 1.0
    total = 0.0
    for s, t in _fans(a, origin):
        for u, v in _fans(b, origin):
            if (t.max(0) < v.min(0)).any() or (v.max(0) < t.min(0)).any():
                continue
            cut = _clip(t, v)
            if len(cut) > 2:
                total += s * u * abs(ring_area(np.r_[cut, cut[:1]]))
    return max(0.0, total)


def meet(a: Polygons, b: Polygons) -> bool:
    """Whether two geometries share a point; touching counts."""
    if not a or not b:
        return False
    for p in (r for x in a for r in x):
        for q in (r for x in b for r in x):
            d, e = p[1:] - p[:-1], q[1:] - q[:-1]
            cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
            w = q[None, :-1] - p[:-1, None]
            den = cross(d[:, None], e[None])
            s, t = cross(w, e[None]), cross(w, d[:, None])
            sign = np.where(den < 0, -1, 1)
            if ((den != 0) & (s * sign >= 0) & (s * sign <= np.abs(den)) & (t * sign >= 0) & (t * sign <= np.abs(den))).any():
                return True
            length = (d**2).sum(1)[:, None]
            flat = (den == 0) & (t == 0) & (length > 0)
            along = lambda z: (z * d[:, None]).sum(2)
            u0, u1 = along(w), along(w + e[None])
            if (flat & (np.minimum(u0, u1) <= length) & (np.maximum(u0, u1) >= 0)).any():
                return True
    return bool(contains(b, a[0][0][:1])[0] or contains(a, b[0][0][:1])[0])


def polygons_of_rings(rings: list[np.ndarray]) -> Polygons:
    """Rings as polygons: the largest turning one way are outsides, those turning the other way are holes of what holds them."""
    if not rings:
        return []
    areas = [ring_area(r) for r in rings]
    way = np.sign(areas[int(np.argmax(np.abs(areas)))])
    outer = [[r] for r, s in zip(rings, areas, strict=True) if np.sign(s) == way]
    for r, s in zip(rings, areas, strict=True):
        if np.sign(s) != way:
            middle = r[0] + (r[1] - r[0]) / 2
            normal = np.array([-(r[1] - r[0])[1], (r[1] - r[0])[0]])
            inside = middle + normal * 1e-6 * np.sign(s)
            holders = [p for p in outer if contains([[p[0]]], inside[None])[0]]
            (min(holders, key=lambda p: abs(ring_area(p[0]))) if holders else outer[0]).append(r)
    return outer


def measured(layer: DataFrame, geom: str = "geom") -> DataFrame:
    """``layer`` with ``area_m2, area_ha, minx, miny, maxx, maxy`` of its WKB; rows without a polygon have area 0 and no box."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [from_wkb(g) for g in pdf[geom]]
            m2 = np.array([area(g) for g in found], float)
            box = np.array([bounds(g) or (None,) * 4 for g in found], object).reshape(-1, 4)
            yield pdf.assign(area_m2=m2, area_ha=m2 / 10000.0, **{n: box[:, i].astype(float) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))})

    kinds = [f"`{n}` {k}" for n, k in layer.dtypes]
    return layer.mapInPandas(run, ", ".join([*kinds, *(f"{n} double" for n in ("area_m2", "area_ha", "minx", "miny", "maxx", "maxy"))]))


def exact_pairs(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose geometries meet, with ``intersection_area_m2`` and ``intersection_area_ha``: the exact test after a join of boxes."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            both = [(from_wkb(a), from_wkb(b)) for a, b in zip(pdf[left], pdf[right], strict=True)]
            ok = np.array([meet(a, b) for a, b in both], bool)
            m2 = np.array([shared_area(a, b) for (a, b), k in zip(both, ok, strict=True) if k], float)
            yield pdf[ok].assign(intersection_area_m2=m2, intersection_area_ha=m2 / 10000.0)

    return pairs.mapInPandas(run, ", ".join([*(f"`{n}` {k}" for n, k in pairs.dtypes), "intersection_area_m2 double, intersection_area_ha double"]))


def convex_hull(layer: DataFrame, geom: str = "geom") -> DataFrame:
    """``geom``: the hull of all geometries; partial hulls where the rows are, then the hull of those few corners."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points = np.zeros((0, 2))
        for pdf in frames:
            more = [p[0] for g in pdf["geom"] for p in from_wkb(g)]
            points = hull(np.concatenate([points, *more]))[:-1] if more else points
        yield pd.DataFrame({"x": points[:, 0], "y": points[:, 1]})

    corners = layer.select(F.col(geom).alias("geom")).mapInPandas(partial, "x double, y double")

    def last(_: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"geom": [to_wkb([[hull(pdf[["x", "y"]].to_numpy())]])]})

    return corners.groupBy(F.lit(1).alias("k")).applyInPandas(last, "geom binary")


def parts(layer: DataFrame, geom: str = "geom") -> DataFrame:
    """One row for each polygon of each geometry; empty and null geometries have none."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(**{geom: [[to_wkb([p]) for p in from_wkb(g)] for g in pdf[geom]]}).explode(geom).dropna(subset=[geom])

    return layer.mapInPandas(run, layer.schema)


def collect_parts(layer: DataFrame, key: str, geom: str = "geom") -> DataFrame:
    """``key, n_parts, geom``: all polygons of a key as one multipolygon, without uniting them."""

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = [p for g in pdf[geom] for p in from_wkb(g)]
        return pd.DataFrame({key: [k[0]], "n_parts": [len(found)], "geom": [struct.pack("<BII", 1, 6, len(found)) + b"".join(to_wkb([p]) for p in found)]})

    return layer.groupBy(key).applyInPandas(run, f"{key} {dict(layer.dtypes)[key]}, n_parts long, geom binary")


def within_distance(polygons: Polygons, points: np.ndarray, distance: float) -> np.ndarray:
    """Points inside, or at most ``distance`` from the outline: what lies in the buffer of the polygons."""
    near = contains(polygons, points)
    for ring in (r for p in polygons for r in p):
        a, d = ring[:-1], ring[1:] - ring[:-1]
        w = points[:, None] - a
        t = np.clip((w * d).sum(2) / np.maximum((d**2).sum(1), 1e-300), 0, 1)
        near |= (((w - t[..., None] * d) ** 2).sum(2) <= distance**2).any(1)
    return near


def clip_cells(cells: DataFrame, geom: bytes, transform: tuple[float, ...], buffer: float = 0.0) -> DataFrame:
    """``cells`` (r, c, v double) with ``v`` NaN where the cell's centre is farther than ``buffer`` from the geometry; cropped to its box."""
    a, b, cc, d, e, f = transform
    polygons = from_wkb(geom)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x, y = pdf["c"] + 0.5, pdf["r"] + 0.5
            points = np.stack([a * x + b * y + cc, d * x + e * y + f], 1)
            box = bounds(polygons)
            inside = within_distance(polygons, points, buffer) if box else np.zeros(len(pdf), bool)
            reach = np.zeros(len(pdf), bool) if box is None else ((points >= np.array(box[:2]) - buffer) & (points <= np.array(box[2:]) + buffer)).all(1)
            yield pdf.assign(v=np.where(inside, pdf["v"], np.nan))[reach]

    # (what is NaN in pandas comes back as null)
    return cells.mapInPandas(run, cells.schema).withColumn("v", F.coalesce("v", F.lit(float("nan"))))
