"""Map projections in closed form on the WGS 84 ellipsoid, after Snyder (USGS Professional Paper 1395)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cinderspark.errors import DataContractError
from cinderspark.operators.geometry import from_wkb, to_wkb

#: The ellipsoid, and the parameters of the equal-area preset.
AXIS, FLATTENING = 6378137.0, 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
ALBERS = {"lat_1": -18.0, "lat_2": -55.0, "lat_0": -37.0, "lon_0": -71.0}


def _arc(lat: np.ndarray) -> np.ndarray:
    """The meridian's length from the equator."""
    e4, e6 = E2**2, E2**3
    return AXIS * ((1 - E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * lat - (3 * E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * np.sin(2 * lat) + (15 * e4 / 256 + 45 * e6 / 1024) * np.sin(4 * lat) - (35 * e6 / 3072) * np.sin(6 * lat))


def utm(lon: np.ndarray, lat: np.ndarray, zone: int = 19, south: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Degrees to metres of a transverse Mercator zone."""
    phi, lam = np.radians(lat), np.radians(np.asarray(lon) - (6 * zone - 183))
    ep2 = E2 / (1 - E2)
    n = AXIS / np.sqrt(1 - E2 * np.sin(phi) ** 2)
    t, c, a = np.tan(phi) ** 2, ep2 * np.cos(phi) ** 2, lam * np.cos(phi)
    x = 0.9996 * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t**2 + 72 * c - 58 * ep2) * a**5 / 120)
    y = 0.9996 * (_arc(phi) + n * np.tan(phi) * (a**2 / 2 + (5 - t + 9 * c + 4 * c**2) * a**4 / 24 + (61 - 58 * t + t**2 + 600 * c - 330 * ep2) * a**6 / 720))
    return x + 500_000.0, y + (10_000_000.0 if south else 0.0)


def utm_inverse(x: np.ndarray, y: np.ndarray, zone: int = 19, south: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Metres of a zone back to degrees, by Newton steps on :func:`utm`."""
    lon = np.full(np.shape(x), 6.0 * zone - 183) + (np.asarray(x) - 500_000.0) / 111_320.0
    lat = (np.asarray(y) - (10_000_000.0 if south else 0.0)) / 110_574.0
    for _ in range(12):
        fx, fy = utm(lon, lat, zone, south)
        h = 1e-6
        ax, ay = utm(lon + h, lat, zone, south)
        bx, by = utm(lon, lat + h, zone, south)
        j = np.array([[(ax - fx) / h, (bx - fx) / h], [(ay - fy) / h, (by - fy) / h]])
        det = j[0, 0] * j[1, 1] - j[0, 1] * j[1, 0]
        dx, dy = x - fx, y - fy
        lon, lat = lon + (j[1, 1] * dx - j[0, 1] * dy) / det, lat + (j[0, 0] * dy - j[1, 0] * dx) / det
    return lon, lat


def albers(lon: np.ndarray, lat: np.ndarray, lat_1: float = ALBERS["lat_1"], lat_2: float = ALBERS["lat_2"], lat_0: float = ALBERS["lat_0"], lon_0: float = ALBERS["lon_0"]) -> tuple[np.ndarray, np.ndarray]:
    """Degrees to metres of a conic projection that keeps areas."""
    e = np.sqrt(E2)

    def q(phi):
        s = np.sin(phi)
        return (1 - E2) * (s / (1 - E2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m(phi):
        return np.cos(phi) / np.sqrt(1 - E2 * np.sin(phi) ** 2)

    p1, p2, p0 = np.radians([lat_1, lat_2, lat_0])
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1)) if p1 != p2 else np.sin(p1)
    c = m(p1) ** 2 + n * q(p1)
    rho = AXIS * np.sqrt(c - n * q(np.radians(lat))) / n
    rho0 = AXIS * np.sqrt(c - n * q(p0)) / n
    theta = n * np.radians(np.asarray(lon) - lon_0)
    return rho * np.sin(theta), rho0 - rho * np.cos(theta)


def mercator(lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Degrees to metres of the spherical web projection."""
    return AXIS * np.radians(lon), AXIS * np.log(np.tan(np.pi / 4 + np.radians(lat) / 2))


def mercator_inverse(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.degrees(np.asarray(x) / AXIS), np.degrees(2 * np.arctan(np.exp(np.asarray(y) / AXIS)) - np.pi / 2)


def albers_inverse(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Metres of the equal-area preset back to degrees, by Newton steps on :func:`albers`."""
    lon, lat = ALBERS["lon_0"] + np.asarray(x) / 90_000.0, ALBERS["lat_0"] + np.asarray(y) / 111_000.0
    h = 1e-6
    for _ in range(20):
        fx, fy = albers(lon, lat)
        ax, ay = albers(lon + h, lat)
        bx, by = albers(lon, lat + h)
        j = np.array([[(ax - fx) / h, (bx - fx) / h], [(ay - fy) / h, (by - fy) / h]])
        det = j[0, 0] * j[1, 1] - j[0, 1] * j[1, 0]
        dx, dy = x - fx, y - fy
        lon, lat = lon + (j[1, 1] * dx - j[0, 1] * dy) / det, lat + (j[0, 0] * dy - j[1, 0] * dx) / det
    return lon, lat


def system(crs: str | None) -> tuple:
    """From degrees and back to degrees in a coordinate system: WGS 84, any of its UTM zones, web Mercator, or the equal-area preset."""
    if crs == "EPSG:4326":
        return (lambda lon, lat: (lon, lat)), (lambda x, y: (x, y))
    if crs == "EPSG:3857":
        return mercator, mercator_inverse
    if crs == "equal-area":
        return albers, albers_inverse
    zone = re.fullmatch(r"EPSG:32([67])(\d\d)", crs or "")
    if zone and 1 <= int(zone[2]) <= 60:
        south, n = zone[1] == "7", int(zone[2])
        return (lambda lon, lat: utm(lon, lat, n, south)), (lambda x, y: utm_inverse(x, y, n, south))
    raise DataContractError(f"no way to or from {crs}")


def is_projected(crs: str | None) -> bool:
    if not crs or crs == "EPSG:4326":
        return False
    try:
        return bool(system(crs))
    except DataContractError:
        return False


def transform(x: np.ndarray, y: np.ndarray, source: str, target: str) -> tuple[np.ndarray, np.ndarray]:
    """Points from one system to another, x before y always."""
    if source == target:
        return x, y
    return system(target)[0](*system(source)[1](x, y))


def reproject(layer: DataFrame, target: str = "EPSG:32719", source: str | None = "EPSG:4326", geom: str = "geom") -> DataFrame:
    """The layer's geometries in another system, vertex by vertex. A layer without a system, or an unknown one, is an error."""
    if not source:
        raise DataContractError("the layer has no coordinate system")
    if source == target:
        return layer
    system(source), system(target)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = [from_wkb(g) for g in pdf[geom]]
            rings = [r for polygons in found for p in polygons for r in p]
            if rings:  # all vertices of a batch at once
                xy = np.concatenate(rings)
                moved = iter(np.split(np.stack(transform(xy[:, 0], xy[:, 1], source, target), 1), np.cumsum([len(r) for r in rings])[:-1]))
                found = [[[next(moved) for _ in p] for p in polygons] for polygons in found]
            yield pdf.assign(**{geom: [None if g is None else to_wkb(polygons) for g, polygons in zip(pdf[geom], found, strict=True)]})

    return layer.mapInPandas(run, layer.schema)


def area_system(crs: str | None, target: str = "equal-area") -> str:
    """The system that areas are measured in: the layer's own if it is projected, else ``target``."""
    if not crs:
        raise DataContractError("the layer has no coordinate system")
    if is_projected(crs):
        return crs
    if not is_projected(target):
        raise DataContractError(f"areas can't be measured in {target}")
    return target
