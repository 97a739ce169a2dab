"""Numbers and shared areas of boxes that meet, by sums over corners."""

import functools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspark.operators import box_sums as B
from cinderspark.operators import vectors as V

BOX = "minx {0}, miny {0}, maxx {0}, maxy {0}"


def by_pairs(s, p):
    """n and shared area of each row of ``s``: (year, minx, miny, maxx, maxy)."""
    wide, high = (np.minimum(s[:, None, k + 2], p[None, :, k + 2]) - np.maximum(s[:, None, k], p[None, :, k]) for k in (1, 2))
    meet = s[:, None, 0] == p[None, :, 0]
    for k in (1, 2):
        meet &= (s[:, None, k] <= p[None, :, k + 2]) & (s[:, None, k + 2] >= p[None, :, k])
    return meet.sum(1), (meet * np.maximum(wide, 0) * np.maximum(high, 0)).sum(1)


def boxes(rng, n, turned=0):
    lo = rng.integers(-20, 40, (n, 2))
    rows = np.concatenate((rng.integers(1, 3, (n, 1)), lo, lo + rng.integers(0, 15, (n, 2)) * rng.integers(0, 4, (n, 1))), axis=1)
    rows[:turned, 1], rows[:turned, 3] = rows[:turned, 3] + 1, rows[:turned, 1]
    return rows


@pytest.mark.parametrize("kind,cell,turned", [("bigint", None, 0), ("int", 6.5, 3), ("double", 6.5, 0), ("decimal(9,2)", None, 0)])
def test_sums_equal_those_of_pairs(spark, kind, cell, turned):
    rng = np.random.default_rng(5)
    s, p = boxes(rng, 150, turned), boxes(rng, 400, turned)
    n, area = by_pairs(s, p)
    layer = lambda rows, name: spark.createDataFrame([(f"{name}{i}", *map(int, r)) for i, r in enumerate(rows)] + [("null", 1, None, 0, 5, 5)], "fire_id string, year int, " + BOX.format("bigint"))
    cast = lambda df: df.select("fire_id", "year", *(F.col(c).cast(kind).alias(c) if kind != "double" else (F.col(c) / 10).alias(c) for c in V.BOX))
    found = {r["scar_id"]: (r["n_polygons"], float(r["shared"])) for r in V.scar_sums(cast(layer(s, "s")), cast(layer(p, "p")), cell=cell and cell / (10 if kind == "double" else 1)).collect()}
    want = {f"s{i}": (a, b / (100 if kind == "double" else 1)) for i, (a, b) in enumerate(zip(n.tolist(), area.tolist(), strict=True))} | {"null": (0, 0)}
    assert {k: (a, round(b, 9)) for k, (a, b) in found.items()} == {k: (a, round(b, 9)) for k, (a, b) in want.items()}


@pytest.mark.parametrize("thin,table", [(64, 4096), (0, 4096), (0, -(10**9))])
@pytest.mark.parametrize("kind", [np.int64, np.float64])
def test_a_cells_sums_by_pairs_tables_and_wavelets(monkeypatch, thin, table, kind):
    monkeypatch.setattr(B, "sums_below", functools.partial(B.sums_below, table=table))
    rng = np.random.default_rng(7)
    s, p = boxes(rng, 90), boxes(rng, 300)
    w, step = rng.integers(1, 4, len(p)), kind(200)
    n, area = by_pairs(np.c_[s[:, :1] * 0, s[:, 1:]], np.repeat(np.c_[p[:, :1] * 0, p[:, 1:]], w, axis=0))
    none = lambda rows: np.zeros((2, len(rows)), bool)
    got = B.cell_sums(np.zeros(len(p), int), p[:, 1:].T.astype(kind), w, none(p), np.zeros(len(s), int), s[:, 1:].T.astype(kind), none(s), np.full((2, len(s)), -60, kind), step, thin)
    assert got[0].tolist() == n.tolist() and got[1].tolist() == area.tolist()


def test_sums_make_no_pairs(spark, monkeypatch):
    """20,000 by 20,000 boxes of one place meet in 400 million pairs."""
    ids = spark.range(20000)
    layer = ids.select(F.col("id").cast("string").alias("fire_id"), F.lit(1).alias("year"), *(F.lit(v).cast("long").alias(c) for c, v in zip(V.BOX, (3, 4, 13, 9), strict=True)))
    found = V.scar_sums(layer, layer)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in found.groupBy("n_polygons", "shared").count().collect()] == [(20000, 20000 * 50, 20000)]


def test_pairs_of_a_polygon_follow_each_other(spark, tmp_path):
    """2 million pairs of 200,000 polygons, too many for a dictionary of ids: in runs they take no eight bytes each."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        box = [F.lit(v).cast("long").alias(c) for c, v in zip(V.BOX, (0, 0, 5, 5), strict=True)]
        scars = spark.range(10).select("id", F.concat(F.lit("F"), "id").alias("fire_id"), F.lit(1).alias("year"), F.lit(6000.0).alias("area_ha"), *box)
        polys = spark.range(200000).select(F.xxhash64("id").alias("id"), F.lit("r1").alias("region"), F.lit(1).alias("year"), F.lit("f").alias("file"), *box)
        V.scar_intersections(scars, polys, cell=10.0).select("scar_id", "poly_id").write.parquet(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.count() == found.distinct().count() == 2_000_000
    assert sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet")) < 2 * 2_000_000
