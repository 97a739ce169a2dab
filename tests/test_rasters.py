import numpy as np
import pytest
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, EmptyInputError, MissingInputError
from cinderspark.operators import components as C
from cinderspark.operators import geometry as G
from cinderspark.operators import masks as M
from cinderspark.operators import mlp as P
from cinderspark.operators import morphology as X


def cells_of(spark, grid, y=1):
    r, c = np.nonzero(grid)
    return spark.createDataFrame([(y, int(a), int(b)) for a, b in zip(r, c, strict=True)], "y int, r int, c int")


def grid_of(df, shape):
    out = np.zeros(shape, bool)
    for row in df.collect():
        out[row["r"], row["c"]] = True
    return out


def step(grid, k, erosion):
    h, w = grid.shape
    at = lambda r, c: 0 <= r < h and 0 <= c < w and grid[r, c]
    offsets = range(-(k // 2), k - k // 2) if erosion else range(-(k // 2 - 1) if k % 2 == 0 else -(k // 2), k // 2 + 1)
    how = all if erosion else any
    return np.array([[how(at(r + i, c + j) for i in offsets for j in offsets) for c in range(w)] for r in range(h)])


@pytest.mark.parametrize("k", [2, 3, 4])
def test_morphology_equals_brute_force(spark, k):
    grid = np.random.default_rng(k).random((14, 17)) < 0.7
    cells = cells_of(spark, grid)
    assert (grid_of(X.erode(cells, k, 14, 17), grid.shape) == step(grid, k, True)).all()
    assert (grid_of(X.dilate(cells, k, 14, 17), grid.shape) == step(grid, k, False)).all()
    assert (X.dense(grid, k, True) == step(grid, k, True)).all() and (X.dense(grid, k, False) == step(grid, k, False)).all()
    opened = step(step(grid, k, True), k, False)
    assert not (opened & ~grid).any()


def test_opening_then_closing_on_tiles_and_border(spark):
    grid = np.random.default_rng(7).random((30, 37)) < 0.75
    want = step(step(step(step(grid, 2, True), 2, False), 4, False), 4, True)
    cells = cells_of(spark, grid)
    assert (grid_of(X.spatial_filter(cells, 30, 37), grid.shape) == want).all()
    assert (grid_of(X.spatial_filter_tiles(cells, 30, 37, tile=8), grid.shape) == want).all()
    full = grid_of(X.closing(cells_of(spark, np.ones((8, 8), bool)), 4, 8, 8), (8, 8))
    assert not full[:2].any() and not full[:, :2].any() and not full[-1].any() and full[2:-1, 2:-1].all()


def flood(grid, diagonal):
    seen, out = {}, []
    for start in zip(*np.nonzero(grid), strict=True):
        if start in seen:
            continue
        stack, part = [start], set()
        while stack:
            r, c = stack.pop()
            if (r, c) in seen or not (0 <= r < grid.shape[0] and 0 <= c < grid.shape[1]) or not grid[r, c]:
                continue
            seen[r, c] = True
            part.add((int(r), int(c)))
            stack += [(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i or j) and (diagonal or not (i and j))]
        out.append(frozenset(part))
    return set(out)


@pytest.mark.parametrize("connectivity", [4, 8])
def test_components_and_outlines(spark, connectivity):
    grid = np.random.default_rng(3).random((20, 23)) < 0.5
    labelled = C.components(cells_of(spark, grid), 20, 23, connectivity, tile=6).cache()
    got = {}
    for row in labelled.collect():
        got.setdefault(row["component"], set()).add((row["r"], row["c"]))
    assert {frozenset(v) for v in got.values()} == flood(grid, connectivity == 8)
    assert all(k == min(23 * r + c for r, c in v) + 23 * 20 for k, v in got.items())
    traced = C.outlines(labelled, (10, 0, 100, 0, -10, 500), connectivity).collect()
    assert {x["component"]: round(G.area(G.from_wkb(x["geom"]))) for x in traced} == {k: 100 * len(v) for k, v in got.items()}


def test_ring_has_one_hole(spark):
    grid = np.ones((5, 5), bool)
    grid[1:4, 1:4] = False
    (row,) = C.outlines(C.components(cells_of(spark, grid), 5, 5)).collect()
    polygons = G.from_wkb(row["geom"])
    assert len(polygons) == 1 and len(polygons[0]) == 2 and G.area(polygons) == 16


def test_masks(spark):
    cover = spark.createDataFrame([(0, 0, 1, 18), (0, 0, 2, 18), (0, 1, 1, 18), (0, 2, 1, 29), (0, 2, 2, 3), (1, 1, 1, 33)], "r int, c int, y int, cls int")
    assert [(x["r"], x["c"]) for x in M.temporal_and(cover, 2).collect()] == [(0, 0)]
    total = {(x["y"], x["r"], x["c"]) for x in M.total_mask_of_cover(cover, 2).collect()}
    assert total == {(1, 0, 0), (2, 0, 0), (1, 0, 2), (2, 0, 2), (1, 1, 1)}
    burnt = spark.createDataFrame([(0, 0, 1, 1), (0, 2, 1, 0), (1, 1, 2, 1), (1, 1, 1, 1)], "r int, c int, y int, v int")
    report = {x["y"]: x.asDict() for x in M.filter_report(M.fill_masked(burnt, M.total_mask_of_cover(cover, 2))).collect()}
    assert report[1] == {"y": 1, "total_pixels": 3, "masked_pixels": 3, "pixels_filtered_to_zero": 2} and report[2]["pixels_filtered_to_zero"] == 0
    with pytest.raises(MissingInputError, match="2"):
        M.require_masks(burnt, [1])
    for bad in (lambda: M.fill_masked(burnt, cover.select("y", "r", "c"), 300), lambda: M.window_grid(5, 5, 0), lambda: M.year_range(3, 2), lambda: M.band_of_year(1999, 2000, 3)):
        with pytest.raises(DataContractError):
            bad()
    assert M.window_grid(5, 3, 2)[-1] == (4, 2, 1, 1) and M.band_of_year(2001, 2000, 3) == 2


def test_network_agrees_with_batches_and_learns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + x[:, 1] > 0).astype(int)
    net, acc = P.fit_network(x, y, steps=400)
    assert acc > 0.9
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x[:50])], "id long, b array<double>")
    z = df.withColumn("b", P.standardise(F.col("b"), list(net.mean), list(net.std)))
    layers = [(w.tolist(), b.tolist()) for w, b in net.layers]
    a = {r["id"]: r["pred"] for r in P.predict(z, layers).collect()}
    b = {r["id"]: r["pred"] for r in P.predict_batches(df, net).collect()}
    assert a == b
    h = P.predict_batches(df, net, depth=5).first()["embedding"]
    assert len(h) == 7
    assert P.network_of(P.hyperparameters(net, "landcover", 3), net.layers).run(x[:5]).shape == (5, 2)
    with pytest.raises(EmptyInputError):
        P.network_of("{}", [])
    with pytest.raises(DataContractError):
        net.run(np.zeros((2, 5)))
    with pytest.raises(EmptyInputError):
        P.fit_network(np.full((4, 2), np.nan), np.zeros(4))


def test_pixel_rules(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(0, [nan, nan]), (1, [nan, 2.0]), (2, [1.0, inf])], "id int, b array<double>")
    row = {r["id"]: r for r in df.select("id", P.any_valid(F.col("b")).alias("a"), P.all_valid(F.col("b")).alias("z"), P.nan_to_number(F.col("b")).alias("n")).collect()}
    assert [row[i]["a"] for i in range(3)] == [False, True, True] and [row[i]["z"] for i in range(3)] == [False, False, True]
    assert row[1]["n"] == [0.0, 2.0] and row[2]["n"][1] == P.FLOAT_MAX
    ranked = P.split_rank(spark.range(90).withColumnRenamed("id", "k"), [F.col("k")])
    assert ranked.where("train").count() == 62
    assert P.band_stats(spark.createDataFrame([([5.0],), ([5.0],)], "b array<double>")).first()["std"] == 1.0
