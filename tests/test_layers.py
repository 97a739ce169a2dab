import json
import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, EmptyInputError
from cinderspark.functions import naming as N
from cinderspark.operators import areas as A
from cinderspark.operators import catalog as K
from cinderspark.operators import crs
from cinderspark.operators import geometry as G
from cinderspark.operators import vectors as V
from cinderspark.operators.graph import connected_components
from cinderspark.sources import geotiff, layers, tables


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first()["x"]


def test_names(spark):
    s = F.col("s")
    assert one(spark, N.year_of_stem(s), s="b14_x_r2_2017_2020") == 2017 and one(spark, N.year_of_stem(s), s="x1999") is None
    with pytest.raises(PySparkException):
        one(spark, N.required_year(s), s="none")
    assert one(spark, N.region_of_stem(s), s="a_r4_b_r1_") == "4" and one(spark, N.region_of_stem(s), s="a_r12_b_r1_") is None
    assert one(spark, N.is_training_file(s, "v1", "r2"), s="samples_v1_foo_r2_bar.tif") and not one(spark, N.is_training_file(s, "v1", "r2"), s="x_v1_r2_y.tif")
    assert one(spark, N.sample_model_id(s), s="samples_v3_a_r5_b_2018.tif") == "v3_r5"
    assert one(spark, N.scar_name(F.lit("F1"), F.lit(2.5), F.lit(2017)), s="") == "F1_2ha_2017"
    assert one(spark, N.mask_name(s, F.lit(1.5)), s="a") == "a_mask1"
    assert [one(spark, N.tick_label(F.lit(x)), s="") for x in (12345.6, 12.4, 0.25)] == ["12,346", "12", "0.25"]
    assert N.parse_years(" 2001,,2003 ") == [2001, 2003]
    with pytest.raises(DataContractError):
        N.parse_years(" , ")


def test_dates(spark):
    s = F.col("s")
    assert one(spark, N.iso_or_prefix_year(s), s=" 2017-02-03T10:00 ") == 2017 and one(spark, N.iso_or_prefix_year(s), s="2017/02") == 2017
    for bad in ("", "spring"):
        with pytest.raises(PySparkException):
            one(spark, N.iso_or_prefix_year(s), s=bad)
    assert one(spark, N.coerced_year(s), s="NaT") is None and one(spark, N.coerced_year(s), s="2019/01/05") == 2019
    assert one(spark, N.prefix_year(s), s="2016xyz") == 2016
    start, end = N.year_bounds_ms(F.lit(1970))
    assert one(spark, start, s="") == 0 and one(spark, end, s="") == 364 * 86_400_000


def test_areas(spark):
    df = spark.createDataFrame([(5000.0,), (5000.5,), (float("nan"),), (0.0,), (float("inf"),)], "area_ha double")
    assert A.at_least(df, 5000).count() == 3 and A.larger_than(df).count() == 2 and A.positive(df).count() == 2
    edges = A.log_edges(0.09, 123.4, 40)
    assert len(edges) == 40 and edges[0] == 0.09 and edges[-1] == 123.4
    h = A.histogram(df, 5)
    assert sum(r["n"] for r in h.collect()) == 2
    assert A.histogram(df.where("area_ha = 5000"), 5).collect()[0]["n"] == 1
    assert A.threshold(None, json.dumps({"threshold_recommendations": {"rule_score_threshold_ha": 3}}), "score") == 3
    for bad in (lambda: A.threshold(-1), lambda: A.threshold(None), lambda: A.threshold(None, "{}"), lambda: A.larger_than(df, 1, "other"), lambda: A.histogram(df.where("false"))):
        with pytest.raises(DataContractError):
            bad()


def test_geometry():
    box = G.rectangle(0, 0, 4, 3)
    hole = [[box[0][0], G.rectangle(1, 1, 2, 2)[0][0]]]
    assert G.area(box) == 12 and G.area(hole) == 11 and G.area(G.from_wkb(G.to_wkb(hole))) == 11
    assert G.shared_area(hole, G.rectangle(1, 1, 3, 2)) == pytest.approx(1)
    assert G.meet(box, G.rectangle(4, 3, 5, 5)) and not G.meet(box, G.rectangle(4.1, 0, 5, 5)) and G.meet(box, G.rectangle(1, 1, 2, 2))
    assert G.from_wkb(None) == [] and G.bounds([]) is None
    rng = np.random.default_rng(1)
    for _ in range(20):
        a, b = (np.sort(rng.random((2, 2)) * 10, axis=0) for _ in range(2))
        want = np.prod(np.maximum(np.minimum(a[1], b[1]) - np.maximum(a[0], b[0]), 0))
        assert G.shared_area(G.rectangle(*a[0], *a[1]), G.rectangle(*b[0], *b[1])) == pytest.approx(want, abs=1e-9)
    star = [[np.array([[math.cos(t) * r, math.sin(t) * r] for t, r in zip(np.linspace(0, 2 * math.pi, 11), [3, 1] * 5 + [3], strict=True)])]]
    assert G.shared_area(star, G.rectangle(-9, -9, 9, 9)) == pytest.approx(G.area(star))
    points = rng.random((200, 2))
    ring = G.hull(points)
    assert (G.within_distance([[ring]], points, 1e-9)).all()


def test_spatial_join_equals_all_pairs(spark):
    rng = np.random.default_rng(5)

    def layer(n, kind):
        rows = []
        for i in range(n):
            x, y = (int(v) for v in rng.integers(0, 60, 2))
            rows.append((i, int(rng.integers(0, 2)), x, y, x + int(rng.integers(0, 20)), y + int(rng.integers(0, 20)), kind))
        return spark.createDataFrame(rows, "id long, year int, minx long, miny long, maxx long, maxy long, kind string")

    a, b = layer(40, "scar"), layer(60, "poly")
    pairs = {(r["l_id"], r["r_id"]) for r in V.spatial_join(a, b, ["year"], 8, "left").collect()}
    got = V.spatial_join(a, b, ["year"], 8).count()
    want = {(x["id"], y["id"]) for x in a.collect() for y in b.collect() if x["year"] == y["year"] and x["minx"] <= y["maxx"] and x["maxx"] >= y["minx"] and x["miny"] <= y["maxy"] and x["maxy"] >= y["miny"]}
    alone = {(x["id"], None) for x in a.collect()} - {(i, None) for i, _ in want}
    assert pairs == want | alone and got == len(want)


def test_layer_rules(spark):
    regions = spark.createDataFrame([("5", 0), ("1", 1), (None, 2)], "region string, k int")
    assert {r["k"] for r in V.exclude_region(regions).collect()} == {1, 2}
    with pytest.raises(DataContractError):
        V.same_crs("EPSG:4326", None)
    wkb = [(i, bytearray(G.to_wkb(G.rectangle(i, 0, i + 1, 2)))) for i in range(4)] + [(9, None)]
    df = spark.createDataFrame(wkb, "id long, geom binary")
    m = {r["id"]: r for r in G.measured(df).collect()}
    assert m[0]["area_m2"] == 2 and m[3]["maxx"] == 4 and m[9]["area_m2"] == 0
    assert G.area(G.from_wkb(G.convex_hull(df).first()["geom"])) == 8
    both = G.collect_parts(df.withColumn("year", F.lit(2001)), "year").first()
    assert both["n_parts"] == 4 and G.area(G.from_wkb(both["geom"])) == 8 and G.parts(df).count() == 4


def test_projections():
    lon, lat = np.array([-69.0, -71.5, -67.2]), np.array([-33.0, -20.0, -54.0])
    x, y = crs.utm(lon, lat)
    assert x[0] == pytest.approx(500_000) and np.allclose(crs.utm_inverse(x, y), (lon, lat), atol=1e-8)
    # a small cell keeps its area on the ellipsoid
    d = 1e-3
    for a, b in ((-71.0, -37.0), (-68.0, -20.0), (-73.0, -50.0)):
        ring = np.array([[a, b], [a + d, b], [a + d, b + d], [a, b + d], [a, b]])
        m = crs.AXIS * (1 - crs.E2) / (1 - crs.E2 * math.sin(math.radians(b + d / 2)) ** 2) ** 1.5
        n = crs.AXIS / math.sqrt(1 - crs.E2 * math.sin(math.radians(b + d / 2)) ** 2)
        want = m * math.radians(d) * n * math.cos(math.radians(b + d / 2)) * math.radians(d)
        assert abs(G.ring_area(np.stack(crs.albers(ring[:, 0], ring[:, 1]), 1))) == pytest.approx(want, rel=1e-5)
    with pytest.raises(DataContractError):
        crs.area_system(None)


def test_geotiff(spark, tmp_path):
    rng = np.random.default_rng(2)
    for kind in ("uint8", "int16", "float32"):
        grid = rng.integers(0, 100, (2, 300, 270)).astype(kind)
        t = geotiff.Tiff(geotiff.encode(grid, (30, 0, 1000, 0, -30, 2000), "EPSG:32719", 0, ["nbr", "landcover"]))
        assert (t.window(250, 200, 50, 70, 1) == grid[1, 250:, 200:]).all() and t.names() == ["nbr", "landcover"]
        assert t.crs == "EPSG:32719" and t.nodata == 0 and t.transform == (30, 0, 1000, 0, -30, 2000)
    cells = spark.createDataFrame([("a", 1, 2, 7.0), ("b", 0, 0, 9.0)], "raster_id string, r int, c int, v double")
    folder = f"file:{tmp_path}/out"
    assert geotiff.write(cells, folder, 4, 5).count() == 2
    back = geotiff.cells(geotiff.read(spark, folder, chunk=2)).where("v <> 0")
    assert {(x["raster_id"], x["r"], x["c"], x["v"]) for x in back.collect()} == {("a", 1, 2, 7.0), ("b", 0, 0, 9.0)}
    assert geotiff.metadata(spark, folder).first()["width"] == 5


def test_layer_files(spark, tmp_path):
    wkb = G.to_wkb(G.rectangle(0, 0, 2, 1))
    (tmp_path / "a.gpkg").write_bytes(layers.write_gpkg([({"FireID": "x", "n": 3}, wkb), ({"FireID": "y"}, None)], "EPSG:32719"))
    got = layers.read_layer(spark, f"{tmp_path}/a.gpkg", schema="FireID string, n int").collect()
    assert {(r["FireID"], r["n"], r["crs"]) for r in got} == {("x", 3, "EPSG:32719"), ("y", None, "EPSG:32719")}
    (tmp_path / "e.gpkg").write_bytes(layers.write_gpkg([]))
    assert layers.read_layer(spark, f"{tmp_path}/e.gpkg").count() == 0
    (tmp_path / "b.geojson").write_text(layers.box_feature("hull", "5", "s", (0, 1, 2, 3)))
    row = layers.read_layer(spark, f"{tmp_path}/b.geojson").first()
    assert G.bounds(G.from_wkb(row["geom"])) == (0, 1, 2, 3) and json.loads(row["properties"])["exclude_region"] == "5"
    with pytest.raises(DataContractError):
        layers.format_of("a.kml")


def test_catalog(spark, tmp_path):
    with pytest.raises((EmptyInputError, PySparkException)):
        K.files(spark, str(tmp_path), "*.tif").count()
    lines = spark.createDataFrame([(0, "model,mosaic"), (1, " m1 , b14.tif\r,extra"), (2, ",")], "i long, line string")
    assert tuple(K.job_row(lines, 0, True).first()) == ("m1", "b14.tif")
    with pytest.raises(DataContractError):
        K.job_row(lines, 1, True)
    assert K.jobs(spark, ["r1", "r2"], 2013, 2025).count() == 26


def test_connected_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (10, 11), (7, 7), (None, 3), (11, 10)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10}
    assert connected_components(edges.where("false")).count() == 0
    chain = spark.range(200).selectExpr("id + 1 as a", "id as b")
    assert {r["component"] for r in connected_components(chain).collect()} == {0}


def test_shared_tables(spark):
    t = tables.written(spark.range(5), "t")
    assert t.count() == 5 and tables.shared_dir(spark) in t.inputFiles()[0]
