import json

import numpy as np
import pytest
import zstandard

from cinderspark.errors import DataContractError
from cinderspark.operators import crs
from cinderspark.operators import dissolve as D
from cinderspark.operators import geometry as G
from cinderspark.plans import inputs
from cinderspark.sources import geotiff, layers, sinks


def area_of(pieces):
    return float((pieces[:, 0] * pieces[:, 3] - pieces[:, 2] * pieces[:, 1]).sum() / 2)


def triangle(rng):
    while True:
        p = rng.random((3, 2)) * 10
        if abs(G.ring_area(np.r_[p, p[:1]])) > 1:
            return [[np.r_[p, p[:1]]]]


def test_union_of_two_is_sum_less_shared():
    rng = np.random.default_rng(0)
    for _ in range(40):
        a, b = triangle(rng), triangle(rng)
        whole = area_of(D.outline([a, b], (-1, -1, 11, 11)))
        assert whole == pytest.approx(G.area(a) + G.area(b) - G.shared_area(a, b), abs=1e-6)
        cut = [D.outline([a, b], (x, y, x + 3, y + 3)) for x in range(-1, 11, 3) for y in range(-1, 11, 3)]
        assert area_of(np.concatenate(cut)) == pytest.approx(whole, abs=1e-6)


def test_union_has_holes_and_touching_parts():
    ring = [G.rectangle(0, 0, 6, 2), G.rectangle(0, 4, 6, 6), G.rectangle(0, 0, 2, 6), G.rectangle(4, 0, 6, 6), G.rectangle(0, 0, 6, 2)]
    pieces = D.outline(ring, (-1, -1, 7, 7))
    made = G.polygons_of_rings(D.linked(pieces))
    assert area_of(pieces) == 32 and G.area(made) == 32 and len(made) == 1 and len(made[0]) == 2
    corner = G.polygons_of_rings(D.linked(D.outline([G.rectangle(0, 0, 1, 1), G.rectangle(1, 1, 2, 2)], (-1, -1, 3, 3))))
    assert G.area(corner) == 2 and len(corner) == 2
    hollow = [[G.rectangle(0, 0, 9, 9)[0][0], G.rectangle(3, 3, 6, 6)[0][0]]]
    assert area_of(D.outline([hollow, G.rectangle(4, 4, 5, 5)], (-1, -1, 10, 10))) == pytest.approx(73)


def test_union_by_key(spark):
    rows = [(1, 0, 0, 4, 4), (1, 2, 2, 6, 6), (1, 2, 2, 6, 6), (2, 0, 0, 1, 1), (None, 0, 0, 1, 1)]
    layer = inputs.boxes(spark.createDataFrame(rows, "k int, minx long, miny long, maxx long, maxy long")).select("k", "geom")
    none = layer.limit(1).selectExpr("k", "cast(null as binary) as geom")
    for most in (200, 1):
        got = D.union_outline(layer.unionByName(none), "k", 3.0, most=most).toPandas()
        assert {k: round(area_of(p[["x0", "y0", "x1", "y1"]].to_numpy()), 9) for k, p in got.groupby("k")} == {1: 28.0, 2: 1.0}
    united = {r["k"]: G.from_wkb(r["geom"]) for r in D.dissolve(layer, "k", 3.0).collect()}
    assert G.area(united[1]) == 28 and len(united[1][0][0]) == 9  # eight corners, closed
    assert D.dissolve(layer.where("false"), "k", 3.0).count() == 0
    with pytest.raises(DataContractError):
        D.union_outline(layer, "k", 0)


def test_systems_go_there_and_back():
    lon, lat = np.array([-70.5, -69.0, -72.2]), np.array([-33.0, -20.5, -53.0])
    for name in ("EPSG:32719", "EPSG:32718", "EPSG:32618", "EPSG:3857", "equal-area", "EPSG:4326"):
        x, y = crs.transform(lon, lat, "EPSG:4326", name)
        assert np.allclose(crs.transform(x, y, name, "EPSG:4326"), (lon, lat), atol=1e-7)
    for bad in ("EPSG:32799", "EPSG:1", None):
        with pytest.raises(DataContractError):
            crs.system(bad)


def packed(data):
    """The format's LZW, plainly."""
    table, out, width, word = {bytes([i]): i for i in range(256)}, "", 9, b""
    n = 258
    out += format(256, "09b")
    for b in data:
        more = word + bytes([b])
        if more in table:
            word = more
            continue
        out += format(table[word], f"0{width}b")
        table[more] = n
        n += 1
        word = bytes([b])
        if n == 1 << width:
            width += 1
    out += format(table[word], f"0{width}b")
    if n > (1 << width) - 2:
        width += 1
    out += format(257, f"0{width}b")
    return int(out.ljust(-(-len(out) // 8) * 8, "0"), 2).to_bytes(-(-len(out) // 8), "big")


def test_packed_blocks():
    data = bytes(np.random.default_rng(1).integers(0, 5, 3000).astype(np.uint8))
    assert geotiff.lzw(packed(data)) == data
    assert geotiff.UNPACK[50000](zstandard.ZstdCompressor().compress(data)) == data
    grid = np.random.default_rng(2).normal(size=(1, 20, 30)).astype("<f4")
    t = geotiff.Tiff(geotiff.encode(grid, block=32))
    t.predictor, t.packed = 3, 1
    x = np.zeros((32, 32), ">f4")
    x[:20, :30] = grid[0]
    planes = x.view(np.uint8).reshape(32, 32, 4).transpose(0, 2, 1).reshape(32, -1)
    raw = np.diff(planes, axis=1, prepend=np.zeros((32, 1), np.uint8)).astype(np.uint8).tobytes()
    t.data, t.tags = geotiff.Bytes(raw), {**t.tags, 324: (0,), 325: (len(raw),)}
    assert (t.window(0, 0, 20, 30, 0) == grid[0]).all()


def test_raster_is_written_block_by_block(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [("a", int(b), int(r), int(c), float(rng.integers(1, 9))) for b, r, c in {tuple(x) for x in np.stack([rng.integers(1, 3, 200), rng.integers(0, 70, 200), rng.integers(0, 90, 200)], 1).tolist()}]
    cells = spark.createDataFrame(rows, "raster_id string, band int, r int, c int, v double")
    got = geotiff.write(cells, str(tmp_path / "out"), 70, 90, block=16, crs="EPSG:32719").first()
    assert got["blocks"] == 2 * 5 * 6
    back = geotiff.cells(geotiff.read(spark, str(tmp_path / "out"), chunk=33)).where("v <> 0")
    assert sorted((x["band"], x["r"], x["c"], x["v"]) for x in back.collect()) == sorted(r[1:] for r in rows)
    assert geotiff.metadata(spark, str(tmp_path / "out")).first()["crs"] == "EPSG:32719"


def test_layer_sinks(spark, tmp_path):
    layer = inputs.boxes(spark.createDataFrame([("a", 1, 0, 0, 2, 1), ("a", 2, 1, 1, 3, 4), ("b", 3, 9, 9, 10, 10)], "name string, n int, minx int, miny int, maxx int, maxy int"))
    names = spark.createDataFrame([("a",), ("none",)], "name string")
    for extension in (".gpkg", ".geojson", ".shp"):
        folder = str(tmp_path / extension[1:])
        got = {r["file"]: r["n"] for r in layers.write_layers(layer, folder, "name", ["n"], extension, "EPSG:32719", names).collect()}
        assert got == {f"a{extension}": 2, f"none{extension}": 0}
        back = G.measured(layers.read_layer(spark, f"{folder}/a{extension}")).collect()
        assert sorted((int(json.loads(r["properties"])["n"]), r["area_m2"], r["crs"]) for r in back) == [(1, 2.0, "EPSG:32719"), (2, 6.0, "EPSG:32719")]
        assert layers.read_layer(spark, f"{folder}/none{extension}").count() == 0
        assert layers.read_layer(spark, f"{folder}/a{extension}", bbox=(2.5, 2.0, 9, 9)).count() == 1


def test_log_and_sizes(spark, tmp_path):
    log = spark.createDataFrame([(2, "INFO", "second"), (1, "WARN", "first")], "at int, level string, message string")
    sinks.write_log(log, f"{tmp_path}/log", "header")
    lines = [r["value"] for r in spark.read.text(f"{tmp_path}/log").collect()]
    assert sorted(lines)[0] == "header" and [json.loads(x)["message"] for x in lines if x != "header"] == ["first", "second"]
    files = spark.createDataFrame([("a", 10_485), ("b", 10_486)], "name string, size long")
    assert [r["name"] for r in sinks.large_enough(files).collect()] == ["b"]
