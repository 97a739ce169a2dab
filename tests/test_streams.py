"""Files of many features, read and written one by one; sums of pairs without the pairs."""

import io
import json
import os

import pytest

from cinderspark.operators import geometry as G
from cinderspark.operators import vectors as V
from cinderspark.plans import inputs
from cinderspark.sources import layers


def test_collections_are_read_feature_by_feature(monkeypatch):
    monkeypatch.setattr(layers, "CHUNK", 1000)
    shape = G.to_wkb(G.rectangle(0, 0, 2, 1))
    whole = layers.to_geojson([({"n": i, "s": "é" * (i % 7)}, shape if i % 3 else None) for i in range(400)], "EPSG:32719")
    read = []

    class Counted(io.BytesIO):
        def read(self, n=-1):
            read.append(n)
            return super().read(n)

    found = layers._geojson(lambda: Counted(whole), None)
    next(found)
    assert sum(read) < len(whole) / 10
    assert [json.loads(p)["n"] for p, _, _ in found] == list(range(1, 400))
    late = json.loads(whole)
    late["crs"] = late.pop("crs")
    rows = list(layers._geojson(lambda: io.BytesIO(json.dumps(late, indent=1).encode("utf-8-sig")), None))
    assert len(rows) == 400 and {c for *_, c in rows} == {"EPSG:32719"} and rows[1][1] == shape and rows[0][1] is None
    with pytest.raises(ValueError):
        list(layers._geojson(lambda: io.BytesIO(whole[:-500]), None))


@pytest.mark.parametrize("extension", [".gpkg", ".geojson"])
def test_large_and_small_files(spark, tmp_path, extension):
    rows = [(f"f {i % 3}" if i < 6000 else "small", i, i % 90, 0, i % 90 + 1, 2) for i in range(6001)]
    layer = inputs.boxes(spark.createDataFrame(rows, "name string, n int, minx int, miny int, maxx int, maxy int"))
    got = {r["file"]: r["n"] for r in layers.write_layers(layer, str(tmp_path / "out"), "name", ["n"], extension, "EPSG:32719").collect()}
    assert got == {f"f {k}{extension}": 2000 for k in range(3)} | {f"small{extension}": 1}
    assert sorted(os.listdir(tmp_path / "out")) == sorted(got) or all(n in got or n.startswith(".") and n.endswith(".crc") for n in os.listdir(tmp_path / "out"))
    back = G.measured(layers.read_layer(spark, f"{tmp_path}/out/*{extension}", schema="n int")).collect()
    assert sorted(r["n"] for r in back) == list(range(6001)) and {(r["area_m2"], r["crs"]) for r in back} == {(2.0, "EPSG:32719")}
    assert os.path.getsize(tmp_path / "out" / f"small{extension}") <= 8192


def test_sums_of_scars_equal_those_of_pairs(spark):
    box = "minx long, miny long, maxx long, maxy long"
    scars = spark.createDataFrame([("a", 1, 0, 0, 10, 10), ("a", 1, 50, 50, 60, 60), (None, 1, 5, 5, 30, 30), ("far", 1, 900, 900, 901, 901), ("other year", None, 0, 0, 9, 9)], f"fire_id string, year int, {box}")
    polys = spark.createDataFrame([(1, 10, 10, 12, 12), (1, 4, 4, 8, 40), (1, 55, 0, 56, 99), (2, 0, 0, 99, 99)], f"year int, {box}")
    found = V.scar_sums(scars, polys, cell=7.0)
    assert {r["scar_id"]: (r["n_polygons"], r["shared"]) for r in found.collect()} == {"a": (3, 34), None: (2, 79), "far": (0, 0), "other year": (0, 0)}
