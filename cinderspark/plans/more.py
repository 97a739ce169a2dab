"""Further queries of the inventory: files written and read back, geometries, names, catalogues and small raster steps."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from cinderspark.functions import naming as N
from cinderspark.operators import areas as A
from cinderspark.operators import catalog as K
from cinderspark.operators import crs as R
from cinderspark.operators import dissolve as D
from cinderspark.operators import geometry as G
from cinderspark.operators import masks as M
from cinderspark.operators import mlp as P
from cinderspark.operators import vectors as V
from cinderspark.plans import inputs as I
from cinderspark.plans.inputs import with_
from cinderspark.plans.registry import _NET, _PX, LAYERS, _pixels, longs, query
from cinderspark.sources import geotiff, layers, sinks, tables

# --- rasters in files ------------------------------------------------------------------------------------------------------


def _rasters(spark, d):
    """The classified rasters of all years as files; the folder."""
    path = tables.new_path(spark, "tiff")
    cells = I.classified(spark, d).select(F.concat(F.lit("y"), F.col("y").cast("string")).alias("raster_id"), "r", "c", F.col("v").cast("double").alias("v"))
    geotiff.write(cells, path, 64, 64, crs="EPSG:32719", transform=(30, 0, 500000, 0, -30, 6000000), block=16)
    return path


_YEARS = "SELECT DISTINCT 'y' || CAST(y AS VARCHAR) AS raster_id"


@query("tiff_metadata", with_("cls") + _YEARS + """, 'GTiff' AS driver, CAST(64 AS BIGINT) AS width, CAST(64 AS BIGINT) AS height, CAST(1 AS BIGINT) AS count, 'uint8' AS dtype, 0::DOUBLE AS nodata, 'EPSG:32719' AS crs,
  30::DOUBLE AS res, 500000::DOUBLE AS minx, (6000000 - 64 * 30)::DOUBLE AS miny, 'band_0' AS band FROM cls""")
def _(spark, d):
    m = geotiff.metadata(spark, _rasters(spark, d))
    return longs(m.select("raster_id", "driver", "width", "height", "count", "dtype", "nodata", "crs", F.col("res")[0].alias("res"), F.col("bounds")[0].alias("minx"), F.col("bounds")[1].alias("miny"), F.col("names")[0].alias("band")))


@query("tiff_windows", with_("cls") + """SELECT 'y' || CAST(y AS VARCHAR) AS raster_id, CAST(r0 AS BIGINT) AS r0, CAST(c0 AS BIGINT) AS c0, CAST(least(20, 64 - r0) AS BIGINT) AS h, CAST(least(20, 64 - c0) AS BIGINT) AS w,
  CAST((SELECT coalesce(sum(v), 0) FROM cls k WHERE k.y = a.y AND r // 20 = r0 // 20 AND c // 20 = c0 // 20) AS BIGINT) AS cells FROM (SELECT DISTINCT y FROM cls) a, range(0, 64, 20) b(r0), range(0, 64, 20) e(c0)""")
def _(spark, d):
    tiles = geotiff.read(spark, _rasters(spark, d), chunk=20)
    n = geotiff.cells(tiles).withColumn("r0", F.floor(F.col("r") / 20) * 20).withColumn("c0", F.floor(F.col("c") / 20) * 20).groupBy("raster_id", "r0", "c0").agg(F.sum("v").cast("long").alias("cells"))
    return longs(tiles.select("raster_id", F.col("r0").cast("long").alias("r0"), F.col("c0").cast("long").alias("c0"), "h", "w").join(n, ["raster_id", "r0", "c0"]))


@query("tiff_band", with_("cls") + "SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(1 + v AS BIGINT) AS v FROM cls WHERE y = (SELECT max(y) FROM cls)")
def _(spark, d):
    path = tables.new_path(spark, "tiff")
    cells = I.classified(spark, d)
    last = cells.agg(F.max("y").alias("y")).first()["y"]
    two = F.explode(F.array(F.struct(F.lit(1).alias("band"), F.lit(9.0).alias("v")), F.struct(F.lit(2).alias("band"), (1 + F.col("v")).cast("double").alias("v"))))
    geotiff.write(cells.where(F.col("y") == last).withColumn("x", two).select(F.lit("both").alias("raster_id"), "r", "c", "x.band", "x.v"), path, 64, 64, dtype="float32")
    return longs(geotiff.cells(geotiff.read(spark, path, bands=[2])).where("v <> 0").select("r", "c", F.col("v").cast("long").alias("v")))


@query("masks_by_window", with_("lulc", "lasting") + "SELECT 'mask_' || CAST(y AS VARCHAR) AS raster_id, CAST(count(*) AS BIGINT) AS cells FROM mask GROUP BY y")
def _(spark, d):
    path = tables.new_path(spark, "masks")
    mask = M.total_mask_of_cover(I.cover(spark, d), I.YEARS)
    geotiff.write(mask.select(F.concat(F.lit("mask_"), F.col("y").cast("string")).alias("raster_id"), "r", "c", F.lit(1.0).alias("v")), path, 64, 64, block=16)
    return geotiff.cells(geotiff.read(spark, path, chunk=16)).groupBy("raster_id").agg(F.sum("v").cast("long").alias("cells"))


@query("mosaic_file", "SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(v AS BIGINT) AS v FROM (SELECT l_partkey % 64 AS r, l_suppkey % 64 AS c, arg_max(l_linenumber + l_orderkey % 50, l_orderkey * 10 + l_linenumber) AS v FROM lineitem WHERE l_linenumber + l_orderkey % 50 <> 7 GROUP BY 1, 2)")
def _(spark, d):
    path = tables.new_path(spark, "mosaic")
    scenes = I.table(spark, d, "lineitem").select((F.col("l_partkey") % 64).alias("r"), (F.col("l_suppkey") % 64).alias("c"), (F.col("l_linenumber") + F.col("l_orderkey") % 50).alias("v"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
    geotiff.write(M.mosaic_last(scenes, nodata=7).withColumn("raster_id", F.lit("mosaic")), path, 64, 64, dtype="int16", block=16)
    return longs(geotiff.cells(geotiff.read(spark, path)).where("v <> 0").select("r", "c", F.col("v").cast("long").alias("v")))


@query("embedding_file", _PX + "SELECT vec_id AS id, CAST(b AS BIGINT) AS band, round(CAST(CAST(embedding[b] AS FLOAT) AS DOUBLE), 5) AS v FROM pixels, range(1, 9) t(b) WHERE embedding[b] <> 0")
def _(spark, d):
    path = tables.new_path(spark, "embedding")
    x = I.samples(spark, d).select("id", F.posexplode("b").alias("i", "v"))
    placed = x.select(F.lit("e").alias("raster_id"), F.floor(F.col("id") / 512).alias("r"), (F.col("id") % 512).alias("c"), (F.col("i") + 1).alias("band"), "v")
    height = int(x.agg(F.max("id").alias("m")).first()["m"]) // 512 + 1
    geotiff.write(placed, path, height, 512, dtype="float32", nodata=None)
    back = geotiff.cells(geotiff.read(spark, path, chunk=512)).where("v <> 0")
    return back.select((F.col("r") * 512 + F.col("c")).cast("long").alias("id"), F.col("band").cast("long").alias("band"), F.round("v", 5).alias("v"))


@query("raster_files", with_("cls") + "SELECT DISTINCT 'y' || CAST(y AS VARCHAR) || '.tif' AS name, 'y' || CAST(y AS VARCHAR) AS stem, true AS verified FROM cls")
def _(spark, d):
    found = K.files(spark, _rasters(spark, d), "*.tif", recursive=True)
    return found.join(sinks.large_enough(found, 0.0001).select("path").withColumn("verified", F.lit(True)), "path", "left").select("name", "stem", "verified")


@query("clip_scene", with_("cls") + "SELECT CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(v AS BIGINT) AS v FROM cls WHERE y = (SELECT min(y) FROM cls) AND pow(greatest(10 - (c + 0.5::DOUBLE), (c + 0.5::DOUBLE) - 40, 0), 2) + pow(greatest(5 - (r + 0.5::DOUBLE), (r + 0.5::DOUBLE) - 30, 0), 2) <= 9")
def _(spark, d):
    cells = I.classified(spark, d)
    first = cells.agg(F.min("y").alias("y")).first()["y"]
    scene = G.to_wkb(G.rectangle(10, 5, 40, 30))
    clipped = G.clip_cells(cells.where(F.col("y") == first).select("r", "c", F.col("v").cast("double").alias("v")), scene, (1, 0, 0, 0, 1, 0), buffer=3.0)
    return longs(clipped.where(~F.isnan("v")).select("r", "c", F.col("v").cast("long").alias("v")))


@query("raster_lines", _PX + "SELECT vec_id // 512 AS r, CAST(count(*) AS BIGINT) AS w, round(sum(embedding[1]), 4) AS total FROM pixels GROUP BY 1")
def _(spark, d):
    x = I.samples(spark, d).select(F.lit(1).alias("raster_id"), F.floor(F.col("id") / 512).alias("r"), (F.col("id") % 512).alias("c"), F.col("b")[0].alias("v"))
    lines = P.devectorise(x)
    return longs(lines.select("r", "w", F.round(F.aggregate("values", F.lit(0.0), lambda a, v: a + v), 4).alias("total")))


@query("cell_flags", with_("lulc") + "SELECT CAST(lulc.y AS BIGINT) AS y, CAST(lulc.y - 1992 + 1 AS BIGINT) AS band, CAST(sum(CASE WHEN cls = 33 THEN 1 ELSE 0 END) AS BIGINT) AS rivers, CAST(sum(CASE WHEN cls - 20 > 0 THEN 1 ELSE 0 END) AS BIGINT) AS above FROM lulc GROUP BY lulc.y")
def _(spark, d):
    cover = I.cover(spark, d)
    years = [(r["y"], M.band_of_year(r["y"], 1992, 15)) for r in cover.select("y").distinct().collect()]
    counted = cover.groupBy("y").agg(F.sum(M.equals(F.col("cls"), 33)).alias("rivers"), F.sum(M.binarise(F.col("cls") - 20)).alias("above"))
    return longs(counted.join(spark.createDataFrame(years, "y int, band int"), "y").select("y", "band", "rivers", "above"))


@query("tile_masks", with_("lulc", "lasting", "cls") + "SELECT CAST(y AS BIGINT) AS y, tiles, masks FROM (SELECT y, count(*) AS tiles FROM cls GROUP BY 1) JOIN (SELECT y, count(*) AS masks FROM mask GROUP BY 1) USING (y)")
def _(spark, d):
    mask = M.total_mask_of_cover(I.cover(spark, d), I.YEARS)
    masks = mask.groupBy("y").agg(F.count("*").alias("masks"))
    tiles = M.require_masks(I.classified(spark, d), [r["y"] for r in masks.select("y").collect()])
    return longs(tiles.groupBy("y").agg(F.count("*").alias("tiles")).join(masks, "y"))


@query("any_set_years", with_("cls") + "SELECT CAST(y AS BIGINT) AS y, bool_or(v <> 0) AS any FROM cls GROUP BY 1")
def _(spark, d):
    cells = I.classified(spark, d)
    found = [(r["y"], A.any_set(cells.where(F.col("y") == r["y"]))) for r in cells.select("y").distinct().collect()]
    return longs(spark.createDataFrame(found, "y int, any boolean"))


@query("window_counts", "SELECT p_partkey AS raster_id, CAST(ceil((30 + p_size) / 20::DOUBLE) * ceil((45 + p_partkey % 50) / 20::DOUBLE) AS BIGINT) AS blocks FROM part")
def _(spark, d):
    rasters = I.table(spark, d, "part").select(F.col("p_partkey").alias("raster_id"), (30 + F.col("p_size")).cast("int").alias("height"), (45 + F.col("p_partkey") % 50).cast("int").alias("width"))
    return M.windows(rasters, 20).groupBy("raster_id").agg(F.count("*").alias("blocks"))


# --- layers in files -------------------------------------------------------------------------------------------------------


def _polygon_files(spark, d, extension):
    path = tables.new_path(spark, "layers")
    layers.write_layers(I.boxes(I.polys(spark, d)), path, "file", ["id", "region", "year"], extension, "EPSG:32719")
    return path


_BY_FILE = """SELECT file || '{0}' AS source_file, count(*) AS n, CAST(sum(id) AS BIGINT) AS ids, CAST(sum((maxx - minx) * (maxy - miny)) AS BIGINT) AS area, 'EPSG:32719' AS crs FROM polys GROUP BY 1"""
for _name, _extension in (("gpkg_files", ".gpkg"), ("geojson_files", ".geojson")):

    @query(_name, with_("polys") + _BY_FILE.format(_extension))
    def _(spark, d, extension=_extension):
        back = G.measured(layers.read_layer(spark, f"{_polygon_files(spark, d, extension)}/*{extension}", schema="id long, region string, year int"))
        return back.groupBy("source_file").agg(F.count("*").alias("n"), F.sum("id").alias("ids"), F.sum("area_m2").cast("long").alias("area"), F.first("crs").alias("crs"))


@query("shapefile_scars", with_("scars") + "SELECT count(*) AS n, CAST(sum((maxx - minx) * (maxy - miny)) AS BIGINT) AS area, 'EPSG:32719' AS crs, max(fire_id) AS last FROM scars WHERE area_ha > 5000")
def _(spark, d):
    path = tables.new_path(spark, "shapes")
    large = I.boxes(A.larger_than(I.scars(spark, d))).withColumn("name", F.lit("scars"))
    layers.write_layers(large, path, "name", ["fire_id", "year"], ".shp", "EPSG:32719")
    back = G.measured(layers.read_layer(spark, f"{path}/scars.shp", schema="fire_id string, year string"))
    return back.agg(F.count("*").alias("n"), F.sum("area_m2").cast("long").alias("area"), F.first("crs").alias("crs"), F.max("fire_id").alias("last"))


@query("bbox_scan", with_("polys") + "SELECT id FROM polys WHERE minx <= 300 AND maxx >= 200 AND miny <= 500 AND maxy >= 450")
def _(spark, d):
    path = _polygon_files(spark, d, ".gpkg")
    return layers.read_layer(spark, f"{path}/*.gpkg", schema="id long", bbox=(200, 450, 300, 500)).select("id")


@query("empty_files", with_("polys") + "SELECT file || '.gpkg' AS file, count(*) FILTER ((maxx - minx) * (maxy - miny) > 550) AS n FROM polys GROUP BY 1")
def _(spark, d):
    polys = I.polys(spark, d)
    large = I.boxes(polys.where("(maxx - minx) * (maxy - miny) > 550"))
    return layers.write_layers(large, tables.new_path(spark, "layers"), "file", ["id"], names=polys)


@query("merged_file", with_("polys") + "SELECT file AS source_file, count(*) AS n, 20::DOUBLE AS threshold_ha_used FROM polys WHERE (maxx - minx) * (maxy - miny) * 1000 / 10000.0::DOUBLE >= 20 GROUP BY 1")
def _(spark, d):
    path = tables.new_path(spark, "merged")
    large = A.with_threshold(I.boxes(I.polys(spark, d).withColumn("area_m2", ((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")) * 1000).cast("double"))).withColumnRenamed("file", "source_file"), 20)
    by_region = [large.where(F.col("region") == r) for r in ("r1", "r2", "r3", "r4", "r5", "r6")]
    layers.write_layers(V.union_layers(by_region).withColumn("name", F.lit("merged")), path, "name", ["id", "source_file", "area_ha", "threshold_ha_used"])
    told = F.from_json("properties", "source_file string, threshold_ha_used double").alias("p")
    return layers.read_layer(spark, f"{path}/merged.gpkg").select(told).select("p.*").groupBy("source_file").agg(F.count("*").alias("n"), F.first("threshold_ha_used").alias("threshold_ha_used"))


_NAMED = "fire_id || '_' || CAST(CAST(round_even(area_ha, 0) AS BIGINT) AS VARCHAR) || 'ha_' || CAST(year AS VARCHAR)"


@query("scar_files", with_("scars") + f"SELECT {_NAMED} || '.gpkg' AS file, count(*) AS n FROM scars WHERE area_ha > 8000 GROUP BY 1")
def _(spark, d):
    named = sinks.by_scar(A.larger_than(I.scars(spark, d), 8000))
    return layers.write_layers(I.boxes(named), tables.new_path(spark, "scars"), "out_name", ["fire_id", "year", "area_ha"])


@query("intersection_files", with_("scars", "polys") + f"""SELECT {_NAMED} || '_intersections.gpkg' AS file, (SELECT count(*) FROM polys p WHERE p.year = s.year AND s.minx <= p.maxx AND s.maxx >= p.minx AND s.miny <= p.maxy AND s.maxy >= p.miny) AS n FROM scars s WHERE area_ha > 8000""")
def _(spark, d):
    scars = sinks.by_scar(A.larger_than(I.scars(spark, d), 8000)).withColumn("name", F.concat("out_name", F.lit("_intersections")))
    met = V.spatial_join(I.boxes(scars), I.boxes(I.polys(spark, d)), ["year"])
    found = G.exact_pairs(met.select(F.col("l_name").alias("name"), F.col("l_geom").alias("s"), F.col("r_geom").alias("geom"), F.col("r_id").alias("id"), F.col("r_region").alias("region")), "s", "geom")
    return layers.write_layers(found, tables.new_path(spark, "met"), "name", ["id", "region", "intersection_area_m2", "intersection_area_ha"], names=scars)


@query("bbox_file", with_("regions") + "SELECT min(minx)::DOUBLE AS minx, min(miny)::DOUBLE AS miny, max(maxx)::DOUBLE AS maxx, max(maxy)::DOUBLE AS maxy, '4' AS excluded FROM regions WHERE region <> '4'")
def _(spark, d):
    box = V.envelope(V.exclude_region(I.regions(spark, d), "4")).first()
    path = tables.new_path(spark, "bbox") + ".geojson"
    spark.createDataFrame([(layers.box_feature("hull", "4", "regions", tuple(box)),)], "value string").coalesce(1).write.text(path)
    back = G.measured(layers.read_layer(spark, path, schema="exclude_region string"))
    return back.select("minx", "miny", "maxx", "maxy", F.col("exclude_region").alias("excluded"))


@query("path_list", with_("polys") + "SELECT DISTINCT file AS path FROM polys")
def _(spark, d):
    path = tables.new_path(spark, "paths")
    sinks.write_paths(I.polys(spark, d).select("file").distinct(), path, "file")
    return spark.read.text(path).select(F.col("value").alias("path"))


@query("log_lines", "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total, 'classification' AS header FROM orders")
def _(spark, d):
    path = tables.new_path(spark, "log")
    o = I.table(spark, d, "orders").select(F.col("o_orderdate").alias("at"), F.lit("INFO").alias("level"), F.col("o_orderkey").cast("string").alias("message"))
    sinks.write_log(o, path, "classification")
    lines = spark.read.text(path)
    told = lines.where("value like '{%'").select(F.from_json("value", "message string").alias("m")).agg(F.count("*").alias("n"), F.sum(F.col("m.message").cast("long")).alias("total"))
    return told.crossJoin(lines.where("value not like '{%'").select(F.col("value").alias("header")))


@query("run_reports", with_("lulc", "lasting", "cls") + """SELECT 'y' || CAST(k.y AS VARCHAR) || '.tif' AS input_file, CAST(k.y AS BIGINT) AS year, '20250101_000000' AS run_timestamp, 'binary' AS mask_mode, 0::DOUBLE AS fill_value, count(*) AS total_pixels,
  count(m.y) AS masked_pixels, count(*) FILTER (v <> 0 AND m.y IS NOT NULL) AS pixels_filtered_to_zero FROM cls k LEFT JOIN mask m USING (y, r, c) GROUP BY 1, 2""")
def _(spark, d):
    path = tables.new_path(spark, "report")
    counted = M.filter_report(M.fill_masked(I.classified(spark, d), M.total_mask_of_cover(I.cover(spark, d), I.YEARS)))
    name = lambda prefix: F.concat(F.lit(prefix), F.col("y").cast("string"), F.lit(".tif"))
    sinks.write_report(sinks.run_report(counted.select(name("y").alias("input_file"), name("f").alias("output_file"), name("m").alias("mask_file"), *counted.columns), "20250101_000000"), path)
    back = spark.read.json(path)
    return back.select("input_file", "year", "run_timestamp", "mask_mode", "fill_value", "total_pixels", "masked_pixels", "pixels_filtered_to_zero")


@query("threshold_summary", with_("scars") + "SELECT count(*) AS n FROM scars WHERE area_ha >= 4321.5")
def _(spark, d):
    path = tables.new_path(spark, "summary")
    spark.createDataFrame([(json.dumps({"threshold_recommendations": {"rule_elbow_threshold_ha": 4321.5}}),)], "value string").coalesce(1).write.text(path)
    return A.at_least(I.scars(spark, d), A.read_threshold(spark, path, "elbow")).agg(F.count("*").alias("n"))


# --- geometries ------------------------------------------------------------------------------------------------------------

# the part of a falling line over a that lies above y0 between x1 and x2, as an area; the line falls from top to bottom of box p
_LINE = "(p.miny + (p.maxy - p.miny) * (1 - ({0} - p.minx) / (p.maxx - p.minx)::DOUBLE))"
_ZERO = "(p.minx + (p.maxx - p.minx) * (1 - ({0} - p.miny) / (p.maxy - p.miny)::DOUBLE))"


def _above(y0: str, x1: str, x2: str) -> str:
    end = f"greatest({x1}, least({x2}, {_ZERO.format(y0)}))"
    return f"(({_LINE.format(x1)} - {y0} + {_LINE.format(end)} - {y0}) / 2 * ({end} - {x1}))"


_X1, _X2, _Y1, _Y2 = "greatest(s.minx, p.minx)", "least(s.maxx, p.maxx)", "greatest(s.miny, p.miny)", "s.maxy"
_TRIANGLE = f"(CASE WHEN {_LINE.format(_X1)} > {_Y1} AND {_X2} > {_X1} THEN {_above(_Y1, _X1, _X2)} - CASE WHEN {_LINE.format(_X1)} > {_Y2} THEN {_above(_Y2, _X1, _X2)} ELSE 0 END ELSE 0 END)"


@query("polygon_intersections", with_("scars", "polys") + f"""SELECT s.fire_id AS scar_id, p.id AS poly_id, CAST(floor({_TRIANGLE} * 10000 + 0.3217) AS BIGINT) AS shared FROM scars s JOIN polys p ON s.year = p.year AND s.minx <= p.maxx AND s.maxx >= p.minx AND s.miny <= p.maxy AND s.maxy >= p.miny
  WHERE s.area_ha > 7000 AND {_LINE.format(_X1)} >= {_Y1} AND {_X1} <= {_X2} AND {_Y1} <= p.maxy""")
def _(spark, d):
    found = V.exact_intersections(I.boxes(A.larger_than(I.scars(spark, d), 7000)), I.triangles(I.polys(spark, d)))
    return found.select("scar_id", "poly_id", F.floor(F.col("intersection_area_m2") * 10000 + 0.3217).alias("shared"))


_UNIT = "SELECT DISTINCT {0} AS k, x, y FROM (SELECT *, unnest(range(minx, maxx)) AS x FROM {1}) t, LATERAL (SELECT unnest(range(t.miny, t.maxy)) AS y) u"


@query("dissolve_area", with_("scars") + f"SELECT CAST(k AS BIGINT) AS year, CAST(count(*) AS DOUBLE) AS area FROM ({_UNIT.format('year', 'scars')}) GROUP BY 1")
def _(spark, d):
    scars = I.boxes(I.scars(spark, d))
    return longs(D.union_area(scars, "year", 64.0).select("year", F.round("area_m2", 4).alias("area")))


@query("dissolve_union", with_("scars") + f"SELECT CAST(k AS BIGINT) AS year, CAST(count(*) AS DOUBLE) AS area, min(x)::DOUBLE AS minx, max(y + 1)::DOUBLE AS maxy FROM ({_UNIT.format('year', 'scars')}) GROUP BY 1")
def _(spark, d):
    united = G.measured(D.dissolve(I.boxes(I.scars(spark, d)), "year", 64.0))
    return longs(united.select("year", F.round("area_m2", 4).alias("area"), "minx", "maxy"))


@query("clip_shape", with_("regions") + f"SELECT CAST(count(*) AS DOUBLE) AS area, 'EPSG:32719' AS crs FROM ({_UNIT.format('1', 'regions')})")
def _(spark, d):
    path = tables.new_path(spark, "clip")
    layers.write_layers(I.boxes(I.regions(spark, d)).withColumn("name", F.lit("clip")), path, "name", ["region"], ".geojson", "EPSG:32719")
    return G.measured(layers.union_of(spark, f"{path}/clip.geojson", 40.0)).select(F.round("area_m2", 4).alias("area"), "crs")


@query("collected_parts", with_("scars") + "SELECT CAST(year AS BIGINT) AS year, count(*) AS n_parts, CAST(sum((maxx - minx) * (maxy - miny)) AS DOUBLE) AS area, min(minx)::DOUBLE AS minx, max(maxy)::DOUBLE AS maxy FROM scars WHERE area_ha > 5000 GROUP BY 1")
def _(spark, d):
    both = G.measured(G.collect_parts(I.boxes(A.larger_than(I.scars(spark, d))), "year"))
    return longs(both.select("year", "n_parts", F.round("area_m2", 4).alias("area"), "minx", "maxy"))


@query("exploded_parts", with_("scars") + "SELECT count(*) AS n, CAST(sum((maxx - minx) * (maxy - miny)) AS DOUBLE) AS area FROM scars WHERE area_ha > 5000")
def _(spark, d):
    large = I.boxes(A.larger_than(I.scars(spark, d)))
    empty = large.withColumn("geom", F.lit(None).cast("binary"))
    return G.measured(G.parts(G.collect_parts(large.unionByName(empty), "year"))).agg(F.count("*").alias("n"), F.sum("area_m2").alias("area"))


@query("hull_area", with_("polys") + """, h AS (SELECT min(minx) AS a, min(miny) AS b, max(maxx) AS c, max(maxy) AS d FROM polys) SELECT (c - a)::DOUBLE AS width, (d - b)::DOUBLE AS height, true AS convex FROM h""")
def _(spark, d):
    hull = G.measured(G.convex_hull(I.boxes(I.polys(spark, d))))
    return hull.select((F.col("maxx") - F.col("minx")).alias("width"), (F.col("maxy") - F.col("miny")).alias("height"), (F.col("area_m2") <= (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))).alias("convex"))


@query("polygon_measures", with_("polys") + "SELECT id, (maxx - minx) * (maxy - miny) / 2::DOUBLE AS area_m2, (maxx - minx) * (maxy - miny) / 20000::DOUBLE AS area_ha, minx::DOUBLE AS minx, maxy::DOUBLE AS maxy FROM polys")
def _(spark, d):
    t = I.triangles(I.polys(spark, d).select("id", "minx", "miny", "maxx", "maxy")).select("id", "geom")
    return G.measured(t).select("id", "area_m2", "area_ha", "minx", "maxy")


@query("scene_overlap_polygons", with_("polys") + f"SELECT p.id FROM polys p, (SELECT 100 AS minx, 50 AS miny, 500 AS maxx, 400 AS maxy) s WHERE s.minx <= p.maxx AND s.maxx >= p.minx AND s.miny <= p.maxy AND s.maxy >= p.miny AND {_TRIANGLE} >= 0.01")
def _(spark, d):
    scene = spark.createDataFrame([(100, 50, 500, 400)], "minx long, miny long, maxx long, maxy long")
    shapes = I.triangles(V.overlapping(I.polys(spark, d), 100, 50, 500, 400, least=0.0))
    both = shapes.select("id", "geom").crossJoin(F.broadcast(I.boxes(scene).select(F.col("geom").alias("scene"))))  # one scene
    return G.exact_pairs(both, "geom", "scene").where("intersection_area_m2 >= 0.01").select("id")


@query("area_systems", "SELECT 'EPSG:4326' AS crs, 'equal-area' AS measured UNION ALL SELECT 'EPSG:32719', 'EPSG:32719' UNION ALL SELECT 'EPSG:32718', 'EPSG:32718' UNION ALL SELECT 'EPSG:3857', 'EPSG:3857'")
def _(spark, d):
    return spark.createDataFrame([(c, R.area_system(c)) for c in ("EPSG:4326", "EPSG:32719", "EPSG:32718", "EPSG:3857")], "crs string, measured string")


# --- names, dates, catalogues ------------------------------------------------------------------------------------------------


@query("model_names", with_("stems") + "SELECT DISTINCT 'col1_chile_v' || CAST(id % 3 AS VARCHAR) || '_r' || CAST(id % 5 AS VARCHAR) || '_rnn_lstm_ckpt' AS model, 'chile' AS country, 'v' || CAST(id % 3 AS VARCHAR) AS version, 'r' || CAST(id % 5 AS VARCHAR) AS region FROM stems")
def _(spark, d):
    k = F.col("id")
    name = N.model_name(F.lit("chile"), F.concat(F.lit("v"), (k % 3).cast("string")), F.concat(F.lit("r"), (k % 5).cast("string")))
    named = I.stems(spark, d).select(name.alias("model")).distinct()
    return named.withColumn("p", N.legacy_model(F.col("model"))).select("model", "p.country", "p.version", "p.region")


@query("legacy_mosaics", with_("stems") + "SELECT id, CASE WHEN len(string_split(stem, '_')) >= 4 THEN string_split(stem, '_')[1] END AS satellite, CASE WHEN len(string_split(stem, '_')) >= 4 THEN TRY_CAST(string_split(stem, '_')[4] AS BIGINT) END AS year FROM stems WHERE stem LIKE 'b14%' OR stem LIKE 'plain%'")
def _(spark, d):
    x = I.stems(spark, d).where("stem like 'b14%' or stem like 'plain%'").withColumn("p", N.legacy_mosaic(F.col("stem")))
    return longs(x.select("id", "p.satellite", "p.year"))


@query("tick_labels", with_("scars") + "SELECT id, CASE WHEN area_ha >= 1000 THEN format('{:,}', CAST(round_even(area_ha, 0) AS BIGINT)) ELSE CAST(CAST(round_even(area_ha, 0) AS BIGINT) AS VARCHAR) END AS label FROM scars WHERE area_ha >= 1")
def _(spark, d):
    return I.scars(spark, d).where("area_ha >= 1").select("id", N.tick_label(F.col("area_ha")).alias("label"))


@query("run_stamps", "SELECT o_orderkey AS id, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS stamp, epoch_ms(make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0.0)) AS first_ms, epoch_ms(make_timestamp(year(o_orderdate), 12, 31, 0, 0, 0.0)) AS last_ms, CAST(year(o_orderdate) AS BIGINT) AS year FROM orders")
def _(spark, d):
    o = I.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("at"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("IgnDate"))
    o = o.withColumn("year", N.year_column(o.columns))
    first, last = N.year_bounds_ms(F.col("year"))
    return longs(o.select("id", N.run_stamp(F.col("at")).alias("stamp"), first.alias("first_ms"), last.alias("last_ms"), "year"))


@query("positional_years", with_("stems") + "SELECT id, CAST(string_split(stem, '_')[4] AS BIGINT) AS year, CAST(regexp_extract(stem, '(20\\d{2})', 1) AS BIGINT) AS found FROM stems WHERE stem LIKE 'b14%'")
def _(spark, d):
    x = I.stems(spark, d).where("stem like 'b14%'")
    return longs(x.select("id", N.positional_year(F.col("stem")).alias("year"), N.required_year(F.col("stem")).alias("found")))


@query("first_scene", with_("scars") + "SELECT id FROM scars ORDER BY year, id LIMIT 1")
def _(spark, d):
    return N.first_only(I.scars(spark, d).select("id", "year"), ["year", "id"], simulate=True).select("id")


_KEYS = "s_suppkey % 7 AS region, s_suppkey % 11 AS year, s_suppkey % 3 AS satellite, s_suppkey % 2 AS layer"


@query("mosaics_without_embeddings", f"SELECT id FROM (SELECT s_suppkey AS id, {_KEYS} FROM supplier) w ANTI JOIN (SELECT {_KEYS} FROM supplier WHERE s_suppkey % 5 = 0) USING (region, year, satellite, layer)")
def _(spark, d):
    k = F.col("s_suppkey")
    keyed = I.table(spark, d, "supplier").select(k.alias("id"), (k % 7).alias("region"), (k % 11).alias("year"), (k % 3).alias("satellite"), (k % 2).alias("layer"))
    return K.missing(keyed, keyed.where("id % 5 = 0"), ["region", "year", "satellite", "layer"]).select("id")


@query("jobs_of_models", "SELECT 'm' || CAST(s_suppkey AS VARCHAR) AS model_name, CAST(s_nationkey AS BIGINT) AS nation, 'b' || CAST(s_suppkey % 9 AS VARCHAR) AS mosaic_name FROM supplier")
def _(spark, d):
    s = I.table(spark, d, "supplier")
    lines = s.select(F.concat(F.lit(" m"), F.col("s_suppkey").cast("string"), F.lit(",b"), (F.col("s_suppkey") % 9).cast("string"), F.lit("\r,x")).alias("line"))
    models = s.select(F.concat(F.lit("m"), F.col("s_suppkey").cast("string")).alias("model_name"), F.col("s_nationkey").cast("long").alias("nation"))
    return models.join(K.job_rows(lines), "model_name").select("model_name", "nation", "mosaic_name")


@query("upload_manifest", "SELECT CAST(y AS BIGINT) AS year, 'landsat' AS satellite, 'v1' AS version, epoch_ms(make_timestamp(y, 1, 1, 0, 0, 0.0)) AS time_start, epoch_ms(make_timestamp(y, 12, 31, 0, 0, 0.0)) AS time_end FROM range(2013, 2026) t(y)")
def _(spark, d):
    years = spark.range(2013, 2026).select(F.col("id").cast("int").alias("year"))
    return longs(K.manifest(years, "landsat", "v1").select("year", "satellite", "version", "time_start", "time_end"))


# --- the network in files ------------------------------------------------------------------------------------------------------


@query("model_file", f"WITH {_NET} SELECT vec_id AS id, CAST(CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS BIGINT) AS pred FROM z")
def _(spark, d):
    path = tables.new_path(spark, "model")
    net = P.Network(LAYERS, [0.0] * 8, [1.0] * 7 + [0.0], list(range(8)))
    sinks.write_model(spark, net, path, P.hyperparameters(net, "landcover", 8))
    return P.predict_batches(_pixels(spark, d), sinks.read_model(spark, path)).select("id", F.col("pred").cast("long").alias("pred"))


@query("checkpoints", "SELECT 'r1-' || printf('%05d', s) || '.json' AS name FROM (VALUES (0), (100), (200), (250)) t(s)")
def _(spark, d):
    path = tables.new_path(spark, "states")
    P.train_models(I.samples(spark, d).withColumn("region", F.lit("r1")), ["region"], steps=250, checkpoints=path).collect()
    return K.files(spark, path, "*.json").select("name")


@query("training_seed", "SELECT 'r1' AS region, true AS same, true AS learnt")
def _(spark, d):
    x = I.samples(spark, d).withColumn("region", F.lit("r1")).orderBy("id")
    a, b = (P.train_models(x, ["region"], steps=200, seed=5) for _ in range(2))
    both = a.alias("a").join(b.alias("b"), "region")
    return both.select("region", (F.col("a.model") == F.col("b.model")).alias("same"), (F.col("a.accuracy") > 0).alias("learnt"))


@query("shuffled_samples", _PX + "SELECT count(*) AS n, CAST(sum(vec_id) AS BIGINT) AS ids FROM pixels")
def _(spark, d):
    x = P.split_rank(I.samples(spark, d), [F.xxhash64("id", F.lit(7))])
    return x.agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
