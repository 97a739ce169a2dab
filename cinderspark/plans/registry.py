"""Every query of the library by name, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.functions import naming as N
from cinderspark.operators import areas as A
from cinderspark.operators import components as C
from cinderspark.operators import crs as R
from cinderspark.operators import geometry as G
from cinderspark.operators import masks as M
from cinderspark.operators import mlp as P
from cinderspark.operators import morphology as X
from cinderspark.operators import vectors as V
from cinderspark.plans import inputs as I
from cinderspark.plans.inputs import with_

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def longs(df: DataFrame) -> DataFrame:
    """Whole-number columns as long, as the SQL gives them."""
    return df.select(*(F.col(c).cast("long").alias(c) if k in ("int", "smallint", "tinyint") else F.col(c) for c, k in df.dtypes))


big = lambda *names: ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in names)

# --- masks ----------------------------------------------------------------------------------------------------------------


@query("mask_accumulated", with_("lulc") + f"SELECT DISTINCT CAST(cls AS BIGINT) AS code, {big('r', 'c')} FROM lulc WHERE cls IN (29, 23, 61, 34, 25)")
def _(spark, d):
    return longs(M.temporal_or(I.cover(spark, d)))


@query("mask_temporal_and", with_("lulc") + f"SELECT {big('r', 'c')} FROM lulc GROUP BY r, c HAVING bool_and(cls = 18) AND count(*) = 7")
def _(spark, d):
    return longs(M.temporal_and(I.cover(spark, d), I.YEARS))


@query("mask_yearly_onehot", with_("lulc") + f"SELECT CAST(cls AS BIGINT) AS code, {big('y', 'r', 'c')} FROM lulc WHERE cls IN (33, 24)")
def _(spark, d):
    return longs(M.yearly_one_hot(I.cover(spark, d)))


@query("mask_total_by_year", with_("lulc", "lasting") + f"SELECT {big('y', 'r', 'c')} FROM mask")
def _(spark, d):
    return longs(M.total_mask_of_cover(I.cover(spark, d), I.YEARS))


@query("filter_classified_report", with_("lulc", "lasting", "cls") + """SELECT CAST(k.y AS BIGINT) AS y, count(*) AS total_pixels, count(m.y) AS masked_pixels,
  count(*) FILTER (v <> 0 AND m.y IS NOT NULL) AS pixels_filtered_to_zero FROM cls k LEFT JOIN mask m USING (y, r, c) GROUP BY 1""")
def _(spark, d):
    mask = M.total_mask_of_cover(I.cover(spark, d), I.YEARS)
    return longs(M.filter_report(M.fill_masked(I.classified(spark, d), mask)))


@query("filter_classified_cells", with_("lulc", "lasting", "cls") + f"SELECT {big('y', 'r', 'c', 'v')} FROM cls ANTI JOIN mask USING (y, r, c) WHERE v <> 0")
def _(spark, d):
    return longs(M.remove_masked(I.classified(spark, d), M.total_mask_of_cover(I.cover(spark, d), I.YEARS)).select("y", "r", "c", "v"))


@query("regrid_nearest", with_("lulc", "cls") + f"""SELECT {big('k.y', 'k.r', 'k.c', 'v').replace('AS k.', 'AS ')}, CAST(m.y IS NOT NULL AS BIGINT) AS masked
  FROM cls k LEFT JOIN (SELECT DISTINCT y, r // 2 AS r, c // 2 AS c FROM lulc WHERE cls IN (33, 24)) m ON m.y = k.y AND m.r = floor((k.r + 0.5) / 2) AND m.c = floor((k.c + 0.5) / 2)""")
def _(spark, d):
    mask = M.yearly_one_hot(I.cover(spark, d)).select("y", F.floor(F.col("r") / 2).alias("r"), F.floor(F.col("c") / 2).alias("c")).distinct()
    return longs(M.regrid(I.classified(spark, d), mask, 2.0).select("y", "r", "c", "v", F.col("masked").cast("int").alias("masked")))


for _name, _how, _sql in (("mosaic_first", M.mosaic_first, "arg_min"), ("mosaic_last", M.mosaic_last, "arg_max")):

    @query(_name, f"SELECT l_partkey % 64 AS r, l_suppkey % 64 AS c, {_sql}(l_linenumber + l_orderkey % 50, l_orderkey * 10 + l_linenumber) AS v FROM lineitem WHERE l_linenumber + l_orderkey % 50 <> 7 GROUP BY 1, 2")
    def _(spark, d, how=_how):
        tiles = I.table(spark, d, "lineitem").select((F.col("l_partkey") % 64).alias("r"), (F.col("l_suppkey") % 64).alias("c"), (F.col("l_linenumber") + F.col("l_orderkey") % 50).alias("v"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"))
        return how(tiles, nodata=7)


@query("crop_bounds", with_("cls") + "SELECT CAST(y AS BIGINT) AS y, CAST(r - 8 AS BIGINT) AS r, CAST(c - 16 AS BIGINT) AS c, CAST(v AS BIGINT) AS v FROM cls WHERE r >= 8 AND r < 40 AND c >= 16 AND c < 60")
def _(spark, d):
    return longs(M.crop(I.classified(spark, d), 8, 16, 40, 60).select("y", "r", "c", "v"))


@query("tile_grid", """SELECT p_partkey AS raster_id, CAST(r0 AS BIGINT) AS r0, CAST(c0 AS BIGINT) AS c0, CAST(least(20, 30 + p_size - r0) AS BIGINT) AS h, CAST(least(20, 45 + p_partkey % 50 - c0) AS BIGINT) AS w
  FROM part, range(0, 200, 20) a(r0), range(0, 200, 20) b(c0) WHERE r0 < 30 + p_size AND c0 < 45 + p_partkey % 50""")
def _(spark, d):
    rasters = I.table(spark, d, "part").select(F.col("p_partkey").alias("raster_id"), (30 + F.col("p_size")).cast("int").alias("height"), (45 + F.col("p_partkey") % 50).cast("int").alias("width"))
    return longs(M.windows(rasters, 20))


# --- morphology -----------------------------------------------------------------------------------------------------------


def _erode(src: str, k: int) -> str:
    o = ", ".join(f"({i})" for i in X.erosion_offsets(k))
    return f"SELECT y, r - a.d AS r, c - b.d AS c FROM {src}, (VALUES {o}) a(d), (VALUES {o}) b(d) WHERE r - a.d BETWEEN 0 AND 63 AND c - b.d BETWEEN 0 AND 63 GROUP BY 1, 2, 3 HAVING count(*) = {k * k}"


def _dilate(src: str, k: int) -> str:
    o = ", ".join(f"({i})" for i in X.dilation_offsets(k))
    return f"SELECT DISTINCT y, r - a.d AS r, c - b.d AS c FROM {src}, (VALUES {o}) a(d), (VALUES {o}) b(d) WHERE r - a.d BETWEEN 0 AND 63 AND c - b.d BETWEEN 0 AND 63"


_OPEN = f"{I.CTE['burnt']}, e2 AS ({_erode('burnt', 2)}), o2 AS ({_dilate('e2', 2)})"
_CELLS = f"SELECT {big('y', 'r', 'c')} FROM "
for _name, _sql, _f in (
    ("morph_erode2", with_("burnt") + f", e AS ({_erode('burnt', 2)}) {_CELLS} e", lambda x: X.erode(x, 2, 64, 64)),
    ("morph_dilate2", with_("burnt") + f", e AS ({_dilate('burnt', 2)}) {_CELLS} e", lambda x: X.dilate(x, 2, 64, 64)),
    ("morph_open2", f"WITH {_OPEN} {_CELLS} o2", lambda x: X.opening(x, 2, 64, 64)),
    ("morph_close4", with_("burnt") + f", d4 AS ({_dilate('burnt', 4)}), z AS ({_erode('d4', 4)}) {_CELLS} z", lambda x: X.closing(x, 4, 64, 64)),
    ("morph_open_close", f"WITH {_OPEN}, d4 AS ({_dilate('o2', 4)}), z AS ({_erode('d4', 4)}) {_CELLS} z", lambda x: X.spatial_filter(x, 64, 64)),
    ("morph_open_close_tiles", f"WITH {_OPEN}, d4 AS ({_dilate('o2', 4)}), z AS ({_erode('d4', 4)}) {_CELLS} z", lambda x: X.spatial_filter_tiles(x, 64, 64, tile=16)),
):

    @query(_name, _sql)
    def _(spark, d, f=_f):
        return longs(f(I.burnt(spark, d)))


# --- pixels and the network -----------------------------------------------------------------------------------------------

_BANDS = "list_transform(embedding[1:8], lambda x: CAST(x AS DOUBLE))"


@query("pixel_vectorize", "SELECT vec_id AS raster_id, CAST((i - 1) // 8 AS BIGINT) AS r, CAST((i - 1) % 8 AS BIGINT) AS c, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) t(i)")
def _(spark, d):
    tiles = I.table(spark, d, "embeddings").select(F.col("vec_id").alias("raster_id"), F.lit(0).alias("r0"), F.lit(0).alias("c0"), F.lit(8).alias("w"), F.array("embedding").alias("bands"))
    return longs(P.vectorise(tiles).select("raster_id", "r", "c", F.col("bands")[0].cast("double").alias("v")))


_PX = with_("pixels")


@query("band_select", _PX + f"SELECT vec_id AS id, b[2] AS b1, b[5] AS b4, b[8] AS b7 FROM (SELECT vec_id, {_BANDS} AS b FROM pixels)")
def _(spark, d):
    x = I.samples(spark, d).withColumn("s", P.select_bands(F.col("b"), [1, 4, 7]))
    return x.select("id", F.col("s")[0].alias("b1"), F.col("s")[1].alias("b4"), F.col("s")[2].alias("b7"))


_HOLES = "CASE WHEN vec_id % 3 = 0 THEN 'NaN'::DOUBLE ELSE b[1] END"


def _holed(spark, d):
    """Samples with NaN in the first band of every third, and in all bands of every ninth."""
    x = I.samples(spark, d)
    nan = F.lit(float("nan"))
    return x.withColumn("b", F.transform("b", lambda v, i: F.when((F.col("id") % 9 == 0) | ((F.col("id") % 3 == 0) & (i == 0)), nan).otherwise(v)))


@query("nan_to_zero", _PX + f"SELECT vec_id AS id, CASE WHEN vec_id % 3 = 0 THEN 0 ELSE b[1] END AS b0, CASE WHEN vec_id % 9 = 0 THEN 0 ELSE b[2] END AS b1 FROM (SELECT vec_id, {_BANDS} AS b FROM pixels)")
def _(spark, d):
    x = _holed(spark, d).withColumn("b", P.nan_to_number(F.col("b")))
    return x.select("id", F.col("b")[0].alias("b0"), F.col("b")[1].alias("b1"))


@query("standardize", _PX + f"SELECT vec_id AS id, round((b[1] - 0.25::DOUBLE) / 2::DOUBLE, 9) AS z0, round((b[2] + 1::DOUBLE) / 1::DOUBLE, 9) AS z1 FROM (SELECT vec_id, {_BANDS} AS b FROM pixels)")
def _(spark, d):
    x = I.samples(spark, d).withColumn("z", P.standardise(F.slice("b", 1, 2), [0.25, -1.0], [2.0, 0.0]))
    return x.select("id", F.round(F.col("z")[0], 9).alias("z0"), F.round(F.col("z")[1], 9).alias("z1"))


@query("valid_any", _PX + "SELECT vec_id AS id FROM pixels WHERE vec_id % 9 <> 0")
def _(spark, d):
    return _holed(spark, d).where(P.any_valid(F.col("b"))).select("id")


@query("valid_all", _PX + "SELECT vec_id AS id FROM pixels WHERE vec_id % 3 <> 0")
def _(spark, d):
    return _holed(spark, d).where(P.all_valid(F.col("b"))).select("id")


_SPLIT = "SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id * 7919 % 10007, vec_id) <= floor((SELECT count(*) FROM pixels) * 0.7::DOUBLE) AS train FROM pixels"


def _split(spark, d):
    x = I.samples(spark, d)
    return P.split_rank(x, [F.col("id") * 7919 % 10007, F.col("id")])


@query("train_split", _PX + f"SELECT id, CAST(train AS BIGINT) AS train FROM ({_SPLIT})")
def _(spark, d):
    return _split(spark, d).select("id", F.col("train").cast("long").alias("train"))


@query("band_stats", f"""WITH {I.CTE['pixels']}, s AS ({_SPLIT}) SELECT CAST(band - 1 AS BIGINT) AS band, round(avg(CAST(embedding[band] AS DOUBLE)), 6) AS mean, round(stddev_pop(CAST(embedding[band] AS DOUBLE)), 6) AS std
  FROM pixels JOIN s ON s.id = vec_id, range(1, 9) t(band) WHERE train GROUP BY 1""")
def _(spark, d):
    return longs(P.band_stats(_split(spark, d).where("train")).select("band", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")))


#: Small whole weights, so that both engines give the same sums: 8 -> 3 -> 2 on rounded bands.
LAYERS = [([[(i * 3 + j * 5) % 7 - 3 for j in range(3)] for i in range(8)], [1, 0, -1]), ([[1, -1], [2, 1], [-1, 2]], [0, 1])]
_ROUNDED = "list_transform(embedding[1:8], lambda x: round(CAST(x AS DOUBLE) * 100))"
_H = [" + ".join([f"{b}", *(f"({LAYERS[0][0][i][j]}) * b[{i + 1}]" for i in range(8))]) for j, b in enumerate(LAYERS[0][1])]
_NET = f"""{I.CTE['pixels']}, x AS (SELECT vec_id, label, {_ROUNDED} AS b FROM pixels), h AS (SELECT vec_id, label, {', '.join(f'greatest({e}, 0::DOUBLE) AS h{j}' for j, e in enumerate(_H))} FROM x),
z AS (SELECT vec_id, label, 0 + h0 + 2 * h1 - h2 AS z0, 1 - h0 + h1 + 2 * h2 AS z1 FROM h)"""


def _pixels(spark, d):
    return I.samples(spark, d).withColumn("b", F.transform("b", lambda x: F.rint(x * 100)))


_NET = _NET.replace("round(CAST(x AS DOUBLE) * 100)", "round_even(CAST(x AS DOUBLE) * 100, 0)")


@query("mlp_predict", f"WITH {_NET} SELECT vec_id AS id, z0, z1, CAST(CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS BIGINT) AS pred FROM z")
def _(spark, d):
    x = P.predict(_pixels(spark, d), LAYERS)
    return x.select("id", F.col("logits")[0].alias("z0"), F.col("logits")[1].alias("z1"), F.col("pred").cast("long").alias("pred"))


@query("mlp_predict_batches", f"WITH {_NET} SELECT vec_id AS id, CAST(CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS BIGINT) AS pred FROM z")
def _(spark, d):
    net = P.Network(LAYERS, [0.0] * 8, [1.0] * 8)
    return P.predict_batches(_pixels(spark, d), net).select("id", F.col("pred").cast("long").alias("pred"))


@query("mlp_embed", f"WITH {_NET} SELECT vec_id AS id, h0, h1, h2 FROM h")
def _(spark, d):
    x = P.embed(_pixels(spark, d), LAYERS, 1)
    return x.select("id", *(F.col("embedding")[i].alias(f"h{i}") for i in range(3)))


@query("mlp_accuracy", f"WITH {_NET} SELECT round(avg(CAST((CASE WHEN z1 > z0 THEN 1 ELSE 0 END) = label % 2 AS DOUBLE)), 9) AS accuracy FROM z")
def _(spark, d):
    return P.accuracy(P.predict(_pixels(spark, d), LAYERS), "landcover").select(F.round("accuracy", 9).alias("accuracy"))


@query("mlp_train")
def _(spark, d):
    return P.train_models(I.samples(spark, d).withColumn("region", F.lit("r1")), ["region"], steps=300).select("region", "n", "accuracy")


# --- names and dates ------------------------------------------------------------------------------------------------------


@query("name_year", with_("stems") + "SELECT id, CAST(nullif(regexp_extract(stem, '(20\\d{2})', 1), '') AS BIGINT) AS year FROM stems")
def _(spark, d):
    return longs(I.stems(spark, d).select("id", N.year_of_stem(F.col("stem")).alias("year")))


@query("name_region", with_("stems") + "SELECT id, CASE WHEN regexp_extract(stem, '_r([0-9]+)_', 1) IN ('1', '2', '4', '6') THEN regexp_extract(stem, '_r([0-9]+)_', 1) END AS region FROM stems")
def _(spark, d):
    return I.stems(spark, d).select("id", N.region_of_stem(F.col("stem")).alias("region"))


@query("name_parts", with_("stems") + "SELECT id, string_split(stem, '_')[3] AS region, string_split(stem, '_')[4] AS year FROM stems")
def _(spark, d):
    return I.stems(spark, d).select("id", N.part_of_stem(F.col("stem"), 2).alias("region"), N.part_of_stem(F.col("stem"), 3).alias("year"))


_ID = N.SAMPLE_PATTERN


@query("sample_model_id", with_("stems") + f"SELECT DISTINCT 'v' || regexp_extract(stem, '{_ID}', 1) || '_r' || regexp_extract(stem, '{_ID}', 2) AS model FROM stems WHERE regexp_matches(stem, '{_ID}')")
def _(spark, d):
    return I.stems(spark, d).select(N.sample_model_id(F.col("stem")).alias("model")).where("model is not null").distinct()


@query("training_files", with_("stems") + r"SELECT id FROM stems WHERE regexp_matches(stem, '^.*_(v1)_.*_r2_.*\.tif$')")
def _(spark, d):
    return I.stems(spark, d).where(N.is_training_file(F.col("stem"), "v1", "r2")).select("id")


@query("output_names", with_("scars", "stems") + """SELECT fire_id || '_' || CAST(CAST(round_even(area_ha, 0) AS BIGINT) AS VARCHAR) || 'ha_' || CAST(year AS VARCHAR) AS name FROM scars
  UNION ALL SELECT stem || '_mask1' FROM stems UNION ALL SELECT stem || '_filtered_20250101_000000' FROM stems""")
def _(spark, d):
    stem = I.stems(spark, d)
    out = I.scars(spark, d).select(N.scar_name(F.col("fire_id"), F.col("area_ha"), F.col("year")).alias("name"))
    return out.unionByName(stem.select(N.mask_name(F.col("stem"), F.lit(1.5)).alias("name"))).unionByName(stem.select(N.filtered_name(F.col("stem"), F.lit("20250101_000000")).alias("name")))


@query("date_year_prefix", with_("readable") + "SELECT id, CAST(substr(d, 1, 4) AS BIGINT) AS year FROM readable")
def _(spark, d):
    return longs(I.readable_dates(spark, d).select("id", N.prefix_year(F.col("d")).alias("year")))


@query("date_year_iso", with_("readable") + "SELECT id, CAST(coalesce(year(try_cast(substr(d, 1, 10) AS DATE)), CAST(substr(d, 1, 4) AS BIGINT)) AS BIGINT) AS year FROM readable")
def _(spark, d):
    return longs(I.readable_dates(spark, d).select("id", N.iso_or_prefix_year(F.col("d")).alias("year")))


@query("date_year_coerce", with_("dates") + "SELECT id, CAST(substr(d, 1, 4) AS BIGINT) AS year FROM dates WHERE d NOT LIKE 'about%' AND CAST(substr(d, 1, 4) AS BIGINT) IN (1996, 1998, 2000) AND CAST(substr(d, 1, 4) AS BIGINT) >= 1997")
def _(spark, d):
    x = I.dates(spark, d).withColumn("year", N.coerced_year(F.col("d"))).where("year is not null")
    return longs(x.where((F.col("year") >= 1997) & F.col("year").isin(N.parse_years("1996, 1998,,2000"))).select("id", "year"))


# --- areas ----------------------------------------------------------------------------------------------------------------


@query("area_threshold_ge", with_("scars") + "SELECT id, round(area_ha, 6) AS area_ha FROM scars WHERE area_ha >= 3000")
def _(spark, d):
    return A.at_least(I.scars(spark, d), 3000).select("id", F.round("area_ha", 6).alias("area_ha"))


@query("area_threshold_gt", with_("scars") + "SELECT id, round(area_ha, 6) AS area_ha FROM scars WHERE area_ha > 5000")
def _(spark, d):
    return A.larger_than(I.scars(spark, d)).select("id", F.round("area_ha", 6).alias("area_ha"))


def _with_area(spark, d):
    p = I.polys(spark, d)
    return p.withColumn("area_ha", A.to_hectares(((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")) * 1000).cast("double"))).withColumnRenamed("file", "source_file")


_AREA = "(maxx - minx) * (maxy - miny) * 1000 / 10000.0::DOUBLE"


@query("area_by_file", with_("polys") + f"SELECT file AS source_file, count(*) AS total, count(*) FILTER ({_AREA} >= 20) AS kept FROM polys GROUP BY ROLLUP (file)")
def _(spark, d):
    return A.kept_by_file(_with_area(spark, d), 20)


@query("area_stats", with_("scars") + "SELECT count(*) AS n, min(area_ha) AS least, round(quantile_cont(area_ha, 0.5), 6) AS median, round(avg(area_ha), 6) AS mean, max(area_ha) AS most FROM scars WHERE area_ha > 0")
def _(spark, d):
    s = A.stats(A.positive(I.scars(spark, d)))
    return s.select("n", "least", F.round("median", 6).alias("median"), F.round("mean", 6).alias("mean"), "most")


def _bins(inner: str) -> str:
    return f"""b AS (SELECT i, {inner} AS e FROM (SELECT min(area_ha) AS a, max(area_ha) AS z FROM scars WHERE area_ha > 0), range(0, 40) t(i))
SELECT CAST(least(b.i, 39) AS BIGINT) AS bin, count(*) AS n FROM (SELECT (SELECT max(i) FROM b WHERE e <= s.area_ha) AS i FROM scars s WHERE area_ha > 0) b GROUP BY 1"""


@query("hist_log", with_("scars") + ", " + _bins("CASE WHEN i = 0 THEN a ELSE pow(10::DOUBLE, log10(a) + (log10(z) - log10(a)) * i / 40) END"))
def _(spark, d):
    return longs(A.histogram(I.scars(spark, d), 40))


@query("hist_linear", with_("scars") + ", " + _bins("a + (z - a) * i / 40"))
def _(spark, d):
    return longs(A.histogram(I.scars(spark, d), 40, log=False))


@query("hist_by_region", with_("polys") + f""", p AS (SELECT region, {_AREA} AS ha FROM polys WHERE region IN ('r1', 'r2', 'r4', 'r6')),
e AS (SELECT i, CASE WHEN i = 0 THEN a WHEN i = 9 THEN z ELSE pow(10::DOUBLE, log10(a) + (log10(z) - log10(a)) * i / 9) END AS e FROM (SELECT min(ha) AS a, max(ha) AS z FROM p), range(0, 10) t(i))
SELECT region, CAST(least(i, 8) AS BIGINT) AS bin, count(*) AS n FROM (SELECT region, (SELECT max(i) FROM e WHERE e <= p.ha) AS i FROM p) GROUP BY 1, 2""")
def _(spark, d):
    p = _with_area(spark, d).where(N.region_of_stem(F.col("source_file")).isNotNull())
    return longs(A.histogram(p, 10, edges_are_bins=True, keys=("region",)))


# --- layers ---------------------------------------------------------------------------------------------------------------

_MEET = "s.minx <= p.maxx AND s.maxx >= p.minx AND s.miny <= p.maxy AND s.maxy >= p.miny"
_SHARED = "(greatest(least(s.maxx, p.maxx) - greatest(s.minx, p.minx), 0) * greatest(least(s.maxy, p.maxy) - greatest(s.miny, p.miny), 0))"


def _large(spark, d):
    return A.larger_than(I.scars(spark, d))


@query("scar_intersections", with_("scars", "polys") + f"""SELECT s.fire_id AS scar_id, CAST(s.year AS BIGINT) AS scar_year, p.id AS poly_id, p.region, {_SHARED} AS intersection_area_m2
  FROM scars s JOIN polys p ON s.year = p.year AND {_MEET} WHERE s.area_ha > 5000""")
def _(spark, d):
    found = V.scar_intersections(_large(spark, d), I.polys(spark, d))
    return longs(found.select("scar_id", "scar_year", "poly_id", "region", "intersection_area_m2"))


@query("scar_intersection_summary", with_("scars", "polys") + f"""SELECT s.fire_id AS scar_id, count(p.id) AS n_polygons, CAST(coalesce(sum({_SHARED}) FILTER (p.id IS NOT NULL), 0) AS BIGINT) AS shared
  FROM scars s LEFT JOIN polys p ON s.year = p.year AND {_MEET} WHERE s.area_ha > 5000 GROUP BY 1""")
def _(spark, d):
    return V.scar_sums(_large(spark, d), I.polys(spark, d))


@query("tiles_semi_hull", with_("polys") + "SELECT id FROM polys WHERE id % 11 <> 0 AND minx <= 180 AND maxx >= 50 AND miny <= 300 AND maxy >= 100")
def _(spark, d):
    tiles = I.polys(spark, d).withColumn("crs", F.when(F.col("id") % 11 != 0, F.lit("EPSG:32719")))
    hull = spark.createDataFrame([(50, 100, 180, 300)], "minx long, miny long, maxx long, maxy long")
    return V.within_reach(tiles, hull).select("id")


@query("regions_envelope", with_("regions") + "SELECT min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM regions WHERE region <> '4'")
def _(spark, d):
    return V.envelope(V.exclude_region(I.regions(spark, d), "4"))


def _utm_sql(lon: str, lat: str) -> tuple[str, str]:
    """x and y of zone 19 south, for degrees, in SQL: the same published series as in the library."""
    phi, lam, e2 = f"radians({lat})", f"radians({lon} + 69)", repr(R.E2)
    n, t, c, a = f"({R.AXIS!r} / sqrt(1 - {e2} * pow(sin({phi}), 2)))", f"pow(tan({phi}), 2)", f"({R.E2 / (1 - R.E2)!r} * pow(cos({phi}), 2))", f"({lam} * cos({phi}))"
    e4, e6, ep2 = R.E2**2, R.E2**3, R.E2 / (1 - R.E2)
    arc = f"({R.AXIS!r} * ({1 - R.E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256!r} * {phi} - {3 * R.E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024!r} * sin(2 * {phi}) + {15 * e4 / 256 + 45 * e6 / 1024!r} * sin(4 * {phi}) - {35 * e6 / 3072!r} * sin(6 * {phi})))"
    x = f"0.9996::DOUBLE * {n} * ({a} + (1 - {t} + {c}) * pow({a}, 3) / 6 + (5 - 18 * {t} + {t} * {t} + 72 * {c} - {58 * ep2!r}) * pow({a}, 5) / 120)"
    y = f"0.9996::DOUBLE * ({arc} + {n} * tan({phi}) * ({a} * {a} / 2 + (5 - {t} + 9 * {c} + 4 * {c} * {c}) * pow({a}, 4) / 24 + (61 - 58 * {t} + {t} * {t} + 600 * {c} - {330 * ep2!r}) * pow({a}, 6) / 720))"
    return x, y


def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    """x and y of the equal-area preset, for degrees, in SQL."""
    import numpy as np

    e, p = np.sqrt(R.E2), {k: float(v) for k, v in R.ALBERS.items()}
    q = lambda s: (1 - R.E2) * (s / (1 - R.E2 * s * s) - np.log((1 - e * s) / (1 + e * s)) / (2 * e))
    m = lambda f: np.cos(f) / np.sqrt(1 - R.E2 * np.sin(f) ** 2)
    a, b, o = np.radians([p["lat_1"], p["lat_2"], p["lat_0"]])
    n = float((m(a) ** 2 - m(b) ** 2) / (q(np.sin(b)) - q(np.sin(a))))
    c = float(m(a) ** 2 + n * q(np.sin(a)))
    rho0 = float(R.AXIS * np.sqrt(c - n * q(np.sin(o))) / n)
    s = f"sin(radians({lat}))"
    qs = f"({1 - R.E2!r} * ({s} / (1 - {R.E2!r} * {s} * {s}) - ln((1 - {float(e)!r} * {s}) / (1 + {float(e)!r} * {s})) / {float(2 * e)!r}))"
    rho, theta = f"({R.AXIS!r} * sqrt({c!r} - {n!r} * {qs}) / {n!r})", f"({n!r} * radians({lon} - {p['lon_0']!r}))"
    return f"{rho} * sin({theta})", f"{rho0!r} - {rho} * cos({theta})"


def _ring_sql(xy) -> str:
    """The area of a box of degrees (a, b, c, d) in another system: the shoelace sum of its four corners."""
    corners = [xy(*p) for p in (("a", "b"), ("c", "b"), ("c", "d"), ("a", "d"))]
    terms = [f"({corners[i][0]}) * ({corners[(i + 1) % 4][1]}) - ({corners[(i + 1) % 4][0]}) * ({corners[i][1]})" for i in range(4)]
    return f"abs({' + '.join(terms)}) / 2"


_DEGREES = "deg AS (SELECT id, -74.0::DOUBLE + minx / 125.0::DOUBLE AS a, -54.0::DOUBLE + miny / 30.0::DOUBLE AS b, -74.0::DOUBLE + maxx / 125.0::DOUBLE AS c, -54.0::DOUBLE + maxy / 30.0::DOUBLE AS d FROM polys)"


def _degrees(spark, d):
    """The polygons' boxes as degrees."""
    x, y = (lambda c: F.lit(-74.0) + F.col(c) / 125.0), (lambda c: F.lit(-54.0) + F.col(c) / 30.0)
    return I.boxes(I.polys(spark, d).select("id", x("minx").alias("minx"), y("miny").alias("miny"), x("maxx").alias("maxx"), y("maxy").alias("maxy"))).select("id", "geom")


@query("reproject_delta", with_("polys") + f""", {_DEGREES}, m AS (SELECT {_ring_sql(_utm_sql)} AS u, {_ring_sql(_albers_sql)} AS e FROM deg)
SELECT round(sum(u) / 1e9, 3) AS before, round(sum(e) / 1e9, 3) AS after, round((sum(e) - sum(u)) * 100 / sum(u), 5) AS delta_pct FROM m""")
def _(spark, d):
    own = R.reproject(_degrees(spark, d), "EPSG:32719")
    both = G.measured(own).select("id", "geom", F.col("area_m2").alias("u"))
    out = G.measured(R.reproject(both, "equal-area", "EPSG:32719")).agg(*A.area_change(F.col("u"), F.col("area_m2")))
    return out.select(F.round(F.col("before") / 1e9, 3).alias("before"), F.round(F.col("after") / 1e9, 3).alias("after"), F.round("delta_pct", 5).alias("delta_pct"))


@query("dissolve_multipart", with_("scars") + "SELECT CAST(year AS BIGINT) AS year, count(*) AS n_parts, CAST(sum((maxx - minx) * (maxy - miny)) AS BIGINT) AS area FROM scars WHERE year BETWEEN 1996 AND 2000 AND year IN (1996, 1998, 1999) GROUP BY 1")
def _(spark, d):
    return longs(V.multiparts(I.scars(spark, d), F.col("year"), [1996, 1998, 1999], 1996, 2000))


@query("scene_overlap", with_("polys") + "SELECT id FROM polys WHERE greatest(least(maxx, 500) - greatest(minx, 100), 0) * greatest(least(maxy, 400) - greatest(miny, 50), 0) >= 0.01")
def _(spark, d):
    return V.overlapping(I.polys(spark, d), 100, 50, 500, 400).select("id")


def _components_sql(near: str) -> str:
    """Smallest cell number that each burnt cell leads to, in all years: labels fall until none does."""
    return f""", b AS (SELECT y, r, c, (y * 64 + r) * 64 + c AS k FROM burnt), e AS (SELECT a.k AS a, z.k AS z FROM b a JOIN b z ON a.y = z.y AND {near} AND a.k <> z.k),
w(k, m) USING KEY (k) AS (SELECT k, k FROM b UNION SELECT e.z, min(w.m) FROM w JOIN e ON e.a = w.k JOIN recurring.w o ON o.k = e.z WHERE w.m < o.m GROUP BY e.z)
SELECT CAST(m // 4096 AS BIGINT) AS y, CAST(m AS BIGINT) AS component, count(*) AS cells"""


_NEAR8, _NEAR4 = "abs(a.r - z.r) <= 1 AND abs(a.c - z.c) <= 1", "abs(a.r - z.r) + abs(a.c - z.c) <= 1"


@query("components_area", with_("burnt") + _components_sql(_NEAR8) + " FROM w GROUP BY m")
def _(spark, d):
    return longs(C.component_areas(C.components(I.burnt(spark, d), 64, 64, tile=16)).select("y", "component", "cells"))


@query("components4_area", with_("burnt") + _components_sql(_NEAR4) + " FROM w GROUP BY m")
def _(spark, d):
    return longs(C.component_areas(C.components(I.burnt(spark, d), 64, 64, 4, tile=16)).select("y", "component", "cells"))


@query("outline_trace", with_("burnt") + _components_sql(_NEAR8) + ", CAST(count(*) AS DOUBLE) AS area FROM w GROUP BY m")
def _(spark, d):
    return longs(G.measured(C.outlines(C.components(I.burnt(spark, d), 64, 64, tile=16))).select("y", "component", "cells", F.round("area_m2", 6).alias("area")))


# --- catalogues -----------------------------------------------------------------------------------------------------------


@query("jobs_cross", "SELECT 'r' || CAST(r AS VARCHAR) AS region, CAST(y AS BIGINT) AS year, 'b14_chile_r' || CAST(r AS VARCHAR) || '_' || CAST(y AS VARCHAR) || '_cog.tif' AS mosaic FROM (VALUES (1), (2), (4), (6)) a(r), range(2013, 2026) b(y)")
def _(spark, d):
    from cinderspark.operators.catalog import jobs

    return longs(jobs(spark, [f"r{r}" for r in N.REGIONS], 2013, 2025).select("region", "year", "mosaic"))


_CATALOG = "models AS (SELECT s_suppkey AS model_id, 'r' || CAST(s_suppkey % 7 AS VARCHAR) AS region FROM supplier), mosaics AS (SELECT p_partkey AS mosaic_id, 'r' || CAST(p_partkey % 9 AS VARCHAR) AS region, p_size AS year FROM part)"


def _models(spark, d):
    return I.table(spark, d, "supplier").select(F.col("s_suppkey").alias("model_id"), F.concat(F.lit("r"), (F.col("s_suppkey") % 7).cast("string")).alias("region"))


def _mosaics(spark, d):
    return I.table(spark, d, "part").select(F.col("p_partkey").alias("mosaic_id"), F.concat(F.lit("r"), (F.col("p_partkey") % 9).cast("string")).alias("region"), F.col("p_size").alias("year"))


@query("models_mosaics", f"WITH {_CATALOG} SELECT region, count(*) AS n, CAST(sum(model_id * 7 + mosaic_id) AS BIGINT) AS checksum FROM models JOIN mosaics USING (region) GROUP BY 1")
def _(spark, d):
    from cinderspark.operators.catalog import by_region

    return by_region(_models(spark, d), _mosaics(spark, d)).groupBy("region").agg(F.count("*").alias("n"), F.sum(F.col("model_id") * 7 + F.col("mosaic_id")).alias("checksum"))


@query("missing_outputs", f"WITH {_CATALOG} SELECT mosaic_id FROM mosaics WHERE region || '/' || CAST(year AS VARCHAR) NOT IN (SELECT region || '/' || CAST(year AS VARCHAR) FROM mosaics WHERE mosaic_id % 3 = 0)")
def _(spark, d):
    from cinderspark.operators.catalog import missing

    m = _mosaics(spark, d)
    return missing(m, m.where("mosaic_id % 3 = 0"), ["region", "year"]).select("mosaic_id")


@query("processed_flags", f"WITH {_CATALOG} SELECT DISTINCT m.region, CAST(o.region IS NOT NULL AS BIGINT) AS done FROM mosaics m LEFT JOIN (SELECT DISTINCT region FROM models) o USING (region)")
def _(spark, d):
    from cinderspark.operators.catalog import with_done

    return with_done(_mosaics(spark, d).select("region").distinct(), _models(spark, d), ["region"]).select("region", F.col("done").cast("long").alias("done"))


@query("years_desc", "SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS year FROM orders ORDER BY year DESC")
def _(spark, d):
    return longs(I.table(spark, d, "orders").select(F.year("o_orderdate").alias("year")).distinct().orderBy(F.desc("year")))


@query("csv_job_nth", "SELECT p_name AS model_name, p_brand AS mosaic_name FROM part WHERE p_partkey = (SELECT min(p_partkey) + 4 FROM part)")
def _(spark, d):
    from cinderspark.operators.catalog import job_row

    lines = I.table(spark, d, "part").select((F.col("p_partkey") - F.lit(1)).alias("i"), F.concat_ws(",", F.col("p_name"), F.concat(F.col("p_brand"), F.lit(" \r")), F.lit("extra")).alias("line"))
    first = lines.agg(F.min("i").alias("m")).first()["m"]
    return job_row(lines.withColumn("i", F.col("i") - first), 4)


@query("geotiff_roundtrip", with_("cls") + "SELECT 'y' || CAST(y AS VARCHAR) AS raster_id, CAST(r AS BIGINT) AS r, CAST(c AS BIGINT) AS c, CAST(v AS BIGINT) AS v FROM cls WHERE v <> 0")
def _(spark, d):
    from cinderspark.sources import geotiff, tables

    path = tables.new_path(spark, "tiff")
    cells = I.classified(spark, d).select(F.concat(F.lit("y"), F.col("y").cast("string")).alias("raster_id"), "r", "c", F.col("v").cast("double").alias("v"))
    geotiff.write(cells, path, 64, 64)
    return longs(geotiff.cells(geotiff.read(spark, path)).where("v <> 0").select("raster_id", "r", "c", F.col("v").cast("long").alias("v")))


from cinderspark.plans import more as _more  # noqa: E402, F401  (its queries register themselves here)
