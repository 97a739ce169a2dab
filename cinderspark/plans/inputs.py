"""Rasters and layers made from the driver tables by whole-number arithmetic, as DataFrames and as SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and columns of the rasters.
GRID = 64
YEARS = 7

CTE = {
    "lulc": """lulc0 AS (SELECT CAST(l_partkey % 64 AS INT) AS r, CAST((l_orderkey * 4 + l_linenumber) % 64 AS INT) AS c, CAST(year(l_shipdate) AS INT) AS y,
  CAST(sum(l_quantity) AS BIGINT) % 64 AS k FROM lineitem GROUP BY 1, 2, 3),
lulc AS (SELECT r, c, y, CAST(CASE WHEN k < 20 OR (k >= 40 AND k <> 61) THEN 18 ELSE k END AS INT) AS cls FROM lulc0)""",
    "cls": """cls AS (SELECT CAST(o_custkey % 64 AS INT) AS r, CAST(o_orderkey % 64 AS INT) AS c, CAST(year(o_orderdate) AS INT) AS y,
  max(CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END) AS v FROM orders GROUP BY 1, 2, 3)""",
    "burnt": """burnt AS (SELECT CAST(o_custkey % 64 AS INT) AS r, CAST(o_orderkey % 64 AS INT) AS c, CAST(year(o_orderdate) AS INT) AS y
  FROM orders WHERE o_totalprice > 20000 GROUP BY 1, 2, 3)""",
    "lasting": """lasting AS (SELECT DISTINCT r, c FROM lulc WHERE cls IN (29, 23, 61, 34, 25)
  UNION SELECT r, c FROM lulc WHERE cls = 18 GROUP BY r, c HAVING count(DISTINCT y) = 7),
mask AS (SELECT y, r, c FROM lasting, (SELECT DISTINCT y FROM lulc) UNION SELECT y, r, c FROM lulc WHERE cls IN (33, 24))""",
    "scars": """scars AS (SELECT o_orderkey AS id, 'F' || CAST(o_orderkey AS VARCHAR) AS fire_id, CAST(year(o_orderdate) AS INT) AS year, o_totalprice / 50 AS area_ha,
  o_custkey % 1000 AS minx, o_orderkey % 1000 AS miny, o_custkey % 1000 + 1 + CAST(floor(o_totalprice) AS BIGINT) % 40 AS maxx, o_orderkey % 1000 + 1 + o_orderkey % 37 AS maxy FROM orders)""",
    "polys": """polys AS (SELECT l_orderkey * 10 + l_linenumber AS id, 'r' || CAST(1 + l_suppkey % 6 AS VARCHAR) AS region, CAST(year(l_shipdate) AS INT) AS year,
  'b14_x_r' || CAST(1 + l_suppkey % 6 AS VARCHAR) || '_' || CAST(year(l_shipdate) AS VARCHAR) || '_cog_classified_filtered_20250101_000000_mask1' AS file,
  l_partkey % 1000 AS minx, (l_orderkey * 13) % 1000 AS miny, l_partkey % 1000 + 1 + CAST(floor(l_quantity) AS BIGINT) % 30 AS maxx, (l_orderkey * 13) % 1000 + 1 + l_linenumber * 3 AS maxy FROM lineitem)""",
    "regions": """regions AS (SELECT CAST(n_regionkey AS VARCHAR) AS region, CAST(n_nationkey * 10 AS BIGINT) AS minx, CAST(n_nationkey * 7 % 50 AS BIGINT) AS miny,
  CAST(n_nationkey * 10 + 15 AS BIGINT) AS maxx, CAST(n_nationkey * 7 % 50 + 20 AS BIGINT) AS maxy FROM nation)""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land cover: r, c, y, cls."""
    key = [(F.col("l_partkey") % 64).cast("int").alias("r"), ((F.col("l_orderkey") * 4 + F.col("l_linenumber")) % 64).cast("int").alias("c"), F.year("l_shipdate").alias("y")]
    k = F.sum("l_quantity").cast("long") % 64
    code = F.when((F.col("k") < 20) | ((F.col("k") >= 40) & (F.col("k") != 61)), 18).otherwise(F.col("k"))
    return table(spark, sf_dir, "lineitem").groupBy(*key).agg(k.alias("k")).select("r", "c", "y", code.cast("int").alias("cls"))


def classified(spark: SparkSession, sf_dir: str, grid: int = GRID, price: float = 150000) -> DataFrame:
    """A classified raster of each year: r, c, y, v."""
    key = [(F.col("o_custkey") % grid).cast("int").alias("r"), (F.col("o_orderkey") % grid).cast("int").alias("c"), F.year("o_orderdate").alias("y")]
    return table(spark, sf_dir, "orders").groupBy(*key).agg(F.max(F.when(F.col("o_totalprice") > price, 1).otherwise(0)).alias("v"))


def burnt(spark: SparkSession, sf_dir: str, grid: int = GRID) -> DataFrame:
    """The set cells of a denser classified raster: y, r, c."""
    return classified(spark, sf_dir, grid, 20000).where("v = 1").select("y", "r", "c")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pixel samples: id, b array<double> of 8 bands, landcover 0 or 1; eight pixels of each vector's 64 numbers."""
    vectors = table(spark, sf_dir, "embeddings").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(7))))
    return vectors.select((F.col("vec_id") * 8 + F.col("j")).alias("id"), F.slice("embedding", F.col("j") * 8 + 1, F.lit(8)).cast("array<double>").alias("b"), (F.col("label") % 2).cast("int").alias("landcover"))


#: The same pixels in SQL, under the names of the table.
CTE["pixels"] = "pixels AS (SELECT vec_id * 8 + j AS vec_id, label, embedding[j * 8 + 1 : j * 8 + 8] AS embedding FROM embeddings, range(0, 8) t(j))"


def scars(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("o_custkey") % 1000, F.col("o_orderkey") % 1000
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("F"), F.col("o_orderkey").cast("string")).alias("fire_id"), F.year("o_orderdate").alias("year"), (F.col("o_totalprice") / 50).alias("area_ha"),
        x.alias("minx"), y.alias("miny"), (x + 1 + F.floor("o_totalprice") % 40).alias("maxx"), (y + 1 + F.col("o_orderkey") % 37).alias("maxy"),
    )


def polys(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("l_partkey") % 1000, (F.col("l_orderkey") * 13) % 1000
    region, year = F.concat(F.lit("r"), (1 + F.col("l_suppkey") % 6).cast("string")), F.year("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), region.alias("region"), year.alias("year"),
        F.concat(F.lit("b14_x_"), region, F.lit("_"), year.cast("string"), F.lit("_cog_classified_filtered_20250101_000000_mask1")).alias("file"),
        x.alias("minx"), y.alias("miny"), (x + 1 + F.floor("l_quantity") % 30).alias("maxx"), (y + 1 + F.col("l_linenumber") * 3).alias("maxy"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey").cast("long")
    return table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("string").alias("region"), (k * 10).alias("minx"), (k * 7 % 50).alias("miny"), (k * 10 + 15).alias("maxx"), (k * 7 % 50 + 20).alias("maxy"))


def stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File stems of all parts: good names, and names without a year, region or parts."""
    p = F.col("p_partkey")
    name = F.when(p % 5 == 0, F.concat(F.lit("b14_x_r"), (1 + p % 7).cast("string"), F.lit("_"), (2013 + p % 13).cast("string"), F.lit("_cog"))).when(p % 5 == 1, F.concat(F.lit("samples_v"), (p % 3).cast("string"), F.lit("_a_r"), (p % 4).cast("string"), F.lit("_b_"), (2013 + p % 13).cast("string"), F.lit(".tif"))).when(p % 5 == 2, F.concat(F.lit("plain"), p.cast("string"))).when(p % 5 == 3, F.concat(F.lit("x_r12_"), (1990 + p % 20).cast("string"), F.lit("_2017"))).otherwise(F.lit("x_v1_r2_y.tif"))
    return table(spark, sf_dir, "part").select(p.alias("id"), name.alias("stem"))


CTE["stems"] = """stems AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'b14_x_r' || CAST(1 + p_partkey % 7 AS VARCHAR) || '_' || CAST(2013 + p_partkey % 13 AS VARCHAR) || '_cog'
  WHEN p_partkey % 5 = 1 THEN 'samples_v' || CAST(p_partkey % 3 AS VARCHAR) || '_a_r' || CAST(p_partkey % 4 AS VARCHAR) || '_b_' || CAST(2013 + p_partkey % 13 AS VARCHAR) || '.tif'
  WHEN p_partkey % 5 = 2 THEN 'plain' || CAST(p_partkey AS VARCHAR) WHEN p_partkey % 5 = 3 THEN 'x_r12_' || CAST(1990 + p_partkey % 20 AS VARCHAR) || '_2017' ELSE 'x_v1_r2_y.tif' END AS stem FROM part)"""


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date texts of all orders: ISO, with slashes, years alone, and no date."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 4 == 1, F.date_format(d, "yyyy/MM/dd")).when(k % 4 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise(F.concat(F.lit("about "), F.date_format(d, "yyyy")))
    return table(spark, sf_dir, "orders").select(k.alias("id"), text.alias("d"))


CTE["dates"] = """dates AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y/%m/%d')
  WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ELSE 'about ' || strftime(o_orderdate, '%Y') END AS d FROM orders)"""


def readable_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date texts of all orders that begin with a year: ISO, with slashes, with a time, and with a season."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 4 == 1, F.date_format(d, "yyyy/MM/dd")).when(k % 4 == 2, F.date_format(d, "yyyy-MM-dd HH:mm:ss")).otherwise(F.concat(F.date_format(d, "yyyy"), F.lit(" spring")))
    return table(spark, sf_dir, "orders").select(k.alias("id"), text.alias("d"))


CTE["readable"] = CTE["dates"].replace("dates AS", "readable AS", 1).replace("'about ' || strftime(o_orderdate, '%Y')", "strftime(o_orderdate, '%Y') || ' spring'")


def boxes(layer: DataFrame) -> DataFrame:
    """``layer`` with the rectangle of its box columns as ``geom``."""
    from cinderspark.operators.geometry import rectangle, to_wkb

    def run(frames):
        for pdf in frames:
            yield pdf.assign(geom=[to_wkb(rectangle(*b)) for b in zip(pdf["minx"], pdf["miny"], pdf["maxx"], pdf["maxy"], strict=True)])

    return layer.mapInPandas(run, ", ".join([*(f"`{n}` {k}" for n, k in layer.dtypes), "geom binary"]))


def triangles(layer: DataFrame) -> DataFrame:
    """``layer`` with, as ``geom``, the triangle of its box's lower left, lower right and upper left corners."""
    import numpy as np

    from cinderspark.operators.geometry import to_wkb

    def run(frames):
        for pdf in frames:
            yield pdf.assign(geom=[to_wkb([[np.array([[a, b], [c, b], [a, d], [a, b]], float)]]) for a, b, c, d in zip(pdf["minx"], pdf["miny"], pdf["maxx"], pdf["maxy"], strict=True)])

    return layer.mapInPandas(run, ", ".join([*(f"`{n}` {k}" for n, k in layer.dtypes), "geom binary"]))


def with_(*names: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(CTE[n] for n in names) + "\n"
