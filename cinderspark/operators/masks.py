"""Map algebra on cells: one row for each (row, column[, year]) of a raster; sparse masks hold the set cells only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, MissingInputError

#: Land-cover codes whose presence in any year masks a cell; the code that must hold in all years; codes that mask their own year.
ANY_YEAR = (29, 23, 61, 34, 25)
EVERY_YEAR = 18
YEARLY = (33, 24)


def band_of_year(year: int, start: int, count: int) -> int:
    """The 1-based band of a year; bands are consecutive years from ``start``."""
    if not start <= year < start + count:
        raise DataContractError(f"year {year} is outside bands {start} to {start + count - 1}")
    return year - start + 1


def year_range(first: int, last: int) -> list[int]:
    if first > last:
        raise DataContractError(f"years run from {first} to {last}")
    return list(range(first, last + 1))


def window_grid(height: int, width: int, chunk: int = 2048) -> list[tuple[int, int, int, int]]:
    """(row, column, height, width) of each window, row by row; the last ones are what is left."""
    if chunk <= 0:
        raise DataContractError("a window has at least one cell")
    return [(r, c, min(chunk, height - r), min(chunk, width - c)) for r in range(0, height, chunk) for c in range(0, width, chunk)]


def windows(rasters: DataFrame, chunk: int = 2048) -> DataFrame:
    """``raster_id, r0, c0, h, w`` of the windows of each raster (raster_id, height, width)."""
    if chunk <= 0:
        raise DataContractError("a window has at least one cell")
    starts = lambda size: F.sequence(F.lit(0), F.col(size) - 1, F.lit(chunk))
    grid = rasters.where("height > 0 and width > 0").withColumn("r0", F.explode(starts("height"))).withColumn("c0", F.explode(starts("width")))
    return grid.select("raster_id", "r0", "c0", F.least(F.lit(chunk), F.col("height") - F.col("r0")).alias("h"), F.least(F.lit(chunk), F.col("width") - F.col("c0")).alias("w"))


def temporal_or(cover: DataFrame, codes: list[int] | None = None) -> DataFrame:
    """``code, r, c`` of the cells that have a code in any year; one scan serves all codes."""
    found = cover.where(F.col("cls").isin(*(codes or ANY_YEAR)))
    return found.select(F.col("cls").alias("code"), "r", "c").distinct()


def temporal_and(cover: DataFrame, n_years: int, code: int = EVERY_YEAR) -> DataFrame:
    """``r, c`` of the cells that have a code in each of ``n_years`` years; a cell that lacks a year does not."""
    return cover.where(F.col("cls") == code).groupBy("r", "c").agg(F.count_distinct("y").alias("n")).where(F.col("n") == n_years).select("r", "c")


def yearly_one_hot(cover: DataFrame, codes: list[int] | None = None) -> DataFrame:
    """``code, y, r, c`` of the cells that have a code in that year."""
    return cover.where(F.col("cls").isin(*(codes or YEARLY))).select(F.col("cls").alias("code"), "y", "r", "c").distinct()


def total_mask(years: DataFrame, lasting: list[DataFrame], yearly: DataFrame) -> DataFrame:
    """``y, r, c``: for each year, the cells of any lasting mask (r, c) or of that year's masks (y, r, c).

    ``years`` (y) is a handful of rows: the lasting cells are united once and repeated for each.
    """
    if not lasting:
        return yearly.select("y", "r", "c").distinct()
    union = lasting[0].select("r", "c")
    for more in lasting[1:]:
        union = union.unionByName(more.select("r", "c"))
    listed = [row["y"] for row in years.select("y").distinct().orderBy("y").collect()]
    repeated = union.distinct().withColumn("y", F.explode(F.array(*map(F.lit, listed)) if listed else F.array().cast("array<int>")))
    return repeated.select("y", "r", "c").unionByName(yearly.select("y", "r", "c")).distinct()


def total_mask_of_cover(cover: DataFrame, n_years: int) -> DataFrame:
    """All masks of a land cover (r, c, y, cls), united for each of its years."""
    return total_mask(cover.select("y").distinct(), [temporal_or(cover), temporal_and(cover, n_years)], yearly_one_hot(cover))


def require_masks(classified: DataFrame, mask_years: list[int]) -> DataFrame:
    """``classified``, or an error with all years that have no mask."""
    missing = sorted(row["y"] for row in classified.select("y").distinct().collect() if row["y"] not in set(mask_years))
    if missing:
        raise MissingInputError(f"no mask for {', '.join(map(str, missing))}")
    return classified


def with_mask(classified: DataFrame, mask: DataFrame) -> DataFrame:
    """``classified`` (r, c, y, v) with ``masked boolean``; cells outside the mask's grid are kept."""
    return classified.join(mask.select("y", "r", "c").withColumn("masked", F.lit(True)), ["y", "r", "c"], "left").withColumn("masked", F.coalesce("masked", F.lit(False)))


def fill_masked(classified: DataFrame, mask: DataFrame, fill: float = 0, low: int = 0, high: int = 255) -> DataFrame:
    """Masked cells get ``fill``, cut to a whole number; a value that the raster can't hold is an error."""
    if not low <= fill <= high:
        raise DataContractError(f"{fill} doesn't fit into {low} to {high}")
    return with_mask(classified, mask).withColumn("out", F.when(F.col("masked"), F.lit(int(fill)).cast("long")).otherwise(F.col("v").cast("long")))


def filter_report(filled: DataFrame) -> DataFrame:
    """Counters of each year: all cells, masked cells, and cells that were set and are no longer."""
    return filled.groupBy("y").agg(F.count("*").alias("total_pixels"), F.count_if("masked").alias("masked_pixels"), F.count_if((F.col("v") != 0) & (F.col("out") == 0)).alias("pixels_filtered_to_zero"))


def remove_masked(classified: DataFrame, mask: DataFrame) -> DataFrame:
    """The set cells that no mask of their year holds."""
    return classified.where("v <> 0").join(mask.select("y", "r", "c"), ["y", "r", "c"], "left_anti")


def nearest_cell(index: Column, scale: float, shift: float = 0.0) -> Column:
    """The cell of another grid that holds the centre of cell ``index``: its cells are ``scale`` wide and begin at ``shift``."""
    return F.floor((index + F.lit(0.5) - F.lit(shift)) / F.lit(float(scale)))


def regrid(classified: DataFrame, mask: DataFrame, scale: float, shift: float = 0.0) -> DataFrame:
    """``classified`` with ``masked`` from a mask (y, r, c) on another grid, by nearest neighbour; outside of it: kept."""
    keyed = classified.withColumn("mr", nearest_cell(F.col("r"), scale, shift)).withColumn("mc", nearest_cell(F.col("c"), scale, shift))
    other = mask.select("y", F.col("r").cast("long").alias("mr"), F.col("c").cast("long").alias("mc")).distinct().withColumn("masked", F.lit(True))
    return keyed.join(other, ["y", "mr", "mc"], "left").withColumn("masked", F.coalesce("masked", F.lit(False))).drop("mr", "mc")


def mosaic_first(tiles: DataFrame, order: str = "ord", nodata: int | None = None) -> DataFrame:
    """``r, c, v``: of overlapping tiles' cells (ord, r, c, v), the valid one that comes first in order."""
    valid = tiles if nodata is None else tiles.where(F.col("v") != nodata)
    return valid.groupBy("r", "c").agg(F.min_by("v", order).alias("v"))


def mosaic_last(tiles: DataFrame, order: str = "ord", nodata: int | None = None) -> DataFrame:
    """``r, c, v``: of overlapping tiles' cells, the valid one that comes last: it lies on top."""
    valid = tiles if nodata is None else tiles.where(F.col("v") != nodata)
    return valid.groupBy("r", "c").agg(F.max_by("v", order).alias("v"))


def crop(cells: DataFrame, r0: int, c0: int, r1: int, c1: int) -> DataFrame:
    """The cells of rows r0 to r1 and columns c0 to c1 (ends exclusive), counted from there."""
    inside = cells.where((F.col("r") >= r0) & (F.col("r") < r1) & (F.col("c") >= c0) & (F.col("c") < c1))
    return inside.withColumns({"r": F.col("r") - r0, "c": F.col("c") - c0})


def equals(value: Column, code: float) -> Column:
    """1 where a cell has the code, else 0."""
    return F.when(value == code, 1).otherwise(0).cast("tinyint")


def binarise(value: Column) -> Column:
    return F.when(value > 0, 1).otherwise(0).cast("tinyint")
