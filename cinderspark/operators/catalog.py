"""Catalogues of files, models and jobs: which belongs to which, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, EmptyInputError


def files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``path, name, stem, size`` of the files that match, from their metadata alone; an error if there are none."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    out = found.select("path", name.alias("name"), F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.col("length").alias("size"))
    if out.isEmpty():
        raise EmptyInputError(f"no {pattern} in {folder}")
    return out.orderBy("path")


def jobs(spark: SparkSession, regions: list[str], first: int, last: int, country: str = "chile") -> DataFrame:
    """``region, year, mosaic`` of every region and year: a list of a few dozen rows."""
    if first > last:
        raise DataContractError(f"years run from {first} to {last}")
    base = spark.createDataFrame([(r,) for r in regions], "region string")
    each = base.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))
    return each.withColumn("mosaic", F.format_string(f"b14_{country}_%s_%d_cog.tif", "region", "year"))


def by_region(models: DataFrame, mosaics: DataFrame) -> DataFrame:
    """Models with the mosaics of their region."""
    return models.join(mosaics, "region")


def with_done(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """``wanted`` with ``done``: whether there is an output of the same keys (compared as wholes, so region1 is not region10)."""
    return wanted.join(present.select(*keys).distinct().withColumn("done", F.lit(True)), keys, "left").withColumn("done", F.coalesce("done", F.lit(False)))


def missing(wanted: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """What has no output yet; one run resumes where another has ended."""
    return wanted.join(present.select(*keys), keys, "left_anti")


def job_rows(lines: DataFrame) -> DataFrame:
    """``model_name, mosaic_name`` of all lines (line): blanks and carriage returns cut, more columns ignored, lines without both left out."""
    fields = F.split(F.regexp_replace("line", "\r", ""), ",")
    name = lambda i: F.trim(F.try_element_at(fields, F.lit(i)))
    return lines.select(name(1).alias("model_name"), name(2).alias("mosaic_name")).where("model_name <> '' and mosaic_name <> ''")


def job_row(lines: DataFrame, task: int, has_header: bool = False) -> DataFrame:
    """``model_name, mosaic_name`` of a task's line (i from 0, line): blanks and carriage returns cut, more columns ignored."""
    fields = F.split(F.regexp_replace("line", "\r", ""), ",")
    row = lines.where(F.col("i") == task + int(has_header)).select(F.trim(F.try_element_at(fields, F.lit(1))).alias("model_name"), F.trim(F.try_element_at(fields, F.lit(2))).alias("mosaic_name"))
    if row.where("model_name <> '' and mosaic_name <> ''").isEmpty():
        raise DataContractError(f"no job for task {task}")
    return row


def manifest(outputs: DataFrame, satellite: str, version: str) -> DataFrame:
    """The property record of each output (region, year): what an upload would carry."""
    from cinderspark.functions.naming import year_bounds_ms

    start, end = year_bounds_ms(F.col("year"))
    return outputs.select("*", F.lit(satellite).alias("satellite"), F.lit(version).alias("version"), start.alias("time_start"), end.alias("time_end"))
