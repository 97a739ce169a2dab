"""Where results go: reports, path lists, one folder for each scar, masks by year; and stored models."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, EmptyInputError, MissingInputError
from cinderspark.functions.naming import scar_name
from cinderspark.operators.mlp import Network


def run_report(report: DataFrame, run_timestamp: str, fill: float = 0.0, mask_mode: str = "binary") -> DataFrame:
    """The ten fields of a filter report, from (input_file, output_file, mask_file, y, counters)."""
    return report.select("input_file", "output_file", "mask_file", F.col("y").alias("year"), F.lit(run_timestamp).alias("run_timestamp"), F.lit(mask_mode).alias("mask_mode"), F.lit(float(fill)).alias("fill_value"), "total_pixels", "masked_pixels", "pixels_filtered_to_zero")


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def write_log(messages: DataFrame, path: str, header: str = "") -> None:
    """Messages (at timestamp, level, message) as lines of JSON in order of time, after a first line with the header."""
    first = messages.sparkSession.createDataFrame([(0, header)], "part int, value string")
    lines = messages.select(F.lit(1).alias("part"), F.to_json(F.struct("at", "level", "message")).alias("value"), "at")
    ordered = lines.unionByName(first, allowMissingColumns=True).orderBy("part", "at", "value")
    ordered.select("value").write.mode("overwrite").text(path)


def large_enough(files: DataFrame, least_mb: float = 0.01) -> DataFrame:
    """Files (size in bytes) of ``least_mb`` megabytes of 2^20 bytes at least: smaller outputs have likely failed."""
    return files.where(F.col("size") / (1 << 20) >= least_mb)


def write_paths(paths: DataFrame, path: str, column: str = "path") -> None:
    """One path a line, in order; range partitions keep the order over files."""
    paths.select(F.col(column).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def write_masks(mask: DataFrame, path: str) -> None:
    """Sparse masks by year, so that a reader of one year opens its files only."""
    mask.repartition("y").write.mode("overwrite").partitionBy("y").parquet(path)


def by_scar(scars: DataFrame, keep_last: bool = True, order: str = "id") -> DataFrame:
    """Scars (fire_id, area_ha, year, ...) with ``out_name``; of equal names the last in ``order`` stays, or all are an error."""
    named = scars.withColumn("out_name", scar_name(F.coalesce(F.trim(F.col("fire_id").cast("string")), F.lit("None")), F.col("area_ha"), F.col("year")))
    if not keep_last:
        twice = named.groupBy("out_name").count().where("count > 1").limit(5).collect()
        if twice:
            raise DataContractError(f"several scars would be {', '.join(r['out_name'] for r in twice)}")
        return named
    last = named.groupBy("out_name").agg(F.max_by(F.struct(*scars.columns), order).alias("row"))
    return last.select("out_name", "row.*")


def write_by_scar(scars: DataFrame, path: str, keep_last: bool = True) -> None:
    """A folder for each scar, named after it."""
    by_scar(scars, keep_last).repartition("out_name").write.mode("overwrite").partitionBy("out_name").parquet(path)


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file from any store that Spark reads; an error if it isn't there."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingInputError(path) from error
        raise
    if row is None:
        raise EmptyInputError(path)
    return row["value"]


def read_model(spark: SparkSession, path: str) -> Network:
    """A model as :func:`write_model` stores it; a deviation of 0 counts as 1."""
    told = json.loads(read_text(spark, path))
    if "DATASET_SCHEMA" not in told:
        raise EmptyInputError("the model was stored without DATASET_SCHEMA")
    return Network([(w, b) for w, b in told["layers"]], told["data_mean"], told["data_std"], told["DATASET_SCHEMA"]["INPUT_BAND_INDICES"])


def write_model(spark: SparkSession, net: Network, path: str, hyperparameters: str) -> None:
    """The hyper-parameters with the layers' weights: one line of JSON."""
    told = {**json.loads(hyperparameters), "layers": [[w.tolist(), b.tolist()] for w, b in net.layers]}
    spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(path)
