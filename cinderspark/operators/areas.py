"""Areas and histograms: filters, summaries and binned counts."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError, EmptyInputError, MissingInputError

#: Names of the thresholds in a summary.
RULES = {"area_cap": "rule_area_cap_threshold_ha", "score": "rule_score_threshold_ha", "elbow": "rule_elbow_threshold_ha"}


def to_hectares(m2: Column) -> Column:
    return m2 / F.lit(10000.0)


def at_least(layer: DataFrame, ha: float, column: str = "area_ha") -> DataFrame:
    """Rows of ``ha`` hectares or more; NaN is no area."""
    return layer.where((F.col(column) >= ha) & ~F.isnan(column))


def larger_than(layer: DataFrame, ha: float = 5000, column: str = "area_ha") -> DataFrame:
    """Rows of more than ``ha`` hectares."""
    if column not in layer.columns:
        raise DataContractError(f"no column {column}")
    return layer.where((F.col(column) > ha) & ~F.isnan(column))


def positive(layer: DataFrame, column: str = "area_ha", finite: bool = True) -> DataFrame:
    """Rows with an area above 0 and, if asked, finite. NaN is above everything in Spark, so it is tested by name."""
    ok = (F.col(column) > 0) & ~F.isnan(column)
    return layer.where(ok & (F.col(column) < float("inf")) if finite else ok)


def threshold(given: float | None, summary: str | None = None, rule: str = "area_cap") -> float:
    """The given threshold, else a rule's from a summary in JSON."""
    if given is not None:
        if given < 0:
            raise DataContractError("a threshold isn't negative")
        return given
    if summary is None:
        raise DataContractError("neither a threshold nor a summary is given")
    found = json.loads(summary).get("threshold_recommendations", {}).get(RULES[rule])
    if found is None:
        raise DataContractError(f"the summary has no {RULES[rule]}")
    return float(found)


def read_threshold(spark, path: str, rule: str = "area_cap") -> float:
    """A rule's threshold from a summary file of any file system that Spark reaches."""
    try:
        row = spark.read.text(path, wholetext=True).first()
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingInputError(path) from error
        raise
    return threshold(None, row["value"] if row else "{}", rule)


def with_threshold(layer: DataFrame, ha: float) -> DataFrame:
    """Features (source_file, area_m2) of ``ha`` hectares at least, with ``area_ha`` and the threshold that was used."""
    return at_least(layer.withColumn("area_ha", to_hectares(F.col("area_m2"))), ha).withColumn("threshold_ha_used", F.lit(float(ha)))


def any_set(cells: DataFrame, value: str = "v") -> bool:
    """Whether any cell is set: the scan ends at the first."""
    return not cells.where(F.col(value) != 0).isEmpty()


def kept_by_file(layer: DataFrame, ha: float) -> DataFrame:
    """``source_file, total, kept`` for each file, and for all of them (source_file null), in one pass."""
    return layer.rollup("source_file").agg(F.count("*").alias("total"), F.count_if((F.col("area_ha") >= ha) & ~F.isnan("area_ha")).alias("kept"))


def stats(layer: DataFrame, column: str = "area_ha") -> DataFrame:
    """Count, least, exact median, mean and largest; without rows, a count of 0 and nulls.

    The median is found by rank: values are range-partitioned and sorted, and only the one or two middle rows of the partition
    that holds them are picked out, so no task gathers all values.
    """
    from cinderspark.sources.tables import written

    x = F.col(column).cast("double")
    kept = written(layer.select(x.alias("x")).where("x is not null").repartitionByRange("x").sortWithinPartitions("x").withColumn("at", F.monotonically_increasing_id()), "ranks")
    total = kept.agg(F.count("*").alias("n"), F.min("x").alias("least"), F.avg("x").alias("mean"), F.max("x").alias("most"))
    sizes = kept.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect()
    n, before, middle = sum(r["n"] for r in sizes), 0, []
    for r in sizes:
        middle += [(r["p"] << 33) + i - before for i in {(n - 1) // 2, n // 2} if before <= i < before + r["n"]]
        before += r["n"]
    median = kept.where(F.col("at").isin(middle)).agg(F.avg("x").alias("median"))
    return total.crossJoin(F.broadcast(median)).select("n", "least", "median", "mean", "most")


def log_edges(low: float, high: float, n: int) -> list[float]:
    """``n`` edges, evenly spaced in the logarithm; the ends are exactly ``low`` and ``high``, so that nothing falls outside."""
    a, b = math.log10(low), math.log10(high)
    inner = [10 ** (a + (b - a) * i / (n - 1)) for i in range(1, n - 1)]
    return [low, *inner, high]


def linear_edges(low: float, high: float, bins: int) -> list[float]:
    return [low + (high - low) * i / bins for i in range(bins)] + [high]


def bin_counts(layer: DataFrame, edges: list[float], column: str = "area_ha", keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys..., bin, n``: bins are closed on the left, the last on both sides; bins without rows are left out."""
    bounds = F.array(*(F.lit(float(e)) for e in edges))
    at = F.size(F.filter(bounds, lambda e: e <= F.col(column))) - 1
    inside = layer.where((F.col(column) >= edges[0]) & (F.col(column) <= edges[-1]))
    return inside.withColumn("bin", F.least(at, F.lit(len(edges) - 2))).groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def histogram(layer: DataFrame, bins: int = 40, log: bool = True, edges_are_bins: bool = False, column: str = "area_ha", keys: tuple[str, ...] = ()) -> DataFrame:
    """Binned counts over the range of the positive finite values.

    ``edges_are_bins``: ``bins`` edges, so one bin fewer; else ``bins`` bins. All values alike: one bin.
    """
    layer = positive(layer, column)
    row = layer.agg(F.min(column).alias("a"), F.max(column).alias("b")).first()
    if row["a"] is None:
        raise DataContractError("no positive areas")
    a, b = float(row["a"]), float(row["b"])
    if a == b:
        edges = [a, b]
    elif log:
        edges = log_edges(a, b, bins if edges_are_bins else bins + 1)
    else:
        edges = linear_edges(a, b, bins)
    return bin_counts(layer, edges, column, keys)


def area_change(before: Column, after: Column) -> list[Column]:
    """Total area before and after, and the change in percent (0 where there was none)."""
    a, b = F.sum(before), F.sum(after)
    return [a.alias("before"), b.alias("after"), F.when(a > 0, (b - a) * 100.0 / a).otherwise(0.0).alias("delta_pct")]


def require_rows(layer: DataFrame, what: str) -> DataFrame:
    if layer.isEmpty():
        raise EmptyInputError(f"no {what}")
    return layer
