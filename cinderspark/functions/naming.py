"""Keys from file names, years from dates, and the names of outputs, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinderspark.errors import DataContractError

#: The regions that have a classification.
REGIONS = ("1", "2", "4", "6")
#: The files of the lasting masks by land-cover code, of all-years farmland, and, by year, of rivers and lakes, of
#: infrastructure and of everything.
MASK_FILES = {
    29: "mascara_alfloramiento_rocoso_acumulado.tif",
    23: "mascara_arena_playa_duna_acumulado.tif",
    61: "mascara_salar_acumulado.tif",
    34: "mascara_hielo_nieve_acumulado.tif",
    25: "mascara_otra_area_sin_vegetacion_acumulado.tif",
    18: "mascara_agricultura_interseccion_todos_anos.tif",
}
YEARLY_MASK_FILES = {33: "mascara_rio_lago_{year}.tif", 24: "mascara_infraestructura_{year}.tif", None: "mascara_total_{year}.tif"}
#: The patterns of years and regions in file stems, of a training sample's id, and of its file; the model's name.
YEAR_PATTERN, REGION_PATTERN = r"(20\d{2})", "_r([0-9]+)_"
SAMPLE_PATTERN, TRAINING_PATTERN = r"_v(\d+)_.*?_r(\d+)(?:_[^_]+)*?_(\d{4})", r"^.*_({version})_.*_{region}_.*\.tif$"
MODEL_FORMAT = "col1_%s_%s_%s_rnn_lstm_ckpt"


def year_of_stem(stem: Column) -> Column:
    """The first 20xx anywhere in a file stem; null where there is none."""
    found = F.regexp_extract(stem, YEAR_PATTERN, 1)
    return F.when(found != "", found.cast("int"))


def required_year(stem: Column) -> Column:
    """:func:`year_of_stem`, which fails the query where a stem has no year."""
    year = year_of_stem(stem)
    return F.when(year.isNull(), F.raise_error(F.concat(F.lit("no year in file name: "), stem)).cast("int")).otherwise(year)


def region_of_stem(stem: Column, allowed: tuple[str, ...] = REGIONS) -> Column:
    """The number of the first ``_r<digits>_``; null if there is none or it isn't allowed."""
    found = F.regexp_extract(stem, REGION_PATTERN, 1)
    return F.when(found.isin(*allowed), found)


def part_of_stem(stem: Column, i: int) -> Column:
    """Part ``i`` (from 0) of a stem split at underscores; null if it has fewer."""
    return F.try_element_at(F.split(stem, "_"), F.lit(i + 1))


def positional_year(stem: Column) -> Column:
    """The fourth part as a year; fails the query if it is no number."""
    return part_of_stem(stem, 3).cast("int")


def sample_model_id(name: Column) -> Column:
    """``v<version>_r<region>`` of a training sample's name; null where it has no version, region and year."""
    version, region = F.regexp_extract(name, SAMPLE_PATTERN, 1), F.regexp_extract(name, SAMPLE_PATTERN, 2)
    return F.when(version != "", F.concat(F.lit("v"), version, F.lit("_r"), region))


def is_training_file(name: Column, version: str, region: str) -> Column:
    """Whether a name has the version, and, after another underscore at least, the region."""
    return name.rlike(TRAINING_PATTERN.replace("{version}", re.escape(version)).replace("{region}", re.escape(region)))


def filtered_name(stem: Column, stamp: Column) -> Column:
    return F.concat(stem, F.lit("_filtered_"), stamp)


def mask_name(stem: Column, value: Column) -> Column:
    """A mask's polygons; the value is cut to a whole number."""
    return F.concat(stem, F.lit("_mask"), value.cast("int").cast("string"))


def scar_name(scar_id: Column, area_ha: Column, year: Column) -> Column:
    """``<id>_<area>ha_<year>``; the area is rounded half to even."""
    return F.concat(scar_id, F.lit("_"), F.bround(area_ha, 0).cast("long").cast("string"), F.lit("ha_"), year.cast("string"))


def model_name(country: Column, version: Column, region: Column) -> Column:
    return F.format_string(MODEL_FORMAT, country, version, region)


def run_stamp(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd_HHmmss")


def iso_or_prefix_year(text: Column) -> Column:
    """The year of an ISO date in the first ten characters, else the first four as a number; fails on blank or other text."""
    t = F.trim(text)
    iso = F.year(F.substring(t, 1, 10).try_cast("date"))
    blank = F.raise_error(F.lit("empty date")).cast("int")
    return F.when(t == "", blank).otherwise(F.coalesce(iso, F.substring(t, 1, 4).cast("int")))


def prefix_year(text: Column) -> Column:
    """The first four characters as a year; fails the query where they are no number."""
    return F.substring(text.cast("string"), 1, 4).cast("int")


def coerced_year(text: Column) -> Column:
    """The year of a date or time in text; null where it is none."""
    return F.year(F.coalesce(text.try_cast("timestamp"), F.try_to_timestamp(text, F.lit("yyyy/MM/dd"))))


def year_column(columns: list[str], text: str = "IgnDate") -> Column:
    """Column ``year`` if there is one, else the year of the ignition date."""
    return F.col("year").cast("int") if "year" in columns else iso_or_prefix_year(F.col(text).cast("string"))


def year_bounds_ms(year: Column) -> tuple[Column, Column]:
    """Epoch milliseconds of January 1 and December 31 at midnight, in the session's time zone."""
    at = lambda month, day: F.unix_millis(F.make_timestamp(year, F.lit(month), F.lit(day), F.lit(0), F.lit(0), F.lit(0)))
    return at(1, 1), at(12, 31)


def year_between(column: str, first: int, last: int) -> Column:
    """A half-open range of time stamps, which reaches the Parquet scan as year() = would not."""
    return (F.col(column) >= F.lit(f"{first:04d}-01-01").cast("timestamp_ntz")) & (F.col(column) < F.lit(f"{last + 1:04d}-01-01").cast("timestamp_ntz"))


def parse_years(text: str) -> list[int]:
    """A comma-separated list; blanks are skipped, none left is an error."""
    years = [int(x) for x in (part.strip() for part in text.split(",")) if x]
    if not years:
        raise DataContractError("no years are given")
    return years


def tick_label(ha: Column) -> Column:
    """Hectares on an axis: grouped from 1000, whole from 1, else as short as can be."""
    whole = F.bround(ha, 0).cast("long")
    short = F.regexp_replace(F.regexp_replace(F.format_string("%.6f", ha), "0+$", ""), r"\.$", "")
    return F.when(ha >= 1000, F.format_number(whole, 0)).when(ha >= 1, whole.cast("string")).otherwise(short)


def legacy_model(name: Column) -> Column:
    """``country, version, region`` of an older model's name, its second to fourth parts; null with fewer than four."""
    part = F.split(name, "_")
    return F.when(F.size(part) >= 4, F.struct(part[1].alias("country"), part[2].alias("version"), part[3].alias("region")))


def legacy_mosaic(name: Column) -> Column:
    """``satellite, year`` of an older mosaic's name, its first and fourth parts; null with fewer than four."""
    part = F.split(name, "_")
    return F.when(F.size(part) >= 4, F.struct(part[0].alias("satellite"), part[3].cast("int").alias("year")))


def first_only(rows: DataFrame, order: list[str], simulate: bool) -> DataFrame:
    """All rows, or for a simulation the first in order."""
    return rows.orderBy(*order).limit(1) if simulate else rows
