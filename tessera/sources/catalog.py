"""Raster catalog: map raster files (or bands) to years.

Files are listed by Spark's ``binaryFile`` source without reading their
bodies; the year comes from the first match of the year pattern in the file
stem. A multi-band raster gives one row per band, the year taken from the
band description or else from its position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the catalog -------------------------------------------------------
YEAR_PATTERN = r"(20[2-9]\d|21\d{2})"  # 2020-2099 and 2100-2199
RASTER_GLOB = "*.tif"
FALLBACK_FIRST_YEAR = 2020  # band i without a year in its description -> 2020 + (i-1)*5
FALLBACK_STEP = 5
# ------------------------------------------------------------------------------------------


def file_stem(path) -> F.Column:
    """File name without its last suffix (``a/b/pop_2030.tif`` -> ``pop_2030``)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, r"([^/]+?)(\.[^./]*)?$", 1)


def catalog_from_paths(paths: DataFrame) -> DataFrame:
    """S1 on a ``path`` column: ``year INT, path STRING, band INT`` for files
    whose stem holds a year, ordered by year then path."""
    year = F.regexp_extract(file_stem("path"), YEAR_PATTERN, 1)
    return (
        paths.select("path", year.alias("y"))
        .where(F.col("y") != "")
        .select(F.col("y").cast("int").alias("year"), "path", F.lit(1).alias("band"))
        .orderBy("year", "path")
    )


def discover_rasters(
    spark: SparkSession, root: str, glob: str = RASTER_GLOB, bands: DataFrame | None = None
) -> DataFrame:
    """Recursive listing under ``root`` -> catalog (lazy).

    ``bands`` (``path, band, description`` of multi-band files, see
    ``multiband_catalog``) is used for the files found when no file name
    holds a year.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path")
    )
    named = catalog_from_paths(files)
    if bands is None or not named.isEmpty():
        return named
    stems = files.select(file_stem("path").alias("stem"))
    return multiband_catalog(bands.withColumn("stem", file_stem("path")).join(stems, "stem", "left_semi").drop("stem"))


def multiband_catalog(bands: DataFrame) -> DataFrame:
    """S2 on ``path, band INT (1-based), description STRING`` of one file:
    year from the description, else ``2020 + (band - 1) * 5``."""
    found = F.regexp_extract(F.coalesce(F.col("description"), F.lit("")), YEAR_PATTERN, 1)
    year = F.when(found != "", found.cast("int")).otherwise(
        F.lit(FALLBACK_FIRST_YEAR) + (F.col("band") - F.lit(1)) * F.lit(FALLBACK_STEP)
    )
    return bands.select(year.cast("int").alias("year"), "path", F.col("band").cast("int").alias("band")).orderBy(
        "year", "band"
    )


def check_catalog(catalog: DataFrame) -> list[int]:
    """Years of a catalog (at most a few dozen rows); fails when empty or
    when a year appears twice."""
    years = [r["year"] for r in catalog.select("year").collect()]
    if not years:
        raise FileNotFoundError("no rasters with a year found")
    if len(set(years)) != len(years):
        raise ValueError(f"duplicate years in catalog: {sorted(years)}")
    return sorted(years)
