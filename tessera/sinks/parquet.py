"""Sorted, partitioned, zstd Parquet output of the index (K2, K3, O1).

Layout: ``<base>/scenario=<S>/h3_res=<N>/part-*.parquet``. Within one
resolution the part files hold disjoint, increasing id ranges and each file
is sorted, so the dataset is totally ordered by ``h3_index`` and row-group
min/max statistics let a reader skip everything outside an id range.

Plan: ``Exchange rangepartitioning(h3_res, h3_index)`` -> ``Sort`` -> write.
The range exchange moves the *aggregated* index (output size), not pixels;
its partition count is left to AQE (advisory partition size), so file size
follows the data instead of a fixed count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values of the output format --------------------------------------------------
ZSTD_LEVEL = 3
ROW_GROUP_ROWS = 1_000_000
# --------------------------------------------------------------------------------------------


def sorted_for_write(index: DataFrame, n_partitions: int | None = None, key: str = "h3_index") -> DataFrame:
    """O1: range-partition on (h3_res, h3_index) and sort within partitions."""
    keys = ["h3_res", key]
    parted = index.repartitionByRange(n_partitions, *keys) if n_partitions else index.repartitionByRange(*keys)
    return parted.sortWithinPartitions(*keys)


def write_index(
    index: DataFrame,
    base: str,
    scenario: str,
    n_partitions: int | None = None,
    zstd_level: int = ZSTD_LEVEL,
    row_group_rows: int = ROW_GROUP_ROWS,
    fresh: bool = False,
    observe: tuple | None = None,
) -> str:
    """K2 + K3: write ``h3_index, pop_*`` partitioned by scenario and resolution.

    ``fresh``: into a folder of its own, which must not exist (a version, see
    ``snapshots``). Otherwise dynamic partition overwrite: rewriting one scenario/resolution
    leaves the others in place. A task retried after an executor loss rewrites only its
    own attempt files (the commit protocol publishes one attempt). ``observe``: an
    Observation and its aggregates, taken of the rows as they are written.
    """
    df = sorted_for_write(index.withColumn("scenario", F.lit(scenario)), n_partitions)
    if observe is not None:  # above the last exchange: rows of a retried task count once
        df = df.observe(observe[0], *observe[1])
    writer = df.write.mode("errorifexists") if fresh else df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (
        writer.option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(zstd_level))
        .option("parquet.block.row.count.limit", str(row_group_rows))
        .partitionBy("scenario", "h3_res")
        .parquet(base)
    )
    return base


def write_curve_index(
    index: DataFrame,
    base: str,
    scenario: str,
    n_partitions: int | None = None,
    zstd_level: int = ZSTD_LEVEL,
    row_group_rows: int = ROW_GROUP_ROWS,
) -> str:
    """O1 for boxes: the same layout with a column ``h3_curve`` and sorted by it, so that row groups and files cover compact
    areas instead of stripes from pole to pole (``operators.analytics.where_bbox_curve`` reads it). ``base`` must be new."""
    from ..functions.curve import curve

    placed = index.withColumns({"scenario": F.lit(scenario), "h3_curve": curve("h3_index")})
    (
        sorted_for_write(placed, n_partitions, "h3_curve").write.mode("errorifexists")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(zstd_level))
        .option("parquet.block.row.count.limit", str(row_group_rows))
        .partitionBy("scenario", "h3_res")
        .parquet(base)
    )
    return base


def write_legacy_index(
    index: DataFrame,
    base: str,
    scenario: str,
    n_partitions: int | None = None,
    zstd_level: int = ZSTD_LEVEL,
    row_group_rows: int = ROW_GROUP_ROWS,
) -> str:
    """K8: the legacy layout -- VARCHAR id, WKB point geometry, FLOAT lat/lon/area,
    pop_* -- same partitioning, order and compression as ``write_index``.

    The geometry column is plain WKB (BINARY); Spark writes no GeoParquet
    ``geo`` footer key.
    """
    from ..operators.analytics import legacy_view

    ordered = sorted_for_write(index.withColumn("scenario", F.lit(scenario)), n_partitions)
    v1 = legacy_view(ordered)
    (
        v1.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.compression.codec.zstd.level", str(zstd_level))
        .option("parquet.block.row.count.limit", str(row_group_rows))
        .partitionBy("scenario", "h3_res")
        .parquet(base)
    )
    return base


def write_pixel_table(pixels: DataFrame, path: str, lat: str = "lat", lon: str = "lon") -> str:
    """Store a wide pixel table clustered by 5-degree window (then lat, lon).

    Every read split then covers a compact region, so a map task of the
    index build touches only that region's cells and its partial aggregate
    ships about one row per cell: the aggregation exchange is bounded by the
    number of cells (fixed by geography) instead of the number of pixels.
    Row-group statistics on lat/lon also become tight, so window reads prune.
    """
    from ..sources.grid import window_index

    clustered = (
        pixels.withColumn("_win", window_index(lat, lon))
        .repartitionByRange("_win", F.col(lat).desc(), lon)  # a hot window is split
        .sortWithinPartitions("_win", F.col(lat).desc(), lon)
        .drop("_win")
    )
    clustered.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path
