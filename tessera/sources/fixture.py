"""Driver tables and the pixel fixture derived from them.

The engine's real input is a gridded raster (a wide pixel table or a tile
table, see ``tessera.sources.grid``). The driver ships TPC-H-like tables
instead, so a deterministic pixel table is derived from ``orders``: a
720 x 1440 grid of 0.25-degree pixels with integer values (exact in FLOAT
in any summation order) that holds nodata, NaN, zero and negative values.
Its size grows with the ``orders`` table.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .grid import GridSpec

# --- fixed values of the fixture ---------------------------------------------------
FIXTURE_GRID = GridSpec(
    origin_lon=-180.0,
    origin_lat=90.0,
    dx=0.25,
    dy=0.25,
    height=720,
    width=1440,
    nodata=-99999.0,
    crs="EPSG:4326",
)
FIXTURE_YEARS = [2025, 2050, 2100]
FIXTURE_YEARS_6 = [2025, 2030, 2040, 2050, 2060, 2100]  # with a year that has no valid value
FIXTURE_SCENARIO = "SSP2"
COLUMN_STRIDE = 89  # column step between consecutive 720-pixel runs of keys: runs lie all around the globe
ORDERS_COLUMNS = "o_orderkey BIGINT, o_custkey BIGINT"
# -------------------------------------------------------------------------------------

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: str | None = None) -> DataFrame:
    """A driver table; with ``schema`` the columns are declared, not inferred
    from file footers (and only those columns are read)."""
    r = spark.read.schema(schema) if schema else spark.read
    return r.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def pixel_view(spark: SparkSession, sf_dir: str, six_years: bool = False) -> DataFrame:
    """``pixel_id, r, c, lat, lon, pop_2025, pop_2050, pop_2100``; ``six_years``: also
    pop_2030 (nodata throughout), pop_2040 (halves) and pop_2060 (with infinities).

    Reads two columns of ``orders``; the expressions are the fixture SQL,
    parsed by Spark (one JVM call per column instead of one per operator).
    The rows are dealt out here, whatever their number: a pixel table is many
    files, ``orders`` is one row group and would be read by a single task.
    """
    g = FIXTURE_GRID
    o = read_table(spark, sf_dir, "orders", ORDERS_COLUMNS).selectExpr(
        "o_orderkey AS pixel_id",
        "o_custkey AS cust",
        f"o_orderkey % {g.height} AS r",
        f"(CAST(floor(o_orderkey / CAST({g.height} AS DOUBLE)) AS BIGINT) * {COLUMN_STRIDE}) % {g.width} AS c",
    )
    more = [
        "CAST(-99999 AS FLOAT) AS pop_2030",
        "CAST(cust % 9 AS FLOAT) * CAST(0.5 AS FLOAT) AS pop_2040",
        "CASE WHEN pixel_id % 83 = 0 THEN CAST('Infinity' AS FLOAT) ELSE CAST(cust % 50 AS FLOAT) END AS pop_2060",
    ]
    return o.repartition(spark.sparkContext.defaultParallelism).selectExpr(
        *(more if six_years else []),
        "pixel_id",
        "r",
        "c",
        f"CAST({g.origin_lat!r} AS DOUBLE) - (CAST(r AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST({g.dy!r} AS DOUBLE) AS lat",
        f"CAST({g.origin_lon!r} AS DOUBLE) + (CAST(c AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST({g.dx!r} AS DOUBLE) AS lon",
        "CAST(CASE WHEN pixel_id % 97 = 0 THEN -99999 ELSE cust % 500 END AS FLOAT) AS pop_2025",
        "CASE WHEN pixel_id % 89 = 0 THEN CAST('NaN' AS FLOAT) "
        "ELSE CAST((cust + pixel_id) % 400 AS FLOAT) END AS pop_2050",
        "CAST(CASE WHEN pixel_id % 11 = 0 THEN 0 WHEN pixel_id % 13 = 0 THEN -5 "
        "ELSE cust % 300 END AS FLOAT) AS pop_2100",
    )
