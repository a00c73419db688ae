"""Dataset metadata document (K4), built and written by Spark.

Cells, id range and totals per resolution are observed metrics of the job that
writes the index (at most 16 resolutions), so nothing is read back; the driver
only adds the run parameters.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values of the metadata document ------------------------------------------------
LAYOUT_NOTE = "one folder per resolution, files sorted by h3_index"
AGGREGATION_NOTE = "every cell holds the total of the valid pixels whose centres it contains"
ID_NOTE = (
    "h3_index is a BIGINT cell id; tessera.functions.cells gives its hex text, "
    "centre lat/lng, area and boundary"
)
METADATA_SCHEMA = (
    "dataset string, source map<string, string>, crs string, cell_system string, h3_resolutions array<int>, scenario string, "
    "years array<int>, layout string, columns map<string, string>, h3_index_note string, aggregation string, compression string, "
    "cells_per_resolution map<string, bigint>, ids_per_resolution map<string, struct<first: bigint, last: bigint>>, "
    "totals_per_resolution map<string, map<string, double>>, processing_time_seconds double, processing_date string"
)
# ---------------------------------------------------------------------------------------------


def write_statistics(pop_cols: list[str], resolutions: list[int]) -> list:
    """Aggregates for ``observe``: cells, id range and totals of every resolution, named ``<what>_<res>``."""
    out = []
    for r in resolutions:
        here = lambda c, r=r: F.when(F.col("h3_res") == F.lit(int(r)), c)
        out.append(F.count(here(F.lit(1))).alias(f"cells_{r}"))
        out.append(F.min(here(F.col("h3_index"))).alias(f"first_{r}"))
        out.append(F.max(here(F.col("h3_index"))).alias(f"last_{r}"))
        out += [F.sum(here(F.col(c).cast("double"))).alias(f"{c}_{r}") for c in pop_cols]
    return out


def metadata_frame(
    spark: SparkSession,
    statistics: dict,
    scenario: str,
    years: list[int],
    resolutions: list[int],
    elapsed_s: float,
    crs: str = "EPSG:4326",
    source: dict | None = None,
    cell_system: str = "hex",
    zstd_level: int = 3,
) -> DataFrame:
    """One-row frame with the nested metadata, from the statistics that the write took (``write_statistics``).

    Resolutions without a cell are listed in ``h3_resolutions`` only.
    """
    cells = {str(r): int(statistics[f"cells_{r}"]) for r in resolutions if statistics.get(f"cells_{r}")}
    ids = {r: (int(statistics[f"first_{r}"]), int(statistics[f"last_{r}"])) for r in cells}
    pops = [f"pop_{int(y)}" for y in years]
    totals = {r: {c: statistics.get(f"{c}_{r}") for c in pops} for r in cells}
    columns = {"h3_index": "cell id (int64)"}
    columns.update({f"pop_{y}": f"people in the cell in {y}, as a 32-bit float" for y in years})
    row = (
        "population", {k: str(v) for k, v in sorted((source or {}).items())}, crs, cell_system, [int(r) for r in resolutions], scenario,
        [int(y) for y in years], LAYOUT_NOTE, columns, ID_NOTE, AGGREGATION_NOTE, f"ZSTD level {zstd_level}", cells, ids, totals,
        round(float(elapsed_s), 1), time.strftime("%Y-%m-%d"),
    )
    return spark.createDataFrame([row], METADATA_SCHEMA)


def write_metadata(meta: DataFrame, path: str) -> str:
    """Write the one-row document as JSON (a single part file)."""
    meta.coalesce(1).write.mode("overwrite").json(path)
    return path
