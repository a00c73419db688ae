"""Output diagnostics of a written index.

    python -m tessera.plans.diagnostics --base PATH [--scenario SSP2]

One Spark job per report, over all resolutions at once (the per-file loop
becomes a ``groupBy("h3_res")``): file listing with sizes (S10), schema
(S8), extent statistics (A4), population statistics for every year
column (S9, A5), the ten most populated cells of the coarsest
resolution with density (O2, F13) and the footer audit (S11).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import cells
from ..operators import analytics as A
from ..sources.index_reader import cell_system, describe, list_files, read_index
from ..sources.layout import layout_audit

# --- fixed values of the report ---------------------------------------------------------
TOP_CELLS = 10
# ------------------------------------------------------------------------------------------


def run_diagnostics(spark: SparkSession, base: str, scenario: str = "SSP2") -> dict[str, DataFrame]:
    """Lazy report frames, keyed by section."""
    system = cell_system(spark, base, scenario)
    if system not in (None, "hex"):
        raise ValueError(f"the index at {base} has ids of the system {system!r}; its cells can't be decoded here")
    idx = read_index(spark, base, scenario)
    pops = A.pop_columns(idx)
    coarsest = idx.agg(F.min("h3_res")).first()[0]  # one number, from partition values
    top = A.top_k(
        idx.where(F.col("h3_res") == F.lit(coarsest))
        .select(
            cells.cell_to_string("h3_index").alias("h3_hex"),
            "h3_index",
            cells.cell_lat("h3_index").cast("float").alias("lat"),
            cells.cell_lng("h3_index").cast("float").alias("lon"),
            cells.cell_area_km2("h3_index").cast("float").alias("area_km2"),
            pops[0],
        )
        .withColumn("density_per_km2", A.density(pops[0], "area_km2")),
        pops[0],
        TOP_CELLS,
    )
    return {
        "files": list_files(spark, base),
        "schema": describe(spark, idx.drop("scenario")),
        "extent": A.extent_stats(idx),
        "population": A.population_stats(idx, pops),
        "top_cells": top,
        "layout": layout_audit(list_files(spark, base)),
    }


def main(argv=None) -> None:
    from ..session import get_spark

    p = argparse.ArgumentParser(description="Diagnostics of a written cell index")
    p.add_argument("--base", required=True)
    p.add_argument("--scenario", default="SSP2")
    a = p.parse_args(argv)
    spark = get_spark("tessera-diagnostics")
    for name, df in run_diagnostics(spark, a.base, a.scenario).items():
        print(f"--- {name} ---")
        df.show(50, truncate=False)


if __name__ == "__main__":
    main()
