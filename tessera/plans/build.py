"""The index-build job (E1): pixels -> mask -> cells -> group-sum -> sorted Parquet + metadata.

One lazy plan with one aggregation exchange and one range exchange:

    scan -> Filter(mask) -> Generate(resolutions) -> HashAggregate(partial)
      -> Exchange hash(h3_res, h3_index) -> HashAggregate(final)
      -> Exchange range(h3_res, h3_index) -> Sort -> write partitioned Parquet

Every build writes a version folder of its own and makes it current by one rename
(``sinks.snapshots``). The metadata's counts, id ranges and totals are observed
metrics of the write, so nothing is read back or recomputed, and a lost executor
only costs its own tasks.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.index import DEFAULT_RESOLUTIONS, build_index, validate_resolutions
from ..sinks.manifest import write_marker
from ..sinks.metadata import metadata_frame, write_metadata, write_statistics
from ..sinks.parquet import write_index
from ..sinks.snapshots import Snapshot, begin, commit
from ..sources.grid import GridSpec, n_windows, pop_col, window_lattice
from ..sources.index_reader import read_snapshot

# --- fixed values of the job surface ------------------------------------------------------
SCENARIOS = ("SSP1", "SSP2", "SSP3", "SSP4", "SSP5")
DEFAULT_SCENARIO = "SSP2"
METADATA_NAME = "_index_metadata.json"
# ----------------------------------------------------------------------------------------------


def validate_scenario(scenario: str) -> str:
    """J1."""
    if scenario not in SCENARIOS:
        raise ValueError(f"scenario must be one of {SCENARIOS}, got {scenario!r}")
    return scenario


def parse_resolutions(text: str) -> list[int]:
    """``"1,2,3"`` -> [1, 2, 3], validated."""
    return validate_resolutions([int(t) for t in str(text).split(",") if t.strip()])


def plan_index(spark: SparkSession, years: list[int], resolutions=DEFAULT_RESOLUTIONS) -> DataFrame:
    """J3 dry run: every window with the work it implies, nothing read.

    ``plan_index(...).limit(5)`` shows the first windows; the counts are the
    per-window task sizes (years x resolutions).
    """
    res = validate_resolutions(resolutions)
    n_lon, n_lat = n_windows()
    return window_lattice(spark).select(
        "*",
        F.lit(len(years)).alias("n_years"),
        F.lit(len(res)).alias("n_resolutions"),
        F.lit(n_lon * n_lat).alias("n_windows_total"),
    )


def build_population_index(
    spark: SparkSession,
    pixels: DataFrame,
    grid: GridSpec,
    years: list[int],
    out_base: str,
    scenario: str = DEFAULT_SCENARIO,
    resolutions=DEFAULT_RESOLUTIONS,
    system: str = "hex",
    source: dict | None = None,
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Run E1 and return the written index (read back, lazily).

    ``pixels`` is a wide pixel table with ``lat``, ``lon`` and ``pop_<year>``
    columns (or see ``tessera.sources.grid`` for tile tables).
    """
    validate_scenario(scenario)
    res = validate_resolutions(resolutions)
    grid.check_geographic()
    nodata = grid.nodata_float32()
    if len(set(years)) != len(years):
        raise ValueError(f"duplicate years: {years}")
    pop_cols = [pop_col(y) for y in years]
    missing = [c for c in pop_cols if c not in pixels.columns]
    if missing:
        raise ValueError(f"pixel table lacks {missing}")

    t0 = time.time()
    index = build_index(pixels, pop_cols, res, nodata, system=system, lat=lat, lon=lon)
    return publish_index(spark, index, out_base, scenario, years, res, grid, system, source, t0)


def stage_index(
    spark: SparkSession,
    index: DataFrame,
    out_base: str,
    scenario: str,
    years: list[int],
    res: list[int],
    grid: GridSpec,
    system: str = "hex",
    source: dict | None = None,
    started: float | None = None,
    run_key: str | None = None,
) -> Snapshot:
    """Write a new version of the index and its metadata; readers don't see it until it is committed."""
    snapshot = begin(out_base, scenario, years, res, run_key)
    taken = Observation()
    write_index(index, snapshot.root, scenario, fresh=True, observe=(taken, write_statistics([pop_col(y) for y in years], res)))
    meta = metadata_frame(
        spark, taken.get, scenario, list(years), res, time.time() - (started or time.time()), crs=grid.crs, source=source, cell_system=system
    )
    # beside the data of the scenario. Spark's file listing keeps every name that
    # starts with "_metadata" (Parquet summary files), so "_metadata.json" would be
    # read as data; any other underscore name is skipped by readers.
    write_metadata(meta, f"{snapshot.root}/scenario={scenario}/{METADATA_NAME}")
    return snapshot


def publish_index(
    spark: SparkSession,
    index: DataFrame,
    out_base: str,
    scenario: str,
    years: list[int],
    res: list[int],
    grid: GridSpec,
    system: str = "hex",
    source: dict | None = None,
    started: float | None = None,
    run_key: str | None = None,
) -> DataFrame:
    """Write a version and its metadata, make it current, then write the completion marker; that version, read back."""
    staged = stage_index(spark, index, out_base, scenario, years, res, grid, system, source, started, run_key)
    snapshot = commit(spark, out_base, staged)
    write_marker(spark, marker_path(out_base, scenario), time.strftime(f"index {snapshot.version} finished %Y-%m-%dT%H:%M:%S\n"))
    return read_snapshot(spark, snapshot)


def marker_path(out_base: str, scenario: str) -> str:
    """K7, for people and schedulers; readers go by the pointer, which is right at any time."""
    return f"{out_base.rstrip('/')}/_COMPLETE_{scenario}"
