"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Most are lazy. Those that show a writer or the published index (``*_written*``,
``index_resumable``, ``index_file_ranges``, ``metadata_json``, ``pub_*``) run the job
that writes it first and return what is read back.

Inputs are the driver tables: the pixel fixture is derived from ``orders``
(``tessera.sources.fixture``), so every query's work grows with the data.
Names follow the operator ids of the survey (in brackets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import cells
from ..functions.num import round_to_bigint, sql_float_div, sql_is_finite
from ..operators import analytics as A
from ..operators import index as X
from ..operators import inspect as I
from ..operators.mask import apply_mask, mask_counts, sql_is_nodata
from ..sinks import manifest as M
from ..sources.fixture import FIXTURE_GRID, FIXTURE_SCENARIO, FIXTURE_YEARS, FIXTURE_YEARS_6, pixel_view
from ..sources.grid import (
    stack_years,
    tiles_to_pixels,
    tiles_to_wide_pixels,
    unstack_years,
    wide_pixels_to_tiles,
    window_lattice,
    window_columns,
    window_index,
)

# --- fixed parameters of the registered queries ------------------------------------------
POP = [f"pop_{y}" for y in FIXTURE_YEARS]
NODATA = FIXTURE_GRID.nodata
ALL_RES = [1, 2, 3, 4, 5, 6, 7, 8]
RES = 5  # the resolution of the published examples
TOPK_POP = 20
TOPK_DENSITY = 10
GROWTH_MIN_POP = 400.0  # "pop_2025 > threshold", scaled to the fixture's values
BBOX_MAIN = (20.0, 35.0, 68.0, 90.0)  # lat_min, lat_max, lng_min, lng_max
BBOX_LIMITED = (35.0, 45.0, -10.0, 5.0)
BBOX_LIMIT = 100
BBOX_FIXTURE = (-30.0, 30.0, 55.0, 70.0)  # a box the sf0.01 pixels cover
TILE = 32  # tile side of the tile-table round trip
PIXEL_ORDER = ["pixel_id"]  # of the pixels at one position: the k-th is the k-th layer's
RESUME_DONE_WEST_BELOW = 0.0  # first half of a run: windows west of 0 are done
# ---------------------------------------------------------------------------------------------


def _pixels(spark: SparkSession, sf: str) -> DataFrame:
    return pixel_view(spark, sf)


def _valid(spark: SparkSession, sf: str) -> DataFrame:
    return apply_mask(_pixels(spark, sf), POP, NODATA)


def _index(spark: SparkSession, sf: str, res=(RES,)) -> DataFrame:
    return X.build_index(_pixels(spark, sf), POP, list(res), NODATA)


def _index_attrs(spark: SparkSession, sf: str) -> DataFrame:
    """Single-resolution index with FLOAT lat/lng/area (the legacy column types)."""
    idx = _index(spark, sf).drop("h3_res")
    c = "h3_index"
    return idx.withColumns(
        {
            "lat": cells.cell_lat(c, RES).cast("float"),
            "lng": cells.cell_lng(c, RES).cast("float"),
            "area_km2": cells.cell_area_km2(c, RES).cast("float"),
        }
    )


# --- pixels, mask, grid -----------------------------------------------------------------


def valid_pixels(spark, sf):
    """[F2-F8] pixels kept by the mask."""
    return _valid(spark, sf)


def pixel_mask_counts(spark, sf):
    """[F4-F7] what each rule removes."""
    return mask_counts(_pixels(spark, sf), POP, NODATA)


def year_unpivot_pivot(spark, sf):
    """per-year rasters (long) aligned back into one wide row per pixel."""
    long = unstack_years(_pixels(spark, sf), ["pixel_id"], FIXTURE_YEARS)
    return stack_years(long, ["pixel_id"], FIXTURE_YEARS, NODATA)


def tiles_roundtrip(spark, sf):
    """[S3, F3, F17] pixels -> dense tiles -> wide pixels (years aligned per tile) -> mask."""
    tiles = wide_pixels_to_tiles(_pixels(spark, sf), TILE, FIXTURE_YEARS, NODATA, PIXEL_ORDER)
    wide = tiles_to_wide_pixels(tiles, FIXTURE_GRID, TILE, FIXTURE_YEARS)
    return apply_mask(wide, POP, NODATA)


def window_cell_counts(spark, sf):
    """[F1, F3b, A7] per (window, resolution): valid pixels and distinct cells."""
    return X.window_cell_counts(_valid(spark, sf), ALL_RES)


def window_status(spark, sf):
    """[F1, A11] status of every lattice window: done (has valid pixels) or skipped."""
    per_win = (
        _valid(spark, sf)
        .select(window_index("lat", "lon").alias("win_idx"))
        .groupBy("win_idx")
        .agg(F.count(F.lit(1)).alias("n_valid"))
        .select(window_columns("win_idx")[0], "n_valid")
    )
    return M.window_status_counts(M.window_outcomes(window_lattice(spark), per_win))


def resume_windows(spark, sf):
    """[K6] windows still to process after a run recorded the western half as done."""
    per_win = (
        _valid(spark, sf)
        .select(window_index("lat", "lon").alias("win_idx"))
        .groupBy("win_idx")
        .agg(F.count(F.lit(1)).alias("n_valid"))
        .select(*window_columns("win_idx")[:3], "n_valid")
    )
    run_key = M.run_key(FIXTURE_SCENARIO, FIXTURE_YEARS, ALL_RES, FIXTURE_GRID, "fixture")
    done = M.manifest_rows(
        per_win.where(F.col("west") < RESUME_DONE_WEST_BELOW).select("win_id"), run_key, "done"
    )
    return M.pending_windows(per_win, done, run_key).select("win_id", "west", "south", "n_valid")


# --- index build ------------------------------------------------------------------------


def cell_assign_multi_res(spark, sf):
    """[G1, F18] one cell per valid pixel and resolution."""
    return X.assign_cells(_valid(spark, sf), ALL_RES, keep=["pixel_id"])


def index_all_res(spark, sf):
    """[A1, A2, F18] the multi-resolution index (v2 columns plus h3_res)."""
    return _index(spark, sf, ALL_RES)


def index_res5_sorted(spark, sf):
    """[O1] one resolution, totally ordered by id."""
    return _index(spark, sf).drop("h3_res").orderBy("h3_index")


def cells_per_resolution(spark, sf):
    """[A8] cells per resolution and the grand total (h3_res NULL)."""
    return X.cells_per_resolution(_index(spark, sf, ALL_RES))


def distinct_cells(spark, sf):
    """[A3] count(DISTINCT h3_index) per resolution."""
    return X.distinct_cells(X.assign_cells(_valid(spark, sf), ALL_RES, keep=[]))


def conservation(spark, sf):
    """[A10] world totals per resolution and of the valid pixels (h3_res NULL)."""
    return X.conservation_totals(_index(spark, sf, ALL_RES), _valid(spark, sf), POP)


# --- cell attributes ----------------------------------------------------------------------


def cell_attributes(spark, sf):
    """[F14, G3-G6] legacy-layout attributes: hex id, lat, lng, area (FLOAT)."""
    return _index_attrs(spark, sf).withColumn("h3_hex", cells.cell_to_string("h3_index"))


def hex_roundtrip(spark, sf):
    """[G2, G3] id -> hex text -> id, plus the resolution read from the id."""
    idx = _index(spark, sf, ALL_RES).select("h3_index")
    hx = idx.withColumn("h3_hex", cells.cell_to_string("h3_index"))
    return hx.select(
        "h3_index",
        "h3_hex",
        cells.string_to_cell("h3_hex").alias("h3_back"),
        cells.cell_res("h3_index").alias("res_of_id"),
    )


def cell_boundary(spark, sf):
    """[G7] six boundary vertices per cell, one row each."""
    idx = _index(spark, sf).select("h3_index")
    v = idx.select("h3_index", F.posexplode(cells.cell_boundary("h3_index", RES)).alias("vertex", "p"))
    return v.select(
        "h3_index",
        F.col("vertex").cast("int").alias("vertex"),
        F.col("p.lat").cast("float").alias("lat"),
        F.col("p.lng").cast("float").alias("lng"),
    )


# --- analytics on the index ---------------------------------------------------------------


def _top_population(idx: DataFrame) -> DataFrame:
    """The k best first (id and values only), attributes for those rows."""
    best = A.top_k(idx.select("h3_index", *POP), "pop_2025", TOPK_POP)
    return best.select(
        "h3_index",
        cells.cell_to_string("h3_index").alias("h3_hex"),
        cells.cell_lat("h3_index", RES).cast("float").alias("lat"),
        cells.cell_lng("h3_index", RES).cast("float").alias("lng"),
        *POP,
        A.growth_ratio("pop_2100", "pop_2025").alias("growth_ratio"),
    )


def _growth_hotspots(idx: DataFrame) -> DataFrame:
    ratio = A.growth_ratio("pop_2100", "pop_2025").alias("growth_ratio")
    grown = idx.where(F.col("pop_2025") > F.lit(GROWTH_MIN_POP)).select("h3_index", "pop_2025", "pop_2100", ratio)
    return A.top_k(grown, "growth_ratio", TOPK_POP).select(
        "h3_index",
        cells.cell_lat("h3_index", RES).cast("float").alias("lat"),
        cells.cell_lng("h3_index", RES).cast("float").alias("lng"),
        "pop_2025",
        "pop_2100",
        "growth_ratio",
    )


def topk_population(spark, sf):
    """[O2, F12, G3] most populated cells with growth ratio."""
    return _top_population(_index(spark, sf))


def topk_density(spark, sf):
    """[O2, F13] most populated cells with density per km^2 (legacy columns)."""
    best = A.top_k(_index(spark, sf).select("h3_index", "pop_2025"), "pop_2025", TOPK_DENSITY)
    area = f"CAST({cells.sql_cell_area('h3_index', RES)} AS FLOAT)"
    # one projection, which the top-k applies to its k rows
    return best.select(
        cells.cell_to_string("h3_index").alias("h3_index"),
        cells.cell_lat("h3_index", RES).cast("float").alias("lat"),
        cells.cell_lng("h3_index", RES).cast("float").alias("lon"),
        F.expr(area).alias("area_km2"),
        "pop_2025",
        F.expr(sql_float_div("pop_2025", area)).alias("density_per_km2"),
    )


def growth_hotspots(spark, sf):
    """[O3, F10, F12] fastest-growing cells above a population threshold."""
    return _growth_hotspots(_index(spark, sf))


def _bbox(spark, sf, box):
    la0, la1, lo0, lo1 = box
    idx = _index(spark, sf).drop("h3_res")
    sel = A.where_bbox(idx, la0, la1, lo0, lo1, res=RES)
    c = "h3_index"
    return sel.select(
        "h3_index",
        cells.cell_lat(c, RES).cast("float").alias("lat"),
        cells.cell_lng(c, RES).cast("float").alias("lng"),
        *POP,
    )


def bbox_cells(spark, sf):
    """cells whose centre is in the published example box."""
    return _bbox(spark, sf, BBOX_MAIN)


def bbox_cells_fixture(spark, sf):
    """the same operator on a box the small fixture covers."""
    return _bbox(spark, sf, BBOX_FIXTURE)


def bbox_limit(spark, sf):
    """[F9, O5] box selection with LIMIT (made deterministic by ordering on id)."""
    return _bbox(spark, sf, BBOX_LIMITED).select("h3_index", "pop_2025", "pop_2050").orderBy("h3_index").limit(BBOX_LIMIT)


def continent_totals(spark, sf):
    """[F11, A6, O4, F15] regional totals, SUM()::BIGINT, ordered by 2025 total."""
    return A.continent_totals(_index(spark, sf).drop("h3_res"), POP, res=RES)


def extent_stats(spark, sf):
    """[A4] per resolution: cells, centre extent, mean area."""
    return A.extent_stats(_index(spark, sf, ALL_RES))


def population_stats(spark, sf):
    """[A5, F15] per resolution and year: total, mean, max, cells with population."""
    return A.population_stats(_index(spark, sf, ALL_RES), POP)


def _float_stats(st: DataFrame) -> DataFrame:
    return st.select(
        "band",
        "year",
        F.col("min").cast("float").alias("min"),
        F.col("max").cast("float").alias("max"),
        F.col("mean").cast("float").alias("mean"),
        F.col("std").cast("float").alias("std"),
        "n_valid",
        "n_total",
        F.col("pct_valid").cast("float").alias("pct_valid"),
    )


def grid_stats_center(spark, sf):
    """[A9] centre-window value statistics of the raster (doubles as FLOAT)."""
    return _float_stats(I.grid_stats_center(pixel_view(spark, sf, six_years=True), FIXTURE_GRID, FIXTURE_YEARS_6))


def sample_points_q(spark, sf):
    """[O7] values at the centre and near-corner pixels, every year."""
    return I.sample_points(spark, pixel_view(spark, sf, six_years=True), FIXTURE_GRID, FIXTURE_YEARS_6)


def tile_conservation(spark, sf):
    """[S3, F17] per year: valid values and their total, in the pixels and read back from tiles."""
    px = _pixels(spark, sf)
    long = unstack_years(px, ["r", "c"], FIXTURE_YEARS)
    tiles = tiles_to_pixels(wide_pixels_to_tiles(px, TILE, FIXTURE_YEARS, NODATA, PIXEL_ORDER), FIXTURE_GRID, TILE)
    ok = F.expr(f"CASE WHEN {sql_is_finite('value')} AND NOT {sql_is_nodata('value', NODATA)} THEN CAST(value AS DOUBLE) END")
    sums = lambda df, name: df.groupBy("year").agg(F.count(ok).alias(f"n_{name}"), F.sum(ok).alias(f"total_{name}"))
    return sums(long, "pixels").join(sums(tiles, "tiles"), "year")


def half_even_totals(spark, sf):
    """halves summed per window and rounded half to even."""
    win = _valid(spark, sf).select(window_index("lat", "lon").alias("win_idx"), *POP)
    half = lambda p: F.sum(F.col(p).cast("double") * F.lit(0.5))
    sums = win.groupBy("win_idx").agg(
        half("pop_2025").alias("half_2025"),
        round_to_bigint(half("pop_2025")).alias("total_2025"),
        round_to_bigint(half("pop_2100")).alias("total_2100"),
    )
    return sums.select(window_columns("win_idx")[0], "half_2025", "total_2025", "total_2100")


def cell_points(spark, sf):
    """[K8, G8] the centre of every cell as a WKB point (hex), from FLOAT coordinates."""
    from ..functions.geometry import point_wkb

    p = _index_attrs(spark, sf).select("h3_index", F.col("lng").cast("double").alias("x"), F.col("lat").cast("double").alias("y"))
    return p.select("h3_index", F.hex(point_wkb(F.col("x"), F.col("y"))).alias("wkb_hex"))


QUERIES = {
    "valid_pixels": valid_pixels,
    "pixel_mask_counts": pixel_mask_counts,
    "year_unpivot_pivot": year_unpivot_pivot,
    "tiles_roundtrip": tiles_roundtrip,
    "window_cell_counts": window_cell_counts,
    "window_status": window_status,
    "resume_windows": resume_windows,
    "cell_assign_multi_res": cell_assign_multi_res,
    "index_all_res": index_all_res,
    "index_res5_sorted": index_res5_sorted,
    "cells_per_resolution": cells_per_resolution,
    "distinct_cells": distinct_cells,
    "conservation": conservation,
    "cell_attributes": cell_attributes,
    "hex_roundtrip": hex_roundtrip,
    "cell_boundary": cell_boundary,
    "topk_population": topk_population,
    "topk_density": topk_density,
    "growth_hotspots": growth_hotspots,
    "bbox_cells": bbox_cells,
    "bbox_cells_fixture": bbox_cells_fixture,
    "bbox_limit": bbox_limit,
    "continent_totals": continent_totals,
    "extent_stats": extent_stats,
    "population_stats": population_stats,
    "grid_stats_center": grid_stats_center,
    "sample_points": sample_points_q,
    "tile_conservation": tile_conservation,
    "half_even_totals": half_even_totals,
    "cell_points": cell_points,
}


# --- written index, resumable build, layout ---------------------------------------------------

STREAM_FILE_ROWS = 4_000  # rows a staged pixel file; their number grows with the data
STREAM_BATCH_BYTES = 512 << 10  # bytes a micro-batch takes, or more:
STREAM_BATCHES = 48  # a backlog is taken in about so many at most


def _written_index(spark, sf):
    """Write the multi-resolution index (K2, K3) and return its base folder."""
    from ..session import scratch_path
    from ..sinks.parquet import write_index

    base = scratch_path(spark, "index")
    write_index(_index(spark, sf, ALL_RES), base, FIXTURE_SCENARIO)
    return base


def index_written_readback(spark, sf):
    """[K2, K3, O1, S5] write sorted zstd Parquet, read one resolution back by partition filter."""
    from ..sources.index_reader import read_index

    base = _written_index(spark, sf)
    return read_index(spark, base, FIXTURE_SCENARIO, RES).select("h3_index", *POP)


def bbox_written(spark, sf):
    """[F9, S5] box selection on the written index: the id range reaches the Parquet scan."""
    from ..sources.index_reader import read_index

    base = _written_index(spark, sf)
    idx = read_index(spark, base, FIXTURE_SCENARIO, RES).select("h3_index", *POP)
    la0, la1, lo0, lo1 = BBOX_FIXTURE
    sel = A.where_bbox(idx, la0, la1, lo0, lo1, res=RES)
    c = "h3_index"
    return sel.select(
        "h3_index",
        cells.cell_lat(c, RES).cast("float").alias("lat"),
        cells.cell_lng(c, RES).cast("float").alias("lng"),
        *POP,
    )


def index_resumable(spark, sf):
    """[K1, K5, K6, S4, A2] window-batched build on a file stream, partials merged."""
    from ..session import scratch_path
    from ..streaming.resumable import run_resumable

    work = scratch_path(spark, "resumable")
    staged = f"{work}/pixels"
    _pixels(spark, sf).select("pixel_id", "lat", "lon", *POP).write.option("maxRecordsPerFile", STREAM_FILE_ROWS).parquet(staged)
    schema = spark.read.parquet(staged).schema
    return run_resumable(
        spark, staged, schema, POP, ALL_RES, NODATA, work, max_bytes_per_trigger=STREAM_BATCH_BYTES, about_batches=STREAM_BATCHES
    )


def index_file_ranges(spark, sf):
    """[S10, O1, K2] id ranges of the published files: per resolution the cells, their range, how many
    files begin before the one ahead ends, and whether every file is sorted."""
    from .published import published_all

    rows = published_all(spark, sf).select(
        "h3_res", "h3_index", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place")
    )
    # ids are unique, so a file is sorted when order by id and by place agree: compare each row's neighbours in it
    nth = Window.partitionBy("h3_res", "file").orderBy("place")
    late = (F.col("h3_index") <= F.lag("h3_index").over(nth)).cast("int")
    files = (
        rows.withColumn("late", F.coalesce(late, F.lit(0)))
        .groupBy("h3_res", "file")
        .agg(F.count(F.lit(1)).alias("n"), F.min("h3_index").alias("lo"), F.max("h3_index").alias("hi"), F.sum("late").alias("late"))
    )
    before = F.max("hi").over(Window.partitionBy("h3_res").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1))
    return (
        files.withColumn("over", F.coalesce((F.col("lo") <= before).cast("long"), F.lit(0)))
        .groupBy("h3_res")
        .agg(
            F.sum("n").alias("n_cells"),
            F.min("lo").alias("min_id"),
            F.max("hi").alias("max_id"),
            F.sum("over").alias("n_overlaps"),
            (F.sum("late") == 0).alias("files_sorted"),
        )
    )


def metadata_json(spark, sf):
    """[K4] what the metadata document of the index job says, one row per resolution: all of it observed by the write."""
    from ..sinks.metadata import METADATA_SCHEMA
    from ..sinks.snapshots import current
    from .build import METADATA_NAME
    from .published import published_base

    root = current(spark, published_base(spark, sf), FIXTURE_SCENARIO).root
    doc = spark.read.schema(METADATA_SCHEMA).json(f"{root}/scenario={FIXTURE_SCENARIO}/{METADATA_NAME}")
    rows = doc.select("*", F.array_join("years", ",").alias("year_list"), F.explode("cells_per_resolution").alias("res", "n_cells"))
    ids, totals = (F.element_at(c, F.col("res")) for c in ("ids_per_resolution", "totals_per_resolution"))
    return rows.select(
        "scenario", "crs", "cell_system", F.col("year_list").alias("years"), F.col("res").cast("int").alias("h3_res"), "n_cells",
        ids["first"].alias("first_id"), ids["last"].alias("last_id"), *[totals[p].alias(f"total_{p[4:]}") for p in POP],
    )


def index_listing(spark, sf):
    """[S10, K3] the listing of the published files against what is read: per resolution the cells, files read but not listed,
    and listed files without a cell or without bytes."""
    from ..sources.index_reader import list_files
    from .published import published_all, published_base

    name = lambda c: F.regexp_extract(c, "([^/]+)$", 1)
    listed = list_files(spark, published_base(spark, sf)).select(
        F.regexp_extract("path", "/h3_res=([0-9]+)/", 1).cast("int").alias("h3_res"), name("path").alias("file"), "length"
    )
    read = published_all(spark, sf).groupBy("h3_res", name(F.col("_metadata.file_path")).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    both = listed.join(read, ["h3_res", "file"], "full")
    count = lambda c: F.count(F.when(c, F.lit(1)))
    return both.groupBy("h3_res").agg(
        F.sum("n").alias("n_cells"), count(F.col("length").isNull()).alias("n_unlisted"), count(F.col("n").isNull() | (F.col("length") <= 0)).alias("n_empty")
    )


QUERIES["index_listing"] = index_listing


# --- snapshots: what a second build leaves to be read -----------------------------------------

REBUILD_RES = [1, 2]
REBUILD_YEARS = [2025]


def _build_into(spark, sf, base, years, res, northern=False):
    from .build import build_population_index

    px = _pixels(spark, sf)
    return build_population_index(spark, px.where("lat > 0") if northern else px, FIXTURE_GRID, years, base, FIXTURE_SCENARIO, res)


def snapshot_republish(spark, sf):
    """[K3, K4, K7] publish res 1-4 with three years, then res 1-2 with one year of fewer pixels into the same base: what is read,
    beside the cells that the metadata counts."""
    from ..session import scratch_path
    from ..sinks.snapshots import current
    from ..sources.index_reader import read_index
    from .build import METADATA_NAME

    base = scratch_path(spark, "republish")
    _build_into(spark, sf, base, FIXTURE_YEARS, [1, 2, 3, 4])
    _build_into(spark, sf, base, REBUILD_YEARS, REBUILD_RES, northern=True)
    root = current(spark, base, FIXTURE_SCENARIO).root
    doc = spark.read.schema("cells_per_resolution map<string, bigint>").json(f"{root}/scenario={FIXTURE_SCENARIO}/{METADATA_NAME}")
    told = doc.select(F.explode("cells_per_resolution").alias("res", "n_told")).select(F.col("res").cast("int").alias("h3_res"), "n_told")
    # every resolution that is read shows, whether the metadata names it or not
    return read_index(spark, base, FIXTURE_SCENARIO).drop("scenario").join(F.broadcast(told), "h3_res", "left")


def snapshot_crash(spark, sf):
    """[K3, K7] a second build that ends between its write and its swap: the first one is read, its marker stands for it."""
    from ..operators.index import build_index
    from ..session import scratch_path
    from ..sources.index_reader import read_index
    from .build import stage_index

    base = scratch_path(spark, "crash")
    _build_into(spark, sf, base, FIXTURE_YEARS, [1, 2, 3, 4])
    northern = build_index(_pixels(spark, sf).where("lat > 0"), ["pop_2025"], REBUILD_RES, NODATA)
    stage_index(spark, northern, base, FIXTURE_SCENARIO, REBUILD_YEARS, REBUILD_RES, FIXTURE_GRID)
    return read_index(spark, base, FIXTURE_SCENARIO).drop("scenario")


QUERIES.update({"snapshot_republish": snapshot_republish, "snapshot_crash": snapshot_crash})


# --- resume by window: a build stopped after some batches and taken up again -------------------

RESUME_RES = [2, 5]
RESUME_BATCHES = 6  # batches that the staged pixels make, about
RESUME_STOP_AFTER = 2  # batches of the first attempt


def _stopped_and_resumed(spark, sf):
    """A run by windows that stops after some batches, has a batch in flight when it ends, finds its files rewritten and goes on."""
    from ..session import scratch_path
    from ..streaming.windows import BAND, WINDOW, WindowRun, stage_by_window, staged_bytes, window_partials

    work = scratch_path(spark, "windows")
    px = _pixels(spark, sf).select("lat", "lon", *POP)
    stage_by_window(px, f"{work}/pixels")
    key = M.run_key(FIXTURE_SCENARIO, FIXTURE_YEARS, RESUME_RES, FIXTURE_GRID, "fixture")
    run = lambda staged: WindowRun(spark, f"{work}/{staged}", px.schema, POP, RESUME_RES, NODATA, work, key)
    first = run("pixels")
    size = staged_bytes(spark, f"{work}/pixels").agg(F.sum("bytes")).first()[0] // RESUME_BATCHES
    first.run(size, max_batches=RESUME_STOP_AFTER)
    # a batch that wrote its partial sums and ended before it recorded its windows
    lost = first._batches(size)[0]
    window_partials(first.read(lost), POP, RESUME_RES, NODATA).write.parquet(f"{work}/partials/attempt=lost")
    # the files of the remaining windows are written anew elsewhere, those of finished windows are gone
    left = first.pending().select(WINDOW)
    stored = spark.read.schema(first.schema).parquet(f"{work}/pixels")
    stage_by_window(stored.join(F.broadcast(left), WINDOW, "left_semi").drop(WINDOW, BAND), f"{work}/rewritten")  # a lattice of rows at most
    second = run("rewritten")
    second.run(size)
    return second


def window_resume(spark, sf):
    """[K5, K6, A11] per window: how often it ran, its outcome and its valid pixels, after a stop and a resumption."""
    run = _stopped_and_resumed(spark, sf)
    ran = run.manifest().groupBy("win_id").agg(F.count(F.lit(1)).alias("n_runs"), F.first("status").alias("status"), F.sum("n_valid").alias("n_valid"))
    lattice = run.lattice().select("win_id")
    return lattice.join(ran, "win_id", "left").select("win_id", F.coalesce("n_runs", F.lit(0).cast("bigint")).alias("n_runs"), "status", "n_valid")


def window_resume_index(spark, sf):
    """[K1, K5, S4, A2] the index of that run."""
    return _stopped_and_resumed(spark, sf).index()


QUERIES.update({"window_resume": window_resume, "window_resume_index": window_resume_index})


# --- polygons, and datasets of unlike years -----------------------------------------------------

POLYGON_RES = [1, 2, 5]  # coarse cells reach over 180 degrees and the poles


def cell_polygons(spark, sf):
    """[G7, K8] every cell as a WKB polygon (hex) of FLOAT corners, cut at 180 degrees and the poles."""
    from ..functions.geometry import cell_ring, polygon_wkb

    ids = _index(spark, sf, POLYGON_RES).select("h3_res", "h3_index")
    single = lambda p: F.struct(p["lng"].cast("float").cast("double").alias("lng"), p["lat"].cast("float").cast("double").alias("lat"))
    rings = ids.select("h3_res", "h3_index", F.transform(cell_ring("h3_index"), single).alias("ring"))
    return rings.select("h3_res", "h3_index", F.size("ring").cast("int").alias("n_corners"), F.hex(polygon_wkb(F.col("ring"))).alias("wkb_hex"))


def merged_population_stats(spark, sf):
    """[S6, S9, A5] two published scenarios of unlike years and resolutions, read together: year columns discovered from the
    files, resolutions taken from the ids."""
    from ..session import scratch_path
    from ..sources.index_reader import read_merged
    from .build import build_population_index

    base, px = scratch_path(spark, "unlike"), _pixels(spark, sf)
    build_population_index(spark, px, FIXTURE_GRID, [2025, 2050], base, "SSP1", [2, 4])
    build_population_index(spark, px.where("lon > 0"), FIXTURE_GRID, [2050, 2100], base, "SSP2", [4, 6])
    found = read_merged(spark, base)
    return A.population_stats(found, A.pop_columns(found), ["scenario", "h3_res"], only_present=True)


QUERIES.update({"cell_polygons": cell_polygons, "merged_population_stats": merged_population_stats})


# --- clustering by a curve, and bitmaps that merge ----------------------------------------------

CURVE_GROUP_ROWS = 512  # rows of a row group, so that a small index has several


def bbox_curve(spark, sf):
    """[F9, O1] box selection on an index clustered along a space-filling curve: ranges of the curve reach the scan."""
    from ..session import scratch_path
    from ..sinks.parquet import write_curve_index
    from ..sources.index_reader import read_index

    base = write_curve_index(_index(spark, sf, ALL_RES), scratch_path(spark, "curve"), FIXTURE_SCENARIO, row_group_rows=CURVE_GROUP_ROWS)
    la0, la1, lo0, lo1 = BBOX_FIXTURE
    sel = A.where_bbox_curve(read_index(spark, base, FIXTURE_SCENARIO, RES), la0, la1, lo0, lo1, RES)
    c = "h3_index"
    return sel.select(c, cells.cell_lat(c, RES).cast("float").alias("lat"), cells.cell_lng(c, RES).cast("float").alias("lng"), *POP)


def bitmap_cell_counts(spark, sf):
    """[A3, A7] distinct cells per window and resolution, and of the globe (win_id NULL), from one stored bitmap table."""
    from ..session import scratch_path

    path = scratch_path(spark, "bitmaps")
    made = X.cell_bitmaps(_valid(spark, sf), ALL_RES)
    made.write.parquet(path)
    stored = spark.read.schema(made.schema).parquet(path)
    windows = X.count_bitmaps(stored, ["win_idx", "h3_res"])
    globe = X.count_bitmaps(stored, ["h3_res"]).select(F.lit(None).cast("int").alias("win_idx"), "h3_res", "n_pixels", "n_cells")
    return windows.union(globe).select(F.when(F.col("win_idx").isNotNull(), window_columns("win_idx")[0]).alias("win_id"), "h3_res", "n_pixels", "n_cells")


QUERIES.update({"bbox_curve": bbox_curve, "bitmap_cell_counts": bitmap_cell_counts})


# --- stored tiles: window reads without an exchange, and an index that shuffles boundary cells only

STORE_BUCKETS = 8
WINDOW_ROWS = (100, 419)  # inclusive pixel ranges of the window read
WINDOW_COLS = (200, 1103)


def _stored_tiles(spark, sf):
    """The pixel fixture as tiles, stored; opened from its descriptor."""
    from ..session import scratch_path
    from ..sources.tile_store import open_tiles, write_tiles

    path = scratch_path(spark, "tiles")
    tiles = wide_pixels_to_tiles(_pixels(spark, sf), TILE, FIXTURE_YEARS, NODATA, PIXEL_ORDER)
    write_tiles(tiles, path, FIXTURE_GRID, TILE, STORE_BUCKETS)
    return open_tiles(spark, path)


def tile_window(spark, sf):
    """[S3, F17] stored tiles, read by a window of pixel rows and columns: no exchange, tile ranges pushed to the scan."""
    tiles, grid, tile = _stored_tiles(spark, sf)
    return apply_mask(tiles_to_wide_pixels(tiles, grid, tile, FIXTURE_YEARS, WINDOW_ROWS, WINDOW_COLS), POP, NODATA)


def index_tiled(spark, sf):
    """[A1, A2, S3] the index of all resolutions from stored tiles: interior cells are final per tile, boundary cells are shuffled."""
    from ..operators.tiled_index import build_index_from_tiles

    tiles, grid, tile = _stored_tiles(spark, sf)
    return build_index_from_tiles(tiles, grid, FIXTURE_YEARS, ALL_RES, tile)


def tile_split(spark, sf):
    """[A1, A2] per resolution: cells that are final within their tile, and the rows and cells that are summed over tiles."""
    from ..operators.tiled_index import tile_sums

    tiles, grid, tile = _stored_tiles(spark, sf)
    sums = tile_sums(tiles, grid, tile, FIXTURE_YEARS, ALL_RES)
    per_cell = sums.groupBy("h3_res", "h3_index").agg(F.max("interior").alias("interior"), F.count(F.lit(1)).alias("n"))
    count = lambda c: F.count(F.when(c, F.lit(1)))
    return per_cell.groupBy("h3_res").agg(
        count(F.col("interior")).alias("n_interior"), count(~F.col("interior")).alias("n_boundary"),
        F.sum(F.when(F.col("interior"), F.lit(0)).otherwise(F.col("n"))).alias("n_boundary_rows"),
    )


POINT_TILE = 90  # tile side of the folder-per-tile store


def _tile_folders(spark, sf):
    from ..session import scratch_path
    from ..sources.tile_store import write_tile_folders

    tiles = wide_pixels_to_tiles(pixel_view(spark, sf, six_years=True), POINT_TILE, FIXTURE_YEARS_6, NODATA, PIXEL_ORDER)
    return write_tile_folders(tiles, scratch_path(spark, "tile-folders"), FIXTURE_GRID, POINT_TILE)


def sample_points_tiles(spark, sf):
    """[O7, S3] the inspection points from stored tiles: at most five tile folders are read."""
    return I.sample_points_tiles(spark, _tile_folders(spark, sf), FIXTURE_GRID, FIXTURE_YEARS_6, POINT_TILE)


def grid_stats_tiles(spark, sf):
    """[A9, S3] centre-window statistics from stored tiles: the window's folders are read."""
    return _float_stats(I.grid_stats_center_tiles(_tile_folders(spark, sf), FIXTURE_GRID, FIXTURE_YEARS_6, POINT_TILE))


QUERIES.update(
    {
        "tile_window": tile_window,
        "index_tiled": index_tiled,
        "tile_split": tile_split,
        "sample_points_tiles": sample_points_tiles,
        "grid_stats_tiles": grid_stats_tiles,
    }
)


QUERIES.update(
    {
        "index_written_readback": index_written_readback,
        "bbox_written": bbox_written,
        "index_resumable": index_resumable,
        "index_file_ranges": index_file_ranges,
        "metadata_json": metadata_json,
    }
)


def legacy_written_readback(spark, sf):
    """[K8, F14, S5] write the legacy layout (text id, WKB point, FLOAT lat/lon/area) and read it back, the point decoded."""
    from ..functions.geometry import point_lonlat
    from ..session import scratch_path
    from ..sinks.parquet import write_legacy_index
    from ..sources.index_reader import read_index

    base = scratch_path(spark, "legacy")
    write_legacy_index(_index(spark, sf, [RES]), base, FIXTURE_SCENARIO)
    back = read_index(spark, base, FIXTURE_SCENARIO, RES)
    point = back.withColumn("point", point_lonlat("geometry"))
    at = [F.col(f"point.{c}").cast("float").alias(f"point_{c}") for c in ("lon", "lat")]
    return point.select("h3_index", F.octet_length("geometry").alias("n_bytes"), *at, "lat", "lon", "area_km2", *POP)


QUERIES["legacy_written_readback"] = legacy_written_readback


def sql_continent_totals(spark, sf):
    """[F11, A6, O4, F15] the regional totals written as Spark SQL with the cell SQL functions."""
    from ..functions.sql import register_sql_functions

    register_sql_functions(spark)
    boxes = " ".join(
        f"WHEN lat BETWEEN {a} AND {b} AND lng BETWEEN {c} AND {d} THEN '{n}'"
        for n, a, b, c, d in A.CONTINENT_BOXES
    )
    sums = ", ".join(f"CAST(rint(SUM({p})) AS BIGINT) AS {p}" for p in POP)
    return spark.sql(
        f"""SELECT CASE {boxes} ELSE '{A.OTHER_REGION}' END AS continent, {sums}
            FROM (SELECT cell_to_lat(h3_index) AS lat, cell_to_lng(h3_index) AS lng, {", ".join(POP)}
                  FROM {{idx}}) centres
            GROUP BY continent ORDER BY pop_2025 DESC, continent""",
        idx=_index(spark, sf).drop("h3_res"),
    )


QUERIES["sql_continent_totals"] = sql_continent_totals


# --- E2: the same analytics on the published index (built once per session) -----------------


def _float_attrs(idx: DataFrame, res: int | None) -> DataFrame:
    c = "h3_index"
    return idx.withColumns(
        {
            "lat": cells.cell_lat(c, res).cast("float"),
            "lng": cells.cell_lng(c, res).cast("float"),
            "area_km2": cells.cell_area_km2(c, res).cast("float"),
        }
    )


def _pub(spark, sf, res=RES):
    from .published import published_resolution

    return published_resolution(spark, sf, res)


def pub_topk_population(spark, sf):
    """[S5, O2, F12] top cells read from the published index."""
    return _top_population(_pub(spark, sf))


def pub_growth_hotspots(spark, sf):
    """[S5, O3, F10, F12] growth hotspots on the published index."""
    return _growth_hotspots(_pub(spark, sf))


def pub_continent_totals(spark, sf):
    """[S5, F11, A6, O4] regional totals on the published index."""
    return A.continent_totals(_pub(spark, sf), POP, res=RES)


def pub_bbox_cells(spark, sf):
    """[S5, F9] the example box on the published index (id range pushed to the scan)."""
    la0, la1, lo0, lo1 = BBOX_MAIN
    sel = A.where_bbox(_pub(spark, sf), la0, la1, lo0, lo1, res=RES)
    return sel.select(
        "h3_index",
        cells.cell_lat("h3_index", RES).cast("float").alias("lat"),
        cells.cell_lng("h3_index", RES).cast("float").alias("lng"),
        *POP,
    )


def pub_extent_stats(spark, sf):
    """[S5, A4] per-resolution extent on the published index."""
    from .published import published_all

    return A.extent_stats(published_all(spark, sf))


def pub_population_stats(spark, sf):
    """[S5, A5] per-resolution population statistics on the published index."""
    from .published import published_all

    return A.population_stats(published_all(spark, sf), POP)


def pub_cell_attributes(spark, sf):
    """[S5, F14, G3-G6] derived attributes of the published cells."""
    return _float_attrs(_pub(spark, sf), RES).withColumn("h3_hex", cells.cell_to_string("h3_index"))


QUERIES.update(
    {
        "pub_topk_population": pub_topk_population,
        "pub_growth_hotspots": pub_growth_hotspots,
        "pub_continent_totals": pub_continent_totals,
        "pub_bbox_cells": pub_bbox_cells,
        "pub_extent_stats": pub_extent_stats,
        "pub_population_stats": pub_population_stats,
        "pub_cell_attributes": pub_cell_attributes,
    }
)
