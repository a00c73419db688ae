"""Multi-resolution cell index: assign (F18, G1), aggregate (A1, A2) and counts.

Physical plan of ``build_index`` (one exchange)::

    scan(pixels) -> Filter(mask) -> Project(X, Y once per pixel)
      -> Generate(inline: one row per resolution with its constants)
      -> Project(h3_index: one compact expression for every resolution)
      -> HashAggregate(partial sums)           -- map-side combine
      -> Exchange hashpartitioning(h3_res, h3_index)
      -> HashAggregate(final sums) -> Project(cast FLOAT)

The partial aggregate makes hot cells harmless: whatever the skew of the
input, each map task ships at most one row per (resolution, cell) it saw.
Coarse resolutions collapse to a few hundred rows per task; at the finest
resolution rows ~ cells, which is the output size and cannot shrink.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cells
from ..sources.grid import window_columns, window_index
from .mask import apply_mask

DEFAULT_RESOLUTIONS = [1, 2, 3, 4, 5, 6, 7, 8]
CELL_SYSTEMS = ("hex", "h3")


def validate_resolutions(resolutions) -> list[int]:
    """Ints in [0, 15], sorted, no duplicates."""
    out = sorted({cells.check_res(int(r)) for r in resolutions})
    if not out:
        raise ValueError("no resolutions given")
    return out


def assign_cells(
    pixels: DataFrame,
    resolutions,
    keep: list[str],
    lat: str = "lat",
    lon: str = "lon",
    system: str = "hex",
) -> DataFrame:
    """F18 + G1: one row per (pixel, resolution) -> ``h3_res INT, h3_index BIGINT, keep...``.

    The equal-area projection (one ``sin``) is computed once per pixel and
    shared by all resolutions; each resolution then costs a few
    multiplications, ``floor`` and compares.
    """
    res_list = validate_resolutions(resolutions)
    if system == "hex":
        # one row per (pixel, resolution) carrying that resolution's factors,
        # then ONE compact cell expression: generated code does not grow
        # with the number of resolutions, and the projection (one sin) is
        # computed once per pixel before the fan-out
        xy = pixels.select(
            *keep, cells.project_x(lon).alias("_x"), cells.project_y(lat).alias("_y")
        )
        if len(res_list) == 1:  # one resolution: literal constants, no fan-out
            r = res_list[0]
            return xy.select(
                F.lit(r).cast("int").alias("h3_res"), cells.cell_of_xy("_x", "_y", r).alias("h3_index"), *keep
            )
        fan = xy.select(*keep, "_x", "_y", F.inline(cells.resolution_constants(res_list)))
        return fan.select(
            "h3_res",
            cells.cell_of_xy_by_constants("_x", "_y", "kq_x", "kq_y", "kr_y", "base").alias("h3_index"),
            *keep,
        )
    if system == "h3":
        from ..functions.h3_adapter import latlng_to_cell
        from ..session import ship_package

        ship_package(pixels.sparkSession)

        fan = F.array(
            *[
                F.struct(
                    F.lit(r).cast("int").alias("h3_res"),
                    latlng_to_cell(F.col(lat), F.col(lon), F.lit(r)).alias("h3_index"),
                )
                for r in res_list
            ]
        )
        return pixels.select(F.inline(fan), *keep)
    raise ValueError(f"unknown cell system {system!r}; expected one of {CELL_SYSTEMS}")


def aggregate_cells(assigned: DataFrame, pop_cols: list[str]) -> DataFrame:
    """A1 + A2: SUM per (resolution, cell), accumulated in DOUBLE, stored as FLOAT.

    Partial sums of overlapping windows are *added*, never de-duplicated.
    """
    return assigned.groupBy("h3_res", "h3_index").agg(
        *[F.sum(F.col(c).cast("double")).cast("float").alias(c) for c in pop_cols]
    )


def build_index(
    pixels: DataFrame,
    pop_cols: list[str],
    resolutions=DEFAULT_RESOLUTIONS,
    nodata: float | None = -99999.0,
    system: str = "hex",
    lat: str = "lat",
    lon: str = "lon",
) -> DataFrame:
    """Mask -> assign -> aggregate: ``h3_res INT, h3_index BIGINT, pop_* FLOAT``."""
    valid = apply_mask(pixels, pop_cols, nodata)
    assigned = assign_cells(valid, resolutions, keep=pop_cols, lat=lat, lon=lon, system=system)
    return aggregate_cells(assigned, pop_cols)


def cells_per_resolution(index: DataFrame) -> DataFrame:
    """Cells per resolution plus a grand-total row (``h3_res`` NULL).

    Counts the aggregated index, whose keys are unique -- no DISTINCT pass.
    """
    return index.rollup("h3_res").agg(F.count(F.lit(1)).alias("n_cells"))


def distinct_cells(assigned: DataFrame) -> DataFrame:
    """A3: ``count(DISTINCT h3_index)`` per resolution over per-pixel assignments."""
    return assigned.groupBy("h3_res").agg(F.countDistinct("h3_index").alias("n_cells"))


def window_cell_counts(valid: DataFrame, resolutions, system: str = "hex") -> DataFrame:
    """Per (5-degree window, resolution): valid pixels and distinct cells.

    A cell that straddles two windows is counted in both, like the partial
    outputs of a per-window run.
    """
    win = valid.select("lat", "lon", window_index("lat", "lon").alias("win_idx"))
    assigned = assign_cells(win, resolutions, keep=["win_idx"], system=system)
    counts = assigned.groupBy("win_idx", "h3_res").agg(
        F.count(F.lit(1)).alias("n_pixels"),
        F.countDistinct("h3_index").alias("n_cells"),
    )
    # labels and bounds only for the <= 2,592 x resolutions result rows
    return counts.select(*window_columns("win_idx"), "h3_res", "n_pixels", "n_cells")


def cell_bitmaps(valid: DataFrame, resolutions, by: list[str] | None = None) -> DataFrame:
    """A3 + A7 in a form that merges: per (``by``..., resolution, bucket) the cells seen, as a bitmap, and the pixels.

    ``by`` are columns of ``valid`` (default: its 5-degree window, ``win_idx``). A cell's bit is its place on the curve of its
    resolution (``functions.curve``), so a bucket is a compact block of 32,768 cells and its bitmap dense where pixels
    are; 4 KB of bits, mostly zero and so compressed where they aren't. A stored table of these answers distinct counts
    per group, per union of groups and of the globe, without going back to pixels, and takes in new windows by a further OR.
    """
    from ..functions.curve import curve

    if by is None:
        valid = valid.select("lat", "lon", window_index("lat", "lon").alias("win_idx"))
        by = ["win_idx"]
    seen = assign_cells(valid, resolutions, keep=by).select(*by, "h3_res", curve("h3_index").alias("place"))
    return seen.groupBy(*by, "h3_res", F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"), F.count(F.lit(1)).alias("n_pixels")
    )


def count_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Exact distinct cells and pixels per ``keys``, from a bitmap table; groups that ``keys`` leave out are merged by OR."""
    merged = bitmaps.groupBy(*dict.fromkeys([*keys, "h3_res"]), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n_pixels").alias("n_pixels"))
    return merged.groupBy(*keys).agg(F.sum("n_pixels").alias("n_pixels"), F.sum(F.bitmap_count("bits")).alias("n_cells"))


def conservation_totals(index: DataFrame, valid: DataFrame, pop_cols: list[str]) -> DataFrame:
    """A10: world totals per resolution, plus the valid-pixel totals (``h3_res`` NULL).

    One union and one grouped aggregate; totals in DOUBLE (SUM of FLOAT).
    Every resolution must reproduce the pixel totals.
    """
    both = index.select(F.col("h3_res").cast("int").alias("h3_res"), *pop_cols).unionByName(
        valid.select(F.lit(None).cast("int").alias("h3_res"), *pop_cols)
    )
    return both.groupBy("h3_res").agg(
        *[F.sum(c).alias(f"total_{c[4:]}") for c in pop_cols],
        F.count(F.lit(1)).alias("n_rows"),
    )


def conservation_spread(totals: DataFrame, pop_cols: list[str]) -> DataFrame:
    """Largest minus smallest total over all levels, per year (one row)."""
    cols = [f"total_{c[4:]}" for c in pop_cols]
    return totals.agg(*[(F.max(c) - F.min(c)).alias(f"spread_{c[6:]}") for c in cols])

