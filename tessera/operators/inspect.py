"""Raster inspection as Spark jobs: centre-window statistics (A9) and point sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.num import sql_is_finite
from .mask import sql_is_nodata
from ..sources.grid import GridSpec, layer_key, pixel_lat, pixel_lon, pop_col, tiles_to_wide_pixels

# --- fixed values of the inspection ----------------------------------------------------
CENTER_WINDOW_MAX = 1000  # side of the centre window, pixels
CORNER_INSET = 10  # sample points sit 10 pixels in from each corner
# -------------------------------------------------------------------------------------------


def center_window(grid: GridSpec) -> tuple[int, int, int]:
    """(row_off, col_off, size) of the centred square window."""
    size = min(CENTER_WINDOW_MAX, grid.height, grid.width)
    return grid.height // 2 - size // 2, grid.width // 2 - size // 2, size


def grid_stats_center(pixels: DataFrame, grid: GridSpec, years: list[int]) -> DataFrame:
    """Per year: min, max, mean, population std of valid values in the centre
    window, valid count and share of the window's pixels.

    Valid = not nodata and finite (no positivity test). Values are widened to
    DOUBLE before comparing, as the inspection does. One range filter on
    (r, c), pushed to the scan; one aggregate over all years at once, then one
    row per year from its single row. A year without a valid value is there
    with ``n_valid`` 0 and null statistics.
    """
    r0, c0, size = center_window(grid)
    win = pixels.where(F.col("r").between(r0, r0 + size - 1) & F.col("c").between(c0, c0 + size - 1))
    aggs, structs = [], []
    for i, y in enumerate(int(y) for y in years):
        v = f"CAST({pop_col(y)} AS DOUBLE)"
        ok = f"CASE WHEN {sql_is_finite(pop_col(y))} AND NOT {sql_is_nodata(pop_col(y), grid.nodata)} THEN {v} END"
        for name, f in (("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_pop"), ("n", "count")):
            aggs.append(F.expr(f"{f}({ok})").alias(f"{name}_{y}"))
        structs.append(
            f"named_struct('band', {i + 1}, 'year', {y}, 'min', min_{y}, 'max', max_{y}, 'mean', mean_{y}, "
            f"'std', std_{y}, 'n_valid', n_{y})"
        )
    total = size * size
    return (
        win.agg(*aggs)
        .select(F.expr(f"inline(array({', '.join(structs)}))"))
        .withColumn("n_total", F.lit(total).cast("bigint"))
        .withColumn("pct_valid", F.col("n_valid") * F.lit(100.0) / F.lit(float(total)))
    )


# --- fixed values: names of the sample points, in order
SAMPLE_LABELS = ("Center", "Top-left", "Top-right", "Bot-left", "Bot-right")

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("label", T.StringType(), False),
        T.StructField("r", T.LongType(), False),
        T.StructField("c", T.LongType(), False),
    ]
)


def sample_point_table(spark: SparkSession, grid: GridSpec) -> DataFrame:
    """The five inspection points: centre and 10 px in from each corner."""
    h, w, d = grid.height, grid.width, CORNER_INSET
    places = [(h // 2, w // 2), (d, d), (d, w - d), (h - d, d), (h - d, w - d)]
    return spark.createDataFrame([(n, r, c) for n, (r, c) in zip(SAMPLE_LABELS, places, strict=True)], SAMPLE_SCHEMA)


def sample_points(spark: SparkSession, pixels: DataFrame, grid: GridSpec, years: list[int]) -> DataFrame:
    """Values of every year at the inspection points.

    The point table has five rows (fixed by the grid, not the data), so it is
    broadcast to the pixel scan: a map-side hash join, no shuffle of the
    pixels. A point with no pixel row reads as nodata (boundless fill).
    """
    cols = [pop_col(y) for y in years]
    pts = sample_point_table(spark, grid)
    hit = pixels.select("r", "c", *cols).join(F.broadcast(pts), ["r", "c"])
    fill = F.lit(grid.nodata).cast("float") if grid.nodata is not None else F.lit(None).cast("float")
    out = pts.join(hit.drop("label"), ["r", "c"], "left")
    return out.select(
        "label",
        "r",
        "c",
        pixel_lat("r", grid).alias("lat"),
        pixel_lon("c", grid).alias("lon"),
        *[F.coalesce(F.col(c), fill).alias(c) for c in cols],
    )


def sample_points_tiles(spark: SparkSession, tiles: DataFrame, grid: GridSpec, years: list[int], tile: int | None = None) -> DataFrame:
    """O7 on a stored tile table with a folder per tile: the points' tiles are the only ones read.

    The five points carry their tile; their filter (inside the grid) makes the join prune the tile folders at run
    time (dynamic partition pruning), and a pixel is picked out of its block without unpacking it. A point with several
    pixels (a layered table) gives a row for each, like the join with the pixels.
    """
    side = grid.tile_side(tile)
    h, w, d = grid.height, grid.width, CORNER_INSET
    places = [(h // 2, w // 2), (d, d), (d, w - d), (h - d, d), (h - d, w - d)]
    rows = ", ".join(f"named_struct('label', '{n}', 'r', {r}L, 'c', {c}L)" for n, (r, c) in zip(SAMPLE_LABELS, places, strict=True))
    pts = spark.range(0, 1, 1, 1).select(F.expr(f"inline(array({rows}))")).where(f"r BETWEEN 0 AND {h - 1} AND c BETWEEN 0 AND {w - 1}")
    # one key of both folder columns: two keys would be pruned one by one, to all combinations of their values
    cols = -(-w // side)
    at = pts.withColumn("tile_key", F.expr(f"CAST(r DIV {side} AS INT) * {cols} + CAST(c DIV {side} AS INT)"))
    value = F.expr(f"values[CAST(r % {side} AS INT)][CAST(c % {side} AS INT)]")
    wanted = tiles.where(F.col("year").isin([int(y) for y in years]))
    layer = layer_key(wanted)
    hit = wanted.join(F.broadcast(at), F.expr(f"tile_row * {cols} + tile_col = tile_key")).select("label", *layer, "year", value.alias("value"))
    per_point = hit.groupBy("label", *layer).agg(*[F.max(F.when(F.col("year") == int(y), F.col("value"))).alias(pop_col(y)) for y in years])
    if layer:
        per_point = per_point.where(" OR ".join(["layer = 0", *[f"{pop_col(y)} IS NOT NULL" for y in years]]))
    fill = F.lit(grid.nodata).cast("float") if grid.nodata is not None else F.lit(None).cast("float")
    # five rows on either side, or on one only: a point has as many as pixels
    out = pts.join(per_point if layer else F.broadcast(per_point), "label", "left")
    return out.select(
        "label", "r", "c", pixel_lat("r", grid).alias("lat"), pixel_lon("c", grid).alias("lon"),
        *[F.coalesce(F.col(pop_col(y)), fill).alias(pop_col(y)) for y in years],
    )


def grid_stats_center_tiles(tiles: DataFrame, grid: GridSpec, years: list[int], tile: int | None = None) -> DataFrame:
    """A9 on a stored tile table: the window's tiles are read (partition or pushed filter on tile_row, tile_col), nothing else."""
    r0, c0, size = center_window(grid)
    px = tiles_to_wide_pixels(tiles, grid, tile, years, (r0, r0 + size - 1), (c0, c0 + size - 1))
    return grid_stats_center(px, grid, years)
