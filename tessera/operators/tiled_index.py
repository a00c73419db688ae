"""Index build from tiles that shuffles boundary cells only (A1, A2).

Tiles are rectangles of the projected plane (x grows with longitude, y with the sine of latitude),
and cells are hexagons of it. A cell whose bounding box lies inside a tile gets all its pixels from that
tile, so its sum within the tile is final; only cells across a tile's edge are summed over tiles:

    bucketed tiles -> years aligned per tile -> mask -> cells
      -> HashAggregate(tile_row, tile_col, h3_res, h3_index)      no exchange: the scan is dealt by tile
      -> written once, split by ``interior``
    interior rows -> index                                        final
    boundary rows -> Exchange(h3_res, h3_index) -> HashAggregate  as many rows as cells on tile edges

What is shuffled grows with the length of tile edges (over the cell size), not with pixels. The write between is
the cut of the lineage: both branches read it, so tiles are read once, and a lost executor costs its own tasks.
A tile at the border of the grid has no neighbour there, so that side doesn't make a cell a boundary cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells
from ..sources.grid import GridSpec, pop_col, tiles_to_wide_pixels
from .index import DEFAULT_RESOLUTIONS, assign_cells, validate_resolutions
from .mask import apply_mask

# Parameter: a cell counts as inside only by this much (km), far above the rounding of assignment.
MARGIN_KM = 1e-6


def interior(grid: GridSpec, tile: int, res_col: str = "h3_res", cell: str = "h3_index") -> Column:
    """Whether a cell's bounding box lies within its tile (columns tile_row, tile_col) or past the grid's own border."""
    d, km = cells.dbl, cells.EARTH_RADIUS_KM
    rows, cols = -(-grid.height // tile), -(-grid.width // tile)
    x_of = lambda lon: f"(radians({lon}) * {d(km)})"
    y_of = lambda lat: f"(sin(radians({lat})) * {d(km)})"
    west = f"({d(grid.origin_lon)} + tile_col * {d(tile * grid.dx)})"
    east = f"({d(grid.origin_lon)} + (tile_col + 1) * {d(tile * grid.dx)})"
    north = f"({d(grid.origin_lat)} - tile_row * {d(tile * grid.dy)})"
    south = f"({d(grid.origin_lat)} - (tile_row + 1) * {d(tile * grid.dy)})"
    pick = lambda f: "element_at(array(" + ", ".join(d(f(cells.res_constants(r)) + MARGIN_KM) for r in range(cells.MIN_RES, cells.MAX_RES + 1)) + f"), {res_col} + 1)"
    half_w, half_h = pick(lambda k: k.cx / 2), pick(lambda k: k.edge_km)
    # the centre, decoded by resolution column (the id carries the same resolution)
    x, y = cells.sql_centre_x(cell, res_col, checked=False), cells.sql_centre_y(cell, res_col, checked=False)
    return F.expr(
        f"(tile_col = 0 OR {x} - {half_w} >= {x_of(west)}) AND (tile_col >= {cols - 1} OR {x} + {half_w} <= {x_of(east)})"
        f" AND (tile_row = 0 OR {y} + {half_h} <= {y_of(north)}) AND (tile_row >= {rows - 1} OR {y} - {half_h} >= {y_of(south)})"
    )


def tile_sums(tiles: DataFrame, grid: GridSpec, tile: int | None, years: list[int], resolutions, system: str = "hex") -> DataFrame:
    """Sums per (tile, resolution, cell) in DOUBLE, with ``interior``; no exchange over a table bucketed by tile."""
    tile, pops = grid.tile_side(tile), [pop_col(y) for y in years]
    if system != "hex":
        raise ValueError("the edges of cells are known for the system 'hex' only")
    if not math.isclose(abs(grid.dy), grid.dy) or not math.isclose(abs(grid.dx), grid.dx):
        raise ValueError("the grid must be north-up")
    px = apply_mask(tiles_to_wide_pixels(tiles, grid, tile, years, keep_tile=True), pops, grid.nodata_float32())
    assigned = assign_cells(px, resolutions, keep=["tile_row", "tile_col", *pops], system=system)
    sums = assigned.groupBy("tile_row", "tile_col", "h3_res", "h3_index").agg(*[F.sum(F.col(p).cast("double")).alias(p) for p in pops])
    return sums.withColumn("interior", interior(grid, tile))


def split_sums(sums: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Per-tile sums written once and read as (interior, boundary)."""
    sums.write.partitionBy("interior").parquet(path)
    rows = sums.sparkSession.read.schema(sums.schema).parquet(path)
    return rows.where("interior"), rows.where("NOT interior")


def build_index_from_tiles(
    tiles: DataFrame, grid: GridSpec, years: list[int], resolutions=DEFAULT_RESOLUTIONS, tile: int | None = None, system: str = "hex"
) -> DataFrame:
    """Tile table -> ``h3_res INT, h3_index BIGINT, pop_* FLOAT``, equal to ``build_index`` over its pixels."""
    from ..session import scratch_path

    res, pops = validate_resolutions(resolutions), [pop_col(y) for y in years]
    inside, across = split_sums(tile_sums(tiles, grid, tile, years, res, system), scratch_path(tiles.sparkSession, "tile-sums"))
    final = inside.select("h3_res", "h3_index", *[F.col(p).cast("float").alias(p) for p in pops])
    summed = across.groupBy("h3_res", "h3_index").agg(*[F.sum(p).cast("float").alias(p) for p in pops])
    return final.unionByName(summed)
