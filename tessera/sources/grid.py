"""Raster grid layer: grid descriptor, pixel centres, 5-degree windows, tile tables.

A raster arrives either as a wide pixel table (one row per pixel, one FLOAT
column per year) or as a *tile table*::

    year INT, tile_row INT, tile_col INT, values ARRAY<ARRAY<FLOAT>>

with one dense ``tile x tile`` block per row, plus one grid descriptor. Where
positions repeat (overlapping rasters), the table is layered: a column
``layer INT`` tells the blocks of a year and tile apart. A
tile row is a bounded unit of work (at most ``tile**2`` floats), so a tile
table splits evenly over any number of tasks and a tile-range filter on
``tile_row``/``tile_col`` is pushed to the Parquet scan (the spatial window
read of a raster).
"""

from __future__ import annotations

import re
from dataclasses import asdict, dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.num import sql_float_literal

# --- fixed values of the processing grid ----------------------------------------
WINDOW_SIZE_DEG = 5.0
LAT_MIN, LAT_MAX = -90.0, 90.0
LON_MIN, LON_MAX = -180.0, 180.0
WINDOW_ID_FORMAT = "w_%+08.1f_%+07.1f"  # west, south
DEFAULT_NODATA_FILL = -99999.0
TASK_PIXELS = 1 << 16  # pixels of a task that makes blocks: as many rows its sorts and lists hold, so they rarely spill
# ---------------------------------------------------------------------------------

# --- fixed values: geographic (lat/lon degree) systems known by code
GEOGRAPHIC_CRS = {
    "EPSG:4326", "EPSG:4979", "EPSG:4258", "EPSG:4269", "EPSG:4267", "EPSG:4230", "EPSG:4277", "EPSG:4283",
    "EPSG:7844", "EPSG:4490", "EPSG:4610", "EPSG:4612", "EPSG:6668", "EPSG:4674", "EPSG:4148", "EPSG:4167",
    "EPSG:4171", "EPSG:4289", "EPSG:4314", "EPSG:4322", "EPSG:4617", "EPSG:9057", "EPSG:9000", "EPSG:10598",
    "OGC:CRS84", "OGC:CRS83", "OGC:CRS27", "OGC:CRS84H", "WGS84", "WGS 84",
}


def crs_refusal(crs: str) -> str | None:
    """Why a CRS is refused, or None for a geographic one.

    Known codes, well-known text and PROJ strings are told apart by what they
    say; a code that isn't known here is refused with the way to pass it.
    """
    text = " ".join(str(crs).split())
    upper = text.upper().removeprefix("URN:OGC:DEF:CRS:").replace("::", ":")
    if upper in GEOGRAPHIC_CRS:
        return None
    if upper.startswith(("GEOGCS[", "GEOGCRS[", "GEOGRAPHICCRS[")):
        return None
    if upper.startswith(("PROJCS[", "PROJCRS[", "PROJECTEDCRS[")):
        return "it is projected, and cells need degrees"
    if upper.startswith(("GEOCCS[", "GEODCRS[")):
        return "it is geocentric, and cells need degrees"
    if "+PROJ=" in upper:
        return None if re.search(r"\+PROJ=(LONGLAT|LATLONG|LATLON|LONLAT)\b", upper) else "it is projected, and cells need degrees"
    return "its code is not known to be geographic; pass its well-known text or a PROJ string"



@dataclass(frozen=True)
class GridSpec:
    """Affine north-up grid: pixel (row, col) covers
    ``[origin_lon + col*dx, +dx) x (origin_lat - (row+1)*dy, origin_lat - row*dy]``."""

    origin_lon: float
    origin_lat: float
    dx: float
    dy: float
    height: int
    width: int
    nodata: float | None = DEFAULT_NODATA_FILL
    crs: str = "EPSG:4326"
    tile: int | None = None  # side of the blocks of a tile table of this grid, pixels

    def check_geographic(self) -> "GridSpec":
        """a projected CRS gives wrong cells -- fail instead of warning."""
        why = crs_refusal(self.crs)
        if why:
            raise ValueError(f"grid CRS {self.crs!r} is refused: {why}")
        return self

    def tile_side(self, tile: int | None) -> int:
        """The side of the blocks: the descriptor's, which an argument must not contradict."""
        if tile is not None and self.tile is not None and tile != self.tile:
            raise ValueError(f"tile side {tile} differs from the grid descriptor's {self.tile}")
        side = self.tile if tile is None else tile
        if not side or side < 1:
            raise ValueError("the tile side is neither given nor in the grid descriptor")
        return side

    def nodata_float32(self) -> float | None:
        """Nodata as the FLOAT the values are stored in (mask compares in FLOAT)."""
        if self.nodata is None:
            return None
        v = float(np.float32(self.nodata))
        if v != self.nodata and not (np.isnan(v) and np.isnan(self.nodata)):
            raise ValueError(f"nodata {self.nodata!r} is not exact in FLOAT")
        return v

    def to_df(self, spark: SparkSession) -> DataFrame:
        """One-row grid descriptor table."""
        schema = T.StructType(
            [
                T.StructField("origin_lon", T.DoubleType(), False),
                T.StructField("origin_lat", T.DoubleType(), False),
                T.StructField("dx", T.DoubleType(), False),
                T.StructField("dy", T.DoubleType(), False),
                T.StructField("height", T.IntegerType(), False),
                T.StructField("width", T.IntegerType(), False),
                T.StructField("nodata", T.FloatType(), True),
                T.StructField("crs", T.StringType(), False),
                T.StructField("tile", T.IntegerType(), True),
            ]
        )
        d = asdict(self)
        return spark.createDataFrame([tuple(d[f.name] for f in schema.fields)], schema)


def _d(x: float) -> str:
    return f"({float(x)!r}D)"


def sql_pixel_lat(row: str, grid: GridSpec) -> str:
    return f"({_d(grid.origin_lat)} - (CAST(({row}) AS DOUBLE) + {_d(0.5)}) * {_d(grid.dy)})"


def sql_pixel_lon(col: str, grid: GridSpec) -> str:
    return f"({_d(grid.origin_lon)} + (CAST(({col}) AS DOUBLE) + {_d(0.5)}) * {_d(grid.dx)})"


def pixel_lat(row: str, grid: GridSpec) -> Column:
    """latitude of the pixel centre (``row`` a column name or SQL expression)."""
    return F.expr(sql_pixel_lat(row, grid))


def pixel_lon(col: str, grid: GridSpec) -> Column:
    """longitude of the pixel centre."""
    return F.expr(sql_pixel_lon(col, grid))


# --- 5-degree windows (F1, F3b) ---------------------------------------------------


def n_windows(size: float = WINDOW_SIZE_DEG) -> tuple[int, int]:
    n_lon = int(np.ceil((LON_MAX - LON_MIN) / size))
    n_lat = int(np.ceil((LAT_MAX - LAT_MIN) / size))
    return n_lon, n_lat


def _window_cols(lon_idx: str, lat_idx: str, size: float) -> list[Column]:
    west = f"({_d(LON_MIN)} + CAST(({lon_idx}) AS DOUBLE) * {_d(size)})"
    south = f"({_d(LAT_MIN)} + CAST(({lat_idx}) AS DOUBLE) * {_d(size)})"
    return [
        F.expr(f"format_string('{WINDOW_ID_FORMAT}', {west}, {south})").alias("win_id"),
        F.expr(west).alias("west"),
        F.expr(south).alias("south"),
        F.expr(f"least({west} + {_d(size)}, {_d(LON_MAX)})").alias("east"),
        F.expr(f"least({south} + {_d(size)}, {_d(LAT_MAX)})").alias("north"),
    ]


def window_lattice(spark: SparkSession, size: float = WINDOW_SIZE_DEG) -> DataFrame:
    """every window of the lattice (72 x 36 = 2,592 for 5 degrees).

    Built from one ``range`` (no cross join); longitude-major like the
    original loop. Its size is fixed by ``size``, never by the data.
    """
    n_lon, n_lat = n_windows(size)
    ids = spark.range(0, n_lon * n_lat, 1, numPartitions=1)  # 2,592 rows: one task, not one per core
    return ids.select(*_window_cols(f"CAST(id / {n_lat} AS BIGINT)", f"id % {n_lat}", size))


def window_index(lat: str = "lat", lon: str = "lon", size: float = WINDOW_SIZE_DEG) -> Column:
    """F3b as one INT: ``lon_idx * n_lat + lat_idx`` (the lattice row number).

    Group pixels by this compact key and attach the window label and bounds
    after aggregating (``window_columns``): the shuffle carries 4 bytes per
    row instead of a string and four doubles.
    """
    n_lon, n_lat = n_windows(size)
    lon_idx = f"least(floor((({lon}) - {_d(LON_MIN)}) / {_d(size)}), {n_lon - 1})"
    lat_idx = f"least(floor((({lat}) - {_d(LAT_MIN)}) / {_d(size)}), {n_lat - 1})"
    return F.expr(f"CAST({lon_idx} * {n_lat} + {lat_idx} AS INT)")


def window_columns(win_idx: str = "win_idx", size: float = WINDOW_SIZE_DEG) -> list[Column]:
    """win_id, west, south, east, north of a window index (see ``window_index``)."""
    _, n_lat = n_windows(size)
    return _window_cols(f"({win_idx}) DIV {n_lat}", f"({win_idx}) % {n_lat}", size)


def window_of(lat: str = "lat", lon: str = "lon", size: float = WINDOW_SIZE_DEG) -> list[Column]:
    """The (half-open) window holding a point -> win_id, west, south, east, north.

    Each point falls in exactly one window; points on the +180 / +90 edge go
    to the last window.
    """
    n_lon, n_lat = n_windows(size)
    lon_idx = f"least(floor((({lon}) - {_d(LON_MIN)}) / {_d(size)}), {n_lon - 1})"
    lat_idx = f"least(floor((({lat}) - {_d(LAT_MIN)}) / {_d(size)}), {n_lat - 1})"
    return _window_cols(lon_idx, lat_idx, size)


# --- year stacking (F17, F19, F2) --------------------------------------------------


def pop_col(year: int) -> str:
    return f"pop_{int(year)}"


def unstack_years(wide: DataFrame, keys: list[str], years: list[int]) -> DataFrame:
    """Wide pixel table -> long ``(keys..., year INT, value FLOAT)`` (one row per year)."""
    structs = ", ".join(f"named_struct('year', {int(y)}, 'value', {pop_col(y)})" for y in years)
    return wide.select(*keys, F.expr(f"inline(array({structs}))"))


def _one_per_year(value: str, years: list[int], largest: str) -> tuple[list[Column], dict[int, str]]:
    """Aggregates that pick each year's value, and SQL that fails where a year came twice."""
    aggs, picked = [], {}
    for y in years:
        aggs.append(F.expr(f"{largest}({value}) FILTER (WHERE year = {y})").alias(f"v_{y}"))
        aggs.append(F.expr(f"count(1) FILTER (WHERE year = {y})").alias(f"n_{y}"))
        picked[y] = f"CASE WHEN n_{y} > 1 THEN raise_error('year {y} came twice for one {{what}}') ELSE v_{y} END"
    return aggs, picked


def stack_years(
    long: DataFrame, keys: list[str], years: list[int], nodata: float | None
) -> DataFrame:
    """F17 + F2: align per-year values by pixel -> one FLOAT column per year.

    The year list is explicit (no extra pass to discover pivot values). A
    pixel missing in a year gets ``nodata`` (the boundless read fill) -- or
    NULL when the grid has none; both are removed by the validity mask. A
    year named twice is rejected; a pixel with two values for one year fails
    the job.
    """
    if len(set(years)) != len(years):
        raise ValueError(f"duplicate years: {years}")
    ys = [int(y) for y in years]
    aggs, picked = _one_per_year("value", ys, "max")
    piv = long.where(F.col("year").isin(ys)).groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for y in ys:
        v = f"CAST({picked[y].format(what='pixel')} AS FLOAT)"
        out.append(F.expr(v if nodata is None else f"coalesce({v}, {sql_float_literal(nodata)})").alias(pop_col(y)))
    return piv.select(*out)


# --- tile table <-> pixels (S3) ------------------------------------------------------

TILE_SCHEMA = T.StructType(
    [
        T.StructField("year", T.IntegerType(), False),
        T.StructField("tile_row", T.IntegerType(), False),
        T.StructField("tile_col", T.IntegerType(), False),
        T.StructField("values", T.ArrayType(T.ArrayType(T.FloatType()))),
    ]
)  # the tile-table layout (row-major blocks of tile x tile values)


def pixels_to_tiles(long: DataFrame, tile: int, nodata: float | None) -> DataFrame:
    """Long pixels ``(r, c, year, value)`` -> dense tile table, gaps = nodata.

    Pixels are dealt by tile once; grouping by (year, tile) here and by tile in
    the reader both hold on that partitioning, so the pixel data moves once.
    Each line of a block collects its at most ``tile`` (position, value)
    entries, sorts them and expands them by emitting a run of fill values
    before each entry; the block is made of its lines likewise -- O(tile**2)
    per tile with higher-order functions, no Python worker.

    A (year, pixel) that comes twice and a pixel left of or above the grid fail
    the job: nothing is picked or dropped. Pixels that may repeat go through
    ``wide_pixels_to_tiles``.
    """
    keyed = long.selectExpr("CAST(year AS INT) AS year", *_sql_place(tile), _sql_pos(tile, "year IS NOT NULL"), "CAST(value AS FLOAT) AS value")
    keys = ["year", "tile_row", "tile_col"]
    return _dense(_dealt(keyed, long), keys, tile, ["value"], nodata).withColumnRenamed("value", "values")


def wide_pixels_to_tiles(wide: DataFrame, tile: int, years: list[int], nodata: float | None, order: list[str]) -> DataFrame:
    """Wide pixels ``(r, c, pop_<year>...)`` -> layered tile table, as many rows a position as there are.

    The k-th row of a position (by the columns ``order``, then by its values) goes to layer k, from 0, with all its
    years: ``year, layer, tile_row, tile_col, values``. A layer is a raster like any other, so a block holds ``tile**2``
    values however often positions repeat, and every reader here takes the layers one by one. Gaps are nodata in
    layer 0 (the boundless fill) and NULL in the others, where a pixel without any value is no row.

    Rows are dealt by tile once, while they are wide: numbering, blocks and the reader's years hold on it.
    """
    pops = [pop_col(y) for y in years]
    dealt = _dealt(wide.selectExpr(*dict.fromkeys([*order, *pops]), *_sql_place(tile), _sql_pos(tile)), wide)
    at = Window.partitionBy("tile_row", "tile_col", "pos").orderBy(*dict.fromkeys([*order, *pops]))
    numbered = dealt.withColumn("layer", F.row_number().over(at) - F.lit(1))
    keys = ["layer", "tile_row", "tile_col"]
    by_year = ", ".join(f"named_struct('year', {int(y)}, 'values', {pop_col(y)})" for y in years)
    blocks = _dense(numbered.select(*keys, "pos", *pops), keys, tile, pops, nodata)
    return blocks.select(*keys, F.expr(f"inline(array({by_year}))")).select("year", *keys, "values")


def _dealt(keyed: DataFrame, pixels: DataFrame) -> DataFrame:
    """Rows dealt by tile into as many tasks as the count of ``pixels`` asks for.

    The number is given, as AQE would merge partitions by their bytes before they grow to blocks, into one a core.
    """
    at_least = keyed.sparkSession.sparkContext.defaultParallelism
    return keyed.repartition(max(at_least, -(-pixels.count() // TASK_PIXELS)), "tile_row", "tile_col")


def _sql_place(tile: int) -> list[str]:
    return [f"CAST(r DIV {tile} AS INT) AS tile_row", f"CAST(c DIV {tile} AS INT) AS tile_col"]


def _sql_pos(tile: int, also: str = "true") -> str:
    """Place in the block; a pixel outside the grid fails the job."""
    return (
        f"CASE WHEN r >= 0 AND c >= 0 AND {also} "
        f"THEN CAST((r % {tile}) * {tile} + (c % {tile}) AS INT) "
        "ELSE raise_error('pixel outside the grid: its row, column or year is negative or missing') END AS pos"
    )


def layer_key(tiles: DataFrame) -> list[str]:
    return ["layer"] if "layer" in tiles.columns else []


def _dense(keyed: DataFrame, keys: list[str], tile: int, cols: list[str], nodata: float | None) -> DataFrame:
    """``keys, pos, cols`` dealt by tile -> a row per key with one dense block for each of ``cols``.

    First a block's lines, then the block from its lines: the lists under way hold a line's entries or a block's
    lines, never all entries of many blocks.
    """
    fill = sql_float_literal(float("nan") if nodata is None else nodata)
    if "layer" in keys:
        fill = f"CASE WHEN layer = 0 THEN {fill} END"
    # its length hangs on a column: no literal of the plan
    fill_line = f"array_repeat({fill}, IF(tile_row >= 0, {tile}, 0))"
    prev = "concat(array(-1), slice(transform(e, x -> x.at), 1, size(e) - 1))"

    def collected(df, by):
        return df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("at", *cols))).alias("e"))

    def filled(col, gap):
        """The entries in order, with a run of ``gap`` before each and after the last; a repeated place makes it too long."""
        runs = f"flatten(zip_with(e, {prev}, (x, p) -> concat(array_repeat({gap}, greatest(x.at - p - 1, 0)), array(x.{col}))))"
        return F.expr(f"concat({runs}, array_repeat({gap}, {tile - 1} - element_at(e, -1).at))").alias(col)

    entries = keyed.selectExpr(*keys, f"CAST(pos DIV {tile} AS INT) AS line", f"CAST(pos % {tile} AS INT) AS at", *cols)
    lines = collected(entries, [*keys, "line"]).select(*keys, "line", *[filled(c, fill) for c in cols])
    once = f"CASE WHEN size({cols[0]}) = {tile} THEN line ELSE raise_error('a year and pixel came twice') END AS at"
    return collected(lines.selectExpr(*keys, once, *cols), keys).select(*keys, *[filled(c, fill_line) for c in cols])


def _blocks(tiles: DataFrame, tile: int, row_range, col_range) -> DataFrame:
    """The tiles of a window; a block that isn't ``tile x tile`` fails the job."""
    t = tiles
    if row_range is not None:
        t = t.where(F.col("tile_row").between(row_range[0] // tile, row_range[1] // tile))
    if col_range is not None:
        t = t.where(F.col("tile_col").between(col_range[0] // tile, col_range[1] // tile))
    fits = f"size(values) = {tile} AND forall(values, x -> x IS NOT NULL AND size(x) = {tile}) AND tile_row >= 0 AND tile_col >= 0"
    checked = f"CASE WHEN {fits} THEN values ELSE raise_error('a block is missing or not {tile} x {tile}, or lies outside the grid') END"
    return t.select("year", *layer_key(t), "tile_row", "tile_col", F.expr(checked).alias("values"))


def tiles_to_pixels(
    tiles: DataFrame,
    grid: GridSpec,
    tile: int | None = None,
    row_range: tuple[int, int] | None = None,
    col_range: tuple[int, int] | None = None,
) -> DataFrame:
    """S3: tile table -> long pixels ``(r, c, lat, lon, year, value)``.

    ``row_range``/``col_range`` (inclusive pixel ranges) select a window: the
    tile-range part is a plain predicate on the tile columns, pushed to the
    scan; the exact pixel range is applied after the explode. The layers of a
    layered table follow one another: a position gives a row for each value.
    """
    tile = grid.tile_side(tile)
    t = _blocks(tiles, tile, row_range, col_range)
    layer = layer_key(t)
    # a block is never empty; a plain explode would get a filter on its size, for which the block is built another time
    rows = t.select(
        "year", *layer, "tile_row", "tile_col", F.posexplode_outer("values").alias("lr", "row_values")
    )
    px = rows.select(
        "year",
        *layer,
        (F.col("tile_row") * F.lit(tile) + F.col("lr")).cast("long").alias("r"),
        "tile_col",
        F.posexplode_outer("row_values").alias("lc", "value"),
    )
    if layer:
        px = px.where("layer = 0 OR value IS NOT NULL")
    px = px.select(
        "r",
        (F.col("tile_col") * F.lit(tile) + F.col("lc")).cast("long").alias("c"),
        "year",
        "value",
    )
    if row_range is not None:
        px = px.where(F.col("r").between(*row_range))
    if col_range is not None:
        px = px.where(F.col("c").between(*col_range))
    px = px.where((F.col("r") < grid.height) & (F.col("c") < grid.width))
    return px.select(
        "r",
        "c",
        pixel_lat("r", grid).alias("lat"),
        pixel_lon("c", grid).alias("lon"),
        "year",
        "value",
    )


def tiles_to_wide_pixels(
    tiles: DataFrame,
    grid: GridSpec,
    tile: int | None,
    years: list[int],
    row_range: tuple[int, int] | None = None,
    col_range: tuple[int, int] | None = None,
    keep_tile: bool = False,
) -> DataFrame:
    """S3 + F17 + F2 at tile granularity: tile table -> wide pixels
    ``r, c, lat, lon, pop_<year>...``; with ``keep_tile`` also ``tile_row, tile_col``.

    Years are aligned per *tile*: the only exchange groups one row per
    (tile, year) -- a few rows per tile, each a bounded array -- instead of
    one row per pixel and year. A tile table bucketed on (tile_row,
    tile_col) (``sources.tile_store``) needs no exchange at all. The arrays of all years are then
    zipped and exploded row by row, column by column. A year missing for a
    tile reads as nodata (the boundless fill); a tile with two blocks for one
    year, or a block of another size than the descriptor says, fails the job.
    The layers of a layered table are aligned one by one: a position gives a row
    for each pixel that it has.
    """
    if len(set(years)) != len(years):
        raise ValueError(f"duplicate years: {years}")
    tile = grid.tile_side(tile)
    t = _blocks(tiles, tile, row_range, col_range)
    ys = [int(y) for y in years]
    aggs, picked = _one_per_year("values", ys, "first")
    layer = layer_key(t)
    per_tile = t.where(F.col("year").isin(ys)).groupBy("tile_row", "tile_col", *layer).agg(*aggs)
    fill = sql_float_literal(float("nan") if grid.nodata is None else grid.nodata)
    # its sides hang on a column, or the optimizer would put the block's values into the plan
    side = f"IF(tile_row >= 0, {tile}, 0)"
    fill_tile = f"array_repeat(array_repeat({fill}, {side}), {side})"
    yc = [F.expr(f"coalesce({picked[y].format(what='tile')}, {fill_tile})").alias(pop_col(y)) for y in ys]
    rows = per_tile.select(
        "tile_row", "tile_col", *layer, F.posexplode_outer(F.arrays_zip(*yc)).alias("lr", "yrows")
    )
    own = ["tile_row", "tile_col"] if keep_tile else []
    px = rows.select(
        *own[:1],
        *layer,
        (F.col("tile_row") * F.lit(tile) + F.col("lr")).cast("long").alias("r"),
        "tile_col",
        F.posexplode_outer(F.arrays_zip(*[F.col("yrows")[pop_col(y)].alias(pop_col(y)) for y in ys])).alias(
            "lc", "v"
        ),
    )
    if layer:
        px = px.where(" OR ".join(["layer = 0", *[f"v.{pop_col(y)} IS NOT NULL" for y in ys]]))
    px = px.select(
        *own,
        "r",
        (F.col("tile_col") * F.lit(tile) + F.col("lc")).cast("long").alias("c"),
        *[F.col("v")[pop_col(y)].alias(pop_col(y)) for y in ys],
    )
    if row_range is not None:
        px = px.where(F.col("r").between(*row_range))
    if col_range is not None:
        px = px.where(F.col("c").between(*col_range))
    px = px.where((F.col("r") < grid.height) & (F.col("c") < grid.width))
    return px.select(
        *own,
        "r",
        "c",
        pixel_lat("r", grid).alias("lat"),
        pixel_lon("c", grid).alias("lon"),
        *[pop_col(y) for y in ys],
    )
