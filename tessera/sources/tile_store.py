"""Stored tile tables (S3): bucketed on (tile_row, tile_col), read by window.

Every block of a tile, whatever its year, lies in one bucket, sorted by tile. So
* aligning years (a group per tile) and everything grouped by tile after it plans without an
  exchange: the pixels never move between storage and the per-tile sums;
* a window read is a predicate on tile_row and tile_col, pushed to the scan, where the
  sorted buckets let it skip row groups.

``write_tile_folders`` is the other layout, for points: a folder per tile, which a join with a
table of points prunes at run time.

The blocks are plain Parquet with the bucket layout in a descriptor beside them
(``_tile_store.json``: grid, tile side, buckets, whether layered), from which any session opens the table.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from .grid import GridSpec, layer_key

# --- fixed names of the layout -------------------------------------------------------------
DESCRIPTOR = "_tile_store.json"
KEYS = ("tile_row", "tile_col")
# -------------------------------------------------------------------------------------------

COLUMNS = "year INT, tile_row INT, tile_col INT, `values` ARRAY<ARRAY<FLOAT>>"
LAYERED_COLUMNS = f"{COLUMNS}, layer INT"
BUCKET_BYTES = 256 << 20  # of blocks before compression that a bucket is to hold
GROUP_VALUES = 1 << 19  # of a row group: a reader unpacks as many rows at once as a group has, up to thousands of blocks


def buckets_for(n_tiles: int, n_years: int, tile: int, at_least: int = 1) -> int:
    """Buckets of about ``BUCKET_BYTES`` for so many tiles; one task reads a bucket."""
    return max(at_least, -(-n_tiles * n_years * tile * tile * 4 // BUCKET_BYTES))


def _rows_of_a_group(grid: GridSpec, tile: int | None) -> dict[str, int]:
    """Write option that bounds the values, not the encoded bytes, of a row group: blocks of fill take hardly any bytes."""
    return {"parquet.block.row.count.limit": max(1, GROUP_VALUES // grid.tile_side(tile) ** 2)}


def write_tiles(tiles: DataFrame, path: str, grid: GridSpec, tile: int | None, buckets: int) -> DataFrame:
    """Store a tile table; the stored table, opened. ``path`` must be new.

    Dealing the rows by bucket first gives one file a bucket; rows that are already dealt by tile into
    as many partitions don't move.
    """
    from ..sinks.manifest import write_marker

    spark = tiles.sparkSession
    name = f"tiles_{uuid.uuid4().hex}"
    layer = layer_key(tiles)
    dealt = tiles.select("year", *KEYS, "values", *layer).repartition(buckets, *KEYS).sortWithinPartitions(*KEYS, *layer, "year")
    (
        dealt.write.format("parquet").mode("errorifexists").option("compression", "zstd").option("path", path)
        .options(**_rows_of_a_group(grid, tile)).bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(name)
    )
    facts = {"grid": asdict(grid), "tile": grid.tile_side(tile), "buckets": buckets, "layered": bool(layer)}
    write_marker(spark, f"{path}/{DESCRIPTOR}", json.dumps(facts))
    return _opened(spark, name)


def write_tile_folders(tiles: DataFrame, path: str, grid: GridSpec, tile: int | None) -> DataFrame:
    """Store a tile table with a folder per tile, for point reads; the stored table. ``path`` must be new.

    A folder holds a tile's blocks of all years and is written by one task, so there are as many tasks as tiles of the
    grid: merged by their bytes, which blocks of fill take hardly any of, one would sort many tiles. Meant for tiles of a few hundred pixels a side: a 1 km grid of
    the globe has some 3,000 of 512.
    """
    from ..sinks.manifest import write_marker

    spark = tiles.sparkSession
    layer = layer_key(tiles)
    side = grid.tile_side(tile)
    n_tiles = -(-grid.height // side) * -(-grid.width // side)
    dealt = tiles.select("year", *KEYS, "values", *layer).repartition(n_tiles, *KEYS).sortWithinPartitions(*KEYS, *layer, "year")
    dealt.write.mode("errorifexists").option("compression", "zstd").options(**_rows_of_a_group(grid, tile)).partitionBy(*KEYS).parquet(path)
    facts = {"grid": asdict(grid), "tile": side, "layered": bool(layer)}
    write_marker(spark, f"{path}/{DESCRIPTOR}", json.dumps(facts))
    return read_tile_folders(spark, path)


def read_tile_folders(spark: SparkSession, path: str) -> DataFrame:
    """``year, values, [layer,] tile_row, tile_col`` of a table with a folder per tile."""
    from ..sinks.snapshots import read_text

    return spark.read.schema(_columns(json.loads(read_text(spark, f"{path}/{DESCRIPTOR}")))).parquet(path)


def _columns(facts: dict) -> str:
    return LAYERED_COLUMNS if facts.get("layered") else COLUMNS


def _opened(spark: SparkSession, name: str) -> DataFrame:
    """The table's frame; its name leaves the catalog again (the files are external to it), the frame keeps the bucket layout."""
    frame = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return frame


def open_tiles(spark: SparkSession, path: str) -> tuple[DataFrame, GridSpec, int]:
    """A stored tile table, its grid and its tile side, in any session (the files stay where they are)."""
    from ..sinks.snapshots import read_text

    facts = json.loads(read_text(spark, f"{path}/{DESCRIPTOR}"))
    name = f"tiles_{uuid.uuid4().hex}"
    keys = ", ".join(KEYS)
    where = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({_columns(facts)}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {int(facts['buckets'])} BUCKETS LOCATION '{where}'"
    )
    return _opened(spark, name), GridSpec(**facts["grid"]), int(facts["tile"])
