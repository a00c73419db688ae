"""Stored tiles and the index build that shuffles boundary cells only."""

import dataclasses
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import cells
from tessera.operators import index as X
from tessera.operators import inspect as I
from tessera.operators.mask import apply_mask
from tessera.operators.tiled_index import build_index_from_tiles, interior, tile_sums
from tessera.plans import queries as Q
from tessera.sources.fixture import FIXTURE_GRID, FIXTURE_YEARS, pixel_view
from tessera.sources.grid import GridSpec, pixels_to_tiles, tiles_to_pixels, tiles_to_wide_pixels, unstack_years, wide_pixels_to_tiles
from tessera.sources.tile_store import buckets_for, open_tiles, write_tile_folders, write_tiles

from .conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _exchange_bytes(df) -> int:
    """Bytes written by the exchanges of an executed plan, from its nodes' metrics."""
    df.collect()

    def walk(node) -> int:
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleBytesWritten").get().value() if name == "ShuffleExchangeExec" else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def _tiles(px, tile, nodata=-99999.0):
    return pixels_to_tiles(unstack_years(px, ["r", "c"], FIXTURE_YEARS), tile, nodata)


def test_window_read_of_stored_tiles_plans_without_exchange(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "tiles")
    write_tiles(_tiles(px, 32), path, FIXTURE_GRID, 32, 4)
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) == 4  # one file a bucket
    tiles, grid, tile = open_tiles(spark, path)
    assert grid == FIXTURE_GRID and tile == 32
    spark.conf.set("spark.sql.maxMetadataStringLength", "3000")
    win = tiles_to_wide_pixels(tiles, grid, tile, FIXTURE_YEARS, (100, 419), (0, 1103))
    plan = _plan(win)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert "GreaterThanOrEqual(tile_row,3)" in pushed and "LessThanOrEqual(tile_row,13)" in pushed and "LessThanOrEqual(tile_col,34)" in pushed
    want = px.where("r BETWEEN 100 AND 419 AND c <= 1103").select("r", "c", "lat", "lon", *Q.POP)
    assert _same(win.where("pop_2025 <> -99999 OR pop_2100 <> -99999"), want.where("pop_2025 <> -99999 OR pop_2100 <> -99999"))
    assert spark.sql("SHOW TABLES").where("tableName LIKE 'tiles\\_%'").count() == 0
    # an index over the stored tiles moves nothing before its boundary cells
    sums = tile_sums(tiles, grid, tile, FIXTURE_YEARS, [2, 5])
    assert "Exchange" not in _plan(sums)


def test_store_refuses_to_overwrite(spark, tmp_dir):
    path = os.path.join(tmp_dir, "tiles")
    tiles = _tiles(pixel_view(spark, SF_SMALL), 64)
    write_tiles(tiles, path, FIXTURE_GRID, 64, 2)
    with pytest.raises(Exception, match="(?i)exist|not empty"):
        write_tiles(tiles, path, FIXTURE_GRID, 64, 2)


def test_buckets_follow_the_data():
    assert buckets_for(100, 3, 32) == 1 and buckets_for(100, 3, 32, at_least=8) == 8
    assert buckets_for(2 * 10**6, 16, 512) > 10_000


@pytest.mark.parametrize("tile", [7, 64, 1440])
def test_index_from_tiles_equals_the_one_over_pixels(spark, tile):
    px = pixel_view(spark, SF_SMALL)
    got = build_index_from_tiles(_tiles(px, tile), FIXTURE_GRID, FIXTURE_YEARS, [1, 3, 8], tile)
    assert _same(got, X.build_index(px, Q.POP, [1, 3, 8], Q.NODATA))


def test_interior_cells_have_all_their_pixels_in_one_tile(spark):
    """Dense pixels: no interior cell occurs in a second tile, and every cell in two tiles is a boundary cell."""
    grid = GridSpec(10.0, 55.0, 0.05, 0.05, 300, 300, nodata=None)
    px = spark.range(300 * 300).selectExpr("id div 300 AS r", "id % 300 AS c", *[f"CAST(1 + id % 5 AS FLOAT) AS {p}" for p in Q.POP])
    sums = tile_sums(_tiles(px, 50, None), grid, 50, FIXTURE_YEARS, [2, 3, 4, 5, 6]).cache()
    per = sums.groupBy("h3_res", "h3_index").agg(F.count(F.lit(1)).alias("n"), F.max("interior").alias("any"), F.min("interior").alias("all"))
    assert per.where("any AND n > 1").isEmpty() and per.where("any <> all AND any").isEmpty()
    share = {r["h3_res"]: r["s"] for r in sums.groupBy("h3_res").agg(F.avg(F.col("interior").cast("double")).alias("s")).collect()}
    assert share[6] > share[4] > share[3] and share[6] > 0.8
    sums.unpersist()


def test_interior_against_plain_geometry(spark):
    """The flag against corner points of each hexagon computed in numpy."""
    grid, tile = FIXTURE_GRID, 40
    px = pixel_view(spark, SF_SMALL)
    rows = tile_sums(_tiles(px, tile), grid, tile, FIXTURE_YEARS, [2, 4, 6]).select("tile_row", "tile_col", "h3_res", "h3_index", "interior").collect()
    km = cells.EARTH_RADIUS_KM
    seen = set()
    for t in rows:
        k = cells.res_constants(t.h3_res)
        q = ((t.h3_index >> cells.Q_SHIFT) & cells.AXIS_MASK) - cells.AXIS_OFFSET
        r = (t.h3_index & cells.AXIS_MASK) - cells.AXIS_OFFSET
        xs, ys = (q + r / 2) * k.cx + np.array(k.vx), r * k.cy + np.array(k.vy)
        west, east = (km * np.radians(grid.origin_lon + (t.tile_col + i) * tile * grid.dx) for i in (0, 1))
        north, south = (km * np.sin(np.radians(grid.origin_lat - (t.tile_row + i) * tile * grid.dy)) for i in (0, 1))
        inside = (t.tile_col == 0 or xs.min() > west) and (t.tile_col == grid.width // tile - 1 or xs.max() < east)
        inside &= (t.tile_row == 0 or ys.max() < north) and (t.tile_row == grid.height // tile - 1 or ys.min() > south)
        assert inside == t.interior
        seen.add(inside)
    assert seen == {True, False}


def test_shuffled_bytes_grow_with_edges_not_with_pixels(spark):
    def shuffled(side, tile):
        """Index of 16 x 16 degrees in ``side`` x ``side`` pixels, tiles of ``tile`` pixels."""
        grid = GridSpec(0.0, 48.0, 16 / side, 16 / side, side, side, nodata=None)
        px = spark.range(side * side).selectExpr(f"id div {side} AS r", f"id % {side} AS c", *[f"CAST(1 + id % 9 AS FLOAT) AS {p}" for p in Q.POP])
        index = build_index_from_tiles(_tiles(px, tile, None), grid, FIXTURE_YEARS, [4], tile)
        whole = X.build_index(tiles_to_wide_pixels(_tiles(px, tile, None), grid, tile, FIXTURE_YEARS), Q.POP, [4], None)
        assert index.count() == whole.count()
        return _exchange_bytes(index)

    few, many = shuffled(64, 16), shuffled(256, 64)  # the same tile edges, 16 times the pixels
    edges = shuffled(256, 16)  # four times the edges, the same pixels
    assert 0 < many < 1.3 * few and edges > 2 * many


def test_other_id_systems_and_grids_are_refused(spark):
    tiles = _tiles(pixel_view(spark, SF_SMALL), 64)
    with pytest.raises(ValueError, match="'hex' only"):
        build_index_from_tiles(tiles, FIXTURE_GRID, FIXTURE_YEARS, [2], 64, system="h3")
    with pytest.raises(ValueError, match="north-up"):
        build_index_from_tiles(tiles, dataclasses.replace(FIXTURE_GRID, dy=-0.25), FIXTURE_YEARS, [2], 64)


def test_empty_tiles(spark):
    tiles = _tiles(pixel_view(spark, SF_SMALL).where("lat > 100"), 64)
    assert build_index_from_tiles(tiles, FIXTURE_GRID, FIXTURE_YEARS, [2, 3], 64).count() == 0


def test_flag_is_a_column_expression(spark):
    plan = _plan(spark.range(5).selectExpr("0 AS tile_row", "1 AS tile_col", "2 AS h3_res", f"id + {cells.res_constants(2).base} AS h3_index").select(interior(FIXTURE_GRID, 32)))
    assert "Python" not in plan


# --- positions that repeat: a layer for each


def _repeated(spark):
    """Pixels of which some come two to five times, once with equal and once with null values, on FIXTURE_GRID's lattice."""
    rows = [(k, k * 7 % 200, k * 11 % 300) for k in range(400)]
    rows += [(1000 + k, 0, 0) for k in range(5)] + [(2000, 360, 720), (2001, 360, 720), (2001, 360, 720), (2002, 360, 720)]
    rows += [(3000 + k, 10 + k % 2, 10) for k in range(6)] + [(4000 + k, 719, 1439) for k in range(2)]
    px = spark.createDataFrame(rows, "pixel_id long, r long, c long")
    pops = {p: F.expr(f"CAST(CASE WHEN pixel_id = 1003 THEN NULL WHEN pixel_id % 17 = {i} THEN -99999 ELSE (pixel_id * 13 + {i}) % 90 END AS FLOAT)") for i, p in enumerate(Q.POP)}
    return px.withColumns({"lat": F.expr("90.0D - (r + 0.5D) * 0.25D"), "lon": F.expr("-180.0D + (c + 0.5D) * 0.25D"), **pops})


def _layered(px, tile):
    return wide_pixels_to_tiles(px, tile, FIXTURE_YEARS, -99999.0, ["pixel_id"])


@pytest.mark.parametrize("tile", [16, 90])
def test_repeated_pixels_all_come_back(spark, tile):
    px = _repeated(spark)
    tiles = _layered(px, tile)
    assert tiles.agg(F.max("layer")).first()[0] == 5 and tiles.groupBy("year", "layer", "tile_row", "tile_col").count().where("count > 1").isEmpty()
    want = apply_mask(px, Q.POP, Q.NODATA).select("r", "c", "lat", "lon", *Q.POP)
    assert want.count() > want.select("r", "c").distinct().count()
    assert _same(apply_mask(tiles_to_wide_pixels(tiles, FIXTURE_GRID, tile, FIXTURE_YEARS), Q.POP, Q.NODATA), want)
    long = unstack_years(px, ["r", "c"], FIXTURE_YEARS).where("value <> -99999")
    assert _same(tiles_to_pixels(tiles, FIXTURE_GRID, tile).where("value <> -99999").select("r", "c", "year", "value"), long)
    # the years of a pixel stay together, whatever the order of rows
    assert _same(tiles, _layered(px.orderBy(F.desc("pixel_id")), tile))


def test_repeated_pixels_in_stored_tiles(spark, tmp_dir):
    px = _repeated(spark)
    path = os.path.join(tmp_dir, "tiles")
    write_tiles(_layered(px, 32), path, FIXTURE_GRID, 32, 4)
    tiles, grid, tile = open_tiles(spark, path)
    win = tiles_to_wide_pixels(tiles, grid, tile, FIXTURE_YEARS, (0, 100), (0, 100))
    assert "Exchange" not in _plan(win) and "Exchange" not in _plan(tile_sums(tiles, grid, tile, FIXTURE_YEARS, [2, 5]))
    want = apply_mask(px, Q.POP, Q.NODATA).where("r <= 100 AND c <= 100").select("r", "c", "lat", "lon", *Q.POP)
    assert _same(apply_mask(win, Q.POP, Q.NODATA), want)
    assert _same(build_index_from_tiles(tiles, grid, FIXTURE_YEARS, [1, 3, 8], tile), X.build_index(px, Q.POP, [1, 3, 8], Q.NODATA))


def test_repeated_pixels_in_tile_folders(spark, tmp_dir):
    px = _repeated(spark)
    folders = write_tile_folders(_layered(px, 90), os.path.join(tmp_dir, "folders"), FIXTURE_GRID, 90)
    got = I.sample_points_tiles(spark, folders, FIXTURE_GRID, FIXTURE_YEARS, 90)
    want = I.sample_points(spark, px, FIXTURE_GRID, FIXTURE_YEARS)
    assert _same(got, want) and got.count() == 5 + 3 + 2
    stats = [f.orderBy("year").collect() for f in (I.grid_stats_center_tiles(folders, FIXTURE_GRID, FIXTURE_YEARS, 90), I.grid_stats_center(px, FIXTURE_GRID, FIXTURE_YEARS))]
    for a, b in zip(*stats, strict=True):
        assert (a.n_valid, a["min"], a["max"]) == (b.n_valid, b["min"], b["max"]) and a["mean"] == pytest.approx(b["mean"])


def test_tile_queries_take_more_orders_than_positions(spark, tmp_dir):
    """Keys beyond the fixture's lattice fall on positions that are taken."""
    orders = spark.range(60).selectExpr("id % 30 + 1036800 * (id DIV 30) AS o_orderkey", "id * 7 AS o_custkey")
    orders.write.parquet(os.path.join(tmp_dir, "orders.parquet"))
    px = Q._valid(spark, tmp_dir)
    assert _same(Q.tiles_roundtrip(spark, tmp_dir), px.select("r", "c", "lat", "lon", *Q.POP))
    assert all(t.n_pixels == t.n_tiles and t.total_pixels == t.total_tiles for t in Q.tile_conservation(spark, tmp_dir).collect())
    assert _same(Q.index_tiled(spark, tmp_dir), Q.QUERIES["index_all_res"](spark, tmp_dir))
    for name in ("tile_window", "tile_split", "sample_points_tiles", "grid_stats_tiles"):
        Q.QUERIES[name](spark, tmp_dir).collect()


def test_blocks_are_collected_by_line_and_read_a_few_at_a_time(spark, tmp_dir):
    """No list holds a block's single pixels, and a row group has a bounded number of values (heap errors at 9M orders)."""
    import pyarrow.parquet as pq

    grid, n = GridSpec(0.0, 8.0, 0.25, 0.25, 32, 32), 1200  # so many pixels at one position: a layer each
    px = spark.range(n).selectExpr("id AS pixel_id", "CAST(floor(id / 1e9) AS BIGINT) + 5 AS r", "CAST(floor(id / 1e9) AS BIGINT) + 7 AS c", "CAST(id AS FLOAT) AS pop_2025")
    tiles = wide_pixels_to_tiles(px, 32, [2025], -99999.0, ["pixel_id"])
    plan = _plan(tiles)
    assert plan.count("Exchange") == 1 and re.search(r"line#\d+\w*\], functions=\[collect_list", plan)
    for name, stored in (
        ("bucketed", write_tiles(tiles, os.path.join(tmp_dir, "bucketed"), grid, 32, 1)),
        ("folders", write_tile_folders(tiles, os.path.join(tmp_dir, "folders"), grid, 32)),
    ):
        files = [os.path.join(d, f) for d, _, fs in os.walk(os.path.join(tmp_dir, name)) for f in fs if f.endswith(".parquet")]
        groups = [m.row_group(i).num_rows for m in map(pq.read_metadata, files) for i in range(m.num_row_groups)]
        assert sum(groups) == n and max(groups) <= 512
        got = tiles_to_wide_pixels(stored, grid, 32, [2025]).where("r = 5 AND c = 7")
        assert sorted(x.pop_2025 for x in got.collect()) == list(range(n))


def test_tasks_that_make_blocks_follow_the_pixels(spark):
    """A task has a bounded number of pixels, whatever their bytes (AQE merged them into a task a core: heap errors at 9M orders)."""
    n = (12 << 16) + 1
    px = spark.range(n).selectExpr("id AS pixel_id", "id % 720 AS r", "id DIV 720 AS c", *[f"CAST(1 + id % 9 AS FLOAT) AS {p}" for p in Q.POP])
    wide, long = _layered(px, 32), pixels_to_tiles(px.selectExpr("2025 AS year", "r", "c", "pop_2025 AS value"), 32, -99999.0)
    for tiles in (wide, long):
        assert re.search(r"hashpartitioning\(tile_row#\d+, tile_col#\d+, 13\), REPARTITION_BY_NUM", _plan(tiles))
    few = _layered(px.limit(5), 32)
    assert f", {spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in _plan(few) and few.count() == 3


def test_no_task_sorts_many_tile_folders(spark, tmp_dir):
    """Folders of blocks are dealt over as many tasks as the grid has tiles, not merged by their few bytes."""
    path = os.path.join(tmp_dir, "folders")
    write_tile_folders(_layered(_repeated(spark), 90), path, FIXTURE_GRID, 90)
    tasks = [(f.split("-")[1], d) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")]
    per_task = [sum(t == task for t, _ in tasks) for task in {t for t, _ in tasks}]
    assert len({d for _, d in tasks}) == len(tasks) >= 12 and max(per_task) <= 4


def test_fill_of_a_missing_year_is_no_literal_of_the_plan(spark):
    """A block's line of fill values stood in the plan's text for each year: 40 KB at tiles of 1440."""
    tiles = _tiles(pixel_view(spark, SF_SMALL).where("lat > 100"), 1440)
    plan = _plan(tiles_to_wide_pixels(tiles, FIXTURE_GRID, 1440, FIXTURE_YEARS))
    assert "-99999.0,-99999.0" not in plan and len(plan) < 20_000
