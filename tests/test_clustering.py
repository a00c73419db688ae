"""The curve over cells, box reads along it, bitmaps, and points read from tile folders."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import cells
from tessera.functions import curve as C
from tessera.operators import analytics as A
from tessera.operators import index as X
from tessera.operators import inspect as I
from tessera.operators.mask import apply_mask
from tessera.plans import queries as Q
from tessera.sinks.parquet import write_curve_index, write_index
from tessera.sources.fixture import FIXTURE_GRID, FIXTURE_YEARS_6, pixel_view
from tessera.sources.grid import window_index
from tessera.sources.index_reader import read_index

from .conftest import SF_MID, SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _metric(df, node_name: str, metric: str) -> int:
    df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get(metric).get().value() if name == node_name else 0
        return own + sum(walk(node.children().apply(i)) for i in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_places_equal_plain_interleaving_and_are_unique(spark):
    r = random.Random(3)
    points = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(400)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    rows = df.select(F.explode(F.array(*[cells.cell_of("lat", "lon", k) for k in (0, 3, 8, 15)])).alias("id")).distinct().select("id", C.curve("id").alias("at")).collect()
    for row in rows:
        q = ((row.id >> cells.Q_SHIFT) & cells.AXIS_MASK) - cells.AXIS_OFFSET
        k = (row.id & cells.AXIS_MASK) - cells.AXIS_OFFSET
        assert row["at"] == C.place(q + (k >> 1) + C.COLUMN_OFFSET, k + cells.AXIS_OFFSET) and row["at"] > 0
    assert len({((x.id >> 55) & 15, x["at"]) for x in rows}) == len(rows)


def test_ranges_hold_their_rectangle():
    r = random.Random(4)
    for _ in range(60):
        c0, r0 = r.randrange(1 << 27), r.randrange(1 << 27)
        c1, r1 = c0 + r.randrange(40), r0 + r.randrange(40)
        for most in (1, 4, 32):
            spans = C.ranges(c0, c1, r0, r1, most)
            assert 1 <= len(spans) <= most and all(a <= b for a, b in spans) and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))
            inside = {C.place(c, k) for c in range(c0, c1 + 1) for k in range(r0, r1 + 1)}
            assert all(any(a <= p <= b for a, b in spans) for p in inside)
    assert sum(b - a + 1 for a, b in C.ranges(64, 127, 0, 63)) == 64 * 64  # a square of the curve is one range, nothing more
    assert C.ranges(5, 4, 0, 0) == []
    wide = C.ranges(0, (1 << 28) - 1, 0, (1 << 27) - 1)
    assert wide[0][0] == 0


BOXES = [(-30, 30, 55, 70), (-90, 90, 10, 11), (20, 20.6, -180, 180), (60, 90, -180, -100), (-90, -60, 100, 180), (5, 5, 5, 5)]


def test_boxes_along_the_curve_select_the_same(spark, tmp_dir):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [4], Q.NODATA)
    write_curve_index(idx, f"{tmp_dir}/c", "SSP2")
    stored = read_index(spark, f"{tmp_dir}/c", "SSP2", 4).select("h3_index", "h3_curve", *Q.POP)
    for box in BOXES:
        a = A.where_bbox(stored, *box, res=4)
        b = A.where_bbox_curve(stored, *box, res=4)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_a_small_box_reads_less_in_both_axes(spark, tmp_dir):
    """Rows that the scan lets through: of the id order a stripe from pole to pole, along the curve an area."""
    px = spark.range(240 * 480).selectExpr("-89.6 + (id div 480) * 0.75 AS lat", "-179.6 + (id % 480) * 0.75 AS lon", *[f"CAST(1 AS FLOAT) AS {p}" for p in Q.POP])
    idx = X.build_index(px, Q.POP, [4], None)
    write_index(idx, f"{tmp_dir}/ids", "SSP2", n_partitions=4, row_group_rows=100)
    write_curve_index(idx, f"{tmp_dir}/curve", "SSP2", n_partitions=4, row_group_rows=100)
    by_id, by_curve = (read_index(spark, f"{tmp_dir}/{d}", "SSP2", 4) for d in ("ids", "curve"))
    read = {}
    for box in ((10, 14, 20, 24), (-60, 60, 20, 22), (10, 12, -100, 100)):
        a, b = A.where_bbox(by_id, *box, res=4), A.where_bbox_curve(by_curve, *box, res=4)
        assert a.count() == b.count() > 0
        read[box] = [_metric(x, "FileSourceScanExec", "numOutputRows") for x in (a, b)]
    small, high, wide = read.values()
    assert small[1] < small[0] / 3  # a small box in both axes
    assert wide[1] < wide[0] / 3 and high[1] < by_id.count() / 5
    plan = _plan(A.where_bbox_curve(by_curve, 10, 14, 20, 24, res=4))
    assert re.search(r"PushedFilters: \[[^\]]*Or\(", plan) and "Exchange" not in plan


def test_bitmaps_count_exactly_and_merge(spark):
    valid = apply_mask(pixel_view(spark, SF_SMALL), Q.POP, Q.NODATA)
    res = [1, 4, 8]
    maps = X.cell_bitmaps(valid, res)
    windows = {(r.win_idx, r.h3_res): (r.n_pixels, r.n_cells) for r in X.count_bitmaps(maps, ["win_idx", "h3_res"]).collect()}
    assigned = X.assign_cells(valid.select("lat", "lon", window_index("lat", "lon").alias("win_idx")), res, ["win_idx"])
    want = assigned.groupBy("win_idx", "h3_res").agg(F.count(F.lit(1)).alias("p"), F.countDistinct("h3_index").alias("n")).collect()
    assert windows == {(r.win_idx, r.h3_res): (r.p, r.n) for r in want}
    globe = {r.h3_res: r.n_cells for r in X.count_bitmaps(maps, ["h3_res"]).collect()}
    assert globe == {r.h3_res: r.n_cells for r in X.distinct_cells(assigned).collect()}
    # a second batch of pixels, some of them seen before, by a further OR
    west, east = (X.cell_bitmaps(valid.where(w), res) for w in ("lon < 20", "lon > 0"))
    again = {r.h3_res: r.n_cells for r in X.count_bitmaps(west.union(east), ["h3_res"]).collect()}
    assert again == globe
    total = X.count_bitmaps(maps, ["win_idx"]).agg(F.sum("n_pixels")).first()[0]
    assert total == valid.count() * len(res)
    assert "Python" not in _plan(maps)


def test_bitmaps_of_no_pixels(spark):
    none = pixel_view(spark, SF_SMALL).where("lat > 100")
    assert X.count_bitmaps(X.cell_bitmaps(none, [3]), ["h3_res"]).count() == 0


def test_points_read_at_most_five_tile_folders(spark):
    tiles = Q._tile_folders(spark, SF_MID)
    assert tiles.select("tile_row", "tile_col").distinct().count() > 20
    got = I.sample_points_tiles(spark, tiles, FIXTURE_GRID, FIXTURE_YEARS_6, Q.POINT_TILE)
    assert "dynamicpruning" in _plan(got).lower()
    assert 0 < _metric(got, "FileSourceScanExec", "numPartitions") <= 5
    want = I.sample_points(spark, pixel_view(spark, SF_MID, six_years=True), FIXTURE_GRID, FIXTURE_YEARS_6)
    plain = lambda df: sorted((tuple("nan" if isinstance(v, float) and np.isnan(v) else v for v in r) for r in df.collect()), key=repr)
    assert plain(got) == plain(want)


def test_center_statistics_read_the_windows_folders(spark):
    tiles = Q._tile_folders(spark, SF_SMALL)
    stats = I.grid_stats_center_tiles(tiles, FIXTURE_GRID, FIXTURE_YEARS_6, Q.POINT_TILE)
    plan = _plan(stats)
    assert "PartitionFilters: [isnotnull(tile_" in plan and "Exchange hashpartitioning(tile_row" in plan
    want = I.grid_stats_center(pixel_view(spark, SF_SMALL, six_years=True), FIXTURE_GRID, FIXTURE_YEARS_6)
    for a, b in zip(stats.orderBy("year").collect(), want.orderBy("year").collect(), strict=True):
        assert (a.n_valid, a.n_total, a["min"], a["max"]) == (b.n_valid, b.n_total, b["min"], b["max"])
