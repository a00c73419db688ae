"""Analytics operators: bbox pruning never loses a match, regions, top-k, stats, inspection."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import cells
from tessera.operators import analytics as A
from tessera.operators import index as X
from tessera.operators.inspect import center_window, grid_stats_center, sample_points
from tessera.plans import queries as Q
from tessera.sources.fixture import FIXTURE_GRID, pixel_view
from tessera.sources.grid import GridSpec

from .conftest import SF_MID, SF_SMALL


def _global_cells(spark, res, n=3000, seed=3):
    rng = np.random.default_rng(seed)
    pts = [(float(a), float(b)) for a, b in zip(rng.uniform(-90, 90, n), rng.uniform(-180, 180, n))]
    df = spark.createDataFrame(pts, "lat double, lon double")
    return df.select(cells.cell_of("lat", "lon", res).alias("h3_index")).distinct()


def test_bbox_range_never_drops_matches(spark):
    rng = np.random.default_rng(11)
    for res in (1, 3, 5):
        idx = _global_cells(spark, res).cache()
        boxes = [(-90.0, 90.0, -180.0, 180.0), (80.0, 90.0, 170.0, 180.0), (-90.0, -60.0, -180.0, -150.0)]
        for _ in range(6):
            la = sorted(rng.uniform(-90, 90, 2))
            lo = sorted(rng.uniform(-180, 180, 2))
            boxes.append((la[0], la[1], lo[0], lo[1]))
        for la0, la1, lo0, lo1 in boxes:
            exact = idx.where(cells.cell_lat("h3_index", res).between(la0, la1) & cells.cell_lng("h3_index", res).between(lo0, lo1))
            pruned = A.where_bbox(idx, la0, la1, lo0, lo1, res=res)
            assert exact.count() == pruned.count(), (res, la0, la1, lo0, lo1)
        idx.unpersist()


def test_continent_boxes_first_match_wins(spark):
    df = spark.createDataFrame(
        [(36.0, 40.0), (10.0, 100.0), (15.0, -60.0), (0.0, 0.0), (-80.0, 0.0)], "lat double, lng double"
    )
    got = [r[0] for r in df.select(A.continent_of("lat", "lng")).collect()]
    # (36, 40) is in both Africa and Europe: Africa comes first; (15, -60) is SA before NA
    assert got == ["Africa", "Asia", "South America", "Africa", "Other"]


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 5.0), (4, 7.0)], "h3_index long, v double")
    assert [r[0] for r in A.top_k(df, "v", 3).collect()] == [4, 1, 3]
    assert [r[0] for r in A.top_k(df, "v", 4, ascending=True).collect()] == [1, 3, 4, 2]


def test_population_and_extent_stats(spark):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [2, 5], Q.NODATA)
    ps = {(r["h3_res"], r["column_name"]): r for r in A.population_stats(idx, Q.POP).collect()}
    base = idx.where("h3_res = 5").agg(F.sum("pop_2025"), F.count(F.when(F.col("pop_2025") > 0, 1))).collect()[0]
    assert ps[(5, "pop_2025")]["total_pop"] == round(base[0])
    assert ps[(5, "pop_2025")]["cells_with_pop"] == base[1]
    ex = {r["h3_res"]: r for r in A.extent_stats(idx).collect()}
    assert abs(ex[5]["avg_area_km2"] - cells.res_constants(5).area_km2) < 1e-3
    assert -90 <= ex[2]["lat_min"] <= ex[2]["lat_max"] <= 90


def test_pop_columns_strict(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, 4.0)], "h3_index long, pop_2025 float, popX2030 float, pop_total float")
    assert A.pop_columns(df) == ["pop_2025"]


def test_grid_stats_center_matches_numpy(spark):
    px = pixel_view(spark, SF_MID)
    r0, c0, size = center_window(FIXTURE_GRID)
    st = {r["year"]: r for r in grid_stats_center(px, FIXTURE_GRID, [2025, 2050, 2100]).collect()}
    pdf = px.toPandas()
    w = pdf[(pdf.r >= r0) & (pdf.r < r0 + size) & (pdf.c >= c0) & (pdf.c < c0 + size)]
    v = w["pop_2050"].to_numpy(np.float64)
    v = v[(v != -99999.0) & np.isfinite(v)]
    s = st[2050]
    assert s["n_valid"] == len(v) and s["min"] == v.min() and s["max"] == v.max()
    assert abs(s["std"] - v.std()) < 1e-9 and s["n_total"] == size * size


def test_sample_points_fill(spark):
    px = pixel_view(spark, SF_SMALL)
    rows = {r["label"]: r for r in sample_points(spark, px, FIXTURE_GRID, [2025, 2050, 2100]).collect()}
    assert set(rows) == {"Center", "Top-left", "Top-right", "Bot-left", "Bot-right"}
    have = {(r["r"], r["c"]) for r in px.select("r", "c").collect()}
    for r in rows.values():
        if (r["r"], r["c"]) not in have:
            assert r["pop_2025"] == -99999.0


def test_grid_stats_reports_a_year_without_values(spark):
    grid = GridSpec(-180.0, 90.0, 1.0, 1.0, 4, 4, nodata=float("nan"))
    rows = [(r, c, float("nan"), 2.0 if r else float("inf")) for r in range(4) for c in range(4)]
    df = spark.createDataFrame(rows, "r long, c long, pop_2030 float, pop_2040 float")
    st = {x["year"]: x for x in grid_stats_center(df, grid, [2030, 2040]).collect()}
    assert st[2030]["n_valid"] == 0 and st[2030]["mean"] is None and st[2030]["n_total"] == 16
    assert st[2040]["n_valid"] == 12 and st[2040]["min"] == st[2040]["max"] == 2.0


H3_ID = 617700169958293503  # a real H3 id (resolution 9)


def test_foreign_ids_fail(spark):
    df = spark.createDataFrame([(H3_ID, 1.0)], "h3_index long, pop_2025 float")
    frames = [
        A.with_cell_attributes(df).select("lat"),
        A.with_cell_attributes(df).select("lng"),
        A.with_cell_attributes(df).select("area_km2"),
        A.with_cell_attributes(df, 5).select("area_km2"),
        df.select(cells.cell_res("h3_index")),
        df.select(cells.cell_boundary("h3_index")),
        A.where_bbox(df, -90, 90, -180, 180),
        A.where_bbox(df, 0, 1, 0, 1, res=5),
        A.continent_totals(df, ["pop_2025"]),
        A.extent_stats(df.selectExpr("9 AS h3_res", "*")),
    ]
    for f in frames:
        with pytest.raises(Exception, match="not an id of this cell system"):
            f.collect()
    assert df.select(cells.cell_to_string("h3_index")).first()[0] == "8928308280fffff"
    null = spark.createDataFrame([(None, 1.0)], "h3_index long, pop_2025 float")
    assert list(A.with_cell_attributes(null).select("lat", "lng", "area_km2").first()) == [None, None, None]


def test_foreign_ids_fail_in_sql(spark):
    from tessera.functions.sql import register_sql_functions

    register_sql_functions(spark)
    for f in ("cell_to_lat", "cell_to_lng", "cell_area", "cell_resolution", "cell_boundary"):
        with pytest.raises(Exception, match="not an id of this cell system"):
            spark.sql(f"SELECT {f}(CAST({H3_ID} AS BIGINT))").collect()
