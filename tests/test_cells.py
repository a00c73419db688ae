"""Cell system: ids against a NumPy brute force, inverse, area, text, boundary, WKB."""

import math

import numpy as np
from pyspark.sql import functions as F

from tessera.functions import cells
from tessera.functions.geometry import point_wkb, wkb_to_lonlat


def np_cell(lat, lon, res):
    k = cells.res_constants(res)
    x = (lon * cells.DEG2RAD) * cells.EARTH_RADIUS_KM
    y = np.sin(lat * cells.DEG2RAD) * cells.EARTH_RADIUS_KM
    qf = x * k.kq_x - y * k.kq_y
    rf = y * k.kr_y
    sf = -qf - rf
    qi, ri, si = np.floor(qf + 0.5), np.floor(rf + 0.5), np.floor(sf + 0.5)
    dq, dr, ds = np.abs(qi - qf), np.abs(ri - rf), np.abs(si - sf)
    worst_q = (dq > dr) & (dq > ds)
    q = np.where(worst_q, -ri - si, qi)
    r = np.where(worst_q, ri, np.where(dr > ds, -qi - si, ri))
    return k.base + (q.astype(np.int64) + cells.AXIS_OFFSET) * (1 << cells.Q_SHIFT) + (
        r.astype(np.int64) + cells.AXIS_OFFSET
    )


def _points(spark, n=4000, seed=7):
    rng = np.random.default_rng(seed)
    lat = rng.uniform(-89.9, 89.9, n)
    lon = rng.uniform(-179.9, 179.9, n)
    return lat, lon, spark.createDataFrame([(float(a), float(b)) for a, b in zip(lat, lon)], "lat double, lon double")


def test_ids_match_numpy(spark):
    lat, lon, df = _points(spark)
    for res in (0, 1, 5, 8, 12, 15):
        got = np.array([r[0] for r in df.select(cells.cell_of("lat", "lon", res)).collect()], dtype=np.int64)
        exp = np_cell(lat, lon, res)
        assert (got == exp).mean() > 0.999, res
        assert (got > 0).all()


def test_by_constants_equals_literal_form(spark):
    _, _, df = _points(spark, 1000)
    xy = df.select(cells.project_x("lon").alias("x"), cells.project_y("lat").alias("y"))
    fan = xy.select("x", "y", F.inline(cells.resolution_constants([2, 7])))
    a = fan.select(
        "h3_res",
        cells.cell_of_xy_by_constants("x", "y", "kq_x", "kq_y", "kr_y", "base").alias("a"),
        F.when(F.col("h3_res") == 2, cells.cell_of_xy("x", "y", 2)).otherwise(cells.cell_of_xy("x", "y", 7)).alias("b"),
    )
    assert a.where("a != b").count() == 0


def test_decode_and_centre_roundtrip(spark):
    _, _, df = _points(spark, 2000)
    for res in (1, 4, 8):
        c = df.select(cells.cell_of("lat", "lon", res).alias("id"))
        centres = c.select("id", cells.cell_lat("id").alias("clat"), cells.cell_lng("id").alias("clng"))
        back = centres.select(
            "id",
            cells.cell_res("id").alias("res"),
            cells.is_valid_cell("id").alias("ok"),
            cells.cell_of("clat", "clng", res).alias("id2"),
        ).collect()  # compared here: a pushed-down filter would inline the whole chain
        assert all(r["res"] == res and r["ok"] for r in back)
        # centre -> id gives the same cell (clamped border cells excepted)
        assert sum(r["id"] != r["id2"] for r in back) <= 0.02 * 2000


def test_centre_close_to_point(spark):
    _, _, df = _points(spark, 2000)
    res = 6
    k = cells.res_constants(res)
    c = df.select(
        cells.project_x("lon").alias("x"),
        cells.project_y("lat").alias("y"),
        cells.cell_of("lat", "lon", res).alias("id"),
    ).select(
        F.sqrt(
            F.pow(F.col("x") - cells.centre_x("id", res), 2) + F.pow(F.col("y") - cells.centre_y("id", res), 2)
        ).alias("d")
    )
    # a point is never farther from its hexagon centre than the circumradius (= edge)
    assert c.agg(F.max("d")).collect()[0][0] <= k.edge_km * (1 + 1e-9)


def test_area_ladder():
    total = 4 * math.pi * cells.EARTH_RADIUS_KM**2
    for res in range(16):
        k = cells.res_constants(res)
        assert math.isclose(k.area_km2 * k.n_cells, total, rel_tol=1e-12)
        assert math.isclose(3 * math.sqrt(3) / 2 * k.edge_km**2, k.area_km2, rel_tol=1e-12)
    assert cells.res_constants(0).n_cells == 122


def test_hex_text_roundtrip(spark):
    df = spark.createDataFrame([(617700169958293503,), (cells.res_constants(5).base + 12345,)], "id bigint")
    out = df.select(cells.cell_to_string("id").alias("s")).select("s", cells.string_to_cell("s").alias("back"))
    rows = out.collect()
    assert rows[0]["s"] == "8928308280fffff" and rows[0]["back"] == 617700169958293503
    assert rows[1]["back"] == cells.res_constants(5).base + 12345


def test_boundary_vertices(spark):
    df = spark.createDataFrame([(10.0, 20.0), (-45.0, 100.0)], "lat double, lon double")
    res = 4
    b = df.select(cells.cell_of("lat", "lon", res).alias("id")).select(
        "id", F.posexplode(cells.cell_boundary("id", res)).alias("i", "p")
    )
    assert b.count() == 12
    # vertices surround the centre: centre lat lies within the vertex lat range
    chk = b.groupBy("id").agg(F.min("p.lat").alias("lo"), F.max("p.lat").alias("hi")).select(
        "lo", "hi", cells.cell_lat("id", res).alias("c")
    )
    for r in chk.collect():
        assert r["lo"] < r["c"] < r["hi"]


def test_wkb_point(spark):
    df = spark.createDataFrame([(1.5, -2.25), (None, 3.0)], "lon double, lat double")
    rows = df.select(point_wkb("lon", "lat").alias("g")).collect()
    assert len(rows[0]["g"]) == 21
    assert wkb_to_lonlat(bytes(rows[0]["g"])) == (1.5, -2.25)
    assert rows[1]["g"] is None


def test_bad_resolution():
    import pytest

    with pytest.raises(ValueError):
        cells.res_constants(16)
    with pytest.raises(ValueError):
        cells.check_res(True)
