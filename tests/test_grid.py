"""Grid layer: windows, pixel centres, year stacking, tile tables."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.mask import apply_mask
from tessera.sources.fixture import FIXTURE_GRID, pixel_view
from tessera.sources.grid import (
    GridSpec,
    pixels_to_tiles,
    stack_years,
    tiles_to_pixels,
    unstack_years,
    window_lattice,
    window_of,
)

from .conftest import SF_SMALL

YEARS = [2025, 2050, 2100]
POP = [f"pop_{y}" for y in YEARS]


def test_lattice(spark):
    lat = window_lattice(spark)
    assert lat.count() == 2592
    first = lat.orderBy("west", "south").first()
    assert first["win_id"] == "w_-00180.0_-0090.0" and first["east"] == -175.0
    assert lat.select("win_id").distinct().count() == 2592


def test_window_of_edges(spark):
    df = spark.createDataFrame([(45.0, -5.0), (90.0, 180.0), (-90.0, -180.0), (2.5, 2.5)], "lat double, lon double")
    ids = [r[0] for r in df.select(window_of("lat", "lon")[0]).collect()]
    assert ids == ["w_-00005.0_+0045.0", "w_+00175.0_+0085.0", "w_-00180.0_-0090.0", "w_+00000.0_+0000.0"]


def test_stack_fills_nodata_and_rejects_duplicates(spark):
    long = spark.createDataFrame([(1, 2025, 5.0), (1, 2100, 7.0), (2, 2050, 1.0)], "pid int, year int, value float")
    wide = {r["pid"]: r for r in stack_years(long, ["pid"], YEARS, -99999.0).collect()}
    assert wide[1]["pop_2050"] == -99999.0 and wide[1]["pop_2100"] == 7.0
    assert apply_mask(stack_years(long, ["pid"], YEARS, -99999.0), POP, -99999.0).count() == 0
    with pytest.raises(ValueError):
        stack_years(long, ["pid"], [2025, 2025], -99999.0)


def test_unstack_stack_roundtrip(spark):
    px = pixel_view(spark, SF_SMALL)
    back = stack_years(unstack_years(px, ["pixel_id"], YEARS), ["pixel_id"], YEARS, -99999.0)
    a = px.select("pixel_id", *POP)
    # NaN == NaN in Spark's exceptAll, so the round trip is exact
    assert a.exceptAll(back).count() == 0 and back.exceptAll(a).count() == 0


def test_tiles_roundtrip_and_window_filter(spark):
    px = pixel_view(spark, SF_SMALL)
    long = unstack_years(px, ["r", "c"], YEARS)
    tiles = pixels_to_tiles(long, 16, -99999.0)
    t = tiles.first()
    assert len(t["values"]) == 16 and all(len(row) == 16 for row in t["values"])
    back = tiles_to_pixels(tiles, FIXTURE_GRID, 16)
    wide = apply_mask(stack_years(back, ["r", "c", "lat", "lon"], YEARS, -99999.0), POP, -99999.0)
    exp = apply_mask(px, POP, -99999.0).select("r", "c", "lat", "lon", *POP)
    assert wide.exceptAll(exp).count() == 0 and exp.exceptAll(wide).count() == 0
    # a pixel window read: only the requested rows/cols come back, tile filter pushed first
    win = tiles_to_pixels(tiles, FIXTURE_GRID, 16, row_range=(100, 199), col_range=(0, 40))
    agg = win.agg(F.min("r"), F.max("r"), F.min("c"), F.max("c")).collect()[0]
    assert agg[0] >= 100 and agg[1] <= 199 and agg[2] >= 0 and agg[3] <= 40


def test_grid_checks():
    with pytest.raises(ValueError):
        GridSpec(0, 0, 1, 1, 1, 1, crs="EPSG:3857").check_geographic()
    with pytest.raises(ValueError):
        GridSpec(0, 0, 1, 1, 1, 1, nodata=0.1).nodata_float32()
    assert GridSpec(0, 0, 1, 1, 1, 1, nodata=-99999.0).nodata_float32() == -99999.0


def test_tiles_to_wide_pixels(spark):
    from tessera.sources.grid import tiles_to_wide_pixels

    px = pixel_view(spark, SF_SMALL)
    tiles = pixels_to_tiles(unstack_years(px, ["r", "c"], YEARS), 16, -99999.0)
    wide = tiles_to_wide_pixels(tiles, FIXTURE_GRID, 16, YEARS)
    got = apply_mask(wide, POP, -99999.0)
    exp = apply_mask(px, POP, -99999.0).select("r", "c", "lat", "lon", *POP)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    # a tile with no 2050 raster: that year reads as nodata, so its pixels are masked out
    no2050 = tiles.where("NOT (year = 2050 AND tile_row = 0)")
    w2 = tiles_to_wide_pixels(no2050, FIXTURE_GRID, 16, YEARS).where("r < 16")
    assert w2.where("pop_2050 != -99999.0").count() == 0
    assert apply_mask(w2, POP, -99999.0).count() == 0
    win = tiles_to_wide_pixels(tiles, FIXTURE_GRID, 16, YEARS, row_range=(20, 40), col_range=(3, 9))
    assert win.count() == 21 * 7


def _long(spark, rows):
    return spark.createDataFrame(rows, "r long, c long, year int, value float")


def test_tiles_reject_what_they_cannot_hold(spark):
    ok = [(r, c, 2025, 2.0) for r in range(20) for c in range(30)]
    assert pixels_to_tiles(_long(spark, ok), 16, -99999.0).count() == 4
    with pytest.raises(Exception, match="came twice"):  # values 1 and 9 for one pixel
        pixels_to_tiles(_long(spark, [*ok, (0, 0, 2025, 9.0)]), 16, -99999.0).collect()
    with pytest.raises(Exception, match="came twice"):
        pixels_to_tiles(_long(spark, [(15, 15, 2025, 1.0)] * 300), 16, -99999.0).collect()
    for bad in ((-1, 3, 2025, 1.0), (3, -1, 2025, 1.0), (None, 3, 2025, 1.0)):
        with pytest.raises(Exception, match="outside the grid"):
            pixels_to_tiles(_long(spark, [*ok, bad]), 16, -99999.0).collect()


def test_tile_side_is_checked(spark):
    from dataclasses import replace

    from tessera.sources.grid import tiles_to_wide_pixels

    tiles = pixels_to_tiles(unstack_years(pixel_view(spark, SF_SMALL), ["r", "c"], YEARS), 32, -99999.0)
    for read in (lambda g, t: tiles_to_pixels(tiles, g, t), lambda g, t: tiles_to_wide_pixels(tiles, g, t, YEARS)):
        with pytest.raises(Exception, match="not 1000 x 1000"):
            read(FIXTURE_GRID, 1000).count()
        with pytest.raises(ValueError, match="differs"):
            read(replace(FIXTURE_GRID, tile=32), 16)
        with pytest.raises(ValueError, match="neither"):
            read(FIXTURE_GRID, None)
    n = tiles_to_pixels(tiles, replace(FIXTURE_GRID, tile=32)).where("value != -99999.0").count()
    assert n == unstack_years(pixel_view(spark, SF_SMALL), ["r", "c"], YEARS).where("value != -99999.0").count()
    broken = tiles.withColumn("values", F.when(F.col("year") == 2050, None).otherwise(F.col("values")))
    with pytest.raises(Exception, match="block is missing"):
        tiles_to_pixels(broken, FIXTURE_GRID, 32).collect()
    with pytest.raises(Exception, match="came twice for one tile"):
        tiles_to_wide_pixels(tiles.union(tiles.limit(1)), FIXTURE_GRID, 32, YEARS).collect()


def test_stack_rejects_a_second_value(spark):
    twice = spark.createDataFrame([(1, 2025, 1.0), (1, 2025, 2.0)], "pid int, year int, value float")
    with pytest.raises(Exception, match="came twice for one pixel"):
        stack_years(twice, ["pid"], YEARS, -99999.0).collect()


@pytest.mark.parametrize("nodata", [float("nan"), float("inf"), float("-inf"), None])
def test_unusual_nodata(spark, nodata):
    from tessera.sources.grid import tiles_to_wide_pixels

    rows = [(0, 0, 2025, 5.0), (0, 0, 2050, 6.0), (0, 1, 2025, 7.0), (3, 3, 2025, float("nan")), (3, 3, 2050, 1.0)]
    grid = GridSpec(-180.0, 90.0, 1.0, 1.0, 4, 4, nodata=nodata, tile=2)
    wide = tiles_to_wide_pixels(pixels_to_tiles(_long(spark, rows), 2, nodata), grid, None, [2025, 2050])
    kept = apply_mask(wide, ["pop_2025", "pop_2050"], grid.nodata_float32()).collect()
    assert [(x["r"], x["c"], x["pop_2025"], x["pop_2050"]) for x in kept] == [(0, 0, 5.0, 6.0)]
    stacked = apply_mask(stack_years(_long(spark, rows), ["r", "c"], [2025, 2050], nodata), ["pop_2025", "pop_2050"], nodata)
    assert [(x["r"], x["c"]) for x in stacked.collect()] == [(0, 0)]


def test_geographic_crs():
    wkt = 'GEOGCS["WGS 84",DATUM["WGS_1984"]]'
    for crs in ("EPSG:4326", "epsg:4269", "OGC:CRS84", "urn:ogc:def:crs:EPSG::4326", wkt, "+proj=longlat +datum=WGS84"):
        GridSpec(0, 0, 1, 1, 1, 1, crs=crs).check_geographic()
    for crs, why in (('PROJCS["UTM"]', "projected"), ("+proj=utm +zone=33", "projected"), ("EPSG:3857", "not known"), ('GEOCCS["x"]', "geocentric")):
        with pytest.raises(ValueError, match=why):
            GridSpec(0, 0, 1, 1, 1, 1, crs=crs).check_geographic()
