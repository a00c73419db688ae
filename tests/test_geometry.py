"""WKB from Column expressions: bytes against struct, rings against plain clipping."""

import math
import random
import struct

from pyspark.sql import functions as F

from tessera.functions import cells
from tessera.functions import geometry as G
from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.sinks.parquet import write_legacy_index
from tessera.sources.fixture import pixel_view
from tessera.sources.index_reader import read_index

from .conftest import SF_SMALL


def _doubles():
    r = random.Random(6)
    out = [0.0, -0.0, 1.0, -1.0, 0.1, -180.0, 180.0, 90.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 2.2250738585072014e-308]
    out += [2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308, 4503599627370496.5, 9007199254740993.0, 2.0**63]
    for e in (-1074, -1073, -1060, -1023, -1022, -1021, -537, -53, -1, 0, 1, 52, 53, 63, 64, 1022, 1023):
        p = 2.0**e
        out += [p, math.nextafter(p, 0.0), math.nextafter(p, math.inf), -p]
    out += [struct.unpack("<d", r.randbytes(8))[0] for _ in range(3000)]
    return [x for x in out if not math.isnan(x)] + [math.nan]


def _bits(x):
    return 0x7FF8000000000000 if math.isnan(x) else struct.unpack("<q", struct.pack("<d", x))[0]


def test_bits_of_every_kind_of_double(spark):
    xs = _doubles()
    df = spark.createDataFrame(list(enumerate(xs)) + [(-1, None)], "i int, x double")
    df = df.select("i", "x", G.double_bits(F.col("x")).alias("b"), G.little_endian(F.col("x")).alias("h"))
    for r in df.withColumn("back", G.double_of_bits(F.col("b"))).collect():
        if r.i < 0:
            assert r.b is None and r.h is None and r.back is None
            continue
        x = xs[r.i]
        assert r.b == _bits(x), x
        assert bytes.fromhex(r.h) == struct.pack("<q", _bits(x))
        assert _bits(r.back) == _bits(x)


def test_point_round_trip_and_nulls(spark):
    rows = [(1, -73.935, 40.73), (2, 0.0, -0.0), (3, None, 1.0), (4, 1.0, None), (5, -180.0, 90.0)]
    df = spark.createDataFrame(rows, "i int, lon double, lat double").select("*", G.point_wkb("lon", "lat").alias("g"))
    for r in df.withColumn("p", G.point_lonlat("g")).collect():
        if r.lon is None or r.lat is None:
            assert r.g is None and r.p is None
        else:
            assert bytes(r.g) == struct.pack("<BIdd", 1, 1, r.lon, r.lat) and tuple(r.p) == (r.lon, r.lat) == G.wkb_to_lonlat(bytes(r.g))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_point_of_other_bytes_fails(spark):
    import pytest

    df = spark.createDataFrame([(bytearray(b"\x00" * 21),)], "g binary")
    with pytest.raises(Exception, match="not a little-endian"):
        df.select(G.point_lonlat("g")).collect()


def plain_ring(cell):
    """Corners cut at the map's border, in the plane."""
    res = (cell >> cells.RES_SHIFT) & 15
    k = cells.res_constants(res)
    q = ((cell >> cells.Q_SHIFT) & cells.AXIS_MASK) - cells.AXIS_OFFSET
    r = (cell & cells.AXIS_MASK) - cells.AXIS_OFFSET
    ring = [((q + r / 2) * k.cx + a, r * k.cy + b) for a, b in zip(k.vx, k.vy, strict=True)]
    km = cells.EARTH_RADIUS_KM
    for axis, bound, sign in ((0, math.pi * km, 1), (0, -math.pi * km, -1), (1, km, 1), (1, -km, -1)):
        out = []
        for p, n in zip(ring, ring[1:] + ring[:1], strict=True):
            if sign * p[axis] <= sign * bound:
                out.append(p)
            if (sign * p[axis] <= sign * bound) != (sign * n[axis] <= sign * bound):
                t = (bound - p[axis]) / (n[axis] - p[axis])
                at = [p[i] + (n[i] - p[i]) * t for i in (0, 1)]
                at[axis] = bound
                out.append(tuple(at))
        ring = out
    return [(math.degrees(x / km), math.degrees(math.asin(max(-1.0, min(1.0, y / km))))) for x, y in ring]


def test_rings_against_plain_clipping(spark):
    points = [(lat, lon) for lat in (-89.9, -75.0, -10.0, 0.0, 33.3, 80.0, 89.99) for lon in (-179.99, -179.0, -60.0, 0.0, 12.5, 178.9, 179.999)]
    df = spark.createDataFrame(points, "lat double, lon double")
    ids = df.select(F.explode(F.array(*[cells.cell_of("lat", "lon", r) for r in (0, 1, 2, 3, 6, 9)])).alias("cell")).distinct()
    rows = ids.select("cell", G.cell_ring("cell").alias("ring")).withColumn("wkb", G.polygon_wkb(F.col("ring"))).collect()
    cut = 0
    for r in rows:
        want = plain_ring(r.cell)
        got = [(p.lng, p.lat) for p in r.ring]
        assert len(got) == len(want)
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for g, w in zip(got, want, strict=True) for a, b in zip(g, w, strict=True))
        assert G.wkb_to_ring(bytes(r.wkb)) == got + got[:1]
        assert all(-180.0 <= x <= 180.0 and -90.0 <= y <= 90.0 for x, y in got)
        cut += len(got) != 6 or any(abs(x) == 180.0 for x, _ in got)
    assert cut > 10


def test_null_cells_and_rings(spark):
    df = spark.createDataFrame([(None,)], "cell bigint").select(G.cell_ring("cell").alias("r"))
    assert df.select(G.polygon_wkb(F.col("r"))).first()[0] is None


def test_geometry_of_the_legacy_layout_is_read_back(spark, tmp_dir):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [5], Q.NODATA)
    write_legacy_index(idx, tmp_dir, "SSP2")
    back = read_index(spark, tmp_dir, "SSP2", 5).withColumn("p", G.point_lonlat("geometry"))
    assert back.where("CAST(p.lon AS FLOAT) <> lon OR CAST(p.lat AS FLOAT) <> lat OR p IS NULL").isEmpty() and back.count() == idx.count()
