"""Geometry as WKB, built by Column expressions.

Spark 4.1 keeps its geometry type behind a flag and cannot write it to
Parquet, so points and polygons are stored as ISO WKB in a BINARY column (little
endian, x = longitude, y = latitude, EPSG:4326 by convention).

No built-in exposes the IEEE-754 bits of a double, so they are computed: the exponent from
``log2``, put right where that rounds across a power of two, and the significand as an
exact quotient. All steps are exact in double arithmetic (scalings by powers of two), so
the bytes equal the stored double's, signed zeros, subnormals, infinities and NaN included.
Lambda variables hold what is read several times; no Python worker takes part.

Rings of cells are cut in the projected plane: at the meridian of 180 degrees and at the poles an
edge ends where it meets the line, it is not bent to it.
"""

from __future__ import annotations

import math
import struct

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cells

# --- fixed values of the format ------------------------------------------------------------
POINT, POLYGON = 1, 3
EXPONENT_BIAS, FRACTION_BITS = 1023, 52
LEAST_EXPONENT = -1022  # of a normal number
INFINITY_BITS, NAN_BITS = 0x7FF0000000000000, 0x7FF8000000000000
# ---------------------------------------------------------------------------------------------


def _let(value: Column, body) -> Column:
    """``body`` of a lambda variable that holds ``value``, computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _two_to(e: Column) -> Column:
    return F.pow(F.lit(2.0), e.cast("double"))


def _magnitude_bits(a: Column) -> Column:
    """Bits of a finite positive double."""
    least = F.pow(F.lit(2.0), F.lit(float((EXPONENT_BIAS + FRACTION_BITS - 1) // 2)))  # squared: one over the least subnormal
    subnormal = ((a * least) * least).cast("long")

    def encoded(e: Column) -> Column:
        fraction = ((a / _two_to(e) - 1.0) * float(1 << FRACTION_BITS)).cast("long")
        return F.when(e < LEAST_EXPONENT, subnormal).otherwise(F.shiftleft((e + EXPONENT_BIAS).cast("long"), FRACTION_BITS) + fraction)

    near = F.floor(F.log2(a)).cast("int")
    put_right = lambda g: g + F.when(a >= _two_to(g + 1), 1).when(a < _two_to(g), -1).otherwise(0)
    return _let(near, lambda g: _let(put_right(g), encoded))


def double_bits(c: Column) -> Column:
    """BIGINT of the IEEE-754 bits of a DOUBLE; NaN is the quiet one. NULL stays NULL."""

    def bits(x: Column) -> Column:
        size = lambda a: F.when(a == 0.0, F.lit(0).cast("long")).when(a == float("inf"), F.lit(INFINITY_BITS)).otherwise(_magnitude_bits(a))
        negative = (x < 0.0) | (x.cast("string") == "-0.0")
        sign = F.when(negative, F.lit(-(1 << 63))).otherwise(F.lit(0).cast("long"))
        return F.when(F.isnan(x), F.lit(NAN_BITS)).when(x.isNotNull(), _let(F.abs(x), size).bitwiseOR(sign))

    return _let(c.cast("double"), bits)


def little_endian(c: Column) -> Column:
    """Sixteen hexadecimal digits of a DOUBLE, least byte first."""
    digits = F.lpad(F.hex(double_bits(c)), 16, "0")
    return _let(digits, lambda h: F.concat(*[F.substr(h, F.lit(i), F.lit(2)) for i in range(15, 0, -2)]))


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def point_wkb(lon, lat) -> Column:
    """WKB POINT(lon lat); NULL when either coordinate is NULL."""
    return F.unhex(F.concat(F.lit(f"01{POINT:02X}000000"), little_endian(_column(lon)), little_endian(_column(lat))))


def polygon_wkb(ring: Column) -> Column:
    """WKB POLYGON of one ring ``ARRAY<STRUCT<lng, lat>>`` (3 to 254 corners, not closed); closed here. NULL for NULL or a null corner."""

    def encoded(r: Column) -> Column:
        closed = F.concat(r, F.slice(r, 1, 1))
        corners = F.transform(closed, lambda p: F.concat(little_endian(p["lng"]), little_endian(p["lat"])))
        whole = F.forall(r, lambda p: p["lng"].isNotNull() & p["lat"].isNotNull())
        count = F.lpad(F.hex(F.size(closed)), 2, "0")
        head = F.lit(f"01{POLYGON:02X}000000" + "01000000")  # one ring
        return F.when(whole, F.unhex(F.concat(head, count, F.lit("000000"), F.array_join(corners, ""))))

    return F.when(ring.isNotNull(), _let(ring, encoded))


# --- rings of cells -----------------------------------------------------------------------


def _cut(ring: Column, axis: str, other: str, bound: float, below: bool) -> Column:
    """The part of a convex ring where ``axis`` is at most (``below``) or at least ``bound``."""
    keeps = (lambda p: p[axis] <= bound) if below else (lambda p: p[axis] >= bound)

    def crossing(p: Column, q: Column) -> Column:
        along = (F.lit(bound) - p[axis]) / (q[axis] - p[axis])
        at = {axis: F.lit(bound), other: p[other] + (q[other] - p[other]) * along}
        return F.struct(at["x"].alias("x"), at["y"].alias("y"))

    def edge(i: Column) -> Column:
        pair = F.struct(F.element_at(ring, i + 1).alias("p"), F.element_at(ring, (i + 1) % F.size(ring) + 1).alias("q"))

        def parts(e: Column) -> Column:
            p, q = e["p"], e["q"]
            own = F.when(keeps(p), F.array(p))
            met = F.when(keeps(p) != keeps(q), F.array(crossing(p, q)))
            empty = F.slice(F.array(p), 1, 0)
            return F.concat(F.coalesce(own, empty), F.coalesce(met, empty))

        return _let(pair, parts)

    cut = F.flatten(F.transform(F.sequence(F.lit(0), F.size(ring) - 1), edge))
    return F.when(F.forall(ring, keeps), ring).otherwise(F.when(F.exists(ring, keeps), cut))


def _cutter(*line):
    return lambda ring: _cut(ring, *line)


def cell_ring(cell: str, res: int | None = None) -> Column:
    """Corners of a cell ``ARRAY<STRUCT<lng DOUBLE, lat DOUBLE>>``, counter-clockwise, cut at 180 degrees and at the
    poles. NULL for a cell of which nothing lies on the map."""
    r = cells.cell_res(cell) if res is None else F.lit(int(res))
    constants = cells.resolution_geometry()
    x, y = cells.centre_x(cell, res), cells.centre_y(cell, res)
    east, north = math.pi * cells.EARTH_RADIUS_KM, cells.EARTH_RADIUS_KM

    def corners(k: Column) -> Column:
        at = lambda i: F.struct((k["x"] + k["vx"][i]).alias("x"), (k["y"] + k["vy"][i]).alias("y"))
        return F.array(*[at(i) for i in range(6)])

    known = F.struct(x.alias("x"), y.alias("y"), F.element_at(constants, r + 1)["vx"].alias("vx"), F.element_at(constants, r + 1)["vy"].alias("vy"))
    ring = _let(known, corners)
    for axis, other, bound, below in (("x", "y", east, True), ("x", "y", -east, False), ("y", "x", north, True), ("y", "x", -north, False)):
        ring = _let(ring, _cutter(axis, other, bound, below))
    degrees = lambda p: F.struct(
        (p["x"] / cells.EARTH_RADIUS_KM * cells.RAD2DEG).alias("lng"),
        (F.asin(F.least(F.greatest(p["y"] / cells.EARTH_RADIUS_KM, F.lit(-1.0)), F.lit(1.0))) * cells.RAD2DEG).alias("lat"),
    )
    return F.when(F.col(cell).isNotNull(), F.transform(ring, degrees))


def double_of_bits(c: Column) -> Column:
    """The DOUBLE whose IEEE-754 bits a BIGINT holds."""

    def value(b: Column) -> Column:
        exponent = F.shiftright(b, FRACTION_BITS).bitwiseAND(F.lit(2047)).cast("int")
        fraction = b.bitwiseAND(F.lit((1 << FRACTION_BITS) - 1)).cast("double")
        subnormal = fraction / float(1 << FRACTION_BITS) * F.pow(F.lit(2.0), F.lit(float(LEAST_EXPONENT)))
        special = F.when(fraction == 0.0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
        normal = (fraction / float(1 << FRACTION_BITS) + 1.0) * _two_to(exponent - EXPONENT_BIAS)
        size = F.when(exponent == 0, subnormal).when(exponent == 2047, special).otherwise(normal)
        return F.when(b < 0, -size).otherwise(size)

    return _let(c, value)


def point_lonlat(wkb: str) -> Column:
    """``STRUCT<lon DOUBLE, lat DOUBLE>`` of a little-endian WKB point; anything else fails. NULL stays NULL."""

    def number(h: Column, at: int) -> Column:
        digits = F.concat(*[F.substr(h, F.lit(at + 2 * i), F.lit(2)) for i in range(7, -1, -1)])
        return double_of_bits(F.conv(digits, 16, -10).cast("long"))

    def decoded(h: Column) -> Column:
        point = F.struct(number(h, 11).alias("lon"), number(h, 27).alias("lat"))
        fits = h.startswith(f"01{POINT:02X}000000") & (F.length(h) == 42)
        return F.when(fits, point).when(h.isNotNull(), F.raise_error(F.lit("not a little-endian WKB point")))

    return _let(F.hex(_column(wkb)), decoded)


# --- decoding (tests and tools) -------------------------------------------------------------


def wkb_to_lonlat(b: bytes) -> tuple[float, float]:
    """Decode one WKB point."""
    if b[:5] != struct.pack("<BI", 1, POINT):
        raise ValueError("not a little-endian WKB point")
    return struct.unpack("<dd", b[5:21])


def wkb_to_ring(b: bytes) -> list[tuple[float, float]]:
    """Decode a WKB polygon of one ring, the closing corner included."""
    if b[:9] != struct.pack("<BII", 1, POLYGON, 1):
        raise ValueError("not a little-endian WKB polygon of one ring")
    n = struct.unpack("<I", b[9:13])[0]
    if len(b) != 13 + 16 * n:
        raise ValueError("the polygon's length doesn't fit its corners")
    return [struct.unpack("<dd", b[13 + 16 * i : 29 + 16 * i]) for i in range(n)]
