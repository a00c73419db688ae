"""A space-filling curve over cells (F9, O1, A3): places that are near on the map lie near on the curve.

Ids sort by (resolution, column, row) of an oblique axis, so a box of the map is a stripe of ids as long as the map is high.
Here a cell gets a place of its own on the Z-order (Morton) curve of its resolution: the bits of
its offset column ``q + floor(r / 2)`` and its row ``r`` alternate. Both are whole numbers without gaps and follow
longitude and latitude, so a box is a rectangle of them, and a rectangle is a few ranges of the curve; 32,768 places in a
row are a block of 256 by 128 cells.

Places fit 55 bits, so they are positive BIGINTs, unique within a resolution.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import cells

# --- fixed values of the curve ---------------------------------------------------------------
COLUMN_BITS = 28  # of the offset column, stored as col + 2**27
COLUMN_OFFSET = 1 << 27
SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]
# ---------------------------------------------------------------------------------------------


def _spread(v: Column) -> Column:
    """Bits of a number below 2^32 moved to the even places."""
    for shift, keep in SPREAD:
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(keep))
    return v


def curve(cell: str) -> Column:
    """The cell's place on its resolution's curve. NULL stays NULL."""
    q, r = cells.cell_q(cell), cells.cell_r(cell)
    col = (q + F.shiftright(r, 1) + COLUMN_OFFSET).cast("long")
    row = (r + cells.AXIS_OFFSET).cast("long")
    return _spread(col).bitwiseOR(F.shiftleft(_spread(row), 1))


def place(col: int, row: int) -> int:
    """The same of stored column and row numbers, in Python."""
    return sum(((col >> i) & 1) << (2 * i) | ((row >> i) & 1) << (2 * i + 1) for i in range(COLUMN_BITS))


def rectangle(res: int, lat_min: float, lat_max: float, lng_min: float, lng_max: float) -> tuple[int, int, int, int]:
    """Stored (first column, last column, first row, last row) of cells whose centre can lie in a box, a little wide.

    Sides at a pole or at 180 degrees stay open: centres beyond are clamped to them.
    """
    k, km = cells.res_constants(res), cells.EARTH_RADIUS_KM
    y = [km * math.sin(math.radians(v)) for v in (max(lat_min, -90.0), min(lat_max, 90.0))]
    x = [km * math.radians(v) for v in (lng_min, lng_max)]
    rows = (math.floor(y[0] / k.cy) - 1 if lat_min > -90.0 else -cells.AXIS_OFFSET, math.ceil(y[1] / k.cy) + 1 if lat_max < 90.0 else cells.AXIS_OFFSET - 1)
    cols = (math.floor(x[0] / k.cx) - 2 if lng_min > -180.0 else -COLUMN_OFFSET, math.ceil(x[1] / k.cx) + 2 if lng_max < 180.0 else COLUMN_OFFSET - 1)
    inside = lambda v, low, high: min(max(v, low), high)
    return (
        *(inside(c, -COLUMN_OFFSET, COLUMN_OFFSET - 1) + COLUMN_OFFSET for c in cols),
        *(inside(r, -cells.AXIS_OFFSET, cells.AXIS_OFFSET - 1) + cells.AXIS_OFFSET for r in rows),
    )


def ranges(c0: int, c1: int, r0: int, r1: int, most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of the curve that together hold a rectangle of columns and rows (inclusive).

    Squares that reach over the rectangle's edge are quartered, the largest first, while the number allows; what is
    left of them is taken whole, so the ranges may hold more than the rectangle, never less.
    """
    if c0 > c1 or r0 > r1:
        return []

    def meets(col, row, size):
        return col <= c1 and col + size > c0 and row <= r1 and row + size > r0

    def within(col, row, size):
        return c0 <= col and col + size - 1 <= c1 and r0 <= row and row + size - 1 <= r1

    whole, edge = [], [(1 << COLUMN_BITS, 0, 0)]
    while edge:
        edge.sort()
        if len(whole) + len(edge) + 3 > 4 * most or edge[-1][0] == 1:
            break
        size, col, row = edge.pop()
        half = size // 2
        for a, b in ((col, row), (col + half, row), (col, row + half), (col + half, row + half)):
            if within(a, b, half):
                whole.append((half, a, b))
            elif meets(a, b, half):
                edge.append((half, a, b))
    spans = sorted((place(c, r), place(c, r) + size * size - 1) for size, c, r in whole + edge)
    out = [list(spans[0])] if spans else []
    for low, high in spans[1:]:
        if low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    while len(out) > most:  # close the narrowest gaps
        i = min(range(len(out) - 1), key=lambda i: out[i + 1][0] - out[i][1])
        out[i : i + 2] = [[out[i][0], out[i + 1][1]]]
    return [tuple(x) for x in out]
