"""DuckDB SQL text for the correctness oracle.

Each registered query has an independent SQL formulation here, run by DuckDB
on the same Parquet tables. Nothing is imported from the engine: constants,
boxes and parameters are written here again, so a wrong one on either side
shows. The cell formulas keep the operation order of the Column expressions,
so both engines produce bit-identical ids.
"""

from __future__ import annotations

import math


class cells:  # noqa: N801
    """The cell system, stated again from its definition."""

    EARTH_RADIUS_KM = 6371.007180918475
    DEG2RAD, RAD2DEG = math.pi / 180.0, 180.0 / math.pi
    MIN_RES, MAX_RES = 0, 15
    RES_SHIFT, Q_SHIFT = 55, 27
    AXIS_OFFSET, AXIS_MASK = 67108864, 134217727

    @classmethod
    def res_constants(cls, res: int) -> "cells":
        k = cls()
        k.area_km2 = 4.0 * math.pi * cls.EARTH_RADIUS_KM * cls.EARTH_RADIUS_KM / (2 + 120 * 7**res)
        edge = math.sqrt(2.0 * k.area_km2 / (3.0 * math.sqrt(3.0)))
        k.kq_x, k.kq_y, k.kr_y = math.sqrt(3.0) / 3.0 / edge, 1.0 / 3.0 / edge, 2.0 / 3.0 / edge
        k.cx, k.cy = math.sqrt(3.0) * edge, 1.5 * edge
        corners = [math.radians(60.0 * i - 30.0) for i in range(6)]
        k.vx, k.vy = [edge * math.cos(t) for t in corners], [edge * math.sin(t) for t in corners]
        k.base = 7 * 2**59 + res * 2**55
        return k



POP = ["pop_2025", "pop_2050", "pop_2100"]

# The fixture view, word for word the same in both engines.
PIXEL_VIEW = """SELECT o_orderkey AS pixel_id, r, c,
 CAST(90 AS DOUBLE) - (CAST(r AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST(0.25 AS DOUBLE) AS lat,
 CAST(-180 AS DOUBLE) + (CAST(c AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST(0.25 AS DOUBLE) AS lon,
 CAST(CASE WHEN o_orderkey % 97 = 0 THEN -99999 ELSE o_custkey % 500 END AS FLOAT) AS pop_2025,
 CASE WHEN o_orderkey % 89 = 0 THEN CAST('NaN' AS FLOAT)
      ELSE CAST((o_custkey + o_orderkey) % 400 AS FLOAT) END AS pop_2050,
 CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN -5
      ELSE o_custkey % 300 END AS FLOAT) AS pop_2100
FROM (SELECT o_orderkey, o_custkey, o_orderkey % 720 AS r,
 (CAST(floor(o_orderkey / CAST(720 AS DOUBLE)) AS BIGINT) * 89) % 1440 AS c FROM orders) o"""


SIX_YEARS = """SELECT pv.*, CAST(-99999 AS FLOAT) AS pop_2030,
 CAST(o_custkey % 9 AS FLOAT) * CAST(0.5 AS FLOAT) AS pop_2040,
 CASE WHEN pixel_id % 83 = 0 THEN CAST('Infinity' AS FLOAT) ELSE CAST(o_custkey % 50 AS FLOAT) END AS pop_2060
FROM (""" + PIXEL_VIEW + """) pv JOIN orders ON o_orderkey = pixel_id"""


def d(x: float) -> str:
    """An exact DOUBLE literal."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


NODATA = "CAST(-99999 AS FLOAT)"


def mask(cols=POP) -> str:
    ok = " AND ".join(f"({c} <> {NODATA} AND isfinite({c}))" for c in cols)
    pos = " OR ".join(f"{c} > 0" for c in cols)
    return f"({ok} AND ({pos}))"


VALID = f"SELECT * FROM ({PIXEL_VIEW}) pv WHERE {mask()}"


def with_xy(src: str) -> str:
    return (
        f"SELECT *, (lon * {d(cells.DEG2RAD)}) * {d(cells.EARTH_RADIUS_KM)} AS _x, "
        f"sin(lat * {d(cells.DEG2RAD)}) * {d(cells.EARTH_RADIUS_KM)} AS _y FROM ({src}) xy_src"
    )


def cells_at(src_xy: str, keep: list[str], res: int) -> str:
    """keep..., h3_res, h3_index for one resolution; ``src_xy`` has _x, _y."""
    k = cells.res_constants(res)
    ks = ", ".join(keep)
    return f"""SELECT {ks}, CAST({res} AS INTEGER) AS h3_res,
  CAST({k.base} AS BIGINT) + (CAST(cq AS BIGINT) + {cells.AXIS_OFFSET}) * {1 << cells.Q_SHIFT}
  + (CAST(cr AS BIGINT) + {cells.AXIS_OFFSET}) AS h3_index
FROM (SELECT *, CASE WHEN dq > dr AND dq > ds THEN -ri - si ELSE qi END AS cq,
             CASE WHEN dq > dr AND dq > ds THEN ri WHEN dr > ds THEN -qi - si ELSE ri END AS cr
 FROM (SELECT *, abs(qi - qf) AS dq, abs(ri - rf) AS dr, abs(si - sf) AS ds
  FROM (SELECT *, floor(qf + {d(0.5)}) AS qi, floor(rf + {d(0.5)}) AS ri, floor(sf + {d(0.5)}) AS si
   FROM (SELECT *, -qf - rf AS sf
    FROM (SELECT {ks}, _x * {d(k.kq_x)} - _y * {d(k.kq_y)} AS qf, _y * {d(k.kr_y)} AS rf
     FROM ({src_xy}) s0) s1) s2) s3) s4) s5"""


def assign(src: str, keep: list[str], resolutions) -> str:
    xy = with_xy(src)
    return "\nUNION ALL\n".join(cells_at(xy, keep, r) for r in resolutions)


def index(resolutions, cols=POP, src: str = VALID) -> str:
    sums = ", ".join(f"CAST(SUM(CAST({c} AS DOUBLE)) AS FLOAT) AS {c}" for c in cols)
    return (
        f"SELECT h3_res, h3_index, {sums} FROM ({assign(src, cols, resolutions)}) a "
        f"GROUP BY h3_res, h3_index"
    )


# --- cell attributes ----------------------------------------------------------------


def _per_res(res, attr: str, idx=None, id_col="h3_index") -> str:
    if isinstance(res, int):
        v = getattr(cells.res_constants(res), attr)
        return d(v if idx is None else v[idx])
    vals = []
    for r in range(cells.MIN_RES, cells.MAX_RES + 1):
        v = getattr(cells.res_constants(r), attr)
        vals.append(d(v if idx is None else v[idx]))
    return f"([{', '.join(vals)}])[{res_of(id_col)} + 1]"


def res_of(c="h3_index") -> str:
    return f"CAST((({c} >> {cells.RES_SHIFT}) & 15) AS INTEGER)"


def q_of(c="h3_index") -> str:
    return f"((({c} >> {cells.Q_SHIFT}) & {cells.AXIS_MASK}) - {cells.AXIS_OFFSET})"


def r_of(c="h3_index") -> str:
    return f"(({c} & {cells.AXIS_MASK}) - {cells.AXIS_OFFSET})"


def centre_x(res=None, c="h3_index") -> str:
    return f"((CAST({q_of(c)} AS DOUBLE) + CAST({r_of(c)} AS DOUBLE) * {d(0.5)}) * {_per_res(res, 'cx', id_col=c)})"


def centre_y(res=None, c="h3_index") -> str:
    return f"(CAST({r_of(c)} AS DOUBLE) * {_per_res(res, 'cy', id_col=c)})"


def lat_of_y(y: str) -> str:
    return (
        f"(asin(least(greatest({y} / {d(cells.EARTH_RADIUS_KM)}, {d(-1.0)}), {d(1.0)}))"
        f" * {d(cells.RAD2DEG)})"
    )


def lng_of_x(x: str) -> str:
    return (
        f"least(greatest(({x} / {d(cells.EARTH_RADIUS_KM)}) * {d(cells.RAD2DEG)}, {d(-180.0)}), {d(180.0)})"
    )


def lat(res=None, c="h3_index") -> str:
    return lat_of_y(centre_y(res, c))


def lng(res=None, c="h3_index") -> str:
    return lng_of_x(centre_x(res, c))


def area(res=None, c="h3_index") -> str:
    return _per_res(res, "area_km2", id_col=c)


def hex_str(c="h3_index") -> str:
    return f"lower(hex({c}))"


def float_div(n: str, den: str) -> str:
    """FLOAT / FLOAT in DuckDB already gives IEEE inf / NaN on zero."""
    return f"(CAST({n} AS FLOAT) / CAST({den} AS FLOAT))"


def continent(lat_e: str, lng_e: str) -> str:
    boxes = (
        ("Africa", -35.0, 37.0, -20.0, 55.0),
        ("Asia", 5.0, 55.0, 60.0, 150.0),
        ("Europe", 35.0, 72.0, -12.0, 45.0),
        ("South America", -56.0, 15.0, -82.0, -34.0),
        ("North America", 15.0, 72.0, -170.0, -50.0),
    )
    whens = " ".join(
        f"WHEN {lat_e} BETWEEN {a} AND {b} AND {lng_e} BETWEEN {c} AND {e} THEN '{n}'" for n, a, b, c, e in boxes
    )
    return f"CASE {whens} ELSE 'Other' END"
