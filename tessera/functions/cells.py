"""Native equal-area hexagonal cell system, as Spark Column expressions.

No H3 library is available to the engine, so the default cell system is our
own grid with the same resolution ladder (aperture 7, ``2 + 120 * 7**res``
cells per resolution) on an equal-area plane:

* projection: Lambert cylindrical equal-area,
  ``X = R * lon_rad``, ``Y = R * sin(lat_rad)``;
* cells: pointy-top hexagons of edge ``a`` with
  ``area = 4 * pi * R**2 / (2 + 120 * 7**res)`` and ``area = 3*sqrt(3)/2 * a**2``;
* assignment: fractional axial coordinates, then cube rounding;
* id: ``7 << 59 | res << 55 | (q + 2**26) << 27 | (r + 2**26)`` -- a
  positive BIGINT that can never be mistaken for an H3 id.

Every function here returns a plain Column (arithmetic, ``floor``, ``sin``,
``asin``, bit operations), so cell assignment runs inside whole-stage
codegen with no Python worker. Arguments are SQL expressions -- usually
column names. Each function writes its expression as Spark SQL text and
parses it once with ``F.expr``: building the same tree operator by operator
costs one JVM round trip per node, which made plan construction slower than
running the plan on small inputs. Where a resolution is known when the plan
is built, pass it as an ``int`` and its constants become literals; pass a
column name to select the constants per row.

Limits: cells are cut at +/-180 degrees and at the poles (their nominal
area is then larger than the covered area), shapes stretch toward the
poles, and ids are not H3 ids (see ``tessera.functions.h3_adapter``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the cell system ----------------------------------------
EARTH_RADIUS_KM = 6371.007180918475  # authalic radius, km
MIN_RES = 0
MAX_RES = 15
ID_TAG = 7  # value of bits 59..61 in every id
TAG_SHIFT = 59
RES_SHIFT = 55
Q_SHIFT = 27
AXIS_OFFSET = 1 << 26  # axial coordinates are stored as q + 2**26, r + 2**26
AXIS_MASK = (1 << 27) - 1
# -----------------------------------------------------------------------------

DEG2RAD = math.pi / 180.0
RAD2DEG = 180.0 / math.pi
SQRT3 = math.sqrt(3.0)
# pointy-top hexagon: vertex i sits at angle 60*i - 30 degrees from the centre
VERTEX_ANGLES = [math.radians(60.0 * i - 30.0) for i in range(6)]


@dataclass(frozen=True)
class ResConstants:
    res: int
    n_cells: int
    area_km2: float
    edge_km: float
    kq_x: float  # q_frac = X * kq_x - Y * kq_y
    kq_y: float
    kr_y: float  # r_frac = Y * kr_y
    cx: float  # centre X = (q + 0.5 * r) * cx
    cy: float  # centre Y = r * cy
    vx: tuple  # vertex offsets in X, Y (edge * cos / sin of the vertex angle)
    vy: tuple
    base: int  # ID_TAG << 59 | res << 55


@lru_cache(maxsize=None)
def res_constants(res: int) -> ResConstants:
    check_res(res)
    n = 2 + 120 * 7**res
    area = 4.0 * math.pi * EARTH_RADIUS_KM * EARTH_RADIUS_KM / n
    a = math.sqrt(2.0 * area / (3.0 * SQRT3))
    return ResConstants(
        res=res,
        n_cells=n,
        area_km2=area,
        edge_km=a,
        kq_x=SQRT3 / 3.0 / a,
        kq_y=1.0 / 3.0 / a,
        kr_y=2.0 / 3.0 / a,
        cx=SQRT3 * a,
        cy=1.5 * a,
        vx=tuple(a * math.cos(t) for t in VERTEX_ANGLES),
        vy=tuple(a * math.sin(t) for t in VERTEX_ANGLES),
        base=(ID_TAG << TAG_SHIFT) | (res << RES_SHIFT),
    )


def check_res(res: int) -> int:
    if not isinstance(res, int) or isinstance(res, bool) or not MIN_RES <= res <= MAX_RES:
        raise ValueError(f"resolution must be an int in [{MIN_RES}, {MAX_RES}], got {res!r}")
    return res


# --- SQL text helpers -------------------------------------------------------------


def dbl(x: float) -> str:
    """Exact DOUBLE literal (shortest round-trip digits, ``D`` suffix)."""
    return f"({float(x)!r}D)"


def lng_lit(n: int) -> str:
    return f"({int(n)}L)"


def _sql(e) -> str:
    if isinstance(e, str):
        return f"({e})"
    raise TypeError("cell functions take SQL expressions or column names as str")


def _per_res(res, attr: str, idx: int | None = None) -> str:
    """Constant ``attr`` of a resolution: a literal for an int, else a lookup by ``res`` (SQL)."""
    if isinstance(res, int):
        v = getattr(res_constants(res), attr)
        return dbl(v if idx is None else v[idx])
    vals = []
    for r in range(MIN_RES, MAX_RES + 1):
        v = getattr(res_constants(r), attr)
        vals.append(dbl(v if idx is None else v[idx]))
    return f"element_at(array({', '.join(vals)}), CAST({res} AS INT) + 1)"


# --- projection ----------------------------------------------------------------


def sql_project_x(lon: str) -> str:
    return f"(({_sql(lon)} * {dbl(DEG2RAD)}) * {dbl(EARTH_RADIUS_KM)})"


def sql_project_y(lat: str) -> str:
    return f"(sin({_sql(lat)} * {dbl(DEG2RAD)}) * {dbl(EARTH_RADIUS_KM)})"


def project_x(lon: str) -> Column:
    """Equal-area plane X (km) of a longitude in degrees."""
    return F.expr(sql_project_x(lon))


def project_y(lat: str) -> Column:
    """Equal-area plane Y (km) of a latitude in degrees."""
    return F.expr(sql_project_y(lat))


# --- point -> cell ---------------------------------------------------------------


def sql_axial_round(x: str, y: str, kq_x: str, kq_y: str, kr_y: str) -> tuple[str, str]:
    """Cube-rounded axial (q, r) of a projected point; the per-resolution
    factors may be literals or column names."""
    x, y = _sql(x), _sql(y)
    qf = f"({x} * {kq_x} - {y} * {kq_y})"
    rf = f"({y} * {kr_y})"
    sf = f"(-{qf} - {rf})"
    half = dbl(0.5)
    qi, ri, si = f"floor({qf} + {half})", f"floor({rf} + {half})", f"floor({sf} + {half})"
    dq, dr, ds = f"abs({qi} - {qf})", f"abs({ri} - {rf})", f"abs({si} - {sf})"
    q_is_worst = f"({dq} > {dr} AND {dq} > {ds})"
    q = f"(CASE WHEN {q_is_worst} THEN -{ri} - {si} ELSE {qi} END)"
    r = f"(CASE WHEN {q_is_worst} THEN {ri} WHEN {dr} > {ds} THEN -{qi} - {si} ELSE {ri} END)"
    return q, r


def _sql_pack(base: str, q: str, r: str) -> str:
    return (
        f"({base} + (CAST({q} AS BIGINT) + {AXIS_OFFSET}) * {1 << Q_SHIFT}"
        f" + (CAST({r} AS BIGINT) + {AXIS_OFFSET}))"
    )


def sql_cell_of_xy(x: str, y: str, res: int) -> str:
    k = res_constants(res)
    q, r = sql_axial_round(x, y, dbl(k.kq_x), dbl(k.kq_y), dbl(k.kr_y))
    return _sql_pack(lng_lit(k.base), q, r)


def cell_of_xy(x: str, y: str, res: int) -> Column:
    """Cell id (BIGINT) of a projected point at a fixed resolution."""
    return F.expr(sql_cell_of_xy(x, y, res))


def cell_of_xy_by_constants(x: str, y: str, kq_x: str, kq_y: str, kr_y: str, base: str) -> Column:
    """Cell id with the resolution's constants given as columns (see
    ``resolution_constants``): one expression serves every resolution."""
    q, r = sql_axial_round(x, y, _sql(kq_x), _sql(kq_y), _sql(kr_y))
    return F.expr(_sql_pack(_sql(base), q, r))


def resolution_constants(resolutions) -> Column:
    """Literal ``ARRAY<STRUCT<h3_res, kq_x, kq_y, kr_y, base>>``; ``inline`` it
    to fan each point out to every resolution with that resolution's factors."""
    structs = []
    for r in resolutions:
        k = res_constants(r)
        structs.append(
            f"named_struct('h3_res', {int(r)}, 'kq_x', {dbl(k.kq_x)}, 'kq_y', {dbl(k.kq_y)}, "
            f"'kr_y', {dbl(k.kr_y)}, 'base', {lng_lit(k.base)})"
        )
    return F.expr(f"array({', '.join(structs)})")


def cell_of(lat: str, lon: str, res: int) -> Column:
    """Cell id (BIGINT) of a point given in degrees (``latlng_to_cell``)."""
    return F.expr(sql_cell_of_xy(sql_project_x(lon), sql_project_y(lat), res))


# --- cell -> attributes ----------------------------------------------------------


FOREIGN = "not an id of this cell system (H3 ids are not decoded here)"


def sql_own(cell: str) -> str:
    """The id itself; fails on an id without this system's tag. NULL stays NULL."""
    c = _sql(cell)
    return f"CASE WHEN shiftright({c}, {TAG_SHIFT}) <> {ID_TAG} THEN raise_error('{FOREIGN}') ELSE {c} END"


def own_id_range() -> tuple[int, int]:
    """Least and largest id with this system's tag."""
    return ID_TAG << TAG_SHIFT, ((ID_TAG + 1) << TAG_SHIFT) - 1


def sql_cell_res(cell: str) -> str:
    return f"CAST((shiftright({sql_own(cell)}, {RES_SHIFT}) & 15) AS INT)"


def sql_cell_q(cell: str) -> str:
    return f"((shiftright({_sql(cell)}, {Q_SHIFT}) & {AXIS_MASK}) - {AXIS_OFFSET})"


def sql_cell_r(cell: str, checked: bool = True) -> str:
    return f"((({sql_own(cell) if checked else _sql(cell)}) & {AXIS_MASK}) - {AXIS_OFFSET})"


def cell_res(cell: str) -> Column:
    return F.expr(sql_cell_res(cell))


def cell_q(cell: str) -> Column:
    return F.expr(sql_cell_q(cell))


def cell_r(cell: str) -> Column:
    return F.expr(sql_cell_r(cell))


def is_valid_cell(cell: str) -> Column:
    c = _sql(cell)
    return F.expr(f"(shiftright({c}, {TAG_SHIFT}) = {ID_TAG} AND (shiftright({c}, 54) & 1) = 0)")


def _res_of(cell: str, res):
    return res if res is not None else sql_cell_res(cell)


def sql_centre_x(cell: str, res=None, checked: bool = True) -> str:
    res = _res_of(cell, res)
    return f"(({sql_cell_q(cell)} + {sql_cell_r(cell, checked)} * {dbl(0.5)}) * {_per_res(res, 'cx')})"


def sql_centre_y(cell: str, res=None, checked: bool = True) -> str:
    res = _res_of(cell, res)
    return f"({sql_cell_r(cell, checked)} * {_per_res(res, 'cy')})"


def sql_lat_of_y(y: str) -> str:
    s = f"({_sql(y)} / {dbl(EARTH_RADIUS_KM)})"
    return f"(asin(least(greatest({s}, {dbl(-1.0)}), {dbl(1.0)})) * {dbl(RAD2DEG)})"


def sql_lng_of_x(x: str) -> str:
    d = f"(({_sql(x)} / {dbl(EARTH_RADIUS_KM)}) * {dbl(RAD2DEG)})"
    return f"least(greatest({d}, {dbl(-180.0)}), {dbl(180.0)})"


def centre_x(cell: str, res=None) -> Column:
    return F.expr(sql_centre_x(cell, res))


def centre_y(cell: str, res=None) -> Column:
    return F.expr(sql_centre_y(cell, res))


def sql_cell_lat(cell: str, res=None, checked: bool = True) -> str:
    # least and greatest skip nulls, so a null id needs a test of its own
    return f"CASE WHEN {_sql(cell)} IS NOT NULL THEN {sql_lat_of_y(sql_centre_y(cell, res, checked))} END"


def sql_cell_lng(cell: str, res=None, checked: bool = True) -> str:
    return f"CASE WHEN {_sql(cell)} IS NOT NULL THEN {sql_lng_of_x(sql_centre_x(cell, res, checked))} END"


def cell_lat(cell: str, res=None) -> Column:
    """Latitude (degrees, DOUBLE) of the cell centre, clamped to +/-90."""
    return F.expr(sql_cell_lat(cell, res))


def cell_lng(cell: str, res=None) -> Column:
    """Longitude (degrees, DOUBLE) of the cell centre, clamped to +/-180."""
    return F.expr(sql_cell_lng(cell, res))


def sql_cell_area(cell: str, res=None) -> str:
    if res is None:
        return f"CASE WHEN {_sql(cell)} IS NOT NULL THEN {_per_res(sql_cell_res(cell), 'area_km2')} END"
    return f"CASE WHEN {sql_own(cell)} IS NOT NULL THEN {_per_res(res, 'area_km2')} END"


def cell_area_km2(cell: str, res=None) -> Column:
    """Nominal cell area in km^2 (DOUBLE)."""
    return F.expr(sql_cell_area(cell, res))


def cell_boundary(cell: str, res=None) -> Column:
    """Six vertices ``ARRAY<STRUCT<lat DOUBLE, lng DOUBLE>>``, counter-clockwise
    from the lower right, in the same clamped lat/lng as the centre."""
    return F.expr(sql_cell_boundary(cell, res))


def sql_cell_boundary(cell: str, res=None) -> str:
    res = _res_of(cell, res)
    x, y = sql_centre_x(cell, res), sql_centre_y(cell, res)
    verts = []
    for i in range(6):
        vy = y + " + " + _per_res(res, "vy", i)
        vx = x + " + " + _per_res(res, "vx", i)
        verts.append(f"named_struct('lat', {sql_lat_of_y(vy)}, 'lng', {sql_lng_of_x(vx)})")
    return f"CASE WHEN {_sql(cell)} IS NOT NULL THEN array({', '.join(verts)}) END"


def resolution_geometry() -> Column:
    """Literal ``ARRAY<STRUCT<vx ARRAY<DOUBLE>, vy ARRAY<DOUBLE>>>``: corner offsets (km) of every resolution, by resolution + 1."""
    offsets = lambda v: f"array({', '.join(dbl(x) for x in v)})"
    every = [res_constants(r) for r in range(MIN_RES, MAX_RES + 1)]
    return F.expr("array(" + ", ".join(f"named_struct('vx', {offsets(k.vx)}, 'vy', {offsets(k.vy)})" for k in every) + ")")


# --- id <-> string -----------------------------------------------------------------


def cell_to_string(cell: str) -> Column:
    """Lower-case hexadecimal text of an id (no leading zeros); the same text for any 64-bit id system."""
    return F.expr(f"lower(hex({_sql(cell)}))")


def string_to_cell(s: str) -> Column:
    """Hexadecimal text -> BIGINT id."""
    return F.expr(f"CAST(conv({_sql(s)}, 16, 10) AS BIGINT)")
