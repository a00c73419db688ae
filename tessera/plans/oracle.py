"""DuckDB SQL for every registered query that SQL can express (see ``queries.py``)."""

from __future__ import annotations

import math

from .oracle_sql import (
    NODATA,
    PIXEL_VIEW,
    POP,
    SIX_YEARS,
    VALID,
    area,
    assign,
    cells,
    continent,
    d,
    float_div,
    hex_str,
    index,
    lat,
    lat_of_y,
    lng,
    lng_of_x,
    mask,
    centre_x,
    centre_y,
    res_of,
)

# Parameters of the queries and the window lattice, stated again.
ALL = [1, 2, 3, 4, 5, 6, 7, 8]
RES = 5
POPS = ", ".join(POP)
WINDOW_SIZE_DEG, LON_MIN, LAT_MIN = 5.0, -180.0, -90.0
N_LON, N_LAT = 72, 36
WINDOW_ID_FORMAT = "w_%+08.1f_%+07.1f"
BBOX_MAIN = (20.0, 35.0, 68.0, 90.0)
BBOX_LIMITED = (35.0, 45.0, -10.0, 5.0)
BBOX_FIXTURE = (-30.0, 30.0, 55.0, 70.0)
HEIGHT, WIDTH, STEP = 720, 1440, 0.25


def _win_cols(lon_idx: str, lat_idx: str) -> str:
    s = d(WINDOW_SIZE_DEG)
    west = f"({d(LON_MIN)} + CAST({lon_idx} AS DOUBLE) * {s})"
    south = f"({d(LAT_MIN)} + CAST({lat_idx} AS DOUBLE) * {s})"
    return (
        f"printf('{WINDOW_ID_FORMAT}', {west}, {south}) AS win_id, {west} AS west, {south} AS south, "
        f"least({west} + {s}, {d(180.0)}) AS east, least({south} + {s}, {d(90.0)}) AS north"
    )


def _pixel_windows(src: str, extra: str = "lat, lon") -> str:
    s = d(WINDOW_SIZE_DEG)
    lon_idx = f"least(floor((lon - {d(LON_MIN)}) / {s}), {N_LON - 1})"
    lat_idx = f"least(floor((lat - {d(LAT_MIN)}) / {s}), {N_LAT - 1})"
    return f"SELECT {extra}, {_win_cols(lon_idx, lat_idx)} FROM ({src}) pw_src"


LATTICE = (
    f"SELECT {_win_cols(f'(i // {N_LAT})', f'(i % {N_LAT})')} "
    f"FROM (SELECT range AS i FROM range({N_LON * N_LAT})) lt"
)

IDX5 = index([RES])
IDX_ALL = index(ALL)


def _attrs(src: str = IDX5) -> str:
    return (
        f"SELECT h3_index, {POPS}, CAST({lat(RES)} AS FLOAT) AS lat, CAST({lng(RES)} AS FLOAT) AS lng, "
        f"CAST({area(RES)} AS FLOAT) AS area_km2 FROM ({src}) at_src"
    )


def _bbox(box) -> str:
    la0, la1, lo0, lo1 = box
    return (
        f"SELECT h3_index, CAST(lat_d AS FLOAT) AS lat, CAST(lng_d AS FLOAT) AS lng, {POPS} FROM "
        f"(SELECT *, {lat(RES)} AS lat_d, {lng(RES)} AS lng_d FROM ({IDX5}) b0) b1 "
        f"WHERE lat_d BETWEEN {la0} AND {la1} AND lng_d BETWEEN {lo0} AND {lo1}"
    )


def _mask_counts() -> str:
    nod = " OR ".join(f"{c} = {NODATA}" for c in POP)
    nonfin = " OR ".join(f"NOT isfinite({c})" for c in POP)
    clean = " AND ".join(f"({c} <> {NODATA} AND isfinite({c}))" for c in POP)
    pos = " OR ".join(f"{c} > 0" for c in POP)
    return (
        "SELECT count(*) AS n_pixels, "
        f"CAST(count(*) FILTER (WHERE {nod}) AS BIGINT) AS n_nodata, "
        f"CAST(count(*) FILTER (WHERE {nonfin}) AS BIGINT) AS n_nonfinite, "
        f"CAST(count(*) FILTER (WHERE ({clean}) AND NOT ({pos})) AS BIGINT) AS n_no_positive, "
        f"CAST(count(*) FILTER (WHERE {mask()}) AS BIGINT) AS n_valid "
        f"FROM ({PIXEL_VIEW}) mc"
    )


def _window_status() -> str:
    pw = f"SELECT win_id, count(*) AS n_valid FROM ({_pixel_windows(VALID)}) w GROUP BY win_id"
    return (
        "SELECT status, count(*) AS n_windows, CAST(sum(n_valid) AS BIGINT) AS n_valid FROM ("
        " SELECT l.win_id, CASE WHEN coalesce(p.n_valid, 0) > 0 THEN 'done' ELSE 'skipped_no_data' END AS status,"
        " CAST(coalesce(p.n_valid, 0) AS BIGINT) AS n_valid"
        f" FROM ({LATTICE}) l LEFT JOIN ({pw}) p ON l.win_id = p.win_id) s GROUP BY status"
    )


def _resume() -> str:
    pw = (
        f"SELECT win_id, west, south, count(*) AS n_valid FROM ({_pixel_windows(VALID)}) w "
        "GROUP BY win_id, west, south"
    )
    return (
        f"WITH pw AS ({pw}) SELECT win_id, west, south, n_valid FROM pw "
        f"WHERE win_id NOT IN (SELECT win_id FROM pw WHERE west < {0.0})"
    )


def _window_cell_counts() -> str:
    keep = ["win_id", "west", "south", "east", "north"]
    a = assign(_pixel_windows(VALID), keep, ALL)
    ks = ", ".join(keep)
    return (
        f"SELECT {ks}, h3_res, count(*) AS n_pixels, count(DISTINCT h3_index) AS n_cells "
        f"FROM ({a}) a GROUP BY {ks}, h3_res"
    )


def _conservation() -> str:
    tots = ", ".join(f"sum({c}) AS total_{c[4:]}" for c in POP)
    return (
        f"SELECT h3_res, {tots}, count(*) AS n_rows FROM ("
        f" SELECT CAST(h3_res AS INTEGER) AS h3_res, {POPS} FROM ({IDX_ALL}) i"
        f" UNION ALL SELECT CAST(NULL AS INTEGER) AS h3_res, {POPS} FROM ({VALID}) v) u GROUP BY h3_res"
    )


def _cell_boundary() -> str:
    k = cells.res_constants(RES)
    vals = ", ".join(f"({i}, {d(k.vx[i])}, {d(k.vy[i])})" for i in range(6))
    return (
        f"SELECT h3_index, vertex, CAST({lat_of_y(f'({centre_y(RES)} + vy)')} AS FLOAT) AS lat, "
        f"CAST({lng_of_x(f'({centre_x(RES)} + vx)')} AS FLOAT) AS lng "
        f"FROM (SELECT h3_index FROM ({IDX5}) i0) i, (VALUES {vals}) v(vertex, vx, vy)"
    )


def _topk_population() -> str:
    return (
        f"SELECT h3_index, {hex_str()} AS h3_hex, lat, lng, {POPS}, "
        f"{float_div('pop_2100', 'pop_2025')} AS growth_ratio FROM ({_attrs()}) a "
        f"ORDER BY pop_2025 DESC, h3_index LIMIT {20}"
    )


def _topk_density() -> str:
    return (
        f"SELECT {hex_str()} AS h3_index, lat, lng AS lon, area_km2, pop_2025, "
        f"{float_div('pop_2025', 'area_km2')} AS density_per_km2 FROM ({_attrs()}) a "
        f"ORDER BY pop_2025 DESC, a.h3_index LIMIT {10}"
    )


def _growth() -> str:
    return (
        f"SELECT h3_index, lat, lng, pop_2025, pop_2100, {float_div('pop_2100', 'pop_2025')} AS growth_ratio "
        f"FROM ({_attrs()}) a WHERE pop_2025 > {400.0} "
        f"ORDER BY growth_ratio DESC, h3_index LIMIT {20}"
    )


def _continents() -> str:
    sums = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in POP)
    return (
        f"SELECT continent, {sums} FROM (SELECT {continent(lat(RES), lng(RES))} AS continent, {POPS} "
        f"FROM ({IDX5}) i) t GROUP BY continent ORDER BY pop_2025 DESC, continent"
    )


def _extent() -> str:
    return (
        "SELECT h3_res, count(*) AS n_cells, min(lat) AS lat_min, max(lat) AS lat_max, "
        "min(lon) AS lon_min, max(lon) AS lon_max, CAST(avg(area_km2) AS FLOAT) AS avg_area_km2 FROM ("
        f" SELECT h3_res, CAST({lat()} AS FLOAT) AS lat, CAST({lng()} AS FLOAT) AS lon, "
        f"CAST({area()} AS FLOAT) AS area_km2 FROM ({IDX_ALL}) i) v GROUP BY h3_res"
    )


def _pop_stats() -> str:
    parts = " UNION ALL ".join(f"SELECT h3_res, '{c}' AS column_name, {c} AS value FROM idx" for c in POP)
    return (
        f"WITH idx AS ({IDX_ALL}) SELECT h3_res, column_name, CAST(SUM(value) AS BIGINT) AS total_pop, "
        "CAST(avg(value) AS FLOAT) AS avg_pop, CAST(max(value) AS FLOAT) AS max_pop, "
        "CAST(count(*) FILTER (WHERE value > 0) AS BIGINT) AS cells_with_pop "
        f"FROM ({parts}) l GROUP BY h3_res, column_name"
    )


YEARS_6 = [2025, 2030, 2040, 2050, 2060, 2100]


def _grid_stats() -> str:
    r0, c0, size = HEIGHT // 2 - 360, WIDTH // 2 - 360, 720  # min(1000, height, width)
    total = size * size
    parts = " UNION ALL ".join(
        f"SELECT {i + 1} AS band, {y} AS year, CASE WHEN isfinite(pop_{y}) AND pop_{y} <> {NODATA} "
        f"THEN CAST(pop_{y} AS DOUBLE) END AS value FROM win"
        for i, y in enumerate(YEARS_6)
    )
    return (
        f"WITH win AS (SELECT * FROM ({SIX_YEARS}) p WHERE r BETWEEN {r0} AND {r0 + size - 1} "
        f"AND c BETWEEN {c0} AND {c0 + size - 1}) "
        "SELECT b.band, b.year, CAST(min(value) AS FLOAT) AS min, CAST(max(value) AS FLOAT) AS max, "
        "CAST(avg(value) AS FLOAT) AS mean, CAST(stddev_pop(value) AS FLOAT) AS std, "
        f"count(value) AS n_valid, CAST({total} AS BIGINT) AS n_total, "
        f"CAST(CAST(count(value) AS DOUBLE) * {d(100.0)} / {d(float(total))} AS FLOAT) AS pct_valid "
        f"FROM (VALUES {', '.join(f'({i + 1}, {y})' for i, y in enumerate(YEARS_6))}) b(band, year) "
        f"LEFT JOIN ({parts}) l ON l.band = b.band GROUP BY b.band, b.year"
    )


def _sample_points() -> str:
    h, w, k = HEIGHT, WIDTH, 10
    pts = [("Center", h // 2, w // 2), ("Top-left", k, k), ("Top-right", k, w - k), ("Bot-left", h - k, k), ("Bot-right", h - k, w - k)]
    vals = ", ".join(f"('{a}', {b}, {c})" for a, b, c in pts)
    cols = ", ".join(f"coalesce(v.pop_{y}, {NODATA}) AS pop_{y}" for y in YEARS_6)
    return (
        f"SELECT p.label, CAST(p.r AS BIGINT) AS r, CAST(p.c AS BIGINT) AS c, "
        f"{d(90.0)} - (CAST(p.r AS DOUBLE) + {d(0.5)}) * {d(STEP)} AS lat, "
        f"{d(-180.0)} + (CAST(p.c AS DOUBLE) + {d(0.5)}) * {d(STEP)} AS lon, {cols} "
        f"FROM (VALUES {vals}) p(label, r, c) LEFT JOIN ({SIX_YEARS}) v ON v.r = p.r AND v.c = p.c"
    )


def _tile_conservation() -> str:
    parts = " UNION ALL ".join(
        f"SELECT {y} AS year, CASE WHEN isfinite(pop_{y}) AND pop_{y} <> {NODATA} THEN CAST(pop_{y} AS DOUBLE) END AS v "
        f"FROM ({PIXEL_VIEW}) p"
        for y in (2025, 2050, 2100)
    )
    return (
        "SELECT year, count(v) AS n_pixels, sum(v) AS total_pixels, count(v) AS n_tiles, sum(v) AS total_tiles "
        f"FROM ({parts}) t GROUP BY year"
    )


def _half_even() -> str:
    src = _pixel_windows(VALID, "pop_2025, pop_2050, pop_2100")
    return (
        "SELECT win_id, sum(CAST(pop_2025 AS DOUBLE) * 0.5::DOUBLE) AS half_2025, "
        "CAST(sum(CAST(pop_2025 AS DOUBLE) * 0.5::DOUBLE) AS BIGINT) AS total_2025, "
        f"CAST(sum(CAST(pop_2100 AS DOUBLE) * 0.5::DOUBLE) AS BIGINT) AS total_2100 FROM ({src}) s GROUP BY win_id"
    )


def _tile_split() -> str:
    """Cells whose bounding box (in the plane) lies within the one tile that holds their pixels, by the grid's own border too."""
    t, km = 32, d(cells.EARTH_RADIUS_KM)
    a = assign(f"SELECT lat, lon, r // {t} AS tr, c // {t} AS tc FROM ({VALID}) v", ["tr", "tc"], ALL)
    half_w = "([" + ", ".join(d(cells.res_constants(r).cx / 2 + 1e-6) for r in range(16)) + "])[h3_res + 1]"
    half_h = "([" + ", ".join(d(cells.res_constants(r).cy / 1.5 + 1e-6) for r in range(16)) + "])[h3_res + 1]"
    side = d(t * STEP)
    x = lambda lon: f"radians({lon}) * {km}"
    y = lambda lat_e: f"sin(radians({lat_e})) * {km}"
    last_row, last_col = -(-HEIGHT // t) - 1, -(-WIDTH // t) - 1
    inside = (
        f"(tc = 0 OR x - {half_w} >= {x(f'(-180 + tc * {side})')}) AND (tc = {last_col} OR x + {half_w} <= {x(f'(-180 + (tc + 1) * {side})')}) "
        f"AND (tr = 0 OR y + {half_h} <= {y(f'(90 - tr * {side})')}) AND (tr = {last_row} OR y - {half_h} >= {y(f'(90 - (tr + 1) * {side})')})"
    )
    return (
        f"WITH s AS (SELECT DISTINCT tr, tc, h3_res, h3_index, {centre_x()} AS x, {centre_y()} AS y FROM ({a}) a), "
        f"p AS (SELECT h3_res, h3_index, bool_or({inside}) AS inside, count(*) AS n FROM s GROUP BY ALL) "
        "SELECT h3_res, count(*) FILTER (inside) AS n_interior, count(*) FILTER (NOT inside) AS n_boundary, "
        "CAST(sum(CASE WHEN inside THEN 0 ELSE n END) AS BIGINT) AS n_boundary_rows FROM p GROUP BY h3_res"
    )


def _northern(cols: list[str]) -> str:
    return f"SELECT * FROM ({PIXEL_VIEW}) pv WHERE {mask(cols)} AND lat > 0"


def _little(e: str) -> str:
    big = f"hex(CAST(CAST(CAST({e} AS DOUBLE) AS BIT) AS BLOB))"
    return " || ".join(f"substr({big}, {2 * i + 1}, 2)" for i in range(7, -1, -1))


def _wkb(lng_e: str, lat_e: str) -> str:
    """Little-endian WKB of a point as upper-case hex: the bytes of each double in reverse."""
    return f"'01' || '01000000' || {_little(lng_e)} || {_little(lat_e)}"


def _polygons() -> str:
    """Corners as rows (x, y, place), cut at four lines one after another, then strung together."""
    corners = " UNION ALL ".join(
        f"SELECT h3_res, h3_index, {i} AS place, {centre_x(r)} + {d(cells.res_constants(r).vx[i])} AS x, "
        f"{centre_y(r)} + {d(cells.res_constants(r).vy[i])} AS y FROM ids WHERE h3_res = {r}"
        for r in (1, 2, 5)
        for i in range(6)
    )
    steps, last = [f"c0 AS ({corners})"], "c0"
    east, north = math.pi * cells.EARTH_RADIUS_KM, cells.EARTH_RADIUS_KM
    for k, (a, o, bound, test) in enumerate((("x", "y", east, "<="), ("x", "y", -east, ">="), ("y", "x", north, "<="), ("y", "x", -north, ">="))):
        nxt = lambda c: f"coalesce(lead({c}) OVER w, first_value({c}) OVER w)"
        steps.append(
            f"n{k} AS (SELECT *, {nxt('x')} AS nx, {nxt('y')} AS ny FROM {last} "
            "WINDOW w AS (PARTITION BY h3_index ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"
        )
        cross = f"{o} + (n{o} - {o}) * (({d(bound)} - {a}) / (n{a} - {a}))"
        steps.append(
            f"c{k + 1} AS (SELECT h3_res, h3_index, place * 2 AS place, x, y FROM n{k} WHERE {a} {test} {d(bound)} UNION ALL "
            f"SELECT h3_res, h3_index, place * 2 + 1, {d(bound) if a == 'x' else cross}, {d(bound) if a == 'y' else cross} "
            f"FROM n{k} WHERE ({a} {test} {d(bound)}) <> (n{a} {test} {d(bound)}))"
        )
        last = f"c{k + 1}"
    km, deg = d(cells.EARTH_RADIUS_KM), d(cells.RAD2DEG)
    lng_e = f"CAST(CAST(x / {km} * {deg} AS FLOAT) AS DOUBLE)"
    lat_e = f"CAST(CAST(asin(least(greatest(y / {km}, {d(-1.0)}), {d(1.0)})) * {deg} AS FLOAT) AS DOUBLE)"
    return (
        f"WITH ids AS (SELECT h3_res, h3_index FROM ({index([1, 2, 5])}) i), {', '.join(steps)}, "
        f"p AS (SELECT h3_res, h3_index, place, {_little(lng_e)} || {_little(lat_e)} AS b FROM {last}) "
        "SELECT h3_res, h3_index, CAST(count(*) AS INTEGER) AS n_corners, '0103000000' || '01000000' || lpad(hex(count(*) + 1), 2, '0') || '000000' "
        "|| string_agg(b, '' ORDER BY place) || first(b ORDER BY place) AS wkb_hex FROM p GROUP BY h3_res, h3_index"
    )


def _unlike_years() -> str:
    def part(scenario, cols, res, where):
        src = f"SELECT * FROM ({PIXEL_VIEW}) pv WHERE {mask(cols)} AND {where}"
        one = lambda c: (
            f"SELECT '{scenario}' AS scenario, h3_res, '{c}' AS column_name, CAST(SUM({c}) AS BIGINT) AS total_pop, CAST(avg({c}) AS FLOAT) AS avg_pop, "
            f"CAST(max({c}) AS FLOAT) AS max_pop, CAST(count(*) FILTER (WHERE {c} > 0) AS BIGINT) AS cells_with_pop "
            f"FROM ({index(res, cols, src)}) i GROUP BY h3_res"
        )
        return " UNION ALL ".join(one(c) for c in cols)

    return part("SSP1", ["pop_2025", "pop_2050"], [2, 4], "TRUE") + " UNION ALL " + part("SSP2", ["pop_2050", "pop_2100"], [4, 6], "lon > 0")


ORACLE = {
    "valid_pixels": VALID,
    "pixel_mask_counts": _mask_counts(),
    "year_unpivot_pivot": f"SELECT pixel_id, {POPS} FROM ({PIXEL_VIEW}) p",
    "tiles_roundtrip": f"SELECT r, c, lat, lon, {POPS} FROM ({VALID}) v",
    "window_cell_counts": _window_cell_counts(),
    "window_status": _window_status(),
    "resume_windows": _resume(),
    "cell_assign_multi_res": assign(VALID, ["pixel_id"], ALL),
    "index_all_res": IDX_ALL,
    "index_res5_sorted": f"SELECT h3_index, {POPS} FROM ({IDX5}) i ORDER BY h3_index",
    "cells_per_resolution": f"SELECT h3_res, count(*) AS n_cells FROM ({IDX_ALL}) i GROUP BY ROLLUP (h3_res)",
    "distinct_cells": (
        f"SELECT h3_res, count(DISTINCT h3_index) AS n_cells FROM ({assign(VALID, ['pixel_id'], ALL)}) a "
        "GROUP BY h3_res"
    ),
    "conservation": _conservation(),
    "cell_attributes": f"SELECT *, {hex_str()} AS h3_hex FROM ({_attrs()}) a",
    "hex_roundtrip": (
        f"SELECT h3_index, {hex_str()} AS h3_hex, CAST('0x' || {hex_str()} AS BIGINT) AS h3_back, "
        f"{res_of()} AS res_of_id FROM ({IDX_ALL}) i"
    ),
    "cell_boundary": _cell_boundary(),
    "topk_population": _topk_population(),
    "topk_density": _topk_density(),
    "growth_hotspots": _growth(),
    "bbox_cells": _bbox(BBOX_MAIN),
    "bbox_cells_fixture": _bbox(BBOX_FIXTURE),
    "bbox_limit": f"SELECT h3_index, pop_2025, pop_2050 FROM ({_bbox(BBOX_LIMITED)}) b ORDER BY h3_index LIMIT {100}",
    "continent_totals": _continents(),
    "extent_stats": _extent(),
    "population_stats": _pop_stats(),
    "grid_stats_center": _grid_stats(),
    "sample_points": _sample_points(),
    "tile_conservation": _tile_conservation(),
    "half_even_totals": _half_even(),
    "cell_points": f"SELECT h3_index, {_wkb('lng', 'lat')} AS wkb_hex FROM ({_attrs()}) a",
    "index_file_ranges": (
        "SELECT h3_res, count(*) AS n_cells, min(h3_index) AS min_id, max(h3_index) AS max_id, "
        f"CAST(0 AS BIGINT) AS n_overlaps, TRUE AS files_sorted FROM ({IDX_ALL}) i GROUP BY h3_res"
    ),
    "metadata_json": (
        "SELECT 'SSP2' AS scenario, 'EPSG:4326' AS crs, 'hex' AS cell_system, '2025,2050,2100' AS years, "
        "CAST(h3_res AS INTEGER) AS h3_res, count(*) AS n_cells, min(h3_index) AS first_id, max(h3_index) AS last_id, "
        + ", ".join(f"sum(CAST({c} AS DOUBLE)) AS total_{c[4:]}" for c in POP)
        + f" FROM ({IDX_ALL}) i GROUP BY h3_res"
    ),
    "index_listing": (
        "SELECT h3_res, count(*) AS n_cells, CAST(0 AS BIGINT) AS n_unlisted, CAST(0 AS BIGINT) AS n_empty "
        f"FROM ({IDX_ALL}) i GROUP BY h3_res"
    ),
    "snapshot_republish": (
        f"WITH i AS ({index([1, 2], ['pop_2025'], _northern(['pop_2025']))}) "
        "SELECT h3_res, h3_index, pop_2025, count(*) OVER (PARTITION BY h3_res) AS n_told FROM i"
    ),
    "snapshot_crash": index([1, 2, 3, 4]),
    "window_resume": (
        "SELECT l.win_id, CAST(1 AS BIGINT) AS n_runs, CASE WHEN p.n IS NULL THEN 'skipped_no_data' ELSE 'done' END AS status, "
        f"coalesce(p.n, 0) AS n_valid FROM ({LATTICE}) l LEFT JOIN "
        f"(SELECT win_id, count(*) AS n FROM ({_pixel_windows(VALID)}) w GROUP BY win_id) p ON p.win_id = l.win_id"
    ),
    "window_resume_index": index([2, 5]),
    "tile_window": f"SELECT r, c, lat, lon, {POPS} FROM ({VALID}) v WHERE r BETWEEN 100 AND 419 AND c BETWEEN 200 AND 1103",
    "index_tiled": IDX_ALL,
    "tile_split": _tile_split(),
    "index_written_readback": f"SELECT h3_index, {POPS} FROM ({IDX5}) i",
    "bbox_written": _bbox(BBOX_FIXTURE),
    "index_resumable": IDX_ALL,
    "sql_continent_totals": _continents(),
    "pub_topk_population": _topk_population(),
    "pub_growth_hotspots": _growth(),
    "pub_continent_totals": _continents(),
    "pub_bbox_cells": _bbox(BBOX_MAIN),
    "pub_extent_stats": _extent(),
    "pub_population_stats": _pop_stats(),
    "pub_cell_attributes": f"SELECT *, {hex_str()} AS h3_hex FROM ({_attrs()}) a",
    "legacy_written_readback": (
        f"SELECT {hex_str()} AS h3_index, 21 AS n_bytes, lng AS point_lon, lat AS point_lat, lat, lng AS lon, area_km2, {POPS} FROM ({_attrs()}) a"
    ),
    "sample_points_tiles": _sample_points(),
    "grid_stats_tiles": _grid_stats(),
    "cell_polygons": _polygons(),
    "bbox_curve": _bbox(BBOX_FIXTURE),
    "bitmap_cell_counts": (
        f"WITH a AS ({assign(_pixel_windows(VALID), ['win_id'], ALL)}) "
        "SELECT win_id, h3_res, count(*) AS n_pixels, count(DISTINCT h3_index) AS n_cells FROM a GROUP BY win_id, h3_res UNION ALL "
        "SELECT NULL, h3_res, count(*), count(DISTINCT h3_index) FROM a GROUP BY h3_res"
    ),
    "merged_population_stats": _unlike_years(),
}
