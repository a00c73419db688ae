"""Queries on a cell index: derived attributes, ratios, top-k, boxes, regions, statistics.

All operators take and return lazy DataFrames. Top-k plans as
``TakeOrderedAndProject`` (each task keeps its own k best, the driver merges
k x tasks rows); grouped statistics use partial aggregation, so their
shuffles carry one row per (task, group).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cells
from ..functions.geometry import point_wkb
from ..functions.num import float_div, round_to_bigint

# --- fixed values: region boxes, first match wins (lat_min, lat_max, lng_min, lng_max)
CONTINENT_BOXES = [
    ("Africa", -35.0, 37.0, -20.0, 55.0),
    ("Asia", 5.0, 55.0, 60.0, 150.0),
    ("Europe", 35.0, 72.0, -12.0, 45.0),
    ("South America", -56.0, 15.0, -82.0, -34.0),
    ("North America", 15.0, 72.0, -170.0, -50.0),
]
OTHER_REGION = "Other"
# ----------------------------------------------------------------------------------------


def pop_columns(df: DataFrame) -> list[str]:
    """Population columns ``pop_YYYY`` in schema order.

    Stricter than a ``LIKE 'pop_%'`` test, where ``_`` is a wildcard."""
    import re

    return [f.name for f in df.schema.fields if re.fullmatch(r"pop_\d{4}", f.name)]


def with_cell_attributes(
    index: DataFrame, res: int | None = None, id_col: str = "h3_index", system: str = "hex"
) -> DataFrame:
    """F14 (G3-G6): add ``h3_hex``, ``lat``, ``lng`` (DOUBLE) and ``area_km2`` (DOUBLE).

    With ``res`` given (a single-resolution index) the constants are literals.
    ``system="h3"`` derives them from H3 ids through the optional ``h3`` package.
    """
    c = id_col
    if system == "h3":
        from ..functions.h3_adapter import h3_attributes

        return index.withColumns({"h3_hex": cells.cell_to_string(c), **h3_attributes(F.col(c))})
    return index.withColumns(
        {
            "h3_hex": cells.cell_to_string(c),
            "lat": cells.cell_lat(c, res),
            "lng": cells.cell_lng(c, res),
            "area_km2": cells.cell_area_km2(c, res),
        }
    )


def legacy_view(index: DataFrame, res: int | None = None) -> DataFrame:
    """The v1 layout over a v2 index: VARCHAR id, WKB point, FLOAT lat/lon/area, pop_*."""
    c = "h3_index"
    lat = cells.cell_lat(c, res)
    lng = cells.cell_lng(c, res)
    keep = [k for k in ("scenario", "h3_res") if k in index.columns]
    return index.select(
        *keep,
        cells.cell_to_string(c).alias("h3_index"),
        point_wkb(lng, lat).alias("geometry"),
        lat.cast("float").alias("lat"),
        lng.cast("float").alias("lon"),
        cells.cell_area_km2(c, res).cast("float").alias("area_km2"),
        *pop_columns(index),
    )


def growth_ratio(num: str, den: str) -> Column:
    """``(num / den)::FLOAT`` with IEEE results on a zero divisor."""
    return float_div(num, den)


def top_k(df: DataFrame, by: str, k: int, tie: str = "h3_index", ascending: bool = False) -> DataFrame:
    """O2/O3: k rows with the largest (or smallest) ``by``; ties broken by ``tie``.

    NULLs sort last both ways. Plans as TakeOrderedAndProject.
    """
    key = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(key, F.col(tie).asc_nulls_last()).limit(int(k))


def _id_range(res: int, lng_min: float, lng_max: float, lat_min: float, lat_max: float):
    """Conservative [lo, hi] of ids whose cell centre can fall in the box.

    Ids sort by (res, q, r), so a q range is one contiguous id range. A box
    reaching the +/-180 clamp keeps that side open.
    """
    k = cells.res_constants(res)
    R = cells.EARTH_RADIUS_KM
    y_lo = R * math.sin(math.radians(max(lat_min, -90.0)))
    y_hi = R * math.sin(math.radians(min(lat_max, 90.0)))
    # centres past a pole are clamped to +/-90, so a box touching a pole stays open there
    r_lo = math.floor(y_lo / k.cy) - 2 if lat_min > -90.0 else -cells.AXIS_OFFSET
    r_hi = math.ceil(y_hi / k.cy) + 2 if lat_max < 90.0 else cells.AXIS_OFFSET
    x_lo = R * math.radians(lng_min)
    x_hi = R * math.radians(lng_max)
    q_lo = math.floor(x_lo / k.cx - r_hi / 2.0) - 2 if lng_min > -180.0 else -cells.AXIS_OFFSET
    q_hi = math.ceil(x_hi / k.cx - r_lo / 2.0) + 2 if lng_max < 180.0 else cells.AXIS_OFFSET - 1
    q_lo = max(q_lo, -cells.AXIS_OFFSET)
    q_hi = min(q_hi, cells.AXIS_OFFSET - 1)
    lo = k.base + ((q_lo + cells.AXIS_OFFSET) << cells.Q_SHIFT)
    hi = k.base + ((q_hi + cells.AXIS_OFFSET) << cells.Q_SHIFT) + cells.AXIS_MASK
    return lo, hi


def where_bbox(
    index: DataFrame,
    lat_min: float,
    lat_max: float,
    lng_min: float,
    lng_max: float,
    res: int | None = None,
) -> DataFrame:
    """cells whose centre lies in the (inclusive) box.

    For a single-resolution index a conservative ``h3_index BETWEEN lo AND
    hi`` is added in front of the exact test: it reaches the Parquet scan
    as a pushed filter, so row groups of a sorted index outside the box
    are skipped. The exact test on derived lat/lng decides. Ids of another
    system lie outside this system's id range; they are let through to the
    exact test, which fails on them.
    """
    dbl = cells.dbl
    # bound as a lambda variable: over an index that isn't written yet the filter moves below the
    # aggregate, and each mention of the id would be a copy of the whole cell expression
    exact = F.expr(
        f"exists(array(h3_index), id -> CASE WHEN shiftright(id, {cells.TAG_SHIFT}) <> {cells.ID_TAG} "
        f"THEN raise_error('{cells.FOREIGN}') ELSE "
        f"{cells.sql_cell_lat('id', res, False)} BETWEEN {dbl(lat_min)} AND {dbl(lat_max)} AND "
        f"{cells.sql_cell_lng('id', res, False)} BETWEEN {dbl(lng_min)} AND {dbl(lng_max)} END)"
    )
    if res is None:
        return index.where(exact)
    lo, hi = _id_range(res, lng_min, lng_max, lat_min, lat_max)
    least, largest = cells.own_id_range()
    near = F.col("h3_index").between(F.lit(lo), F.lit(hi))
    foreign = (F.col("h3_index") < F.lit(least)) | (F.col("h3_index") > F.lit(largest))
    return index.where(near | foreign).where(exact)


def where_bbox_curve(
    index: DataFrame, lat_min: float, lat_max: float, lng_min: float, lng_max: float, res: int, most_ranges: int = 32
) -> DataFrame:
    """F9 on a stored index clustered by ``h3_curve`` (``sinks.parquet.write_curve_index``), of one resolution: the box as a few
    ranges of the curve, which reach the scan and narrow it in both axes; the exact test decides. (Over an index that isn't
    stored yet the ranges would be pushed below its aggregate, with a copy of the cell expression for each bound.)"""
    from ..functions.curve import ranges, rectangle

    dbl = cells.dbl
    spans = ranges(*rectangle(res, lat_min, lat_max, lng_min, lng_max), most_ranges)
    near = F.lit(False)
    for low, high in spans:
        near = F.col("h3_curve").between(F.lit(low), F.lit(high)) if low == spans[0][0] else near | F.col("h3_curve").between(F.lit(low), F.lit(high))
    lat, lng = cells.sql_cell_lat("h3_index", res), cells.sql_cell_lng("h3_index", res)
    exact = F.expr(f"{lat} BETWEEN {dbl(lat_min)} AND {dbl(lat_max)} AND {lng} BETWEEN {dbl(lng_min)} AND {dbl(lng_max)}")
    return index.where(near).where(exact)


def continent_of(lat: str, lng: str) -> Column:
    """searched CASE over the region boxes (inclusive), first match wins, else 'Other'.

    ``lat``/``lng`` are column names or SQL expressions."""
    dbl = cells.dbl
    whens = " ".join(
        f"WHEN ({lat}) BETWEEN {dbl(la0)} AND {dbl(la1)} AND ({lng}) BETWEEN {dbl(lo0)} AND {dbl(lo1)} THEN '{name}'"
        for name, la0, la1, lo0, lo1 in CONTINENT_BOXES
    )
    return F.expr(f"CASE {whens} ELSE '{OTHER_REGION}' END")


def continent_totals(index: DataFrame, pop_cols: list[str], res: int | None = None) -> DataFrame:
    """A6 + O4: ``SUM(pop)::BIGINT`` per region, ordered by the first year's total."""
    c = "h3_index"
    # centres first, as columns: the CASE reads each of them ten times
    centres = index.select(cells.cell_lat(c, res).alias("_lat"), cells.cell_lng(c, res).alias("_lng"), *pop_cols)
    tagged = centres.select(continent_of("_lat", "_lng").alias("continent"), *pop_cols)
    agg = tagged.groupBy("continent").agg(*[round_to_bigint(F.sum(p)).alias(p) for p in pop_cols])
    return agg.orderBy(F.col(pop_cols[0]).desc_nulls_last(), F.col("continent"))


def extent_stats(index: DataFrame) -> DataFrame:
    """A4 per resolution: cell count, lat/lon extent of centres (FLOAT, as the
    legacy layout stores them) and mean nominal area ``avg(area)::FLOAT``."""
    c = "h3_index"
    v1 = index.select(
        "h3_res",
        cells.cell_lat(c).cast("float").alias("lat"),
        cells.cell_lng(c).cast("float").alias("lon"),
        cells.cell_area_km2(c).cast("float").alias("area_km2"),
    )
    return v1.groupBy("h3_res").agg(
        F.count(F.lit(1)).alias("n_cells"),
        F.min("lat").alias("lat_min"),
        F.max("lat").alias("lat_max"),
        F.min("lon").alias("lon_min"),
        F.max("lon").alias("lon_max"),
        F.avg("area_km2").cast("float").alias("avg_area_km2"),
    )


def population_stats(
    index: DataFrame, pop_cols: list[str], keys: list[str] | None = None, only_present: bool = False
) -> DataFrame:
    """A5 per (resolution, year column): ``sum::BIGINT, avg::FLOAT, max::FLOAT,
    count_if(> 0)``. One aggregate over all years per resolution; only its (at
    most 16) rows are turned into one row per year. ``keys`` groups by more, say the scenario;
    ``only_present`` leaves out year columns that hold no value in a group (of another dataset)."""
    keys = keys or ["h3_res"]
    aggs, structs = [], []
    for p in pop_cols:
        aggs += [
            round_to_bigint(F.sum(p)).alias(f"t_{p}"),
            F.avg(p).cast("float").alias(f"a_{p}"),
            F.max(p).cast("float").alias(f"m_{p}"),
            F.count_if(F.col(p) > 0).alias(f"c_{p}"),
            F.count(p).alias(f"n_{p}"),
        ]
        structs.append(
            f"named_struct('column_name', '{p}', 'total_pop', t_{p}, 'avg_pop', a_{p}, 'max_pop', m_{p}, "
            f"'cells_with_pop', c_{p}, 'present', n_{p} > 0)"
        )
    stats = index.groupBy(*keys).agg(*aggs).select(*keys, F.expr(f"inline(array({', '.join(structs)}))"))
    return (stats.where("present") if only_present else stats).drop("present")


def density(pop: str, area: str = "area_km2") -> Column:
    """``(pop / area)::FLOAT``."""
    return float_div(pop, area)
