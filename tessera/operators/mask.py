"""Pixel validity mask (F4-F7) as one native predicate.

A pixel is kept when, for **every** year, the value is not nodata (compared
in FLOAT, the storage type) and finite, and **at least one** year is > 0.
One bad year drops the pixel for all years; a negative year is kept (and
later summed) when another year is positive. NULL (a pixel missing in some
year with no nodata fill) fails the predicate, so it is dropped too.

Spark evaluates ``NaN > 0`` as true, unlike NumPy; the finiteness test is
ANDed in, so a NaN can never be the "positive" year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.num import sql_float_literal, sql_is_finite


def sql_is_nodata(c: str, nodata: float | None) -> str:
    """Spark holds NaN equal to NaN, so one comparison covers a NaN nodata too."""
    return "false" if nodata is None else f"({c} = {sql_float_literal(nodata)})"


def sql_not_nodata(c: str, nodata: float | None) -> str:
    if nodata is None:
        return f"({c} IS NOT NULL)"
    return f"({c} != {sql_float_literal(nodata)})"


def sql_all_finite_not_nodata(pop_cols: list[str], nodata: float | None) -> str:
    return " AND ".join(f"({sql_not_nodata(c, nodata)} AND {sql_is_finite(c)})" for c in pop_cols)


def sql_any_positive(pop_cols: list[str]) -> str:
    return "(" + " OR ".join(f"({c} > CAST(0.0D AS FLOAT))" for c in pop_cols) + ")"


def all_finite_not_nodata(pop_cols: list[str], nodata: float | None) -> Column:
    return F.expr(sql_all_finite_not_nodata(pop_cols, nodata))


def any_positive(pop_cols: list[str]) -> Column:
    return F.expr(sql_any_positive(pop_cols))


def valid_mask(pop_cols: list[str], nodata: float | None) -> Column:
    """F4 & F5 & F6 as one Column; NULL (a missing year) counts as not valid."""
    if not pop_cols:
        raise ValueError("no population columns")
    return F.expr(
        f"coalesce(({sql_all_finite_not_nodata(pop_cols, nodata)}) AND {sql_any_positive(pop_cols)}, false)"
    )


def apply_mask(pixels: DataFrame, pop_cols: list[str], nodata: float | None) -> DataFrame:
    """keep valid pixels.

    Written as plain conjuncts (a filter drops NULL anyway), so Catalyst can
    hand the comparisons to the Parquet reader: ``pop_y != nodata`` and the
    disjunction ``pop_a > 0 OR pop_b > 0 ...`` become pushed filters, and row
    groups where every year is <= 0 (oceans, deserts) are skipped unread.
    """
    if not pop_cols:
        raise ValueError("no population columns")
    return pixels.where(any_positive(pop_cols)).where(all_finite_not_nodata(pop_cols, nodata))


def mask_counts(pixels: DataFrame, pop_cols: list[str], nodata: float | None) -> DataFrame:
    """How many pixels each rule removes (one row, one pass, partial aggregation).

    ``n_nodata``: some year equals nodata; ``n_nonfinite``: some year NaN/inf
    (other than a NaN or infinite nodata);
    ``n_no_positive``: all years finite and not nodata, but none > 0;
    ``n_valid``: kept by the mask.
    """
    has_nodata = " OR ".join(sql_is_nodata(c, nodata) for c in pop_cols)
    nonfinite = " OR ".join(f"(NOT {sql_is_finite(c)} AND NOT {sql_is_nodata(c, nodata)})" for c in pop_cols)
    clean = sql_all_finite_not_nodata(pop_cols, nodata)
    pos = sql_any_positive(pop_cols)
    return pixels.selectExpr(
        "count(1) AS n_pixels",
        f"count_if(coalesce({has_nodata}, false)) AS n_nodata",
        f"count_if(coalesce({nonfinite}, false)) AS n_nonfinite",
        f"count_if(coalesce(({clean}) AND NOT {pos}, false)) AS n_no_positive",
        f"count_if(coalesce(({clean}) AND {pos}, false)) AS n_valid",
    )
