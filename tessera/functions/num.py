"""Numeric rules that differ between Spark's defaults and the expected results.

* ``float_div``  -- FLOAT division with IEEE results on a zero divisor
  (x/0 -> +/-inf, 0/0 -> NaN) instead of an ANSI error or NULL.
* ``round_to_bigint`` -- DOUBLE -> BIGINT rounding half to even
  (1.7 -> 2, 2.5 -> 2, 3.5 -> 4) instead of Spark's truncation.
* ``is_finite`` -- neither NaN nor +/-inf.

All are plain Column expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_float_div(num: str, den: str) -> str:
    """IEEE quotient: on a zero divisor the sign is sign(n) x sign of the zero
    (``pow(d, -1)`` is -inf exactly for -0.0; Spark's ``atan2`` normalizes
    signed zeros, so it cannot tell); 0/0 and NaN/0 are NaN -- tested first,
    since Spark orders NaN above every number."""
    n, d = f"CAST(({num}) AS DOUBLE)", f"CAST(({den}) AS DOUBLE)"
    neg_zero = f"(pow({d}, -1.0D) < 0)"
    return (
        f"CAST(CASE WHEN {n} IS NULL OR {d} IS NULL THEN CAST(NULL AS DOUBLE) "
        f"WHEN {d} = 0 THEN (CASE WHEN isnan({n}) OR {n} = 0 THEN CAST('NaN' AS DOUBLE) "
        f"WHEN ({n} > 0) != {neg_zero} THEN CAST('Infinity' AS DOUBLE) "
        f"ELSE CAST('-Infinity' AS DOUBLE) END) "
        f"ELSE {n} / {d} END AS FLOAT)"
    )


def sql_is_finite(c: str) -> str:
    return f"(NOT isnan({c}) AND abs(CAST(({c}) AS DOUBLE)) != CAST('Infinity' AS DOUBLE))"


def float_div(num, den) -> Column:
    """``num / den`` as FLOAT with IEEE semantics on a zero divisor.

    Division is carried out in DOUBLE and rounded once to FLOAT; for two
    FLOAT operands that equals the correctly rounded FLOAT quotient.
    NULL in either operand gives NULL. Column names / SQL text are parsed
    in one step; Columns are combined operator by operator.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(sql_float_div(num, den))
    n = _col(num).cast("double")
    d = _col(den).cast("double")
    neg_zero = F.pow(d, F.lit(-1.0)) < 0  # -inf exactly for -0.0
    # Spark orders NaN above every number (NaN > 0 is true): test it first
    by_zero = (
        F.when(F.isnan(n) | (n == 0), F.lit(NAN))
        .when((n > 0) != neg_zero, F.lit(INF))
        .otherwise(F.lit(-INF))
    )
    return (
        F.when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
        .when(d == 0, by_zero)
        .otherwise(n / d)
        .cast("float")
    )


def round_to_bigint(x) -> Column:
    """DOUBLE -> BIGINT, rounding half to even (``rint``)."""
    return F.rint(_col(x).cast("double")).cast("bigint")


def is_finite(x) -> Column:
    """True when ``x`` is neither NaN nor infinite (NULL stays NULL)."""
    if isinstance(x, str):
        return F.expr(sql_is_finite(x))
    c = x
    return ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(INF))


def sql_float_literal(x: float) -> str:
    """A FLOAT literal, also for NaN and the infinities."""
    x = float(x)
    text = f"{x!r}D" if math.isfinite(x) else "'NaN'" if math.isnan(x) else "'Infinity'" if x > 0 else "'-Infinity'"
    return f"CAST({text} AS FLOAT)"
