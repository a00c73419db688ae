"""One hand-made row per trap of the validity mask."""

import math

from tessera.operators.mask import apply_mask, mask_counts

NODATA = -99999.0
POP = ["pop_2025", "pop_2050", "pop_2100"]
NAN, INF = float("nan"), float("inf")

CASES = [
    ("one year nodata", (5.0, NODATA, 5.0), False),
    ("one year NaN", (5.0, NAN, 5.0), False),
    ("one year infinite", (5.0, INF, 5.0), False),
    ("NaN the only positive", (0.0, NAN, 0.0), False),
    ("all zero", (0.0, 0.0, 0.0), False),
    ("negative with a positive", (-5.0, 3.0, 0.0), True),
    ("all negative", (-5.0, -1.0, -2.0), False),
    ("plain", (1.0, 2.0, 3.0), True),
    ("null year", (1.0, None, 3.0), False),
]


def _df(spark):
    rows = [(i, *vals) for i, (_, vals, _) in enumerate(CASES)]
    return spark.createDataFrame(rows, "id int, pop_2025 float, pop_2050 float, pop_2100 float")


def test_mask_cases(spark):
    kept = {r["id"] for r in apply_mask(_df(spark), POP, NODATA).collect()}
    for i, (name, _, expect) in enumerate(CASES):
        assert (i in kept) == expect, name


def test_nodata_compared_in_float(spark):
    # 0.1 is not exact in FLOAT: the nodata literal must be cast to FLOAT to match
    df = spark.createDataFrame([(0.1, 1.0, 1.0)], "pop_2025 float, pop_2050 float, pop_2100 float")
    assert apply_mask(df, POP, 0.1).count() == 0


def test_no_nodata_value(spark):
    df = spark.createDataFrame([(NODATA, 1.0, 1.0)], "pop_2025 float, pop_2050 float, pop_2100 float")
    assert apply_mask(df, POP, None).count() == 1


def test_mask_counts(spark):
    r = mask_counts(_df(spark), POP, NODATA).collect()[0]
    assert r["n_pixels"] == len(CASES)
    assert r["n_valid"] == sum(1 for c in CASES if c[2])
    assert r["n_nodata"] == 1
    assert r["n_nonfinite"] == 3
    assert r["n_no_positive"] == 2
    assert not math.isnan(r["n_valid"])


def test_mask_matches_numpy(spark):
    import numpy as np
    from hypothesis import given, settings
    from hypothesis import strategies as st

    val = st.one_of(
        st.sampled_from([NODATA, NAN, INF, -INF, 0.0, -0.0, -5.0, 1.0]),
        st.floats(min_value=-1e6, max_value=1e6, width=32),
    )

    @settings(max_examples=25, deadline=None, derandomize=True)
    @given(st.lists(st.tuples(val, val, val), min_size=1, max_size=80))
    def check(rows):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, pop_2025 float, pop_2050 float, pop_2100 float")
        kept = {r["id"] for r in apply_mask(df, POP, NODATA).collect()}
        a = np.array(rows, dtype=np.float32)
        ok = np.all((a != np.float32(NODATA)) & np.isfinite(a), axis=1) & np.any(a > 0, axis=1)
        assert kept == set(np.nonzero(ok)[0].tolist())

    check()


def test_valid_mask_column_agrees_with_filter(spark):
    from pyspark.sql import functions as F

    from tessera.operators.mask import valid_mask

    df = _df(spark)
    n = df.agg(F.count_if(valid_mask(POP, NODATA))).first()[0]
    assert n == apply_mask(df, POP, NODATA).count()
