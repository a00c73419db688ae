import math

from pyspark.sql import functions as F

from tessera.functions.num import float_div, is_finite, round_to_bigint


def test_float_div_ieee(spark):
    df = spark.createDataFrame(
        [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, 2.0), (None, 1.0), (1.0, None), (7.0, 0.0)],
        "n float, d float",
    )
    out = [r[0] for r in df.select(float_div("n", "d")).collect()]
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2])
    assert out[3] == 0.5 and out[4] is None and out[5] is None and out[6] == math.inf
    assert df.select(float_div("n", "d").alias("x")).schema["x"].dataType.simpleString() == "float"


def test_round_half_even(spark):
    df = spark.createDataFrame([(1.7,), (2.5,), (3.5,), (-1.5,), (-2.5,), (0.5,)], "x double")
    assert [r[0] for r in df.select(round_to_bigint("x")).collect()] == [2, 2, 4, -2, -2, 0]


def test_is_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x float")
    assert [r[0] for r in df.select(is_finite(F.col("x"))).collect()] == [True, False, False, False]


def test_float_div_matches_numpy_float32(spark):
    import numpy as np
    from hypothesis import given, settings
    from hypothesis import strategies as st

    floats = st.floats(width=32, allow_nan=True, allow_infinity=True)
    rows_st = st.lists(st.tuples(floats, floats), min_size=1, max_size=60)

    @settings(max_examples=25, deadline=None, derandomize=True)
    @given(rows_st)
    def check(rows):
        df = spark.createDataFrame(rows, "n float, d float")
        got = [r[0] for r in df.select(float_div("n", "d")).collect()]
        with np.errstate(all="ignore"):
            exp = [np.float32(n) / np.float32(d) for n, d in rows]
        for g, e in zip(got, exp):
            assert (math.isnan(g) and math.isnan(e)) or g == float(e)

    check()


def test_round_to_bigint_matches_numpy_rint(spark):
    import numpy as np
    from hypothesis import given, settings
    from hypothesis import strategies as st

    @settings(max_examples=25, deadline=None, derandomize=True)
    @given(st.lists(st.floats(min_value=-1e12, max_value=1e12), min_size=1, max_size=60))
    def check(xs):
        df = spark.createDataFrame([(x,) for x in xs], "x double")
        got = [r[0] for r in df.select(round_to_bigint("x")).collect()]
        assert got == [int(np.rint(x)) for x in xs]

    check()


def test_float_div_signed_zero_column_and_text(spark):
    df = spark.createDataFrame([(1.0, -0.0), (-1.0, -0.0), (-2.0, 0.0), (0.0, -0.0)], "n float, d float")
    for got in ([r[0] for r in df.select(float_div("n", "d")).collect()],
                [r[0] for r in df.select(float_div(F.col("n"), F.col("d"))).collect()]):
        assert got[:3] == [float("-inf"), float("inf"), float("-inf")] and math.isnan(got[3])


def test_float_div_nan_numerator(spark):
    df = spark.createDataFrame([(float("nan"), 0.0), (float("nan"), -0.0), (float("nan"), 2.0)], "n float, d float")
    for col in (float_div("n", "d"), float_div(F.col("n"), F.col("d"))):
        assert all(math.isnan(r[0]) for r in df.select(col).collect())
