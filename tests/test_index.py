"""Index invariants: brute-force sums, conservation, one cell per pixel, partition independence."""

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import index as X
from tessera.operators.mask import apply_mask
from tessera.plans import queries as Q
from tessera.sources.fixture import pixel_view

from .conftest import SF_SMALL
from .test_cells import np_cell


def _np_index(pdf, res):
    ok = np.ones(len(pdf), bool)
    for c in Q.POP:
        v = pdf[c].to_numpy(np.float32)
        ok &= (v != np.float32(Q.NODATA)) & np.isfinite(v)
    anyp = np.zeros(len(pdf), bool)
    for c in Q.POP:
        anyp |= pdf[c].to_numpy(np.float32) > 0
    ok &= anyp
    v = pdf[ok]
    ids = np_cell(v["lat"].to_numpy(), v["lon"].to_numpy(), res)
    out = {}
    for c in Q.POP:
        u, inv = np.unique(ids, return_inverse=True)
        out[c] = dict(zip(u.tolist(), np.bincount(inv, weights=v[c].to_numpy(np.float64)).astype(np.float32).tolist()))
    return out


def test_index_matches_numpy(spark):
    px = pixel_view(spark, SF_SMALL)
    pdf = px.toPandas()
    for res in (2, 5, 8):
        got = {r["h3_index"]: r for r in X.build_index(px, Q.POP, [res], Q.NODATA).collect()}
        exp = _np_index(pdf, res)
        assert set(got) == set(exp["pop_2025"]), res
        for c in Q.POP:
            assert all(got[k][c] == exp[c][k] for k in got), (res, c)


def test_conservation_and_uniqueness(spark):
    px = pixel_view(spark, SF_SMALL)
    idx = X.build_index(px, Q.POP, Q.ALL_RES, Q.NODATA)
    valid = apply_mask(px, Q.POP, Q.NODATA)
    tot = X.conservation_totals(idx, valid, Q.POP)
    spread = X.conservation_spread(tot, Q.POP).collect()[0]
    assert all(v == 0.0 for v in spread)
    assert idx.groupBy("h3_res", "h3_index").count().where("count > 1").count() == 0
    # each valid pixel lands in exactly one cell per resolution
    a = X.assign_cells(valid, Q.ALL_RES, keep=["pixel_id"])
    assert a.groupBy("pixel_id", "h3_res").count().where("count != 1").count() == 0
    assert a.count() == valid.count() * len(Q.ALL_RES)


def test_merge_independent_of_partitioning(spark):
    px = pixel_view(spark, SF_SMALL)
    a = X.build_index(px.repartition(1), Q.POP, [3, 6], Q.NODATA)
    b = X.build_index(px.repartition(13, "pixel_id"), Q.POP, [3, 6], Q.NODATA)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_cell_is_summed(spark):
    # a third of all rows in one pixel position: partial aggregation keeps it cheap and exact
    rows = [(i, 10.0, 20.0, 1.0, 2.0, 3.0) for i in range(3000)] + [
        (3000 + i, -40.0 + i * 0.01, 100.0, 1.0, 1.0, 1.0) for i in range(6000)
    ]
    df = spark.createDataFrame(rows, "pixel_id long, lat double, lon double, pop_2025 float, pop_2050 float, pop_2100 float")
    idx = X.build_index(df.repartition(8), Q.POP, [5], Q.NODATA)
    hot = idx.orderBy(F.desc("pop_2025")).first()
    assert hot["pop_2025"] == 3000.0 and hot["pop_2100"] == 9000.0
    assert idx.agg(F.sum("pop_2025")).collect()[0][0] == 9000.0


def test_cells_per_resolution_rollup(spark):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [1, 4], Q.NODATA)
    rows = {r["h3_res"]: r["n_cells"] for r in X.cells_per_resolution(idx).collect()}
    assert rows[None] == rows[1] + rows[4]


def test_validate_resolutions():
    import pytest

    assert X.validate_resolutions([3, 1, 3]) == [1, 3]
    with pytest.raises(ValueError):
        X.validate_resolutions([])
    with pytest.raises(ValueError):
        X.validate_resolutions([16])


def test_hot_window_counts(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    hot = [(float(a), float(b)) for a, b in zip(rng.uniform(40.1, 44.9, 3000), rng.uniform(10.1, 14.9, 3000))]
    rest = [(float(a), float(b)) for a, b in zip(rng.uniform(-60, 60, 6000), rng.uniform(-170, 170, 6000))]
    rows = [(i, la, lo, 1.0, 1.0, 1.0) for i, (la, lo) in enumerate(hot + rest)]
    df = spark.createDataFrame(rows, "pixel_id long, lat double, lon double, pop_2025 float, pop_2050 float, pop_2100 float")
    got = {(r["win_id"], r["h3_res"]): (r["n_pixels"], r["n_cells"]) for r in X.window_cell_counts(df.repartition(8), [3, 6]).collect()}
    wins = [f"w_{-180 + 5 * int((lo + 180) // 5):+08.1f}_{-90 + 5 * int((la + 90) // 5):+07.1f}" for _, la, lo, *_ in rows]
    assert got[("w_+00010.0_+0040.0", 3)][0] == wins.count("w_+00010.0_+0040.0") >= 3000
    exp = {}
    for res in (3, 6):
        ids = np_cell(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), res)
        for w, c in zip(wins, ids):
            n, cs = exp.setdefault((w, res), [0, set()])
            exp[(w, res)][0] = n + 1
            cs.add(int(c))
    assert got == {k: (n, len(cs)) for k, (n, cs) in exp.items()}
