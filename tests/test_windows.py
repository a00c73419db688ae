"""Builds by windows: stops, resumptions, and what is read for the rest."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.sinks import manifest as M
from tessera.sources.fixture import FIXTURE_GRID, pixel_view
from tessera.streaming import windows as W
from tessera.streaming.resumable import resumable_build

from .conftest import SF_MID, SF_SMALL

RES = [2, 4]


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _run(spark, work, staged="pixels", key="k", sf=SF_SMALL):
    px = pixel_view(spark, sf).select("lat", "lon", *Q.POP)
    return px, W.WindowRun(spark, os.path.join(work, staged), px.schema, Q.POP, RES, Q.NODATA, work, key)


def test_finished_windows_are_not_read_again(spark, tmp_dir):
    px, run = _run(spark, tmp_dir, sf=SF_MID)
    W.stage_by_window(px, run.staged)
    assert run.pending().count() == 2592
    size = W.staged_bytes(spark, run.staged).agg(F.sum("bytes")).first()[0] // 5
    assert run.run(size, max_batches=2) == 2
    done = {r[0] for r in run.manifest().select("win_id").collect()}
    assert 0 < len(done) < 2592
    # the folders of bands that are finished as a whole go: nothing reads them any more
    left = {r[0] // W.BAND_WINDOWS for r in run.pending().select(W.WINDOW).collect()}
    gone = [d for d in os.listdir(run.staged) if d.startswith(W.BAND) and int(d.split("=")[1]) not in left]
    assert gone
    for d in gone:
        shutil.rmtree(os.path.join(run.staged, d))
    _, again = _run(spark, tmp_dir)
    assert again.run(size) >= 2 and again.pending().isEmpty()
    assert _same(again.index(), X.build_index(px, Q.POP, RES, Q.NODATA))
    # every window once, and those of the first attempt still by it
    assert again.manifest().groupBy("win_id").count().where("count <> 1").isEmpty()
    assert again.run(size) == 0


def test_read_prunes_bands_and_pushes_the_window_range(spark, tmp_dir):
    px, run = _run(spark, tmp_dir)
    W.stage_by_window(px, run.staged)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = run.read([100, 101, 103])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{W.BAND}" in plan or f"PartitionFilters: [isnotnull({W.BAND}" in plan
    assert f"GreaterThanOrEqual({W.WINDOW},100)" in plan and f"LessThanOrEqual({W.WINDOW},103)" in plan and "Exchange" not in plan
    rows = run.read([100, 101, 103]).select(W.WINDOW).distinct().collect()
    assert {r[0] for r in rows} <= {100, 101, 103}


def test_attempt_without_commit_does_not_count(spark, tmp_dir):
    px, run = _run(spark, tmp_dir)
    W.stage_by_window(px, run.staged)
    # a batch that died after its partial sums, another that died while writing them
    W.window_partials(run.read([w for b in run._batches(1 << 40) for w in b]), Q.POP, RES, Q.NODATA).write.parquet(f"{run.partials}/attempt=dead")
    os.makedirs(f"{run.partials}/attempt=half/_temporary/0")
    run.run()
    assert _same(run.index(), X.build_index(px, Q.POP, RES, Q.NODATA))


def test_another_key_shares_nothing(spark, tmp_dir):
    px, run = _run(spark, tmp_dir)
    W.stage_by_window(px, run.staged)
    run.run()
    _, other = _run(spark, tmp_dir, key="other")
    assert other.pending().count() == 2592 and other.index().count() == 0


def test_no_pixels_at_all(spark, tmp_dir):
    px, run = _run(spark, tmp_dir)
    W.stage_by_window(px.where("lat > 100"), run.staged)
    run.run()
    assert run.pending().isEmpty() and run.index().count() == 0
    counts = {r["status"]: r["count"] for r in run.manifest().groupBy("status").count().collect()}
    assert counts == {M.STATUS_NO_DATA: 2592}


def test_window_with_a_third_of_all_pixels_is_dealt_over_files(spark, tmp_dir):
    hot = spark.range(40_000).selectExpr("10.0 + (id % 200) * 0.02 AS lat", "20.0 + (id div 200) * 0.02 AS lon", *[f"CAST(id % 7 AS FLOAT) AS {p}" for p in Q.POP])
    rest = pixel_view(spark, SF_SMALL).select("lat", "lon", *Q.POP)
    px = hot.union(rest).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        W.stage_by_window(px, f"{tmp_dir}/pixels")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    band = spark.read.parquet(f"{tmp_dir}/pixels").where(f"{W.BAND} = 40")
    assert band.select(F.input_file_name()).distinct().count() > 1
    _, run = _run(spark, tmp_dir)
    run.run(1 << 14)
    assert _same(run.index(), X.build_index(px, Q.POP, RES, Q.NODATA))


def test_build_stops_and_resumes_with_rewritten_input(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    out = os.path.join(tmp_dir, "out")
    job = lambda df, **how: resumable_build(spark, df, "release 1", FIXTURE_GRID, [2025, 2050, 2100], out, "SSP2", RES, **how)
    px.write.parquet(os.path.join(tmp_dir, "a"))
    assert job(spark.read.parquet(os.path.join(tmp_dir, "a")), max_bytes_per_batch=4096, max_batches=2) is None
    assert not os.path.exists(os.path.join(out, "_COMPLETE_SSP2"))
    px.repartition(3).write.parquet(os.path.join(tmp_dir, "b"))  # the same pixels in other files
    got = job(spark.read.parquet(os.path.join(tmp_dir, "b"))).select("h3_res", "h3_index", *Q.POP)
    assert _same(got, X.build_index(px, Q.POP, RES, Q.NODATA))
    assert os.path.exists(os.path.join(out, "_COMPLETE_SSP2"))


@pytest.mark.parametrize("win", [0, 1, 35, 36, 2591])
def test_lattice_rows_carry_their_number(spark, win):
    run = W.WindowRun(spark, "x", pixel_view(spark, SF_SMALL).schema, Q.POP, RES, Q.NODATA, "x", "k")
    row = run.lattice().where(F.col(W.WINDOW) == win).collect()
    assert len(row) == 1
    assert run.lattice().select(W.WINDOW).distinct().count() == 2592
