"""Versions of a published index: what readers see while, between and after builds."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.plans.build import build_population_index, marker_path, publish_index, stage_index
from tessera.sinks import snapshots as S
from tessera.sinks.metadata import METADATA_SCHEMA
from tessera.sinks.parquet import write_index
from tessera.sources.fixture import FIXTURE_GRID, pixel_view
from tessera.sources.index_reader import list_files, read_index, read_index_files, read_snapshot
from tessera.streaming.resumable import resumable_build

from .conftest import SF_SMALL

YEARS = [2025, 2050, 2100]


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _metadata(spark, base, scenario="SSP2"):
    root = S.current(spark, base, scenario).root
    return spark.read.schema(METADATA_SCHEMA).json(f"{root}/scenario={scenario}/_index_metadata.json").first().asDict(recursive=True)


def test_rerun_replaces_all_of_the_first(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px, FIXTURE_GRID, YEARS, tmp_dir, "SSP2", [1, 2, 3, 4])
    opened = read_index(spark, tmp_dir, "SSP2")
    before = opened.groupBy("h3_res").agg(F.sum("pop_2100")).collect()
    second = build_population_index(spark, px.where("lat > 0"), FIXTURE_GRID, [2025], tmp_dir, "SSP2", [1, 2])
    got = read_index(spark, tmp_dir, "SSP2")
    assert got.columns == ["h3_index", "pop_2025", "scenario", "h3_res"] and _same(got, second)
    want = X.build_index(px.where("lat > 0"), ["pop_2025"], [1, 2], Q.NODATA)
    assert _same(got.select("h3_res", "h3_index", "pop_2025"), want)
    meta = _metadata(spark, tmp_dir)
    assert meta["h3_resolutions"] == [1, 2] and meta["years"] == [2025]
    counts = {k: v for k, v in meta["cells_per_resolution"].items() if v is not None}
    assert counts == {str(r["h3_res"]): r["count"] for r in got.groupBy("h3_res").count().collect()}
    # files of the current version only, by any reader of the library
    assert all(f"/{S.current(spark, tmp_dir, 'SSP2').version}/" in f["path"] for f in list_files(spark, tmp_dir).collect())
    assert read_index_files(spark, tmp_dir).count() == got.count()
    # one who opened the first version still reads it
    assert sorted(map(tuple, opened.groupBy("h3_res").agg(F.sum("pop_2100")).collect())) == sorted(map(tuple, before))
    assert [h.resolutions for h in S.history(spark, tmp_dir, "SSP2")] == [[1, 2, 3, 4], [1, 2]]


def test_crash_between_write_and_swap(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    first = build_population_index(spark, px, FIXTURE_GRID, YEARS, tmp_dir, "SSP2", [2])
    marker = open(marker_path(tmp_dir, "SSP2")).read()
    staged = stage_index(spark, X.build_index(px, ["pop_2025"], [1], Q.NODATA), tmp_dir, "SSP2", [2025], [1], FIXTURE_GRID)
    assert _same(read_index(spark, tmp_dir, "SSP2"), first) and open(marker_path(tmp_dir, "SSP2")).read() == marker
    assert S.current(spark, tmp_dir, "SSP2").version in marker
    # a version that was not written to its end can't be committed
    os.remove(os.path.join(staged.root, "_SUCCESS"))
    with pytest.raises(ValueError, match="to its end"):
        S.commit(spark, tmp_dir, staged)
    # a crash while the pointer is being written leaves a temporary name, which no reader takes for one
    folder = os.path.join(tmp_dir, S.POINTERS, "SSP2")
    with open(os.path.join(folder, "_tmp-x"), "w") as f:
        f.write('{"vers')
    assert _same(read_index(spark, tmp_dir, "SSP2"), first)


def test_two_builds_that_commit_at_once(spark, tmp_dir, monkeypatch):
    px = pixel_view(spark, SF_SMALL)
    a, b = (stage_index(spark, X.build_index(px, ["pop_2025"], [r], Q.NODATA), tmp_dir, "SSP2", [2025], [r], FIXTURE_GRID) for r in (1, 2))
    assert read_or_none(spark, tmp_dir) is None
    S.commit(spark, tmp_dir, a)
    real = S._numbers
    monkeypatch.setattr(S, "_numbers", lambda *x: [])  # b looked before a had committed
    b = S.commit(spark, tmp_dir, b)
    monkeypatch.setattr(S, "_numbers", real)
    assert b.number == 2 and S.current(spark, tmp_dir, "SSP2").resolutions == [2]
    assert [h.version for h in S.history(spark, tmp_dir, "SSP2")] == [a.version, b.version]


def read_or_none(spark, base):
    return S.current(spark, base, "SSP2")


def test_expire_keeps_the_newest_and_spares_running_builds(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    for res in (1, 2, 3):
        build_population_index(spark, px, FIXTURE_GRID, [2025], tmp_dir, "SSP2", [res])
    running = stage_index(spark, X.build_index(px, ["pop_2025"], [1], Q.NODATA), tmp_dir, "SSP2", [2025], [1], FIXTURE_GRID)
    assert len(S.expire(spark, tmp_dir, "SSP2", keep=2)) == 1
    assert [h.resolutions for h in S.history(spark, tmp_dir, "SSP2")] == [[2], [3]] and os.path.isdir(running.root)
    assert S.expire(spark, tmp_dir, "SSP2", keep=1, idle_hours=-1.0)  # the crashed one and the one before
    assert not os.path.isdir(running.root) and read_index(spark, tmp_dir, "SSP2").count() > 0
    with pytest.raises(ValueError):
        S.expire(spark, tmp_dir, "SSP2", keep=0)


def test_empty_index_is_published(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px, FIXTURE_GRID, [2025], tmp_dir, "SSP2", [1])
    out = build_population_index(spark, px.where("lat > 100"), FIXTURE_GRID, YEARS, tmp_dir, "SSP2", [1, 2])
    assert out.count() == 0 and read_index(spark, tmp_dir, "SSP2").columns == out.columns
    meta = _metadata(spark, tmp_dir)
    assert not any((meta["cells_per_resolution"] or {}).values()) and meta["h3_resolutions"] == [1, 2]


def test_metadata_is_observed_by_the_write(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    out = build_population_index(spark, px, FIXTURE_GRID, YEARS, tmp_dir, "SSP2", [1, 5])
    meta = _metadata(spark, tmp_dir)
    for r in out.groupBy("h3_res").agg(F.count(F.lit(1)).alias("n"), F.min("h3_index").alias("a"), F.max("h3_index").alias("b"), F.sum(F.col("pop_2050").cast("double")).alias("s")).collect():
        k = str(r["h3_res"])
        assert meta["cells_per_resolution"][k] == r["n"] and meta["totals_per_resolution"][k]["pop_2050"] == r["s"]
        assert (meta["ids_per_resolution"][k]["first"], meta["ids_per_resolution"][k]["last"]) == (r["a"], r["b"])
    # the statistics add no exchange or sort to the write
    df = X.build_index(px, Q.POP, [1, 5], Q.NODATA)
    plan = []
    for observe in (None, True):
        from pyspark.sql import Observation

        from tessera.sinks.metadata import write_statistics
        from tessera.sinks.parquet import sorted_for_write

        rows = sorted_for_write(df)
        rows = rows.observe(Observation(), *write_statistics(Q.POP, [1, 5])) if observe else rows
        text = rows._jdf.queryExecution().executedPlan().toString()
        plan.append((text.count("Exchange"), text.count("Sort ["), text.count("FileScan")))
    assert plan[0] == plan[1]


def test_scenarios_with_unlike_years_read_together(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px, FIXTURE_GRID, [2025], tmp_dir, "SSP1", [2])
    build_population_index(spark, px, FIXTURE_GRID, [2050, 2100], tmp_dir, "SSP2", [1, 2])
    both = read_index(spark, tmp_dir)
    assert {"pop_2025", "pop_2050", "pop_2100"} <= set(both.columns)
    assert both.where("scenario = 'SSP1' AND pop_2050 IS NOT NULL").count() == 0
    assert read_index(spark, tmp_dir, res=1).select("scenario").distinct().collect()[0][0] == "SSP2"


def test_plain_folders_are_read_as_they_lie(spark, tmp_dir):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [2], Q.NODATA)
    write_index(idx, tmp_dir, "SSP3")
    assert S.scenarios(spark, tmp_dir) == [] and read_index(spark, tmp_dir, "SSP3", 2).count() == idx.count()
    with pytest.raises(Exception, match="already exists"):
        write_index(idx, tmp_dir, "SSP3", fresh=True)


def test_resumable_publishes_again_after_another_build(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    job = lambda: resumable_build(spark, px, "again", FIXTURE_GRID, YEARS, tmp_dir, "SSP2", [2])
    want = job().drop("scenario").collect()
    publish_index(spark, X.build_index(px.where("lat > 60"), Q.POP, [2], Q.NODATA), tmp_dir, "SSP2", YEARS, [2], FIXTURE_GRID)
    assert sorted(job().drop("scenario").collect()) == sorted(want)
    n = len(S.history(spark, tmp_dir, "SSP2"))
    assert sorted(job().drop("scenario").collect()) == sorted(want) and len(S.history(spark, tmp_dir, "SSP2")) == n  # nothing to do


def test_read_snapshot_of_history(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px, FIXTURE_GRID, YEARS, tmp_dir, "SSP2", [1, 2])
    build_population_index(spark, px, FIXTURE_GRID, [2025], tmp_dir, "SSP2", [3])
    old = S.history(spark, tmp_dir, "SSP2")[0]
    assert read_snapshot(spark, old, 2).count() == X.build_index(px, Q.POP, [2], Q.NODATA).count()
