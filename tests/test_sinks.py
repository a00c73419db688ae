"""Sinks and sources: sorted zstd layout, row-group cap, readback, metadata, manifest, catalog."""

import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.plans.build import build_population_index, parse_resolutions, plan_index, validate_scenario
from tessera.sinks import manifest as M
from tessera.sinks.parquet import write_index
from tessera.sinks.snapshots import current
from tessera.sources.catalog import catalog_from_paths, check_catalog, discover_rasters, multiband_catalog
from tessera.sources.fixture import FIXTURE_GRID, pixel_view
from tessera.sources.index_reader import describe, list_files, read_index, read_index_files
from tessera.sources.layout import layout_audit

from .conftest import SF_SMALL


def test_write_sorted_zstd_row_groups(spark, tmp_dir):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [5, 8], Q.NODATA)
    write_index(idx, tmp_dir, "SSP2", n_partitions=3, row_group_rows=100)
    files = list_files(spark, tmp_dir).collect()
    assert files and all("scenario=SSP2/h3_res=" in f["path"] for f in files)
    audit = layout_audit(list_files(spark, tmp_dir))
    assert audit.where("codec != 'ZSTD'").count() == 0
    assert audit.agg(F.max("n_rows")).collect()[0][0] <= 100
    # every file sorted; files of one resolution hold disjoint increasing ranges
    for res in (5, 8):
        d = os.path.join(tmp_dir, "scenario=SSP2", f"h3_res={res}")
        parts = sorted(p for p in os.listdir(d) if p.endswith(".parquet"))
        prev_max = None
        for p in parts:
            ids = pq.read_table(os.path.join(d, p), columns=["h3_index"]).column(0).to_pylist()
            if not ids:
                continue
            assert ids == sorted(ids)
            assert prev_max is None or ids[0] > prev_max
            prev_max = ids[-1]
    back = read_index(spark, tmp_dir, "SSP2", 5).drop("scenario", "h3_res")
    exp = idx.where("h3_res = 5").drop("h3_res")
    assert back.exceptAll(exp).count() == 0 and exp.exceptAll(back).count() == 0
    assert "scenario" not in read_index_files(spark, tmp_dir).columns


def test_bbox_pushdown_reaches_scan(spark, tmp_dir):
    from tessera.operators.analytics import where_bbox

    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [5], Q.NODATA)
    write_index(idx, tmp_dir, "SSP2")
    df = where_bbox(read_index(spark, tmp_dir, "SSP2", 5), -30, 30, 55, 70, res=5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(h3_index" in plan
    assert "PartitionFilters" in plan


def test_build_job_and_metadata(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    out = build_population_index(spark, px, FIXTURE_GRID, [2025, 2050, 2100], tmp_dir, "SSP2", [1, 5])
    assert os.path.exists(os.path.join(tmp_dir, "_COMPLETE_SSP2"))
    assert M.has_marker(spark, os.path.join(tmp_dir, "_COMPLETE_SSP2"))
    meta_dir = os.path.join(current(spark, tmp_dir, "SSP2").root, "scenario=SSP2", "_index_metadata.json")
    [jf] = [f for f in os.listdir(meta_dir) if f.endswith(".json")]
    meta = json.loads(open(os.path.join(meta_dir, jf)).read())
    counts = {int(k): v for k, v in meta["cells_per_resolution"].items()}
    assert counts == {r["h3_res"]: r["count"] for r in out.groupBy("h3_res").count().collect()}
    assert meta["years"] == [2025, 2050, 2100] and meta["h3_resolutions"] == [1, 5]
    assert read_index(spark, tmp_dir, "SSP2").count() == out.count()  # metadata is not data


def test_job_parameters(spark):
    import pytest

    assert validate_scenario("SSP5") == "SSP5"
    with pytest.raises(ValueError):
        validate_scenario("SSP9")
    assert parse_resolutions("8,1,5") == [1, 5, 8]
    plan = plan_index(spark, [2025, 2030], [1, 2, 3])
    r = plan.first()
    assert plan.count() == 2592 and r["n_years"] == 2 and r["n_resolutions"] == 3


def test_manifest_resume(spark, tmp_dir):
    key = M.run_key("SSP2", [2025], [5], FIXTURE_GRID, "x")
    assert key != M.run_key("SSP3", [2025], [5], FIXTURE_GRID, "x")
    wins = spark.createDataFrame([("a",), ("b",), ("c",)], "win_id string")
    path = os.path.join(tmp_dir, "manifest")
    M.append_manifest(M.manifest_rows(wins.where("win_id = 'a'"), key, M.STATUS_DONE), path)
    M.append_manifest(M.manifest_rows(wins.where("win_id = 'b'"), "other-run", M.STATUS_DONE), path)
    pend = {r[0] for r in M.pending_windows(wins, M.read_manifest(spark, path), key).collect()}
    assert pend == {"b", "c"}
    counts = {r["status"]: r["n_windows"] for r in M.window_status_counts(
        M.window_outcomes(wins, spark.createDataFrame([("a", 3)], "win_id string, n_valid long"))
    ).collect()}
    assert counts == {"done": 1, "skipped_no_data": 2}


def test_catalog(spark, tmp_dir):
    for name in ["pop_ssp2_2030.tif", "pop_ssp2_2025.tif", "readme.tif", "x2101y.tif", "pop_2100.txt"]:
        open(os.path.join(tmp_dir, name), "w").write("x")
    os.makedirs(os.path.join(tmp_dir, "sub"))
    open(os.path.join(tmp_dir, "sub", "b_2050.tif"), "w").write("x")
    cat = discover_rasters(spark, tmp_dir).collect()
    assert [r["year"] for r in cat] == [2025, 2030, 2050, 2101]
    assert all(r["band"] == 1 for r in cat)
    assert check_catalog(discover_rasters(spark, tmp_dir)) == [2025, 2030, 2050, 2101]
    paths = spark.createDataFrame([("a/2025.tif",), ("b/p2025.tif",)], "path string")
    import pytest

    with pytest.raises(ValueError):
        check_catalog(catalog_from_paths(paths))
    bands = spark.createDataFrame(
        [("f.tif", 1, "SSP2 2025"), ("f.tif", 2, None), ("f.tif", 3, "no year")], "path string, band int, description string"
    )
    assert [(r["year"], r["band"]) for r in multiband_catalog(bands).collect()] == [(2025, 1), (2025, 2), (2030, 3)]


def test_describe(spark):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [5], Q.NODATA)
    d = {r["column_name"]: r["column_type"] for r in describe(spark, idx).collect()}
    assert d["h3_index"] == "BIGINT" and d["pop_2025"] == "FLOAT" and d["h3_res"] == "INTEGER"


def test_legacy_layout_and_geometry_row(spark, tmp_dir):
    """Legacy columns with a WKB point, and the literal smoke row."""
    from tessera.functions.geometry import point_wkb, wkb_to_lonlat
    from tessera.sinks.parquet import write_legacy_index

    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [2], Q.NODATA)
    write_legacy_index(idx, tmp_dir, "SSP2")
    v1 = read_index(spark, tmp_dir, "SSP2", 2)
    assert [f.name for f in v1.schema.fields][:5] == ["h3_index", "geometry", "lat", "lon", "area_km2"]
    r = v1.first()
    lon, lat = wkb_to_lonlat(bytes(r["geometry"]))
    assert abs(lat - r["lat"]) < 1e-4 and abs(lon - r["lon"]) < 1e-4
    assert v1.count() == idx.count()
    # the literal smoke row: string id, point, FLOAT lat/lon/pop, zstd Parquet
    row = spark.createDataFrame([("8928308280fffff", 40.730, -73.935, 1000000.0)], "h3_index string, lat double, lon double, pop_2025 double")
    lit = row.select(
        "h3_index", point_wkb("lon", "lat").alias("geometry"),
        F.col("lat").cast("float").alias("lat"), F.col("lon").cast("float").alias("lon"),
        F.col("pop_2025").cast("float").alias("pop_2025"),
    )
    p = os.path.join(tmp_dir, "smoke")
    lit.write.option("compression", "zstd").parquet(p)
    aud = layout_audit(list_files(spark, p)).collect()
    assert {a["column"] for a in aud} == {"h3_index", "geometry", "lat", "lon", "pop_2025"}
    assert {a["physical_type"] for a in aud if a["column"] == "geometry"} == {"BYTE_ARRAY"}
    assert not any(a["has_geo"] for a in aud)


def test_cli_dry_run_and_build(spark, tmp_dir, capsys):
    from tessera.plans.cli import main as cli

    px = pixel_view(spark, SF_SMALL).select("lat", "lon", *Q.POP)
    src = os.path.join(tmp_dir, "px")
    px.write.parquet(src)
    cli(["--pixels", src, "--out", os.path.join(tmp_dir, "out"), "--dry-run", "--resolutions", "1,2"])
    assert "2592 windows x 3 years x 2 resolutions" in capsys.readouterr().out
    cli(["--pixels", src, "--out", os.path.join(tmp_dir, "out"), "--resolutions", "1,2"])
    assert "res  2:" in capsys.readouterr().out
    assert os.path.exists(os.path.join(tmp_dir, "out", "_COMPLETE_SSP2"))


def test_diagnostics_report(spark, tmp_dir):
    from tessera.plans.diagnostics import run_diagnostics

    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [2, 4], Q.NODATA)
    write_index(idx, tmp_dir, "SSP2")
    rep = run_diagnostics(spark, tmp_dir, "SSP2")
    assert {r["h3_res"] for r in rep["extent"].collect()} == {2, 4}
    assert rep["population"].count() == 2 * 3
    top = rep["top_cells"].collect()
    assert 0 < len(top) <= 10 and all(r["h3_hex"] for r in top)
    best = idx.where("h3_res = 2").agg(F.max("pop_2025")).first()[0]
    assert top[0]["pop_2025"] == best
    assert rep["files"].count() > 0 and rep["layout"].count() > 0
    assert {r["column_name"] for r in rep["schema"].collect()} >= {"h3_index", "pop_2025", "h3_res"}


def test_write_pixel_table_clusters_by_window(spark, tmp_dir):
    from tessera.sinks.parquet import write_pixel_table
    from tessera.sources.grid import window_index

    px = pixel_view(spark, SF_SMALL)
    write_pixel_table(px.repartition(5), tmp_dir)
    back = spark.read.parquet(tmp_dir)
    assert back.count() == px.count()
    # each file holds a contiguous run of windows: no window is split over many files
    per_win = back.select(window_index("lat", "lon").alias("w"), F.input_file_name().alias("f")).distinct()
    assert per_win.groupBy("w").count().where("count > 2").count() == 0
    idx_a = X.build_index(back, Q.POP, [4], Q.NODATA)
    idx_b = X.build_index(px, Q.POP, [4], Q.NODATA)
    assert idx_a.exceptAll(idx_b).count() == 0


def test_cli_tiles_and_resumable(spark, tmp_dir, capsys):
    import dataclasses

    from tessera.plans.cli import main as cli
    from tessera.sources.grid import pixels_to_tiles, unstack_years

    px = pixel_view(spark, SF_SMALL)
    tiles = pixels_to_tiles(unstack_years(px, ["r", "c"], [2025, 2050, 2100]), 64, -99999.0)
    tdir = os.path.join(tmp_dir, "tiles")
    tiles.write.parquet(tdir)
    gpath = os.path.join(tmp_dir, "grid.json")
    with open(gpath, "w") as f:
        json.dump(dataclasses.asdict(FIXTURE_GRID), f)
    out = os.path.join(tmp_dir, "out_tiles")
    cli(["--tiles", tdir, "--tile-size", "64", "--grid", gpath, "--out", out, "--resolutions", "2,4"])
    exp = X.build_index(px, Q.POP, [2, 4], Q.NODATA)
    got = read_index(spark, out, "SSP2").select("h3_res", "h3_index", *Q.POP)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0

    src = os.path.join(tmp_dir, "px")
    px.select("lat", "lon", *Q.POP).repartition(3).write.parquet(src)
    out2 = os.path.join(tmp_dir, "out_resumable")
    cli(["--pixels", src, "--out", out2, "--resolutions", "3", "--resumable"])
    got2 = read_index(spark, out2, "SSP2").select("h3_res", "h3_index", *Q.POP)
    exp2 = X.build_index(px, Q.POP, [3], Q.NODATA)
    assert got2.exceptAll(exp2).count() == 0 and exp2.exceptAll(got2).count() == 0
    assert os.path.exists(os.path.join(out2, "_COMPLETE_SSP2"))
    assert read_metadata(spark, out2)["cells_per_resolution"]["3"] == got2.count()

    # another configuration is another run: nothing of the first is reused
    out3 = os.path.join(tmp_dir, "out_resumable_5")
    cli(["--pixels", src, "--out", out3, "--resolutions", "5,6", "--resumable"])
    assert {r[0] for r in read_index(spark, out3, "SSP2").select("h3_res").distinct().collect()} == {5, 6}
    out4 = os.path.join(tmp_dir, "out_resumable_nodata")
    cli(["--pixels", src, "--out", out4, "--resolutions", "3", "--resumable", "--nodata", "7", "--years", "2025"])
    exp4 = X.build_index(px, ["pop_2025"], [3], 7.0)
    got4 = read_index(spark, out4, "SSP2").select("h3_res", "h3_index", "pop_2025")
    assert got4.exceptAll(exp4).count() == 0 and exp4.exceptAll(got4).count() == 0

    # another input is another run as well; the same run again does nothing
    px.where("lat > 0").select("lat", "lon", *Q.POP).write.parquet(os.path.join(tmp_dir, "px2"))
    out5 = os.path.join(tmp_dir, "out_resumable_px2")
    cli(["--pixels", os.path.join(tmp_dir, "px2"), "--out", out5, "--resolutions", "3", "--resumable"])
    assert read_index(spark, out5, "SSP2").count() == X.build_index(px.where("lat > 0"), Q.POP, [3], Q.NODATA).count()
    written = os.path.getmtime(os.path.join(out2, "_COMPLETE_SSP2"))
    cli(["--pixels", src, "--out", out2, "--resolutions", "3", "--resumable"])
    assert os.path.getmtime(os.path.join(out2, "_COMPLETE_SSP2")) == written

    # tiles are unpacked first
    out6 = os.path.join(tmp_dir, "out_resumable_tiles")
    cli(["--tiles", tdir, "--tile-size", "64", "--grid", gpath, "--out", out6, "--resolutions", "2,4", "--resumable"])
    got6 = read_index(spark, out6, "SSP2").select("h3_res", "h3_index", *Q.POP)
    assert got6.exceptAll(exp).count() == 0 and exp.exceptAll(got6).count() == 0
    with pytest.raises(ValueError, match="refused"):
        cli(["--pixels", src, "--out", out6, "--crs", "EPSG:3857"])


def read_metadata(spark, base):
    return spark.read.json(f"{current(spark, base, 'SSP2').root}/scenario=SSP2/_index_metadata.json").first().asDict(recursive=True)


def test_diagnostics_refuse_another_id_system(spark, tmp_dir):
    from tessera.plans.build import publish_index
    from tessera.plans.diagnostics import run_diagnostics
    from tessera.sources.index_reader import cell_system

    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [2], Q.NODATA)
    publish_index(spark, idx, tmp_dir, "SSP2", [2025, 2050, 2100], [2], FIXTURE_GRID, system="h3")
    assert cell_system(spark, tmp_dir, "SSP2") == "h3"
    with pytest.raises(ValueError, match="can't be decoded"):
        run_diagnostics(spark, tmp_dir)


def test_published_index_built_once_and_rebuilt_when_gone(spark):
    import shutil

    from tessera.plans.published import published_base, published_resolution

    a = published_base(spark, SF_SMALL)
    assert published_base(spark, SF_SMALL) == a  # reused
    n = published_resolution(spark, SF_SMALL, 5).count()
    shutil.rmtree(a)
    b = published_base(spark, SF_SMALL)
    assert b != a and published_resolution(spark, SF_SMALL, 5).count() == n


def test_read_index_missing_resolution_is_empty(spark, tmp_dir):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [2], Q.NODATA)
    write_index(idx, tmp_dir, "SSP2")
    assert read_index(spark, tmp_dir, "SSP2", 9).count() == 0
    assert read_index(spark, tmp_dir, "SSP2", 2).count() == idx.count()


def test_catalog_falls_back_to_bands(spark, tmp_dir):
    for name in ("all_years.tif", "other.tif"):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(b"x")
    bands = spark.createDataFrame(
        [("all_years.tif", 1, "population 2030"), ("all_years.tif", 2, None), ("gone.tif", 1, "2040")], "path string, band int, description string"
    )
    assert discover_rasters(spark, tmp_dir).count() == 0
    got = [(r["year"], r["band"]) for r in discover_rasters(spark, tmp_dir, bands=bands).collect()]
    assert got == [(2025, 2), (2030, 1)]
    with open(os.path.join(tmp_dir, "pop_2060.tif"), "wb") as f:
        f.write(b"x")
    assert [r["year"] for r in discover_rasters(spark, tmp_dir, bands=bands).collect()] == [2060]
