"""Files of unlike runs read together."""

import os

from pyspark.sql import functions as F

from tessera.operators import analytics as A
from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.plans.build import build_population_index
from tessera.sources.fixture import FIXTURE_GRID, pixel_view
from tessera.sources.index_reader import read_merged

from .conftest import SF_SMALL


def test_published_scenarios_of_unlike_years(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px, FIXTURE_GRID, [2050], tmp_dir, "SSP1", [2])
    build_population_index(spark, px, FIXTURE_GRID, [2025, 2100], tmp_dir, "SSP2", [2, 5])
    df = read_merged(spark, tmp_dir)
    assert df.columns == ["scenario", "h3_res", "h3_index", "pop_2025", "pop_2050", "pop_2100"]
    stats = A.population_stats(df, A.pop_columns(df), ["scenario", "h3_res"], only_present=True).collect()
    assert {(r.scenario, r.h3_res, r.column_name) for r in stats} == {
        ("SSP1", 2, "pop_2050"), ("SSP2", 2, "pop_2025"), ("SSP2", 2, "pop_2100"), ("SSP2", 5, "pop_2025"), ("SSP2", 5, "pop_2100"),
    }
    one = A.population_stats(X.build_index(px, ["pop_2050"], [2], Q.NODATA), ["pop_2050"]).first()
    assert next((r.total_pop, r.cells_with_pop) for r in stats if r.scenario == "SSP1") == (one.total_pop, one.cells_with_pop)


def test_plain_files_with_misleading_folders_types_and_names(spark, tmp_dir):
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [3, 4], Q.NODATA).select("h3_index", *Q.POP)
    # the folder says resolution 9; one file lacks a year, another has one more and one under a name that isn't a year
    idx.select("h3_index", "pop_2025").write.parquet(os.path.join(tmp_dir, "scenario=SSP4", "h3_res=9", "a"))
    more = idx.withColumn("pop_2070", F.lit(1.0).cast("float")).withColumn("pop_note", F.lit("x")).drop("pop_2025")
    more.write.parquet(os.path.join(tmp_dir, "elsewhere", "b"))
    df = read_merged(spark, tmp_dir)
    assert df.columns == ["scenario", "h3_res", "h3_index", "pop_2025", "pop_2050", "pop_2070", "pop_2100"]
    assert {tuple(r) for r in df.select("scenario", "h3_res").distinct().collect()} == {("SSP4", 3), ("SSP4", 4), (None, 3), (None, 4)}
    assert df.where("scenario = 'SSP4' AND pop_2050 IS NOT NULL").isEmpty() and df.where("scenario IS NULL").agg(F.sum("pop_2070")).first()[0] == idx.count()


def test_float_and_double_years(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px, FIXTURE_GRID, [2050], tmp_dir, "SSP1", [2])
    from tessera.sinks import snapshots as S

    staged = S.begin(tmp_dir, "SSP2", [2050], [2])
    wide = X.build_index(px, ["pop_2050"], [2], Q.NODATA).withColumn("pop_2050", F.col("pop_2050").cast("double") + 0.25)
    wide.withColumn("scenario", F.lit("SSP2")).write.partitionBy("scenario", "h3_res").parquet(staged.root)
    S.commit(spark, tmp_dir, staged)
    df = read_merged(spark, tmp_dir)
    assert df.schema["pop_2050"].dataType.simpleString() == "double"
    a, b = (df.where(f"scenario = '{s}'").agg(F.sum("pop_2050"), F.count("*")).first() for s in ("SSP1", "SSP2"))
    assert b[0] - a[0] == 0.25 * a[1] and a[1] == b[1]


def test_versions_without_cells(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL)
    build_population_index(spark, px.where("lat > 100"), FIXTURE_GRID, [2050], tmp_dir, "SSP1", [2])
    assert read_merged(spark, tmp_dir).columns == ["scenario", "h3_res", "h3_index", "pop_2050"] and read_merged(spark, tmp_dir).count() == 0
    build_population_index(spark, px, FIXTURE_GRID, [2100], tmp_dir, "SSP2", [2])
    df = read_merged(spark, tmp_dir)
    assert df.columns[3:] == ["pop_2100"] and {r[0] for r in df.select("scenario").distinct().collect()} == {"SSP2"}
