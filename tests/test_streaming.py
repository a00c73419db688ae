"""Resumable build: a second run over the same folder only takes new files, and
the merged result equals the one-pass index."""

import os

from pyspark.sql import functions as F

from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.sources.fixture import pixel_view
from tessera.sources.grid import window_of
from tessera.streaming.resumable import run_resumable

from .conftest import SF_SMALL


def test_resume_takes_only_new_files(spark, tmp_dir):
    px = pixel_view(spark, SF_SMALL).select("pixel_id", "lat", "lon", *Q.POP, window_of("lat", "lon")[0])
    west = px.where(F.col("lon") < 0)
    east = px.where(F.col("lon") >= 0)
    pix_dir = os.path.join(tmp_dir, "pixels")
    west.repartition(3, "win_id").write.parquet(pix_dir)
    schema = spark.read.parquet(pix_dir).schema
    work = os.path.join(tmp_dir, "work")
    first = run_resumable(spark, pix_dir, schema, Q.POP, [3, 5], Q.NODATA, work, max_files_per_trigger=1)
    n_batches_1 = len([d for d in os.listdir(os.path.join(work, "partials")) if d.startswith("batch_id=")])
    exp_w = X.build_index(west, Q.POP, [3, 5], Q.NODATA)
    assert first.exceptAll(exp_w).count() == 0 and exp_w.exceptAll(first).count() == 0

    # new files arrive; the restarted run processes only those
    east.repartition(2, "win_id").write.mode("append").parquet(pix_dir)
    second = run_resumable(spark, pix_dir, schema, Q.POP, [3, 5], Q.NODATA, work, max_files_per_trigger=1)
    n_batches_2 = len([d for d in os.listdir(os.path.join(work, "partials")) if d.startswith("batch_id=")])
    assert n_batches_2 - n_batches_1 <= 2
    exp = X.build_index(px, Q.POP, [3, 5], Q.NODATA)
    assert second.exceptAll(exp).count() == 0 and exp.exceptAll(second).count() == 0


def test_a_larger_backlog_takes_larger_batches(spark, tmp_dir):
    """24 files, a bound of one byte: the share of the backlog holds, every file is read, and a batch's files are few."""
    px = pixel_view(spark, SF_SMALL).select("pixel_id", "lat", "lon", *Q.POP)
    pix_dir, work = os.path.join(tmp_dir, "pixels"), os.path.join(tmp_dir, "work")
    px.repartition(24).write.parquet(pix_dir)
    schema = spark.read.parquet(pix_dir).schema
    got = run_resumable(spark, pix_dir, schema, Q.POP, [3, 5], Q.NODATA, work, max_bytes_per_trigger=1, about_batches=3)
    batches = [d for d in os.listdir(os.path.join(work, "partials")) if d.startswith("batch_id=")]
    assert 2 <= len(batches) <= 5
    assert all(sum(f.endswith(".parquet") for f in os.listdir(os.path.join(work, "partials", b))) == 1 for b in batches)
    exp = X.build_index(px, Q.POP, [3, 5], Q.NODATA)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
