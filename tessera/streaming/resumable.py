"""Index build on a stream of pixel files, and the resumable job.

``resumable_build`` goes by windows (``streaming.windows``). ``run_resumable`` is
for pixel files that keep arriving: they are consumed as a file stream:

* each micro-batch turns its files into *partial* sums per (resolution,
  cell) and writes them under ``partials/batch_id=<n>`` -- with dynamic
  partition overwrite, so a replayed batch replaces its own output;
* the stream checkpoint (in the shared checkpoint folder) records which
  files each batch took, so a restarted run skips finished files and
  replays at most the batch in flight (finished *files* are skipped, by Spark's
  own offset log; finished windows are the other job's);
* the merge is the final phase of the same aggregation: SUM of partials
  per (resolution, cell), cast to FLOAT once (partials stay DOUBLE, so the
  result equals the one-pass build).

``availableNow`` processes everything present and stops, so the same code
serves one-shot backfills and incremental runs over new files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.index import assign_cells, validate_resolutions
from ..operators.mask import apply_mask


def partial_sums(pixels: DataFrame, pop_cols: list[str], resolutions, nodata, system="hex") -> DataFrame:
    """K1: per-batch partial aggregate, kept in DOUBLE."""
    valid = apply_mask(pixels, pop_cols, nodata)
    assigned = assign_cells(valid, resolutions, keep=pop_cols, system=system)
    return assigned.groupBy("h3_res", "h3_index").agg(
        *[F.sum(F.col(c).cast("double")).alias(c) for c in pop_cols]
    )


def merge_partials(partials: DataFrame, pop_cols: list[str]) -> DataFrame:
    """A2 over partial results: partial sums of straddling cells are added."""
    return partials.groupBy("h3_res", "h3_index").agg(
        *[F.sum(c).cast("float").alias(c) for c in pop_cols]
    )


def run_resumable(
    spark: SparkSession,
    pixel_dir: str,
    pixel_schema: T.StructType,
    pop_cols: list[str],
    resolutions,
    nodata: float | None,
    work_dir: str,
    max_bytes_per_trigger: int = 64 << 30,
    system: str = "hex",
    max_files_per_trigger: int | None = None,
    about_batches: int | None = None,
) -> DataFrame:
    """Consume all pixel files under ``pixel_dir`` (resuming if ``work_dir``
    holds an earlier attempt) and return the merged index (lazy).

    A batch has costs of its own (offsets, commit, a job's start), which bounded batches pay as often as the
    backlog holds them. With ``about_batches`` the bound in bytes rises to that share of the files present, so
    their number stays about that whatever the backlog; ``max_bytes_per_trigger`` is then the least bound.
    """
    from ..sources.index_reader import list_files

    res = validate_resolutions(resolutions)
    partials_dir = os.path.join(work_dir, "partials")
    ckpt = os.path.join(work_dir, "stream-checkpoint")

    def process(batch: DataFrame, batch_id: int) -> None:
        # a batch is a job like any other, but its session has re-planning off: each of them would write a file
        # for every shuffle partition, however few its rows
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")
        part = partial_sums(batch, pop_cols, res, nodata, system=system)
        (
            part.withColumn("batch_id", F.lit(int(batch_id)))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(partials_dir)
        )

    if about_batches:
        present = list_files(spark, pixel_dir).agg(F.sum("length")).first()[0] or 0
        max_bytes_per_trigger = max(max_bytes_per_trigger, -(-present // about_batches))

    # batches are bounded by bytes, so a backlog is few large batches whatever the file sizes
    reader = spark.readStream.schema(pixel_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    stream = reader.parquet(pixel_dir)
    q = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    from ..sources.index_reader import read_partials

    return merge_partials(read_partials(spark, partials_dir), pop_cols)


def resumable_build(
    spark: SparkSession,
    pixels: DataFrame,
    inputs: str,
    grid,
    years: list[int],
    out_base: str,
    scenario: str,
    resolutions,
    system: str = "hex",
    max_bytes_per_batch: int = 64 << 30,
    max_batches: int | None = None,
) -> DataFrame | None:
    """The index job in resumable form, finished like the one-pass job (metadata, pointer, marker).

    The work folder is named by a key over scenario, years, resolutions, grid
    (with nodata), id system and ``inputs`` (the input's listing, or a label the caller gives
    to data whose files may be rewritten), so an attempt is only ever resumed by the same run.
    ``pixels`` are staged by window once; windows then run in batches and are recorded
    with each batch (``streaming.windows``). A run whose version is the current one is not
    repeated; after another build over the same output it is published anew from its
    partial sums. ``max_batches`` stops early: then None is returned, and nothing is published.
    """
    import time

    from ..plans.build import publish_index, validate_scenario
    from ..session import checkpoint_root
    from ..sinks import manifest as M
    from ..sinks.snapshots import current
    from ..sources.grid import pop_col
    from ..sources.index_reader import read_snapshot
    from .windows import WindowRun, stage_by_window

    started = time.time()
    validate_scenario(scenario)
    grid.check_geographic()
    res = validate_resolutions(resolutions)
    pops = [pop_col(y) for y in years]
    key = M.run_key(scenario, years, res, grid, inputs, system)
    work = os.path.join(checkpoint_root(spark), f"resumable-{key}")
    staged = os.path.join(work, "pixels")
    wide = pixels.select("lat", "lon", *pops)
    run = WindowRun(spark, staged, wide.schema, pops, res, grid.nodata_float32(), work, key, system)
    complete = run.pending().isEmpty()
    snapshot = current(spark, out_base, scenario)
    if complete and snapshot is not None and snapshot.run_key == key:
        return read_snapshot(spark, snapshot)
    if not complete:
        if not M.has_marker(spark, os.path.join(staged, "_SUCCESS")):
            stage_by_window(wide, staged)
        run.run(max_bytes_per_batch, max_batches)
        if max_batches is not None and not run.pending().isEmpty():
            return None
    return publish_index(spark, run.index(), out_base, scenario, years, res, grid, system, None, started, run_key=key)
