"""Run manifest: which windows a run has finished.

The manifest is an append-only Parquet table ``(run_key, win_id, status, n_valid,
attempt)`` in shared storage. ``run_key`` fingerprints everything that changes the
output (scenario, years, resolutions, grid, input), so a finished
run of one configuration is never reused by another.

A run has one row per lattice window. ``attempt`` names the folder of partial sums
that hold the window; each batch of windows appends its rows as one file after its
partial sums are written, and only partial sums that a row names count.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATUS_DONE = "done"
STATUS_NO_DATA = "skipped_no_data"

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("run_key", T.StringType(), False),
        T.StructField("win_id", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("n_valid", T.LongType(), True),
        T.StructField("attempt", T.StringType(), True),
    ]
)


def run_key(scenario: str, years, resolutions, grid, inputs: str, system: str = "hex") -> str:
    """Fingerprint of a run configuration (small, computed on the driver)."""
    payload = {
        "scenario": scenario,
        "years": sorted(int(y) for y in years),
        "resolutions": sorted(int(r) for r in resolutions),
        "grid": asdict(grid) if is_dataclass(grid) else grid,
        "inputs": inputs,
        "system": system,
    }
    return hashlib.sha256(json.dumps(payload, sort_keys=True, default=str).encode()).hexdigest()[:16]


def manifest_rows(win_ids: DataFrame, key: str, status: str) -> DataFrame:
    return win_ids.select(
        F.lit(key).alias("run_key"), F.col("win_id"), F.lit(status).alias("status")
    )


def append_manifest(rows: DataFrame, path: str) -> None:
    """K5: append finished windows, as one file (at most a lattice of rows): all of a batch or none of it."""
    for name, kind in (("n_valid", "bigint"), ("attempt", "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    rows.select(*MANIFEST_SCHEMA.names).coalesce(1).write.mode("append").parquet(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, or an empty one when nothing was recorded yet."""
    if not has_marker(spark, path):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def pending_windows(windows: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """K6: windows not yet recorded for this run (left anti join).

    Both sides have at most one row per lattice window; how they are joined
    is left to Spark.
    """
    finished = manifest.where(F.col("run_key") == F.lit(key)).select("win_id").distinct()
    return windows.join(finished, "win_id", "left_anti")


def window_outcomes(lattice: DataFrame, per_window: DataFrame) -> DataFrame:
    """Status of every lattice window from per-window valid-pixel counts.

    Both inputs have at most one row per lattice window.
    """
    j = lattice.join(per_window.select("win_id", "n_valid"), "win_id", "left")
    return j.select(
        "win_id",
        F.when(F.coalesce(F.col("n_valid"), F.lit(0)) > 0, F.lit(STATUS_DONE))
        .otherwise(F.lit(STATUS_NO_DATA))
        .alias("status"),
        F.coalesce(F.col("n_valid"), F.lit(0)).cast("bigint").alias("n_valid"),
    )


def window_status_counts(outcomes: DataFrame) -> DataFrame:
    """Windows per status."""
    return outcomes.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_windows"), F.sum("n_valid").cast("bigint").alias("n_valid")
    )


def write_marker(spark: SparkSession, path: str, text: str) -> str:
    """K7: a small completion marker file, through the Hadoop FileSystem of
    ``path`` (local, HDFS, S3A ...). Written last, so its presence means the
    index and metadata are complete."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return path


def has_marker(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))
