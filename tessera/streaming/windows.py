"""Index build by windows that resumes at the window.

The unit of work and of resuming is a window of the lattice, as in a run that goes
window by window -- not a file, and not the run as a whole:

1. ``stage_by_window`` stores the pixel table once, one folder per band of longitude
   (``win_band=<n>``), sorted by window in it, so a window's pixels are found by folder and by
   the statistics of row groups and pages.
2. ``run_windows`` asks the manifest which windows are left (an anti join of the
   lattice, before any pixel is read) and takes them in batches bounded by bytes.
   A batch reads only the bands and, in them, the window range that it needs, writes
   partial sums per (window, resolution, cell) to a folder named by a new attempt, and then
   commits the outcomes of its windows as one manifest file that names the attempt.
3. The index is the sum of the partial sums whose attempt the manifest names for their
   window. Partial sums of an attempt that ended before its commit are never read.

A run that stops anywhere loses at most the batch in flight. What a window's files are
called, when they were written, and how many windows one input file holds doesn't matter to it:
the manifest keeps windows. The run key says what must be equal for windows to be taken over.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.index import assign_cells, validate_resolutions
from ..operators.mask import apply_mask
from ..sinks import manifest as M
from ..sources.grid import n_windows, window_columns, window_index, window_lattice

WINDOW, BAND = "win_idx", "win_band"
_, BAND_WINDOWS = n_windows()  # windows of a band: those of one column of the lattice


def stage_by_window(pixels: DataFrame, path: str, lat: str = "lat", lon: str = "lon") -> str:
    """Store a wide pixel table with a folder per band of windows, sorted by window.

    The range exchange sorts by (window, lat, lon): a task holds few bands, a crowded window spans
    tasks, and at most (tasks + bands) files are written.
    """
    dealt = pixels.withColumn(WINDOW, window_index(lat, lon)).repartitionByRange(WINDOW, F.col(lat).desc(), lon)
    (
        dealt.withColumn(BAND, F.expr(f"{WINDOW} div {BAND_WINDOWS}").cast("int"))
        .sortWithinPartitions(BAND, WINDOW, F.col(lat).desc(), lon)
        .write.mode("overwrite").option("compression", "zstd").partitionBy(BAND).parquet(path)
    )
    return path


def staged_bytes(spark: SparkSession, path: str) -> DataFrame:
    """``win_band, bytes`` of a staged table, from the listing of its files."""
    from ..sources.index_reader import list_files

    band = F.regexp_extract("path", rf"/{BAND}=(\d+)/", 1)
    files = list_files(spark, path).where(band != "")
    return files.groupBy(band.cast("int").alias(BAND)).agg(F.sum("length").alias("bytes"))


def _schema(pop_cols: list[str]) -> T.StructType:
    keys = [T.StructField("h3_res", T.IntegerType()), T.StructField("h3_index", T.LongType())]
    pops = [T.StructField(c, T.DoubleType()) for c in pop_cols]
    return T.StructType([*keys, T.StructField("n", T.LongType()), *pops, T.StructField(WINDOW, T.IntegerType()), T.StructField("attempt", T.StringType())])


def window_partials(pixels: DataFrame, pop_cols: list[str], resolutions, nodata, system: str = "hex", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """K1: partial sums per (window, resolution, cell), kept in DOUBLE, and the pixels in them."""
    valid = apply_mask(pixels, pop_cols, nodata)
    assigned = assign_cells(valid, resolutions, keep=[WINDOW, *pop_cols], lat=lat, lon=lon, system=system)
    return assigned.groupBy(WINDOW, "h3_res", "h3_index").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("double")).alias(c) for c in pop_cols]
    )


class WindowRun:
    """A build by windows over a staged pixel table, in a work folder named by its run key."""

    def __init__(self, spark: SparkSession, staged: str, pixel_schema: T.StructType, pop_cols: list[str], resolutions, nodata: float | None, work: str, key: str, system: str = "hex"):
        self.spark, self.staged, self.pop_cols = spark, staged, list(pop_cols)
        self.res, self.nodata, self.key, self.system = validate_resolutions(resolutions), nodata, key, system
        wanted = {"lat", "lon", *pop_cols}
        fields = [f for f in pixel_schema.fields if f.name in wanted]
        self.schema = T.StructType([*fields, T.StructField(WINDOW, T.IntegerType()), T.StructField(BAND, T.IntegerType())])
        self.partials, self.manifest_path = f"{work}/partials", f"{work}/manifest"

    # what is recorded

    def manifest(self) -> DataFrame:
        """Rows of this run, all of the lattice's windows at most."""
        return M.read_manifest(self.spark, self.manifest_path).where(F.col("run_key") == F.lit(self.key))

    def lattice(self) -> DataFrame:
        lattice = window_lattice(self.spark)
        return lattice.withColumn(WINDOW, window_index("south + 1e-6D", "west + 1e-6D"))

    def pending(self) -> DataFrame:
        """K6: windows without a row of this run."""
        return M.pending_windows(self.lattice(), self.manifest(), self.key)

    # what is run

    def _batches(self, max_bytes: int) -> list[list[int]]:
        """Pending windows in order, cut where their share of the bands' bytes exceeds ``max_bytes``; those of bands
        without files, which need no reading, come last."""
        sizes = {r[BAND]: r["bytes"] / BAND_WINDOWS for r in staged_bytes(self.spark, self.staged).collect()}  # one row a band
        out, held, empty = [], 0.0, []
        for (w,) in self.pending().select(WINDOW).orderBy(WINDOW).collect():  # a lattice of rows at most
            size = sizes.get(w // BAND_WINDOWS)
            if size is None:
                empty.append(w)
            elif not out or held + size > max_bytes:
                out.append([w])
                held = size
            else:
                out[-1].append(w)
                held += size
        self._bands = set(sizes)
        return [*out, empty] if empty else out

    def read(self, windows: list[int]) -> DataFrame:
        """Pixels of some windows: bands by partition filter, the windows' range pushed to the scan."""
        bands = sorted({int(w) // BAND_WINDOWS for w in windows})
        px = self.spark.read.schema(self.schema).parquet(self.staged)
        px = px.where(F.col(BAND).isin(bands) & F.col(WINDOW).between(int(min(windows)), int(max(windows))))
        whole = len(windows) == max(windows) - min(windows) + 1
        return px if whole else px.where(F.col(WINDOW).isin([int(w) for w in windows]))

    def _run_batch(self, windows: list[int], with_pixels: bool) -> None:
        attempt = uuid.uuid4().hex
        here = self.lattice().where(F.col(WINDOW).isin([int(w) for w in windows])).select(WINDOW)
        if with_pixels:
            folder = f"{self.partials}/attempt={attempt}"
            window_partials(self.read(windows), self.pop_cols, self.res, self.nodata, self.system).write.mode("errorifexists").parquet(folder)
            # each valid pixel counts once at any one resolution
            mine = self._partial_rows([attempt]).where(F.col("h3_res") == F.lit(self.res[0]))
            counts = mine.groupBy(WINDOW).agg(F.sum("n").alias("n_valid"))
            found = here.join(counts, WINDOW, "left")
        else:
            found = here.withColumn("n_valid", F.lit(None).cast("bigint"))
        n = F.coalesce("n_valid", F.lit(0).cast("bigint"))
        outcome = F.when(n > 0, F.lit(M.STATUS_DONE)).otherwise(F.lit(M.STATUS_NO_DATA))
        rows = found.select(F.lit(self.key).alias("run_key"), window_columns(WINDOW)[0], outcome.alias("status"), n.alias("n_valid"), F.lit(attempt).alias("attempt"))
        M.append_manifest(rows, self.manifest_path)

    def run(self, max_bytes: int = 64 << 30, max_batches: int | None = None) -> int:
        """Work off pending windows; ``max_batches`` stops after so many. Returns how many batches ran."""
        batches = self._batches(max_bytes)[:max_batches]
        for windows in batches:
            self._run_batch(windows, with_pixels=windows[0] // BAND_WINDOWS in self._bands)
        return len(batches)

    # what comes out

    def _partial_rows(self, attempts: list[str]) -> DataFrame:
        folders = [f"{self.partials}/attempt={a}" for a in attempts]
        return self.spark.read.schema(_schema(self.pop_cols)).option("basePath", self.partials).parquet(*folders)

    def index(self) -> DataFrame:
        """A2: the committed partial sums, added per (resolution, cell) and rounded to FLOAT once."""
        rows = self.manifest().where(F.col("status") == F.lit(M.STATUS_DONE))
        attempts = sorted(r[0] for r in rows.select("attempt").distinct().collect())  # one a batch
        if not attempts:
            kinds = ", ".join(["h3_res int", "h3_index bigint", *[f"{c} float" for c in self.pop_cols]])
            return self.spark.createDataFrame([], kinds)
        sums = [F.sum(c).cast("float").alias(c) for c in self.pop_cols]
        return self._partial_rows(attempts).groupBy("h3_res", "h3_index").agg(*sums)
