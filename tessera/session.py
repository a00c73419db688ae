"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for a batch job: AQE re-plans shuffles at runtime (coalesces small
# partitions, splits skewed ones), no web UI, UTC, Arrow for pandas UDFs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # plans and tasks kept for that UI would fill a long session's driver
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "10000",
    # cell math and region CASEs make wide generated methods; let the JIT
    # compile them instead of interpreting any method over 8 KB of bytecode
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    # parquet: keep the vectorized reader and filter pushdown on
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.enableVectorizedReader": "true",
}


def get_spark(
    app: str = "tessera",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so a cluster launcher keeps control.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (what a cluster names as its shared,
    fault-tolerant storage). Only when it is unset *and* the master is local
    (tests, a laptop) a private temporary folder is created and recorded in
    the session; on a cluster an unset folder is an error, never a
    machine-local fallback.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: set it to shared storage (HDFS, S3A, ...) "
                "so checkpoints and intermediate tables survive executor loss"
            )
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of this application's scratch folder.

    The scratch folder lies in the shared checkpoint folder and goes when the
    driver's JVM ends.
    """
    top = os.path.join(checkpoint_root(spark), f"scratch-{spark.sparkContext.applicationId}")
    if top not in _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _SCRATCH.add(top)
    return os.path.join(top, f"{name}-{uuid.uuid4().hex[:12]}")


_SCRATCH: set = set()
_SHIPPED: set = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``tessera`` importable in the Python workers (pandas UDFs,
    ``applyInPandas``, ``mapInPandas``) -- what ``--py-files`` does at submit
    time, done once per SparkContext so a session started elsewhere (a
    notebook, a test harness) works too. The zip holds only the package's
    source files and is served to executors by the driver.
    """
    import zipfile

    from pyspark.sql import SparkSession as _S

    spark = spark or _S.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zip_path = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zip_path)
    _SHIPPED.add(key)
