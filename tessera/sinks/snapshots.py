"""Snapshots of a published index (K3, K7): versions written beside one another, one named at a time.

    <base>/_snapshots/<S>/<version>/scenario=<S>/h3_res=<N>/part-*.parquet
    <base>/_snapshots/<S>/<version>/scenario=<S>/_index_metadata.json/
    <base>/_pointers/<S>/<number>      the file with the highest number names the current version

A build writes a version folder of its own and then commits it: a small file is
written under a temporary name and renamed to the next number, which readers see
whole or not at all. Nothing that a reader may hold open is overwritten, so a
rerun with fewer resolutions or other years leaves nothing behind in what is read,
a crash before the rename leaves the earlier version current, and a reader keeps the
version it resolved. Two builds that commit at once take two numbers; the later one is current.
Numbered files instead of one overwritten file: no file system has to replace a
file atomically, only to refuse a name that exists.

Names begin with an underscore, so that Spark readers of ``base`` itself find no data in
it rather than every version at once: ``read_index`` resolves the pointer.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# --- fixed names of the layout ---------------------------------------------------------------
SNAPSHOTS, POINTERS = "_snapshots", "_pointers"
NUMBER_DIGITS = 20
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Snapshot:
    """A version of one scenario; ``number`` is None until it is committed."""

    scenario: str
    version: str
    root: str
    number: int | None = None
    years: list[int] = field(default_factory=list)
    resolutions: list[int] = field(default_factory=list)
    run_key: str | None = None


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it doesn't exist."""
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def _rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename, unless ``target`` exists; False then."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    src, dst = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(src.toUri(), conf)
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(src, dst, plain)
    except Exception as e:
        if "FileAlreadyExists" in str(getattr(e, "java_exception", e)):
            return False
        raise
    return True


def _pointers(base: str, scenario: str) -> str:
    return f"{base.rstrip('/')}/{POINTERS}/{scenario}"


def _folder(base: str, scenario: str, version: str) -> str:
    return f"{base.rstrip('/')}/{SNAPSHOTS}/{scenario}/{version}"


def begin(base: str, scenario: str, years=(), resolutions=(), run_key: str | None = None) -> Snapshot:
    """A version to be written: its folder's name is new and sorts by time."""
    version = f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"
    return Snapshot(scenario, version, _folder(base, scenario, version), None, [int(y) for y in years], [int(r) for r in resolutions], run_key)


def _numbers(spark: SparkSession, base: str, scenario: str) -> list[int]:
    return sorted(int(n) for n in _names(spark, _pointers(base, scenario)) if n.isdigit())


def commit(spark: SparkSession, base: str, snapshot: Snapshot) -> Snapshot:
    """Make a wholly written version the current one."""
    from .manifest import has_marker, write_marker

    if not has_marker(spark, f"{snapshot.root}/_SUCCESS"):
        raise ValueError(f"the version at {snapshot.root} was not written to its end")
    facts = {
        "version": snapshot.version, "years": snapshot.years, "resolutions": snapshot.resolutions,
        "run_key": snapshot.run_key, "committed": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
    }
    folder = _pointers(base, snapshot.scenario)
    written = write_marker(spark, f"{folder}/_tmp-{uuid.uuid4().hex}", json.dumps(facts))
    number = max(_numbers(spark, base, snapshot.scenario), default=0) + 1
    while not _rename_new(spark, written, f"{folder}/{number:0{NUMBER_DIGITS}d}"):
        number += 1  # another build has just taken it
    return _load(spark, base, snapshot.scenario, number)


def _load(spark: SparkSession, base: str, scenario: str, number: int) -> Snapshot:
    facts = json.loads(read_text(spark, f"{_pointers(base, scenario)}/{number:0{NUMBER_DIGITS}d}"))
    root = _folder(base, scenario, facts["version"])
    return Snapshot(scenario, facts["version"], root, number, facts["years"], facts["resolutions"], facts["run_key"])


def current(spark: SparkSession, base: str, scenario: str) -> Snapshot | None:
    """The committed version that readers use; None if there is none."""
    numbers = _numbers(spark, base, scenario)
    return _load(spark, base, scenario, numbers[-1]) if numbers else None


def history(spark: SparkSession, base: str, scenario: str) -> list[Snapshot]:
    """Committed versions, oldest first."""
    return [_load(spark, base, scenario, n) for n in _numbers(spark, base, scenario)]


def scenarios(spark: SparkSession, base: str) -> list[str]:
    """Scenarios with a committed version."""
    names = _names(spark, f"{base.rstrip('/')}/{POINTERS}")
    return [s for s in names if _numbers(spark, base, s)]


def data_roots(spark: SparkSession, base: str) -> list[str]:
    """Where the data of a published index lies: its current versions, or ``base`` itself for plain folders."""
    roots = [current(spark, base, s).root for s in scenarios(spark, base)]
    return roots or [base.rstrip("/")]


def expire(spark: SparkSession, base: str, scenario: str, keep: int = 2, idle_hours: float = 24.0) -> list[str]:
    """Delete all but the newest ``keep`` committed versions, pointers first, and folders of crashed builds that were
    not touched for ``idle_hours``. The current version always stays. Returns the deleted versions."""
    if keep < 1:
        raise ValueError("the current version can't be deleted")
    old = history(spark, base, scenario)[:-keep]
    for s in old:
        p, fs = _fs(spark, f"{_pointers(base, scenario)}/{s.number:0{NUMBER_DIGITS}d}")
        fs.delete(p, False)
    named = {s.version for s in history(spark, base, scenario)}
    gone, before = [], (time.time() - idle_hours * 3600) * 1000
    for version in _names(spark, f"{base.rstrip('/')}/{SNAPSHOTS}/{scenario}"):
        p, fs = _fs(spark, _folder(base, scenario, version))
        was_committed = any(s.version == version for s in old)
        if version not in named and (was_committed or fs.getFileStatus(p).getModificationTime() < before):
            fs.delete(p, True)
            gone.append(version)
    return gone
