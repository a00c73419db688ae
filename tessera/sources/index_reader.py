"""Readers of a written index and its files.

Any Hadoop URI works (``file:``, ``hdfs:``, ``s3a:`` with the usual
``spark.hadoop.fs.s3a.*`` settings); nothing here lists files on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def index_schema(years: list[int]) -> T.StructType:
    """The published columns; ``scenario`` and ``h3_res`` come from the folders."""
    fields = [T.StructField("h3_index", T.LongType())]
    fields += [T.StructField(f"pop_{int(y)}", T.FloatType()) for y in years]
    return T.StructType([*fields, T.StructField("scenario", T.StringType()), T.StructField("h3_res", T.IntegerType())])


def cell_system(spark: SparkSession, base: str, scenario: str) -> str | None:
    """The id system the metadata document names, or None without a document."""
    from ..sinks.manifest import has_marker
    from ..sinks.snapshots import current

    snapshot = current(spark, base, scenario)
    root = snapshot.root if snapshot else base.rstrip("/")
    path = f"{root}/scenario={scenario}/_index_metadata.json"
    if not has_marker(spark, path):
        return None
    row = spark.read.schema("cell_system string").json(path).first()
    return row["cell_system"] if row else None


def read_snapshot(spark: SparkSession, snapshot, res: int | None = None, years: list[int] | None = None) -> DataFrame:
    """One version of a scenario. The pointer names its years, so no file footer is opened for the schema."""
    return _read_plain(spark, snapshot.root, snapshot.scenario, res, snapshot.years if years is None else years)


def read_index(
    spark: SparkSession,
    base: str,
    scenario: str | None = None,
    res: int | None = None,
    years: list[int] | None = None,
) -> DataFrame:
    """The published layout. Scenario/resolution become partition
    filters (directory pruning), other predicates reach the Parquet reader.

    A base with committed versions (``sinks.snapshots``) reads the current one of the
    scenario, or of each scenario, whose unlike year columns are then merged (null where a scenario lacks
    one). Plain folders ``scenario=<S>/h3_res=<N>``, as other tools write them, are read as they lie.
    With ``years`` the schema is declared and no file footer is opened for it.
    """
    from ..sinks.snapshots import current, scenarios

    if scenario is not None:
        snapshot = current(spark, base, scenario)
        return read_snapshot(spark, snapshot, res, years) if snapshot else _read_plain(spark, base, scenario, res, years)
    found = scenarios(spark, base)
    if not found:
        return _read_plain(spark, base, None, res, years)
    out = None
    for s in found:  # at most a handful
        df = read_snapshot(spark, current(spark, base, s), res, years)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def _read_plain(spark: SparkSession, base: str, scenario: str | None, res: int | None, years: list[int] | None) -> DataFrame:
    """When scenario and resolution are given only that leaf directory is listed (``basePath`` keeps
    ``scenario``/``h3_res`` as columns), so opening one resolution doesn't cost more with more of them."""
    from ..sinks.manifest import has_marker

    root = base.rstrip("/")
    leaf = f"{root}/scenario={scenario}/h3_res={int(res)}" if scenario is not None and res is not None else None
    reader = spark.read.schema(index_schema(years)) if years is not None else spark.read
    if leaf is not None and has_marker(spark, leaf):
        df = reader.option("basePath", root).parquet(leaf)
    else:  # whole layout; a resolution without cells has no folder and reads empty
        df = reader.parquet(root)
    if scenario is not None:
        df = df.where(F.col("scenario") == F.lit(scenario))
    if res is not None:
        df = df.where(F.col("h3_res") == F.lit(int(res)))
    return df


def read_index_files(spark: SparkSession, base: str, glob: str = "*.parquet") -> DataFrame:
    """Every current data file under ``base`` as one table, partition inference off
    (the directory names are not turned into columns)."""
    from ..sinks.snapshots import data_roots

    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .parquet(*data_roots(spark, base))
    )


def read_merged(spark: SparkSession, base: str, glob: str = "*.parquet") -> DataFrame:
    """S6 + S9: ``scenario, h3_res, h3_index`` and every ``pop_<year>`` that any file has, in order of years; null where a file
    lacks the year.

    For data of unlike runs: files under ``base`` may differ in year columns (their schemas are merged, by a
    Spark job over the footers) and, from one version to another, in the type of a year (FLOAT and DOUBLE read as
    DOUBLE). Folder names are not trusted: partition inference is off, the resolution is that of the
    id, and the scenario is what the file's path names (null if it names none). Versions
    without a cell have no files and add nothing but, where all are so, their years.
    """
    from ..functions import cells
    from ..operators.analytics import pop_columns
    from ..sinks.snapshots import current, data_roots, scenarios

    parts, kinds = [], {}
    for root in data_roots(spark, base):  # one for plain folders, else one a scenario
        if _listing(spark, [root], glob).isEmpty():
            continue
        df = (
            spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).parquet(root)
        )
        for c in pop_columns(df):
            kinds.setdefault(c, set()).add(df.schema[c].dataType.simpleString())
        parts.append(df)
    years = sorted(kinds)
    named = F.regexp_extract(F.col("_metadata.file_path"), "/scenario=([^/]+)/", 1)
    out = None
    for df in parts:
        own = set(df.columns)
        value = lambda c, own=own: (F.col(c) if c in own else F.lit(None)).cast("float" if kinds[c] == {"float"} else "double").alias(c)
        rows = df.select(F.nullif(named, F.lit("")).alias("scenario"), cells.cell_res("h3_index").alias("h3_res"), "h3_index", *[value(c) for c in years])
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        known = sorted({y for s in scenarios(spark, base) for y in current(spark, base, s).years})
        return spark.createDataFrame([], ", ".join(["scenario string, h3_res int, h3_index bigint", *(f"pop_{y} float" for y in known)]))
    return out


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """Partial results of a resumable run (one folder per batch)."""
    return spark.read.parquet(path)


def _listing(spark: SparkSession, roots: list[str], glob: str) -> DataFrame:
    """The ``content`` column is never selected, so no file body is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(roots)
        .select("path", "length", "modificationTime")
    )


def list_files(spark: SparkSession, base: str, glob: str = "*.parquet") -> DataFrame:
    """``path, length, modificationTime`` of matching files, sorted by path; of a published index
    those of its current versions."""
    from ..sinks.snapshots import data_roots

    return _listing(spark, data_roots(spark, base), glob).orderBy("path")


def listing_key(spark: SparkSession, base: str, glob: str = "*.parquet") -> str:
    """A fingerprint of the files under ``base`` (paths, lengths, times), whatever their order or number."""
    one = F.xxhash64("path", "length", F.col("modificationTime").cast("long"))
    r = _listing(spark, [base], glob).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.coalesce(F.bit_xor(one), F.lit(0)).alias("x")
    ).first()
    return f"{r['n']}-{r['bytes']}-{r['x']}"


_DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "float": "FLOAT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "binary": "BLOB",
    "boolean": "BOOLEAN",
}


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``column_name, column_type`` of a frame, from its schema alone
    (the ``LIMIT 0`` describe: no data is read)."""
    rows = [
        (f.name, _DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()))
        for f in df.schema.fields
    ]
    schema = T.StructType(
        [T.StructField("column_name", T.StringType(), False), T.StructField("column_type", T.StringType(), False)]
    )
    return spark.createDataFrame(rows, schema)
