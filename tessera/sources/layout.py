"""Parquet layout audit (S11) as a distributed job.

Input: a DataFrame of file paths (``list_files``). Each task opens only the
footers of its own files with pyarrow and emits one row per (file, row
group, column): row count, physical type, codec, min/max statistics, plus
whether the file carries a ``geo`` key. File bodies are never read and no
listing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("row_group", T.IntegerType(), False),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("physical_type", T.StringType(), False),
        T.StructField("codec", T.StringType(), False),
        T.StructField("min", T.StringType(), True),
        T.StructField("max", T.StringType(), True),
        T.StructField("has_geo", T.BooleanType(), False),
    ]
)


def _open(path: str):
    import pyarrow.fs as pafs

    u = urlparse(path)
    if u.scheme in ("", "file"):
        return pafs.LocalFileSystem().open_input_file(u.path if u.scheme else path)
    fs, p = pafs.FileSystem.from_uri(path)
    return fs.open_input_file(p)


def _audit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for pdf in batches:
        out = []
        for path in pdf["path"]:
            with _open(path) as f:
                meta = pq.ParquetFile(f).metadata
                kv = meta.metadata or {}
                has_geo = b"geo" in kv
                for g in range(meta.num_row_groups):
                    rg = meta.row_group(g)
                    for i in range(rg.num_columns):
                        col = rg.column(i)
                        st = col.statistics
                        has = st is not None and st.has_min_max
                        out.append(
                            (
                                path,
                                g,
                                rg.num_rows,
                                col.path_in_schema,
                                col.physical_type,
                                col.compression,
                                str(st.min) if has else None,
                                str(st.max) if has else None,
                                has_geo,
                            )
                        )
        yield pd.DataFrame(out, columns=[f.name for f in AUDIT_SCHEMA.fields])


def layout_audit(files: DataFrame) -> DataFrame:
    """One row per (file, row group, column chunk)."""
    from ..session import ship_package

    ship_package(files.sparkSession)
    return files.select("path").mapInPandas(_audit, AUDIT_SCHEMA)
