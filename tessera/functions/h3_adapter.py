"""Optional exact H3 cells (``system="h3"``) through the public ``h3`` package.

Vectorized pandas UDFs (one Arrow batch per call). The package is imported
inside the UDF, so this module loads without it; using the functions where
it is missing raises a clear error. Published H3 datasets can still be read,
and their ids formatted / parsed, with ``tessera.functions.cells``.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def available() -> bool:
    try:
        import h3  # noqa: F401
    except ImportError:
        return False
    return True


def _h3():
    try:
        import h3
    except ImportError as e:  # pragma: no cover - depends on the image
        raise RuntimeError("system='h3' needs the 'h3' package on every executor") from e
    return h3


@F.pandas_udf(T.LongType())
def latlng_to_cell(lat: pd.Series, lon: pd.Series, res: pd.Series) -> pd.Series:
    h3 = _h3()
    return pd.Series(
        [h3.str_to_int(h3.latlng_to_cell(a, b, int(r))) for a, b, r in zip(lat, lon, res)],
        index=lat.index,
        dtype="int64",
    )


@F.pandas_udf(T.DoubleType())
def h3_cell_to_lat(cell: pd.Series) -> pd.Series:
    h3 = _h3()
    return pd.Series([h3.cell_to_latlng(h3.int_to_str(int(c)))[0] for c in cell], index=cell.index)


@F.pandas_udf(T.DoubleType())
def h3_cell_to_lng(cell: pd.Series) -> pd.Series:
    h3 = _h3()
    return pd.Series([h3.cell_to_latlng(h3.int_to_str(int(c)))[1] for c in cell], index=cell.index)


@F.pandas_udf(T.DoubleType())
def h3_cell_area_km2(cell: pd.Series) -> pd.Series:
    h3 = _h3()
    return pd.Series([h3.cell_area(h3.int_to_str(int(c)), unit="km^2") for c in cell], index=cell.index)


def h3_attributes(cell: Column) -> dict[str, Column]:
    from ..session import ship_package

    ship_package()
    return {
        "lat": h3_cell_to_lat(cell),
        "lng": h3_cell_to_lng(cell),
        "area_km2": h3_cell_area_km2(cell),
    }
