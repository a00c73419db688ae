"""Cell functions for Spark SQL users (temporary SQL functions).

``register_sql_functions(spark)`` defines, for the session::

    latlng_to_cell(lat DOUBLE, lng DOUBLE, res INT)  -> BIGINT
    cell_to_lat(cell BIGINT) / cell_to_lng(cell BIGINT) -> DOUBLE
    cell_area(cell BIGINT)                             -> DOUBLE (km^2)
    cell_resolution(cell BIGINT)                       -> INT
    cell_boundary(cell BIGINT)                         -> ARRAY<STRUCT<lat, lng>>
    cell_to_string(cell BIGINT) / string_to_cell(s STRING)
    ieee_div(n DOUBLE, d DOUBLE)                       -> FLOAT (x/0 = +-inf, 0/0 = NaN)

They are SQL-bodied functions: the analyzer inlines their bodies, so a
query such as ``SELECT cell_to_lat(h3_index) ... ORDER BY pop_2025 DESC
LIMIT 10`` plans exactly like the DataFrame operators -- native codegen, no
Python worker. The resolution may vary per row; its constants are looked up
from literal arrays.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import cells
from .num import sql_float_div


def _latlng_to_cell_body() -> str:
    x = cells.sql_project_x("lng")
    y = cells.sql_project_y("lat")
    q, r = cells.sql_axial_round(
        x, y, cells._per_res("res", "kq_x"), cells._per_res("res", "kq_y"), cells._per_res("res", "kr_y")
    )
    base = f"({cells.ID_TAG << cells.TAG_SHIFT}L + shiftleft(CAST(res AS BIGINT), {cells.RES_SHIFT}))"
    return cells._sql_pack(base, q, r)


def function_bodies() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, return type, SQL body)."""
    return {
        "latlng_to_cell": ("lat DOUBLE, lng DOUBLE, res INT", "BIGINT", _latlng_to_cell_body()),
        "cell_to_lat": ("cell BIGINT", "DOUBLE", cells.sql_cell_lat("cell")),
        "cell_to_lng": ("cell BIGINT", "DOUBLE", cells.sql_cell_lng("cell")),
        "cell_area": ("cell BIGINT", "DOUBLE", cells.sql_cell_area("cell")),
        "cell_resolution": ("cell BIGINT", "INT", cells.sql_cell_res("cell")),
        "cell_to_string": ("cell BIGINT", "STRING", "lower(hex(cell))"),
        "string_to_cell": ("s STRING", "BIGINT", "CAST(conv(s, 16, 10) AS BIGINT)"),
        "ieee_div": ("n DOUBLE, d DOUBLE", "FLOAT", sql_float_div("n", "d")),
        "cell_boundary": (
            "cell BIGINT",
            "ARRAY<STRUCT<lat: DOUBLE, lng: DOUBLE>>",
            cells.sql_cell_boundary("cell"),
        ),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary functions in this session."""
    for name, (params, ret, body) in function_bodies().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return sorted(function_bodies())
