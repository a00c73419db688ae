"""Spark SQL surface: reference-style SQL over an index with our SQL functions."""

from pyspark.sql import functions as F

from tessera.functions import cells
from tessera.functions.sql import register_sql_functions
from tessera.operators import analytics as A
from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.sources.fixture import pixel_view

from .conftest import SF_SMALL


def test_functions_match_column_api(spark):
    names = register_sql_functions(spark)
    assert "latlng_to_cell" in names and "cell_to_lat" in names
    px = pixel_view(spark, SF_SMALL).select("lat", "lon")
    got = spark.sql(
        "SELECT lat, lon, latlng_to_cell(lat, lon, 3) AS c3, latlng_to_cell(lat, lon, 7) AS c7 FROM {px}", px=px
    )
    exp = px.select("lat", "lon", cells.cell_of("lat", "lon", 3).alias("c3"), cells.cell_of("lat", "lon", 7).alias("c7"))
    assert got.exceptAll(exp).count() == 0
    attrs = spark.sql(
        "SELECT c3, cell_to_lat(c3) AS lat, cell_to_lng(c3) AS lng, cell_area(c3) AS a, cell_resolution(c3) AS r,"
        " string_to_cell(cell_to_string(c3)) AS back, size(cell_boundary(c3)) AS nv FROM {g}",
        g=got,
    )
    exp2 = got.select(
        "c3",
        cells.cell_lat("c3", 3).alias("lat"),
        cells.cell_lng("c3", 3).alias("lng"),
        cells.cell_area_km2("c3", 3).alias("a"),
        F.lit(3).alias("r"),
        F.col("c3").alias("back"),
        F.lit(6).alias("nv"),
    )
    assert attrs.exceptAll(exp2).count() == 0
    plan = attrs._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_reference_style_topk_sql(spark):
    register_sql_functions(spark)
    idx = X.build_index(pixel_view(spark, SF_SMALL), Q.POP, [5], Q.NODATA).drop("h3_res")
    sql = spark.sql(
        """SELECT h3_index, cell_to_lat(h3_index) AS lat, cell_to_lng(h3_index) AS lng,
                  pop_2025, pop_2050, pop_2100, ieee_div(pop_2100, pop_2025) AS growth_ratio
           FROM {idx} ORDER BY pop_2025 DESC, h3_index LIMIT 10""",
        idx=idx,
    ).collect()
    df = A.top_k(
        A.with_cell_attributes(idx, res=5).select(
            "h3_index", "lat", "lng", *Q.POP, A.growth_ratio("pop_2100", "pop_2025").alias("growth_ratio")
        ),
        "pop_2025",
        10,
    ).collect()
    assert [tuple(r) for r in sql] == [tuple(r) for r in df]
    div = spark.sql("SELECT ieee_div(1, 0) a, ieee_div(-1, 0) b, ieee_div(0, 0) c").first()
    assert div["a"] == float("inf") and div["b"] == float("-inf") and div["c"] != div["c"]
