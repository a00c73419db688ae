"""Plan-shape guards: the physical plans we reviewed stay that way."""

import re

import pytest

from tessera.operators import index as X
from tessera.plans import queries as Q
from tessera.sources.fixture import pixel_view

from .conftest import SF_SMALL

PYTHON_OPERATORS = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")
PYTHON_QUERIES: set = set()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_cartesian_and_python_only_where_needed(spark, name):
    plan = _plan(Q.QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_QUERIES:
        assert not any(op in plan for op in PYTHON_OPERATORS), name


def test_index_build_has_one_aggregation_exchange(spark):
    big = pixel_view(spark, SF_SMALL)
    plan = _plan(X.build_index(big, Q.POP, Q.ALL_RES, Q.NODATA))
    hash_ex = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(hash_ex) == 1 and "h3_res" in hash_ex[0] and "h3_index" in hash_ex[0]
    assert "partial_sum" in plan  # map-side combine below the exchange
    # the operator adds no exchange of its own whatever the input's size
    read = spark.read.parquet(f"{SF_SMALL}/orders.parquet").selectExpr(
        "o_orderkey % 90 AS lat", "o_orderkey % 180 AS lon", *[f"CAST(o_custkey AS FLOAT) AS {p}" for p in Q.POP]
    )
    assert "RoundRobinPartitioning" not in _plan(X.build_index(read, Q.POP, Q.ALL_RES, Q.NODATA))


def test_tiles_move_the_pixels_once(spark):
    plan = _plan(Q.tiles_roundtrip(spark, SF_SMALL))
    assert re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) and plan.count("Exchange hashpartitioning") == 1
    assert "tile_row" in plan


def test_population_stats_unpivots_results_only(spark):
    plan = _plan(Q.population_stats(spark, SF_SMALL))
    top = plan[: plan.index("Exchange hashpartitioning(h3_res")]
    assert "Generate inline" in top  # above the final aggregate


def test_top_k_derives_attributes_last(spark):
    for name in ("topk_population", "topk_density", "growth_hotspots"):
        lines = Q.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().upper().split("\n")
        derived = [i for i, x in enumerate(lines) if "ASIN(" in x]
        assert derived and max(derived) < next(i for i, x in enumerate(lines) if "SORT [" in x), name


def test_top_k_plans(spark):
    for name in ("topk_population", "topk_density", "growth_hotspots", "bbox_limit"):
        assert "TakeOrderedAndProject" in _plan(Q.QUERIES[name](spark, SF_SMALL)), name


def test_written_index_reads_prune(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = _plan(Q.QUERIES["bbox_written"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(scenario" in plan
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(h3_index,\d+\).*LessThanOrEqual\(h3_index,\d+\)", plan)
    assert "Exchange" not in plan
