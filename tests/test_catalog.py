"""Registered queries against their SQL on the smallest tables, in both kinds of plan."""

import ast
from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
# Queries whose plan depends on whether the input fits one task.
SIZED = ["area_stats", "q2_room_type_pricing", "q6_top_revenue_areas", "kpi_market", "box_stats_room", "detect_outliers",
         "histogram_price", "kruskal_wallis", "median_price_by_supplier", "valuation", "scalar_percentiles"]


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    problem, _, _ = compare(spark, duck, FOLDER, name, entry.queries()[name], SQL[name])
    assert problem is None


@pytest.mark.parametrize("name", SIZED)
def test_matches_sql_distributed(spark, duck, distributed, name):
    problem, _, _ = compare(spark, duck, FOLDER, name, entry.queries()[name], SQL[name])
    assert problem is None


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_no_name_is_bound_twice():
    """A later function of the same name would silently replace the one that earlier queries call."""
    for section in entry.SECTIONS:
        bodies = ast.parse(Path(section.__file__).read_text()).body
        names = [b.name for b in bodies if isinstance(b, ast.FunctionDef)]
        assert len(names) == len(set(names)), section.__name__
