"""Empty inputs give empty or missing results, never an error."""

import pytest
from pyspark.sql import functions as F

from catalog import roles
from marketlens.operators import areas, features, market, profile, stats, summaries
from marketlens.operators.quantiles import grouped

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def nothing(spark):
    return {k: v.limit(0) for k, v in roles.clean(spark, FOLDER).items()}


def test_reports_over_nothing(spark, nothing):
    x = nothing["listings"]
    assert market.kpi_market(x.withColumns({"occupancy_rate": F.lit(1.0), market.REVENUE: F.lit(1.0)})).first().listings == 0
    assert market.histogram(x, "price", 10).count() == 0
    assert market.area_price_topk(x).count() == 0
    assert market.corr_matrix(x, ["price", "beds"]).count() == 0
    assert profile.null_counts(x).where("null_count > 0").count() == 0
    assert profile.detect_outliers(x, ["price"], "x").count() == 0
    assert summaries.calendar_summary(nothing["calendar"]).count() == 0
    assert areas.area_stats(x).count() == 0
    assert features.build_master(nothing, roles.AS_OF).count() == 0


@pytest.mark.parametrize("slices", [1, 4])
def test_statistics_over_nothing(spark, nothing, slices):
    x = nothing["listings"]
    groups = stats.two_groups(x, "price", F.col("beds") == 1, F.col("beds") == 2)
    assert stats.mann_whitney_u(groups, slices).first().u is None
    assert stats.cohens_d(groups).first().d is None
    assert stats.kruskal_wallis(x, "room_type", "price", slices=slices).first().h is None
    assert stats.lowess_grid(x, "price", "beds").count() == 0
    assert grouped(x, ["room_type"], quantiles={"m": ("price", 0.5)}, slices=slices).count() == 0
