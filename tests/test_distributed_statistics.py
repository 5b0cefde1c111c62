"""Ranks by range partition, masked matrix products and robust smoothing against numpy and pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import market, moments, ranges, stats


def pandas_ranks(pdf, by):
    groups = pdf.groupby(by)["v"] if by else pdf["v"]
    return groups.rank()


@pytest.mark.parametrize("parts", [1, 7, 40])
@pytest.mark.parametrize("by", [None, "g"])
def test_range_ranks(spark, parts, by):
    """A value that holds a third of all rows spans many partitions; groups of one row; infinities."""
    r = np.random.default_rng(3)
    v = np.where(r.random(3000) < 0.34, 5.0, r.integers(0, 300, 3000) / 10)
    v[:4] = [np.inf, -np.inf, -7.5, np.inf]
    pdf = pd.DataFrame({"id": range(3000), "v": v, "g": np.where(r.random(3000) < 0.5, 2, r.integers(0, 9, 3000))})
    pdf.loc[17, "g"] = 77
    out = ranges.range_ranks(spark.createDataFrame(pdf), "v", by, parts=parts).toPandas().set_index("id").sort_index()
    np.testing.assert_allclose(out["rank"], pandas_ranks(pdf, by))
    keys = ["v", *([by] if by else [])]
    np.testing.assert_array_equal(out["ties"], pdf.groupby(keys)["id"].transform("size"))


def test_weighted_ranks_stand_for_rows(spark):
    pdf = pd.DataFrame({"v": [3.0, 1.0, 3.0, 2.0, 9.0], "w": [4, 2, 1, 5, 3]})
    out = ranges.range_ranks(spark.createDataFrame(pdf), "v", weight="w", parts=3).toPandas()
    long = pdf.loc[pdf.index.repeat(pdf["w"]), "v"]
    expected = dict(zip(long, long.rank()))
    assert {(a, b) for a, b in zip(out["v"], out["rank"])} == set(expected.items())


def test_ranks_of_nothing(spark):
    assert ranges.range_ranks(spark.createDataFrame([], "v double, g int"), "v", "g").count() == 0


def test_one_ordered_shuffle_and_no_join_on_the_value(spark):
    df = spark.range(1000).select((F.col("id") % 50).cast("double").alias("v"))
    plan = ranges.range_ranks(df, "v", parts=4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan.replace("RangePartitioning", "")


@pytest.mark.parametrize("slices", [1, 6])
def test_spearman_of_many_columns(spark, slices):
    r = np.random.default_rng(9)
    pdf = pd.DataFrame({"a": r.integers(0, 4, 900).astype(float), "b": r.normal(size=900), "c": np.round(r.normal(size=900), 1), "d": 1.0})
    pdf["b"] += pdf["a"]
    pdf.loc[::13, "c"] = np.nan
    expected = pdf.dropna().corr("spearman")
    got = {(r.column_a, r.column_b): r.rho for r in stats.corr_spearman(spark.createDataFrame(pdf), list("abcd"), slices).collect()}
    assert len(got) == 16
    for (a, b), rho in got.items():
        assert (rho is None and "d" in (a, b)) or rho == pytest.approx(expected.loc[a, b], abs=1e-12)


def test_pair_correlations_under_missing_values(spark):
    """Each pair over its own rows, far from zero, with null, NaN, a constant and an empty column."""
    r = np.random.default_rng(5)
    pdf = pd.DataFrame({"a": 1e6 + r.normal(size=2000), "b": r.normal(size=2000), "c": -3e5 + r.normal(size=2000) / 100})
    pdf["b"] += pdf["a"] - 1e6
    for i, c in enumerate("abc"):
        pdf.loc[r.random(2000) < 0.2 + i / 10, c] = np.nan
    expected = pdf.corr()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    df = df.withColumns({"k": F.lit(3.0), "e": F.lit(None).cast("double"), "f": F.when(F.rand(1) < 0.5, F.lit(float("nan"))).otherwise(F.col("b"))})
    got = {(r.column_a, r.column_b): r["corr"] for r in moments.pair_correlations(df.repartition(5), ["a", "b", "c", "k", "e"]).collect()}
    for a in "abc":
        for b in "abc":
            assert got[(a, b)] == pytest.approx(expected.loc[a, b], abs=1e-8)
        assert got[(a, "k")] is None and (a, "e") not in got
    nan = {(r.column_a, r.column_b): r["corr"] for r in moments.pair_correlations(df, ["b", "f"]).collect()}
    assert nan[("b", "f")] == pytest.approx(1.0)


def test_correlations_shuffle_sums_only(spark):
    df = spark.range(5000).select(*[(F.col("id") * k % 97).cast("double").alias(f"c{k}") for k in range(1, 12)])
    plan = market.corr_matrix(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline" not in plan and "MapInArrow" in plan


def numpy_lowess(x, y, points, frac, rounds):
    grid = np.unique(np.quantile(x, np.linspace(0, 1, points)))
    widths = [np.quantile(np.abs(x - g), frac) for g in grid]
    weight = np.ones(len(x))
    for i in range(rounds + 1):
        curve = []
        for g, h in zip(grid, widths):
            u = np.abs(x - g) / h
            w = weight * np.where(u < 1, (1 - u ** 3) ** 3, 0)
            d = x - g
            det = w.sum() * (w * d * d).sum() - (w * d).sum() ** 2
            curve.append(((w * d * d).sum() * (w * y).sum() - (w * d).sum() * (w * d * y).sum()) / det)
        if i < rounds:
            off = np.abs(y - np.interp(x, grid, curve))
            share = off / (6 * np.median(off))
            weight = np.where(share < 1, (1 - share ** 2) ** 2, 0)
    return dict(zip(grid, curve))


@pytest.mark.parametrize("rounds", [0, 1, 3])
@pytest.mark.parametrize("distributed_plan", [False, True])
def test_robust_smoothing_equals_numpy(spark, request, rounds, distributed_plan):
    if distributed_plan:
        request.getfixturevalue("distributed")
    r = np.random.default_rng(12)
    x = r.integers(0, 120, 800) / 4
    y = np.sin(x / 5) * 10 + r.normal(size=800)
    y[::15] += 200  # outliers
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    expected = numpy_lowess(x, y, 12, 0.3, rounds)
    got = {r.x: r.smoothed for r in stats.lowess_grid(df, "y", "x", 12, 0.3, rounds).collect()}
    assert got.keys() == expected.keys()
    for g, v in expected.items():
        assert got[g] == pytest.approx(v, abs=1e-8)
    if rounds == 3:
        assert max(abs(v - np.sin(g / 5) * 10) for g, v in got.items()) < 4


@pytest.mark.parametrize("few", [2, 100])
def test_spearman_orders_rows_only_by_columns_of_many_values(spark, monkeypatch, few):
    """Columns of few values are ranked by their counts; the others by one ordered shuffle of the rows each."""
    ordered = []

    def seen(df, value, **options):
        ordered.append((value, df.count()))
        return ranges.range_ranks(df, value, **options)

    monkeypatch.setattr(stats, "range_ranks", seen)
    monkeypatch.setattr(stats, "FEW_VALUES", few, raising=False)
    r = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": r.integers(0, 4, 700).astype(float), "b": r.normal(size=700), "c": r.integers(-9, 9, 700).astype(float)})
    expected = pdf.corr("spearman")
    got = {(r.column_a, r.column_b): r.rho for r in stats.corr_spearman(spark.createDataFrame(pdf), list("abc"), 6).collect()}
    assert {c for c, _ in ordered} == (set("abc") if few == 2 else {"b"}) and {n for _, n in ordered} == {700}
    assert all(rho == pytest.approx(expected.loc[a, b], abs=1e-12) for (a, b), rho in got.items())
