"""Ridge and variance inflation against closed forms; global aggregates of empty frames and NaN in both kinds of plan."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from marketlens.operators import attribution, ml, stats
from marketlens.operators.quantiles import grouped


@pytest.mark.parametrize("scale", [0.1, 1.0, 7.0])
def test_ridge_penalty(spark, scale):
    r = np.random.default_rng(2)
    x = r.normal(0, [1, 3], (200, 2))
    y = scale * (x @ [1.5, -1.2] + r.normal(0, 1, 200)) + 4
    name = ml.fixed.MODEL_FEATURES[:2]
    df = spark.createDataFrame([(i, *map(float, row), float(t)) for i, (row, t) in enumerate(zip(x, y))], f"id long, {name[0]} double, {name[1]} double, {ml.TARGET} double")
    model = ml.fit(df, ml.ridge(200, float(np.std(y)), alpha=100.0)).stages[-1]
    z = (x - x.mean(0)) / x.std(0)
    expected = np.linalg.solve(z.T @ z + 100 * np.eye(2), z.T @ (y - y.mean())) / x.std(0)
    np.testing.assert_allclose(model.coefficients.toArray(), expected, rtol=1e-6)


def test_cross_validated_ridge_knows_its_label(spark):
    seen = []

    def make(rows, sd):
        seen.append((rows, sd))
        return ml.ridge(rows, sd)

    name = ml.fixed.MODEL_FEATURES[0]
    df = spark.createDataFrame([(i, float(i % 13), math.log1p(20 + 3.0 * i % 50)) for i in range(120)], f"id long, {name} double, {ml.TARGET} double")
    ml.cross_validate(df, make, "ridge").collect()
    folds = {i: f for i, f in df.select("id", ml.fold_of("id", 5, 42)).collect()}
    label = {r["id"]: r[ml.TARGET] for r in df.collect()}
    for (rows, sd), f in zip(seen, sorted(set(folds.values()))):
        rest = [label[i] for i in label if folds[i] != f]
        assert rows == len(rest) and math.isclose(sd, np.std(rest), rel_tol=1e-9)


def test_vif_of_dependent_and_constant_columns(spark):
    r = np.random.default_rng(4)
    a, c = r.normal(size=50), r.normal(size=50)
    df = spark.createDataFrame([(float(x), float(2 * x), float(z), 3.0) for x, z in zip(a, c)], "a double, b double, c double, k double")
    got = {x["feature"]: (x["vif"], x["flag"]) for x in stats.vif(df, ["a", "b", "c", "k"]).collect()}
    assert got["a"] == (math.inf, "high") and got["b"] == (math.inf, "high") and got["k"] == (None, "")
    assert math.isclose(got["c"][0], 1 / (1 - np.corrcoef(a, c)[0, 1] ** 2), rel_tol=1e-9)


@pytest.mark.parametrize("slices", [1, 4])
def test_global_quantiles(spark, slices):
    def values(rows):
        df = spark.createDataFrame(rows, "x double")
        return [tuple(r) for r in grouped(df, [], [F.count(F.lit(1)).alias("n")], {"m": ("x", 0.5)}, slices=slices).collect()]

    assert values([]) == [(0, None)]
    assert values([(None,), (None,)]) == [(2, None)]
    assert values([(1.0,), (float("nan"),), (4.0,), (2.0,)]) == [(4, 2.0)]
    assert values([(7.0,)] * 50 + [(1.0,)]) == [(51, 7.0)]


def test_attribution_needs_a_background(spark):
    name = ml.fixed.MODEL_FEATURES[0]
    df = spark.createDataFrame([(i, float(i), float(i)) for i in range(20)], f"id long, {name} double, {ml.TARGET} double")
    model = ml.fit(df, ml.ridge(20))
    with pytest.raises(ValueError, match="background"):
        attribution.attribution_batch(model, df, df.limit(0)).collect()


@pytest.mark.parametrize("name, size", [(n, (200, 12)) for n in ("cv_random_forest", "feature_importance", "attribution_batch", "attribution_importance")]
                         + [(n, (400, 6, 0.05)) for n in ("cv_boosted_trees", "holdout_metrics")])
def test_registered_models_are_full_size(spark, monkeypatch, name, size):
    class Seen(Exception):
        pass

    def fit(df, estimator):
        raise Seen(estimator)

    monkeypatch.setattr(ml, "fit", fit)
    with pytest.raises(Seen) as seen:
        entry.queries()[name](spark, "/root/testdata/sf0.001")
    e = seen.value.args[0]
    got = (e.getNumTrees(), e.getMaxDepth()) if len(size) == 2 else (e.getMaxIter(), e.getMaxDepth(), e.getStepSize())
    assert got == size
