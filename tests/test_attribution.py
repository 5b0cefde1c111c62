"""Exact contributions against all orders of features, and folds fitted side by side."""

import itertools
import math
import threading

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.operators import attribution, filters, ml, trees

NAMES = ["accommodates", "bedrooms", "beds"]


@pytest.fixture(scope="module")
def rooms(spark):
    r = np.random.default_rng(8)
    x = r.integers(0, 12, (400, 3)).astype(float)
    y = x[:, 0] * x[:, 1] / 10 - np.abs(x[:, 2] - 5) + r.normal(0, 0.1, 400)
    rows = [(i, *map(float, v), "abcd"[int(v[2]) % 4], float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"id long, {', '.join(n + ' double' for n in NAMES)}, kind string, log_price double").cache()


def over_all_orders(predict, row, references):
    out = np.zeros(len(row))
    for ref in references:
        for order in itertools.permutations(range(len(row))):
            point = list(ref)
            before = predict(point)
            for j in order:
                point[j] = row[j]
                now = predict(point)
                out[j] += now - before
                before = now
    return out / len(references) / math.factorial(len(row))


ESTIMATORS = {"forest": lambda: RandomForestRegressor(labelCol="log_price", numTrees=7, maxDepth=6, seed=1),
              "tree": lambda: DecisionTreeRegressor(labelCol="log_price", maxDepth=7),
              "boosting": lambda: GBTRegressor(labelCol="log_price", maxIter=9, maxDepth=4, stepSize=0.3, seed=2)}


@pytest.mark.parametrize("kind", ESTIMATORS)
def test_contributions_equal_all_orders(spark, rooms, kind):
    model = ml.fit(rooms, ESTIMATORS[kind]())
    ensemble = trees.read_ensemble(model.stages[-1])
    predicted = {r.id: r.prediction for r in model.transform(rooms).collect()}
    values = np.array([[r[n] for n in NAMES] for r in rooms.orderBy("id").collect()])
    np.testing.assert_allclose(trees.predict(ensemble, values), [predicted[i] for i in range(400)], atol=1e-12)
    some = rooms.where("id < 12")
    drawn = [[r[n] for n in NAMES] for r in filters.sample_rows(rooms, "id", 6).collect()]
    out = {(r.id, r.feature): r for r in attribution.attribution_batch(model, some, rooms, references=6).collect()}
    assert len(out) == 12 * 3
    for r in some.collect():
        exact = over_all_orders(lambda p: float(trees.predict(ensemble, np.array([p]))[0]), [r[n] for n in NAMES], drawn)
        for name, value in zip(NAMES, exact):
            got = out[(r.id, name)]
            assert got.contribution == pytest.approx(value, abs=1e-9) and got.std_error == 0 and got.feature_value == r[name]
        assert sum(out[(r.id, n)].contribution for n in NAMES) + got.base == pytest.approx(predicted[r.id], abs=1e-9)


@pytest.mark.parametrize("rows_at_a_time", [8, 16_384])
def test_equal_rows_are_explained_once(spark, rooms, monkeypatch, rows_at_a_time):
    """Copies of rows, repeated and null keys: all are answered, few are explained, whether batches or trees are dealt out."""
    model, asked = ml.fit(rooms, ESTIMATORS["forest"]()), []
    own = trees.explain_trees

    def explain(fitted, stored, *rest):
        asked.append(stored.count())
        return own(fitted, stored, *rest)

    monkeypatch.setattr(attribution, "explain_trees", explain)
    monkeypatch.setattr(trees, "ROWS", rows_at_a_time)
    some = rooms.where("id < 30")
    copies = some.crossJoin(spark.range(50).select(F.col("id").alias("copy"))).withColumn(
        "id", F.when(F.col("copy") == 0, F.lit(None)).when(F.col("copy") == 1, F.lit(7)).otherwise(F.col("id") + 1000 * F.col("copy")))
    got = attribution.attribution_batch(model, copies, rooms, references=6).collect()
    assert asked == [some.select(*NAMES).distinct().count()]
    assert len(got) == 30 * 50 * 3 and sum(r.id is None for r in got) == sum(r.id == 7 for r in got) == 30 * 3
    ensemble = trees.read_ensemble(model.stages[-1])
    drawn = np.array([[r[n] for n in NAMES] for r in filters.sample_rows(rooms, "id", 6).collect()])
    x = some.collect()
    exact = {r.id: c for r, c in zip(x, trees.contributions(ensemble, np.array([[r[n] for n in NAMES] for r in x]), drawn))}
    for r in got:
        if r.id is not None and r.id != 7:
            assert r.contribution == pytest.approx(exact[r.id % 1000][NAMES.index(r.feature)], abs=1e-12)


def test_linear_contributions(spark, rooms):
    model = ml.fit(rooms, ml.ridge(400))
    drawn = np.array([[r[n] for n in NAMES] for r in filters.sample_rows(rooms, "id", 6).collect()])
    known, weights = {r.id: r for r in rooms.collect()}, model.stages[-1].coefficients.toArray()
    got = attribution.attribution_batch(model, rooms, rooms, references=6).collect()
    assert len(got) == 400 * 3
    for r in got:
        j = NAMES.index(r.feature)
        assert r.feature_value == known[r.id][r.feature]
        assert r.contribution == pytest.approx((r.feature_value - drawn[:, j].mean()) * weights[j], abs=1e-12)


def test_walks_come_close(spark, rooms):
    model = ml.fit(rooms, ESTIMATORS["forest"]())
    some = rooms.where("id < 8")
    exact = {(r.id, r.feature): r.contribution for r in attribution.attribution_batch(model, some, rooms, references=50).collect()}
    for r in attribution.attribution_walks(model, some, rooms, references=50, orders=50).collect():
        assert abs(r.contribution - exact[(r.id, r.feature)]) <= 6 * r.std_error + 1e-9


def test_splits_by_category(spark, rooms):
    """An indexed column is split by sets of categories."""
    stages = [StringIndexer(inputCol="kind", outputCol="kind_index"), VectorAssembler(inputCols=["kind_index", "beds"], outputCol="features"),
              RandomForestRegressor(labelCol="log_price", numTrees=5, maxDepth=5, seed=3)]
    fitted = Pipeline(stages=stages).fit(rooms)
    ensemble = trees.read_ensemble(fitted.stages[-1])
    assert any(threshold is None for _, threshold, _ in ensemble.splits)
    scored = fitted.transform(rooms).collect()
    points = np.array([r.features.toArray() for r in scored])
    np.testing.assert_allclose(trees.predict(ensemble, points), [r.prediction for r in scored], atol=1e-12)
    got = trees.contributions(ensemble, points[:9], points[-7:])
    for point, row in zip(points[:9], got):
        exact = over_all_orders(lambda p: float(trees.predict(ensemble, np.array([p]))[0]), point, points[-7:])
        np.testing.assert_allclose(row, exact, atol=1e-10)


def test_wide_paths_and_many_batches(monkeypatch):
    """Paths of over 16 features, and fewer rows at a time than there are."""
    r = np.random.default_rng(1)
    n = 20
    chain = trees.Tree(np.array([*range(n), *[-1] * (n + 1)]), np.array([*range(n), *[-1] * (n + 1)]),
                       np.array([*range(1, n), n, *[-1] * (n + 1)]), np.array([*range(n + 1, 2 * n + 1), *[-1] * (n + 1)]), r.normal(size=2 * n + 1))
    ensemble = trees.Ensemble([chain], [(f, 0.0, frozenset()) for f in range(n)])
    rows, references = r.normal(size=(3000, n)) - 1.2, r.normal(size=(30, n)) - 1.2
    monkeypatch.setattr(trees, "MASKS", 1)
    got = trees.contributions(ensemble, rows, references)
    np.testing.assert_allclose(got.sum(axis=1), trees.predict(ensemble, rows) - trees.predict(ensemble, references).mean(), atol=1e-10)
    monkeypatch.undo()
    np.testing.assert_allclose(trees.contributions(ensemble, rows[:50], references), got[:50], atol=1e-12)


def test_folds_run_side_by_side(spark, monkeypatch):
    data = spark.range(300).select("id", *[(F.col("id") % (k + 3)).cast("double").alias(n) for k, n in enumerate(fixed.MODEL_FEATURES[:3])],
                                   F.log1p(F.col("id") % 50 + 20).alias("log_price"))
    meeting, own = threading.Barrier(5, timeout=60), ml.fit

    def fit(df, estimator):
        meeting.wait()  # passes only once all five folds are being fitted
        return own(df, estimator)

    monkeypatch.setattr(ml, "fit", fit)
    together = ml.cross_validate(data, ml.ridge, "ridge").first()
    monkeypatch.setattr(ml, "fit", own)
    one_by_one = ml.cross_validate(data, ml.ridge, "ridge", parallelism=1).first()
    for name in together.asDict():
        assert together[name] == pytest.approx(one_by_one[name]) if name != "model" else together[name] == "ridge"


def test_training_rows_are_dealt_by_estimator(spark):
    rows = ml.cut_lineage(spark.range(20_000))
    assert ml.dealt_out(rows, ml.boosted_trees()).rdd.getNumPartitions() == 2
    assert ml.dealt_out(rows, ml.random_forest()).rdd.getNumPartitions() == 8
    assert ml.dealt_out(rows, ml.random_forest(), fits=5).rdd.getNumPartitions() == 2
