"""Own growth of trees against MLlib's."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from marketlens.functions import draws
from marketlens.operators import ml, tree_fits

NAMES = ml.fixed.MODEL_FEATURES[:5]


@pytest.fixture(scope="module")
def rooms(spark):
    """Few and many values, zeros, a constant, columns that say the same, and rows that come twice."""
    r = np.random.default_rng(5)
    x = np.stack([r.integers(0, 9, 900), r.normal(size=900).round(2), np.zeros(900), r.integers(-3, 3, 900), r.integers(0, 9, 900)], 1).astype(float)
    x[:, 4] = x[:, 0] > 4
    x[800:] = x[:100]
    y = x[:, 0] * x[:, 1] + np.abs(x[:, 3]) + r.normal(0, 0.2, 900)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))]
    return ml.assembled(spark.createDataFrame(rows, f"id long, {', '.join(n + ' double' for n in NAMES)}, {ml.TARGET} double"))


def nodes(spark, model, folder):
    model.write().save(str(folder))
    return [str(r) for r in spark.read.parquet(f"{folder}/data").orderBy("treeID", "nodeData.id").collect()]


@pytest.mark.parametrize("partitions", [1, 3])
@pytest.mark.parametrize("change", [{}, {"subsamplingRate": 1.0, "featureSubsetStrategy": "all"}, {"minInstancesPerNode": 40, "maxBins": 4},
                                    {"minInfoGain": 0.05, "seed": -7, "minWeightFractionPerNode": 0.02}])
def test_boosting_is_that_of_mllib(spark, rooms, tmp_path, partitions, change):
    estimator, dealt = ml.boosted_trees(rounds=12, rate=0.3, depth=4).setParams(**change), rooms.repartition(partitions, "id")
    theirs, own = estimator.fit(dealt), ml.fit(dealt, estimator).stages[-1]
    assert nodes(spark, own, tmp_path / "own") == nodes(spark, theirs, tmp_path / "theirs")
    assert own.treeWeights == theirs.treeWeights and own.numFeatures == theirs.numFeatures and own.uid == theirs.uid
    assert own.extractParamMap().keys() and own.featureImportances == theirs.featureImportances
    both = own.transform(rooms).select("id", "prediction").join(theirs.transform(rooms).select("id", F.col("prediction").alias("p")), "id")
    assert both.where("prediction <> p").count() == 0 and both.count() == 900


def test_boosting_of_a_sample_of_values(spark, tmp_path):
    """More rows than thresholds are chosen from."""
    rows = ml.assembled(spark.range(25_000).select("id", *[((F.col("id") * (k + 7919)) % (k * 40 + 11)).cast("double").alias(n) for k, n in enumerate(NAMES)],
                                                   F.log1p((F.col("id") * 31) % 977).alias(ml.TARGET))).repartition(3, "id")
    estimator = ml.boosted_trees(rounds=4, depth=3)
    assert nodes(spark, ml.fit(rows, estimator).stages[-1], tmp_path / "own") == nodes(spark, estimator.fit(rows), tmp_path / "theirs")


def test_boosting_runs_no_job_per_tree(spark, rooms):
    spark.sparkContext.setJobGroup("boosting", "")
    try:
        model = ml.fit(rooms, ml.boosted_trees(rounds=40)).stages[-1]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert model.getNumTrees == 40
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosting")) < 40


def test_other_fits_stay_with_mllib(spark, rooms, monkeypatch):
    assert tree_fits.grows_here(rooms, ml.boosted_trees())
    for other in (ml.boosted_trees().setLossType("absolute"), ml.boosted_trees().setFeatureSubsetStrategy("sqrt"),
                  ml.boosted_trees().setWeightCol("accommodates"), ml.boosted_trees().setValidationIndicatorCol("v"), ml.ridge(900)):
        assert not tree_fits.grows_here(rooms, other)
    monkeypatch.setattr(tree_fits, "TASK_ROWS", 899)
    assert not tree_fits.grows_here(rooms, ml.boosted_trees())


def test_degenerate_boosting(spark, tmp_path):
    """A label without variance, and features without a split."""
    for k, (x, y) in enumerate([(lambda i: float(i % 3), lambda i: 2.0), (lambda i: 1.0, lambda i: float(i % 4))]):
        rows = ml.assembled(spark.createDataFrame([(i, x(i), y(i)) for i in range(20)], f"id long, {NAMES[0]} double, {ml.TARGET} double")).coalesce(1)
        estimator = GBTRegressor(labelCol=ml.TARGET, maxIter=3, seed=1)
        assert nodes(spark, ml.fit(rows, estimator).stages[-1], tmp_path / f"own{k}") == nodes(spark, estimator.fit(rows), tmp_path / f"theirs{k}")


def test_draws():
    """Values of Spark's generator, and many at once against one by one."""
    one = draws.XorShift(42)
    assert draws.XorShift(42).doubles(3000).tolist() == [one.double() for _ in range(3000)]
    assert sorted(draws.reservoir(16, 16, 5)) == list(range(16)) and len(set(draws.reservoir(16, 13, 5))) == 13


# Forests


@pytest.fixture()
def own_forests(monkeypatch):
    monkeypatch.setattr(tree_fits, "FOREST_ROWS", 1)


def settings_of(rooms, **change):
    rows = rooms.select(tree_fits.vector_to_array("features").alias("x"), F.col(ml.TARGET).alias("y"))
    thresholds = tree_fits.find_thresholds(rows, rows.count(), 32, 42)
    table = rows.toArrow().combine_chunks()
    x, y = tree_fits._matrix(table["x"].combine_chunks(), len(thresholds)), table["y"].to_numpy()
    known = dict(trees=1, depth=7, min_rows=5, min_weight=0.0, min_gain=0.0, seed=42, sampling=1.0, features=len(thresholds)) | change
    return tree_fits.Settings(thresholds, **known), x, y


@pytest.mark.parametrize("depth, min_rows", [(0, 1), (3, 1), (12, 1), (12, 5), (12, 300)])
def test_tree_of_all_rows_is_that_of_mllib(spark, rooms, depth, min_rows):
    settings, x, y = settings_of(rooms, depth=depth, min_rows=min_rows)
    tree = RandomForestRegressor(labelCol=ml.TARGET, numTrees=1, maxDepth=depth, minInstancesPerNode=min_rows, seed=42,
                                 featureSubsetStrategy="all", bootstrap=False).fit(rooms)
    predicted = np.array([tree.predict(Vectors.dense(row)) for row in x])
    grown = tree_fits.grow(settings.binned(x), y, np.ones(len(y), np.uint8), settings)
    np.testing.assert_allclose(grown.value[tree_fits._leaves(grown, settings.binned(x))], predicted, atol=1e-9)
    assert tree_fits._records(0, grown, settings).num_rows == tree.totalNumNodes


def test_rows_with_counts_are_repeated_rows(spark, rooms):
    settings, x, y = settings_of(rooms)
    times = np.random.default_rng(1).poisson(1.0, len(y))
    at = np.flatnonzero(times)
    bins = settings.binned(x)
    one = tree_fits.grow(bins[:, at].copy(), y[at], times[at].astype(np.uint8), settings)
    other = tree_fits.grow(np.repeat(bins, times, axis=1), np.repeat(y, times), np.ones(times.sum(), np.uint8), settings)
    np.testing.assert_allclose(one.value[tree_fits._leaves(one, bins)], other.value[tree_fits._leaves(other, bins)], atol=1e-9)
    np.testing.assert_allclose(one.sums[0], [times.sum(), (times * y).sum(), (times * y * y).sum()])


def test_large_forests_are_grown_here(spark, rooms, own_forests, tmp_path):
    """All trees at full depth from few jobs, as a model that scores, is saved and is loaded as MLlib's."""
    spark.sparkContext.setJobGroup("forest", "")
    try:
        model = ml.fit(rooms, ml.random_forest(trees=9, depth=12, min_leaf=1))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # MLlib runs a job for every level.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("forest")) < 40
    forest = model.stages[-1]
    assert forest.getNumTrees == 9 and forest.getMaxDepth() == 12 and len({t.numNodes for t in forest.trees}) > 1
    assert sum(forest.featureImportances) == pytest.approx(1.0) and forest.featureImportances[2] == 0
    scored = model.transform(rooms)
    error, spread = scored.agg(F.avg(F.pow(F.col("prediction") - F.col(ml.TARGET), 2)), F.var_pop(ml.TARGET)).first()
    theirs = ml.pipeline(rooms, ml.random_forest(9, 12, 1)).fit(rooms).transform(rooms).agg(F.avg(F.pow(F.col("prediction") - F.col(ml.TARGET), 2))).first()[0]
    assert error < spread / 10 and error < 2 * theirs
    ml.save_model(model, str(tmp_path / "model"))
    again = ml.load_model(str(tmp_path / "model")).transform(rooms)
    assert scored.select("id", "prediction").exceptAll(again.select("id", "prediction")).count() == 0
    repeated = ml.fit(rooms, ml.random_forest(trees=9, depth=12, min_leaf=1)).transform(rooms)
    assert scored.select("id", "prediction").exceptAll(repeated.select("id", "prediction")).count() == 0


@pytest.mark.parametrize("node_rows", [1, 150, 500])
def test_first_levels_are_split_by_all_tasks(spark, rooms, own_forests, monkeypatch, node_rows):
    """Trees whose rows fill no single task are the trees of one task, but for features that part the drawn rows of a small node alike."""
    monkeypatch.setattr(tree_fits, "CHUNK", 100)
    dealt, estimator = rooms.repartition(3, "id"), ml.random_forest(trees=6, depth=6)
    whole = {r.id: r.prediction for r in ml.fit(dealt, estimator).transform(rooms).collect()}
    largest, own = [], tree_fits._growth
    monkeypatch.setattr(tree_fits, "NODE_ROWS", node_rows)
    monkeypatch.setattr(tree_fits, "_growth", lambda tops, places, s: largest.append(len(places)) or own(tops, places, s))
    model = ml.fit(dealt, estimator)
    assert largest[0] == 0 if node_rows == 1 else largest[0] > 6
    scored = model.transform(rooms).collect()
    apart = [abs(r.prediction - whole[r.id]) for r in scored]
    assert len(scored) == 900 and np.mean(np.array(apart) < 1e-9) > 0.98 and np.mean(apart) < 0.01 * np.std([*whole.values()])


def test_folds_and_holdouts_are_grown_here(spark, rooms, own_forests, monkeypatch):
    """Every fold's forest and the boosting of a holdout, whose errors are those of MLlib's fit."""
    fits, own = [], tree_fits.fit
    monkeypatch.setattr(tree_fits, "fit", lambda df, estimator: fits.append(type(estimator).__name__) or own(df, estimator))
    plain = rooms.drop("features").withColumn("price", F.expm1(F.abs(F.col(ml.TARGET)) / 20)).withColumn(ml.TARGET, F.log1p("price"))
    row = ml.cross_validate(plain, lambda rows, sd: ml.random_forest(4, 6), "forest").first()
    assert fits == ["RandomForestRegressor"] * 5 and 0 < row["mae_mean"] < plain.agg(F.stddev("price")).first()[0]
    here = {r.part: r for r in ml.holdout_metrics(plain, ml.boosted_trees(5, 0.3, 3)).collect()}
    assert fits[5:] == ["GBTRegressor"]
    monkeypatch.setattr(tree_fits, "grows_here", lambda *_: False)
    theirs = {r.part: r for r in ml.holdout_metrics(plain, ml.boosted_trees(5, 0.3, 3)).collect()}
    assert len(fits) == 6 and here.keys() == theirs.keys() == {"train", "test"}
    for part, r in here.items():
        assert r.n == theirs[part].n and r.mae == pytest.approx(theirs[part].mae, rel=1e-12)
