"""The stored feature pipeline against pandas, and raw candidates through a model loaded again."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.operators import feature_pipeline as fp, ml
from marketlens.plans import model_run

ROWS = [
    (1, "2", "1.0", "1.5", "1", 100.0, 2, 30, 4.5, "t", "Private room", "Loft", "North", 90.0),
    (2, "4", None, "x", "2", 0.0, 3, 0, None, "f", "Entire home/apt", "Condo", "South", 210.0),
    (3, "6", "3.0", None, "nan", 365.0, 1, 19, 4.0, None, "Shared room", None, "East-End", 320.0),
    (4, "1", "0.0", "1", "1", 30.0, 9, 20, 5.0, "true", "Private room", "Loft", None, None),
    (5, "3", "2.0", "2", "4", 200.0, 2, 7, 3.5, "0", "Hotel room", "Äpart 'ment", "North", 150.0),
]
DDL = ("id long, accommodates string, bedrooms string, bathrooms string, beds string, availability_365 double, minimum_nights int, "
       "number_of_reviews int, review_scores_rating double, host_is_superhost string, room_type string, property_type string, "
       "neighbourhood_cleansed string, price double")


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, DDL)


def test_features_equal_pandas(raw):
    features = fp.fit_features(raw)
    names = fp.feature_labels(features)
    got = pd.DataFrame(fp.feature_values(features, raw, names, nonzero=False).collect(), columns=["id", "feature", "value"]).pivot(
        index="id", columns="feature", values="value")
    pdf = pd.DataFrame(ROWS, columns=[c.split()[0] for c in DDL.split(", ")]).set_index("id")
    numbers = pdf[list(fp.NUMBERS)].apply(pd.to_numeric, errors="coerce")
    numbers = numbers.fillna(numbers.median())
    expected = [numbers, pd.get_dummies(pdf["room_type"], prefix="room", drop_first=True, dtype=float),
                pd.get_dummies(pdf["property_type"], prefix="property", drop_first=True, dtype=float),
                pd.get_dummies(pdf["neighbourhood_cleansed"], prefix="neighbourhood", drop_first=True, dtype=float)]
    derived = pd.DataFrame({
        "guests_per_bedroom": np.where(numbers["bedrooms"] > 0, numbers["accommodates"] / numbers["bedrooms"].replace(0, 1), numbers["accommodates"]),
        "review_density": np.where(numbers["availability_365"] > 0, numbers["number_of_reviews"] / numbers["availability_365"].replace(0, 1), 0).round(4),
        "is_superhost": [1.0, 0, 0, 1, 0], "has_reviews": (numbers["number_of_reviews"] > 0).astype(float),
        "is_popular": (numbers["number_of_reviews"] >= 20).astype(float)}, index=pdf.index)
    expected = pd.concat([*expected, derived], axis=1)
    assert set(names) == set(expected.columns) and len(names) == len(set(names))
    pd.testing.assert_frame_equal(got[sorted(names)], expected[sorted(names)], check_names=False, check_dtype=False)


def test_unseen_categories_and_absent_columns(spark, raw):
    features = fp.fit_features(raw)
    names = fp.feature_labels(features)
    odd = spark.createDataFrame([(9, "Castle", "5")], "id long, room_type string, accommodates string")
    got = {r.feature: r.value for r in fp.feature_values(features, odd, names, nonzero=False).collect()}
    assert got["accommodates"] == 5 and got["bedrooms"] == 1.5 and got["is_superhost"] == 0
    assert not any(v for f, v in got.items() if f.startswith(("room_", "property_", "neighbourhood_")))


def test_stored_model_scores_raw_candidates(spark, raw, tmp_path):
    many = raw.unionByName(raw).unionByName(raw).repartition(2)
    model = fp.fit_price_model(many, ml.random_forest(trees=5, depth=3, min_leaf=1))
    ml.save_model(model, str(tmp_path / "m"))
    candidates = raw.drop("price", "beds")
    here = {r.id: r.predicted for r in fp.score_raw(model, candidates).collect()}
    there = fp.score_raw(ml.load_model(str(tmp_path / "m")), candidates)
    assert there.columns == [*candidates.columns, "predicted"]
    assert {r.id: r.predicted for r in there.collect()} == here and all(v > 0 for v in here.values())


def test_columns_without_values_take_serving_defaults(spark):
    empty = spark.createDataFrame([(1, None, None)], "id long, beds double, room_type string")
    features = fp.fit_features(empty)
    got = {r.feature: r.value for r in fp.feature_values(features, empty, fp.feature_labels(features), nonzero=False).collect()}
    assert got == {**{c: float(fixed.CANDIDATE_DEFAULTS[c]) for c in fp.NUMBERS}, "guests_per_bedroom": 2.0, "review_density": 0.0556,
                   "is_superhost": 0.0, "has_reviews": 1.0, "is_popular": 0.0}


def test_a_leaking_category_is_refused(raw):
    with pytest.raises(ValueError, match="price away"):
        fp.fit_features(raw.withColumn("price_tier", raw["room_type"]), ["room_type", "price_tier"])


def test_models_are_compared_fitted_and_stored(spark, tmp_path):
    r = np.random.default_rng(2)
    pdf = pd.DataFrame(r.integers(0, 6, (300, 3)).astype(float), columns=["accommodates", "beds", "bathrooms"])
    pdf["price"] = 40 + 20 * pdf["accommodates"] + 5 * pdf["beds"] + r.normal(size=300)
    pdf["log_price"], pdf["id"] = np.log1p(pdf["price"]), range(300)
    table = spark.createDataFrame(pdf)
    models = {"Ridge Regression": ml.ridge, "Small Forest": lambda n, sd: ml.random_forest(5, 4)}
    comparison, fitted = model_run.run_models(table, str(tmp_path), models)
    assert {r.model for r in comparison.collect()} == set(models) == set(fitted)
    assert spark.read.parquet(str(tmp_path / "comparison")).count() == 2
    again = ml.load_model(str(tmp_path / "small_forest"))
    a, b = ({r.id: r.prediction for r in m.transform(table).collect()} for m in (again, fitted["Small Forest"]))
    assert a == b
    assert ml.best_model(comparison).first().model in models


def test_candidate_bundle(spark):
    r = np.random.default_rng(4)
    pdf = pd.DataFrame(r.integers(1, 5, (200, len(fixed.MODEL_FEATURES))).astype(float), columns=fixed.MODEL_FEATURES)
    pdf["log_price"], pdf["id"] = 4 + 0.2 * pdf["accommodates"], range(200)
    background = spark.createDataFrame(pdf)
    model = ml.fit(background, ml.random_forest(5, 4))
    candidates = spark.createDataFrame([(1, 4, "A"), (2, None, "B"), (3, 1, None)], "id long, accommodates int, neighbourhood_cleansed string")
    market = spark.createDataFrame([("A", 100.0), ("A", 140.0), ("C", 50.0)], "neighbourhood_cleansed string, price double")
    got = {x.id: x for x in model_run.value_candidates(candidates, model, model, background, market, references=20).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].area_median, got[2].area_median, got[3].area_median) == (120.0, 100.0, 100.0)
    for x in got.values():
        assert len(x.contributions) == len(fixed.MODEL_FEATURES) and x.explanation
        assert x.predicted == pytest.approx(np.expm1(np.log1p(x.base_price) + sum(c.contribution for c in x.contributions)))
        assert [abs(c.contribution) for c in x.contributions] == sorted((abs(c.contribution) for c in x.contributions), reverse=True)
    first = got[1].contributions[0]
    assert first.feature == "accommodates" and first.contribution > 0 and "guest capacity of 4" in got[1].explanation


def test_inputs_of_fills_are_stored_once(spark):
    """Medians, modes and categories are queries of their own; none of them joins the listings again."""
    hosts = spark.range(5).select(F.col("id").alias("host"), (F.col("id") > 2).alias("host_is_superhost"))
    rows = spark.range(60).select("id", (F.col("id") % 5).alias("host"), *[
        F.when(F.col("id") % (7 + i) != 0, (F.col("id") % (3 + i)).cast("double")).alias(c) for i, c in enumerate((*fp.NUMBERS, "price"))],
        F.lit("Hotel room").alias("room_type"), F.col("id").cast("string").alias("property_type"), F.lit("A").alias("neighbourhood_cleansed"))
    master = rows.join(hosts, "host").withColumn("instant_bookable", F.lit(True))
    table = ml.build_feature_table(ml.prepare_model_table(master))
    assert "Join" not in table._jdf.queryExecution().analyzed().toString() and table.count() > 0
    seen = []
    real = fp.grouped
    fp.grouped = lambda df, *rest, **more: seen.append(df) or real(df, *rest, **more)
    try:
        fp.fit_features(master)
    finally:
        fp.grouped = real
    assert len(seen) == 1 and "Join" not in seen[0]._jdf.queryExecution().analyzed().toString()
