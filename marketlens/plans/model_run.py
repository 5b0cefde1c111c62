"""The price models as one plan: compare, fit on all rows, store; and everything a report says about a candidate."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators import attribution, ml
from marketlens.operators.filters import leaking_features
from marketlens.sizing import cut_lineage

#: The three models of a comparison: name -> estimator for a number of rows and a label deviation.
MODELS: dict[str, Callable[[int, float], Estimator]] = {
    "Ridge Regression": ml.ridge, "Random Forest": lambda rows, sd: ml.random_forest(), "Boosted Trees": lambda rows, sd: ml.boosted_trees(),
}


def compare_models(table: DataFrame, models: Mapping[str, Callable[[int, float], Estimator]] = MODELS, key: str = "id", folds: int = 5) -> DataFrame:
    """One row per model: mean and deviation of its fold errors. All models see the same folds of the same stored table."""
    stored = cut_lineage(table)
    return reduce(DataFrame.unionByName, [ml.cross_validate(stored, make, name, key, folds) for name, make in models.items()])


def run_models(table: DataFrame, folder: str, models: Mapping[str, Callable[[int, float], Estimator]] = MODELS, key: str = "id",
               folds: int = 5) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Compare the models, fit each on all rows and store it below `folder`; the stored comparison and the fitted models.

    A table with a feature that gives the price away is refused before anything is fitted.
    """
    if leaks := leaking_features(ml.feature_names(table)):
        raise ValueError(f"features that give the price away: {leaks}")
    stored = cut_lineage(table)
    comparison = cut_lineage(compare_models(stored, models, key, folds))
    rows, sd = stored.agg(F.count(ml.TARGET), F.stddev_pop(ml.TARGET)).first()
    fitted = {}
    for name, make in models.items():
        estimator = make(rows, sd if sd is not None else 1.0)
        fitted[name] = ml.fit(ml.dealt_out(stored, estimator, key), estimator)
        ml.save_model(fitted[name], f"{folder}/{name.lower().replace(' ', '_')}")
    comparison.write.mode("overwrite").parquet(f"{folder}/comparison")
    return comparison, fitted


def value_candidates(
    candidates: DataFrame, price_model: PipelineModel, explained_model: PipelineModel, background: DataFrame, market: DataFrame,
    key: str = "id", area: str = "neighbourhood_cleansed", references: int = 100, minimum: float = 0.02,
) -> DataFrame:
    """Per candidate: predicted price, base price, contributions by weight, explanation and valuation against the market.

    `candidates` have raw inputs, absent ones take their defaults. The price comes from `price_model`, the contributions
    (log scale) from `explained_model` against rows of `background`; `market` holds the area and price of known listings.
    Everything is joined by key; candidates are read from one stored copy of their features.
    """
    features = cut_lineage(ml.scoring_features(candidates))
    shares = cut_lineage(attribution.attribution_batch(explained_model, features, background, key, references))
    place = F.struct((-F.abs("contribution")).alias("order"), "feature", "feature_value", "contribution")
    listed = F.transform(F.array_sort(F.collect_list(place)), lambda p: p.dropFields("order"))
    # A row per feature of the model and candidate: a short list each.
    parts = shares.groupBy(key).agg(F.expm1(F.max("base")).alias("base_price"), listed.alias("contributions"))
    predicted = ml.score_batch(price_model, features).select(key, area, "predicted")
    valued = attribution.valuation(predicted, market.select(area, "price"), area)
    return valued.join(parts, key).join(attribution.explain_text(shares, key, minimum), key)
