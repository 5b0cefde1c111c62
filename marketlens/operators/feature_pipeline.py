"""A price model that carries its own features: from raw listing columns to a prediction in one stored PipelineModel.

Everything the features need is fitted once and becomes part of the model: the exact medians that fill missing numbers, the
categories behind the indicator columns, the ratios and flags. Scoring a raw candidate, also after loading the model
elsewhere, is `model.transform`. Categories become indicators in a sparse vector, so their number is not bounded by a
column limit; the first category in order has none, and a value the model has not seen (or null) has all zeros.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.operators.filters import leaking_features
from marketlens.operators.quantiles import grouped
from marketlens.sizing import cut_lineage

#: Raw numbers of a listing that are features as they are.
NUMBERS = ("accommodates", "bedrooms", "bathrooms", "beds", "availability_365", "minimum_nights", "number_of_reviews", "review_scores_rating")
#: Raw category -> prefix of its indicators.
CATEGORIES = {"room_type": "room", "property_type": "property", "neighbourhood_cleansed": "neighbourhood"}
DERIVED = ("guests_per_bedroom", "review_density", "is_superhost", "has_reviews", "is_popular")


def _literal(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def fill_statement(fills: Mapping[str, float]) -> str:
    """Raw numbers read leniently, those missing or unreadable filled; the host flag in any of its spellings as 0 or 1."""
    numbers = [f"coalesce(nanvl(try_cast(`{c}` AS DOUBLE), CAST(NULL AS DOUBLE)), {_literal(v)}) AS `_{c}`" for c, v in fills.items()]
    flag = "CAST(coalesce(lower(CAST(host_is_superhost AS STRING)) IN ('true', '1', '1.0', 't'), false) AS DOUBLE) AS is_superhost"
    return f"SELECT *, {', '.join(numbers)}, {flag} FROM __THIS__"


DERIVE_STATEMENT = """SELECT *,
  CASE WHEN _bedrooms > 0 THEN _accommodates / _bedrooms ELSE _accommodates END AS guests_per_bedroom,
  CASE WHEN _availability_365 > 0 THEN rint(_number_of_reviews / _availability_365 * 10000D) / 10000D ELSE 0D END AS review_density,
  CAST(_number_of_reviews > 0 AS DOUBLE) AS has_reviews, CAST(_number_of_reviews >= 20 AS DOUBLE) AS is_popular
FROM __THIS__"""


def with_inputs(df: DataFrame) -> DataFrame:
    """Absent inputs as null columns, so that the model's own fills apply."""
    absent = {c: "double" for c in NUMBERS} | {"host_is_superhost": "string"} | {c: "string" for c in CATEGORIES}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in absent.items() if c not in df.columns})


def _indexer(categories: Sequence[str]) -> StringIndexer:
    return StringIndexer(inputCols=list(categories), outputCols=[f"_{c}_index" for c in categories], handleInvalid="keep",
                         stringOrderType="alphabetAsc")


def fit_features(df: DataFrame, categories: Sequence[str] = tuple(CATEGORIES), fills: Mapping[str, float] | None = None,
                 drop_first: bool = True) -> PipelineModel:
    """The fitted feature stages over raw listing columns: fills, ratios, flags, indicators, one vector `features`.

    `fills` are the exact medians of the frame unless given (`fixed.CANDIDATE_DEFAULTS` has the serving defaults). A number
    without any known value takes its serving default. Categories are counted in one pass of the indexer. The columns read
    are stored once, since medians, categories and stages are fitted by queries of their own.
    """
    names = [*NUMBERS, *DERIVED, *categories]
    if leaks := leaking_features(names):
        raise ValueError(f"features that give the price away: {leaks}")
    raw = cut_lineage(with_inputs(df).select(*dict.fromkeys([*NUMBERS, "host_is_superhost", *CATEGORIES, *categories])))
    if fills is None:
        known = {c: F.nanvl(F.col(c).try_cast("double"), F.lit(None).cast("double")) for c in NUMBERS}
        medians = grouped(raw, [], quantiles={c: (v, 0.5) for c, v in known.items()}).first().asDict()
        fills = {c: medians[c] if medians[c] is not None else float(fixed.CANDIDATE_DEFAULTS[c]) for c in NUMBERS}
    filled = SQLTransformer(statement=fill_statement({c: float(fills[c]) for c in NUMBERS}))
    derived = SQLTransformer(statement=DERIVE_STATEMENT)
    stages = [filled, derived]
    parts = [*[f"_{c}" for c in NUMBERS], *DERIVED]
    indexed = _indexer(categories).fit(raw.select(*categories)) if categories else None
    labels = indexed.labelsArray if categories else []
    kept = [c for c, known in zip(categories, labels) if len(known) > (1 if drop_first else 0)]
    if kept:
        hot = [f"_{c}_hot" for c in kept]
        # An unseen value takes an index behind the known ones, which the encoder drops.
        several = indexed if len(kept) == len(labels) else _indexer(kept).fit(raw.select(*kept))
        stages += [several, OneHotEncoder(inputCols=[f"_{c}_index" for c in kept], outputCols=hot, dropLast=True)]
        if drop_first:
            count = {c: len(known) for c, known in zip(categories, labels)}
            stages += [VectorSlicer(inputCol=h, outputCol=f"{h}_rest", indices=list(range(1, count[c]))) for c, h in zip(kept, hot)]
            hot = [f"{h}_rest" for h in hot]
        parts += hot
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages).fit(raw)


def feature_labels(features: PipelineModel, drop_first: bool = True) -> list[str]:
    """Names of the vector's places, indicators as prefix_category."""
    names = [*NUMBERS, *DERIVED]
    for stage in features.stages:
        if isinstance(stage, StringIndexerModel):
            for c, labels in zip(stage.getInputCols(), stage.labelsArray):
                names += [f"{CATEGORIES.get(c, c)}_{label}" for label in labels[1 if drop_first else 0:]]
    return names


def fit_price_model(df: DataFrame, estimator: Estimator, categories: Sequence[str] = tuple(CATEGORIES), price: str = "price") -> PipelineModel:
    """Features and a regressor of the log price, as one PipelineModel over raw columns.

    Rows without a positive price teach nothing. The features are stored once, since a fit reads them many times.
    """
    raw = with_inputs(df.where(F.col(price) > 0))
    features = fit_features(raw, categories)
    data = cut_lineage(features.transform(raw).select("features", F.log1p(price).alias("log_price")))
    return PipelineModel(stages=[*features.stages, estimator.fit(data)])


def score_raw(model: PipelineModel, candidates: DataFrame) -> DataFrame:
    """Candidates as they came, with `predicted` prices; absent columns count as missing values."""
    scored = model.transform(with_inputs(candidates))
    return scored.select(*[F.col(f"`{c}`") for c in candidates.columns], F.expm1("prediction").alias("predicted"))


def feature_values(features: PipelineModel, df: DataFrame, names: Sequence[str], key: str = "id", nonzero: bool = True) -> DataFrame:
    """(key, feature, value) per row and place of the vector, without zeros unless asked for."""
    labels = F.array(*[F.lit(n) for n in names])
    out = features.transform(with_inputs(df)).select(key, F.explode(F.arrays_zip(labels.alias("feature"), vector_to_array("features").alias("value"))).alias("_f"))
    out = out.select(key, "_f.feature", "_f.value")
    return out.where(F.col("value") != 0) if nonzero else out
