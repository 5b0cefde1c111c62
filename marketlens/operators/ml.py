"""Price models: preparation, training, cross-validation, scoring and error analysis with MLlib."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.functions.scalar import flag_to_int, flag_to_tf, number, right_closed_bin, round_half_even
from marketlens.operators import tree_fits
from marketlens.operators.cleaning import has
from marketlens.operators.quantiles import grouped, scalar_quantiles
from marketlens.sizing import cut_lineage, scanned_bytes

TARGET = "log_price"
#: Rows of a task in a fit over fewer rows than the cluster's tasks can hold.
ROWS_PER_TASK, FOREST_ROWS_PER_TASK = 16_384, 1024


# Preparation

#: Columns that one_hot makes at most from values it finds itself.
MAX_CATEGORIES = 1000


def mode_of(df: DataFrame, column: str) -> Column:
    """The most frequent known value (smallest on ties) as a scalar subquery, from per-value counts."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(column).alias("v")))["v"].alias("mode")).scalar()


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing values take the exact median of their column."""
    known = [c for c in columns if c in df.columns]
    medians = scalar_quantiles(df, {c: (c, 0.5) for c in known})
    return df.withColumns({c: F.coalesce(F.col(c), medians[c]) for c in known})


def fill_mode(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), mode_of(df, column)))


def prepare_model_table(master: DataFrame, key: str = "id") -> DataFrame:
    """Priced listings with the model columns: medians and modes filled, flags as t/f.

    The columns are stored once: every median and mode is a query of its own, and each would join the listings again.
    """
    df = cut_lineage(master.select(key, *[c for c in fixed.ML_COLUMNS if c in master.columns]).where(F.col("price").isNotNull()))
    df = fill_median(df, ["review_scores_rating", "bedrooms"])
    if has(df, "host_is_superhost"):
        df = fill_mode(df, "host_is_superhost")
    flags = [c for c in ("host_is_superhost", "instant_bookable") if c in df.columns]
    return df.withColumns({c: flag_to_tf(c) for c in flags}).dropna(subset=flags)


def one_hot(df: DataFrame, column: str, prefix: str, categories: Sequence[str] | None = None) -> DataFrame:
    """0/1 columns for all but the first category in order.

    Each category becomes a column, so the list is a schema. It is read from the data when not given; a column with more
    than MAX_CATEGORIES values is refused.
    """
    if categories is None:
        found = df.where(F.col(column).isNotNull()).select(column).distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"{column} has more than {MAX_CATEGORIES} values: name the categories")
        categories = [r[0] for r in found]
    return df.withColumns({
        f"{prefix}_{c}": F.coalesce(F.col(column) == c, F.lit(False)).cast("int") for c in sorted(categories)[1:]
    })


def model_features(df: DataFrame, room_types: Sequence[str] = fixed.ROOM_TYPES) -> DataFrame:
    """Ratios, flags and room indicators derived from the listing's own columns."""
    out = df.withColumns({
        "guests_per_bedroom": F.when(F.col("bedrooms") > 0, F.col("accommodates") / F.col("bedrooms")).otherwise(
            F.col("accommodates").cast("double")),
        "review_density": F.when(
            F.col("availability_365") > 0,
            round_half_even(F.try_divide(F.col("number_of_reviews"), F.col("availability_365")), 4)).otherwise(F.lit(0.0)),
        "has_reviews": F.coalesce(F.col("number_of_reviews") > 0, F.lit(False)).cast("int"),
        "is_popular": F.coalesce(F.col("number_of_reviews") >= 20, F.lit(False)).cast("int"),
    })
    return one_hot(out, "room_type", "room", room_types)


def build_feature_table(prepared: DataFrame, key: str = "id", room_types: Sequence[str] = fixed.ROOM_TYPES) -> DataFrame:
    """The model-ready table: the fixed feature list, both targets, complete rows only."""
    df = fill_median(prepared.withColumn("bathrooms", number("bathrooms")), ["bathrooms"])
    df = df.withColumn("is_superhost", flag_to_int("host_is_superhost"))
    df = model_features(df, room_types).withColumn(TARGET, F.log1p("price"))
    kept = [c for c in fixed.MODEL_FEATURES if c in df.columns]
    numbers = [F.col(f"`{c}`").cast("double").alias(c) for c in kept]
    return df.select(key, *numbers, TARGET, "price").dropna()


def scoring_features(candidates: DataFrame, room_types: Sequence[str] = fixed.ROOM_TYPES) -> DataFrame:
    """Features of candidate listings; absent or missing inputs take their defaults."""
    filled = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in candidates.columns else F.lit(v)
        for c, v in fixed.CANDIDATE_DEFAULTS.items()
    }
    df = candidates.withColumns(filled)
    whole = {c: F.col(c).cast("long") for c in
             ("accommodates", "availability_365", "minimum_nights", "number_of_reviews")}
    df = model_features(df.withColumns(whole), room_types).withColumn("is_superhost", F.col("is_superhost").cast("int"))
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in fixed.MODEL_FEATURES if c in df.columns})


# Models


def ridge(rows: int, label_sd: float = 1.0, alpha: float = 10.0) -> LinearRegression:
    """L2 regression on standardised features, the solution of (Z'Z + alpha I) b = Z'y.

    MLlib's penalty is per row and divided by the label's population deviation, hence both factors.
    """
    return LinearRegression(labelCol=TARGET, elasticNetParam=0.0, regParam=alpha * label_sd / max(rows, 1), solver="normal")


def ridge_for(df: DataFrame, alpha: float = 10.0) -> LinearRegression:
    """ridge() for the rows and label deviation of a training set, from one aggregate over it."""
    rows, sd = df.agg(F.count(TARGET), F.stddev_pop(TARGET)).first()
    return ridge(rows, sd if sd is not None else 1.0, alpha)


def random_forest(trees: int = 200, depth: int = 12, min_leaf: int = 5, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=TARGET, numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf,
                                 featureSubsetStrategy="all", seed=seed)


def boosted_trees(rounds: int = 400, rate: float = 0.05, depth: int = 6, rows: float = 0.8, columns: float = 0.8,
                  seed: int = 42) -> GBTRegressor:
    return GBTRegressor(labelCol=TARGET, maxIter=rounds, stepSize=rate, maxDepth=depth, subsamplingRate=rows,
                        featureSubsetStrategy=str(columns), seed=seed)


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in fixed.MODEL_FEATURES if c in df.columns]


def pipeline(df: DataFrame, estimator: Estimator) -> Pipeline:
    """Assembler and estimator; the fitted pipeline carries the ordered feature list with it.

    A frame that has its features already (`assembled`) needs the estimator alone.
    """
    if "features" in df.columns:
        return Pipeline(stages=[estimator])
    return Pipeline(stages=[VectorAssembler(inputCols=feature_names(df), outputCol="features"), estimator])


def fit(df: DataFrame, estimator: Estimator) -> PipelineModel:
    """Forests of many rows and boosted trees are grown by `tree_fits`, all else by MLlib."""
    stages = pipeline(df, estimator).getStages()
    rows = reduce(lambda d, stage: stage.transform(d), stages[:-1], df)
    if tree_fits.grows_here(rows, estimator):
        return PipelineModel([*stages[:-1], tree_fits.fit(rows, estimator)])
    return pipeline(df, estimator).fit(df)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_feature_list(model: PipelineModel) -> list[str]:
    return list(model.stages[0].getInputCols())


# Evaluation


def fold_of(key: str, folds: int = 5, seed: int = 42) -> Column:
    """Fold number from a keyed hash: the same row is always in the same fold."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("int")


def train_test_split(df: DataFrame, key: str = "id", test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    bucket = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1_000_000))
    in_test = bucket < int(test_share * 1_000_000)
    return df.where(~in_test), df.where(in_test)


def score_batch(model: Model, df: DataFrame) -> DataFrame:
    """Price prediction per row with residual, absolute and percentage error, keeping all columns."""
    out = model.transform(df).withColumn("predicted", F.expm1("prediction")).drop("features", "prediction")
    return with_errors(out) if "price" in df.columns else out


def with_errors(df: DataFrame, actual: str = "price", predicted: str = "predicted") -> DataFrame:
    residual = F.col(actual) - F.col(predicted)
    return df.withColumns({
        "residual": residual, "abs_error": F.abs(residual),
        "pct_error": F.abs(residual / F.greatest(F.col(actual), F.lit(1.0))) * 100,
    })


def regression_metrics(df: DataFrame, by: Sequence[str] = (), actual: str = "price", predicted: str = "predicted") -> DataFrame:
    """MAE, RMSE, both forms of MAPE and R2, in one pass."""
    a, p = F.col(actual), F.col(predicted)
    error = a - p
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(error / (a + 1e-9))) * 100).alias("mape"),
        (F.avg(F.abs(error / F.greatest(a, F.lit(1.0)))) * 100).alias("mape_floored"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(a))).alias("r2"),
    )


def assembled(df: DataFrame) -> DataFrame:
    """The features put together once and stored, for fits that read the same rows many times."""
    return cut_lineage(VectorAssembler(inputCols=feature_names(df), outputCol="features").transform(df))


def dealt_out(stored: DataFrame, estimator: Estimator, key: str = "id", fits: int = 1) -> DataFrame:
    """Stored training rows, dealt out by key over as many tasks as the fit keeps busy beside `fits` - 1 others.

    A fit runs a short job for every level of every tree. Boosting grows one tree at a time, so few rows stay in few tasks; a
    forest grows all trees at once and spreads earlier. Rows that fill the cluster's tasks as stored are left as they lie.
    """
    cores = stored.sparkSession.sparkContext.defaultParallelism
    if scanned_bytes(stored) >= cores * 64 * 1024 * 1024:
        return stored
    per_task = FOREST_ROWS_PER_TASK if isinstance(estimator, RandomForestRegressor) else ROWS_PER_TASK
    return stored.repartition(max(1, min(-(-cores // fits), -(-stored.count() // per_task))), key)


def cross_validate(df: DataFrame, make: Callable[[int, float], Estimator], name: str, key: str = "id", folds: int = 5,
                   seed: int = 42, parallelism: int = 5) -> DataFrame:
    """Mean and population deviation of the fold errors in price units, one row.

    `make(rows, label_sd)` gives a fresh estimator for a training set of that size and label deviation. Folds are fitted
    side by side, `parallelism` at a time, over one assembled and stored frame, so that the many small jobs of one fit
    fill the gaps of the others. The predictions of all folds stay distributed and are scored together.
    """
    data = assembled(df.withColumn("_fold", fold_of(key, folds, seed)))
    label = F.col(TARGET)
    moments = {r["_fold"]: r for r in data.groupBy("_fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(label).alias("mean"), F.var_pop(label).alias("var")).collect()}
    estimators = {}
    for f in sorted(moments):
        rest = [m for g, m in moments.items() if g != f]
        rows = sum(m["n"] for m in rest)
        mean = sum(m["n"] * m["mean"] for m in rest) / max(rows, 1)
        sd = (sum(m["n"] * (m["var"] + (m["mean"] - mean) ** 2) for m in rest) / max(rows, 1)) ** 0.5
        estimators[f] = make(rows, sd)

    def predictions(f: int) -> DataFrame:
        model = fit(dealt_out(data.where(F.col("_fold") != f), estimators[f], key, min(parallelism, len(estimators))), estimators[f])
        return model.transform(data.where(F.col("_fold") == f)).select(
            "_fold", F.expm1(TARGET).alias("price"), F.expm1("prediction").alias("predicted"))

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        parts = list(pool.map(inheritable_thread_target(df.sparkSession)(predictions), estimators))
    per_fold = regression_metrics(reduce(DataFrame.unionByName, parts), ["_fold"])
    return per_fold.agg(
        F.lit(name).alias("model"),
        *[f(m).alias(f"{m}_{suffix}") for m in ("mae", "rmse", "mape") for f, suffix in
          ((F.avg, "mean"), (F.stddev_pop, "std"))])


def best_model(comparison: DataFrame, metric: str = "mae_mean") -> DataFrame:
    return comparison.agg(F.min_by("model", metric).alias("model"), F.min(metric).alias(metric))


def holdout_metrics(df: DataFrame, estimator: Estimator, key: str = "id") -> DataFrame:
    """Training and test errors of one holdout fit."""
    train, test = train_test_split(assembled(df), key)
    model = fit(dealt_out(train, estimator, key), estimator)
    scored = [score_batch(model, part).withColumn("part", F.lit(name)) for name, part in (("train", train), ("test", test))]
    return regression_metrics(scored[0].unionByName(scored[1]), ["part"])


def error_by(df: DataFrame, by: str | Column, name: str = "group", error: str = "abs_error", slices: int | None = None) -> DataFrame:
    """Median absolute error and rows per group."""
    group = F.col(by) if isinstance(by, str) else by
    keyed = df.select(group.alias(name), F.col(error).alias("_e")).where(F.col(name).isNotNull())
    return grouped(keyed, [name], [F.count("_e").alias("n")], {"median_abs_error": ("_e", 0.5)}, slices)


def price_bucket(price: str = "price") -> Column:
    bucket = right_closed_bin(price, fixed.ERROR_BUCKET_EDGES, fixed.ERROR_BUCKET_LABELS)
    return F.when(F.col(price) <= fixed.ERROR_BUCKET_EDGES[-1], bucket)


def best_and_worst(errors: DataFrame, name: str = "group", k: int = 5) -> DataFrame:
    """The k groups with the smallest and the k with the largest error."""
    low = errors.orderBy("median_abs_error", name).limit(k).withColumn("side", F.lit("best"))
    high = errors.orderBy(F.col("median_abs_error").desc(), name).limit(k).withColumn("side", F.lit("worst"))
    return low.unionByName(high)


def residual_summary(df: DataFrame, price_cap: float = 800, residual_cap: float = 400) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"), F.avg("residual").alias("mean_residual"), F.stddev_pop("residual").alias("std_residual"),
        F.count_if(F.col("price") <= price_cap).alias("rows_within_price_cap"),
        F.count_if(F.abs("residual") <= residual_cap).alias("rows_within_residual_cap"),
    )


def attach_attributes(predictions: DataFrame, attributes: DataFrame, key: str = "id") -> DataFrame:
    """Join predictions to listing attributes by key (never by position)."""
    return predictions.join(attributes, key)


def feature_importance(model: PipelineModel) -> DataFrame:
    """Importance per feature, smallest first. The list is as long as the feature list."""
    values = model.stages[-1].featureImportances.toArray()
    rows = [(n, fixed.FEATURE_LABELS.get(n, n), float(v)) for n, v in zip(model_feature_list(model), values)]
    return SparkSession.active().createDataFrame(rows, "feature string, label string, importance double").orderBy("importance", "feature")
