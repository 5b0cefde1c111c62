"""Feature attribution, explanations and valuations in batch."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.functions.scalar import round_half_even
from marketlens.operators.filters import sample_rows
from marketlens.operators.ml import model_feature_list
from marketlens.operators.quantiles import grouped
from marketlens.operators.trees import explain_linear, explain_trees, has_exact_contributions
from marketlens.sizing import broadcast_if_small, cut_lineage, join_small, spread


def _references(background: DataFrame, key: str, names: Sequence[str], references: int, seed: int) -> list[list[float]]:
    """At most `references` rows of the background, drawn reproducibly."""
    drawn = [[float(r[n]) for n in names] for r in sample_rows(background, key, references, seed).collect()]
    if not drawn:
        raise ValueError("the background has no rows to take references from")
    return drawn


def attribution_batch(model: PipelineModel, df: DataFrame, background: DataFrame, key: str = "id", references: int = 100,
                      seed: int = 42) -> DataFrame:
    """Shapley contributions of every feature to the model output of every row, against `references` background rows.

    Exact for forests, boosted and single regression trees (`trees`) and for linear models: the mean over all orders of
    features and over all reference rows, so `std_error` is 0. Other models are walked (`attribution_walks`). A row's
    contributions add up to its prediction minus `base`, the mean prediction of the reference rows.

    Model and references are broadcast. Trees explain every distinct row of features once, and the rows are joined
    to what was found for their features; linear models explain a row where it lies. `df` is read several times.
    """
    fitted, names = model.stages[-1], model_feature_list(model)
    if not has_exact_contributions(fitted):
        return attribution_walks(model, df, background, key, references, seed=seed)
    drawn = _references(background, key, names, references, seed)
    rows = df.select(F.col(key), F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("_x"))
    if isinstance(fitted, LinearRegressionModel):
        explained, base = explain_linear(fitted, spread(rows, key), names, drawn)
    else:
        found, base = explain_trees(fitted, cut_lineage(rows.select("_x").distinct()), names, drawn)
        explained = rows.join(broadcast_if_small(cut_lineage(found), 100_000), "_x")
    labels = F.array(*[F.lit(n) for n in names])
    each = F.explode(F.arrays_zip(labels.alias("feature"), F.col("_x").alias("feature_value"), F.col("_c").alias("contribution")))
    return explained.select(key, each.alias("_f")).select(key, "_f.*", F.lit(base).alias("base"), F.lit(0.0).alias("std_error"))


def attribution_walks(
    model: PipelineModel, df: DataFrame, background: DataFrame, key: str = "id", references: int = 100, orders: int = 32,
    seed: int = 42, permutations: int | None = None,
) -> DataFrame:
    """Estimated Shapley contributions for any model, with their standard errors.

    Monte Carlo over walks: a reference row turns into the explained row one feature at a time, and a
    feature's contribution is the change at its turn. There are as many walks as the larger of `references`
    and `orders`, so that each reference row, drawn reproducibly from `background`, and each order is walked;
    orders come in opposite pairs. Contributions of a row add up exactly to its prediction minus `base`, the
    mean prediction of the reference rows over the walks. `std_error` is that of the mean over the pairs of
    walks, null where there is only one. `permutations` sets both numbers.

    Walks are a small broadcast table. Rows are hashed by their key once, narrow as they are; each is then
    expanded, scored and summed in place, with no further shuffle, and only its sums become a row per feature.
    """
    references, orders = (references, orders) if permutations is None else (permutations, permutations)
    names = model_feature_list(model)
    size = len(names)
    drawn = _references(background, key, names, references, seed)
    draw = random.Random(seed)
    turns: list[list[int]] = []
    while len(turns) < orders:
        order = draw.sample(range(size), size)
        turns += [[o.index(j) + 1 for j in range(size)] for o in (order, order[::-1])]
    turns = turns[:orders]
    count = max(references, orders)
    walks = [(p // 2, min(2, count - p // 2 * 2), turns[p % orders], drawn[p % len(drawn)]) for p in range(count)]
    plans = df.sparkSession.createDataFrame(walks, "_u int, _n int, _turn array<int>, _ref array<double>")
    base = model.stages[-1].transform(plans.select(array_to_vector("_ref").alias("features"))).agg(F.avg("prediction")).first()[0]

    rows = df.select(F.col(key), F.array(*[F.col(f"`{n}`").cast("double") for n in names]).alias("_x"))
    steps = spread(rows, key).crossJoin(F.broadcast(plans)).select("*", F.explode(F.sequence(F.lit(0), F.lit(size))).alias("_s"))
    mixed = F.zip_with(F.col("_x"), F.zip_with("_turn", "_ref", lambda t, r: F.struct(t.alias("t"), r.alias("r"))),
                       lambda x, p: F.when(p["t"] <= F.col("_s"), x).otherwise(p["r"]))
    scored = model.stages[-1].transform(steps.withColumn("features", array_to_vector(mixed)))

    # Plain numbers only, so that these are hash aggregations; a value is the same in all rows of a group.
    def change(j: int) -> Column:
        turn, out = F.element_at("_turn", j + 1), F.col("prediction")
        return F.when(turn == F.col("_s"), out).when(turn == F.col("_s") + 1, -out).otherwise(0.0)

    pairs = scored.groupBy(key, "_u", "_n").agg(
        *[F.sum(change(j)).alias(f"_c{j}") for j in range(size)], *[F.max(F.element_at("_x", j + 1)).alias(f"_v{j}") for j in range(size)])
    sums = pairs.groupBy(key).agg(
        *[F.sum(f"_c{j}").alias(f"_c{j}") for j in range(size)], *[F.max(f"_v{j}").alias(f"_v{j}") for j in range(size)],
        *[F.var_samp(F.col(f"_c{j}") / F.col("_n")).alias(f"_e{j}") for j in range(size)], F.count(F.lit(1)).alias("_pairs"))
    each = F.explode(F.array(*[F.struct(
        F.lit(n).alias("feature"), F.col(f"_v{j}").alias("feature_value"), (F.col(f"_c{j}") / count).alias("contribution"),
        F.sqrt(F.col(f"_e{j}") / F.col("_pairs")).alias("std_error")) for j, n in enumerate(names)]))
    return sums.select(key, each.alias("_f")).select(
        key, "_f.feature", "_f.feature_value", "_f.contribution", F.lit(base).alias("base"), "_f.std_error")


def global_importance(attributions: DataFrame, k: int = 15) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return attributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance")).orderBy(
        F.col("importance").desc(), "feature").limit(k)


def dependence_table(attributions: DataFrame, k: int = 2, key: str = "id") -> DataFrame:
    """Value and contribution of the k most important features for every row."""
    top = F.broadcast(global_importance(attributions, k).select("feature"))
    return attributions.join(top, "feature", "left_semi").select(key, "feature", "feature_value", "contribution")


def top_contributions(attributions: DataFrame, k: int = 10, key: str = "id", minimum: float = 0.0) -> DataFrame:
    """The k strongest contributions per row, with label and place."""
    order = Window.partitionBy(key).orderBy(F.abs("contribution").desc(), "feature")
    label = F.coalesce(F.try_element_at(_literal_map(fixed.FEATURE_LABELS), F.col("feature")), F.col("feature"))
    kept = attributions.where(F.abs("contribution") > minimum).withColumn("place", F.row_number().over(order))
    return kept.where(F.col("place") <= k).withColumn("label", label)


def signed_drivers(attributions: DataFrame, k: int = 3, key: str = "id", minimum: float = 0.0) -> DataFrame:
    """The k strongest contributions per row in each direction."""
    side = F.when(F.col("contribution") > minimum, F.lit("up")).when(F.col("contribution") < -minimum, F.lit("down"))
    order = Window.partitionBy(key, "direction").orderBy(F.abs("contribution").desc(), "feature")
    sided = attributions.withColumn("direction", side).where(F.col("direction").isNotNull())
    return sided.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def driver_phrase(feature: str = "feature", value: str = "feature_value") -> Column:
    """Wording of one driver: a format per feature, else the name with blanks."""
    v, out = F.col(value), F.replace(F.col(feature), F.lit("_"), F.lit(" "))
    for name, (pattern, kind) in fixed.FEATURE_PHRASES.items():
        argument = {"int": [v.cast("long")], "float": [v], "text": [v.cast("string")]}.get(kind, [])
        text = F.format_string(pattern, *argument) if argument else F.lit(pattern)
        out = F.when(F.col(feature) == name, text).otherwise(out)
    return out


def _sentence(prefix: str, terms: Column) -> Column:
    """`a, b and c` after the prefix; nothing without terms."""
    head = F.array_join(F.slice(terms, F.lit(1), F.greatest(F.size(terms) - 1, F.lit(0))), ", ")
    joint = F.when(F.size(terms) > 1, F.lit(" and ")).otherwise(F.lit(""))
    return F.when(F.size(terms) > 0, F.concat(F.lit(prefix), head, joint, F.element_at(terms, -1), F.lit(".")))


def explain_text(attributions: DataFrame, key: str = "id", minimum: float = 0.02, k: int = 3) -> DataFrame:
    """One explanation per row from its strongest raising and lowering features."""
    side = F.when(F.col("contribution") > minimum, F.lit("up")).when(F.col("contribution") < -minimum, F.lit("down"))
    order = Window.partitionBy(key, "_side").orderBy(F.abs("contribution").desc(), "feature")
    placed = attributions.withColumn("_side", side).withColumn("_place", F.row_number().over(order))

    def terms(which: str) -> Column:
        # At most k entries per row are collected.
        entry = F.when((F.col("_side") == which) & (F.col("_place") <= k), F.struct("_place", driver_phrase().alias("text")))
        return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"])

    out = placed.groupBy(key).agg(terms("up").alias("_up"), terms("down").alias("_down"))
    text = F.concat_ws(" ", _sentence(fixed.RAISES_PREFIX, F.col("_up")), _sentence(fixed.LOWERS_PREFIX, F.col("_down")))
    return out.select(key, F.when(text == "", F.lit(fixed.NO_DRIVER_TEXT)).otherwise(text).alias("explanation"))


def valuation(predicted: DataFrame, market: DataFrame, area: str = "neighbourhood_cleansed", slices: int | None = None) -> DataFrame:
    """Predicted prices against the market: area gap, range, tier and recommendation.

    `predicted` has `predicted` and the area; `market` the known prices. An area without prices is
    compared with the overall median.
    """
    medians = grouped(market.where(F.col(area).isNotNull()), [area], quantiles={"_area_median": ("price", 0.5)}, slices=slices)
    bounds = grouped(market, [], quantiles={"median": ("price", 0.5), "p35": ("price", 0.35), "p85": ("price", 0.85)}, slices=slices)
    overall = bounds.select(F.struct("median", "p35", "p85")).scalar()
    price, base = F.col("predicted_price"), F.col("area_median")
    out = join_small(predicted, medians, area).withColumn("predicted_price", F.greatest(F.col("predicted"), F.lit(10.0)))
    out = out.withColumn("area_median", F.coalesce(F.col("_area_median"), overall["median"])).drop("_area_median")
    out = out.withColumn("price_difference", price - base).withColumn(
        "difference_pct", F.try_divide(F.col("price_difference"), base) * 100)
    gap = F.col("difference_pct")
    return out.withColumns({
        "range_min": (price * 0.95).cast("long"), "range_max": (price * 1.05).cast("long"),
        "tier": F.when(price <= overall["p35"], F.lit("Budget Option")).when(price >= overall["p85"], F.lit("Luxury Option"))
        .otherwise(F.lit("Mid-Range Option")),
        "recommendation": F.when(gap > 15, F.lit("Premium Pricing")).when(gap < -15, F.lit("Underpriced Opportunity"))
        .otherwise(F.lit("Highly Competitive")),
    })


def valuation_report(valued: DataFrame, inputs: Sequence[str], key: str = "id", area: str = "neighbourhood_cleansed") -> DataFrame:
    """One JSON document per valuation."""
    span = F.concat(F.lit("€"), F.col("range_min"), F.lit(" - €"), F.col("range_max"))
    document = F.struct(
        F.struct(*[F.col(c) for c in inputs]).alias("inputs"), F.col(area).alias("district"), F.col("property_type"),
        round_half_even("predicted_price", 2).alias("predicted_price"), round_half_even("area_median", 2).alias("district_median"),
        round_half_even("price_difference", 2).alias("price_difference"),
        round_half_even("difference_pct", 2).alias("difference_percentage"), F.col("tier"),
        F.col("recommendation").alias("valuation_recommendation"), span.alias("suggested_range"))
    return valued.select(key, F.to_json(document).alias("report"))
