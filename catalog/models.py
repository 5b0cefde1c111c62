"""Model tables, training, evaluation, attribution and valuation.

Fits have no SQL; everything around them is checked on predictions and contributions that both
engines can derive from the tables.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import roles
from catalog.oracle import oracle
from catalog.rounding import near
from marketlens.functions.fixed_values import CANDIDATE_DEFAULTS, FEATURE_LABELS, MODEL_FEATURES
from marketlens.operators import attribution, feature_pipeline as fp, ml
from marketlens.plans import model_run
from marketlens.sizing import cut_lineage, shared_folder

QUERIES = {}
L = roles.listings

PREPARED = """
SELECT id, price, room_type, property_type, accommodates, COALESCE(bedrooms, MEDIAN(bedrooms) OVER ()) AS bedrooms,
  bathrooms, beds, availability_365, minimum_nights, number_of_reviews,
  COALESCE(review_scores_rating, MEDIAN(review_scores_rating) OVER ()) AS review_scores_rating,
  CASE WHEN host_is_superhost THEN 't' ELSE 'f' END AS host_is_superhost,
  CASE WHEN instant_bookable THEN 't' ELSE 'f' END AS instant_bookable, neighbourhood_cleansed
FROM listings WHERE price IS NOT NULL"""
RATIOS = """CASE WHEN bedrooms > 0 THEN accommodates / bedrooms ELSE accommodates END AS guests_per_bedroom,
  CASE WHEN availability_365 > 0 THEN round_even(number_of_reviews / availability_365, 4) ELSE 0 END AS review_density"""
FLAGS = """CAST(number_of_reviews > 0 AS {t}) AS has_reviews, CAST(number_of_reviews >= 20 AS {t}) AS is_popular,
  CAST(room_type = 'Hotel room' AS {t}) AS "room_Hotel room", CAST(room_type = 'Private room' AS {t}) AS "room_Private room",
  CAST(room_type = 'Shared room' AS {t}) AS "room_Shared room\""""
READY = f"""
SELECT id, accommodates, bedrooms, bathrooms, beds, availability_365, minimum_nights, number_of_reviews, review_scores_rating,
  {RATIOS}, CAST(host_is_superhost = 't' AS DOUBLE) AS is_superhost, {FLAGS.format(t='DOUBLE')}, ln(1 + price) AS log_price, price
FROM (SELECT * REPLACE (COALESCE(bathrooms, MEDIAN(bathrooms) OVER ()) AS bathrooms) FROM prepared) WHERE beds IS NOT NULL"""
PARTS = {"prepared": PREPARED, "ready": READY,
         "scored": """SELECT *, price - predicted AS residual, abs(price - predicted) AS abs_error,
            abs((price - predicted) / GREATEST(price, 1)) * 100 AS pct_error
            FROM (SELECT id, room_type, neighbourhood_cleansed, price, price * 0.9 + accommodates * 2 AS predicted FROM prepared)"""}


def o(sql, extra=None):
    return oracle(sql, {**PARTS, **(extra or {})})


def prepared(s, d):
    return ml.prepare_model_table(L(s, d))


def ready(s, d):
    return ml.build_feature_table(prepared(s, d))


def scored(s, d):
    """Predictions by formula, so that SQL can follow."""
    formula = F.col("price") * 0.9 + F.col("accommodates") * 2
    rows = L(s, d).where(F.col("price").isNotNull()).select("id", "room_type", "neighbourhood_cleansed", "price", formula.alias("predicted"))
    return ml.with_errors(rows)


QUERIES["prepared_model_table"] = (prepared, o("SELECT * FROM prepared"))
QUERIES["model_ready"] = near(ready, o("SELECT * FROM ready"), "log_price", "guests_per_bedroom")
QUERIES["one_hot_room_type"] = (
    lambda s, d: ml.one_hot(L(s, d).select("id", "room_type"), "room_type", "room"),
    oracle("""SELECT id, room_type, CAST(room_type = 'Hotel room' AS INT) AS "room_Hotel room", CAST(room_type = 'Other' AS INT) AS "room_Other",
        CAST(room_type = 'Private room' AS INT) AS "room_Private room", CAST(room_type = 'Shared room' AS INT) AS "room_Shared room" FROM listings"""))
# The property types that the role of listings has: five priorities times twenty.
PROPERTIES = sorted(f"{p}/{k}" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW") for k in range(20))
QUERIES["one_hot_property_type"] = (
    lambda s, d: ml.one_hot(L(s, d).select("id", "property_type"), "property_type", "property", PROPERTIES),
    oracle("SELECT id, property_type, " + ", ".join(f"""CAST(property_type = '{p}' AS INT) AS "property_{p}\"""" for p in PROPERTIES[1:]) + " FROM listings"))
QUERIES["fill_mode"] = (
    lambda s, d: ml.fill_mode(L(s, d).select("id", "beds"), "beds"),
    oracle("""SELECT id, COALESCE(beds, (SELECT beds FROM listings WHERE beds IS NOT NULL GROUP BY beds
              ORDER BY COUNT(*) DESC, beds LIMIT 1)) AS beds FROM listings"""))
CANDIDATE = ", ".join(
    f"COALESCE({c}, {CANDIDATE_DEFAULTS[c]}) AS {c}" for c in ("bedrooms", "bathrooms", "beds", "review_scores_rating"))
QUERIES["scoring_features"] = near(
    lambda s, d: ml.scoring_features(L(s, d).drop("minimum_nights").withColumn("is_superhost", F.col("host_is_superhost")))
    .select("id", *MODEL_FEATURES),
    o(f"""SELECT id, accommodates, bedrooms, bathrooms, beds, availability_365, CAST(2 AS DOUBLE) AS minimum_nights,
        number_of_reviews, review_scores_rating, {RATIOS}, CAST(host_is_superhost AS DOUBLE) AS is_superhost, {FLAGS.format(t='DOUBLE')}
        FROM (SELECT id, accommodates, {CANDIDATE}, availability_365, number_of_reviews, host_is_superhost, room_type FROM listings)"""),
    "guests_per_bedroom")

# Evaluation on predictions by formula

METRICS = """COUNT(*) AS n, AVG(abs_error) AS mae, sqrt(AVG(residual * residual)) AS rmse,
  AVG(abs(residual / (price + 1e-9))) * 100 AS mape, AVG(pct_error) AS mape_floored, 1 - AVG(residual * residual) / VAR_POP(price) AS r2"""
NAMES = ("mae", "rmse", "mape", "mape_floored", "r2")
QUERIES["regression_metrics"] = near(lambda s, d: ml.regression_metrics(scored(s, d)), o(f"SELECT {METRICS} FROM scored"), *NAMES)
QUERIES["regression_metrics_by_room"] = near(
    lambda s, d: ml.regression_metrics(scored(s, d), ["room_type"]),
    o(f"SELECT room_type, {METRICS} FROM scored GROUP BY room_type"), *NAMES)
QUERIES["best_model"] = near(
    lambda s, d: ml.best_model(ml.regression_metrics(scored(s, d), ["room_type"]).select(
        F.col("room_type").alias("model"), F.col("mae").alias("mae_mean"))),
    o("""SELECT room_type AS model, AVG(abs_error) AS mae_mean FROM scored GROUP BY room_type ORDER BY mae_mean LIMIT 1"""), "mae_mean")
QUERIES["score_errors"] = near(scored, o("SELECT * FROM scored"), "predicted", "residual", "abs_error", "pct_error")
for _name, _by, _sql in (("room", "room_type", "room_type"), ("area", "neighbourhood_cleansed", "neighbourhood_cleansed")):
    QUERIES[f"error_by_{_name}"] = near(
        lambda s, d, b=_by: ml.error_by(scored(s, d), b),
        o(f'SELECT {_sql} AS "group", COUNT(*) AS n, MEDIAN(abs_error) AS median_abs_error FROM scored GROUP BY ALL'), "median_abs_error")
QUERIES["error_by_price_bucket"] = near(
    lambda s, d: ml.error_by(scored(s, d), ml.price_bucket()),
    o("""SELECT CASE WHEN price <= 80 THEN 'Budget ≤€80' WHEN price <= 150 THEN 'Mid €81-150' WHEN price <= 300 THEN 'Premium €151-300'
        WHEN price <= 600 THEN 'High €301-600' ELSE 'Luxury €600+' END AS "group", COUNT(*) AS n,
        MEDIAN(abs_error) AS median_abs_error FROM scored WHERE price > 0 AND price <= 50000 GROUP BY 1"""), "median_abs_error")
QUERIES["best_and_worst_areas"] = near(
    lambda s, d: ml.best_and_worst(ml.error_by(scored(s, d), "neighbourhood_cleansed")),
    o("""SELECT * FROM (SELECT *, 'best' AS side FROM errors ORDER BY median_abs_error, "group" LIMIT 5)
        UNION ALL SELECT * FROM (SELECT *, 'worst' AS side FROM errors ORDER BY median_abs_error DESC, "group" LIMIT 5)""",
      {"errors": 'SELECT neighbourhood_cleansed AS "group", COUNT(*) AS n, MEDIAN(abs_error) AS median_abs_error FROM scored GROUP BY ALL'}),
    "median_abs_error")
QUERIES["residual_summary"] = near(
    lambda s, d: ml.residual_summary(scored(s, d), 300, 20),
    o("""SELECT COUNT(*) AS n, AVG(residual) AS mean_residual, STDDEV_POP(residual) AS std_residual,
        COUNT(*) FILTER (WHERE price <= 300) AS rows_within_price_cap,
        COUNT(*) FILTER (WHERE abs(residual) <= 20) AS rows_within_residual_cap FROM scored"""), "mean_residual", "std_residual")
QUERIES["category_dummies"] = (
    lambda s, d: fp.feature_values(features := fp.fit_features(L(s, d)), L(s, d), fp.feature_labels(features)).where(
        "feature RLIKE '^(room|property|neighbourhood)_'"),
    oracle(" UNION ALL ".join(
        f"SELECT id, '{prefix}_' || {c} AS feature, CAST(1 AS DOUBLE) AS value FROM listings WHERE {c} > (SELECT MIN({c}) FROM listings)"
        for c, prefix in fp.CATEGORIES.items())))
QUERIES["pipeline_numbers"] = near(
    lambda s, d: fp.feature_values(fp.fit_features(L(s, d), ()), L(s, d), [*fp.NUMBERS, *fp.DERIVED], nonzero=False)
    .groupBy("id").pivot("feature", [*fp.NUMBERS, *fp.DERIVED]).agg(F.max("value")),
    oracle("SELECT id, " + ", ".join(fp.NUMBERS) + f""", {RATIOS}, CAST(host_is_superhost AS DOUBLE) AS is_superhost,
        CAST(number_of_reviews > 0 AS DOUBLE) AS has_reviews, CAST(number_of_reviews >= 20 AS DOUBLE) AS is_popular
        FROM (SELECT * REPLACE (""" + ", ".join(f"COALESCE({c}, MEDIAN({c}) OVER ()) AS {c}" for c in fp.NUMBERS) + ") FROM listings)"),
    "guests_per_bedroom")


def reloaded_scores(s, d):
    """Raw candidates scored by a model and by its stored copy, beside the prices they are scored without."""
    raw = cut_lineage(L(s, d))
    model = fp.fit_price_model(raw, ml.ridge(raw.where("price > 0").count()))
    path = f"{shared_folder(s)}/price-model-{uuid.uuid4().hex}"
    ml.save_model(model, path)
    inputs = raw.select("id", *fp.NUMBERS, "host_is_superhost", *fp.CATEGORIES)
    here, there = (fp.score_raw(m, inputs).select("id", "predicted") for m in (model, ml.load_model(path)))
    both = here.join(there.withColumnRenamed("predicted", "reloaded"), "id", "full")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("predicted") > 0).alias("priced"),
                    F.count_if(~F.col("predicted").eqNullSafe(F.col("reloaded"))).alias("differences"))


QUERIES["pipeline_model_reloaded"] = (reloaded_scores, "SELECT COUNT(*) AS rows, COUNT(*) AS priced, 0 AS differences FROM orders")
QUERIES["attach_attributes"] = near(
    lambda s, d: ml.attach_attributes(scored(s, d).select("id", "predicted"), L(s, d).select("id", "room_type")),
    o("SELECT id, predicted, room_type FROM scored"), "predicted")
QUERIES["fold_sizes"] = (
    lambda s, d: L(s, d).select(ml.fold_of("id").alias("fold")).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("folds")), "SELECT COUNT(*) AS rows, 5 AS folds FROM orders")
QUERIES["train_test_sizes"] = (
    lambda s, d: reduce(DataFrame.union, [p.select("id") for p in ml.train_test_split(L(s, d))]).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids")),
    "SELECT COUNT(*) AS rows, COUNT(*) AS ids FROM orders")

# Fits, of the library's full sizes.

RIDGE = ml.ridge


def full_forest(*_):
    return ml.random_forest()


def full_boost(*_):
    return ml.boosted_trees()


QUERIES["cv_ridge"] = (lambda s, d: ml.cross_validate(ready(s, d), RIDGE, "ridge"), None)
QUERIES["cv_random_forest"] = (lambda s, d: ml.cross_validate(ready(s, d), full_forest, "random_forest"), None)
QUERIES["cv_boosted_trees"] = (lambda s, d: ml.cross_validate(ready(s, d), full_boost, "boosted_trees"), None)
QUERIES["holdout_metrics"] = (lambda s, d: ml.holdout_metrics(ready(s, d), full_boost()), None)


def ridge_scored(s, d):
    data = cut_lineage(ready(s, d))
    return ml.score_batch(ml.fit(data, ml.ridge_for(data)), data).select("id", "price", "predicted", "residual")


QUERIES["score_batch"] = (ridge_scored, None)


def fitted_forest(data):
    """The forest of full size over stored rows."""
    return ml.fit(ml.dealt_out(data, full_forest()), full_forest())


QUERIES["feature_importance"] = (lambda s, d: ml.feature_importance(fitted_forest(cut_lineage(ready(s, d)))), None)


def attributed(s, d):
    data = cut_lineage(ready(s, d))
    return attribution.attribution_batch(fitted_forest(data), data, data)


QUERIES["attribution_batch"] = (attributed, None)
QUERIES["attribution_importance"] = (lambda s, d: attribution.global_importance(attributed(s, d)), None)


def attribution_gaps(s, d):
    """Rows whose contributions and base do not add up to the model's prediction."""
    data = cut_lineage(ready(s, d))
    model = ml.fit(ml.dealt_out(data, ml.random_forest(20, 8)), ml.random_forest(20, 8))
    sums = attribution.attribution_batch(model, data, data).groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), (F.sum("contribution") + F.first("base")).alias("total"))
    rows = model.transform(data).select("id", "prediction").join(sums, "id", "left")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("contributions"),
                    F.count_if(~F.coalesce(F.abs(F.col("prediction") - F.col("total")) < 1e-9, F.lit(False))).alias("gaps"))


QUERIES["attribution_adds_up"] = (
    attribution_gaps, o(f"SELECT COUNT(*) AS rows, {len(MODEL_FEATURES)} * COUNT(*) AS contributions, 0 AS gaps FROM ready"))

# Reports over contributions by formula

DRIVERS = {"accommodates": 8, "bedrooms": 2, "beds": 3, "minimum_nights": 15, "number_of_reviews": 60, "review_scores_rating": 4}


def contributions(s, d):
    """Every listing, its missing inputs filled as for scoring."""
    known = ml.scoring_features(L(s, d)).select("id", *DRIVERS)
    long = known.unpivot("id", list(DRIVERS), "feature", "feature_value")
    middle = F.create_map(*[F.lit(x) for kv in DRIVERS.items() for x in kv])[F.col("feature")]
    return long.withColumn("contribution", (F.col("feature_value") - middle) / 100.0)


CONTRIB = {"contributions": " UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, CAST(COALESCE({c}, {CANDIDATE_DEFAULTS[c]}) AS DOUBLE) AS feature_value, "
    f"(COALESCE({c}, {CANDIDATE_DEFAULTS[c]}) - {m}) / CAST(100 AS DOUBLE) AS contribution FROM listings" for c, m in DRIVERS.items()),
    "placed": """SELECT *, CASE WHEN contribution > 0.02 THEN 'up' WHEN contribution < -0.02 THEN 'down' END AS direction,
        ROW_NUMBER() OVER (PARTITION BY id, contribution > 0.02, contribution < -0.02 ORDER BY abs(contribution) DESC, feature) AS place FROM contributions"""}


def c(sql, extra=None):
    return oracle(sql, {**CONTRIB, **(extra or {})})


QUERIES["global_importance"] = near(
    lambda s, d: attribution.global_importance(contributions(s, d), 3),
    c("SELECT feature, AVG(abs(contribution)) AS importance FROM contributions GROUP BY feature ORDER BY importance DESC, feature LIMIT 3"), "importance")
QUERIES["dependence_table"] = (
    lambda s, d: attribution.dependence_table(contributions(s, d)),
    c("""SELECT id, feature, feature_value, contribution FROM contributions WHERE feature IN (
        SELECT feature FROM contributions GROUP BY feature ORDER BY AVG(abs(contribution)) DESC, feature LIMIT 2)"""))
LABELS = "CASE feature " + " ".join(f"WHEN '{f}' THEN '{t}'" for f, t in FEATURE_LABELS.items() if f in DRIVERS) + " END"
QUERIES["top_contributions"] = (
    lambda s, d: attribution.top_contributions(contributions(s, d), 4, minimum=0.001),
    c(f"""SELECT id, feature, feature_value, contribution, {LABELS} AS label,
        CAST(ROW_NUMBER() OVER (PARTITION BY id ORDER BY abs(contribution) DESC, feature) AS INT) AS place FROM contributions
        WHERE abs(contribution) > 0.001 QUALIFY place <= 4"""))
QUERIES["signed_drivers"] = (
    lambda s, d: attribution.signed_drivers(contributions(s, d), minimum=0.02),
    c("""SELECT id, feature, feature_value, contribution, direction, CAST(place AS INT) AS place FROM placed
         WHERE direction IS NOT NULL AND place <= 3"""))
PHRASES = """CASE feature WHEN 'accommodates' THEN format('guest capacity of {}', CAST(feature_value AS INT))
  WHEN 'bedrooms' THEN format('{} bedroom(s)', CAST(feature_value AS INT)) WHEN 'beds' THEN format('{} bed(s)', CAST(feature_value AS INT))
  WHEN 'minimum_nights' THEN format('minimum stay of {} night(s)', CAST(feature_value AS INT))
  WHEN 'number_of_reviews' THEN format('review count ({})', CAST(feature_value AS INT))
  WHEN 'review_scores_rating' THEN format('rating of {:.2f}/5', feature_value) END"""


def sentence(prefix, side):
    return f"""CASE WHEN len({side}) > 0 THEN '{prefix}' || array_to_string({side}[1:len({side}) - 1], ', ')
      || CASE WHEN len({side}) > 1 THEN ' and ' ELSE '' END || {side}[len({side})] || '.' END"""


QUERIES["explain_text"] = (
    lambda s, d: attribution.explain_text(contributions(s, d)),
    c("SELECT id, CASE WHEN t = '' THEN 'This listing''s price is close to the average market baseline, with no single feature dominating the valuation.' "
      "ELSE t END AS explanation FROM (SELECT id, concat_ws(' ', "
      + sentence("This listing is priced higher mainly because of its ", "up") + ", "
      + sentence("Conversely, its price is moderated or reduced due to its ", "down") + ") AS t FROM terms)",
      {"terms": f"""SELECT id, list({PHRASES} ORDER BY place) FILTER (WHERE direction = 'up' AND place <= 3) AS up,
        list({PHRASES} ORDER BY place) FILTER (WHERE direction = 'down' AND place <= 3) AS down FROM placed GROUP BY id"""}))


def valued(s, d):
    guesses = L(s, d).select("id", "neighbourhood_cleansed", "property_type", "accommodates", "bedrooms",
                             (F.col("accommodates") * 33 - 20).alias("predicted"))
    return attribution.valuation(guesses, L(s, d).select("neighbourhood_cleansed", "price"))


VALUED = {"medians": "SELECT neighbourhood_cleansed, MEDIAN(price) AS area_median FROM listings GROUP BY ALL",
          "bounds": "SELECT quantile_cont(price, 0.35) AS p35, quantile_cont(price, 0.85) AS p85, MEDIAN(price) AS p50 FROM listings",
          "guesses": """SELECT id, l.neighbourhood_cleansed, property_type, accommodates, bedrooms, accommodates * 33 - 20 AS predicted,
            GREATEST(accommodates * 33 - 20, 10) AS predicted_price, COALESCE(area_median, p50) AS area_median, p35, p85
            FROM listings l JOIN bounds ON TRUE LEFT JOIN medians USING (neighbourhood_cleansed)"""}
QUERIES["valuation"] = near(
    valued, oracle("""SELECT * EXCLUDE (p35, p85), predicted_price - area_median AS price_difference,
        (predicted_price - area_median) / area_median * 100 AS difference_pct,
        CAST(trunc(predicted_price * 0.95) AS BIGINT) AS range_min, CAST(trunc(predicted_price * 1.05) AS BIGINT) AS range_max,
        CASE WHEN predicted_price <= p35 THEN 'Budget Option' WHEN predicted_price >= p85 THEN 'Luxury Option' ELSE 'Mid-Range Option' END AS tier,
        CASE WHEN (predicted_price - area_median) / area_median * 100 > 15 THEN 'Premium Pricing'
             WHEN (predicted_price - area_median) / area_median * 100 < -15 THEN 'Underpriced Opportunity' ELSE 'Highly Competitive' END AS recommendation
        FROM guesses""", VALUED), "area_median", "price_difference", "difference_pct")


def candidate_bundles(s, d):
    """Every listing as a candidate: price by ridge, contributions by a small forest; sums and bounds that must hold."""
    data = cut_lineage(ready(s, d))
    forest = ml.random_forest(20, 6)
    models = ml.fit(data, ml.ridge_for(data)), ml.fit(ml.dealt_out(data, forest), forest)
    inputs = L(s, d).drop("price").withColumn("is_superhost", F.col("host_is_superhost"))
    out = model_run.value_candidates(inputs, *models, data, L(s, d))
    scored = models[1].transform(ml.scoring_features(inputs)).select("id", "prediction")
    total = F.log1p("base_price") + F.aggregate("contributions", F.lit(0.0), lambda a, c: a + c["contribution"])
    falling = F.forall(F.sequence(F.lit(1), F.size("contributions") - 1), lambda i: F.abs(F.get("contributions", i - 1)["contribution"])
                       >= F.abs(F.get("contributions", i)["contribution"]))
    checked = out.join(scored, "id").select("id", "neighbourhood_cleansed", "area_median", F.size("contributions").alias("n"), F.length("explanation").alias("e"),
                                            (F.abs(total - F.col("prediction")) < 1e-9).alias("adds_up"), falling.alias("sorted"),
                                            (F.col("predicted_price") >= 10).alias("floored"))
    return checked.groupBy("neighbourhood_cleansed").agg(
        F.count(F.lit(1)).alias("candidates"), F.max("area_median").alias("area_median"), F.sum("n").alias("contributions"),
        F.count_if(F.col("adds_up") & F.col("sorted") & F.col("floored") & (F.col("e") > 0)).alias("sound"))


QUERIES["value_candidates"] = near(
    candidate_bundles, oracle(f"""SELECT neighbourhood_cleansed, COUNT(*) AS candidates, COALESCE(MEDIAN(price), (SELECT MEDIAN(price) FROM listings)) AS area_median,
        {len(MODEL_FEATURES)} * COUNT(*) AS contributions, COUNT(*) AS sound FROM listings GROUP BY neighbourhood_cleansed"""), "area_median")
QUERIES["valuation_report"] = (lambda s, d: attribution.valuation_report(valued(s, d), ["accommodates", "bedrooms"]), None)
