"""Semantics of summaries, quantiles, ranks, duplicates and models on small data."""

import itertools
import json
import math
import random
import statistics
from collections import Counter
from datetime import date
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.operators import areas, attribution, features, filters, fuzzy, market, ml, profile, quality, star, stats, summaries
from marketlens.operators.quantiles import grouped, sliced_quantiles
from marketlens.functions import fixed_values as fixed

DAY = date(2024, 5, 4)


def test_single_review_has_no_rate(spark):
    df = spark.createDataFrame([(1, 7, DAY, True)], "id long, listing_id long, date date, _has_text boolean")
    row = summaries.review_summary(df).first()
    assert (row.review_count, row.active_review_months, row.reviews_per_month_computed) == (1, 0.0, 0.0)


def test_peak_month_tie_and_missing_availability(spark):
    rows = [(1, False, 6, False)] * 3 + [(1, False, 5, True)] * 3 + [(1, True, 7, False), (1, None, 7, False), (2, True, 1, False)]
    df = spark.createDataFrame(rows, "listing_id long, available boolean, month int, is_weekend boolean")
    one, two = summaries.calendar_summary(df).orderBy("listing_id").collect()
    assert (one.peak_month, one.total_days, one.booked_days, one.available_days) == (5, 7, 6, 1)
    assert one.booked_days + one.available_days <= one.total_days
    assert (one.weekend_occupancy_rate, one.weekday_total_days) == (1.0, 4)
    assert (two.peak_month, two.weekend_booked_days, two.weekend_occupancy_rate) == (None, None, None)


def test_left_joins_keep_every_listing(spark):
    listings = spark.createDataFrame([(1,), (2,), (3,), (None,)], "id long")
    summary = spark.createDataFrame([(1, 5), (9, 6)], "listing_id long, review_count long")
    out = summaries.join_summary(listings, summary)
    assert out.count() == 4 and out.columns == ["id", "review_count"]


def test_rank_ties_share_the_best_place(spark):
    df = spark.createDataFrame([("a", 200.0), ("b", 200.0), ("c", 150.0), ("d", None)], "area string, neighbourhood_median_price double")
    got = {r.area: r.neighbourhood_price_rank for r in areas.price_rank(df).collect()}
    assert got == {"a": 1, "b": 1, "c": 3, "d": None}


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_sliced_quantiles_equal_numpy(spark, slices):
    draw = random.Random(slices)
    # One group holds most rows and most of them are one value.
    rows = [("hot" if draw.random() < 0.7 else draw.choice(["a", None]), draw.choice([5.0, 5.0, draw.gauss(0, 50), None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    for r in sliced_quantiles(df, ["g"], "v", probs, slices).collect():
        known = [v for g, v in rows if g == r.g and v is not None]
        np.testing.assert_allclose([r[p] for p in probs], np.quantile(known, list(probs.values())), rtol=1e-12)
    whole = grouped(df, [], [F.count(F.lit(1)).alias("n")], {"m": ("v", 0.5)}, slices).first()
    assert whole.n == 3000 and whole.m == pytest.approx(np.median([v for _, v in rows if v is not None]))


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 5)], "g string, v double, n long")
    for slices in (1, 4):
        assert grouped(df, ["g"], quantiles={"m": ("v", 0.5)}, slices=slices, weight="n").first().m == 9.0


def mann_whitney_by_hand(a, b):
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    n1, n2 = len(a), len(b)
    n, ties = n1 + n2, pd.Series(a + b).value_counts()
    sd = math.sqrt(n1 * n2 / 12 * (n + 1 - sum(t**3 - t for t in ties) / (n * (n - 1))))
    z = (u - n1 * n2 / 2 - 0.5) / sd
    return u, 0.5 * math.erfc(z / math.sqrt(2))


@pytest.mark.parametrize("slices", [1, 5])
def test_mann_whitney_against_all_pairs(spark, slices):
    draw = random.Random(3)
    a, b = [float(draw.randint(0, 20)) for _ in range(80)], [float(draw.randint(0, 18)) for _ in range(120)]
    df = spark.createDataFrame([(v, True) for v in a] + [(v, False) for v in b], "v double, in_first boolean")
    row = stats.mann_whitney_u(df, slices).first()
    u, p = mann_whitney_by_hand(a, b)
    assert row.u == u and row.p_value == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize("slices", [1, 6])
def test_kruskal_against_pandas_ranks(spark, slices):
    draw = random.Random(5)
    rows = [(draw.choice("abc"), float(draw.randint(0, 30))) for _ in range(300)] + [("tiny", 1.0)]
    pdf = pd.DataFrame(rows[:-1], columns=["g", "v"])
    pdf["r"] = pdf.v.rank()
    n = len(pdf)
    h = 12 / (n * (n + 1)) * sum(g.r.sum() ** 2 / len(g) for _, g in pdf.groupby("g")) - 3 * (n + 1)
    h /= 1 - sum(t**3 - t for t in pdf.v.value_counts()) / (n**3 - n)
    row = stats.kruskal_wallis(spark.createDataFrame(rows, "g string, v double"), "g", "v", slices=slices).first()
    assert row.groups == 3 and row.n == n and row.h == pytest.approx(h, rel=1e-9)
    assert row.p_value == pytest.approx(math.exp(-h / 2), rel=1e-6)  # two degrees of freedom


def test_tails_known_values(spark):
    from marketlens.functions import tails
    df = spark.createDataFrame([(1.959963984540054, 11.070497693516351, 5.0, 10.0)], "z double, x double, k double, n double")
    row = df.select(tails.normal_upper_tail("z"), tails.chi2_upper_tail("x", "k"), tails.t_quantile_975("n"), tails.t_quantile_975(F.lit(1.0)),
                    tails.chi2_upper_tail(F.lit(1.0), F.lit(3.0))).first()
    np.testing.assert_allclose(row, [0.025, 0.05, 2.228138852, 12.70620474, 0.8012519569], rtol=1e-6)


@pytest.mark.parametrize("slices", [1, 4])
def test_spearman_against_pandas(spark, slices):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 200).astype(float), "b": rng.normal(size=200)})
    pdf["c"] = pdf.a * 2 + rng.normal(size=200)
    pdf.loc[3, "b"] = None
    expected = pdf.dropna().corr("spearman")
    for r in stats.corr_spearman(spark.createDataFrame(pdf), ["a", "b", "c"], slices).collect():
        assert r.rho == pytest.approx(expected.loc[r.column_a, r.column_b], abs=1e-12)


def test_ols_and_vif_against_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 3))
    x[:, 2] += x[:, 0]
    y = 1.5 + x @ [0.5, -0.2, 0.0] + rng.normal(size=400) * 0.1
    pdf = pd.DataFrame(x, columns=["p", "q", "r"]).assign(y=y)
    df = spark.createDataFrame(pdf)
    design = np.column_stack([np.ones(400), x])
    beta = np.linalg.lstsq(design, y, rcond=None)[0]
    got = {r.feature: r for r in stats.ols(df, "y", ["p", "q", "r"]).collect()}
    np.testing.assert_allclose([got[n].coefficient for n in ("intercept", "p", "q", "r")], beta, atol=1e-8)
    assert got["p"].significant and not got["r"].p_value < 1e-6
    vifs = {r.feature: r.vif for r in stats.vif(df, ["p", "q", "r"]).collect()}
    np.testing.assert_allclose([vifs[c] for c in "pqr"], np.diag(np.linalg.inv(np.corrcoef(x.T))), rtol=1e-8)


@pytest.mark.parametrize("distributed_plan", [False, True])
def test_lowess_reproduces_a_line(spark, distributed_plan, request):
    if distributed_plan:
        request.getfixturevalue("distributed")
    df = spark.createDataFrame([(float(i % 40), 3.0 + 2.0 * (i % 40)) for i in range(400)], "x double, y double")
    for r in stats.lowess_grid(df, "y", "x", points=5).collect():
        assert r.smoothed == pytest.approx(3 + 2 * r.x, rel=1e-9)


@pytest.mark.parametrize("threshold", [0.6, 0.75, 0.9])
def test_fuzzy_join_loses_no_pair(spark, threshold):
    draw = random.Random(11)
    words = ["canal", "house", "studio", "cosy", "loft", "view", "central", "a", "b", "ab", "abc", ""]
    texts = [" ".join(draw.choice(words) for _ in range(draw.randint(1, 5))) for _ in range(60)]
    texts += [t[:i] + draw.choice("xyz") + t[i + draw.randint(0, 1):] for t in texts[:40] for i in [draw.randint(0, len(t))]]
    texts += ["aa", "ab", "abcd", "abce", "Abcd ", None]
    values = sorted({t.strip().lower() for t in texts if t is not None})
    expected = {(a, b): round(SequenceMatcher(None, a, b).ratio(), 3) for a, b in itertools.combinations(values, 2)
                if SequenceMatcher(None, a, b).ratio() >= threshold}
    df = spark.createDataFrame([(t,) for t in texts], "name string")
    got = {(r.value_a, r.value_b): r.similarity for r in fuzzy.fuzzy_duplicates(df, "name", threshold).collect()}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) <= 0.001 for k in got)


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_positions_bound_the_pairs_that_meet(spark, threshold):
    """Every pair that shares enough meets once; fewer meet than share a token of their prefixes."""
    draw = random.Random(4)
    syllables = ["ka", "lo", "mi", "ster", "dam", "ou", "brug", "zee", "vel", "hof"]
    names = sorted({" ".join("".join(draw.choice(syllables) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(1, 3))) for _ in range(600)})
    q = 2 if threshold > 2 / 3 else 1
    values = spark.createDataFrame([(n, len(n)) for n in names], "value string, size int")
    prefixes = fuzzy._prefixes(fuzzy._tokens(values, q), threshold, q)
    met = [(r.value_a, r.value_b) for r in fuzzy.meeting_pairs(prefixes, threshold, q).collect()]
    assert len(met) == len(set(met))
    grams = {n: Counter(n[i:i + q] for i in range(len(n) - q + 1)) for n in names}

    def must_meet(a, b):
        total = len(a) + len(b)
        asked = total * threshold / 2 if q == 1 else 1.5 * threshold * total - total - 1
        return asked > 1e-6 and 2 * min(len(a), len(b)) >= threshold * total and (grams[a] & grams[b]).total() >= asked

    pairs = {tuple(sorted(p, key=lambda v: (len(v), v))) for p in itertools.combinations(names, 2)}
    needed = {p for p in pairs if must_meet(*p)}
    heads = {r.value: set(r.prefix) for r in prefixes.collect()}
    by_prefix = {(a, b) for a, b in pairs if 2 * len(a) >= threshold * (len(a) + len(b)) and heads.get(a, set()) & heads.get(b, set())}
    assert needed <= set(met) < by_prefix


def test_exact_duplicates_and_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "id int, v string")
    row = profile.exact_duplicates(df, "id", "t").first()
    assert (row.duplicate_rows, row.duplicate_rows_pct, row.duplicate_keys) == (2, 40.0, 3)


def test_exact_duplicates_tell_nulls_microseconds_and_signs(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, '', 0D, timestamp'2024-01-01 00:00:00.000001'), (1, null, 0D, timestamp'2024-01-01 00:00:00.000001'),
        (1, '', -0D, timestamp'2024-01-01 00:00:00.000001'), (1, '', 0D, timestamp'2024-01-01 00:00:00.000002') AS t(id, v, x, at)""")
    assert profile.exact_duplicates(df, "id", "t").first().duplicate_rows == 1
    assert profile.exact_duplicates(df.limit(0), "id", "t").first().duplicate_keys == 0


def test_validation_short_circuits(spark):
    missing = quality.validate_dataset(spark.createDataFrame([(1,)], "id int"), "listings").first()
    assert not missing.passed and missing.rule == "required columns"
    empty = quality.validate_dataset(spark.createDataFrame([], "neighbourhood string"), "neighbourhoods").first()
    assert not empty.passed and empty.rule == "has rows"


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").cast("double").alias("price"), F.lit("x").alias("room_type"), F.lit(1).alias("other")).write.parquet(f"{tmp_path}/t")
    df = filters.apply_filters(spark.read.parquet(f"{tmp_path}/t"), {"room_type": ["x", "y"]}, ranges={"price": (5, 9)}).select("price")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price), In(room_type, [x,y]), GreaterThanOrEqual(price,5.0), LessThanOrEqual(price,9.0)]" in plan or (
        "GreaterThanOrEqual(price,5.0)" in plan and "In(room_type" in plan)
    assert "other" not in plan.split("ReadSchema")[1]
    assert df.count() == 5


def test_sample_is_reproducible(spark):
    df = spark.range(1000)
    a = {r.id for r in filters.sample_rows(df, "id", 50).collect()}
    assert len(a) == 50 and a == {r.id for r in filters.sample_rows(df.repartition(7), "id", 50).collect()}
    assert filters.leaking_features(["beds", "Price_x", "revenue_y"]) == ["Price_x", "revenue_y"]


def test_keyed_dimension_has_one_row_per_key(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, "x"), (1, "b", "w"), (2, "c", "y"), (None, "z", "z")],
                               "host_id int, host_name string, host_segment string")
    dim = star.dim_host(df)
    assert dim.count() == 2 == dim.select("host_id").distinct().count()
    assert dim.where("host_id = 1").first()[1:] == ("b", "w")  # attributes of one source row
    assert star.dim_host(df, "distinct").count() == 4


def test_shares_sum_to_100(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 2 + [(None,)], "host_segment string")
    assert sum(r.share_pct for r in market.segment_share(df).collect()) == pytest.approx(100)


def test_histogram_last_bin_is_closed_and_constant_column(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    assert [r.n for r in market.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    assert [r.n for r in market.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 5).collect()] == [4]


@pytest.fixture(scope="module")
def model_data(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.integers(0, 5, size=(600, len(fixed.MODEL_FEATURES))).astype(float), columns=fixed.MODEL_FEATURES)
    pdf["id"] = range(600)
    pdf["log_price"] = 3 + 0.2 * pdf["accommodates"] - 0.1 * pdf["beds"] + 0.05 * pdf["bedrooms"] * pdf["bathrooms"]
    pdf["price"] = np.expm1(pdf["log_price"])
    return spark.createDataFrame(pdf).cache()


def test_attribution_adds_up(spark, model_data):
    model = ml.fit(model_data, ml.random_forest(trees=5, depth=4))
    some = model_data.limit(20)
    out = attribution.attribution_batch(model, some, model_data, references=4)
    assert out.count() == 20 * len(fixed.MODEL_FEATURES)
    reference = filters.sample_rows(model_data, "id", 4)
    base = model.transform(reference).agg(F.avg("prediction")).first()[0]
    total = out.groupBy("id").agg(F.sum("contribution").alias("c"))
    for r in total.join(model.transform(some), "id").select("c", "prediction").collect():
        assert base + r.c == pytest.approx(r.prediction, abs=1e-9)
    assert out.agg(F.min("base"), F.max("base")).first() == pytest.approx((base, base), abs=1e-9)
    values = {(r.id, r.feature): r.feature_value for r in out.collect()}
    for r in some.collect():
        assert values[(r.id, "beds")] == r["beds"]


def test_attribution_of_a_linear_model(spark, model_data):
    """Walks: by default 100 references; contributions and standard errors against their closed forms."""
    model = ml.fit(model_data, ml.ridge(model_data.count()))
    some = model_data.limit(3)
    names = ml.model_feature_list(model)
    slopes = dict(zip(names, model.stages[-1].coefficients))
    reference = filters.sample_rows(model_data, "id", 100).collect()
    assert len(reference) == 100
    rows = {r.id: r for r in some.collect()}
    out = attribution.attribution_walks(model, some, model_data).collect()
    assert len(out) == 3 * len(names)
    for r in out:
        each = [slopes[r.feature] * (rows[r.id][r.feature] - x[r.feature]) for x in reference]
        pairs = [(a + b) / 2 for a, b in zip(each[::2], each[1::2])]
        assert r.contribution == pytest.approx(sum(each) / 100, abs=1e-9)
        assert r.std_error == pytest.approx(statistics.stdev(pairs) / 50 ** 0.5, abs=1e-9)


def test_one_hot_refuses_unbounded_columns(spark):
    with pytest.raises(ValueError):
        ml.one_hot(spark.range(ml.MAX_CATEGORIES + 1), "id", "id")


def test_small_sides_are_broadcast_whatever_their_source(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).select((F.col("id") % 3).alias("area"), F.col("id").cast("double").alias("price"))
        stats = rows.groupBy("area").agg(F.avg("price").alias("neighbourhood_median_price"))
        joined = areas.join_area_stats(rows, stats, "area")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_attribution_of_a_linear_model_is_exact(spark, model_data):
    data = model_data.withColumn("log_price", 3 + 0.2 * F.col("accommodates") - 0.1 * F.col("beds"))
    model = ml.fit(data, ml.ridge(1, alpha=0.0))
    reference = filters.sample_rows(data, "id", 2).agg(F.avg("accommodates")).first()[0]
    out = attribution.attribution_batch(model, data, data, references=2).where("feature = 'accommodates'")
    for r in out.collect():
        assert r.contribution == pytest.approx(0.2 * (r.feature_value - reference), abs=1e-6)


def test_cross_validation_and_holdout(spark, model_data):
    ridge = ml.cross_validate(model_data, ml.ridge, "ridge")
    flat = ml.cross_validate(model_data, lambda n, sd: ml.ridge(1, alpha=1e9), "flat")
    row = ridge.first()
    assert row.mae_mean < flat.first().mae_mean and row.mae_std >= 0
    assert ml.best_model(ridge.unionByName(flat)).first().model == "ridge"
    parts = {r.part: r for r in ml.holdout_metrics(model_data, ml.boosted_trees(rounds=5, rate=0.3, depth=3)).collect()}
    assert parts["train"].n + parts["test"].n == 600 and parts["train"].r2 > 0
    train, test = ml.train_test_split(model_data)
    assert train.join(test, "id").count() == 0


def test_model_round_trip_and_importance(spark, model_data, tmp_path):
    model = ml.fit(model_data, ml.random_forest(trees=3, depth=3))
    ml.save_model(model, f"{tmp_path}/m")
    again = ml.load_model(f"{tmp_path}/m")
    assert ml.model_feature_list(again) == fixed.MODEL_FEATURES
    a, b = (m.transform(model_data).orderBy("id").select("prediction").toPandas() for m in (model, again))
    assert a.equals(b)
    rows = ml.feature_importance(model).collect()
    assert sum(r.importance for r in rows) == pytest.approx(1) and rows[-1].feature == "accommodates"


def test_valuation_report_document(spark):
    listings = spark.createDataFrame([("x", 100.0), ("x", 120.0), ("y", 300.0), ("z", None)], "neighbourhood_cleansed string, price double")
    guesses = spark.createDataFrame([(1, "x", "Loft", 2.0, 150.0), (2, "nowhere", "Loft", 2.0, 4.0)],
                                    "id long, neighbourhood_cleansed string, property_type string, beds double, predicted double")
    rows = {r.id: json.loads(r.report) for r in attribution.valuation_report(attribution.valuation(guesses, listings), ["beds"]).collect()}
    assert rows[1]["valuation_recommendation"] == "Premium Pricing" and rows[1]["suggested_range"] == "€142 - €157"
    assert rows[2]["predicted_price"] == 10.0 and rows[2]["district_median"] == 120.0 and rows[2]["tier"] == "Budget Option"


def test_explanation_without_drivers(spark):
    df = spark.createDataFrame([(1, "beds", 2.0, 0.001), (2, "beds", 2.0, 0.5), (2, "bathrooms", 1.5, 0.4), (2, "is_popular", 1.0, -0.3)],
                               "id long, feature string, feature_value double, contribution double")
    got = {r.id: r.explanation for r in attribution.explain_text(df).collect()}
    assert got[1] == fixed.NO_DRIVER_TEXT
    assert got[2] == fixed.RAISES_PREFIX + "2 bed(s) and 1.5 bathroom(s). " + fixed.LOWERS_PREFIX + "is popular."


def test_master_is_stable_across_partitionings(spark):
    from catalog import roles
    folder = "/root/testdata/sf0.001"
    parts = roles.clean(spark, folder)
    once = features.build_master(parts, roles.AS_OF)
    again = features.build_master({k: v.repartition(5) for k, v in parts.items()}, roles.AS_OF)
    assert once.exceptAll(again).isEmpty() and once.count() == parts["listings"].count()
