"""Hand-written rows for the cleaning expressions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.functions import scalar as sc
from marketlens.operators import cleaning
from marketlens.operators.features import price_tier


def values(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
            .coalesce(1).select(expression).collect()]


@pytest.mark.parametrize("expression,rows,expected", [
    (sc.clean_price, ["$1,234.50", "€80", "£7", "0", "-5", "", "nan", "abc", None], [1234.5, 80.0, 7.0] + [None] * 6),
    (sc.parse_money, ["$1,234.50", "€80", "0", "-5", "nan", None], [1234.5, None, 0.0, -5.0, None, None]),
    (sc.parse_percent, ["97%", " 5 %", "N/A", "", None], [97.0, 5.0, None, None, None]),
    (sc.flag_from_tf, ["t", "f", "x", None], [True, False, None, None]),
    (sc.flag_or_false, ["t", "f", "True", "False", "1", "0", "x", None], [True, False, True, False, True, False, False, False]),
    (sc.flag_to_tf, ["t", "f", "True", "0", "x", None], ["t", "f", "t", "f", None, None]),
    (sc.flag_to_int, ["t", "f", None], [1, 0, 0]),
    (sc.parse_date, ["2024-01-05", "2024-13-01", "soon", "", None], [date(2024, 1, 5), None, None, None, None]),
    (sc.number, ["5", "nan", "x", "", None], [5.0, None, None, None, None]),
    (sc.title_case_or_null, [" centrum-west ", "OUD-ZUID", "de pijp - rivierenbuurt", "nan", "île d'été", None],
     ["Centrum-West", "Oud-Zuid", "De Pijp - Rivierenbuurt", None, "Île D'Été", None]),
    (sc.blank_to_null, ["", " ", "a", None], [None, None, "a", None]),
])
def test_text_parsing(spark, expression, rows, expected):
    assert values(spark, rows, "v string", expression("v")) == expected


def test_categories(spark):
    rooms = {r: r for r in fixed.ROOM_TYPES}
    assert values(spark, ["Private room", "Castle", None], "v string", sc.map_category("v", rooms)) == ["Private room", "Other", "Other"]
    kept = sc.map_category("v", fixed.PROPERTY_TYPES, keep_null=True)
    assert values(spark, [" Room in hotel", "Castle", None], "v string", kept) == ["Hotel room", "Other", None]


def test_price_tier_edges(spark):
    got = values(spark, [0.0, -1.0, 80.0, 80.01, 150.0, 300.0, 300.01, None], "v double", price_tier("v"))
    b, m, p, x = fixed.PRICE_TIER_LABELS
    assert got == [None, None, b, m, m, p, x, None]


def test_host_segment_edges(spark):
    got = values(spark, [None, 0.0, 1.0, 2.0, 5.0, 6.0, 20.0, 21.0], "v double", cleaning.host_segment("v"))
    s, m, l, c = fixed.HOST_SEGMENT_LABELS
    assert got == [s, None, s, m, m, l, l, c]


def test_clip_keeps_null(spark):
    assert values(spark, [-1.0, 5.0, 400.0, None], "v double", sc.clip("v", 0.0, 365.0)) == [0.0, 5.0, 365.0, None]


def test_round_half_even_is_numpy(spark):
    import numpy as np
    xs = [0.125, 0.375, 2.675, 1.005, -0.125, 1e6 / 3]
    assert values(spark, xs, "v double", sc.round_half_even("v", 2)) == list(np.round(xs, 2))


def test_weekend(spark):
    days = [date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7)]
    parts = sc.calendar_parts("v")
    assert values(spark, days, "v date", parts["is_weekend"]) == [False, True, True]
    assert values(spark, days, "v date", parts["day_of_week"]) == ["Friday", "Saturday", "Sunday"]
    assert values(spark, days[:1], "v date", parts["month_name"]) == ["January"]


def test_sentinel_and_imputation(spark):
    assert values(spark, [2147483647.0, 1125.0], "v double", cleaning.sentinel_to_null("v", fixed.NO_MAXIMUM_NIGHTS)) == [None, 1125.0]
    beds = cleaning.impute_from("beds", F.ceil(F.col("acc") / 2).cast("double"))
    assert values(spark, [(None, 3.0), (None, None), (2.0, 9.0)], "beds double, acc double", beds) == [2.0, None, 2.0]


def test_geo_half_null_and_outside(spark):
    df = spark.createDataFrame([(52.3, 4.9), (52.3, None), (53.0, 4.9), (52.5, 5.1)], "latitude double, longitude double")
    rows = cleaning.clean_listings_geo(df.coalesce(1), "Town").collect()
    assert [(r.latitude, r.longitude) for r in rows] == [(52.3, 4.9), (None, None), (None, None), (52.5, 5.1)]
    assert {r.city for r in rows} == {"Town"}


def test_valid_flag(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0, "a"), (1.0, None, 1.0, "a"), (1.0, 1.0, 1.0, "a")],
                               "price double, latitude double, longitude double, room_type string")
    assert [r[0] for r in df.coalesce(1).select(cleaning.valid_flag()).collect()] == [False, False, True]


def test_steps_tolerate_absent_columns(spark):
    df = spark.createDataFrame([("1", "$5.00")], "id string, price string")
    assert cleaning.standardize_listings(df).first().asDict() == {"id": 1, "price": 5.0}
    assert cleaning.handle_missing_listings(cleaning.standardize_listings(df), date(2025, 1, 1)).columns == ["id", "price"]


def test_review_frequency_fallback(spark):
    df = spark.createDataFrame([(10.0, date(2024, 1, 1)), (10.0, date(2025, 1, 1)), (3.0, None)],
                               "number_of_reviews double, host_since date").coalesce(1)
    got = [r.review_frequency for r in cleaning.handle_missing_listings(df, date(2025, 1, 1)).collect()]
    assert got == [round(10 / (366 / 30.44), 4), 10.0, None]


def test_all_null_column_is_dropped(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x")], "a int, b string, c string")
    assert cleaning.drop_all_null_columns(df, ["b", "c", "zz"]).columns == ["a", "c"]
