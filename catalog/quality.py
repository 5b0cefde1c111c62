"""Validation, profiling and fuzzy duplicates, over the driver's tables made dirty by key."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.oracle import oracle
from catalog.rounding import near
from marketlens.functions import scalar as sc
from marketlens.operators import cleaning, profile, quality
from marketlens.operators.fuzzy import fuzzy_duplicates

QUERIES = {}


def raw_listings(spark, folder):
    """Listings as raw text: money format, t/f flags, per cent signs, lower-case names, blanks by key."""
    x = roles.listings(spark, folder)
    key = F.col("id")
    money = F.concat(F.lit("$"), F.format_number("price", 2))
    return x.select(
        key.cast("string").alias("id"), F.col("host_id").cast("string").alias("host_id"),
        F.when(key % 50 == 1, F.lit("$0.00")).when(key % 50 == 2, F.lit("n/a")).otherwise(F.coalesce(money, F.lit("")))
        .alias("price"),
        "room_type", "property_type", F.col("latitude").cast("string").alias("latitude"),
        F.when(key % 40 == 0, F.lit(None)).otherwise(F.col("longitude").cast("string")).alias("longitude"),
        F.concat(F.lit(" "), F.lower(F.replace(F.col("neighbourhood_cleansed"), F.lit("_"), F.lit("-"))))
        .alias("neighbourhood_cleansed"),
        F.when(F.col("host_is_superhost"), F.lit("t")).otherwise(F.lit("f")).alias("host_is_superhost"),
        F.concat(F.col("host_response_rate").cast("int").cast("string"), F.lit("%")).alias("host_response_rate"),
        F.when(key % 5 != 0, F.lit("within an hour")).alias("host_response_time"),
        F.col("accommodates").cast("string").alias("accommodates"), F.col("bedrooms").cast("string").alias("bedrooms"),
        F.col("beds").cast("string").alias("beds"),
        F.when(key % 9 != 0, (key % 30).cast("string")).alias("reviews_per_month"),
        F.col("number_of_reviews").cast("string").alias("number_of_reviews"),
        (key % 500).cast("string").alias("minimum_nights"),
        F.col("availability_365").cast("string").alias("availability_365"),
        (key % 600 - 20).cast("string").alias("estimated_occupancy_l365d"),
        F.col("host_since").cast("string").alias("host_since"),
        F.col("host_total_listings_count").cast("string").alias("host_total_listings_count"),
        F.col("review_scores_rating").cast("string").alias("review_scores_rating"),
    )


RAW = {"raw_listings": """
SELECT id, host_id, CASE WHEN id % 50 = 1 THEN '$0.00' WHEN id % 50 = 2 THEN 'n/a'
       ELSE COALESCE('$' || format('{:,.2f}', price), '') END AS price, room_type, property_type, latitude,
       CASE WHEN id % 40 <> 0 THEN longitude END AS longitude,
       neighbourhood_cleansed, host_is_superhost, host_response_rate,
       CASE WHEN id % 5 <> 0 THEN 'within an hour' END AS host_response_time, accommodates, bedrooms, beds,
       CASE WHEN id % 9 <> 0 THEN id % 30 END AS reviews_per_month, number_of_reviews, id % 500 AS minimum_nights,
       availability_365, id % 600 - 20 AS estimated_occupancy_l365d, host_since, host_total_listings_count,
       review_scores_rating FROM listings""",
    "typed_price": """
SELECT *, TRY_CAST(replace(replace(price, '$', ''), ',', '') AS DOUBLE) AS amount FROM raw_listings"""}

BOUNDS = "latitude BETWEEN 52.2 AND 52.5 AND longitude BETWEEN 4.7 AND 5.1"
CLEAN = """
SELECT id, host_id, CASE WHEN amount > 0 THEN amount END AS price, room_type, property_type,
  CASE WHEN property_type IS NOT NULL THEN 'Other' END AS property_type_normalized,
  CASE WHEN {B} THEN latitude END AS latitude, CASE WHEN {B} THEN longitude END AS longitude,
  upper(neighbourhood_cleansed[1]) || replace(lower(neighbourhood_cleansed[2:]), '_', '-') AS neighbourhood_cleansed,
  host_is_superhost, host_response_rate, COALESCE(host_response_time, 'Unknown') AS host_response_time,
  accommodates, bedrooms, COALESCE(beds, ceil(accommodates / 2)) AS beds,
  CAST(CASE WHEN reviews_per_month IS NULL AND number_of_reviews = 0 THEN 0 ELSE reviews_per_month END AS DOUBLE) AS reviews_per_month,
  number_of_reviews, CAST(LEAST(minimum_nights, 365) AS DOUBLE) AS minimum_nights, LEAST(availability_365, 365) AS availability_365,
  CAST(GREATEST(LEAST(estimated_occupancy_l365d, 365), 0) AS DOUBLE) AS estimated_occupancy_l365d, host_since,
  host_total_listings_count, review_scores_rating,
  GREATEST(round_even(date_diff('day', host_since, DATE '2025-01-01') / CAST(365.25 AS DOUBLE), 2), 0) AS host_tenure_years,
  CASE WHEN bedrooms > 0 AND amount > 0 THEN round_even(amount / bedrooms, 2) END AS price_per_bedroom,
  CASE WHEN host_total_listings_count <= 0 THEN NULL WHEN host_total_listings_count <= 1 THEN 'Single-listing'
       WHEN host_total_listings_count <= 5 THEN 'Small (2-5)' WHEN host_total_listings_count <= 20 THEN 'Medium (6-20)'
       ELSE 'Commercial (20+)' END AS host_segment, 'Sample City' AS city,
  COALESCE(amount > 0 AND {B}, FALSE) AS _is_valid FROM typed_price""".replace("{B}", BOUNDS)
PARTS = {**RAW, "cleaned": CLEAN}


def cleaned(spark, folder):
    return cleaning.clean_listings(raw_listings(spark, folder), roles.AS_OF, "Sample City")


def raw_calendar(spark, folder):
    x = roles.calendar(spark, folder)
    key = F.col("listing_id")
    return x.select(
        key.cast("string").alias("listing_id"),
        F.when(key % 1000 == 3, F.lit("soon")).otherwise(F.col("date").cast("string")).alias("date"),
        F.when(F.col("available"), F.lit("t")).when(~F.col("available"), F.lit("f")).otherwise(F.lit("?")).alias("available"),
        F.concat(F.lit("$"), F.format_number("price", 2)).alias("price"), F.lit(None).cast("string").alias("adjusted_price"),
        F.col("minimum_nights").cast("int").cast("string").alias("minimum_nights"),
        F.when(key % 3 == 0, F.lit("2147483647")).otherwise((key % 1200).cast("string")).alias("maximum_nights"),
    )


def raw_reviews(spark, folder):
    x = roles.reviews(spark, folder)
    return x.select(
        F.col("id").cast("string").alias("id"), F.col("listing_id").cast("string").alias("listing_id"),
        F.when(F.col("id") % 500 == 7, F.lit("2024-13-45")).otherwise(F.col("date").cast("string")).alias("date"),
        (F.col("id") % 900).cast("string").alias("reviewer_id"), F.lit("Guest").alias("reviewer_name"),
        F.concat(F.lit("  "), "comments", F.lit(" ")).alias("comments"),
    )


def raw_all(spark, folder):
    names = roles.table(spark, folder, "nation").select(F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))).alias("neighbourhood"))
    return {"listings": raw_listings(spark, folder), "calendar": raw_calendar(spark, folder),
            "reviews": raw_reviews(spark, folder), "neighbourhoods": names}


def o(body):
    return oracle(body, PARTS)


# Cleaning

QUERIES["clean_listings"] = (cleaned, o("SELECT * FROM cleaned"))
QUERIES["clean_calendar"] = (
    lambda s, d: cleaning.clean_calendar(raw_calendar(s, d)),
    oracle("""SELECT listing_id, date, available, round(price, 2) AS price, LEAST(minimum_nights, 365) AS minimum_nights,
        CASE WHEN listing_id % 3 <> 0 THEN CAST(listing_id % 1200 AS DOUBLE) END AS maximum_nights, month, month_name,
        day_of_week, is_weekend, quarter, year FROM calendar WHERE listing_id % 1000 <> 3"""))
QUERIES["clean_reviews"] = (
    lambda s, d: cleaning.clean_reviews(raw_reviews(s, d)),
    oracle("""SELECT id, listing_id, CASE WHEN id % 500 <> 7 THEN date END AS date, id % 900 AS reviewer_id,
        'Guest' AS reviewer_name, comments, CASE WHEN id % 500 <> 7 THEN CAST(year(date) AS INT) END AS review_year,
        CASE WHEN id % 500 <> 7 THEN CAST(month(date) AS INT) END AS review_month, _has_text, _is_auto_review FROM reviews"""))
QUERIES["clean_neighbourhoods"] = (
    lambda s, d: cleaning.clean_neighbourhoods(raw_all(s, d)["neighbourhoods"]),
    "SELECT upper(n_name[1]) || replace(lower(n_name[2:]), '_', '-') AS neighbourhood FROM nation")
QUERIES["validity_breakdown"] = (
    lambda s, d: cleaning.validity_breakdown(cleaned(s, d)),
    o("""SELECT COUNT(*) FILTER (WHERE _is_valid) AS valid, COUNT(*) FILTER (WHERE NOT _is_valid) AS invalid,
         COUNT(*) FILTER (WHERE NOT _is_valid AND price IS NULL) AS null_price,
         COUNT(*) FILTER (WHERE NOT _is_valid AND latitude IS NULL) AS null_coordinates FROM cleaned"""))
QUERIES["price_cleaning_audit"] = (
    lambda s, d: quality.price_cleaning_audit(
        raw_listings(s, d).withColumn("price", sc.blank_to_null("price")), "price", sc.clean_price("price")),
    o("""SELECT COUNT(*) FILTER (WHERE amount > 0) AS valid_prices,
         COUNT(*) FILTER (WHERE amount IS NULL OR amount <= 0) AS missing_prices,
         COUNT(*) FILTER (WHERE price <> '' AND (amount IS NULL OR amount <= 0)) AS new_nulls FROM typed_price"""))
QUERIES["parse_money"] = (
    lambda s, d: raw_listings(s, d).select("id", sc.parse_money("price").alias("amount")),
    o("SELECT CAST(id AS VARCHAR) AS id, amount FROM typed_price"))
QUERIES["flags"] = (
    lambda s, d: raw_listings(s, d).select(
        "id", sc.flag_or_false("host_is_superhost").alias("as_bool"), sc.flag_to_tf("host_is_superhost").alias("as_tf"),
        sc.flag_to_int("host_is_superhost").alias("as_int"),
        sc.flag_to_tf(F.col("id").cast("int") % 3).alias("number_tf")),
    o("""SELECT CAST(id AS VARCHAR) AS id, host_is_superhost AS as_bool,
         CASE WHEN host_is_superhost THEN 't' ELSE 'f' END AS as_tf, CAST(host_is_superhost AS INT) AS as_int,
         CASE id % 3 WHEN 0 THEN 'f' WHEN 1 THEN 't' END AS number_tf FROM raw_listings"""))
QUERIES["log_transform"] = near(
    lambda s, d: roles.listings(s, d).select(
        "id", F.log1p("price").alias("log_price"), F.expm1(F.log1p("price")).alias("back")),
    oracle("SELECT id, ln(1 + price) AS log_price, price AS back FROM listings"), "log_price", "back")
# Validation

QUERIES["validate_listings"] = (
    lambda s, d: quality.validate_dataset(raw_listings(s, d), "listings").select("rule", "measured", "is_issue"),
    o("""SELECT rule, CAST(n AS DOUBLE) AS measured, n > 0 AS is_issue FROM (
      SELECT 'price <= 0' AS rule, COUNT(*) FILTER (WHERE amount <= 0) AS n FROM typed_price
      UNION ALL SELECT 'price unparseable', COUNT(*) FILTER (WHERE amount IS NULL) FROM typed_price
      UNION ALL SELECT 'latitude outside the country', COUNT(*) FILTER (WHERE latitude IS NULL OR latitude NOT BETWEEN 50.7 AND 53.6) FROM raw_listings
      UNION ALL SELECT 'longitude outside the country', COUNT(*) FILTER (WHERE longitude IS NULL OR longitude NOT BETWEEN 3.3 AND 7.3) FROM raw_listings
      UNION ALL SELECT 'duplicate listing ids', COUNT(*) - COUNT(DISTINCT id) FROM raw_listings
      UNION ALL SELECT 'availability_365 out of range', COUNT(*) FILTER (WHERE availability_365 NOT BETWEEN 0 AND 365) FROM raw_listings)"""))
QUERIES["validate_calendar"] = (
    lambda s, d: quality.validate_dataset(raw_calendar(s, d), "calendar").select("rule", "measured", "is_issue"),
    oracle("""SELECT 'available not in {t, f}' AS rule, CAST(COUNT(*) FILTER (WHERE available IS NULL) AS DOUBLE) AS measured,
        COUNT(*) FILTER (WHERE available IS NULL) > 0 AS is_issue FROM calendar
      UNION ALL SELECT 'unparseable dates', COUNT(*) FILTER (WHERE listing_id % 1000 = 3), COUNT(*) FILTER (WHERE listing_id % 1000 = 3) > 0 FROM calendar
      UNION ALL SELECT 'days spanned', date_diff('day', MIN(date), MAX(date)), date_diff('day', MIN(date), MAX(date)) < 300 FROM calendar WHERE listing_id % 1000 <> 3
      UNION ALL SELECT 'adjusted_price null %', 100, TRUE FROM region WHERE r_regionkey = 0"""))
QUERIES["validate_reviews"] = (
    lambda s, d: quality.validate_dataset(raw_reviews(s, d), "reviews").select("rule", "measured", "is_issue"),
    oracle("""SELECT 'duplicate review ids' AS rule, CAST(COUNT(*) - COUNT(DISTINCT id) AS DOUBLE) AS measured,
        COUNT(*) <> COUNT(DISTINCT id) AS is_issue FROM reviews
      UNION ALL SELECT 'comments null %', AVG(CASE WHEN comments IS NULL THEN 100.0 ELSE 0 END), AVG(CASE WHEN comments IS NULL THEN 100.0 ELSE 0 END) > 10 FROM reviews
      UNION ALL SELECT 'unparseable dates', COUNT(*) FILTER (WHERE id % 500 = 7), COUNT(*) FILTER (WHERE id % 500 = 7) > 0 FROM reviews"""))
QUERIES["validate_all"] = (
    lambda s, d: quality.validate_all(raw_all(s, d)).groupBy("dataset").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("is_issue").alias("issues"), F.every("passed").alias("passed")),
    o("""SELECT 'listings' AS dataset, 6 AS checks, (SELECT (COUNT(*) FILTER (WHERE amount <= 0) > 0)::INT + (COUNT(*) FILTER (WHERE amount IS NULL) > 0)::INT + (COUNT(*) FILTER (WHERE longitude IS NULL) > 0)::INT + (COUNT(*) FILTER (WHERE availability_365 > 365) > 0)::INT FROM typed_price) AS issues, TRUE AS passed
      UNION ALL SELECT 'calendar', 4, (SELECT (COUNT(*) FILTER (WHERE available IS NULL) > 0)::INT + (COUNT(*) FILTER (WHERE listing_id % 1000 = 3) > 0)::INT + 1 FROM calendar), TRUE
      UNION ALL SELECT 'reviews', 3, (SELECT (COUNT(*) FILTER (WHERE comments IS NULL) * 10 > COUNT(*))::INT + (COUNT(*) FILTER (WHERE id % 500 = 7) > 0)::INT FROM reviews), TRUE"""))
QUERIES["domain_violations"] = (
    lambda s, d: quality.domain_violations(raw_listings(s, d), "listings")
    .unionByName(quality.domain_violations(raw_calendar(s, d), "calendar"))
    .unionByName(quality.domain_violations(raw_reviews(s, d), "reviews")).select("dataset", "rule", "violations"),
    o("""SELECT 'listings' AS dataset, 'price > 0' AS rule, COUNT(*) FILTER (WHERE amount <= 0) AS violations FROM typed_price
      UNION ALL SELECT 'listings', 'price parseable', COUNT(*) FILTER (WHERE amount IS NULL) FROM typed_price
      UNION ALL SELECT 'listings', 'latitude in [50.7, 53.6]', COUNT(*) FILTER (WHERE latitude NOT BETWEEN 50.7 AND 53.6) FROM raw_listings
      UNION ALL SELECT 'listings', 'longitude in [3.3, 7.3]', COUNT(*) FILTER (WHERE longitude IS NULL) FROM raw_listings
      UNION ALL SELECT 'listings', 'availability_365 in [0, 365]', COUNT(*) FILTER (WHERE availability_365 > 365) FROM raw_listings
      UNION ALL SELECT 'calendar', 'available in {t, f}', COUNT(*) FILTER (WHERE available IS NULL) FROM calendar
      UNION ALL SELECT 'calendar', 'date is parseable', COUNT(*) FILTER (WHERE listing_id % 1000 = 3) FROM calendar
      UNION ALL SELECT 'reviews', 'date is parseable', COUNT(*) FILTER (WHERE id % 500 = 7) FROM reviews
      UNION ALL SELECT 'reviews', 'listing_id not null', COUNT(*) FILTER (WHERE listing_id IS NULL) FROM reviews"""))

# Profiling


def profiled_sql(columns, numbers, table):
    parts = []
    for c, dtype in columns:
        n = c in numbers
        stats = ", ".join(f"{'round_even(' + f + '(' + c + '), 4)' if n else 'NULL'} AS {a}"
                          for f, a in (("min", "min"), ("max", "max"), ("avg", "mean"), ("stddev_samp", "std")))
        parts.append(f"""SELECT 'customer' AS dataset, '{c}' AS "column", '{dtype}' AS dtype,
          COUNT(*) - COUNT({c}) AS null_count, round_even((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 2) AS null_pct,
          COUNT(DISTINCT {c}) AS unique_values, (SELECT string_agg(v, ', ' ORDER BY v) FROM
            (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {table} WHERE {c} IS NOT NULL ORDER BY v LIMIT 3)) AS sample_values,
          {stats} FROM {table}""")
    return " UNION ALL ".join(parts)


def customer(spark, folder):
    return roles.table(spark, folder, "customer").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal")))


CUSTOMER = {"gappy": "SELECT * REPLACE (CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal) FROM customer"}
CUSTOMER_COLUMNS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                    ("c_mktsegment", "string")]
QUERIES["profile_columns"] = (
    lambda s, d: profile.profile_columns(customer(s, d), "customer"),
    oracle(profiled_sql(CUSTOMER_COLUMNS, {"c_custkey", "c_nationkey", "c_acctbal"}, "gappy"), CUSTOMER))
QUERIES["high_null_columns"] = (
    lambda s, d: profile.high_null_columns(profile.null_counts(customer(s, d)), 49.0),
    oracle("""SELECT 'c_acctbal' AS "column", round_even((COUNT(*) - COUNT(c_acctbal)) / COUNT(*) * 100, 2) AS null_pct
              FROM gappy HAVING (COUNT(*) - COUNT(c_acctbal)) / COUNT(*) * 100 > 49""", CUSTOMER))
QUERIES["schema_summary"] = (
    lambda s, d: profile.schema_summary(customer(s, d)),
    oracle(" UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype, COUNT(*) AS row_count, COUNT({c}) AS non_null FROM gappy"""
        for i, (c, t) in enumerate(CUSTOMER_COLUMNS)), CUSTOMER))
QUERIES["uniqueness"] = (
    lambda s, d: profile.uniqueness(roles.calendar(s, d).select("listing_id", "date", "available", "month_name")),
    oracle(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS non_null, COUNT(DISTINCT {c}) AS unique_values,
            COUNT(DISTINCT {c}) = COUNT(*) AS is_unique FROM calendar""" for c in ("listing_id", "date", "available", "month_name"))))
OUTLIERS = " UNION ALL ".join(f"""
SELECT 'listings' AS dataset, '{c}' AS "column", COUNT(v) AS "count", round_even(ANY_VALUE(q1), 2) AS "Q1",
  round_even(MEDIAN(v), 2) AS median, round_even(ANY_VALUE(q3), 2) AS "Q3", round_even(ANY_VALUE(q3 - q1), 2) AS "IQR",
  round_even(ANY_VALUE(q1 - 1.5 * (q3 - q1)), 2) AS lower_fence, round_even(ANY_VALUE(q3 + 1.5 * (q3 - q1)), 2) AS upper_fence,
  COUNT(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outlier_count,
  round_even(COUNT(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) / COUNT(v) * 100, 2) AS outlier_pct,
  COUNT(*) FILTER (WHERE v > q3 + 3 * (q3 - q1)) AS extreme_high_count, round_even(MAX(v), 2) AS max_value
FROM (SELECT v, (SELECT quantile_cont({e}, 0.25) FROM typed_price) AS q1, (SELECT quantile_cont({e}, 0.75) FROM typed_price) AS q3
      FROM (SELECT {e} AS v FROM typed_price) WHERE v IS NOT NULL)"""
    for c, e in (("price", "amount"), ("number_of_reviews", "number_of_reviews"), ("minimum_nights", "CAST(minimum_nights AS DOUBLE)")))
QUERIES["detect_outliers"] = (
    lambda s, d: profile.detect_outliers(raw_listings(s, d), ["price", "number_of_reviews", "minimum_nights", "absent"], "listings"),
    o(OUTLIERS))
QUERIES["detect_outliers_events"] = (
    lambda s, d: profile.detect_outliers(
        roles.table(s, d, "events").select("value"), ["value"], "events").select("count", "outlier_count", "extreme_high_count"),
    """SELECT COUNT(*) AS "count", COUNT(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outlier_count,
       COUNT(*) FILTER (WHERE value > q3 + 3 * (q3 - q1)) AS extreme_high_count
       FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)""")
QUERIES["exact_duplicates"] = (
    lambda s, d: profile.exact_duplicates(roles.table(s, d, "part").select("p_name", "p_brand", "p_size"), "p_name", "part"),
    """SELECT 'part' AS dataset, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
       round_even(SUM(n - 1) / SUM(n) * 100, 3) AS duplicate_rows_pct,
       (SELECT COUNT(*) - COUNT(DISTINCT p_name) FROM part) AS duplicate_keys
       FROM (SELECT COUNT(*) AS n FROM part GROUP BY p_name, p_brand, p_size)""")
QUERIES["fuzzy_duplicates"] = (lambda s, d: fuzzy_duplicates(roles.table(s, d, "part"), "p_name", 0.80), None)
CRITICAL = {"c_acctbal": "Cannot rank customers", "c_name": "Cannot address customers"}
QUERIES["completeness"] = (
    lambda s, d: profile.completeness(customer(s, d), "customer", CRITICAL),
    oracle(" UNION ALL ".join(
        f"""SELECT 'customer' AS dataset, '{c}' AS "column", COUNT(*) - COUNT({c}) AS null_count,
            round_even((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 2) AS null_pct, {str(c in CRITICAL).upper()} AS is_critical,
            '{CRITICAL.get(c, "")}' AS implication FROM gappy""" for c, _ in CUSTOMER_COLUMNS), CUSTOMER))
QUERIES["critical_gaps"] = (
    lambda s, d: profile.critical_gaps(profile.completeness(customer(s, d), "customer", CRITICAL)).select("column"),
    oracle("""SELECT 'c_acctbal' AS "column" FROM gappy HAVING (COUNT(*) - COUNT(c_acctbal)) / COUNT(*) > 0.05""", CUSTOMER))
MISSING = ["price", "bedrooms", "beds", "bathrooms", "review_scores_rating", "room_type"]
QUERIES["missing_table"] = (
    lambda s, d: profile.missing_table(roles.listings(s, d), MISSING),
    oracle("SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS missing_count,
            round_even((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 2) AS missing_pct FROM listings""" for c in MISSING)
        + ") WHERE missing_count > 0"))
NUMBERS = ["price", "accommodates", "bedrooms", "review_scores_rating"]


def described(extra=""):
    return oracle(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS "count", AVG({c}) AS mean, STDDEV_SAMP({c}) AS std, MIN({c}) AS min,
            MAX({c}) AS max, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75
            {extra.replace('{c}', c)} FROM listings""" for c in NUMBERS))


QUERIES["describe_numbers"] = near(
    lambda s, d: profile.describe_numbers(roles.listings(s, d), NUMBERS), described(), "mean", "std", "p25", "p50", "p75")
QUERIES["numeric_summary"] = near(
    lambda s, d: profile.describe_numbers(roles.listings(s, d), NUMBERS, with_missing=True),
    described(", round_even((COUNT(*) - COUNT({c})) / COUNT(*) * 100, 2) AS missing_pct"),
    "mean", "std", "p25", "p50", "p75")
QUERIES["describe_categories"] = (
    lambda s, d: profile.describe_categories(roles.listings(s, d), ["room_type", "property_type"]),
    oracle(" UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(SUM(n) AS BIGINT) AS "count", COUNT(*) AS "unique",
            (SELECT v FROM counts_{c} ORDER BY n DESC, v LIMIT 1) AS top, MAX(n) AS freq FROM counts_{c}"""
        for c in ("room_type", "property_type")),
        {f"counts_{c}": f"SELECT {c} AS v, COUNT(*) AS n FROM listings GROUP BY {c}" for c in ("room_type", "property_type")}))
QUERIES["value_counts"] = (
    lambda s, d: profile.value_counts(roles.listings(s, d), "property_type", 10),
    oracle("""SELECT property_type, COUNT(*) AS n FROM listings WHERE property_type IS NOT NULL
              GROUP BY property_type ORDER BY n DESC, property_type LIMIT 10"""))
QUERIES["blank_strings"] = (
    lambda s, d: profile.blank_strings(raw_listings(s, d), ["price", "room_type"]),
    o("""SELECT 'price' AS "column", COUNT(*) FILTER (WHERE price = '') AS blank_count FROM raw_listings
         UNION ALL SELECT 'room_type', COUNT(*) FILTER (WHERE room_type = '') FROM raw_listings"""))
QUERIES["skewness_audit"] = near(
    lambda s, d: profile.skewness_audit(roles.listings(s, d)),
    oracle("SELECT skewness(price) AS skew_price, skewness(ln(1 + price)) AS skew_log_price FROM listings"),
    "skew_price", "skew_log_price")
QUERIES["profile_report_summary"] = (
    lambda s, d: profile.report_summary(profile.profile_all(raw_all(s, d)))["violations"].select("dataset", "rule", "violations"),
    None)
QUERIES["profile_all_rows"] = (
    lambda s, d: profile.profile_all(raw_all(s, d))["completeness"].select("dataset", "column", "null_count", "is_critical"), None)
