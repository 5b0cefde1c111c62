"""Summaries, master table, star schema and the eight market questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import roles
from catalog.oracle import oracle
from marketlens.operators import areas, features, star, summaries
from marketlens.operators.cleaning import serving_defaults
from marketlens.plans import market_queries as mq
from marketlens.sources.sinks import run_sql

QUERIES = {}


def master(spark, folder):
    return features.build_master(roles.clean(spark, folder), roles.AS_OF)


def served(spark, folder):
    return serving_defaults(master(spark, folder))


def featured(spark, folder):
    """The master table before the area statistics."""
    parts = roles.clean(spark, folder)
    joined = summaries.join_all_summaries(parts["listings"], parts["reviews"], parts["calendar"])
    return features.engineer_features(joined, roles.AS_OF, medians_from=parts["listings"])


def fact(spark, folder):
    """The listings fact without the columns that need the area statistics."""
    return star.fact_listings(featured(spark, folder))


def dims(spark, folder):
    return star.dim_host(featured(spark, folder))


QUERIES["review_summary"] = (
    lambda s, d: summaries.review_summary(roles.reviews(s, d)), oracle("SELECT * FROM review_summary"))
QUERIES["calendar_summary"] = (
    lambda s, d: summaries.calendar_summary(roles.calendar(s, d)), oracle("SELECT * FROM calendar_summary"))
QUERIES["peak_month"] = (
    lambda s, d: summaries.calendar_summary(roles.calendar(s, d)).select("listing_id", "peak_month"),
    oracle("SELECT listing_id, peak_month FROM calendar_summary"))
QUERIES["join_review_summary"] = (
    lambda s, d: summaries.join_summary(
        roles.listings(s, d).select("id", "price"), summaries.review_summary(roles.reviews(s, d))),
    oracle("SELECT id, price, r.* EXCLUDE (listing_id) FROM listings l LEFT JOIN review_summary r ON l.id = r.listing_id"))
QUERIES["join_calendar_summary"] = (
    lambda s, d: summaries.join_summary(
        roles.listings(s, d).select("id", "price"), summaries.calendar_summary(roles.calendar(s, d))),
    oracle("SELECT id, price, c.* EXCLUDE (listing_id) FROM listings l LEFT JOIN calendar_summary c ON l.id = c.listing_id"))
QUERIES["match_counts"] = (
    lambda s, d: summaries.match_counts(featured(s, d)),
    oracle("SELECT COUNT(*) AS rows, COUNT(review_count) AS matched_reviews, "
           "COUNT(occupancy_rate) AS matched_calendar FROM featured"))
QUERIES["engineered_features"] = (featured, oracle("SELECT * FROM featured"))
QUERIES["area_stats"] = (lambda s, d: areas.area_stats(featured(s, d)), oracle("SELECT * FROM area_stats"))
QUERIES["area_extremes"] = (
    lambda s, d: areas.area_extremes(areas.area_stats(featured(s, d))),
    oracle("""SELECT
        (SELECT neighbourhood_cleansed FROM area_stats ORDER BY neighbourhood_median_price DESC, neighbourhood_cleansed DESC LIMIT 1) AS most_expensive_area,
        (SELECT neighbourhood_cleansed FROM area_stats ORDER BY neighbourhood_listing_count DESC, neighbourhood_cleansed DESC LIMIT 1) AS largest_area,
        MAX(neighbourhood_listing_count) AS largest_area_listings, MIN(neighbourhood_median_price) AS lowest_median_price,
        MAX(neighbourhood_median_price) AS highest_median_price FROM area_stats"""))
QUERIES["master_listings"] = (master, oracle("SELECT * FROM master"))
QUERIES["price_vs_area_median"] = (
    lambda s, d: master(s, d).select("id", "price", "neighbourhood_median_price", "price_vs_neighbourhood_median"),
    oracle("SELECT id, price, neighbourhood_median_price, price_vs_neighbourhood_median FROM master"))
QUERIES["tier_distribution"] = (
    lambda s, d: features.tier_distribution(roles.listings(s, d).withColumn("price_tier", features.price_tier())),
    oracle("""SELECT price_tier, COUNT(*) AS listings, COUNT(*) * 100 / SUM(COUNT(*)) OVER () AS pct
              FROM featured WHERE price_tier IS NOT NULL GROUP BY price_tier"""))
QUERIES["feature_audit"] = (
    lambda s, d: features.feature_audit(featured(s, d)),
    oracle(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS valid, CAST(MEDIAN({c}) AS DOUBLE) AS median_value FROM featured"
        for c in features.AUDITED)))
QUERIES["map_points"] = (
    lambda s, d: features.map_points(featured(s, d)),
    oracle("""SELECT id, latitude, longitude, price, neighbourhood_cleansed, room_type, review_scores_rating,
        occupancy_rate, LEAST(GREATEST(COALESCE(occupancy_rate, 0), 0), 1) * 12 + 3 AS marker_size,
        (SELECT GREATEST(50, quantile_cont(price, 0.95)) FROM featured) AS color_cap,
        (SELECT median(latitude) FROM featured) AS center_latitude,
        (SELECT median(longitude) FROM featured) AS center_longitude FROM featured"""))

# Star schema

QUERIES["dim_host"] = (dims, oracle("SELECT * FROM dim_host"))
QUERIES["dim_host_distinct"] = (
    lambda s, d: star.dim_host(featured(s, d), "distinct"),
    oracle("""SELECT DISTINCT host_id, host_since, host_is_superhost, host_response_rate, host_acceptance_rate,
        host_total_listings_count, host_tenure_years, host_segment FROM featured"""))
AREA_DIM = """
SELECT DISTINCT neighbourhood_cleansed AS neighbourhood, neighbourhood_group_cleansed AS neighbourhood_group,
  neighbourhood_median_price, neighbourhood_mean_price, neighbourhood_listing_count, neighbourhood_avg_rating,
  neighbourhood_avg_occupancy, neighbourhood_price_rank, neighbourhood_superhost_pct,
  CASE WHEN neighbourhood_median_price >= 200 THEN 'Premium' WHEN neighbourhood_median_price >= 120 THEN 'Mid-range'
       ELSE 'Budget' END AS neighbourhood_price_tier FROM master"""
QUERIES["dim_neighbourhood"] = (lambda s, d: star.dim_neighbourhood(master(s, d)), oracle(AREA_DIM))
ROOM_CATEGORY = """CASE WHEN room_type = 'Entire home/apt' THEN 'Entire Place' WHEN room_type = 'Hotel room' THEN 'Hotel'
  WHEN room_type IN ('Private room', 'Shared room') THEN 'Shared' ELSE 'Other' END AS room_category"""
QUERIES["dim_room_type"] = (
    lambda s, d: star.dim_room_type(roles.listings(s, d)),
    oracle(f"SELECT DISTINCT room_type, {ROOM_CATEGORY} FROM listings"))
QUERIES["dim_room_type_distinct"] = (
    lambda s, d: star.dim_room_type(roles.listings(s, d), "distinct"),
    oracle(f"SELECT DISTINCT room_type, property_type, {ROOM_CATEGORY} FROM listings"))
QUERIES["dim_date"] = (
    lambda s, d: star.dim_date(roles.calendar(s, d)),
    oracle("SELECT DISTINCT date, month, month_name, quarter, year, day_of_week, is_weekend FROM calendar"))
LISTING_FACT = ", ".join(
    c for c in star.LISTING_MEASURES
    if c not in ("city", "maximum_nights", "estimated_revenue_l365d", "estimated_occupancy_l365d", "neighbourhood_cleansed"))
QUERIES["fact_listings"] = (
    lambda s, d: star.fact_listings(master(s, d)),
    oracle(f"SELECT id AS listing_id, neighbourhood_cleansed AS neighbourhood, {LISTING_FACT} FROM master"))
QUERIES["fact_calendar"] = (
    lambda s, d: star.fact_calendar(roles.calendar(s, d)),
    oracle("""SELECT listing_id, date, available, price, minimum_nights, month, month_name, quarter, year,
              day_of_week, is_weekend FROM calendar"""))
QUERIES["star_row_counts"] = (
    lambda s, d: star.row_counts(star.build_star(master(s, d), roles.calendar(s, d))),
    oracle("""SELECT 'dim_host' AS table_name, COUNT(DISTINCT host_id) AS row_count FROM listings
        UNION ALL SELECT 'dim_neighbourhood', COUNT(DISTINCT neighbourhood_cleansed) FROM listings
        UNION ALL SELECT 'dim_room_type', COUNT(DISTINCT room_type) FROM listings
        UNION ALL SELECT 'dim_date', COUNT(DISTINCT date) FROM calendar
        UNION ALL SELECT 'fact_listings', COUNT(*) FROM listings
        UNION ALL SELECT 'fact_calendar', COUNT(*) FROM calendar"""))

# The eight market questions

QUERIES["q1_area_price_ranking"] = (
    lambda s, d: mq.q1_area_price_ranking(star.dim_neighbourhood(master(s, d))),
    oracle("""SELECT neighbourhood, neighbourhood_price_tier, neighbourhood_price_rank,
        round(neighbourhood_median_price, 2) AS median_price, round(neighbourhood_mean_price, 2) AS mean_price,
        neighbourhood_listing_count AS listing_count, round(neighbourhood_avg_rating, 2) AS avg_rating,
        round(neighbourhood_avg_occupancy * 100, 1) AS occupancy_pct FROM area_dim""", {"area_dim": AREA_DIM}))
Q2 = """SELECT f.room_type, d.room_category, COUNT(id) AS listing_count, round(median(price), 2) AS median_price,
    round(avg(price), 2) AS mean_price, round(quantile_cont(price, 0.25), 2) AS p25_price,
    round(quantile_cont(price, 0.75), 2) AS p75_price, round(avg(review_scores_rating), 3) AS avg_rating
    FROM listings f JOIN room_dim d ON f.room_type = d.room_type WHERE _is_valid GROUP BY ALL"""
QUERIES["q2_room_type_pricing"] = (
    lambda s, d: mq.q2_room_type_pricing(
        star.fact_listings(roles.listings(s, d)), star.dim_room_type(roles.listings(s, d))),
    oracle(Q2, {"room_dim": f"SELECT DISTINCT room_type, {ROOM_CATEGORY} FROM listings"}))
QUERIES["q2_room_type_pricing_distinct"] = (
    lambda s, d: mq.q2_room_type_pricing(
        star.fact_listings(roles.listings(s, d)), star.dim_room_type(roles.listings(s, d), "distinct")),
    oracle(Q2, {"room_dim": f"SELECT DISTINCT room_type, property_type, {ROOM_CATEGORY} FROM listings"}))
QUERIES["q3_superhost_comparison"] = (
    lambda s, d: mq.q3_superhost_comparison(fact(s, d), star.dim_host(roles.listings(s, d))),
    oracle("""SELECT host_is_superhost, COUNT(id) AS listing_count, round(median(price), 2) AS median_price,
        round(avg(price), 2) AS mean_price, round(avg(review_scores_rating), 3) AS avg_rating,
        round(avg(occupancy_rate) * 100, 1) AS avg_occupancy_pct,
        round(avg(estimated_annual_revenue_computed), 0) AS avg_est_revenue
        FROM featured WHERE _is_valid GROUP BY host_is_superhost"""))
QUERIES["q4_host_concentration"] = (
    lambda s, d: mq.q4_host_concentration(
        star.fact_listings(roles.listings(s, d)),
        star.dim_host(features.engineer_features(roles.listings(s, d), roles.AS_OF))),
    oracle("""SELECT host_segment, COUNT(DISTINCT host_id) AS host_count, COUNT(id) AS total_listings,
        round(COUNT(id) * 100.0 / SUM(COUNT(id)) OVER (), 1) AS pct_of_market, round(median(price), 2) AS median_price,
        round(avg(review_scores_rating), 3) AS avg_rating FROM featured GROUP BY host_segment"""))
QUERIES["q5_weekend_occupancy"] = (
    lambda s, d: mq.q5_weekend_occupancy(star.fact_calendar(roles.calendar(s, d))),
    oracle("""SELECT is_weekend, COUNT(*) AS day_count,
        round(SUM(CASE WHEN available = FALSE THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2) AS occupancy_pct,
        round(avg(price), 2) AS avg_price FROM calendar WHERE price IS NOT NULL GROUP BY is_weekend"""))
QUERIES["q6_top_revenue_areas"] = (
    lambda s, d: mq.q6_top_revenue_areas(fact(s, d)),
    oracle("""SELECT neighbourhood_cleansed AS neighbourhood, COUNT(id) AS listing_count,
        round(median(price), 2) AS median_price, round(avg(occupancy_rate) * 100, 1) AS avg_occupancy_pct,
        round(avg(estimated_annual_revenue_computed), 0) AS avg_est_revenue,
        round(max(estimated_annual_revenue_computed), 0) AS max_est_revenue
        FROM featured WHERE _is_valid AND estimated_annual_revenue_computed IS NOT NULL
        GROUP BY ALL ORDER BY avg_est_revenue DESC, neighbourhood LIMIT 10"""))
QUERIES["q7_scores_by_room_type"] = (
    lambda s, d: mq.q7_scores_by_room_type(star.fact_listings(roles.listings(s, d))),
    oracle("""SELECT room_type, round(avg(review_scores_rating), 3) AS overall,
        round(avg(review_scores_cleanliness), 3) AS cleanliness, round(avg(review_scores_location), 3) AS location,
        round(avg(review_scores_communication), 3) AS communication, round(avg(review_scores_checkin), 3) AS checkin,
        round(avg(review_scores_value), 3) AS value
        FROM listings WHERE review_scores_rating IS NOT NULL GROUP BY room_type"""))
QUERIES["q8_seasonal_occupancy"] = (
    lambda s, d: mq.q8_seasonal_occupancy(star.fact_calendar(roles.calendar(s, d))),
    oracle("""SELECT month_name, month, COUNT(*) AS total_days,
        round(COUNT(*) FILTER (WHERE NOT available) * 100.0 / COUNT(*), 2) AS occupancy_pct
        FROM calendar GROUP BY month_name, month"""))
QUERIES["sql_text_over_star"] = (
    lambda s, d: run_sql(
        s, """SELECT d.quarter, count(*) AS days, count_if(NOT f.available) AS booked
              FROM star_calendar f JOIN star_date d ON f.date = d.date GROUP BY d.quarter""",
        {"star_calendar": star.fact_calendar(roles.calendar(s, d)), "star_date": star.dim_date(roles.calendar(s, d))}),
    oracle("""SELECT quarter, COUNT(*) AS days, COUNT(*) FILTER (WHERE NOT available) AS booked
              FROM calendar GROUP BY quarter"""))
