"""Reference SQL fragments (DuckDB) that the per-query statements build on."""

from __future__ import annotations

import re

from catalog.roles import CALENDAR_SQL, LISTINGS_SQL, REVIEWS_SQL

TIER = """CASE WHEN {0} IS NULL OR {0} <= 0 THEN NULL WHEN {0} <= 80 THEN 'Budget (≤€80)'
  WHEN {0} <= 150 THEN 'Mid-range (€81–€150)' WHEN {0} <= 300 THEN 'Premium (€151–€300)' ELSE 'Luxury (>€300)' END"""
SEGMENT = """CASE WHEN COALESCE({0}, 1) <= 0 THEN NULL WHEN COALESCE({0}, 1) <= 1 THEN 'Single-listing'
  WHEN {0} <= 5 THEN 'Small (2-5)' WHEN {0} <= 20 THEN 'Medium (6-20)' ELSE 'Commercial (20+)' END"""

PARTS = {
    "listings": LISTINGS_SQL,
    "calendar": f"""
SELECT *, isodow(date) >= 6 AS is_weekend, monthname(date) AS month_name, dayname(date) AS day_of_week
FROM ({CALENDAR_SQL})""",
    "reviews": f"""
SELECT *, COALESCE(length(comments) > 10, FALSE) AS _has_text,
       COALESCE(contains(lower(comments), 'the host canceled'), FALSE) AS _is_auto_review FROM ({REVIEWS_SQL})""",
    "review_summary": """
SELECT *, CASE WHEN active_review_months > 0
               THEN round_even(review_count / active_review_months, 4) ELSE 0 END AS reviews_per_month_computed
FROM (SELECT listing_id, COUNT(id) AS review_count, MAX(date) AS latest_review_date, MIN(date) AS earliest_review_date,
             COUNT(*) FILTER (WHERE _has_text) AS has_text_review_count,
             round_even(date_diff('day', MIN(date), MAX(date)) / CAST(30.44 AS DOUBLE), 2) AS active_review_months
      FROM reviews WHERE listing_id IS NOT NULL GROUP BY listing_id)""",
    "month_counts": """
SELECT listing_id, month, COUNT(*) AS n FROM calendar WHERE NOT available GROUP BY ALL""",
    "peaks": """
SELECT listing_id, month AS peak_month FROM month_counts
QUALIFY ROW_NUMBER() OVER (PARTITION BY listing_id ORDER BY n DESC, month) = 1""",
    "calendar_counts": """
SELECT listing_id, COUNT(available) AS total_days, COUNT(*) FILTER (WHERE NOT available) AS booked_days,
       COUNT(*) FILTER (WHERE available) AS available_days,
       CASE WHEN COUNT(*) FILTER (WHERE is_weekend) > 0
            THEN COUNT(*) FILTER (WHERE NOT available AND is_weekend) END AS weekend_booked_days,
       CASE WHEN COUNT(*) FILTER (WHERE is_weekend) > 0
            THEN COUNT(available) FILTER (WHERE is_weekend) END AS weekend_total_days,
       CASE WHEN COUNT(*) FILTER (WHERE NOT is_weekend) > 0
            THEN COUNT(*) FILTER (WHERE NOT available AND NOT is_weekend) END AS weekday_booked_days,
       CASE WHEN COUNT(*) FILTER (WHERE NOT is_weekend) > 0
            THEN COUNT(available) FILTER (WHERE NOT is_weekend) END AS weekday_total_days
FROM calendar GROUP BY listing_id""",
    "calendar_summary": """
SELECT c.*, p.peak_month, round_even(booked_days / NULLIF(total_days, 0), 4) AS occupancy_rate,
       round_even(weekend_booked_days / NULLIF(weekend_total_days, 0), 4) AS weekend_occupancy_rate,
       round_even(weekday_booked_days / NULLIF(weekday_total_days, 0), 4) AS weekday_occupancy_rate
FROM calendar_counts c LEFT JOIN peaks p USING (listing_id)""",
    "medians": """
SELECT median(review_scores_rating) AS rating_median, median(number_of_reviews) AS reviews_median FROM listings""",
    "featured": f"""
SELECT l.*, r.* EXCLUDE (listing_id), c.* EXCLUDE (listing_id),
       GREATEST(round_even(date_diff('day', host_since, DATE '2025-01-01') / CAST(365.25 AS DOUBLE), 2), 0)
           AS host_tenure_years,
       CASE WHEN bedrooms > 0 THEN round_even(price / bedrooms, 2) END AS price_per_bedroom,
       round_even(occupancy_rate * price * 365, 2) AS estimated_annual_revenue_computed,
       {TIER.format('price')} AS price_tier,
       COALESCE(review_scores_rating >= rating_median AND number_of_reviews >= reviews_median, FALSE)
           AS is_high_performer,
       date_diff('day', latest_review_date, DATE '2025-01-01') AS days_since_last_review,
       {SEGMENT.format('host_total_listings_count')} AS host_segment,
       reviews_per_month_computed AS review_frequency
FROM listings l LEFT JOIN review_summary r ON l.id = r.listing_id
LEFT JOIN calendar_summary c ON l.id = c.listing_id CROSS JOIN medians""",
    "area_stats": """
SELECT *, CAST(CASE WHEN neighbourhood_median_price IS NOT NULL THEN
         RANK() OVER (ORDER BY neighbourhood_median_price DESC NULLS LAST) END AS INT) AS neighbourhood_price_rank
FROM (SELECT neighbourhood_cleansed,
       round_even(AVG(price) FILTER (WHERE _is_valid), 2) AS neighbourhood_mean_price,
       round_even(MIN(price) FILTER (WHERE _is_valid), 2) AS neighbourhood_min_price,
       round_even(MAX(price) FILTER (WHERE _is_valid), 2) AS neighbourhood_max_price,
       round_even(STDDEV_SAMP(price) FILTER (WHERE _is_valid), 2) AS neighbourhood_price_std,
       COUNT(id) AS neighbourhood_listing_count,
       round_even(AVG(review_scores_rating), 3) AS neighbourhood_avg_rating,
       round_even(AVG(review_scores_cleanliness) FILTER (WHERE review_scores_rating IS NOT NULL), 3)
           AS neighbourhood_avg_cleanliness,
       round_even(AVG(review_scores_location) FILTER (WHERE review_scores_rating IS NOT NULL), 3)
           AS neighbourhood_avg_location,
       round_even(AVG(occupancy_rate), 4) AS neighbourhood_avg_occupancy,
       round_even(COUNT(*) FILTER (WHERE host_is_superhost) / COUNT(*) * 100, 1) AS neighbourhood_superhost_pct,
       round_even(MEDIAN(price) FILTER (WHERE _is_valid), 2) AS neighbourhood_median_price
      FROM featured GROUP BY neighbourhood_cleansed HAVING COUNT(*) FILTER (WHERE _is_valid) > 0)""",
    "master": """
SELECT f.*, s.* EXCLUDE (neighbourhood_cleansed),
       round_even((price - neighbourhood_median_price) / neighbourhood_median_price * 100, 2)
           AS price_vs_neighbourhood_median
FROM featured f LEFT JOIN area_stats s USING (neighbourhood_cleansed)""",
    "dim_host": """
SELECT host_id, h.* FROM (
  SELECT host_id, MAX({'host_since': host_since, 'host_is_superhost': host_is_superhost,
    'host_response_rate': host_response_rate, 'host_acceptance_rate': host_acceptance_rate,
    'host_total_listings_count': host_total_listings_count, 'host_tenure_years': host_tenure_years,
    'host_segment': host_segment}) AS h FROM master GROUP BY host_id)""",
    "served": """
SELECT * REPLACE (COALESCE(bedrooms, 1) AS bedrooms, COALESCE(bathrooms, 1) AS bathrooms, COALESCE(beds, 1) AS beds,
       COALESCE(price, 0) AS price, COALESCE(review_scores_rating, 4.5) AS review_scores_rating,
       COALESCE(occupancy_rate, 0) AS occupancy_rate,
       COALESCE(estimated_annual_revenue_computed, 0) AS estimated_annual_revenue_computed) FROM master""",
}


def oracle(body: str, extra: dict[str, str] | None = None) -> str:
    """The statement preceded by exactly the fragments it uses, in dependency order."""
    parts = {**PARTS, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for name, sql in parts.items():
            if name not in order and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(sql)
                if name not in order:
                    order.append(name)

    visit(body)
    return ("WITH " + ",\n".join(f"{n} AS ({parts[n]})" for n in order) + "\n" if order else "") + body
