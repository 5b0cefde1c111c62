"""Per-listing summaries of reviews and calendars, and their joins to the listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.fixed_values import DAYS_PER_MONTH
from marketlens.functions.scalar import ratio, round_half_even


def review_summary(
    reviews: DataFrame, listing: str = "listing_id", review: str = "id", day: str = "date",
    has_text: str = "_has_text",
) -> DataFrame:
    """One row per reviewed listing: counts, first and last date, active months, monthly rate.

    Only partial aggregates cross the shuffle, so one listing may hold any share of the reviews.
    """
    months = round_half_even(
        F.datediff("latest_review_date", "earliest_review_date") / DAYS_PER_MONTH, 2
    )
    per_month = round_half_even(ratio("review_count", "active_review_months"), 4)
    return (
        reviews.where(F.col(listing).isNotNull()).groupBy(F.col(listing).alias("listing_id"))
        .agg(
            F.count(review).alias("review_count"),
            F.max(day).alias("latest_review_date"),
            F.min(day).alias("earliest_review_date"),
            F.count_if(has_text).alias("has_text_review_count"),
        )
        .withColumn("active_review_months", months)
        .withColumn(
            "reviews_per_month_computed",
            F.when(F.col("active_review_months") > 0, per_month).otherwise(F.lit(0.0)),
        )
    )


def calendar_summary(
    calendar: DataFrame, listing: str = "listing_id", available: str = "available",
    weekend: str = "is_weekend", month: str = "month",
) -> DataFrame:
    """One row per listing: days, occupancy in total and by weekend flag, busiest month.

    One pass and one shuffle on the listing: the busiest month comes from twelve conditional counts
    rather than from a second grouping. A month tie goes to the earlier month.
    """
    free, is_weekend = F.col(available), F.col(weekend)
    booked_by_month = [F.count_if(~free & (F.col(month) == m)).alias(f"_booked_{m}") for m in range(1, 13)]

    def seen(flag: Column, counted: Column) -> Column:
        """A count over one side of the weekend split is missing when the listing has no such day."""
        return F.when(F.count_if(flag) > 0, F.count_if(counted))

    counts = calendar.where(F.col(listing).isNotNull()).groupBy(F.col(listing).alias("listing_id")).agg(
        F.count(free).alias("total_days"),
        F.count_if(~free).alias("booked_days"),
        F.count_if(free).alias("available_days"),
        seen(is_weekend, ~free & is_weekend).alias("weekend_booked_days"),
        seen(is_weekend, free.isNotNull() & is_weekend).alias("weekend_total_days"),
        seen(~is_weekend, ~free & ~is_weekend).alias("weekday_booked_days"),
        seen(~is_weekend, free.isNotNull() & ~is_weekend).alias("weekday_total_days"),
        *booked_by_month,
    )
    busiest = F.greatest(*[
        F.when(F.col(f"_booked_{m}") > 0, F.struct(F.col(f"_booked_{m}").alias("days"), F.lit(-m).alias("neg_month")))
        for m in range(1, 13)
    ])
    return counts.withColumns({
        "peak_month": -busiest["neg_month"],
        "occupancy_rate": round_half_even(ratio("booked_days", "total_days"), 4),
        "weekend_occupancy_rate": round_half_even(ratio("weekend_booked_days", "weekend_total_days"), 4),
        "weekday_occupancy_rate": round_half_even(ratio("weekday_booked_days", "weekday_total_days"), 4),
    }).drop(*[f"_booked_{m}" for m in range(1, 13)])


def join_summary(listings: DataFrame, summary: DataFrame, key: str = "id") -> DataFrame:
    """Left join of a per-listing summary; every listing stays, the summary's key is dropped."""
    matched = listings[key] == summary["listing_id"]
    return listings.join(summary, matched, "left").drop(summary["listing_id"])


def join_all_summaries(listings: DataFrame, reviews: DataFrame, calendar: DataFrame) -> DataFrame:
    joined = join_summary(listings, review_summary(reviews))
    return join_summary(joined, calendar_summary(calendar))


def match_counts(master: DataFrame) -> DataFrame:
    """Rows, and rows that found reviews or a calendar."""
    return master.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("review_count").alias("matched_reviews"),
        F.count("occupancy_rate").alias("matched_calendar"),
    )
