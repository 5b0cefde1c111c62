"""Derived columns of the master table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.functions.scalar import clip, right_closed_bin, round_half_even
from marketlens.operators.areas import enrich_with_areas
from marketlens.operators.cleaning import days_between, has, host_segment, price_per_bedroom, tenure_years
from marketlens.operators.quantiles import grouped, scalar_quantiles
from marketlens.operators.summaries import join_all_summaries
from marketlens.sizing import cut_lineage, fits_one_task


def price_tier(price: str | Column = "price") -> Column:
    return right_closed_bin(price, fixed.PRICE_TIER_EDGES, fixed.PRICE_TIER_LABELS)


def annual_revenue(occupancy: str = "occupancy_rate", price: str = "price") -> Column:
    return round_half_even(F.col(occupancy) * F.col(price) * 365, 2)


def review_frequency(df: DataFrame) -> Column | None:
    """Best source at hand: joined reviews, the listing's own column, or reviews per tenure month."""
    if has(df, "reviews_per_month_computed"):
        return F.col("reviews_per_month_computed")
    if has(df, "reviews_per_month"):
        return F.col("reviews_per_month")
    if has(df, "number_of_reviews", "host_tenure_years"):
        return round_half_even(F.col("number_of_reviews") / clip(F.col("host_tenure_years") * 12, 1.0), 4)
    return None


def days_since_last_review(df: DataFrame, as_of: date) -> Column | None:
    for c in ("latest_review_date", "last_review"):
        if c in df.columns:
            return days_between(as_of, c)
    return None


def high_performer(df: DataFrame, rating: str = "review_scores_rating", reviews: str = "number_of_reviews") -> Column:
    """At or above the median in rating and in reviews; a missing value gives false."""
    medians = scalar_quantiles(df, {"rating": (rating, 0.5), "reviews": (reviews, 0.5)})
    good, busy = F.col(rating) >= medians["rating"], F.col(reviews) >= medians["reviews"]
    return F.coalesce(good & busy, F.lit(False))


def engineer_features(df: DataFrame, as_of: date, medians_from: DataFrame | None = None) -> DataFrame:
    """All derived columns whose inputs exist.

    `medians_from` names a narrower frame with the same rows for the two medians of the performance
    flag, so that the scalar subquery does not repeat the joins of `df`.
    """
    columns: dict[str, Column] = {}
    if has(df, "host_since"):
        columns["host_tenure_years"] = tenure_years(as_of, "host_since")
    if has(df, "price", "bedrooms"):
        columns["price_per_bedroom"] = price_per_bedroom()
    if has(df, "occupancy_rate", "price"):
        columns["estimated_annual_revenue_computed"] = annual_revenue()
    if has(df, "price"):
        columns["price_tier"] = price_tier()
    if has(df, "review_scores_rating", "number_of_reviews"):
        columns["is_high_performer"] = high_performer(medians_from if medians_from is not None else df)
    recency = days_since_last_review(df, as_of)
    if recency is not None:
        columns["days_since_last_review"] = recency
    if has(df, "host_total_listings_count"):
        columns["host_segment"] = host_segment()
    out = df.withColumns(columns) if columns else df
    frequency = review_frequency(out)
    return out if frequency is None else out.withColumn("review_frequency", frequency)


def build_master(clean: dict[str, DataFrame], as_of: date) -> DataFrame:
    """One row per listing with review, calendar and area statistics and all derived columns."""
    joined = join_all_summaries(clean["listings"], clean["reviews"], clean["calendar"])
    featured = engineer_features(joined, as_of, medians_from=clean["listings"])
    # The area statistics read the joined table several times once it is large; join it only once.
    return enrich_with_areas(featured if fits_one_task(featured) else cut_lineage(featured))


def tier_distribution(df: DataFrame, tier: str = "price_tier") -> DataFrame:
    """Listings per price tier and their share of the priced ones."""
    counts = df.where(F.col(tier).isNotNull()).groupBy(tier).agg(F.count(F.lit(1)).alias("listings"))
    total = counts.agg(F.sum("listings")).scalar()
    return counts.withColumn("pct", F.col("listings") * 100 / total)


AUDITED = [
    "host_tenure_years", "price_per_bedroom", "review_frequency", "estimated_annual_revenue_computed",
    "review_scores_rating", "number_of_reviews", "days_since_last_review",
]


def feature_audit(df: DataFrame, columns: list[str] = AUDITED, slices: int | None = None) -> DataFrame:
    """One row per derived column: valid values and exact median."""
    return column_quantiles(df, [c for c in columns if c in df.columns], {"median_value": 0.5}, slices=slices)


def column_quantiles(
    df: DataFrame, columns: list[str], probs: dict[str, float], aggregates: list[Column] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """One row per column with exact quantiles: the columns are melted, then grouped by name."""
    melted = df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    known = [F.count("value").alias("valid"), *(aggregates or [])]
    return grouped(melted, ["column"], known, {n: ("value", p) for n, p in probs.items()}, slices)


def map_points(df: DataFrame, color_floor: float = 50.0) -> DataFrame:
    """Marker size and colour value per listing, with the colour cap and centre of the map."""
    located = df.select(
        "id", "latitude", "longitude", "price", "neighbourhood_cleansed", "room_type",
        "review_scores_rating", "occupancy_rate",
    )
    size = clip(F.coalesce(F.col("occupancy_rate"), F.lit(0.0)), 0.0, 1.0) * 12 + 3
    scale = scalar_quantiles(df, {"cap": ("price", 0.95), "lat": ("latitude", 0.5), "lon": ("longitude", 0.5)})
    return located.withColumns({
        "marker_size": size, "color_cap": F.greatest(F.lit(color_floor), scale["cap"]),
        "center_latitude": scale["lat"], "center_longitude": scale["lon"],
    })
