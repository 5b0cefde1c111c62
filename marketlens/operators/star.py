"""Star schema: four dimensions and two facts derived from the master table and the calendar."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.fixed_values import ROOM_CATEGORIES
from marketlens.functions.scalar import calendar_parts, map_category

HOST_ATTRIBUTES = [
    "host_name", "host_since", "host_is_superhost", "host_response_rate", "host_response_time",
    "host_acceptance_rate", "host_identity_verified", "host_has_profile_pic", "host_total_listings_count",
    "host_tenure_years", "host_segment",
]
AREA_ATTRIBUTES = [
    "neighbourhood_median_price", "neighbourhood_mean_price", "neighbourhood_listing_count",
    "neighbourhood_avg_rating", "neighbourhood_avg_occupancy", "neighbourhood_price_rank",
    "neighbourhood_superhost_pct",
]
DATE_ATTRIBUTES = ["month", "month_name", "quarter", "year", "day_of_week", "is_weekend"]
LISTING_MEASURES = [
    "host_id", "neighbourhood_cleansed", "room_type", "city", "latitude", "longitude", "accommodates", "bedrooms",
    "beds", "price", "price_per_bedroom", "price_tier", "price_vs_neighbourhood_median", "minimum_nights",
    "maximum_nights", "availability_365", "number_of_reviews", "review_scores_rating", "review_scores_cleanliness",
    "review_scores_location", "review_scores_communication", "review_scores_checkin", "review_scores_value",
    "review_count", "review_frequency", "days_since_last_review", "occupancy_rate", "weekend_occupancy_rate",
    "weekday_occupancy_rate", "estimated_annual_revenue_computed", "estimated_revenue_l365d",
    "estimated_occupancy_l365d", "instant_bookable", "host_tenure_years", "host_segment", "is_high_performer",
    "_is_valid",
]
CALENDAR_MEASURES = ["listing_id", "date", "available", "price", "minimum_nights", "maximum_nights", *DATE_ATTRIBUTES]


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def build_dim(
    df: DataFrame, keys: Sequence[str], attributes: Sequence[str], mode: str = "keyed",
    latest_by: str | None = None,
) -> DataFrame:
    """A dimension with one row per key (`mode="keyed"`), or every distinct combination (`"distinct"`).

    A keyed dimension takes all attributes from one and the same source row: the one with the largest
    `latest_by`, then the largest attribute values. Only one row per key and task is shuffled.
    """
    attributes = present(df, attributes)
    known = df.where(F.col(keys[0]).isNotNull())
    if mode == "distinct" or not attributes:
        return known.select(*keys, *attributes).distinct()
    order = [F.col(latest_by).alias("_latest")] if latest_by else []
    version = F.max(F.struct(*order, *attributes)).alias("_row")
    return known.groupBy(*keys).agg(version).select(*keys, *[F.col(f"_row.`{a}`").alias(a) for a in attributes])


def dim_host(master: DataFrame, mode: str = "keyed") -> DataFrame:
    return build_dim(master, ["host_id"], HOST_ATTRIBUTES, mode)


def area_price_tier(median: str = "neighbourhood_median_price") -> Column:
    m = F.col(median)
    return F.when(m >= 200, F.lit("Premium")).when(m >= 120, F.lit("Mid-range")).otherwise(F.lit("Budget"))


def dim_neighbourhood(master: DataFrame, mode: str = "keyed") -> DataFrame:
    attributes = ["neighbourhood_group_cleansed", "city", *AREA_ATTRIBUTES]
    dim = build_dim(master, ["neighbourhood_cleansed"], attributes, mode)
    return dim.withColumn("neighbourhood_price_tier", area_price_tier()).withColumnsRenamed(
        {"neighbourhood_cleansed": "neighbourhood", "neighbourhood_group_cleansed": "neighbourhood_group"}
    )


def dim_room_type(master: DataFrame, mode: str = "keyed") -> DataFrame:
    attributes = [] if mode == "keyed" else ["property_type", "property_type_normalized"]
    dim = build_dim(master, ["room_type"], attributes, mode)
    return dim.withColumn("room_category", map_category("room_type", ROOM_CATEGORIES))


def dim_date(calendar: DataFrame) -> DataFrame:
    """Distinct dates first, then their parts: only the date itself is shuffled, in a hash aggregation."""
    parts = calendar_parts("date")
    dates = calendar.where(F.col("date").isNotNull()).select("date").distinct()
    return dates.select("date", *[parts[a].alias(a) for a in present(calendar, DATE_ATTRIBUTES)])


def fact_listings(master: DataFrame) -> DataFrame:
    return master.select(F.col("id").alias("listing_id"), *present(master, LISTING_MEASURES)).withColumnRenamed(
        "neighbourhood_cleansed", "neighbourhood"
    )


def fact_calendar(calendar: DataFrame) -> DataFrame:
    return calendar.select(*present(calendar, CALENDAR_MEASURES))


def build_star(master: DataFrame, calendar: DataFrame | None = None, mode: str = "keyed") -> dict[str, DataFrame]:
    """All tables by name; the two calendar tables only when there is a calendar."""
    tables = {
        "dim_host": dim_host(master, mode), "dim_neighbourhood": dim_neighbourhood(master, mode),
        "dim_room_type": dim_room_type(master, mode), "fact_listings": fact_listings(master),
    }
    if calendar is not None:
        tables |= {"dim_date": dim_date(calendar), "fact_calendar": fact_calendar(calendar)}
    return tables


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, as one frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
