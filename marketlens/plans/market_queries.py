"""The eight market questions over the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.quantiles import grouped, median
from marketlens.sizing import join_small


def q1_area_price_ranking(dim_neighbourhood: DataFrame) -> DataFrame:
    return dim_neighbourhood.select(
        "neighbourhood", "neighbourhood_price_tier", "neighbourhood_price_rank",
        F.round("neighbourhood_median_price", 2).alias("median_price"),
        F.round("neighbourhood_mean_price", 2).alias("mean_price"),
        F.col("neighbourhood_listing_count").alias("listing_count"),
        F.round("neighbourhood_avg_rating", 2).alias("avg_rating"),
        F.round(F.col("neighbourhood_avg_occupancy") * 100, 1).alias("occupancy_pct"),
    ).orderBy("neighbourhood_price_rank", "neighbourhood")


def q2_room_type_pricing(fact_listings: DataFrame, dim_room_type: DataFrame, slices: int | None = None) -> DataFrame:
    joined = join_small(fact_listings.where("_is_valid"), dim_room_type, "room_type", "inner")
    out = grouped(
        joined, ["room_type", "room_category"],
        [
            F.count("listing_id").alias("listing_count"),
            F.round(F.avg("price"), 2).alias("mean_price"),
            F.round(F.avg("review_scores_rating"), 3).alias("avg_rating"),
        ],
        {"median_price": median("price"), "p25_price": ("price", 0.25), "p75_price": ("price", 0.75)}, slices,
    )
    money = {c: F.round(c, 2) for c in ("median_price", "p25_price", "p75_price")}
    return out.withColumns(money).orderBy(F.col("median_price").desc(), "room_type")


def q3_superhost_comparison(fact_listings: DataFrame, dim_host: DataFrame, slices: int | None = None) -> DataFrame:
    hosts = dim_host.select("host_id", "host_is_superhost")
    out = grouped(
        fact_listings.where("_is_valid").join(hosts, "host_id"), ["host_is_superhost"],
        [
            F.count("listing_id").alias("listing_count"),
            F.round(F.avg("price"), 2).alias("mean_price"),
            F.round(F.avg("review_scores_rating"), 3).alias("avg_rating"),
            F.round(F.avg("occupancy_rate") * 100, 1).alias("avg_occupancy_pct"),
            F.round(F.avg("estimated_annual_revenue_computed"), 0).alias("avg_est_revenue"),
        ],
        {"median_price": median("price")}, slices,
    )
    return out.withColumn("median_price", F.round("median_price", 2)).orderBy(F.col("host_is_superhost").desc())


def q4_host_concentration(fact_listings: DataFrame, dim_host: DataFrame, slices: int | None = None) -> DataFrame:
    hosts = dim_host.select("host_id", "host_segment")
    joined = fact_listings.select("listing_id", "host_id", "price", "review_scores_rating").join(hosts, "host_id")
    out = grouped(
        joined, ["host_segment"],
        [
            F.count_distinct("host_id").alias("host_count"),
            F.count("listing_id").alias("total_listings"),
            F.round(F.avg("review_scores_rating"), 3).alias("avg_rating"),
        ],
        {"median_price": median("price")}, slices,
    )
    # One row per segment is left here, so the unpartitioned window holds only those.
    share = F.col("total_listings") * 100.0 / F.sum("total_listings").over(Window.partitionBy())
    return out.withColumns(
        {"pct_of_market": F.round(share, 1), "median_price": F.round("median_price", 2)}
    ).orderBy(F.col("total_listings").desc(), "host_segment")


def q5_weekend_occupancy(fact_calendar: DataFrame) -> DataFrame:
    return (
        fact_calendar.where(F.col("price").isNotNull()).groupBy("is_weekend")
        .agg(
            F.count(F.lit(1)).alias("day_count"),
            F.round(F.count_if(~F.col("available")) * 100.0 / F.count(F.lit(1)), 2).alias("occupancy_pct"),
            F.round(F.avg("price"), 2).alias("avg_price"),
        )
        .orderBy(F.col("is_weekend").desc())
    )


def q6_top_revenue_areas(fact_listings: DataFrame, k: int = 10, slices: int | None = None) -> DataFrame:
    revenue = F.col("estimated_annual_revenue_computed")
    out = grouped(
        fact_listings.where(F.col("_is_valid") & revenue.isNotNull()), ["neighbourhood"],
        [
            F.count("listing_id").alias("listing_count"),
            F.round(F.avg("occupancy_rate") * 100, 1).alias("avg_occupancy_pct"),
            F.round(F.avg(revenue), 0).alias("avg_est_revenue"),
            F.round(F.max(revenue), 0).alias("max_est_revenue"),
        ],
        {"median_price": median("price")}, slices,
    )
    return out.withColumn("median_price", F.round("median_price", 2)).orderBy(
        F.col("avg_est_revenue").desc(), "neighbourhood"
    ).limit(k)


def q7_scores_by_room_type(fact_listings: DataFrame) -> DataFrame:
    scores = {
        "overall": "rating", "cleanliness": "cleanliness", "location": "location",
        "communication": "communication", "checkin": "checkin", "value": "value",
    }
    means = [F.round(F.avg(f"review_scores_{c}"), 3).alias(name) for name, c in scores.items()]
    rated = fact_listings.where(F.col("review_scores_rating").isNotNull())
    return rated.groupBy("room_type").agg(*means).orderBy(F.col("overall").desc(), "room_type")


def q8_seasonal_occupancy(fact_calendar: DataFrame) -> DataFrame:
    booked = F.count_if(~F.col("available")) * 100.0 / F.count(F.lit(1))
    return (
        fact_calendar.groupBy("month_name", "month")
        .agg(F.count(F.lit(1)).alias("total_days"), F.round(booked, 2).alias("occupancy_pct"))
        .orderBy("month")
    )
