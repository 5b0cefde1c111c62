"""Area statistics and their join back to the listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.scalar import ratio, round_half_even
from marketlens.operators.quantiles import grouped
from marketlens.sizing import join_small


def area_stats(df: DataFrame, area: str = "neighbourhood_cleansed", slices: int | None = None) -> DataFrame:
    """One row per area that has a valid listing: prices, counts, ratings, occupancy, hosts, rank.

    All statistics come from one pass with conditional aggregates; prices use valid listings only.
    """
    valid = F.col("_is_valid") if "_is_valid" in df.columns else F.lit(True)
    price = F.when(valid, F.col("price"))
    rated = F.col("review_scores_rating").isNotNull()
    out = [
        F.count_if(valid).alias("_valid"),
        round_half_even(F.avg(price), 2).alias("neighbourhood_mean_price"),
        round_half_even(F.min(price), 2).alias("neighbourhood_min_price"),
        round_half_even(F.max(price), 2).alias("neighbourhood_max_price"),
        round_half_even(F.stddev_samp(price), 2).alias("neighbourhood_price_std"),
        F.count("id").alias("neighbourhood_listing_count"),
    ]
    scores = {
        "review_scores_rating": "neighbourhood_avg_rating",
        "review_scores_cleanliness": "neighbourhood_avg_cleanliness",
        "review_scores_location": "neighbourhood_avg_location",
    }
    out += [
        round_half_even(F.avg(F.when(rated, F.col(c))), 3).alias(name)
        for c, name in scores.items() if c in df.columns
    ]
    if "occupancy_rate" in df.columns:
        out.append(round_half_even(F.avg("occupancy_rate"), 4).alias("neighbourhood_avg_occupancy"))
    if "host_is_superhost" in df.columns:
        share = F.count_if("host_is_superhost") / F.count(F.lit(1)) * 100
        out.append(round_half_even(share, 1).alias("neighbourhood_superhost_pct"))
    stats = (
        grouped(df.where(F.col(area).isNotNull()), [area], out, {"_median": (price, 0.5)}, slices)
        .where(F.col("_valid") > 0)
        .withColumn("neighbourhood_median_price", round_half_even("_median", 2))
        .drop("_valid", "_median")
    )
    return price_rank(stats)


def price_rank(stats: DataFrame, value: str = "neighbourhood_median_price", out: str = "neighbourhood_price_rank") -> DataFrame:
    """Descending rank, ties share the best place, a missing value has no rank. One row per area."""
    order = Window.orderBy(F.col(value).desc_nulls_last())
    return stats.withColumn(out, F.when(F.col(value).isNotNull(), F.rank().over(order)).cast("int"))


def area_extremes(stats: DataFrame, area: str = "neighbourhood_cleansed") -> DataFrame:
    """Most expensive area, area with most listings (name breaks ties), range of medians."""
    by_price = F.struct("neighbourhood_median_price", area)
    by_count = F.struct("neighbourhood_listing_count", area)
    return stats.agg(
        F.max_by(area, by_price).alias("most_expensive_area"),
        F.max_by(area, by_count).alias("largest_area"),
        F.max("neighbourhood_listing_count").alias("largest_area_listings"),
        F.min("neighbourhood_median_price").alias("lowest_median_price"),
        F.max("neighbourhood_median_price").alias("highest_median_price"),
    )


def price_vs_area_median(price: str = "price", area_median: str = "neighbourhood_median_price") -> Column:
    gap = ratio(F.col(price) - F.col(area_median), area_median) * 100
    return round_half_even(gap, 2)


def join_area_stats(df: DataFrame, stats: DataFrame, area: str = "neighbourhood_cleansed") -> DataFrame:
    """Left join of the area statistics and the deviation of each price from its area.

    The statistics are stored and their size is checked: small ones are broadcast and the listings stay where they are.
    """
    return join_small(df, stats, area).withColumn("price_vs_neighbourhood_median", price_vs_area_median())


def enrich_with_areas(df: DataFrame, area: str = "neighbourhood_cleansed") -> DataFrame:
    return join_area_stats(df, area_stats(df, area), area)
