"""Market reports: key figures, group tables, top lists, distributions and correlations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.moments import pair_correlations
from marketlens.operators.profile import value_counts
from marketlens.operators.quantiles import grouped, median, scalar_quantile
from marketlens.sizing import join_small

REVENUE = "estimated_annual_revenue_computed"
AREA = "neighbourhood_cleansed"


# Key figures


def superhost_share(flag: str = "host_is_superhost") -> Column:
    return F.try_divide(F.count_if(F.col(flag)) * 100, F.count(F.lit(1)))


def kpi_baseline(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("listings"), F.avg("price").alias("mean_price"),
        F.avg("occupancy_rate").alias("mean_occupancy"), superhost_share().alias("superhost_pct"),
    )


def kpi_market(df: DataFrame, slices: int | None = None) -> DataFrame:
    return grouped(df, [], [
        F.count(F.lit(1)).alias("listings"), F.avg("price").alias("mean_price"),
        F.avg("review_scores_rating").alias("mean_rating"), F.avg("occupancy_rate").alias("mean_occupancy"),
        F.avg(REVENUE).alias("mean_revenue"), F.count_if("host_is_superhost").alias("superhosts"),
        superhost_share().alias("superhost_pct"), F.avg("number_of_reviews").alias("mean_reviews"),
    ], {"median_price": median("price"), "median_min_nights": median("minimum_nights")}, slices)


def kpi_host(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("host_response_rate").alias("mean_response_rate"),
        F.avg("host_acceptance_rate").alias("mean_acceptance_rate"),
        F.avg("host_tenure_years").alias("mean_tenure_years"),
    )


def price_overview(df: DataFrame, price: str = "price", slices: int | None = None) -> DataFrame:
    return grouped(df, [], [
        F.count(F.lit(1)).alias("listings"), F.count(price).alias("priced_listings"), F.min(price).alias("min_price"),
        F.max(price).alias("max_price"), F.avg(price).alias("mean_price"),
    ], {"median_price": median(price)}, slices)


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """Rows in total and per named condition."""
    return df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def scalar_summary(df: DataFrame, quantiles: Mapping[str, tuple[str, float]], maxima: Mapping[str, str] | None = None,
                   slices: int | None = None) -> DataFrame:
    """Named percentiles and maxima of the whole frame."""
    return grouped(df, [], [F.max(c).alias(n) for n, c in (maxima or {}).items()], quantiles, slices)


# Group tables


def group_mean(df: DataFrame, by: str, metric: str) -> DataFrame:
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.avg(metric).alias("value"))


def group_median(df: DataFrame, by: str, metric: str = "price", slices: int | None = None) -> DataFrame:
    return grouped(df.where(F.col(by).isNotNull()), [by], quantiles={"value": median(metric)}, slices=slices)


def area_table(df: DataFrame, area: str = AREA, slices: int | None = None) -> DataFrame:
    return grouped(df.where(F.col(area).isNotNull()), [area], [
        F.count("id").alias("listings"), F.avg("price").alias("mean_price"),
        F.avg("occupancy_rate").alias("mean_occupancy"), F.avg("review_scores_rating").alias("mean_rating"),
    ], {"median_price": median("price")}, slices).orderBy(F.col("median_price").desc(), area)


def area_price_topk(df: DataFrame, k: int = 10, ascending: bool = False, area: str = AREA,
                    slices: int | None = None) -> DataFrame:
    out = group_median(df, area, "price", slices).withColumnRenamed("value", "median_price")
    order = F.col("median_price").asc_nulls_last() if ascending else F.col("median_price").desc_nulls_last()
    return out.orderBy(order, area).limit(k)


def price_by_category(df: DataFrame, by: str, price: str = "price", slices: int | None = None) -> DataFrame:
    """Count, median and mean of the known prices per category, dearest first."""
    priced = df.where(F.col(price).isNotNull() & F.col(by).isNotNull())
    return grouped(priced, [by], [F.count(price).alias("listings"), F.avg(price).alias("mean_price")],
                   {"median_price": median(price)}, slices).orderBy(F.col("median_price").desc(), by)


def segment_share(df: DataFrame, segment: str = "host_segment") -> DataFrame:
    counts = value_counts(df, segment)
    # One row per segment: the unpartitioned window holds only those.
    return counts.withColumn("share_pct", F.col("n") * 100 / F.sum("n").over(Window.partitionBy()))


def superhost_performance(df: DataFrame) -> DataFrame:
    label = F.when(F.col("host_is_superhost"), F.lit("Superhost")).otherwise(F.lit("Regular Host"))
    return df.where(F.col("host_is_superhost").isNotNull()).groupBy(label.alias("host_type")).agg(
        F.avg("price").alias("mean_price"), F.avg("occupancy_rate").alias("mean_occupancy"),
        F.avg(REVENUE).alias("mean_revenue"),
    )


def room_revenue_rank(df: DataFrame, k: int | None = None, slices: int | None = None) -> DataFrame:
    out = group_median(df, "room_type", REVENUE, slices).withColumnRenamed("value", "median_revenue")
    ordered = out.orderBy(F.col("median_revenue").desc_nulls_last(), "room_type")
    return ordered.limit(k) if k else ordered


def area_demand(df: DataFrame, min_listings: int = 10, area: str = AREA, slices: int | None = None) -> DataFrame:
    """Occupancy, median price and size per area; small areas are left out unless all are small."""
    out = grouped(df.where(F.col(area).isNotNull()), [area], [
        F.avg("occupancy_rate").alias("mean_occupancy"), F.count("id").alias("listings"),
    ], {"median_price": median("price")}, slices)
    enough = F.col("listings") >= min_listings
    # One row per area is left, so the unpartitioned window holds only those.
    any_enough = F.max(enough).over(Window.partitionBy())
    return out.withColumn("_any", any_enough).where(enough | ~F.col("_any")).drop("_any")


def top_occupancy_areas(df: DataFrame, k: int = 3, min_listings: int = 10, area: str = AREA,
                        slices: int | None = None) -> DataFrame:
    demand = area_demand(df, min_listings, area, slices)
    return demand.orderBy(F.col("mean_occupancy").desc_nulls_last(), area).limit(k)


def opportunity_areas(df: DataFrame, k: int = 3, min_listings: int = 10, area: str = AREA,
                      slices: int | None = None) -> DataFrame:
    """Areas with occupancy above and supply below the median area."""
    demand = area_demand(df, min_listings, area, slices)
    # Medians over one row per area; a percentile of that few values fits any task.
    every = Window.partitionBy()
    busy = F.col("mean_occupancy") > F.percentile("mean_occupancy", F.lit(0.5)).over(every)
    small = F.col("listings") < F.percentile("listings", F.lit(0.5)).over(every)
    ranked = demand.withColumns({"_busy": busy, "_small": small}).where("_busy AND _small").drop("_busy", "_small")
    return ranked.orderBy(F.col("mean_occupancy").desc(), area).limit(k)


def superhost_premium(df: DataFrame, slices: int | None = None) -> DataFrame:
    """Median revenue of superhosts minus that of the others; zero when a group is missing."""
    mine, others = (F.when(F.col("host_is_superhost") == v, F.col(REVENUE)) for v in (True, False))
    out = grouped(df, [], quantiles={"superhost_median": median(mine), "other_median": median(others)}, slices=slices)
    return out.withColumn("premium", F.coalesce(F.col("superhost_median") - F.col("other_median"), F.lit(0.0)))


def top_value_rows(df: DataFrame, column: str, k: int = 8) -> DataFrame:
    """Rows whose value is among the k most frequent ones. The k values are a bounded broadcast."""
    return df.join(F.broadcast(value_counts(df, column, k).select(column)), column, "left_semi")


def expensive_rows(df: DataFrame, above: float = 5000, k: int = 20, price: str = "price", key: str = "id") -> DataFrame:
    return df.where(F.col(price) > above).orderBy(F.col(price).desc(), key).limit(k)


# Distributions


def box_stats(df: DataFrame, by: str, value: str = "price", slices: int | None = None) -> DataFrame:
    """Quartiles and whiskers (the extreme values within 1.5 quartile distances) per group."""
    known = df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).select(by, F.col(value).cast("double").alias("_v"))
    quartiles = grouped(known, [by], [F.count("_v").alias("n")],
                        {"q1": ("_v", 0.25), "median": ("_v", 0.5), "q3": ("_v", 0.75)}, slices)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    whiskers = join_small(known, quartiles, by, "inner").groupBy(by).agg(
        F.min(F.when(F.col("_v") >= F.col("q1") - reach, F.col("_v"))).alias("whisker_low"),
        F.max(F.when(F.col("_v") <= F.col("q3") + reach, F.col("_v"))).alias("whisker_high"),
    )
    return quartiles.join(whiskers, by)


def histogram(df: DataFrame, value: str, bins: int, upto_quantile: float | None = None,
              above: float | None = None, upper: float | None = None) -> DataFrame:
    """Equal-width counts between the smallest and largest value; the last bin is closed.

    `upto_quantile` keeps values up to an exact percentile, `above` keeps larger values only and
    `upper` moves larger values to that bound. Empty bins are absent.
    """
    v = F.col(value).cast("double")
    kept = df.where(F.col(value).isNotNull())
    if above is not None:
        kept = kept.where(v > above)
    if upto_quantile is not None:
        kept = kept.where(v <= scalar_quantile(kept, value, upto_quantile))
    kept = kept.select((F.least(v, F.lit(float(upper))) if upper is not None else v).alias("_v"))
    bounds = kept.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()
    low, width = bounds["low"], (bounds["high"] - bounds["low"]) / bins
    position = F.when(width > 0, F.least(F.floor((F.col("_v") - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (
        kept.withColumns({"bin": position.cast("int"), "_low": low, "_width": width})
        .groupBy("bin", "_low", "_width").agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (F.col("_low") + F.col("bin") * F.col("_width")).alias("bin_start"),
                (F.col("_low") + (F.col("bin") + 1) * F.col("_width")).alias("bin_end"), "n")
    )


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows that have both, in one pass (`pair_correlations`)."""
    return pair_correlations(df, [c for c in columns if c in df.columns])
