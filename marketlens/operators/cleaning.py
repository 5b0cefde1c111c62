"""Cleaning of the raw data sets: formats, missing values, geography, validity.

Every step is a projection, so the whole chain of one data set is a single stage without shuffle.
Absent optional columns are skipped when the plan is built.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.functions.scalar import (
    calendar_parts, clean_price, clip, flag_from_tf, flag_or_false, in_box, integer, map_category, number,
    parse_date, parse_percent, right_closed_bin, round_half_even, title_case_or_null,
)


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Replace only columns that exist."""
    return df.withColumns({name: c for name, c in columns.items() if name in df.columns})


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


# Formats


def standardize_listings(df: DataFrame) -> DataFrame:
    columns = {"price": clean_price("price")}
    columns |= {c: integer(c) for c in ("id", "host_id")}
    columns |= {c: parse_date(c) for c in fixed.LISTING_DATES}
    columns |= {c: flag_from_tf(c) for c in fixed.LISTING_FLAGS}
    columns |= {c: parse_percent(c) for c in fixed.LISTING_PERCENTS}
    columns |= {c: number(c) for c in fixed.LISTING_NUMBERS}
    columns["room_type"] = map_category("room_type", {r: r for r in fixed.ROOM_TYPES})
    out = replace_columns(df, columns)
    if has(df, "property_type"):
        out = out.withColumn(
            "property_type_normalized", map_category("property_type", fixed.PROPERTY_TYPES, keep_null=True)
        )
    return out


def standardize_calendar(df: DataFrame, drop_empty: bool = True) -> DataFrame:
    """Typed calendar with date parts; rows without a readable date are dropped.

    `drop_empty` removes `adjusted_price` when it holds no value at all, which needs one look at
    the data (it stops at the first value found).
    """
    out = replace_columns(df, {
        "listing_id": integer("listing_id"),
        "date": parse_date("date"),
        "price": clean_price("price"),
        "available": flag_from_tf("available"),
        "minimum_nights": number("minimum_nights"),
        "maximum_nights": number("maximum_nights"),
    })
    if has(df, "date"):
        out = out.where(F.col("date").isNotNull()).withColumns(calendar_parts("date"))
    return drop_all_null_columns(out, ["adjusted_price"]) if drop_empty else out


def standardize_reviews(df: DataFrame) -> DataFrame:
    out = replace_columns(df, {
        "date": parse_date("date"),
        "id": integer("id"), "listing_id": integer("listing_id"), "reviewer_id": integer("reviewer_id"),
        "comments": F.trim("comments"),
    })
    if has(df, "date"):
        out = out.withColumns({"review_year": F.year("date"), "review_month": F.month("date")})
    return out.withColumns(review_flags("comments")) if has(df, "comments") else out


def review_flags(comments: str) -> dict[str, Column]:
    """Enough text to read, and text written by the platform; missing text gives false."""
    return {
        "_has_text": F.coalesce(F.char_length(comments) > 10, F.lit(False)),
        "_is_auto_review": F.coalesce(F.lower(comments).rlike(fixed.AUTO_REVIEW_PATTERN), F.lit(False)),
    }


def drop_all_null_columns(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Drop those of the candidate columns that hold no value in any row."""
    empty = [c for c in candidates if c in df.columns and df.where(F.col(c).isNotNull()).select(c).isEmpty()]
    return df.drop(*empty)


# Missing values


def fill_sentinel(c: str, value: str) -> Column:
    return F.coalesce(F.col(c), F.lit(value))


def impute_from(c: str, expression: Column) -> Column:
    return F.coalesce(F.col(c), expression)


def fill_when(c: str, condition: Column, value: float) -> Column:
    return F.when(F.col(c).isNull() & condition, F.lit(value)).otherwise(F.col(c))


def sentinel_to_null(c: str, sentinel: float) -> Column:
    return F.nullif(F.col(c), F.lit(sentinel).cast("double"))


def days_between(as_of: date, c: str | Column) -> Column:
    return F.datediff(F.lit(as_of), c)


def tenure_years(as_of: date, host_since: str | Column) -> Column:
    return clip(round_half_even(days_between(as_of, host_since) / fixed.DAYS_PER_YEAR, 2), 0.0)


def price_per_bedroom(price: str = "price", bedrooms: str = "bedrooms") -> Column:
    return F.when(F.col(bedrooms) > 0, round_half_even(F.try_divide(F.col(price), F.col(bedrooms)), 2))


def host_segment(listings: str = "host_total_listings_count") -> Column:
    size = F.coalesce(F.col(listings), F.lit(1))
    return right_closed_bin(size, fixed.HOST_SEGMENT_EDGES, fixed.HOST_SEGMENT_LABELS)


def handle_missing_listings(df: DataFrame, as_of: date) -> DataFrame:
    """Documented strategies; price, ratings, bedrooms and rates stay missing."""
    columns = {"host_response_time": fill_sentinel("host_response_time", "Unknown"),
               "minimum_nights": clip("minimum_nights", upper=365.0),
               "availability_365": clip("availability_365", 0.0, 365.0),
               "estimated_occupancy_l365d": clip("estimated_occupancy_l365d", 0.0, 365.0)}
    if has(df, "beds", "accommodates"):
        columns["beds"] = impute_from("beds", F.ceil(F.col("accommodates") / 2).cast("double"))
    if has(df, "reviews_per_month", "number_of_reviews"):
        no_reviews = F.coalesce(F.col("number_of_reviews"), F.lit(0)) == 0
        columns["reviews_per_month"] = fill_when("reviews_per_month", no_reviews, 0.0)
    out = replace_columns(df, columns)
    derived = {}
    if has(df, "host_since"):
        derived["host_tenure_years"] = tenure_years(as_of, "host_since")
    if has(df, "price", "bedrooms"):
        derived["price_per_bedroom"] = price_per_bedroom()
    if has(df, "number_of_reviews", "host_since") and not has(df, "reviews_per_month"):
        months = F.greatest(days_between(as_of, "host_since") / fixed.DAYS_PER_MONTH, F.lit(1.0))
        derived["review_frequency"] = F.when(
            F.col("host_since").isNotNull(), round_half_even(F.col("number_of_reviews") / months, 4)
        )
    if has(df, "host_total_listings_count"):
        derived["host_segment"] = host_segment()
    return out.withColumns(derived) if derived else out


def handle_missing_calendar(df: DataFrame) -> DataFrame:
    return replace_columns(df, {
        "maximum_nights": sentinel_to_null("maximum_nights", fixed.NO_MAXIMUM_NIGHTS),
        "minimum_nights": clip("minimum_nights", upper=365.0),
    })


def handle_missing_reviews(df: DataFrame) -> DataFrame:
    """Comments and dates stay missing: they cannot be imputed."""
    return df


def serving_defaults(df: DataFrame, defaults: dict[str, float] = fixed.SERVING_DEFAULTS) -> DataFrame:
    """Fill the master table for reports: numbers by constant, flags to false."""
    columns = {c: F.coalesce(number(c), F.lit(v)) for c, v in defaults.items()}
    columns |= {c: flag_or_false(c) for c in ("host_is_superhost", "instant_bookable")}
    return replace_columns(df, columns)


# Geography and validity


def clean_listings_geo(
    df: DataFrame, city: str, box: tuple[float, float, float, float] = fixed.CITY_BOX
) -> DataFrame:
    """Round coordinates, clear both when either is missing or outside the box, unify area names."""
    out = replace_columns(df, {
        "latitude": round_half_even(number("latitude"), 5),
        "longitude": round_half_even(number("longitude"), 5),
        "neighbourhood_cleansed": title_case_or_null("neighbourhood_cleansed"),
        "neighbourhood_group_cleansed": title_case_or_null("neighbourhood_group_cleansed"),
    })
    if has(df, "latitude", "longitude"):
        inside = in_box("latitude", "longitude", box)
        out = out.withColumns({c: F.when(inside, F.col(c)) for c in ("latitude", "longitude")})
    return out.withColumn("city", F.lit(city))


def clean_neighbourhoods(df: DataFrame) -> DataFrame:
    return df.select([title_case_or_null(f"`{c}`").alias(c) for c in df.columns])


def valid_flag(columns: tuple[str, ...] = ("price", "latitude", "longitude", "room_type")) -> Column:
    flag = F.lit(True)
    for c in columns:
        flag = flag & F.col(c).isNotNull()
    return flag


def validity_breakdown(df: DataFrame, flag: str = "_is_valid") -> DataFrame:
    invalid = ~F.col(flag)
    return df.agg(
        F.count_if(flag).alias("valid"), F.count_if(invalid).alias("invalid"),
        F.count_if(invalid & F.col("price").isNull()).alias("null_price"),
        F.count_if(invalid & F.col("latitude").isNull()).alias("null_coordinates"),
    )


def clean_listings(df: DataFrame, as_of: date, city: str, box=fixed.CITY_BOX) -> DataFrame:
    out = handle_missing_listings(standardize_listings(df), as_of)
    return clean_listings_geo(out, city, box).withColumn("_is_valid", valid_flag())


def clean_calendar(df: DataFrame, drop_empty: bool = True) -> DataFrame:
    return handle_missing_calendar(standardize_calendar(df, drop_empty))


def clean_reviews(df: DataFrame) -> DataFrame:
    return handle_missing_reviews(standardize_reviews(df))


def clean_all(raw: dict[str, DataFrame], as_of: date, city: str, box=fixed.CITY_BOX) -> dict[str, DataFrame]:
    return {
        "listings": clean_listings(raw["listings"], as_of, city, box),
        "calendar": clean_calendar(raw["calendar"]),
        "reviews": clean_reviews(raw["reviews"]),
        "neighbourhoods": clean_neighbourhoods(raw["neighbourhoods"]),
    }
