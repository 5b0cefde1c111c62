"""Report filters: predicates over plain columns, so that they reach the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.quantiles import grouped


def apply_filters(
    df: DataFrame,
    isin: dict[str, Sequence[str]] | None = None,
    flags: dict[str, bool | None] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> DataFrame:
    """Keep rows that satisfy every given filter.

    An empty list or a `None` flag means no filter on that column; ranges are inclusive.
    """
    predicates: list[Column] = [F.col(c).isin(list(v)) for c, v in (isin or {}).items() if v]
    predicates += [F.col(c) == F.lit(v) for c, v in (flags or {}).items() if v is not None]
    predicates += [F.col(c).between(low, high) for c, (low, high) in (ranges or {}).items()]
    return df.where(reduce(lambda a, b: a & b, predicates)) if predicates else df


def distinct_values_of(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def search_values(df: DataFrame, column: str, text: str) -> DataFrame:
    """Distinct values that contain the text, ignoring case."""
    return distinct_values_of(df, column).where(F.lower(column).contains(text.lower()))


def filter_options(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as (column, value) rows."""
    text = df.select([F.col(c).cast("string").alias(c) for c in columns])
    return text.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull()).distinct()


def filter_bounds(df: DataFrame, slices: int | None = None) -> DataFrame:
    """Slider bounds: lowest price, 99th percentile price, largest bedroom and guest counts."""
    return grouped(df, [], [
        F.min("price").alias("min_price"), F.max("bedrooms").alias("max_bedrooms"),
        F.max("accommodates").alias("max_accommodates"),
    ], {"max_price": ("price", 0.99)}, slices)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A reproducible simple random sample without replacement: the n smallest keyed hashes."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def leaking_features(features: Sequence[str]) -> list[str]:
    """Feature names that give the target away."""
    return [f for f in features if "price" in f.lower() or "revenue" in f.lower()]
