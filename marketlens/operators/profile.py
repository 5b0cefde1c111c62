"""Column profiles, outliers, duplicates and completeness."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from marketlens.functions import fixed_values as fixed
from marketlens.functions.scalar import parse_money, round_half_even
from marketlens.operators.fuzzy import fuzzy_duplicates
from marketlens.operators.features import column_quantiles
from marketlens.operators.quality import domain_violations, surplus_rows
from marketlens.operators.sketches import merge_sketches, profile_from_sketches, sketch_columns
from marketlens.sizing import cut_lineage

# Columns per aggregate: beyond this the generated code of one aggregation becomes too large.
COLUMNS_PER_PASS = 40


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def per_column(df: DataFrame, columns: Sequence[str], measures: dict[str, "callable"]) -> DataFrame:
    """One row per column with the given measures, from wide aggregates over groups of columns."""
    parts = []
    for start in range(0, len(columns), COLUMNS_PER_PASS):
        chunk = columns[start:start + COLUMNS_PER_PASS]
        wide = df.agg(*[
            F.struct(F.lit(c).alias("column"), *[m(c).alias(n) for n, m in measures.items()]).alias(f"c{i}")
            for i, c in enumerate(chunk)
        ])
        parts.append(wide.select(F.inline(F.array(*[f"c{i}" for i in range(len(chunk))]))))
    return reduce(DataFrame.unionByName, parts)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, nulls and null share (two decimals) per column."""
    out = per_column(df, list(columns or df.columns), {
        "row_count": lambda c: F.count(F.lit(1)), "null_count": lambda c: F.count_if(F.col(f"`{c}`").isNull()),
    })
    return out.withColumn("null_pct", round_half_even(F.try_divide(F.col("null_count"), F.col("row_count")) * 100, 2))


def melt_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, value) with every value as text."""
    text = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot([], list(columns), "column", "value")


def distinct_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Occurrences of each distinct value of each column, counted before and after the shuffle."""
    melted = melt_text(df, list(columns or df.columns)).where(F.col("value").isNotNull())
    return melted.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def uniqueness(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, and whether the column is unique.

    Exact counts melt the columns and count distinct (column, value) pairs, which spreads every column
    over all tasks; `approximate=True` needs one pass without that shuffle.
    """
    names = list(columns or df.columns)
    if approximate:
        return per_column(df, names, {
            "non_null": lambda c: F.count(f"`{c}`"), "unique_values": lambda c: F.approx_count_distinct(f"`{c}`"),
        })
    found = distinct_values(df, names).groupBy("column").agg(
        F.sum("n").alias("non_null"), F.count(F.lit(1)).alias("unique_values"))
    every = null_counts(df, names).select("column", "row_count")
    return every.join(found, "column", "left").select(
        "column", F.coalesce("non_null", F.lit(0)).alias("non_null"),
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
        (F.coalesce("unique_values", F.lit(0)) == F.col("row_count")).alias("is_unique"),
    )


def sample_values(values: DataFrame, k: int = 3) -> DataFrame:
    """The k smallest distinct values per column as text; at most k rows per task are shuffled."""
    order = Window.partitionBy("column").orderBy("value")
    first = values.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k)
    return first.groupBy("column").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("sample_values"))


def profile_columns(df: DataFrame, dataset: str, approximate: bool = False) -> DataFrame:
    """Type, nulls, distinct values, samples and numeric summary per column.

    `approximate=True` takes distinct values and samples from sketches (see `profile_from_sketches`), without a shuffle of
    values; profiles that grow load by load store `sketch_columns` and merge.
    """
    if approximate:
        merged = profile_from_sketches(merge_sketches(sketch_columns(df, dataset, "")))
        return merged.select("dataset", "column", "dtype", "null_count", "null_pct", "unique_values", "sample_values",
                             "min", "max", "mean", "std")
    types = F.create_map(*[F.lit(x) for name_type in df.dtypes for x in name_type])
    values = distinct_values(df)
    nulls = null_counts(df).drop("row_count")
    distinct = values.groupBy("column").agg(F.count(F.lit(1)).alias("unique_values"))
    out = nulls.join(distinct, "column", "left").join(sample_values(values), "column", "left")
    numbers = numeric_columns(df)
    stats = {"min": F.min, "max": F.max, "mean": F.avg, "std": F.stddev_samp}
    if numbers:
        summary = per_column(df, numbers, {
            n: (lambda c, f=f: round_half_even(f(F.col(f"`{c}`").cast("double")), 4)) for n, f in stats.items()
        })
        out = out.join(summary, "column", "left")
    else:
        out = out.withColumns({n: F.lit(None).cast("double") for n in stats})
    return out.select(
        F.lit(dataset).alias("dataset"), "column", types[F.col("column")].alias("dtype"), "null_count", "null_pct",
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
        F.coalesce("sample_values", F.lit("")).alias("sample_values"), *stats,
    )


def high_null_columns(profile: DataFrame, threshold: float = 50.0) -> DataFrame:
    return profile.where(F.col("null_pct") > threshold).select("column", "null_pct")


def schema_summary(df: DataFrame) -> DataFrame:
    """Position, type and filled values per column."""
    types = F.create_map(*[F.lit(x) for name_type in df.dtypes for x in name_type])
    positions = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)])
    return null_counts(df).select(
        positions[F.col("column")].alias("position"), "column", types[F.col("column")].alias("dtype"), "row_count",
        (F.col("row_count") - F.col("null_count")).alias("non_null"),
    )


def as_number(df: DataFrame, c: str) -> Column:
    return parse_money(c) if dict(df.dtypes)[c] == "string" else F.col(c).cast("double")


def detect_outliers(df: DataFrame, columns: Sequence[str], dataset: str, slices: int | None = None) -> DataFrame:
    """Fences at 1.5 times the quartile distance per column, and the values beyond them."""
    names = [c for c in columns if c in df.columns]
    numbers = df.select([as_number(df, c).alias(c) for c in names])
    quartiles = column_quantiles(
        numbers, names, {"_q1": 0.25, "_q2": 0.5, "_q3": 0.75}, [F.max("value").alias("_max")], slices
    ).where(F.col("valid") > 0)
    spread = F.col("_q3") - F.col("_q1")
    fences = quartiles.withColumns(
        {"_iqr": spread, "_low": F.col("_q1") - 1.5 * spread, "_high": F.col("_q3") + 1.5 * spread,
         "_extreme": F.col("_q3") + 3 * spread})
    # One row per column: bounded by the schema, hence safe to broadcast.
    melted = numbers.unpivot([], names, "column", "value").where(F.col("value").isNotNull())
    v = F.col("value")
    counts = (
        melted.join(F.broadcast(fences.select("column", "_low", "_high", "_extreme")), "column").groupBy("column")
        .agg(F.count_if((v < F.col("_low")) | (v > F.col("_high"))).alias("outlier_count"),
             F.count_if(v > F.col("_extreme")).alias("extreme_high_count"))
    )
    named = {"Q1": "_q1", "median": "_q2", "Q3": "_q3", "IQR": "_iqr", "lower_fence": "_low",
             "upper_fence": "_high", "max_value": "_max"}
    return fences.join(counts, "column").select(
        F.lit(dataset).alias("dataset"), "column", F.col("valid").alias("count"),
        *[round_half_even(c, 2).alias(n) for n, c in named.items()],
        "outlier_count", round_half_even(F.col("outlier_count") / F.col("valid") * 100, 2).alias("outlier_pct"),
        "extreme_high_count",
    )


def exact_duplicates(df: DataFrame, key: str, dataset: str) -> DataFrame:
    """Rows beyond the first of each identical row, and of each key. A missing key is one value.

    Rows are grouped by a 256-bit digest of their JSON form, which tells nulls from empty texts and keeps microseconds:
    32 bytes a row are shuffled. Zero and negative zero are one value, but for those inside arrays and structs.
    """
    fields = [(F.col(f"`{c}`") + F.lit(0).cast(kind) if kind in ("float", "double") else F.col(f"`{c}`")).alias(f"c{i}")
              for i, (c, kind) in enumerate(df.dtypes)]
    row = F.to_json(F.struct(*fields), {
        "ignoreNullFields": "false", "timeZone": "UTC", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    repeats = df.groupBy(F.unhex(F.sha2(row, 256)).alias("_row")).agg(F.count(F.lit(1)).alias("_n"))
    rows = repeats.agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicate_rows"))
    keys = df.agg(surplus_rows(key).alias("k")).scalar() if key in df.columns else F.lit(0)
    return rows.select(
        F.lit(dataset).alias("dataset"), "duplicate_rows",
        round_half_even(F.try_divide(F.col("duplicate_rows"), F.col("rows")) * 100, 3).alias("duplicate_rows_pct"),
        keys.cast("long").alias("duplicate_keys"),
    )


def completeness(df: DataFrame, dataset: str, critical: dict[str, str] | None = None) -> DataFrame:
    """Null share per column, worst first, with what a missing critical field means."""
    fields = fixed.CRITICAL_FIELDS.get(dataset, {}) if critical is None else critical
    text = F.lit("")
    for name, implication in fields.items():
        text = F.when(F.col("column") == name, F.lit(implication)).otherwise(text)
    return null_counts(df).select(
        F.lit(dataset).alias("dataset"), "column", "null_count", "null_pct",
        F.col("column").isin(*fields).alias("is_critical") if fields else F.lit(False).alias("is_critical"),
        text.alias("implication"),
    ).orderBy(F.col("null_pct").desc(), "column")


def critical_gaps(report: DataFrame, above: float = 5.0) -> DataFrame:
    return report.where(F.col("is_critical") & (F.col("null_pct") > above))


def missing_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, worst first."""
    return null_counts(df, columns).where(F.col("null_count") > 0).select(
        "column", F.col("null_count").alias("missing_count"), F.col("null_pct").alias("missing_pct")
    ).orderBy(F.col("missing_pct").desc(), "column")


def describe_numbers(
    df: DataFrame, columns: Sequence[str] | None = None, with_missing: bool = False, slices: int | None = None
) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column."""
    names = [c for c in (columns or numeric_columns(df)) if c in df.columns]
    extra = [F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
             F.max("value").alias("max")]
    if with_missing:
        share = F.count_if(F.col("value").isNull()) / F.count(F.lit(1)) * 100
        extra.append(round_half_even(share, 2).alias("missing_pct"))
    return column_quantiles(df, names, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, extra, slices).withColumnRenamed(
        "valid", "count")


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value (smallest on ties) and its frequency per column."""
    # At most one row per column and task is ranked: the most frequent value, the smallest text among equals.
    values = cut_lineage(distinct_values(df, columns))
    order = Window.partitionBy("column").orderBy(F.col("n").desc(), "value")
    top = values.withColumn("_r", F.row_number().over(order)).where("_r = 1").select(
        "column", F.col("value").alias("top"), F.col("n").alias("freq"))
    sums = values.groupBy("column").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"))
    return sums.join(top, "column").select("column", "count", "unique", "top", "freq")


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Frequency of each non-null value, most frequent first."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = out.orderBy(F.col("n").desc(), column)
    return ordered.limit(k) if k else ordered


def blank_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Empty strings per text column."""
    return per_column(df, list(columns), {"blank_count": lambda c: F.count_if(F.col(f"`{c}`") == "")})


def adjusted_skewness(c: Column | str) -> Column:
    """Sample skewness with the small-sample correction."""
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def skewness_audit(df: DataFrame, price: str = "price") -> DataFrame:
    return df.agg(
        adjusted_skewness(F.col(price)).alias("skew_price"),
        adjusted_skewness(F.log1p(price)).alias("skew_log_price"),
    )


def profile_all(frames: dict[str, DataFrame], approximate: bool = False) -> dict[str, DataFrame]:
    """The whole report: every part of every data set, united by kind."""
    parts: dict[str, list[DataFrame]] = {}

    def add(kind: str, frame: DataFrame) -> None:
        parts.setdefault(kind, []).append(frame)

    for name, df in frames.items():
        key, fuzzy, outlier_columns = fixed.PROFILE_CONFIG.get(name, (None, None, []))
        add("column_profiles", profile_columns(df, name, approximate))
        if any(c in df.columns for c in outlier_columns):
            add("outliers", detect_outliers(df, outlier_columns, name))
        if key and key in df.columns:
            add("duplicate_summary", exact_duplicates(df, key, name))
        if fuzzy and fuzzy in df.columns:
            add("fuzzy_duplicates", fuzzy_duplicates(df, fuzzy))
        add("completeness", completeness(df, name))
        if name in fixed.CRITICAL_FIELDS:
            add("domain_violations", domain_violations(df, name))
    return {kind: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), group) for kind, group in parts.items()}


def report_summary(report: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the report's reader sees first."""
    out = {}
    if "domain_violations" in report:
        out["violations"] = report["domain_violations"].where(F.col("violations") > 0)
    if "outliers" in report:
        out["outliers"] = report["outliers"].where(F.col("outlier_count") > 0).select(
            "dataset", "column", "outlier_count", "outlier_pct", "upper_fence")
    gaps = report["completeness"].where(F.col("is_critical") & (F.col("null_pct") > 0))
    out["critical_gaps"] = gaps.orderBy(F.col("null_pct").desc(), "dataset", "column").limit(8)
    return out
