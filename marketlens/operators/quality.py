"""Validation rules as data, evaluated in one aggregate pass per data set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marketlens.functions import fixed_values as fixed
from marketlens.functions.scalar import number, parse_date, parse_money


@dataclass(frozen=True)
class Rule:
    """A measured value per data set; it is an issue when it exceeds `limit` (or falls below `floor`)."""

    name: str
    value: Column
    action: str = ""
    limit: float = 0.0
    floor: float | None = None
    #: Columns of a rule over distinct values; None where plain sums over the rows are enough.
    distinct_of: str | None = None


def outside(c: str, low: float, high: float) -> Column:
    """Rows whose number is missing or not within the inclusive range."""
    return F.count_if(~F.coalesce(number(c).between(low, high), F.lit(False)))


def surplus_rows(key: str) -> Column:
    """Rows beyond the first per key; a missing key counts as one value."""
    known = F.count_distinct(key) + F.when(F.count_if(F.col(key).isNull()) > 0, 1).otherwise(0)
    return F.count(F.lit(1)) - known


def null_share(c: str) -> Column:
    return F.avg(F.col(c).isNull().cast("double")) * 100


def missing_columns(df: DataFrame, dataset: str) -> list[str]:
    return [c for c in fixed.REQUIRED_COLUMNS.get(dataset, []) if c not in df.columns]


def validation_rules(df: DataFrame, dataset: str) -> list[Rule]:
    """The checks of a data set; rules over absent optional columns are left out."""
    lat_low, lat_high, lon_low, lon_high = fixed.COUNTRY_BOX
    price = parse_money("price") if "price" in df.columns else None
    if dataset == "listings":
        rules = [
            Rule("price <= 0", F.count_if(price <= 0)),
            Rule("price unparseable", F.count_if(price.isNull())),
            Rule("latitude outside the country", outside("latitude", lat_low, lat_high)),
            Rule("longitude outside the country", outside("longitude", lon_low, lon_high)),
            Rule("duplicate listing ids", surplus_rows("id"), distinct_of="id"),
        ]
        if "availability_365" in df.columns:
            rules.append(Rule("availability_365 out of range", outside("availability_365", 0, 365)))
        if "estimated_revenue_l365d" in df.columns:
            rules.append(Rule("negative estimated revenue", F.count_if(number("estimated_revenue_l365d") < 0)))
        return rules
    if dataset == "calendar":
        day = parse_date("date")
        rules = [
            Rule("available not in {t, f}", F.count_if(~F.coalesce(F.col("available").isin("t", "f"), F.lit(False)))),
            Rule("unparseable dates", F.count_if(day.isNull())),
            Rule("days spanned", F.datediff(F.max(day), F.min(day)), limit=float("inf"), floor=300),
        ]
        if "adjusted_price" in df.columns:
            rules.append(Rule("adjusted_price null %", null_share("adjusted_price"), limit=20))
        return rules
    if dataset == "reviews":
        return [
            Rule("duplicate review ids", surplus_rows("id"), distinct_of="id"),
            Rule("comments null %", null_share("comments"), limit=10),
            Rule("unparseable dates", F.count_if(parse_date("date").isNull())),
        ]
    return []


def domain_rules(df: DataFrame, dataset: str) -> list[Rule]:
    """The rules of the profiling report with their remedies; an absent column counts no violation."""
    def when_present(c: str, value: Column) -> Column:
        return value if c in df.columns else F.lit(0)

    lat_low, lat_high, lon_low, lon_high = fixed.COUNTRY_BOX
    if dataset == "listings":
        price = parse_money("price")
        spatial = "Flag as invalid, exclude from spatial analysis"
        return [
            Rule("price > 0", F.count_if(price <= 0), "Set to NaN, exclude from price analysis"),
            Rule("price parseable", F.count_if(price.isNull()), "Strip $ and , symbols, cast to float"),
            Rule("latitude in [50.7, 53.6]", when_present("latitude", outside("latitude", lat_low, lat_high)), spatial),
            Rule("longitude in [3.3, 7.3]", when_present("longitude", outside("longitude", lon_low, lon_high)), spatial),
            Rule("availability_365 in [0, 365]",
                 when_present("availability_365", outside("availability_365", 0, 365)), "Cap at 365 or set to NaN"),
        ]
    date_rule = Rule("date is parseable", when_present("date", F.count_if(parse_date("date").isNull())),
                     "Drop rows with unparseable dates")
    if dataset == "calendar":
        known = F.coalesce(F.col("available").isin("t", "f"), F.lit(False))
        return [Rule("available in {t, f}", when_present("available", F.count_if(~known)),
                     "Map to bool, set others to NaN"), date_rule]
    if dataset == "reviews":
        return [date_rule, Rule("listing_id not null", when_present("listing_id", F.count_if(F.col("listing_id").isNull())),
                                "Drop orphan reviews")]
    return []


def rule_entries(dataset: str, rules: Sequence[Rule], measured: Sequence[Column]) -> list[Column]:
    """One struct per rule from its measured value: data set, rule, measured value, issue flag, action."""
    entries = []
    for r, v in zip(rules, measured):
        issue = v > r.limit if r.floor is None else v < r.floor
        entries.append(F.struct(F.lit(dataset).alias("dataset"), F.lit(r.name).alias("rule"), v.alias("measured"),
                                F.coalesce(issue, F.lit(False)).alias("is_issue"), F.lit(r.action).alias("action")))
    return entries


def measure_rules(df: DataFrame, dataset: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules in one pass; one row per rule: data set, rule, measured value, issue flag, action."""
    if not rules:
        return df.sparkSession.createDataFrame(
            [], "dataset string, rule string, measured double, is_issue boolean, action string")
    wide = df.agg(*[r.value.cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    return wide.select(F.inline(F.array(*rule_entries(dataset, rules, [F.col(f"r{i}") for i in range(len(rules))]))))


def domain_violations(df: DataFrame, dataset: str) -> DataFrame:
    measured = measure_rules(df, dataset, domain_rules(df, dataset))
    return measured.select("dataset", "rule", F.col("measured").cast("long").alias("violations"), "action")


CHECKS = "dataset string, rule string, measured double, is_issue boolean, action string, passed boolean"


def failed_check(spark: SparkSession, dataset: str, rule: str, measured: float, action: str = "") -> DataFrame:
    return spark.createDataFrame([(dataset, rule, measured, True, action, False)], CHECKS)


def validate_dataset(df: DataFrame, dataset: str) -> DataFrame:
    """One row per check. A data set without rows or required columns fails without running its rules."""
    missing = missing_columns(df, dataset)
    if missing:
        return failed_check(df.sparkSession, dataset, "required columns", float(len(missing)), ", ".join(missing))
    if df.isEmpty():
        return failed_check(df.sparkSession, dataset, "has rows", 0.0)
    return measure_rules(df, dataset, validation_rules(df, dataset)).withColumn("passed", F.lit(True))


def land_checked(df: DataFrame, dataset: str, path: str) -> tuple[DataFrame, int, DataFrame]:
    """Write a data set as Parquet and check it while it is written: the stored frame, its rows, the checks.

    Rows and all rules that are sums over rows are observed in the write itself, so the source is read once. A rule over
    distinct values reads the one column it needs from the stored frame. The checks are those of `validate_dataset`.
    """
    spark, missing = df.sparkSession, missing_columns(df, dataset)
    rules = [] if missing else validation_rules(df, dataset)
    summed = {i: r.value.cast("double").alias(f"r{i}") for i, r in enumerate(rules) if r.distinct_of is None}
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *summed.values()).write.mode("overwrite").parquet(path)
    found, stored = seen.get, spark.read.parquet(path)
    rows = int(found.get("rows") or 0)
    if missing:
        return stored, rows, failed_check(spark, dataset, "required columns", float(len(missing)), ", ".join(missing))
    if not rows:
        return stored, rows, failed_check(spark, dataset, "has rows", 0.0)
    if not rules:
        return stored, rows, spark.createDataFrame([], CHECKS)
    wide = stored.agg(F.lit(None).alias("_none"), *[r.value.cast("double").alias(f"r{i}") for i, r in enumerate(rules) if r.distinct_of])
    measured = [F.col(f"r{i}") if r.distinct_of else F.lit(found[f"r{i}"]).cast("double") for i, r in enumerate(rules)]
    checks = wide if len(summed) < len(rules) else spark.range(1)
    return stored, rows, checks.select(F.inline(F.array(*rule_entries(dataset, rules, measured)))).withColumn("passed", F.lit(True))


def validate_all(frames: dict[str, DataFrame]) -> DataFrame:
    """Checks of all data sets. Issues warn; only missing rows or columns fail a data set."""
    return reduce(DataFrame.unionByName, [validate_dataset(df, name) for name, df in frames.items()])


def price_cleaning_audit(df: DataFrame, raw: str, cleaned: Column) -> DataFrame:
    """Valid, missing and newly missing prices around the cleaning of one column."""
    missing = F.count_if(cleaned.isNull())
    return df.agg(
        F.count(cleaned).alias("valid_prices"), missing.alias("missing_prices"),
        (missing - F.count_if(F.col(raw).isNull())).alias("new_nulls"),
    )
