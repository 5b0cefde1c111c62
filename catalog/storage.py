"""Sources and sinks, written to and read back from the folder that all executors share."""

from __future__ import annotations

import functools
import uuid
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import core, quality, roles
from catalog.oracle import oracle
from catalog.rounding import near
from marketlens.operators import attribution, cleaning, features, ml, profile, sketches, star, summaries
from marketlens.operators.quality import land_checked, validate_all
from marketlens.plans import market_queries as mq
from marketlens.plans.pipeline import run_pipeline
from marketlens.sizing import cut_lineage, shared_folder
from marketlens.sources import clustered, raw, sinks

QUERIES = {}
L = roles.listings


def scratch(spark):
    return f"{shared_folder(spark)}/catalog-{uuid.uuid4().hex}"


def write_raw(df, path):
    """A gzip CSV export the way marketplaces publish it: quotes doubled, blanks empty."""
    df.write.csv(path, header=True, quote='"', escape='"', emptyValue="", compression="gzip",
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def raw_from_files(s, d, name, df, **options):
    return raw.read_raw(s, "", name, path=write_raw(df, f"{scratch(s)}/{name}"), **options)


QUERIES["read_raw_listings"] = (
    lambda s, d: cleaning.clean_listings(raw_from_files(s, d, "listings", quality.raw_listings(s, d)), roles.AS_OF, "Sample City"),
    quality.o("SELECT * FROM cleaned"))
QUERIES["read_raw_calendar"] = (
    lambda s, d: cleaning.clean_calendar(raw_from_files(s, d, "calendar", quality.raw_calendar(s, d))),
    quality.QUERIES["clean_calendar"][1])
QUERIES["read_raw_reviews"] = (
    lambda s, d: raw_from_files(s, d, "reviews", roles.table(s, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("comments"), F.col("lang").alias("reviewer_name")))
    .select("id", "comments", "reviewer_name"),
    """SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN trim(text) <> '' THEN text END AS comments, lang AS reviewer_name FROM documents""")
QUERIES["read_raw_neighbourhoods"] = (
    lambda s, d: cleaning.clean_neighbourhoods(raw_from_files(s, d, "neighbourhoods", quality.raw_all(s, d)["neighbourhoods"])),
    quality.QUERIES["clean_neighbourhoods"][1])
QUERIES["read_raw_keeps_blanks"] = (
    lambda s, d: profile.blank_strings(
        raw_from_files(s, d, "listings", quality.raw_listings(s, d), blank_as_null=False), ["price", "longitude"]),
    quality.o("""SELECT 'price' AS "column", COUNT(*) FILTER (WHERE price = '') AS blank_count FROM raw_listings
        UNION ALL SELECT 'longitude', COUNT(*) FILTER (WHERE longitude IS NULL) FROM raw_listings"""))


def saved_calendar(s, d):
    folder = scratch(s)
    sinks.save_cleaned({"calendar": roles.calendar(s, d)}, folder)
    return raw.read_table(s, f"{folder}/calendar_clean.parquet")


QUERIES["save_cleaned_calendar"] = (
    lambda s, d: saved_calendar(s, d).groupBy("listing_id", "year", "month").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("available").alias("free"), F.count("price").alias("priced"),
        F.min("date").alias("first_day"), F.sum("minimum_nights").alias("nights")),
    oracle("""SELECT listing_id, year, month, COUNT(*) AS days, COUNT(*) FILTER (WHERE available) AS free, COUNT(price) AS priced,
              MIN(date) AS first_day, SUM(minimum_nights) AS nights FROM calendar GROUP BY ALL"""))


def saved_cleaned(s, d, name):
    folder = scratch(s)
    sinks.save_cleaned({name: roles.clean(s, d)[name]}, folder)
    return raw.read_table(s, f"{folder}/{name}_clean.parquet")


QUERIES["save_cleaned_listings"] = (lambda s, d: saved_cleaned(s, d, "listings"), oracle("SELECT * FROM listings"))
QUERIES["save_cleaned_reviews"] = (lambda s, d: saved_cleaned(s, d, "reviews"), oracle("SELECT * FROM reviews"))


def saved_master(s, d):
    folder = scratch(s)
    sinks.save_master(core.master(s, d), folder)
    return raw.read_table(s, f"{folder}/master_listings.parquet")


QUERIES["save_master"] = (saved_master, oracle("SELECT * FROM master"))


def saved_model_tables(s, d):
    folder = scratch(s)
    prepared = ml.prepare_model_table(L(s, d))
    sinks.save_model_tables(prepared, ml.build_feature_table(prepared), folder)
    ready = raw.read_table(s, f"{folder}/model_ready.parquet").agg(F.count(F.lit(1)).alias("n")).scalar()
    return raw.read_table(s, f"{folder}/ml_prepared.parquet").agg(F.count(F.lit(1)).alias("prepared")).select(
        "prepared", ready.alias("ready"))


QUERIES["save_model_tables"] = (
    lambda s, d: saved_model_tables(s, d),
    oracle("""SELECT COUNT(price) AS prepared, COUNT(*) FILTER (WHERE price IS NOT NULL AND beds IS NOT NULL) AS ready FROM listings"""))


def saved_extract(s, d):
    path = f"{scratch(s)}/extract.csv"
    sinks.save_csv(L(s, d).where("price > 100").select("id", "price", "room_type"), path)
    return s.read.csv(path, header=True, schema="id bigint, price double, room_type string")


QUERIES["csv_extract"] = (saved_extract, oracle("SELECT id, price, room_type FROM listings WHERE price > 100"))


def saved_report(s, d):
    folder = scratch(s)
    # Stored once: each part of the report scans the listings anew, and would join them anew.
    report = profile.profile_all({"listings": cut_lineage(quality.raw_listings(s, d))})
    sinks.save_report(report, folder)
    return s.read.csv(f"{folder}/profile_violations.csv", header=True, inferSchema=False).select(
        "dataset", "rule", F.col("violations").cast("bigint").alias("violations"))


QUERIES["save_report"] = (
    saved_report, quality.o("""SELECT 'listings' AS dataset, 'price > 0' AS rule, COUNT(*) FILTER (WHERE amount <= 0) AS violations FROM typed_price
      UNION ALL SELECT 'listings', 'price parseable', COUNT(*) FILTER (WHERE amount IS NULL) FROM typed_price
      UNION ALL SELECT 'listings', 'latitude in [50.7, 53.6]', COUNT(*) FILTER (WHERE latitude NOT BETWEEN 50.7 AND 53.6) FROM raw_listings
      UNION ALL SELECT 'listings', 'longitude in [3.3, 7.3]', COUNT(*) FILTER (WHERE longitude IS NULL) FROM raw_listings
      UNION ALL SELECT 'listings', 'availability_365 in [0, 365]', COUNT(*) FILTER (WHERE availability_365 > 365) FROM raw_listings"""))


def saved_valuations(s, d):
    from catalog import models

    path = f"{scratch(s)}/valuations.json"
    document = attribution.valuation_report(models.valued(s, d), ["accommodates", "bedrooms"])
    parsed = document.select("id", F.from_json(
        "report", "tier string, district string, inputs struct<accommodates: double>, suggested_range string").alias("r")).select("id", "r.*")
    sinks.save_json(parsed, path)
    return s.read.schema("id bigint, tier string, district string, inputs struct<accommodates: double>, suggested_range string").json(
        path).select("id", "tier", "district", F.col("inputs.accommodates").alias("accommodates"), "suggested_range")


def valuations_sql():
    from catalog.models import VALUED

    return oracle("""SELECT id, CASE WHEN predicted_price <= p35 THEN 'Budget Option' WHEN predicted_price >= p85 THEN 'Luxury Option'
        ELSE 'Mid-Range Option' END AS tier, neighbourhood_cleansed AS district, accommodates,
        '€' || CAST(trunc(predicted_price * 0.95) AS BIGINT) || ' - €' || CAST(trunc(predicted_price * 1.05) AS BIGINT) AS suggested_range
        FROM guesses""", VALUED)


QUERIES["valuation_json"] = (saved_valuations, valuations_sql())


def ledger(s, d):
    path, at = f"{scratch(s)}/ledger", datetime(2025, 1, 1, 12, 0, 0)
    sinks.append_run_metadata(s, path, "listings", "loaded", L(s, d).count(), "first", at)
    sinks.append_run_metadata(s, path, "calendar", "loaded", roles.calendar(s, d).count(), "second", at)
    return raw.read_table(s, path).select("run_id", "dataset_name", "stage", "row_count", "notes")


QUERIES["run_ledger"] = (ledger, """
SELECT '20250101_120000' AS run_id, 'listings' AS dataset_name, 'loaded' AS stage, COUNT(*) AS row_count, 'first' AS notes FROM orders
UNION ALL SELECT '20250101_120000', 'calendar', 'loaded', COUNT(*), 'second' FROM lineitem""")


def registered(s, d):
    """A view that is replaced, then kept; the second registration does not win."""
    rooms = L(s, d).groupBy("room_type").agg(F.count(F.lit(1)).alias("n"))
    sinks.register_table(rooms, "catalog_rooms", view=True)
    sinks.register_table(rooms.limit(0), "catalog_rooms", replace=False, view=True)
    return sinks.run_sql(s, "SELECT room_type, n FROM catalog_rooms WHERE n > 0")


QUERIES["register_table"] = (registered, oracle("SELECT room_type, COUNT(*) AS n FROM listings GROUP BY room_type"))


def reloaded_model(s, d):
    path = f"{scratch(s)}/model"
    data = L(s, d).select("id", "price", "accommodates", "minimum_nights").dropna().withColumn(ml.TARGET, F.col("price"))
    ml.save_model(ml.fit(data, ml.ridge(1, alpha=0.0)), path)
    scored = ml.load_model(path).transform(data)
    return scored.agg(F.avg("prediction").alias("mean_prediction"))


# A least-squares fit with intercept reproduces the mean of its target.
QUERIES["model_save_load"] = near(reloaded_model, oracle("SELECT AVG(price) AS mean_prediction FROM listings"), "mean_prediction", digits=4)

# Loads that arrive one after the other

LOADED = {"l_orderkey": "long", "l_quantity": "double", "l_extendedprice": "double", "l_returnflag": "string"}
LOAD_QUARTERS = (1, 2, 3, 4)


def by_quarter(s, d):
    """Lineitem as four loads, each with a gap of nulls."""
    line = roles.table(s, d, "lineitem").select(F.quarter("l_shipdate").alias("q"), *LOADED)
    return line.withColumn("l_quantity", F.when(F.col("l_orderkey") % 9 != 0, F.col("l_quantity").cast("double")))


def merged_profile(s, d):
    """Sketches of four loads, stored load by load and the third one twice, merged and held against exact figures."""
    path, line = f"{scratch(s)}/sketches", by_quarter(s, d)
    for q in (*LOAD_QUARTERS, 3):
        sketches.save_sketches(sketches.sketch_columns(line.where(F.col("q") == q).drop("q"), "lineitem", f"q{q}"), path)
    found = sketches.profile_from_sketches(sketches.merge_sketches(sketches.read_sketches(s, path)))
    exact = profile.uniqueness(line.drop("q")).select("column", F.col("unique_values").alias("_exact"))
    within = F.abs(F.col("unique_values") - F.col("_exact")) <= 5 * sketches.DISTINCT_ERROR * F.col("_exact") + 0.5
    numbers = [c for c, t in line.drop("q").dtypes if t != "string"]
    middle = found.where(F.col("median").isNotNull()).select("column", F.col("median").alias("_median"))
    rank = line.select([F.col(c).cast("double").alias(c) for c in numbers]).unpivot([], numbers, "column", "value").join(
        F.broadcast(middle), "column").groupBy("column").agg(  # one row per column
        F.count("value").alias("_n"), F.count_if(F.col("value") < F.col("_median")).alias("_below"),
        F.count_if(F.col("value") <= F.col("_median")).alias("_upto"))
    reach = 5 * sketches.RANK_ERROR * F.col("_n") + 1
    centred = (F.col("_below") - reach <= F.col("_n") / 2) & (F.col("_n") / 2 <= F.col("_upto") + reach)
    return found.join(exact, "column").join(rank, "column", "left").select(
        "column", "row_count", "null_count", "min", "max", "mean", "std", within.alias("distinct_within_bound"),
        centred.alias("median_within_bound"))


def _load_sql(column: str) -> str:
    value = "CASE WHEN l_orderkey % 9 <> 0 THEN l_quantity END" if column == "l_quantity" else column
    numeric = LOADED[column] != "string"
    number = f"CAST({value} AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", COUNT(*) AS row_count, COUNT(*) - COUNT({value}) AS null_count, round(MIN({number}), 4) AS min,
        round(MAX({number}), 4) AS max, AVG({number}) AS mean, stddev_samp({number}) AS std, TRUE AS distinct_within_bound,
        {'TRUE' if numeric else 'CAST(NULL AS BOOLEAN)'} AS median_within_bound FROM lineitem"""


QUERIES["profile_merged_loads"] = near(merged_profile, " UNION ALL ".join(_load_sql(c) for c in LOADED), "mean", "std", digits=3)


def checked_landing(s, d):
    """Raw data sets checked while they are landed; the rows stored beside the rows observed."""
    parts = []
    for name, df in quality.raw_all(s, d).items():
        stored, rows, checks = land_checked(df, name, f"{scratch(s)}/{name}")
        told = stored.agg(F.lit(name).alias("dataset"), F.lit("rows observed").alias("rule"),
                          F.lit(float(rows)).alias("measured"), (F.count(F.lit(1)) != rows).alias("is_issue"))
        parts += [told, checks.select("dataset", "rule", "measured", "is_issue")]
    return functools.reduce(DataFrame.unionByName, parts)


def landing_sql():
    checks = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, rule, measured, is_issue FROM ({quality.QUERIES[f'validate_{name}'][1]})"
        for name in ("listings", "calendar", "reviews"))
    rows = " UNION ALL ".join(
        f"SELECT '{name}', 'rows observed', CAST(COUNT(*) AS DOUBLE), FALSE FROM {table}"
        for name, table in (("listings", "orders"), ("calendar", "lineitem"), ("reviews", "events"), ("neighbourhoods", "nation")))
    return f"{checks} UNION ALL {rows}"


QUERIES["landing_checks"] = (checked_landing, landing_sql())


def rerun_month(s, d):
    """The calendar stored by month, then the Februaries once more with every day booked."""
    folder, days = scratch(s), roles.calendar(s, d)
    sinks.save_cleaned({"calendar": days}, folder)
    again = days.where("month = 2").withColumn("available", F.lit(False))
    sinks.save_cleaned({"calendar": again}, folder, keep_other_months=True)
    return raw.read_table(s, f"{folder}/calendar_clean.parquet").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("available").alias("free"))


QUERIES["rerun_month"] = (rerun_month, oracle("""SELECT year, month, COUNT(*) AS days,
    COUNT(*) FILTER (WHERE available AND month <> 2) AS free FROM calendar GROUP BY year, month"""))


def published_runs(s, d):
    """What readers see after a whole run and one that fails at its second table."""
    folder, rooms = scratch(s), L(s, d).groupBy("room_type").agg(F.count(F.lit(1)).alias("n"))
    sinks.publish_tables(s, {"rooms": rooms, "listings": L(s, d)}, folder, "one")
    broken = L(s, d).select(F.raise_error(F.lit("stopped on purpose")).alias("id"))
    try:
        sinks.publish_tables(s, {"rooms": rooms.limit(0), "listings": broken}, folder, "two")
    except PySparkException:
        pass
    tables = sinks.current_tables(s, folder)
    return tables["rooms"].join(tables["listings"].groupBy("room_type").agg(F.count("price").alias("priced")), "room_type")


QUERIES["published_runs"] = (published_runs, oracle(
    "SELECT room_type, COUNT(*) AS n, COUNT(price) AS priced FROM listings GROUP BY room_type"))

# Tables clustered by listing


def clustered_tables(s, d):
    """Listings, reviews and calendar in buckets by listing; the catalog forgets them once they are read."""
    prefix, parts = f"catalog_{uuid.uuid4().hex}_", roles.clean(s, d)
    keys = {"listings": "id", "reviews": "listing_id", "calendar": "listing_id"}
    tables = clustered.save_clustered_tables({n: (parts[n], k) for n, k in keys.items()}, scratch(s), prefix)
    clustered.forget_tables(s, [f"{prefix}{n}" for n in tables])
    return tables


def clustered_featured(s, d):
    tables = clustered_tables(s, d)
    joined = summaries.join_all_summaries(tables["listings"], tables["reviews"], tables["calendar"])
    return features.engineer_features(joined, roles.AS_OF, medians_from=tables["listings"])


QUERIES["clustered_features"] = (clustered_featured, oracle("SELECT * FROM featured"))
QUERIES["clustered_q6"] = (
    lambda s, d: mq.q6_top_revenue_areas(star.fact_listings(clustered_featured(s, d))), core.QUERIES["q6_top_revenue_areas"][1])

# Failing data sets


def failing_checks(s, d):
    """Listings without two required columns and a calendar without rows fail; reviews are checked as ever."""
    frames = quality.raw_all(s, d)
    checks = validate_all({"listings": frames["listings"].drop("price", "latitude"), "calendar": frames["calendar"].where("listing_id IS NULL"),
                           "reviews": frames["reviews"]})
    return checks.withColumn("action", F.when(~F.col("passed"), F.col("action")))


QUERIES["validate_failing"] = (failing_checks, f"""
SELECT 'listings' AS dataset, 'required columns' AS rule, CAST(2 AS DOUBLE) AS measured, TRUE AS is_issue, 'price, latitude' AS action, FALSE AS passed
UNION ALL SELECT 'calendar', 'has rows', CAST(COUNT(l_orderkey) - COUNT(*) AS DOUBLE), TRUE, '', FALSE FROM lineitem
UNION ALL SELECT 'reviews', rule, measured, is_issue, NULL, TRUE FROM ({quality.QUERIES["validate_reviews"][1]})""")

# The batch run


def batch_run(s, d):
    """From raw exports to the star schema; its tables' rows, and what the ledger says of them."""
    source = scratch(s)
    for name, df in quality.raw_all(s, d).items():
        write_raw(df, f"{source}/{raw.RAW_FILES[name][0]}")
    tables = run_pipeline(s, source, f"{source}/out", roles.AS_OF, "Sample City")
    told = raw.read_table(s, f"{source}/out/pipeline_metadata").where("stage = 'published'").select(
        F.col("dataset_name").alias("table_name"), F.col("row_count").alias("ledger_rows"))
    return star.row_counts(tables).join(told, "table_name")


_RUN_ROWS = {
    "dim_host": "SELECT COUNT(DISTINCT host_id) FROM cleaned", "dim_neighbourhood": "SELECT COUNT(DISTINCT neighbourhood_cleansed) FROM cleaned",
    "dim_room_type": "SELECT COUNT(DISTINCT room_type) FROM cleaned", "fact_listings": "SELECT COUNT(*) FROM cleaned",
    "dim_date": "SELECT COUNT(DISTINCT date) FROM calendar WHERE listing_id % 1000 <> 3",
    "fact_calendar": "SELECT COUNT(*) FROM calendar WHERE listing_id % 1000 <> 3",
}
QUERIES["batch_run"] = (batch_run, quality.o(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, ({rows}) AS row_count, ({rows}) AS ledger_rows" for name, rows in _RUN_ROWS.items())))
