"""The batch run: load, validate, profile, clean, enrich, publish, with a ledger row per stage."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from marketlens.functions.fixed_values import CITY_BOX
from marketlens.operators import cleaning, features, profile, quality, star
from marketlens.sources import raw, sinks


def publish(
    spark: SparkSession, master: DataFrame, calendar: DataFrame | None, folder: str, mode: str = "keyed",
    run_id: str | None = None,
) -> dict[str, DataFrame]:
    """Write the star schema into a folder of this run, make it the current one, and give back the stored tables.

    They are registered as views of the same names. Readers of `sinks.current_tables` see whole runs only.
    """
    run_id = run_id or f"{datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"
    built = star.build_star(master, calendar, mode)
    stored = sinks.publish_tables(spark, built, folder, run_id, {"fact_calendar": ["year", "month"]})
    for name, df in stored.items():
        sinks.register_table(df, name, view=True)
    return stored


def run_pipeline(
    spark: SparkSession, raw_folder: str, out_folder: str, as_of: date, city: str, box=CITY_BOX,
    approximate_profile: bool = False,
) -> dict[str, DataFrame]:
    """Run all stages; every stage reads what the previous one stored, so a restart loses one stage at most.

    Returns the star tables. A failing stage leaves a `FAILED` row in the ledger before the error surfaces.
    """
    out, ledger = out_folder.rstrip("/"), f"{out_folder.rstrip('/')}/pipeline_metadata"

    def log(dataset: str, stage: str, rows: int, notes: str = "") -> None:
        sinks.append_run_metadata(spark, ledger, dataset, stage, rows, notes)

    try:
        # Gzip exports are not splittable: land them once as Parquet, then everything runs in parallel. Rows are counted
        # and checked while they are written.
        landed, checks = {}, []
        for name, df in raw.load_all(spark, raw_folder).items():
            landed[name], rows, found = quality.land_checked(df, name, f"{out}/raw/{name}.parquet")
            checks.append(found)
            log(name, "loaded", rows)

        checks = reduce(DataFrame.unionByName, checks)
        sinks.save_csv(checks, f"{out}/reports/validation.csv", single_file=True)
        log("all", "validated", len(landed))

        sinks.save_report(profile.profile_all(landed, approximate_profile), f"{out}/reports")
        log("all", "profiled", len(landed))

        sinks.save_cleaned(cleaning.clean_all(landed, as_of, city, box), f"{out}/processed")
        clean = {name: raw.read_table(spark, f"{out}/processed/{name}_clean.parquet") for name in landed}
        log("all", "cleaned", len(clean))

        sinks.save_master(features.build_master(clean, as_of), f"{out}/processed")
        master = raw.read_table(spark, f"{out}/processed/master_listings.parquet")
        log("master_listings", "enriched", master.count())

        tables = publish(spark, master, clean["calendar"], f"{out}/star")
        for row in star.row_counts(tables).collect():
            log(row["table_name"], "published", row["row_count"])
        return tables
    except Exception as error:
        log("pipeline", "FAILED", 0, str(error))
        raise
