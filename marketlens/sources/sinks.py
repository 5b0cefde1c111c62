"""Sinks: Parquet stages, CSV extracts, JSON documents, tables and the run ledger."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from marketlens.functions.fixed_values import MODEL_FEATURES
from marketlens.sizing import cut_lineage

LEDGER_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("dataset_name", StringType()),
    StructField("stage", StringType()),
    StructField("row_count", LongType()),
    StructField("run_timestamp", TimestampType()),
    StructField("notes", StringType()),
])


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, keep_other_parts: bool = False) -> None:
    """Replace what is stored; with `keep_other_parts` only the partitions that `df` has rows for."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if keep_other_parts else "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_cleaned(frames: Mapping[str, DataFrame], folder: str, keep_other_months: bool = False) -> None:
    """One Parquet folder per cleaned data set; the calendar is laid out by year and month.

    With `keep_other_months` a rerun over some months rewrites those of the calendar and leaves the others as they are.
    """
    for name, df in frames.items():
        parts = ["year", "month"] if name == "calendar" and {"year", "month"} <= set(df.columns) else None
        # One file per month and task would be many small files: bring each month together first,
        # spread over `_spread` so that one busy month is still written by several tasks.
        if parts:
            spread = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
            keyed = F.pmod(F.xxhash64("listing_id"), F.lit(max(1, spread // 24)))
            df = df.repartition(*parts, keyed)
        save_parquet(df, f"{folder.rstrip('/')}/{name}_clean.parquet", parts, keep_other_months and parts is not None)


def save_master(master: DataFrame, folder: str) -> None:
    save_parquet(master, f"{folder.rstrip('/')}/master_listings.parquet")


def save_model_tables(prepared: DataFrame, ready: DataFrame, folder: str) -> None:
    save_parquet(prepared, f"{folder.rstrip('/')}/ml_prepared.parquet")
    save_parquet(ready, f"{folder.rstrip('/')}/model_ready.parquet")


def save_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV extract with a header; `single_file` only for result-sized frames."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").csv(path, header=True)


def save_report(report: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Profiling outputs as CSV; violations and outliers only when there are any."""
    files = {
        "column_profiles": "profile_columns", "completeness": "profile_completeness",
        "domain_violations": "profile_violations", "outliers": "profile_outliers",
    }
    saved = []
    for key, file in files.items():
        frame = report.get(key)
        if frame is None:
            continue
        if key in ("domain_violations", "outliers"):
            frame = cut_lineage(frame)  # a report's few rows, asked for once and written from there
            if frame.isEmpty():
                continue
        save_csv(frame, f"{folder.rstrip('/')}/{file}.csv", single_file=True)
        saved.append(f"{file}.csv")
    return saved


def save_json(df: DataFrame, path: str) -> None:
    """One JSON document per row."""
    df.write.mode("overwrite").json(path)


def save_feature_list(spark: SparkSession, path: str, features: list[str] = MODEL_FEATURES) -> None:
    """The ordered feature list as one JSON array."""
    names = spark.range(1).select(F.to_json(F.array(*[F.lit(f) for f in features])).alias("value"))
    names.write.mode("overwrite").text(path)


def register_table(df: DataFrame, name: str, replace: bool = True, view: bool = False) -> None:
    """Store as a table (`replace=False` keeps an existing one) or register as a temporary view."""
    if view:
        if replace or not df.sparkSession.catalog.tableExists(name):
            df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite" if replace else "ignore").saveAsTable(name)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def run_sql(spark: SparkSession, sql: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text over registered tables and, optionally, frames passed by name.

    The names of the frames hold for this statement only. They hide tables, but may not be those of the session's views.
    """
    views = views or {}
    for name, df in views.items():
        df.createTempView(name)
    try:
        return spark.sql(sql)
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


POINTER_SCHEMA = "run_id string, published_at timestamp, tables array<string>"


def publish_tables(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, run_id: str,
                   partition_by: Mapping[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """Write all tables into the run's own folder and then make it the current one by one pointer row.

    Nothing is renamed or replaced that readers may be at: a run that fails before its last table leaves them on the run
    before it, and repeating a run id writes its folder anew. The tables are written one after the other.
    """
    root = folder.rstrip("/")
    for name, df in tables.items():
        save_parquet(df, f"{root}/run={run_id}/{name}.parquet", (partition_by or {}).get(name))
    spark.createDataFrame([(run_id, datetime.now(), list(tables))], POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root}/current")
    return current_tables(spark, root)


def current_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the run that was published last."""
    root = folder.rstrip("/")
    pointer = spark.read.schema(POINTER_SCHEMA).parquet(f"{root}/current").orderBy(F.desc("published_at"), F.desc("run_id")).first()
    return {name: spark.read.parquet(f"{root}/run={pointer['run_id']}/{name}.parquet") for name in pointer["tables"]}


def append_run_metadata(
    spark: SparkSession, path: str, dataset: str, stage: str, row_count: int, notes: str = "",
    at: datetime | None = None,
) -> None:
    """Append one row to the run ledger."""
    at = at or datetime.now()
    row = (at.strftime("%Y%m%d_%H%M%S"), dataset, stage, int(row_count), at, notes)
    spark.createDataFrame([row], LEDGER_SCHEMA).write.mode("append").parquet(path)
