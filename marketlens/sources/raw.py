"""Raw CSV and Parquet sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.scalar import blank_to_null

# File of each raw data set; free text may span lines only where stated.
RAW_FILES = {
    "listings": ("listings.csv.gz", True),
    "calendar": ("calendar.csv.gz", False),
    "reviews": ("reviews.csv.gz", True),
    "neighbourhoods": ("neighbourhoods.csv", False),
}


def read_raw(
    spark: SparkSession, folder: str, name: str, *, path: str | None = None,
    partitions: int | None = None, blank_as_null: bool = True,
) -> DataFrame:
    """One raw data set with every column as text, so that nothing is lost before cleaning.

    A gzip file is read by one task each, hence the rebalance right after the scan (partitions
    sized at run time, or a fixed number). With `blank_as_null=False` blanks stay empty strings.
    """
    file, multi_line = RAW_FILES[name]
    df = spark.read.csv(
        path or f"{folder.rstrip('/')}/{file}", header=True, inferSchema=False, multiLine=multi_line,
        quote='"', escape='"', emptyValue="",
    )
    keep = blank_to_null if blank_as_null else (lambda c: F.coalesce(F.col(c), F.lit("")))
    df = df.select([keep(f"`{c}`").alias(c) for c in df.columns])
    if file.endswith(".gz"):
        df = df.repartition(partitions) if partitions else df.hint("rebalance")
    return df


def load_all(spark: SparkSession, folder: str, **options) -> dict[str, DataFrame]:
    """All four raw data sets by name, lazily."""
    return {name: read_raw(spark, folder, name, **options) for name in RAW_FILES}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stage stored as Parquet."""
    return spark.read.parquet(path)
