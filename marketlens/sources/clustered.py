"""Tables clustered by a key: grouping and joining them by that key reads buckets and moves no rows.

Every bucket is one sorted file, dealt by the hash of the key. Tables of the same number of buckets and the same type of
key meet bucket by bucket, so that calendar summaries, their joins to the listings and the listings fact need no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sizing import scanned_bytes

#: Stored bytes of a bucket of the largest table, and buckets at least and at most. A task sorts a bucket's rows in memory,
#: where they take some twenty times their stored bytes.
BUCKET_BYTES, FEWEST, MOST = 8 * 1024 * 1024, 8, 1 << 16
#: A bucket that holds SKEW times an even share of the rows, and more rows than TASK_ROWS, is too much for one task.
SKEW, TASK_ROWS = 4.0, 5_000_000


def bucket_count(frames: list[DataFrame], bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for tables that are to meet: a power of two, by the bytes the largest of them reads."""
    most = max(scanned_bytes(df) for df in frames)
    return min(MOST, max(FEWEST, 1 << math.ceil(math.log2(max(1.0, most / bucket_bytes)))))


def fullest_bucket(df: DataFrame, key: str, buckets: int) -> tuple[int, int]:
    """Rows of the fullest bucket and of all; buckets are dealt as Spark deals them."""
    bucket = F.pmod(F.hash(key), F.lit(buckets))
    rows = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("most"), F.sum("n").alias("rows")).first()
    return rows["most"] or 0, rows["rows"] or 0


def save_clustered(df: DataFrame, key: str, name: str, path: str, buckets: int, skew: float = SKEW, task_rows: int = TASK_ROWS) -> DataFrame:
    """Replace the table `name`, stored at `path`, and give it back, clustered by `key` where its buckets are even.

    A bucket is written by one task and read by one. Where a key, or the rows without one, fill a bucket far beyond the
    others, the table is stored without buckets: grouping then combines rows ahead of its shuffle, and adaptive execution
    splits what a join finds too large. The results are the same. `df` is read twice, so pass a stored one.
    """
    most, rows = fullest_bucket(df, key, buckets)
    even = most <= max(task_rows, skew * rows / buckets)
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key) if even else df.write
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def save_clustered_tables(tables: Mapping[str, tuple[DataFrame, str]], folder: str, prefix: str = "", buckets: int | None = None) -> dict[str, DataFrame]:
    """Tables by name, each given with its key, stored below `folder` in the same number of buckets."""
    buckets = buckets or bucket_count([df for df, _ in tables.values()])
    return {name: save_clustered(df, key, f"{prefix}{name}", f"{folder.rstrip('/')}/{prefix}{name}", buckets)
            for name, (df, key) in tables.items()}


def forget_tables(spark: SparkSession, names: list[str]) -> None:
    """Take tables out of the catalog; their files stay."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
