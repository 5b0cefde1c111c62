"""Order-preserving slices: running totals over a sorted column without a single-task sort.

A column is cut into value ranges at a bounded list of literal cut points. Cut points only balance
the work; any list gives the same results. Running totals are then taken inside each slice and
shifted by the totals of the lower slices, so that no task ever sees a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.sizing import fits_one_task

MAX_SLICES = 4096
#: Distinct values that one task may hold as a map, about a hundred bytes each.
TASK_VALUES = 1_000_000


def slice_count(df: DataFrame, small: bool = True) -> int:
    """One slice while the input is small and fits one task, else a few per shuffle partition."""
    if small and fits_one_task(df):
        return 1
    return min(MAX_SLICES, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def value_slices(counted: DataFrame) -> int:
    """slice_count() for a stored frame of value counts, whose rows, unlike its compressed bytes, tell a map's size."""
    return slice_count(counted, counted.count() <= TASK_VALUES)


def cut_points(df: DataFrame, value: str, slices: int) -> list[float]:
    """At most `slices - 1` cut points, from a map-side quantile sketch (one scan, no data shuffle)."""
    if slices <= 1:
        return []
    probs = [i / slices for i in range(1, slices)]
    found = df.agg(F.percentile_approx(F.col(value).cast("double"), probs, 20000).alias("p")).first()["p"]
    return sorted(set(found or []))


def with_slice(df: DataFrame, value: str, points: Sequence[float], out: str = "_slice") -> DataFrame:
    """Add the slice number of a non-null value (binary search over literal cut points)."""
    if not points:
        return df.withColumn(out, F.lit(0.0))
    splits = [-float("inf"), *points, float("inf")]
    keyed = df.withColumn("_slice_in", F.col(value).cast("double"))
    return Bucketizer(splits=splits, inputCol="_slice_in", outputCol=out).transform(keyed).drop("_slice_in")


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of all keys between two aliased frames."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return condition


def value_counts(df: DataFrame, by: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Occurrences of each distinct non-null value per group; repeats collapse before the shuffle.

    `weight` names a column that says how many rows a row stands for.
    """
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(total.alias("_n"))


def shifted_totals(sliced: DataFrame, by: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Per (group, slice): the total of each measure, the total of the lower slices, and of all slices.

    `measures` maps a result prefix to the summed column; a group has at most as many rows here as
    there are slices.
    """
    sums = [F.sum(column).alias(f"{name}_in") for name, column in measures.items()]
    group = Window.partitionBy(*by)
    lower = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    out = sliced.groupBy(*by, "_slice").agg(*sums)
    added = {}
    for name in measures:
        added[f"{name}_below"] = F.coalesce(F.sum(f"{name}_in").over(lower), F.lit(0))
        added[f"{name}_all"] = F.sum(f"{name}_in").over(group)
    return out.withColumns(added)
