"""Reports along several dimensions from one scan of the rows.

The rows are read once and counted by (dimensions, metric, value); repeats collapse before the shuffle and the counts are
stored. Grouping sets roll these counts up to every wanted slice, and means, extremes and exact medians of all slices come
from the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.quantiles import grouped, median
from marketlens.operators.slices import value_slices
from marketlens.sizing import cut_lineage


def value_cells(df: DataFrame, dims: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """dims, metric, value, n: rows of every value of every metric per combination of dimensions; NaN is no value."""
    numbers = [F.nanvl(F.col(m).cast("double"), F.lit(None).cast("double")).alias(m) for m in metrics]
    melted = df.select(*dims, *numbers).unpivot(list(dims), list(metrics), "metric", "value")
    return melted.groupBy(*dims, "metric", "value").agg(F.count(F.lit(1)).alias("n"))


def slice_name(dims: Sequence[str]) -> str:
    return ", ".join(dims) or "all"


def report_cube(
    df: DataFrame, dims: Sequence[str], metrics: Sequence[str], sets: Sequence[Sequence[str]] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """slice, dims, metric, listings, valued, mean, min, max, median.

    `sets` names the dimensions of each slice; without it there is one slice for each dimension and one for everything.
    A dimension that a slice leaves out is null there; a missing value of one that it holds is a group of its own, told
    apart by the name in `slice`. `listings` counts rows, `valued` those with a value. An empty frame gives no rows.
    """
    dims, metrics = list(dims), list(metrics)
    sets = [list(s) for s in (sets if sets is not None else [[d] for d in dims] + [[]])]
    cells = cut_lineage(value_cells(df, dims, metrics))
    # Stored, equal and ordered values take a fraction of the bytes that a map of them takes in a task.
    slices = slices or value_slices(cells)
    rolled = cells.groupingSets([[*s, "metric", "value"] for s in sets], *dims, "metric", "value").agg(
        F.sum("n").alias("n"), F.grouping_id().alias("_set"))
    width = len(dims) + 2
    numbers = {sum(1 << (width - 1 - i) for i, d in enumerate(dims) if d not in s): slice_name(s) for s in sets}
    names = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    known = F.col("value").isNotNull()
    out = grouped(
        rolled.withColumn("slice", names[F.col("_set").cast("int")]).drop("_set"), ["slice", *dims, "metric"],
        [F.sum("n").alias("listings"), F.sum(F.when(known, F.col("n")).otherwise(0)).alias("valued"),
         F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(F.when(known, F.col("n")))).alias("mean"),
         F.min("value").alias("min"), F.max("value").alias("max")],
        {"median": median("value")}, slices, weight="n")
    return out.select("slice", *dims, "metric", "listings", "valued", "mean", "min", "max", "median")


def cube_slice(cube: DataFrame, dims: Sequence[str], metric: str) -> DataFrame:
    """The single report of one slice and one metric."""
    return cube.where((F.col("slice") == slice_name(dims)) & (F.col("metric") == metric)).select(
        *dims, "listings", "valued", "mean", "min", "max", "median")
