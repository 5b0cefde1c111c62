"""Column profiles from mergeable sketches: a new load is profiled by reading that load only.

Per load and column one row is stored: counts, extremes, moments, a HyperLogLog sketch of the distinct values and a KLL
sketch of the numbers. Rows of several loads merge into the profile of their union. Nothing is shuffled by value: a task
sends one row of bounded size per group of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.functions.scalar import round_half_even

#: Registers of the distinct sketch (2**12): a standard error of 1.6 %. Width of the quantile sketch: 1.4 % of the ranks.
DISTINCT_BITS, QUANTILE_WIDTH = 12, 200
DISTINCT_ERROR, RANK_ERROR = 0.016, 0.014
#: Columns per aggregate; each holds sketches, so fewer than for plain measures.
COLUMNS_PER_PASS = 20


def sketch_columns(df: DataFrame, dataset: str, load: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: what a profile needs, in a form that merges with other loads'."""
    types = dict(df.dtypes)
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    names = list(columns or df.columns)
    parts = []
    for start in range(0, len(names), COLUMNS_PER_PASS):
        structs = []
        for c in names[start:start + COLUMNS_PER_PASS]:
            text, is_number = F.col(f"`{c}`").cast("string"), types[c].startswith(numeric)
            value = F.col(f"`{c}`").cast("double") if is_number else F.lit(None).cast("double")
            structs.append(F.struct(
                F.lit(c).alias("column"), F.lit(df.columns.index(c)).alias("position"), F.lit(types[c]).alias("dtype"),
                F.count(F.lit(1)).alias("row_count"), F.count_if(text.isNull()).alias("null_count"),
                F.hll_sketch_agg(text, F.lit(DISTINCT_BITS)).alias("distinct"),
                F.min(text).alias("first_value"), F.max(text).alias("last_value"),
                F.count(value).alias("numbers"), F.min(value).alias("min"), F.max(value).alias("max"),
                F.avg(value).alias("mean"), (F.var_pop(value) * F.count(value)).alias("squares"),
                (F.kll_sketch_agg_double(value, F.lit(QUANTILE_WIDTH)) if is_number
                 else F.lit(None).cast("binary")).alias("quantiles"),
            ).alias(f"c{len(structs)}"))
        parts.append(df.agg(*structs).select(F.inline(F.array(*[f"c{i}" for i in range(len(structs))]))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(F.lit(dataset).alias("dataset"), F.lit(load).alias("load"), "*")


def save_sketches(sketches: DataFrame, path: str) -> None:
    """Store the rows of one or more loads; a load that is stored again replaces itself and no other."""
    writer = sketches.coalesce(1).write.mode("overwrite").partitionBy("dataset", "load")  # one row a column
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """All stored rows; names of loads stay text."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return rows.select("dataset", "load", *[c for c in rows.columns if c not in ("dataset", "load")])


SCHEMA = """column string, position int, dtype string, row_count long, null_count long, distinct binary, first_value string,
    last_value string, numbers long, min double, max double, mean double, squares double, quantiles binary,
    dataset string, load string"""


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per data set and column over all its loads, of the same columns but `load`.

    The rows are as many as loads times columns. Type and position are those of the smallest load name.
    """
    own = Window.partitionBy("dataset", "column")
    overall = F.try_divide(F.sum(F.col("mean") * F.col("numbers")).over(own), F.sum("numbers").over(own))
    apart = F.col("mean") - F.col("_mean")
    return sketches.withColumn("_mean", overall).groupBy("dataset", "column").agg(
        F.min_by("position", "load").alias("position"), F.min_by("dtype", "load").alias("dtype"),
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct").alias("distinct"), F.min("first_value").alias("first_value"),
        F.max("last_value").alias("last_value"), F.sum("numbers").alias("numbers"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.first("_mean").alias("mean"),
        F.sum(F.col("squares") + F.col("numbers") * apart * apart).alias("squares"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def profile_from_sketches(sketches: DataFrame) -> DataFrame:
    """The column profile of merged rows (`merge_sketches`).

    Counts, extremes, mean and deviation are exact; `unique_values` has a standard error of DISTINCT_ERROR, `p25`, `median`
    and `p75` are values whose rank is off by RANK_ERROR of the rows. `sample_values` are the smallest and the largest text.
    """
    at = lambda p: F.when(F.col("numbers") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(p)))
    deviation = F.when(F.col("numbers") > 1, F.sqrt(F.col("squares") / (F.col("numbers") - 1)))
    return sketches.select(
        "dataset", "column", "dtype", "row_count", "null_count",
        round_half_even(F.try_divide(F.col("null_count"), F.col("row_count")) * 100, 2).alias("null_pct"),
        F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0)).cast("long").alias("unique_values"),
        F.concat_ws(", ", F.array_distinct(F.array("first_value", "last_value"))).alias("sample_values"),
        *[round_half_even(c, 4).alias(n) for n, c in
          (("min", F.col("min")), ("max", F.col("max")), ("mean", F.col("mean")), ("std", deviation))],
        at(0.25).alias("p25"), at(0.5).alias("median"), at(0.75).alias("p75"),
    )
