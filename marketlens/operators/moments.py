"""Sums and products of many columns under missing values, one matrix product per batch."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.sizing import let_workers_import

PAIR = "i int, j int, n long, sx double, sy double, sxx double, syy double, sxy double"
#: Rows whose means shift the columns, so that sums of squares keep their digits. Any shift gives the same results.
SHIFT_ROWS = 1000


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For columns i <= j: rows that have both, and their shifted sums, squares and products, added up over all tasks.

    A task keeps six k x k matrices and returns one row per pair, whatever its number of rows; null and NaN count as missing.
    """
    let_workers_import(df.sparkSession)
    names, k = list(columns), len(columns)
    numbers = df.select([F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(names)])
    # One row of k means.
    means = numbers.limit(SHIFT_ROWS).agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(k)]).first()
    shift = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, k, k))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            known = ~np.isnan(x)
            x, m = np.where(known, x - shift, 0.0), known.astype(float)
            square = x * x
            sums += [m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x]
        i, j = np.triu_indices(k)
        n, *rest = sums[:, i, j]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(n.astype(np.int64)), *map(pa.array, rest)],
            names=[c.split()[0] for c in PAIR.split(", ")])

    parts = numbers.mapInArrow(add, PAIR)
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])


def pair_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_a, column_b, corr) for every ordered pair, over the rows that have both; null without variation."""
    n, labels = F.col("n"), F.array(*[F.lit(c) for c in columns])
    xx, yy = F.col("sxx") - F.col("sx") * F.col("sx") / n, F.col("syy") - F.col("sy") * F.col("sy") / n
    xy = F.col("sxy") - F.col("sx") * F.col("sy") / n
    # What is left of a constant column is rounding of its squares.
    varied = (xx > 1e-13 * F.col("sxx")) & (yy > 1e-13 * F.col("syy"))
    corr = F.when(varied, F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(xy / F.sqrt(xx * yy)))
    found = pair_sums(df, columns).where(n > 0).select("i", "j", corr.alias("corr"))
    both = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j"))))
    return found.select(F.explode(both).alias("p"), "corr").select(
        F.element_at(labels, F.col("p.i") + 1).alias("column_a"), F.element_at(labels, F.col("p.j") + 1).alias("column_b"), "corr")
