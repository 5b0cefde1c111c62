"""Exact, linearly interpolated quantiles per group, and aggregates that include them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.operators.slices import (
    cut_points, same_keys, shifted_totals, slice_count, value_counts, with_slice,
)

_ALL = "_all_rows"


def sliced_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], slices: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with the exact quantile of `value` for every name in `probs`.

    `weight` names a column that says how many rows a row stands for. Works on distinct values with counts, cut into value slices. Only the slices that hold a wanted
    position are sorted. A group of any size is spread over all slices.
    """
    by = list(by)
    points = cut_points(df, value, slices or slice_count(df))
    sliced = with_slice(value_counts(df, by, value, weight), value, points)
    totals = shifted_totals(sliced, by, {"_n": "_n"})

    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in probs.items()])
    position = F.col("_q.p") * (F.col("_n_all") - 1)
    targets = (
        totals.withColumn("_q", F.explode(wanted))
        .select("*", position.alias("_pos"), F.explode(F.array(F.floor(position), F.ceil(position))).alias("_rank"))
        .where((F.col("_n_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_n_below") + F.col("_n_in")))
    )
    inside = Window.partitionBy(*by, "_slice").orderBy(value)
    keys = [*by, "_slice"]
    needed = targets.select(*keys).distinct()
    running = (
        sliced.alias("s").join(needed.alias("t"), same_keys("s", "t", keys), "left_semi")
        .withColumn("_upto", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    )
    offset = F.col("_rank") - F.col("_n_below")
    picked = (
        running.alias("s").join(targets.alias("t"), same_keys("s", "t", keys))
        .where((F.col("s._upto") - F.col("s._n") <= offset) & (offset < F.col("s._upto")))
        .select(*[F.col(f"s.`{k}`").alias(k) for k in by], F.col("t._q.name").alias("_name"),
                F.col("t._pos").alias("_pos"), F.col("t._rank").alias("_rank"),
                F.col(f"s.`{value}`").cast("double").alias("_v"))
    )
    weight = F.col("_pos") - F.floor("_pos")
    outputs = []
    for name in probs:
        mine = F.col("_name") == name
        low = F.max(F.when(mine & (F.col("_rank") == F.floor("_pos")), F.col("_v")))
        high = F.max(F.when(mine & (F.col("_rank") == F.ceil("_pos")), F.col("_v")))
        share = F.max(F.when(mine, weight))
        outputs.append(F.when(share > 0, (1 - share) * low + share * high).otherwise(low).alias(name))
    return picked.groupBy(*by).agg(*outputs)


def grouped(
    df: DataFrame,
    by: Sequence[str],
    aggregates: Sequence[Column] = (),
    quantiles: Mapping[str, tuple[Column | str, float]] | None = None,
    slices: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """`groupBy(by).agg(aggregates)` plus exact quantiles `{name: (expression, probability)}`.

    With one slice, the choice while the input fits one task, this is one hash aggregation with the
    built-in exact percentile, whose per-group value map is then bounded too. With more slices the
    quantiles come from `sliced_quantiles` and are joined to the other aggregates on the group keys.
    """
    by, quantiles = list(by), dict(quantiles or {})
    if slices is None:
        slices = slice_count(df) if quantiles else 1
    # Quantiles of one expression share one value map, or one ranking.
    shared: dict[str, tuple[Column, dict[str, float]]] = {}
    for name, (c, p) in quantiles.items():
        c = F.col(c) if isinstance(c, str) else c
        c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))  # NaN is no value in either plan
        shared.setdefault(c._jc.toString(), (c, {}))[1][name] = float(p)

    if slices <= 1:
        counted = F.col(weight) if weight else 1
        maps = [F.percentile(c, list(probs.values()), counted).alias(f"_q{i}") for i, (c, probs) in enumerate(shared.values())]
        out = df.groupBy(*by).agg(*aggregates, *maps) if by else df.agg(*aggregates, *maps)
        named = {n: F.col(f"_q{i}")[j] for i, (_, probs) in enumerate(shared.values()) for j, n in enumerate(probs)}
        return out.withColumns(named).drop(*[f"_q{i}" for i in range(len(maps))]) if named else out

    keys = by or [_ALL]
    base = df if by else df.withColumn(_ALL, F.lit(1))
    if by:
        out = base.groupBy(*keys).agg(*aggregates) if aggregates else base.select(*keys).distinct()
    else:  # one row, also for an empty frame
        out = df.agg(*aggregates).withColumn(_ALL, F.lit(1)) if aggregates else df.sparkSession.range(1).select(F.lit(1).alias(_ALL))
    for expression, names in shared.values():
        kept = base.select(*keys, expression.cast("double").alias("_value"), *([weight] if weight else []))
        part = sliced_quantiles(kept, keys, "_value", names, slices, weight)
        out = (
            out.alias("l").join(part.alias("r"), same_keys("l", "r", keys), "left")
            .select("l.*", *[F.col(f"r.`{n}`") for n in names])
        )
    return out if by else out.drop(_ALL)


def median(c: Column | str) -> tuple[Column | str, float]:
    return c, 0.5


def scalar_quantile(df: DataFrame, value: Column | str, p: float) -> Column:
    """An exact quantile of the whole frame as a scalar subquery, for use inside an expression."""
    return grouped(df, [], quantiles={"q": (value, p)}).scalar()


def scalar_quantiles(df: DataFrame, quantiles: Mapping[str, tuple[Column | str, float]]) -> Column:
    """Several exact quantiles as one scalar subquery with a field per name: one pass for all."""
    return grouped(df, [], quantiles=quantiles).select(F.struct(*quantiles)).scalar()
