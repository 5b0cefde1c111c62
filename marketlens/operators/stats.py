"""Effect sizes, rank tests, confidence intervals, regression and smoothing on whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.scalar import effect_label
from marketlens.functions.tails import chi2_upper_tail, normal_upper_tail, t_quantile_975
from marketlens.operators.moments import pair_correlations
from marketlens.operators.quantiles import grouped, scalar_quantile
from marketlens.operators.ranges import range_parts, range_ranks
from marketlens.operators.slices import cut_points, shifted_totals, slice_count, with_slice
from marketlens.sizing import broadcast_if_small, cut_lineage, join_small

COHEN_BOUNDS = (0.2, 0.5, 0.8)
ETA_BOUNDS = (0.01, 0.06, 0.14)


def two_groups(df: DataFrame, value: Column | str, first: Column, second: Column) -> DataFrame:
    """Rows (value, in_first) of two disjoint groups, without missing values."""
    v = F.col(value) if isinstance(value, str) else value
    marked = df.select(v.cast("double").alias("v"), F.when(first, F.lit(True)).when(second, F.lit(False)).alias("in_first"))
    return marked.where(F.col("v").isNotNull() & F.col("in_first").isNotNull())


def _moments(groups: DataFrame) -> DataFrame:
    parts = {"1": F.when(F.col("in_first"), F.col("v")), "2": F.when(~F.col("in_first"), F.col("v"))}
    return groups.agg(*[f(x).alias(f"{n}{g}") for g, x in parts.items() for n, f in
                        (("n", F.count), ("mean", F.avg), ("var", F.var_samp))])


def cohens_d(groups: DataFrame) -> DataFrame:
    """Mean difference in pooled standard deviations, with its label, in one pass."""
    n1, n2 = F.col("n1"), F.col("n2")
    pooled = F.sqrt(F.try_divide((n1 - 1) * F.col("var1") + (n2 - 1) * F.col("var2"), n1 + n2 - 2))
    d = F.try_divide(F.col("mean1") - F.col("mean2"), pooled)
    return _moments(groups).select("n1", "n2", "mean1", "mean2", d.alias("d")).withColumn(
        "effect", effect_label(F.abs("d"), COHEN_BOUNDS))


def group_comparison(groups: DataFrame, slices: int | None = None) -> DataFrame:
    """Size, mean and median of both groups and their differences."""
    first, second = F.when(F.col("in_first"), F.col("v")), F.when(~F.col("in_first"), F.col("v"))
    out = grouped(groups, [], [F.count(first).alias("n1"), F.count(second).alias("n2"), F.avg(first).alias("mean1"),
                               F.avg(second).alias("mean2")], {"median1": (first, 0.5), "median2": (second, 0.5)}, slices)
    return out.withColumns({"mean_difference": F.col("mean1") - F.col("mean2"),
                            "median_difference": F.col("median1") - F.col("median2")})


def mann_whitney_u(groups: DataFrame, slices: int | None = None) -> DataFrame:
    """U of the first group, tie term, and the one-sided p (first group larger), on all rows.

    Ranks need a global order. Values are counted first; beyond one task their counts are ranked by range partition.
    """
    counts = groups.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.count_if("in_first").alias("n1"))
    slices = slices or slice_count(groups)
    if slices <= 1:
        upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        ranked = counts.select("n", "n1", (upto - F.col("n") + (F.col("n") + 1) / 2).alias("rank"), F.col("n").alias("ties"))
    else:
        counts = cut_lineage(counts)
        ranked = range_ranks(counts, "v", weight="n", parts=max(slices, range_parts(counts)))
    n, ties = F.col("n").cast("double"), F.col("ties").cast("double")
    totals = ranked.agg(
        F.sum(F.col("n1") * F.col("rank")).alias("rank_sum"), F.sum(n * (ties * ties - 1)).alias("tie_term"),
        F.sum("n").cast("double").alias("n"), F.sum("n1").cast("double").alias("n1"),
    )
    n1, total = F.col("n1"), F.col("n")
    n2 = total - n1
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    variance = n1 * n2 / 12 * ((total + 1) - F.try_divide(F.col("tie_term"), total * (total - 1)))
    z = F.try_divide(u - n1 * n2 / 2 - 0.5, F.sqrt(variance))
    return totals.select(
        n1.cast("long").alias("n1"), n2.cast("long").alias("n2"), u.alias("u"), F.col("tie_term"), z.alias("z"),
    ).withColumn("p_value", normal_upper_tail("z"))


def kruskal_wallis(df: DataFrame, by: str, value: str, min_rows: int = 10, slices: int | None = None) -> DataFrame:
    """H with tie correction, its p, and eta squared over groups of at least `min_rows` rows."""
    known = df.select(F.col(by).alias("g"), F.col(value).cast("double").alias("v")).where(
        F.col("g").isNotNull() & F.col("v").isNotNull())
    slices = slices or slice_count(known)
    # Read three times below: count once and keep the counts.
    counts = cut_lineage(known.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")))
    large = counts.groupBy("g").agg(F.sum("n").alias("_rows")).where(F.col("_rows") >= min_rows).select("g")
    counts = join_small(counts, large, "g", "left_semi")
    if slices <= 1:
        upto = F.sum("n").over(Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
        values = counts.groupBy("v").agg(F.sum("n").alias("n"))
        ranks = values.select("v", (upto - F.col("n") + (F.col("n") + 1) / 2).alias("rank"), F.col("n").alias("ties"))
        ranked = counts.join(ranks, "v")
    else:
        ranked = range_ranks(counts, "v", weight="n", parts=max(slices, range_parts(counts)))
    n, ties = F.col("n").cast("double"), F.col("ties").cast("double")
    # A value of t rows adds t (t^2 - 1) to the tie term: t^2 - 1 for each of them.
    per_group = cut_lineage(ranked.groupBy("g").agg(
        F.sum("n").cast("double").alias("n"), F.sum(n * F.col("rank")).alias("r"), F.sum(n * (ties * ties - 1)).alias("t")))
    totals = per_group.agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s"), F.sum("t").alias("t"))
    total, k = F.col("n"), F.col("groups")
    tied = F.try_divide(F.col("t"), total * total * total - total)
    h = F.try_divide(12 / (total * (total + 1)) * F.col("s") - 3 * (total + 1), 1 - tied)
    return (
        totals.withColumn("h", h)
        .select(k.alias("groups"), total.cast("long").alias("n"), "h", F.try_divide(F.col("h") - k + 1, total - k).alias("eta_squared"))
        .withColumn("effect", effect_label("eta_squared", ETA_BOUNDS))
        .withColumn("p_value", chi2_upper_tail("h", (F.col("groups") - 1).cast("double")))
    )


def normality_check(df: DataFrame, value: str) -> DataFrame:
    """Jarque-Bera over all rows in one pass; p comes from the chi-squared tail with two degrees."""
    out = df.where(F.col(value).isNotNull()).agg(
        F.count(value).alias("n"), F.skewness(value).alias("skewness"), F.kurtosis(value).alias("excess_kurtosis"))
    jb = F.col("n") / 6 * (F.pow("skewness", F.lit(2)) + F.pow("excess_kurtosis", F.lit(2)) / 4)
    return out.withColumn("jarque_bera", jb).withColumn("p_value", F.exp(-F.col("jarque_bera") / 2))


def mean_ci95(df: DataFrame, by: str, value: str = "price", min_rows: int = 10) -> DataFrame:
    """Mean with a 95 % t interval per group of at least `min_rows` values."""
    out = df.where(F.col(value).isNotNull() & F.col(by).isNotNull()).groupBy(by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("std_error"),
    ).where(F.col("n") >= min_rows)
    half = t_quantile_975((F.col("n") - 1).cast("double")) * F.col("std_error")
    return out.withColumn("_half", half).select(
        by, "n", "mean", "std_error", (F.col("mean") - F.col("_half")).alias("ci_low"),
        (F.col("mean") + F.col("_half")).alias("ci_high")).orderBy("mean", by)


def weekend_lift(calendar: DataFrame, available: str = "available", weekend: str = "is_weekend") -> DataFrame:
    """Booked share at weekends and on weekdays; a missing availability counts as not booked."""
    booked = F.coalesce(~F.col(available), F.lit(False)).cast("double") * 100
    out = calendar.agg(F.avg(F.when(F.col(weekend), booked)).alias("weekend_pct"),
                       F.avg(F.when(~F.col(weekend), booked)).alias("weekday_pct"))
    return out.withColumn("lift", F.col("weekend_pct") - F.col("weekday_pct"))


def weekend_groups(calendar: DataFrame, available: str = "available", weekend: str = "is_weekend") -> DataFrame:
    """Booked (1) or not (0) per day, weekends first."""
    booked = F.coalesce(~F.col(available), F.lit(False)).cast("double")
    return two_groups(calendar, booked, F.col(weekend), ~F.col(weekend))


def hypothesis_summary(listings: DataFrame, calendar: DataFrame, area: str = "neighbourhood_cleansed",
                       slices: int | None = None) -> DataFrame:
    """One row per test: name, test, p, significance, effect size and label."""
    valid = listings.where("_is_valid")
    room, host = F.col("room_type"), F.col("host_is_superhost")
    pairs = {
        "H1": two_groups(valid, "price", room == "Entire home/apt", room == "Private room"),
        "H2": two_groups(listings, "review_scores_rating", host, ~host),
        "H5": weekend_groups(calendar),
    }
    rows = []
    for name, groups in pairs.items():
        effect = cohens_d(groups).select(F.struct("d", "effect")).scalar()
        rows.append(mann_whitney_u(groups, slices).select(
            F.lit(name).alias("hypothesis"), F.lit("Mann-Whitney U").alias("test"), "p_value",
            effect["d"].alias("effect_size"), effect["effect"].alias("effect")))
    rows.append(kruskal_wallis(valid, area, "price", slices=slices).select(
        F.lit("H4").alias("hypothesis"), F.lit("Kruskal-Wallis").alias("test"), "p_value",
        F.col("eta_squared").alias("effect_size"), "effect"))
    table = reduce(DataFrame.unionByName, rows)
    return table.withColumn("significant", F.col("p_value") < 0.05).orderBy("hypothesis")


def average_ranks(df: DataFrame, value: str, out: str, slices: int | None = None) -> DataFrame:
    """(value, rank) per distinct value; ties share the average of their places."""
    known = df.select(F.col(value).cast("double").alias(value))
    counts = known.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    sliced = with_slice(counts, value, cut_points(known, value, slices or slice_count(df)))
    inside = Window.partitionBy("_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    below = shifted_totals(sliced, [], {"n": "n"}).select("_slice", "n_below")
    ranked = sliced.withColumn("_upto", F.sum("n").over(inside)).join(F.broadcast(below), "_slice")
    rank = F.col("n_below") + F.col("_upto") - F.col("n") + (F.col("n") + 1) / 2
    return ranked.select(value, rank.alias(out))


#: Distinct values of a column up to which its ranks are a small table.
FEW_VALUES = 100_000


def _ranks_of_few(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Each of `columns`, which have few distinct values, replaced by its ranks under a new name. No row is moved.

    Rows are counted by (column, value) in one pass; the counts are ranked, and a table of ranks per column is broadcast.
    """
    names = list(columns)
    cells = F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).alias("_v")) for i, c in enumerate(names)]))
    counts = df.select(cells).groupBy("_i", "_v").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_i").orderBy("_v"))
    ranks = cut_lineage(counts.select("_i", "_v", (upto - (F.col("_n") - 1) / 2).alias("_r")))
    for i, c in enumerate(names):
        own = ranks.where(F.col("_i") == i).select(F.col("_v").alias(c), F.col("_r").alias(columns[c]))
        df = df.join(F.broadcast(own), c).drop(c)
    return df


def corr_spearman(df: DataFrame, columns: Sequence[str], slices: int | None = None) -> DataFrame:
    """Rank correlation of every pair over complete rows, as (column_a, column_b, rho).

    While the input fits one task each column's ranks are computed per distinct value and joined back on the value. Beyond
    it columns of few distinct values are ranked by their counts, without moving a row, and each other one by an ordered
    shuffle of the rows (`range_ranks`).
    """
    names = [c for c in columns if c in df.columns]
    slices = slices or slice_count(df)
    complete = df.select([F.col(c).cast("double").alias(c) for c in names]).dropna()
    if slices <= 1:
        ranked = complete = cut_lineage(complete)
        for i, c in enumerate(names):
            ranks = cut_lineage(average_ranks(complete, c, f"_rank{i}", slices))
            ranked = ranked.join(broadcast_if_small(ranks), c).drop(c)
    else:
        complete = cut_lineage(complete)
        found = complete.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
        few = {c: f"_rank{i}" for i, c in enumerate(names) if found[c] <= FEW_VALUES}
        ranked = _ranks_of_few(complete, few) if few else complete
        for i, c in enumerate(names):
            if c not in few:
                ranked = range_ranks(ranked, c, parts=range_parts(complete)).drop("ties", c).withColumnRenamed("rank", f"_rank{i}")
    found = pair_correlations(ranked, [f"_rank{i}" for i in range(len(names))])
    labels = F.create_map(*[x for i, c in enumerate(names) for x in (F.lit(f"_rank{i}"), F.lit(c))])
    return found.select(labels[F.col("column_a")].alias("column_a"), labels[F.col("column_b")].alias("column_b"), F.col("corr").alias("rho"))


def strongest_with(matrix: DataFrame, column: str = "price", k: int = 8) -> DataFrame:
    """The k columns most correlated with one column, by absolute value."""
    mine = matrix.where((F.col("column_a") == column) & (F.col("column_b") != column))
    sign = F.when(F.col("rho") > 0, F.lit("positive")).otherwise(F.lit("negative"))
    return mine.select(F.col("column_b").alias("column"), "rho", sign.alias("direction")).orderBy(
        F.abs("rho").desc(), "column").limit(k)


def regression_frame(df: DataFrame, columns: Sequence[str], price: str = "price") -> DataFrame:
    """Complete numeric rows with the log price and 0/1 indicators for room type and superhost."""
    out = df.withColumns({
        "is_entire_home": (F.col("room_type") == "Entire home/apt").cast("int"),
        "is_private_room": (F.col("room_type") == "Private room").cast("int"),
        "is_superhost": F.coalesce(F.col("host_is_superhost"), F.lit(False)).cast("int"),
    })
    names = [c for c in columns if c in out.columns]
    return out.select([F.col(c).cast("double").alias(c) for c in [*names, price]]).dropna().withColumn(
        "log_price", F.log1p(price))


def ols(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Coefficients, p-values and percentage effects of a least-squares fit, one row per column."""
    kept = cut_lineage(df.select(*columns, F.col(target).alias("_y")))
    data = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(kept).select("_x", "_y")
    model = LinearRegression(featuresCol="_x", labelCol="_y", solver="normal", regParam=0.0).fit(data)
    names, p = ["intercept", *columns], model.summary.pValues
    rows = [(n, float(b), float(q), float(np.expm1(b) * 100), float(model.summary.r2))
            for n, b, q in zip(names, [model.intercept, *model.coefficients], [p[-1], *p[:-1]])]
    return df.sparkSession.createDataFrame(
        rows, "feature string, coefficient double, p_value double, pct_effect double, r2 double"
    ).withColumn("significant", F.col("p_value") < 0.05)


def vif(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation factors: the diagonal of the inverse correlation matrix.

    A column that the others determine has an infinite factor, flagged high; a constant one has none (null).
    """
    kept = cut_lineage(df.select(*columns))
    ends = kept.agg(*[F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]).first()
    varying = [c for c in columns if ends[c]["low"] is not None and ends[c]["low"] < ends[c]["high"]]
    own = np.zeros((0, 0))
    if varying:
        data = VectorAssembler(inputCols=varying, outputCol="_x").transform(kept).select("_x")
        own = Correlation.corr(data, "_x").head()[0].toArray()
    values, vectors = np.linalg.eigh(own)
    null = values < 1e-10 * max(1, len(values))
    factors = np.diag(vectors[:, ~null] / values[~null] @ vectors[:, ~null].T)
    factors = np.where((np.abs(vectors[:, null]) > 1e-6).any(1), np.inf, factors)
    by_name = dict(zip(varying, factors.tolist()))
    out = df.sparkSession.createDataFrame([(c, by_name.get(c)) for c in columns], "feature string, vif double")
    flag = F.when(F.col("vif") > 10, F.lit("high")).when(F.col("vif") > 5, F.lit("moderate")).otherwise(F.lit(""))
    return out.withColumn("flag", flag).orderBy(F.col("vif").desc_nulls_last())


def trendline(df: DataFrame, y: str, x: str, y_quantile: float | None = 0.95) -> DataFrame:
    """Least-squares line over all rows with y up to an exact percentile."""
    kept = df.where(F.col(y) <= scalar_quantile(df, y, y_quantile)) if y_quantile else df
    return kept.agg(F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"),
                    F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"))


def _grid_lines(per_x: DataFrame, widths: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Weighted local lines at every grid point, from weights `n` and weighted sums `sy` per distinct x."""
    placed = per_x.select("x", "n", "sy", F.explode(F.array(*[F.lit(g) for g in grid])).alias("g")).withColumn("d", F.col("x") - F.col("g"))
    # One row per grid point: a fixed number, hence safe to broadcast.
    near = placed.join(F.broadcast(widths), "g")
    share = F.try_divide(F.abs("d"), F.col("h"))
    tricube = F.pow(1 - F.pow(share, F.lit(3)), F.lit(3))
    # A bandwidth of zero means that `frac` of the rows sit on the point itself.
    weight = F.when(F.col("h") > 0, F.when(share < 1, tricube).otherwise(0.0)).otherwise((F.col("d") == 0).cast("double"))
    d, wn, ws = F.col("d"), F.col("w") * F.col("n"), F.col("w") * F.col("sy")
    sums = near.withColumn("w", weight).groupBy("g", "h").agg(
        F.sum(wn).alias("w"), F.sum(wn * d).alias("wd"), F.sum(wn * d * d).alias("wdd"),
        F.sum(ws).alias("wy"), F.sum(ws * d).alias("wdy"))
    det = F.col("w") * F.col("wdd") - F.col("wd") * F.col("wd")
    line = (F.col("wdd") * F.col("wy") - F.col("wd") * F.col("wdy")) / det
    # Within a single x the line is undefined and the weighted mean is the answer.
    fit = F.when(det > 1e-9 * F.col("w") * F.col("w"), line).otherwise(F.try_divide("wy", "w"))
    return sums.select(F.col("g").alias("x"), fit.alias("smoothed"), F.col("h").alias("bandwidth"))


def _along(x: Column, points: Sequence[tuple[float, float]]) -> Column:
    """The line through ascending (x, y) points, as literals; flat beyond both ends."""
    out = F.when(x <= points[0][0], F.lit(points[0][1]))
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        out = out.when(x <= x1, F.lit(y0) + (x - F.lit(x0)) * F.lit((y1 - y0) / (x1 - x0)))
    return out.when(x.isNotNull(), F.lit(points[-1][1]))


def lowess_grid(df: DataFrame, y: str, x: str, points: int = 20, frac: float = 0.3, iterations: int = 3) -> DataFrame:
    """Robust local linear smoothing with tricube weights, evaluated on a grid of x quantiles.

    Tricube weights depend on x alone, so rows are first reduced to a weight and a weighted sum per distinct x, and only
    those meet the grid, a fixed number of literals. The bandwidth at a grid point is the exact distance within which `frac`
    of the rows lie.

    `iterations` rounds then make it robust: a row's residual is its distance from the curve through the grid, its weight
    the bisquare of the residual over six times the exact median of all absolute residuals; where that median is 0, rows off
    the curve weigh nothing. Each round reads the stored rows twice and hands on one number per grid point.
    """
    known = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    slices = slice_count(df)
    known = cut_lineage(known) if iterations else known
    per_x = cut_lineage(known.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy")))
    probs = {f"g{i}": ("x", i / (points - 1)) for i in range(points)}
    # At most `points` scalars.
    grid = sorted(set(grouped(per_x, [], quantiles=probs, slices=slices, weight="n").first() or []) - {None})
    if not grid:
        return df.sparkSession.createDataFrame([], "x double, smoothed double, bandwidth double")
    away = per_x.select("n", F.explode(F.array(*[F.struct(F.lit(g).alias("g"), F.abs(F.col("x") - g).alias("_a")) for g in grid])).alias("_p"))
    widths = cut_lineage(grouped(away.select("_p.g", "n", "_p._a"), ["g"], quantiles={"h": ("_a", frac)}, slices=slices, weight="n"))
    curve = _grid_lines(per_x, widths, grid)
    for _ in range(iterations):
        # At most `points` rows.
        fitted = sorted((r["x"], r["smoothed"]) for r in curve.collect() if r["smoothed"] is not None)
        residual = F.abs(F.col("y") - _along(F.col("x"), fitted))
        middle = grouped(known.select(residual.alias("_r")), [], quantiles={"m": ("_r", 0.5)}, slices=slices).first()["m"]
        # Below this a distance is rounding.
        least = 1e-12 * max(abs(v) for _, v in fitted)
        share = residual / F.lit(6 * middle) if middle > least else (residual > least).cast("double")
        weight = F.when(share < 1, F.pow(1 - share * share, F.lit(2))).otherwise(F.lit(0.0))
        weighted = known.select("x", weight.alias("_w"), (weight * F.col("y")).alias("_wy"))
        curve = _grid_lines(weighted.groupBy("x").agg(F.sum("_w").alias("n"), F.sum("_wy").alias("sy")), widths, grid)
    return curve
