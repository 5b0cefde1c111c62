"""Hypothesis tests, correlations, regression and smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import core, roles
from catalog.oracle import oracle
from catalog.rounding import near
from marketlens.functions.fixed_values import REGRESSION_COLUMNS, SPEARMAN_COLUMNS
from marketlens.operators import stats

QUERIES = {}
L = roles.listings


def entire_vs_private(s, d):
    room = F.col("room_type")
    return stats.two_groups(L(s, d).where("_is_valid"), "price", room == "Entire home/apt", room == "Private room")


def superhosts(s, d):
    host = F.col("host_is_superhost")
    return stats.two_groups(L(s, d), "review_scores_rating", host, ~host)


def weekends(s, d):
    return stats.weekend_groups(roles.calendar(s, d))


GROUPS = {
    "h1_price_by_room": (entire_vs_private, """SELECT price AS v, room_type = 'Entire home/apt' AS f FROM listings
        WHERE _is_valid AND room_type IN ('Entire home/apt', 'Private room')"""),
    "h2_rating_by_superhost": (superhosts, """SELECT review_scores_rating AS v, host_is_superhost AS f FROM listings
        WHERE review_scores_rating IS NOT NULL"""),
    "h5_booked_by_weekend": (weekends, """SELECT CAST(COALESCE(NOT available, FALSE) AS DOUBLE) AS v, is_weekend AS f FROM calendar"""),
}
for _name, (_groups, _sql) in GROUPS.items():
    _extra = {"groups": _sql, "m": """
SELECT COUNT(*) FILTER (WHERE f) AS n1, COUNT(*) FILTER (WHERE NOT f) AS n2, AVG(v) FILTER (WHERE f) AS mean1,
  AVG(v) FILTER (WHERE NOT f) AS mean2, VAR_SAMP(v) FILTER (WHERE f) AS v1, VAR_SAMP(v) FILTER (WHERE NOT f) AS v2 FROM groups""",
              "effect": "SELECT n1, n2, mean1, mean2, (mean1 - mean2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) AS d FROM m",
              "counted": "SELECT v, COUNT(*) AS n, COUNT(*) FILTER (WHERE f) AS k FROM groups GROUP BY v",
              "ranked": "SELECT n, k, SUM(n) OVER (ORDER BY v) - n + (n + 1) / 2 AS r FROM counted"}
    QUERIES[f"cohens_d_{_name}"] = near(
        lambda s, d, g=_groups: stats.cohens_d(g(s, d)),
        oracle("""SELECT *, CASE WHEN abs(d) < 0.2 THEN 'Negligible' WHEN abs(d) < 0.5 THEN 'Small'
                  WHEN abs(d) < 0.8 THEN 'Medium' ELSE 'Large' END AS effect FROM effect""", _extra), "mean1", "mean2", "d")
    QUERIES[f"mann_whitney_{_name}"] = near(
        lambda s, d, g=_groups: stats.mann_whitney_u(g(s, d)).select("n1", "n2", "u", "tie_term", "z"),
        oracle("""SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u, t AS tie_term,
            (u - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n + 1 - t / (n * (n - 1)))) AS z FROM (
            SELECT CAST(SUM(k) AS DOUBLE) AS n1, CAST(SUM(n) - SUM(k) AS DOUBLE) AS n2, CAST(SUM(n) AS DOUBLE) AS n,
                   CAST(SUM(k * r) AS DOUBLE) - SUM(k) * (SUM(k) + 1) / 2 AS u,
                   SUM(CAST(n AS DOUBLE) * n * n - n) AS t FROM ranked)""", _extra), "z")
    QUERIES[f"mann_whitney_p_{_name}"] = (lambda s, d, g=_groups: stats.mann_whitney_u(g(s, d)).select("p_value"), None)
QUERIES["group_comparison"] = near(
    lambda s, d: stats.group_comparison(entire_vs_private(s, d)),
    oracle("""SELECT *, mean1 - mean2 AS mean_difference, median1 - median2 AS median_difference FROM (
        SELECT COUNT(*) FILTER (WHERE f) AS n1, COUNT(*) FILTER (WHERE NOT f) AS n2, AVG(v) FILTER (WHERE f) AS mean1,
          AVG(v) FILTER (WHERE NOT f) AS mean2, MEDIAN(v) FILTER (WHERE f) AS median1,
          MEDIAN(v) FILTER (WHERE NOT f) AS median2 FROM groups)""", {"groups": GROUPS["h1_price_by_room"][1]}),
    "mean1", "mean2", "median1", "median2", "mean_difference", "median_difference")
KRUSKAL = {
    "known": "SELECT neighbourhood_cleansed AS g, price AS v FROM listings WHERE _is_valid",
    "large": "SELECT * FROM known QUALIFY COUNT(*) OVER (PARTITION BY g) >= 10",
    "value_ranks": "SELECT v, n, SUM(n) OVER (ORDER BY v) - n + (n + 1) / 2 AS r FROM (SELECT v, COUNT(*) AS n FROM large GROUP BY v)",
    "group_ranks": "SELECT g, CAST(COUNT(*) AS DOUBLE) AS n, SUM(r) AS r FROM large JOIN value_ranks USING (v) GROUP BY g",
    "h_stat": """SELECT COUNT(*) AS groups, SUM(n) AS n, (12 / (SUM(n) * (SUM(n) + 1)) * SUM(r * r / n) - 3 * (SUM(n) + 1))
        / (1 - (SELECT SUM(CAST(n AS DOUBLE) * n * n - n) FROM value_ranks) / (SUM(n) * SUM(n) * SUM(n) - SUM(n))) AS h FROM group_ranks""",
}
QUERIES["kruskal_wallis"] = near(
    lambda s, d: stats.kruskal_wallis(L(s, d).where("_is_valid"), "neighbourhood_cleansed", "price").drop("p_value"),
    oracle("""SELECT groups, CAST(n AS BIGINT) AS n, h, (h - groups + 1) / (n - groups) AS eta_squared,
        CASE WHEN (h - groups + 1) / (n - groups) < 0.01 THEN 'Negligible' WHEN (h - groups + 1) / (n - groups) < 0.06 THEN 'Small'
             WHEN (h - groups + 1) / (n - groups) < 0.14 THEN 'Medium' ELSE 'Large' END AS effect FROM h_stat""", KRUSKAL),
    "h", "eta_squared", digits=6)
QUERIES["kruskal_wallis_p"] = (
    lambda s, d: stats.kruskal_wallis(L(s, d).where("_is_valid"), "neighbourhood_cleansed", "price").select("p_value"), None)
QUERIES["normality_check"] = near(
    lambda s, d: stats.normality_check(L(s, d), "price").drop("p_value"),
    oracle("""SELECT n, g AS skewness, k AS excess_kurtosis, n / 6 * (g * g + k * k / 4) AS jarque_bera FROM (
        SELECT COUNT(*) AS n, AVG(pow(price - m, 3)) / pow(AVG(pow(price - m, 2)), 1.5) AS g,
               AVG(pow(price - m, 4)) / pow(AVG(pow(price - m, 2)), 2) - 3 AS k
        FROM listings, (SELECT AVG(price) AS m FROM listings) WHERE price IS NOT NULL)"""),
    "skewness", "excess_kurtosis", "jarque_bera", digits=6)
QUERIES["mean_ci95"] = near(
    lambda s, d: stats.mean_ci95(L(s, d).where("_is_valid"), "neighbourhood_cleansed").select(
        "neighbourhood_cleansed", "n", "mean", "std_error"),
    oracle("""SELECT neighbourhood_cleansed, COUNT(price) AS n, AVG(price) AS mean,
        STDDEV_SAMP(price) / sqrt(COUNT(price)) AS std_error FROM listings WHERE _is_valid GROUP BY ALL HAVING COUNT(price) >= 10"""),
    "mean", "std_error")
QUERIES["mean_ci95_bounds"] = (lambda s, d: stats.mean_ci95(L(s, d).where("_is_valid"), "neighbourhood_cleansed"), None)
QUERIES["weekend_lift"] = near(
    lambda s, d: stats.weekend_lift(roles.calendar(s, d)),
    oracle("""SELECT a AS weekend_pct, b AS weekday_pct, a - b AS lift FROM (
        SELECT AVG(CASE WHEN NOT available THEN 100.0 ELSE 0 END) FILTER (WHERE is_weekend) AS a,
               AVG(CASE WHEN NOT available THEN 100.0 ELSE 0 END) FILTER (WHERE NOT is_weekend) AS b FROM calendar)"""),
    "weekend_pct", "weekday_pct", "lift")
QUERIES["hypothesis_summary"] = (lambda s, d: stats.hypothesis_summary(L(s, d), roles.calendar(s, d)), None)
RANKED = ["price", "accommodates", "bedrooms", "number_of_reviews", "review_scores_rating", "availability_365"]
RANKS = {"complete": f"SELECT {', '.join(RANKED)} FROM listings WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in RANKED),
         "ranks": "SELECT " + ", ".join(f"RANK() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2 AS {c}" for c in RANKED)
         + " FROM complete"}
QUERIES["corr_spearman"] = near(
    lambda s, d: stats.corr_spearman(L(s, d), RANKED),
    oracle(" UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS rho FROM ranks"
                              for a in RANKED for b in RANKED), RANKS), "rho")
QUERIES["strongest_with_price"] = near(
    lambda s, d: stats.strongest_with(stats.corr_spearman(L(s, d), RANKED), "price", 3),
    oracle("""SELECT "column", rho, CASE WHEN rho > 0 THEN 'positive' ELSE 'negative' END AS direction FROM (""" + " UNION ALL ".join(
        f"SELECT '{b}' AS \"column\", corr(price, {b}) AS rho FROM ranks" for b in RANKED[1:]) + ") ORDER BY abs(rho) DESC LIMIT 3", RANKS), "rho")
QUERIES["corr_spearman_master"] = (lambda s, d: stats.corr_spearman(core.master(s, d), SPEARMAN_COLUMNS), None)


def regression(s, d):
    return stats.regression_frame(core.master(s, d).where("_is_valid"), REGRESSION_COLUMNS)


QUERIES["ols_log_price"] = (lambda s, d: stats.ols(regression(s, d), "log_price", REGRESSION_COLUMNS), None)
QUERIES["ols_single"] = near(
    lambda s, d: stats.ols(L(s, d).select("price", "accommodates").dropna(), "price", ["accommodates"]).select("feature", "coefficient", "r2"),
    oracle("""SELECT 'accommodates' AS feature, regr_slope(price, accommodates) AS coefficient, regr_r2(price, accommodates) AS r2 FROM listings
        UNION ALL SELECT 'intercept', regr_intercept(price, accommodates), regr_r2(price, accommodates) FROM listings"""), "coefficient", "r2", digits=6)
QUERIES["vif"] = (lambda s, d: stats.vif(regression(s, d), REGRESSION_COLUMNS), None)
QUERIES["vif_pair"] = near(
    lambda s, d: stats.vif(L(s, d).select("accommodates", "bedrooms").dropna(), ["accommodates", "bedrooms"]).select("feature", "vif"),
    oracle("""SELECT f AS feature, 1 / (1 - r * r) AS vif FROM (SELECT corr(accommodates, bedrooms) AS r FROM listings),
        (SELECT 'accommodates' AS f UNION ALL SELECT 'bedrooms')"""), "vif")
QUERIES["trendline"] = near(
    lambda s, d: stats.trendline(L(s, d), "price", "accommodates"),
    oracle("""SELECT regr_count(price, accommodates) AS n, regr_slope(price, accommodates) AS slope,
        regr_intercept(price, accommodates) AS intercept, regr_r2(price, accommodates) AS r2 FROM listings
        WHERE price <= (SELECT quantile_cont(price, 0.95) FROM listings)"""), "slope", "intercept", "r2")


def lowess_sql(x: str, kept: str, rounds: int = 3, points: int = 20, frac: float = 0.3) -> str:
    """Robust smoothing round by round: lines at the grid, residuals along it, bisquare weights."""
    probs = ", ".join(f"CAST({i} AS DOUBLE) / {points - 1}" for i in range(points))
    parts = {"k0": f"SELECT {x} AS x, price AS y, CAST(1 AS DOUBLE) AS rw FROM listings WHERE {kept} AND {x} IS NOT NULL",
             "grid": f"SELECT DISTINCT unnest(quantile_cont(x, [{probs}])) AS g FROM k0",
             "widths": f"SELECT g, quantile_cont(abs(x - g), {frac}) AS h FROM k0, grid GROUP BY g"}
    for i in range(rounds + 1):
        parts[f"w{i}"] = f"""SELECT g, h, x - g AS d, y, rw * CASE WHEN h > 0 THEN CASE WHEN abs(x - g) / h < 1 THEN pow(1 - pow(abs(x - g) / h, 3), 3)
            ELSE 0 END ELSE CAST(x = g AS DOUBLE) END AS w FROM k{i}, widths"""
        parts[f"s{i}"] = f"""SELECT g, h, SUM(w) AS w, SUM(w * d) AS wd, SUM(w * d * d) AS wdd, SUM(w * y) AS wy, SUM(w * d * y) AS wdy FROM w{i} GROUP BY g, h"""
        parts[f"c{i}"] = f"""SELECT g, h, CASE WHEN w * wdd - wd * wd > 1e-9 * w * w THEN (wdd * wy - wd * wdy) / (w * wdd - wd * wd) ELSE wy / w END AS v FROM s{i}"""
        parts[f"e{i}"] = f"SELECT g AS a, v AS va, lead(g) OVER (ORDER BY g) AS b, lead(v) OVER (ORDER BY g) AS vb, row_number() OVER (ORDER BY g) AS i FROM c{i}"
        parts[f"r{i}"] = f"SELECT x, y, abs(y - (va + (x - a) * (vb - va) / (b - a))) AS r FROM k{i} JOIN e{i} ON b IS NOT NULL AND x <= b AND (x > a OR i = 1)"
        parts[f"k{i + 1}"] = f"SELECT x, y, CASE WHEN r / (6 * m) < 1 THEN pow(1 - pow(r / (6 * m), 2), 2) ELSE 0 END AS rw FROM r{i}, (SELECT MEDIAN(r) AS m FROM r{i})"
    return oracle(f"SELECT g AS x, v AS smoothed, h AS bandwidth FROM c{rounds}", parts)


for _x, _limit in (("accommodates", ""), ("number_of_reviews", " AND number_of_reviews <= 200"), ("review_scores_rating", "")):
    _kept = "_is_valid AND price <= 800" + _limit
    QUERIES[f"lowess_{_x}"] = near(lambda s, d, x=_x, w=_kept: stats.lowess_grid(L(s, d).where(w), "price", x),
                                   lowess_sql(_x, _kept), "x", "smoothed", "bandwidth", digits=6)
