"""Filters, key figures, group tables, top lists, distributions, correlations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import core, roles
from catalog.oracle import oracle
from catalog.rounding import near
from marketlens.functions.fixed_values import PEARSON_COLUMNS, SERVING_DEFAULTS
from marketlens.operators import filters, market
from marketlens.operators.cleaning import serving_defaults
from marketlens.operators.cube import report_cube

QUERIES = {}
L = roles.listings


def featured(s, d):
    return core.featured(s, d)


# Serving and filters

SERVED = ", ".join(
    f"COALESCE({c}, {v}) AS {c}" for c, v in SERVING_DEFAULTS.items())
QUERIES["serving_defaults"] = (
    lambda s, d: serving_defaults(featured(s, d)).select("id", *SERVING_DEFAULTS, "host_is_superhost", "instant_bookable"),
    oracle(f"SELECT id, {SERVED}, host_is_superhost, instant_bookable FROM featured"))
QUERIES["apply_filters"] = (
    lambda s, d: filters.apply_filters(
        L(s, d), {"neighbourhood_cleansed": [], "room_type": ["Private room", "Entire home/apt"]},
        {"host_is_superhost": True, "instant_bookable": None}, {"price": (50, 300), "bedrooms": (1, 3), "accommodates": (2, 8)}),
    oracle("""SELECT * FROM listings WHERE room_type IN ('Private room', 'Entire home/apt') AND host_is_superhost
        AND price BETWEEN 50 AND 300 AND bedrooms BETWEEN 1 AND 3 AND accommodates BETWEEN 2 AND 8"""))
QUERIES["filter_pushdown_lineitem"] = (
    lambda s, d: filters.apply_filters(
        roles.table(s, d, "lineitem"), {"l_returnflag": ["R", "A"]}, None, {"l_quantity": (10, 20)}
    ).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")),
    """SELECT l_returnflag, COUNT(*) AS n FROM lineitem WHERE l_returnflag IN ('R', 'A')
       AND l_quantity BETWEEN 10 AND 20 GROUP BY l_returnflag""")
QUERIES["search_values"] = (
    lambda s, d: filters.search_values(L(s, d), "neighbourhood_cleansed", "ION_1"),
    oracle("SELECT DISTINCT neighbourhood_cleansed FROM listings WHERE contains(lower(neighbourhood_cleansed), 'ion_1')"))
QUERIES["filter_options"] = (
    lambda s, d: filters.filter_options(L(s, d), ["neighbourhood_cleansed", "room_type", "property_type"]),
    oracle(" UNION ALL ".join(f"SELECT DISTINCT '{c}' AS \"column\", {c} AS value FROM listings"
                              for c in ("neighbourhood_cleansed", "room_type", "property_type"))))
QUERIES["filter_bounds"] = near(
    lambda s, d: filters.filter_bounds(L(s, d)),
    oracle("""SELECT MIN(price) AS min_price, MAX(bedrooms) AS max_bedrooms, MAX(accommodates) AS max_accommodates,
              quantile_cont(price, 0.99) AS max_price FROM listings"""), "max_price")
QUERIES["sample_rows"] = (
    lambda s, d: filters.sample_rows(L(s, d), "id", 500).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")),
    "SELECT LEAST(COUNT(*), 500) AS n, LEAST(COUNT(*), 500) AS ids FROM orders")
QUERIES["rating_and_price_filters"] = (
    lambda s, d: L(s, d).where(
        "_is_valid AND review_scores_rating > 0 AND price <= 800 AND number_of_reviews <= 200 AND minimum_nights <= 14")
    .where(F.col("accommodates") <= 10).agg(F.count(F.lit(1)).alias("n")),
    oracle("""SELECT COUNT(*) AS n FROM listings WHERE _is_valid AND review_scores_rating > 0 AND price <= 800
              AND number_of_reviews <= 200 AND minimum_nights <= 14 AND accommodates <= 10"""))

# Key figures

QUERIES["kpi_baseline"] = near(
    lambda s, d: market.kpi_baseline(featured(s, d)),
    oracle("""SELECT COUNT(*) AS listings, AVG(price) AS mean_price, AVG(occupancy_rate) AS mean_occupancy,
              COUNT(*) FILTER (WHERE host_is_superhost) * 100 / COUNT(*) AS superhost_pct FROM featured"""),
    "mean_price", "mean_occupancy", "superhost_pct")
QUERIES["kpi_market"] = near(
    lambda s, d: market.kpi_market(featured(s, d)),
    oracle("""SELECT COUNT(*) AS listings, AVG(price) AS mean_price, AVG(review_scores_rating) AS mean_rating,
              AVG(occupancy_rate) AS mean_occupancy, AVG(estimated_annual_revenue_computed) AS mean_revenue,
              COUNT(*) FILTER (WHERE host_is_superhost) AS superhosts,
              COUNT(*) FILTER (WHERE host_is_superhost) * 100 / COUNT(*) AS superhost_pct,
              AVG(number_of_reviews) AS mean_reviews, MEDIAN(price) AS median_price,
              MEDIAN(minimum_nights) AS median_min_nights FROM featured"""),
    "mean_price", "mean_rating", "mean_occupancy", "mean_revenue", "superhost_pct", "mean_reviews", "median_price")
QUERIES["kpi_host"] = near(
    lambda s, d: market.kpi_host(featured(s, d)),
    oracle("""SELECT AVG(host_response_rate) AS mean_response_rate, AVG(host_acceptance_rate) AS mean_acceptance_rate,
              AVG(host_tenure_years) AS mean_tenure_years FROM featured"""),
    "mean_response_rate", "mean_acceptance_rate", "mean_tenure_years")
QUERIES["price_overview"] = near(
    lambda s, d: market.price_overview(L(s, d)),
    oracle("""SELECT COUNT(*) AS listings, COUNT(price) AS priced_listings, MIN(price) AS min_price,
              MAX(price) AS max_price, AVG(price) AS mean_price, MEDIAN(price) AS median_price FROM listings"""),
    "mean_price", "median_price")
QUERIES["conditional_counts"] = (
    lambda s, d: market.conditional_counts(L(s, d), {
        "entire_homes": F.col("room_type") == "Entire home/apt", "private_rooms": F.col("room_type") == "Private room",
        "superhosts": F.col("host_is_superhost"), "instant": F.col("instant_bookable")}),
    oracle("""SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE room_type = 'Entire home/apt') AS entire_homes,
        COUNT(*) FILTER (WHERE room_type = 'Private room') AS private_rooms,
        COUNT(*) FILTER (WHERE host_is_superhost) AS superhosts, COUNT(*) FILTER (WHERE instant_bookable) AS instant
        FROM listings"""))
QUERIES["scalar_percentiles"] = near(
    lambda s, d: market.scalar_summary(
        L(s, d), {"p35": ("price", 0.35), "p50": ("price", 0.5), "p85": ("price", 0.85), "p95": ("price", 0.95),
                  "p99": ("price", 0.99)}, {"max_price": "price"}),
    oracle("""SELECT quantile_cont(price, 0.35) AS p35, quantile_cont(price, 0.5) AS p50,
        quantile_cont(price, 0.85) AS p85, quantile_cont(price, 0.95) AS p95, quantile_cont(price, 0.99) AS p99,
        MAX(price) AS max_price FROM listings"""), "p35", "p50", "p85", "p95", "p99")

# Group tables


def by_group(name, query, sql, *columns):
    QUERIES[name] = near(query, oracle(sql), *columns)


by_group("area_table", lambda s, d: market.area_table(featured(s, d)),
         """SELECT neighbourhood_cleansed, COUNT(id) AS listings, AVG(price) AS mean_price,
            AVG(occupancy_rate) AS mean_occupancy, AVG(review_scores_rating) AS mean_rating,
            MEDIAN(price) AS median_price FROM featured GROUP BY neighbourhood_cleansed""",
         "mean_price", "mean_occupancy", "mean_rating", "median_price")
for _name, _ascending in (("area_price_top10", False), ("area_price_bottom10", True)):
    by_group(_name, lambda s, d, a=_ascending: market.area_price_topk(L(s, d), 10, a),
             f"""SELECT neighbourhood_cleansed, MEDIAN(price) AS median_price FROM listings GROUP BY ALL
                 ORDER BY median_price {'ASC' if _ascending else 'DESC'}, neighbourhood_cleansed LIMIT 10""", "median_price")
by_group("segment_share", lambda s, d: market.segment_share(featured(s, d)),
         """SELECT host_segment, COUNT(*) AS n, COUNT(*) * 100 / SUM(COUNT(*)) OVER () AS share_pct FROM featured
            WHERE host_segment IS NOT NULL GROUP BY host_segment""", "share_pct")
for _metric in ("occupancy_rate", "estimated_annual_revenue_computed"):
    by_group(f"segment_mean_{_metric.split('_')[0]}",
             lambda s, d, m=_metric: market.group_mean(featured(s, d), "host_segment", m),
             f"SELECT host_segment, AVG({_metric}) AS value FROM featured WHERE host_segment IS NOT NULL GROUP BY ALL", "value")
for _by in ("room_type", "bedrooms", "accommodates", "property_type"):
    by_group(f"median_price_by_{_by}", lambda s, d, b=_by: market.group_median(L(s, d), b),
             f"SELECT {_by}, MEDIAN(price) AS value FROM listings WHERE {_by} IS NOT NULL GROUP BY ALL", "value")
by_group("price_by_room_type", lambda s, d: market.price_by_category(L(s, d), "room_type"),
         """SELECT room_type, COUNT(price) AS listings, AVG(price) AS mean_price, MEDIAN(price) AS median_price
            FROM listings WHERE price IS NOT NULL GROUP BY room_type""", "mean_price", "median_price")
by_group("price_by_area", lambda s, d: market.price_by_category(L(s, d), "neighbourhood_cleansed"),
         """SELECT neighbourhood_cleansed, COUNT(price) AS listings, AVG(price) AS mean_price,
            MEDIAN(price) AS median_price FROM listings WHERE price IS NOT NULL GROUP BY ALL""", "mean_price", "median_price")
by_group("median_price_by_supplier", lambda s, d: market.group_median(
    roles.table(s, d, "lineitem"), "l_suppkey", "l_extendedprice"),
    "SELECT l_suppkey, MEDIAN(l_extendedprice) AS value FROM lineitem GROUP BY l_suppkey", "value")
by_group("superhost_performance", lambda s, d: market.superhost_performance(featured(s, d)),
         """SELECT CASE WHEN host_is_superhost THEN 'Superhost' ELSE 'Regular Host' END AS host_type,
            AVG(price) AS mean_price, AVG(occupancy_rate) AS mean_occupancy,
            AVG(estimated_annual_revenue_computed) AS mean_revenue FROM featured GROUP BY ALL""",
         "mean_price", "mean_occupancy", "mean_revenue")
by_group("room_revenue_rank", lambda s, d: market.room_revenue_rank(featured(s, d)),
         """SELECT room_type, MEDIAN(estimated_annual_revenue_computed) AS median_revenue FROM featured GROUP BY room_type""",
         "median_revenue")
by_group("room_revenue_best", lambda s, d: market.room_revenue_rank(featured(s, d), 1),
         """SELECT room_type, MEDIAN(estimated_annual_revenue_computed) AS median_revenue FROM featured
            GROUP BY room_type ORDER BY median_revenue DESC, room_type LIMIT 1""", "median_revenue")
DEMAND = {"demand": """
SELECT * EXCLUDE (any_enough) FROM (SELECT *, MAX(listings >= {n}) OVER () AS any_enough FROM (
  SELECT neighbourhood_cleansed, AVG(occupancy_rate) AS mean_occupancy, COUNT(id) AS listings,
         MEDIAN(price) AS median_price FROM featured GROUP BY neighbourhood_cleansed))
WHERE listings >= {n} OR NOT any_enough"""}


def demand_sql(sql, n):
    return oracle(sql, {"demand": DEMAND["demand"].format(n=n)})


for _n in (10, 1000000):
    QUERIES[f"top_occupancy_areas{'' if _n == 10 else '_fallback'}"] = near(
        lambda s, d, n=_n: market.top_occupancy_areas(featured(s, d), 3, n),
        demand_sql("SELECT * FROM demand ORDER BY mean_occupancy DESC, neighbourhood_cleansed LIMIT 3", _n),
        "mean_occupancy", "median_price")
QUERIES["opportunity_areas"] = near(
    lambda s, d: market.opportunity_areas(featured(s, d)),
    demand_sql("""SELECT d.* FROM demand d WHERE mean_occupancy > (SELECT MEDIAN(mean_occupancy) FROM demand)
        AND listings < (SELECT MEDIAN(listings) FROM demand) ORDER BY mean_occupancy DESC, neighbourhood_cleansed LIMIT 3""", 10),
    "mean_occupancy", "median_price")
by_group("superhost_premium", lambda s, d: market.superhost_premium(featured(s, d)),
         """SELECT MEDIAN(r) FILTER (WHERE host_is_superhost) AS superhost_median,
            MEDIAN(r) FILTER (WHERE NOT host_is_superhost) AS other_median,
            COALESCE(MEDIAN(r) FILTER (WHERE host_is_superhost) - MEDIAN(r) FILTER (WHERE NOT host_is_superhost), 0) AS premium
            FROM (SELECT host_is_superhost, estimated_annual_revenue_computed AS r FROM featured)""",
         "superhost_median", "other_median", "premium")
QUERIES["top_value_rows"] = (
    lambda s, d: market.top_value_rows(L(s, d), "property_type").select("id", "property_type"),
    oracle("""SELECT id, property_type FROM listings WHERE property_type IN (SELECT property_type FROM listings
              GROUP BY property_type ORDER BY COUNT(*) DESC, property_type LIMIT 8)"""))
QUERIES["expensive_rows"] = (
    lambda s, d: market.expensive_rows(L(s, d), 400).select("id", "price"),
    oracle("SELECT id, price FROM listings WHERE price > 400 ORDER BY price DESC, id LIMIT 20"))
QUERIES["nearest_to_median"] = (
    lambda s, d: core_nearest(s, d),
    oracle("SELECT id, price FROM listings WHERE price IS NOT NULL ORDER BY abs(price - (SELECT median(price) FROM listings)), id LIMIT 1"))


def core_nearest(s, d):
    from marketlens.operators.quantiles import scalar_quantile

    rows = L(s, d).where(F.col("price").isNotNull())
    return rows.orderBy(F.abs(F.col("price") - scalar_quantile(rows, "price", 0.5)), "id").limit(1).select("id", "price")


# Distributions

for _by in ("room_type", "neighbourhood_cleansed"):
    QUERIES[f"box_stats_{_by.split('_')[0]}"] = near(
        lambda s, d, b=_by: market.box_stats(L(s, d), b),
        oracle(f"""SELECT l.{_by}, COUNT(*) AS n, ANY_VALUE(q1) AS q1, ANY_VALUE(q2) AS median, ANY_VALUE(q3) AS q3,
            MIN(price) FILTER (WHERE price >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
            MAX(price) FILTER (WHERE price <= q3 + 1.5 * (q3 - q1)) AS whisker_high
            FROM listings l JOIN (SELECT {_by}, quantile_cont(price, 0.25) AS q1, MEDIAN(price) AS q2,
              quantile_cont(price, 0.75) AS q3 FROM listings GROUP BY ALL) q USING ({_by})
            WHERE price IS NOT NULL GROUP BY l.{_by}"""), "q1", "median", "q3")


def histogram_sql(expression, bins, where="TRUE", table="featured"):
    return f"""SELECT bin, low + bin * width AS bin_start, low + (bin + 1) * width AS bin_end, COUNT(*) AS n FROM (
      SELECT CAST(LEAST(floor((v - low) / width), {bins - 1}) AS INT) AS bin, low, width FROM (
        SELECT v, MIN(v) OVER () AS low, (MAX(v) OVER () - MIN(v) OVER ()) / {bins} AS width
        FROM (SELECT {expression} AS v FROM {table} WHERE {expression} IS NOT NULL AND {where})))
      GROUP BY bin, low, width"""


HISTOGRAMS = {
    "price": (dict(value="price", bins=40, upto_quantile=0.95),
              ("price", 40, "price <= (SELECT quantile_cont(price, 0.95) FROM listings)", "listings")),
    "occupancy": (dict(value="occupancy_rate", bins=30), ("occupancy_rate", 30)),
    "rating": (dict(value="review_scores_rating", bins=25, above=0),
               ("review_scores_rating", 25, "review_scores_rating > 0", "listings")),
    "tenure": (dict(value="host_tenure_years", bins=20), ("host_tenure_years", 20)),
    "price_capped": (dict(value="price", bins=50, upper=300), ("LEAST(price, 300)", 50, "price IS NOT NULL", "listings")),
}
for _name, (_options, _sql) in HISTOGRAMS.items():
    QUERIES[f"histogram_{_name}"] = near(
        lambda s, d, o=_options, t=_sql: market.histogram(L(s, d) if len(t) == 4 else featured(s, d), **o),
        oracle(histogram_sql(*_sql)), "bin_start", "bin_end")
CORR = [c for c in PEARSON_COLUMNS]
QUERIES["corr_matrix"] = near(
    lambda s, d: market.corr_matrix(featured(s, d), CORR),
    oracle(" UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS corr FROM featured"
                              for a in CORR for b in CORR)), "corr")

# All reports of three dimensions from one scan

CUBE_DIMS = ["neighbourhood_cleansed", "room_type", "host_is_superhost"]
CUBE_METRICS = ["price", "occupancy_rate", market.REVENUE, "review_scores_rating"]
CUBE_SETS = [["neighbourhood_cleansed"], ["room_type"], ["host_is_superhost"], ["room_type", "host_is_superhost"], []]
_MELTED = " UNION ALL ".join(f"SELECT {', '.join(CUBE_DIMS)}, '{m}' AS metric, {m} AS value FROM featured" for m in CUBE_METRICS)
_NAMES = " ".join(
    f"WHEN GROUPING({', '.join(CUBE_DIMS)}) = {sum(4 >> i for i, d in enumerate(CUBE_DIMS) if d not in s)} THEN '{', '.join(s) or 'all'}'"
    for s in CUBE_SETS)
QUERIES["report_cube"] = near(
    lambda s, d: report_cube(featured(s, d), CUBE_DIMS, CUBE_METRICS, CUBE_SETS),
    oracle(f"""SELECT CASE {_NAMES} END AS slice, {', '.join(CUBE_DIMS)}, metric, COUNT(*) AS listings, COUNT(value) AS valued,
        AVG(value) AS mean, MIN(value) AS min, MAX(value) AS max, MEDIAN(value) AS median FROM ({_MELTED})
        GROUP BY GROUPING SETS ({', '.join(f"({', '.join([*s, 'metric'])})" for s in CUBE_SETS)})"""),
    "mean", "median", digits=6)
