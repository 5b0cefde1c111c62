"""The driver's tables in the roles of listings, calendar and reviews, for Spark and as SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators.cleaning import review_flags, valid_flag
from marketlens.functions.scalar import calendar_parts, in_box
from marketlens.functions.fixed_values import CITY_BOX

AS_OF = date(2025, 1, 1)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


LISTINGS_SQL = """
SELECT o.o_orderkey AS id, o.o_custkey AS host_id, n.n_name AS neighbourhood_cleansed,
       r.r_name AS neighbourhood_group_cleansed,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Entire home/apt' WHEN '2-HIGH' THEN 'Private room'
            WHEN '3-MEDIUM' THEN 'Shared room' WHEN '4-NOT SPECIFIED' THEN 'Hotel room' ELSE 'Other' END AS room_type,
       CONCAT(o.o_orderpriority, '/', CAST(o.o_orderkey % 20 AS STRING)) AS property_type,
       CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_totalprice / CAST(1000 AS DOUBLE) END AS price,
       CAST(1 + o.o_orderkey % 16 AS DOUBLE) AS accommodates,
       CAST(CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderkey % 5 END AS DOUBLE) AS bedrooms,
       CAST(CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE 1 + o.o_orderkey % 3 END AS DOUBLE) AS bathrooms,
       CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE 1 + o.o_orderkey % 6 END AS DOUBLE) AS beds,
       CASE WHEN o.o_orderkey % 10 = 0 THEN NULL ELSE (300 + o.o_orderkey % 200) / CAST(100 AS DOUBLE) END
           AS review_scores_rating,
       (300 + o.o_orderkey % 191) / CAST(100 AS DOUBLE) AS review_scores_cleanliness,
       (300 + o.o_orderkey % 181) / CAST(100 AS DOUBLE) AS review_scores_location,
       (300 + o.o_orderkey % 173) / CAST(100 AS DOUBLE) AS review_scores_communication,
       (300 + o.o_orderkey % 167) / CAST(100 AS DOUBLE) AS review_scores_checkin,
       (300 + o.o_orderkey % 163) / CAST(100 AS DOUBLE) AS review_scores_value,
       CAST(o.o_orderkey % 120 AS DOUBLE) AS number_of_reviews,
       CAST((o.o_orderkey * 13) % 400 AS DOUBLE) AS availability_365,
       CAST(1 + o.o_orderkey % 30 AS DOUBLE) AS minimum_nights,
       (52200 + o.o_orderkey % 400) / CAST(1000 AS DOUBLE) AS latitude,
       (4700 + o.o_orderkey % 397) / CAST(1000 AS DOUBLE) AS longitude,
       c.c_acctbal > 5000 AS host_is_superhost, o.o_orderkey % 4 = 0 AS instant_bookable,
       CAST(c.c_custkey % 30 AS DOUBLE) AS host_total_listings_count,
       CAST(c.c_custkey % 101 AS DOUBLE) AS host_response_rate,
       CAST(c.c_custkey % 97 AS DOUBLE) AS host_acceptance_rate,
       CAST(o.o_orderdate AS DATE) AS host_since,
       o.o_orderkey % 7 <> 0 AND o.o_orderkey % 400 <= 300 AS _is_valid
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
"""

CALENDAR_SQL = """
SELECT l_orderkey AS listing_id, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_returnflag <> 'R' END AS available,
       CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_extendedprice END AS price,
       CAST(l_quantity AS DOUBLE) AS minimum_nights,
       CAST(MONTH(l_shipdate) AS INT) AS month, CAST(YEAR(l_shipdate) AS INT) AS year,
       CAST(QUARTER(l_shipdate) AS INT) AS quarter
FROM lineitem
"""

REVIEWS_SQL = """
SELECT event_id AS id, user_id AS listing_id, CAST(ts AS DATE) AS date,
       CASE event_type WHEN 'error' THEN 'The host canceled this reservation' WHEN 'signup' THEN 'ok'
            WHEN 'view' THEN NULL ELSE CONCAT(event_type, ' was a pleasant stay') END AS comments FROM events
"""


def listings(spark: SparkSession, folder: str) -> DataFrame:
    o, c = table(spark, folder, "orders"), table(spark, folder, "customer")
    n, r = table(spark, folder, "nation"), table(spark, folder, "region")
    key, host = F.col("o_orderkey"), F.col("c_custkey")
    rooms = {"1-URGENT": "Entire home/apt", "2-HIGH": "Private room", "3-MEDIUM": "Shared room",
             "4-NOT SPECIFIED": "Hotel room"}
    room = F.lit("Other")
    for priority, name in rooms.items():
        room = F.when(F.col("o_orderpriority") == priority, F.lit(name)).otherwise(room)

    def hundredths(m: int):
        return (300 + key % m) / 100.0

    joined = (
        o.join(c, F.col("o_custkey") == host)
        .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    latitude, longitude = (52200 + key % 400) / 1000.0, (4700 + key % 397) / 1000.0
    return joined.select(
        key.alias("id"), F.col("o_custkey").alias("host_id"), F.col("n_name").alias("neighbourhood_cleansed"),
        F.col("r_name").alias("neighbourhood_group_cleansed"), room.alias("room_type"),
        F.concat("o_orderpriority", F.lit("/"), (key % 20).cast("string")).alias("property_type"),
        F.when(key % 7 != 0, F.col("o_totalprice") / 1000.0).alias("price"),
        (1 + key % 16).cast("double").alias("accommodates"),
        F.when(key % 11 != 0, key % 5).cast("double").alias("bedrooms"),
        F.when(key % 13 != 0, 1 + key % 3).cast("double").alias("bathrooms"),
        F.when(key % 3 != 0, 1 + key % 6).cast("double").alias("beds"),
        F.when(key % 10 != 0, hundredths(200)).alias("review_scores_rating"),
        hundredths(191).alias("review_scores_cleanliness"), hundredths(181).alias("review_scores_location"),
        hundredths(173).alias("review_scores_communication"), hundredths(167).alias("review_scores_checkin"),
        hundredths(163).alias("review_scores_value"),
        (key % 120).cast("double").alias("number_of_reviews"),
        ((key * 13) % 400).cast("double").alias("availability_365"),
        (1 + key % 30).cast("double").alias("minimum_nights"),
        latitude.alias("latitude"), longitude.alias("longitude"),
        (F.col("c_acctbal") > 5000).alias("host_is_superhost"), (key % 4 == 0).alias("instant_bookable"),
        (host % 30).cast("double").alias("host_total_listings_count"),
        (host % 101).cast("double").alias("host_response_rate"),
        (host % 97).cast("double").alias("host_acceptance_rate"),
        F.col("o_orderdate").cast("date").alias("host_since"),
    ).withColumn("_is_valid", valid_flag(("price",)) & in_box("latitude", "longitude", CITY_BOX))


def calendar(spark: SparkSession, folder: str) -> DataFrame:
    line = table(spark, folder, "lineitem")
    typed = line.select(
        F.col("l_orderkey").alias("listing_id"), F.col("l_shipdate").cast("date").alias("date"),
        F.when(F.col("l_linenumber") != 7, F.col("l_returnflag") != "R").alias("available"),
        F.when(F.col("l_linestatus") != "O", F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").cast("double").alias("minimum_nights"),
    )
    return typed.withColumns(calendar_parts("date"))


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    comments = (
        F.when(kind == "error", F.lit("The host canceled this reservation")).when(kind == "signup", F.lit("ok"))
        .when(kind != "view", F.concat(kind, F.lit(" was a pleasant stay")))
    )
    e = table(spark, folder, "events")
    typed = e.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("listing_id"), F.col("ts").cast("date").alias("date"),
        comments.alias("comments"),
    )
    return typed.withColumns(review_flags("comments"))


def clean(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: role(spark, folder) for name, role in
            {"listings": listings, "calendar": calendar, "reviews": reviews}.items()}
