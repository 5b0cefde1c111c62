"""The batch run from CSV files to the star schema."""

import gzip
from datetime import date
from pathlib import Path

import pytest

from marketlens.plans import market_queries as mq
from marketlens.plans.pipeline import run_pipeline
from marketlens.sources import raw, sinks

LISTINGS = '''id,host_id,host_name,name,price,room_type,property_type,latitude,longitude,neighbourhood_cleansed,host_is_superhost,host_since,accommodates,bedrooms,beds,number_of_reviews,review_scores_rating,review_scores_cleanliness,review_scores_location,review_scores_communication,review_scores_checkin,review_scores_value,availability_365,minimum_nights,host_total_listings_count
1,10,Ann,"Cosy ""canal"" loft
by the park","$1,200.00",Entire home/apt,Entire loft,52.37,4.90,centrum-west,t,2015-01-01,4,2,,12,4.8,4.9,4.7,4.6,4.5,4.4,100,2,1
2,10,Ann,Cosy canal loft,$80.00,Private room,Room in hotel,52.36,4.91,Centrum-West,t,2015-01-01,2,1,1,0,,,,,,,0,500,1
3,11,Bob,Boat,,Tent,Boat,52.99,4.91,oud-zuid,f,2020-05-05,3,0,2,5,4.0,4,4,4,4,4,10,1,7
'''
CALENDAR = "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n" + "".join(
    f"{i},2024-0{m}-0{d},{'t' if (i + d) % 3 else 'f'},$90.00,,2,2147483647\n" for i in (1, 2) for m in (5, 6) for d in range(1, 10)
) + "1,never,t,,,1,1\n"
REVIEWS = '''listing_id,id,date,reviewer_id,reviewer_name,comments
1,100,2024-01-01,5,Zed,"Lovely, ""really""
lovely place"
1,101,2024-03-01,6,Yan,ok
2,102,2024-03-01,6,Yan,The host canceled this reservation
'''


@pytest.fixture()
def folder(tmp_path):
    for name, text in (("listings.csv.gz", LISTINGS), ("calendar.csv.gz", CALENDAR), ("reviews.csv.gz", REVIEWS)):
        with gzip.open(tmp_path / name, "wt", encoding="utf-8") as f:
            f.write(text)
    (tmp_path / "neighbourhoods.csv").write_text("neighbourhood,neighbourhood_group\ncentrum-west,\noud-zuid,\n")
    return str(tmp_path)


def test_full_run(spark, folder):
    tables = run_pipeline(spark, folder, f"{folder}/out", date(2025, 1, 1), "Town")
    assert {n: t.count() for n, t in tables.items()} == {
        "dim_host": 2, "dim_neighbourhood": 2, "dim_room_type": 3, "dim_date": 18, "fact_listings": 3, "fact_calendar": 36,
    }
    fact = {r.listing_id: r for r in tables["fact_listings"].collect()}
    assert fact[1].price == 1200.0 and fact[1].beds == 2.0 and fact[1]._is_valid
    assert fact[2].minimum_nights == 365.0 and fact[2].neighbourhood == "Centrum-West"
    assert fact[3].latitude is None and fact[3].room_type == "Other" and not fact[3]._is_valid
    assert fact[1].review_count == 2 and fact[3].review_count is None
    master = raw.read_table(spark, f"{folder}/out/processed/master_listings.parquet")
    assert master.count() == 3 and "adjusted_price" not in raw.read_table(spark, f"{folder}/out/processed/calendar_clean.parquet").columns
    reviews = {r.id: r for r in raw.read_table(spark, f"{folder}/out/processed/reviews_clean.parquet").collect()}
    assert reviews[100].comments == 'Lovely, "really"\nlovely place' and reviews[102]._is_auto_review
    assert mq.q6_top_revenue_areas(tables["fact_listings"]).first().neighbourhood == "Centrum-West"
    assert sinks.run_sql(spark, "SELECT count(*) FROM fact_calendar WHERE year = 2024 AND month = 5").first()[0] == 18
    ledger = raw.read_table(spark, f"{folder}/out/pipeline_metadata")
    assert {"loaded", "validated", "profiled", "cleaned", "enriched", "published"} == {r.stage for r in ledger.collect()}


def test_failure_is_logged(spark, folder):
    Path(folder, "reviews.csv.gz").unlink()
    with pytest.raises(Exception):
        run_pipeline(spark, folder, f"{folder}/out", date(2025, 1, 1), "Town")
    rows = raw.read_table(spark, f"{folder}/out/pipeline_metadata").where("stage = 'FAILED'").collect()
    assert len(rows) == 1


def test_tables_are_replaced_or_kept(spark):
    one, two = spark.range(1), spark.range(2)
    sinks.register_table(one, "kept_table")
    sinks.register_table(two, "kept_table", replace=False)
    assert spark.table("kept_table").count() == 1 and sinks.table_exists(spark, "kept_table")
    sinks.register_table(two, "kept_table")
    assert spark.table("kept_table").count() == 2 and not sinks.table_exists(spark, "absent_table")
    spark.sql("DROP TABLE kept_table")


def test_feature_list_document(spark, tmp_path):
    import json

    from marketlens.functions.fixed_values import MODEL_FEATURES
    sinks.save_feature_list(spark, f"{tmp_path}/features")
    assert json.loads(spark.read.text(f"{tmp_path}/features").first()[0]) == MODEL_FEATURES
