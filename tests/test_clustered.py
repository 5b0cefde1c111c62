"""Tables clustered by listing: plans without a shuffle, equal results, full buckets, names that queries leave behind."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from catalog import roles
from marketlens.operators import star, summaries
from marketlens.sources import clustered, sinks

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture()
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_summaries_joins_and_fact_move_no_rows(spark, shuffled_joins, tmp_path):
    parts = roles.clean(spark, FOLDER)
    keys = {"listings": "id", "reviews": "listing_id", "calendar": "listing_id"}
    tables = clustered.save_clustered_tables({n: (parts[n], k) for n, k in keys.items()}, str(tmp_path), "c_")
    joined = star.fact_listings(summaries.join_all_summaries(tables["listings"], tables["reviews"], tables["calendar"]))
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    clustered.forget_tables(spark, ["c_listings", "c_reviews", "c_calendar"])
    assert not sinks.table_exists(spark, "c_listings")
    plain = star.fact_listings(summaries.join_all_summaries(parts["listings"], parts["reviews"], parts["calendar"]))
    assert "Exchange" in plan(plain)
    assert joined.exceptAll(plain).isEmpty() and joined.count() == plain.count()


def test_a_full_bucket_is_not_one_task(spark, shuffled_joins, tmp_path):
    """A key with most rows, and rows without a key, are stored without buckets; results stay."""
    for name, key in (("hot", F.lit(7)), ("bare", F.lit(None).cast("long"))):
        df = spark.range(4000).select(F.when(F.col("id") % 3 > 0, key).otherwise(F.col("id")).cast("long").alias("k"), "id")
        table = clustered.save_clustered(df, "k", name, f"{tmp_path}/{name}", 8, task_rows=100)
        assert "Exchange" in plan(table.groupBy("k").count())
        assert table.groupBy("k").count().exceptAll(df.groupBy("k").count()).isEmpty() and table.count() == 4000
        even = clustered.save_clustered(df, "k", name, f"{tmp_path}/{name}", 8)
        assert "Exchange" not in plan(even.groupBy("k").count()) and even.count() == 4000
        clustered.forget_tables(spark, [name])


def test_no_rows_and_bucket_counts(spark, tmp_path):
    empty = clustered.save_clustered(spark.range(0), "id", "none", f"{tmp_path}/none", 8)
    assert empty.count() == 0 and empty.columns == ["id"]
    clustered.forget_tables(spark, ["none"])
    frames = [roles.table(spark, FOLDER, n) for n in ("orders", "lineitem")]
    assert clustered.bucket_count(frames) == clustered.FEWEST
    most = clustered.scanned_bytes(frames[1])
    assert clustered.bucket_count(frames, most // 20) == 32 and clustered.bucket_count(frames, 1) <= clustered.MOST


def test_names_of_a_statement_are_its_own(spark):
    out = sinks.run_sql(spark, "SELECT sum(id) AS s FROM given_rows", {"given_rows": spark.range(4)})
    assert not sinks.table_exists(spark, "given_rows") and out.first().s == 6
    spark.range(1).createOrReplaceTempView("own_view")
    with pytest.raises(AnalysisException):
        sinks.run_sql(spark, "SELECT 1", {"own_view": spark.range(2)})
    assert spark.table("own_view").count() == 1
    spark.catalog.dropTempView("own_view")


def test_a_bucket_grows_no_further_than_a_task_can_sort(monkeypatch):
    for stored in (1 << 26, 1 << 28, 1 << 32):
        monkeypatch.setattr(clustered, "scanned_bytes", lambda _: stored)
        assert stored / clustered.bucket_count([None]) <= 8 << 20
