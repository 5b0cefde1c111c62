"""Report cubes, mergeable sketches, checks while writing, run folders."""

import pytest
from pyspark.sql import functions as F

from catalog import core, quality as raw_data, roles, storage
from marketlens.operators import market, profile, quality, sketches
from marketlens.operators.cube import cube_slice, report_cube
from marketlens.sources import sinks

FOLDER = "/root/testdata/sf0.001"


def values(df, *columns):
    return {tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()}


@pytest.mark.parametrize("slices", [1, 5])
def test_cube_slices_equal_single_reports(spark, slices):
    x = core.featured(spark, FOLDER)
    cube = report_cube(x, ["neighbourhood_cleansed", "room_type", "host_is_superhost"], ["price", "occupancy_rate"], slices=slices)
    area = market.area_table(x)
    got = cube_slice(cube, ["neighbourhood_cleansed"], "price")
    assert values(got, "neighbourhood_cleansed", "listings", "mean", "median") == values(
        area, "neighbourhood_cleansed", "listings", "mean_price", "median_price")
    got = cube_slice(cube, ["room_type"], "price")
    assert values(got, "room_type", "valued", "mean", "median") == values(
        market.price_by_category(x, "room_type"), "room_type", "listings", "mean_price", "median_price")
    label = F.when(F.col("host_is_superhost"), "Superhost").otherwise("Regular Host").alias("t")
    got = cube_slice(cube, ["host_is_superhost"], "occupancy_rate").select(label, "mean")
    assert values(got, "t", "mean") == values(market.superhost_performance(x), "host_type", "mean_occupancy")
    assert cube_slice(cube, [], "price").count() == 1


def test_cube_tells_missing_dimensions_from_left_out_ones(spark):
    x = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, float("nan")), ("a", None)], "g string, v double")
    rows = {(r.slice, r.g): (r.listings, r.valued, r["median"]) for r in report_cube(x, ["g"], ["v"]).collect()}
    assert rows == {("g", "a"): (2, 1, 1.0), ("g", None): (2, 1, 2.0), ("all", None): (4, 2, 1.5)}
    assert report_cube(x.limit(0), ["g"], ["v"]).count() == 0


def test_cube_reads_its_rows_once(spark):
    x = roles.listings(spark, FOLDER)
    plan = report_cube(x, ["room_type"], ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan  # only stored counts are read by all slices


def test_merged_sketches_equal_one_sketch(spark):
    x = roles.listings(spark, FOLDER).select("id", "price", "room_type", "host_since")
    parts = [x.where(F.col("id") % 3 == i) for i in range(3)] + [x.limit(0)]
    rows = [sketches.sketch_columns(p, "x", f"l{i}") for i, p in enumerate(parts)]
    merged = rows[0].unionByName(rows[1]).unionByName(rows[2]).unionByName(rows[3])
    got = {r["column"]: r for r in sketches.profile_from_sketches(sketches.merge_sketches(merged)).collect()}
    whole = {r["column"]: r for r in profile.profile_columns(x, "x").collect()}
    for c, r in whole.items():
        assert [got[c][k] for k in ("dtype", "null_count", "null_pct", "min", "max", "mean", "std")] == \
               [r[k] for k in ("dtype", "null_count", "null_pct", "min", "max", "mean", "std")]
        assert abs(got[c].unique_values - r.unique_values) <= max(1, 0.08 * r.unique_values)
    prices = sorted(r.price for r in x.where("price IS NOT NULL").collect())
    below = sum(p < got["price"]["median"] for p in prices) / len(prices)
    assert abs(below - 0.5) < 0.05


def test_a_repeated_load_replaces_itself(spark, tmp_path):
    x, path = spark.range(10).toDF("n"), str(tmp_path / "sketches")
    for load, frame in (("1", x), ("2", x), ("2", x.limit(4))):
        sketches.save_sketches(sketches.sketch_columns(frame, "x", load), path)
    merged = sketches.merge_sketches(sketches.read_sketches(spark, path)).first()
    assert merged.row_count == 14


def test_approximate_profile_shuffles_no_values(spark):
    x = roles.listings(spark, FOLDER).select("id", "price", "room_type")
    frame = profile.profile_columns(x, "x", approximate=True)
    assert frame.columns == profile.profile_columns(x, "x").columns
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan  # the melt that grouping by value starts from


def test_observed_checks_equal_checks_of_the_stored_frame(spark, tmp_path):
    for name, df in raw_data.raw_all(spark, FOLDER).items():
        stored, rows, checks = quality.land_checked(df, name, str(tmp_path / name))
        assert rows == stored.count()
        assert values(checks, *checks.columns) == values(quality.validate_dataset(stored, name), *checks.columns)


def test_failing_data_sets_are_landed_and_told(spark, tmp_path):
    df = raw_data.raw_reviews(spark, FOLDER)
    _, rows, checks = quality.land_checked(df.limit(0), "reviews", str(tmp_path / "a"))
    assert rows == 0 and [(r.rule, r.passed) for r in checks.collect()] == [("has rows", False)]
    _, rows, checks = quality.land_checked(df.drop("id"), "reviews", str(tmp_path / "b"))
    assert rows > 0 and [(r.rule, r.passed, r.action) for r in checks.collect()] == [("required columns", False, "id")]


def test_readers_stay_on_the_last_whole_run(spark, tmp_path):
    folder = str(tmp_path)
    sinks.publish_tables(spark, {"a": spark.range(3), "b": spark.range(1)}, folder, "one")
    broken = spark.range(1).select(F.raise_error(F.lit("stopped")).alias("id"))
    with pytest.raises(Exception):
        sinks.publish_tables(spark, {"a": spark.range(9), "b": broken}, folder, "two")
    assert sinks.current_tables(spark, folder)["a"].count() == 3
    sinks.publish_tables(spark, {"a": spark.range(9), "b": spark.range(1)}, folder, "two")
    assert sinks.current_tables(spark, folder)["a"].count() == 9


def test_cube_of_many_values_is_sliced(spark, monkeypatch):
    """Rows of counted values, not their compressed bytes, say whether a task may hold them all."""
    from marketlens.operators import cube, slices

    used = []

    def seen(df, by, aggregates, quantiles, slices, **options):
        used.append(slices)
        return grouped(df, by, aggregates, quantiles, slices, **options)

    grouped = cube.grouped
    monkeypatch.setattr(cube, "grouped", seen)
    x = spark.range(300).select((F.col("id") % 3).alias("g"), (F.col("id") % 97).cast("double").alias("v"))
    whole = report_cube(x, ["g"], ["v"]).collect()
    monkeypatch.setattr(slices, "TASK_VALUES", 50, raising=False)
    assert sorted(map(str, report_cube(x, ["g"], ["v"]).collect())) == sorted(map(str, whole))
    assert used[0] == 1 and used[1] > 1


def test_reports_are_computed_once_before_they_are_saved(spark, tmp_path):
    computed = spark.sparkContext.accumulator(0)

    def passed(x):
        computed.add(1)
        return x > 0

    rows = spark.range(4, numPartitions=1).where(F.udf(passed, "boolean")("id")).groupBy("id").count().where("count > 0")
    saved = sinks.save_report({"outliers": rows, "domain_violations": spark.range(0)}, str(tmp_path))
    assert saved == ["profile_outliers.csv"] and computed.value == 4
    assert {r["id"] for r in spark.read.csv(f"{tmp_path}/profile_outliers.csv", header=True).collect()} == {"1", "2", "3"}


def test_report_profiles_stored_listings(spark, monkeypatch):
    given = {}

    def seen(frames):
        given.update(frames)
        raise InterruptedError

    monkeypatch.setattr(storage.profile, "profile_all", seen)
    with pytest.raises(InterruptedError):
        storage.saved_report(spark, FOLDER)
    plan = given["listings"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and given["listings"].count() == raw_data.raw_listings(spark, FOLDER).count()
