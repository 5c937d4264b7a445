"""Aggregate tables, profiles and top lists on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, profile, ranking, reshape, toplists
from millrace.plans.eda import summary_document, summary_sections

SCHEMA = ("id BIGINT, primary_type STRING, district INT, arrest BOOLEAN, domestic BOOLEAN, "
          "latitude DOUBLE, longitude DOUBLE, hour_of_day INT, event_time STRING")


def table(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], SCHEMA)


def sample(spark):
    return table(spark, [
        ("B", 1, True, False, 1.0, -1.0, 3, "2024-01-02"),
        ("A", 1, False, True, 3.0, None, 3, "2024-01-01"),
        ("A", 2, None, None, None, -2.0, None, "2024-01-03"),
        ("C", None, True, True, 9.0, -9.0, 5, "2024-01-04"),
        (None, 2, True, False, 5.0, -4.0, 5, "2024-01-05"),
    ])


def test_type_stats_count_missing_flags_as_false(spark):
    stats = {r["primary_type"]: r for r in aggregates.type_stats(sample(spark)).collect()}
    a = stats["A"]
    assert (a["crime_count"], a["arrest_count"], a["arrest_rate"], a["domestic_rate"]) == (2, 0, 0.0, 0.5)
    assert (a["first_seen"], a["last_seen"], a["frequency_bucket"]) == ("2024-01-01", "2024-01-03", "low")


def test_region_stats_break_ties_by_name(spark):
    stats = {r["district"]: r for r in aggregates.region_stats(sample(spark)).collect()}
    assert set(stats) == {1, 2}
    one = stats[1]
    assert (one["top_primary_type"], one["top_primary_type_count"], one["unique_types"]) == ("A", 1, 2)
    assert (one["avg_latitude"], one["avg_longitude"], one["arrest_rate"]) == (2.0, -1.0, 0.5)
    assert stats[2]["unique_types"] == 1 and stats[2]["avg_latitude"] == 5.0
    winners = {r["district"]: r["top_primary_type"] for r in aggregates.top_type_per_region(
        sample(spark).where("primary_type IS NOT NULL")).collect()}
    assert winners == {1: "A", 2: "A"}


def test_region_stats_equal_the_join_form(spark):
    rows = spark.range(5000).select(
        "id", F.concat(F.lit("t"), F.col("id") * 7 % 11).alias("primary_type"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 13).cast("int").alias("district"),
        (F.col("id") % 5 == 0).alias("arrest"), (F.col("id") % 17).cast("double").alias("latitude"),
        (F.col("id") % 19).cast("double").alias("longitude"))
    stats = aggregates.region_stats(rows)
    base = rows.groupBy("district").agg(F.count("*").alias("crime_count"), F.avg("latitude").alias("avg_latitude"))
    joined = aggregates.with_winner(base, aggregates.top_type_per_region(rows), "district")
    ours = {r["district"]: r for r in stats.collect()}
    for row in joined.collect():
        mine = ours.pop(row["district"])
        assert all(mine[name] == pytest.approx(row[name]) for name in joined.columns if name != "top_primary_type")
        assert mine["top_primary_type"] == row["top_primary_type"]
    assert not ours


def test_hourly_stats_and_roll_up(spark):
    hourly = aggregates.hourly_stats(sample(spark))
    assert hourly.count() == 4 and hourly.where("hour_of_day IS NULL").isEmpty()
    assert {tuple(r) for r in aggregates.roll_up(hourly, "hour_of_day").collect()} == {(3, 2), (5, 2)}


def test_distinct_counts_with_null_as_a_value(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 1), (None, None, 2)], "a INT, b INT, c INT")
    counts = df.agg(*[profile.distinct_with_null(n).alias(n) for n in df.columns]).first()
    assert tuple(counts) == tuple(df.select(n).distinct().count() for n in df.columns) == (3, 1, 2)
    empty = df.limit(0).agg(profile.distinct_with_null("a")).first()[0]
    assert empty == 0


def test_overview_and_nulls(spark):
    values = {r["metric"]: r["value"] for r in profile.overview(sample(spark)).collect()}
    assert values == {"total_rows": 5.0, "unique_primary_type": 4.0, "unique_district": 3.0,
                      "arrest_rate": 0.6, "domestic_rate": 0.4}
    none = {r["metric"]: r["value"] for r in profile.overview(sample(spark).limit(0)).collect()}
    assert none["total_rows"] == 0.0 and none["arrest_rate"] == 0.0
    gaps = {tuple(r) for r in profile.null_profile(sample(spark)).collect()}
    assert gaps == {("primary_type", 1), ("district", 1), ("arrest", 1), ("domestic", 1),
                    ("latitude", 1), ("longitude", 1), ("hour_of_day", 1)}


def test_describe_equals_spark(spark):
    names = ["latitude", "longitude"]
    ours = {r["summary"]: r for r in profile.describe_numeric(sample(spark), names).collect()}
    for row in sample(spark).select(*names).describe().collect():
        for name in names:
            assert ours[row["summary"]][name] == pytest.approx(float(row[name]))


def test_flag_share_sums_to_one(spark):
    assert {tuple(r) for r in profile.flag_share(sample(spark), "arrest").collect()} == {
        (True, 3, 0.6), (False, 2, 0.4)}


def test_yearly_rate_skips_missing_flags(spark):
    df = spark.createDataFrame([(2020, True), (2020, None), (2021, False)], "event_year INT, arrest BOOLEAN")
    assert [tuple(r) for r in profile.yearly_trend(df).collect()] == [(2020, 2, 1.0), (2021, 1, 0.0)]
    assert tuple(profile.year_range(profile.yearly_trend(df)).first()) == (2020, 2021)


def test_summary_document(spark):
    rows = spark.range(500).select(
        "id", F.concat(F.lit("t"), F.col("id") % 20).alias("primary_type"),
        (F.col("id") % 4).cast("int").alias("district"),
        F.when(F.col("id") % 10 != 0, (F.col("id") % 6).cast("int")).alias("ward"),
        F.lit(1).alias("community_area"), (F.col("id") % 3 == 0).alias("arrest"), F.lit(False).alias("domestic"),
        F.col("id").cast("double").alias("latitude"), F.lit(-1.0).alias("longitude"),
        (2000 + F.col("id") % 12).cast("int").alias("year"), (2000 + F.col("id") % 12).cast("int").alias("event_year"),
        (F.col("id") % 24).cast("int").alias("hour_of_day"), (F.col("id") % 7 + 1).cast("int").alias("day_of_week"))
    document = summary_document(summary_sections(rows)).first()
    assert document["total_rows"] == 500 and document["unique_ward"] == 7
    assert document["null_counts"] == {"ward": 50}
    assert len(document["top_primary_types"]) == 15
    for trend, key in (("yearly_trend", "year"), ("hourly_trend", "hour"), ("weekly_trend", "day_of_week")):
        assert sum(e["crime_count"] for e in document[trend]) == 500
        keys = [e[key] for e in document[trend]]
        assert keys == sorted(keys)
    assert document["numeric_describe"]["max"] == {"latitude": 499.0, "longitude": -1.0, "year": 2011.0}


def test_top_lists_are_total_orders(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "t STRING")
    assert [tuple(r) for r in toplists.top_counts(df, "t", 2, "n").collect()] == [("c", 2), ("a", 1)]


def test_heat_map(spark):
    grid = toplists.top_by_hour(aggregates.hourly_stats(sample(spark).where("primary_type IS NOT NULL")), 2)
    rows = [r.asDict() for r in grid.collect()]
    assert [r["primary_type"] for r in rows] == ["A", "B"]
    assert rows[0]["hour_3"] == 1 and rows[0]["hour_4"] == 0 and rows[0]["crime_count"] == 1


def test_crosstab_fills_gaps(spark):
    df = spark.createDataFrame([("x", 1, 5), ("y", 2, 7)], "r STRING, c INT, n BIGINT")
    grid = reshape.crosstab(df, "r", "c", [1, 2, 3], "n", "c_").orderBy("r")
    assert [tuple(r) for r in grid.collect()] == [("x", 5, 0, 0), ("y", 0, 7, 0)]


def test_crosstab_keeps_or_refuses_unlisted_values(spark):
    df = spark.createDataFrame([("x", 1, 5), (None, 1, 2), ("x", 9, 3), ("x", None, 4)], "r STRING, c INT, n BIGINT")
    grid = reshape.crosstab(df, "r", "c", [1], "n", rest="other").collect()
    assert {tuple(r) for r in grid} == {("x", 5, 7), (None, 2, 0)}
    with pytest.raises(Exception, match="unlisted c"):
        reshape.crosstab(df, "r", "c", [1], "n").collect()


@pytest.mark.parametrize("partitions, most_sums", [(1, 100_000), (7, 100_000), (7, 0)])
def test_running_totals_with_a_hot_group(spark, monkeypatch, partitions, most_sums):
    monkeypatch.setattr(ranking, "MOST_SUMS", most_sums)
    rows = [(None if n % 3 else n % 5, n * 37 % 1000, n % 4) for n in range(1000)]
    df = spark.createDataFrame(rows, "g INT, o INT, m BIGINT").repartition(partitions)
    out = ranking.running_totals(df, ["g"], ["o"], ["m"]).collect()
    assert len(out) == 1000
    for row in out[::41]:
        assert row["before_m"] == sum(m for g, o, m in rows if g == row["g"] and o < row["o"])


@pytest.mark.parametrize("threshold", ["1000", "5"])
def test_first_rows_by_both_ways(spark, monkeypatch, threshold):
    """Equal rows, a third of them alike, and a cut in the middle of them."""
    monkeypatch.setattr(ranking, "_CHUNK", 50)
    setting = "spark.sql.optimizer.windowGroupLimitThreshold"
    spark.conf.set(setting, threshold)
    try:
        values = [(7 if n % 3 == 0 else n % 50, "xy"[n % 2]) for n in range(900)]
        df = spark.createDataFrame(values, "v INT, w STRING").repartition(5)
        for n in (6, 100, 250, 900, 990):
            got = sorted(tuple(r) for r in ranking.first_rows(df, ["v"], n).collect())
            assert got == sorted(values)[:n]
        gaps = df.withColumn("v", F.when(F.col("v") != 7, F.col("v")))
        for n in (250, 400):
            got = [r["v"] for r in ranking.first_rows(gaps, ["v"], n).collect()]
            assert len(got) == n and got.count(None) == min(n, sum(v == 7 for v, _ in values))
        plan = ranking.first_rows(df, ["v"], 5)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2
    finally:
        spark.conf.unset(setting)


def test_tables_without_rows(spark):
    none = sample(spark).limit(0)
    for build in (aggregates.type_stats, aggregates.region_stats, aggregates.top_type_per_region,
                  aggregates.hourly_stats, profile.hourly_trend, profile.null_profile):
        assert build(none).isEmpty()
    assert toplists.top_by_hour(aggregates.hourly_stats(none)).isEmpty()
    assert toplists.top_counts(none, "primary_type", 5).isEmpty()
    described = {r["summary"]: r["latitude"] for r in profile.describe_numeric(none, ["latitude"]).collect()}
    assert described == {"count": 0.0, "mean": None, "stddev": None, "min": None, "max": None}
    assert {tuple(r) for r in profile.flag_share(none, "arrest").collect()} == {(True, 0, 0.0), (False, 0, 1.0)}
    for n in (10, 5000):
        assert ranking.first_rows(none.select("id", "district"), ["id"], n).isEmpty()
