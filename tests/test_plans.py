"""What the physical plans must and must not contain."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, clean, profile
from millrace.sources.tables import write_table
from workload import load

SF = Path("/root/testdata/sf0.001")
# These run for seconds before there is a plan to look at.
SLOW = ("stream_", "train_", "predict_best", "feature_importance", "runs_logged", "merge_", "compact_", "silver_rebuild")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not SF.exists(), reason="test tables not present")
def test_no_cross_joins_and_no_python_in_any_query(spark):
    for name, query in load().items():
        if not name.startswith(SLOW):
            plan = plan_of(query.run(spark, str(SF)))
            for unwanted in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "Cross"):
                assert unwanted not in plan, (name, unwanted)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    i = F.col("id")
    write_table(spark.range(1000).select(
        "id", F.lit("T").alias("primary_type"), (i % 5).cast("int").alias("district"),
        (i % 2 == 0).alias("arrest"), (i % 3 == 0).alias("domestic"),
        i.cast("double").alias("latitude"), i.cast("double").alias("longitude"),
        (i % 24).cast("int").alias("hour_of_day"), F.lit("wide").alias("description"),
        F.current_timestamp().cast("timestamp_ntz").alias("event_time"),
        (2020 + i % 4).cast("int").alias("event_year")), path, ["event_year"])
    return spark.read.parquet(path)


def test_scans_read_only_what_is_used(silver):
    plan = plan_of(aggregates.hourly_stats(silver))
    assert "ReadSchema: struct<primary_type:string,hour_of_day:int>" in plan
    assert "PushedFilters: [IsNotNull(hour_of_day)]" in plan
    assert "ReadSchema: struct<arrest:boolean>" in plan_of(profile.yearly_trend(silver))


def test_partitions_are_pruned(silver):
    plan = plan_of(aggregates.type_stats(silver.where("event_year = 2021")))
    assert "PartitionFilters: [isnotnull(event_year" in plan and "description" not in plan


def test_region_stats_scan_once_without_a_join(silver):
    plan = plan_of(aggregates.region_stats(silver))
    assert plan.count("FileScan") == 1 and "Join" not in plan
    # Cells are added up before the first shuffle.
    assert plan.index("partial_count(1)") > plan.rindex("Exchange")


def test_completeness_reaches_the_scan(silver):
    # The plan text shows the first filters only.
    plan = plan_of(clean.complete_rows(silver))
    assert "PushedFilters: [IsNotNull(id), IsNotNull(primary_type), IsNotNull(district)" in plan
