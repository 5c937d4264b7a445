"""Aggregate tables made from what has changed equal those made from everything."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import gold
from millrace.sources.tables import write_table


def events(spark, *parts):
    """Rows per year, a missing year among them."""
    rows = [(year, i) for year, n in parts for i in range(n)]
    i = F.col("i")
    return spark.createDataFrame(rows, "event_year INT, i INT").select(
        F.col("i").cast("bigint").alias("id"), F.when(i % 7 != 0, F.concat(F.lit("T"), i % 3)).alias("primary_type"),
        F.when(i % 5 != 0, i % 4).alias("district"), F.when(i % 6 != 0, i % 24).alias("hour_of_day"),
        (i % 2 == 0).alias("arrest"), (i % 3 == 0).alias("domestic"), i.cast("double").alias("latitude"),
        F.when(i % 11 != 0, -i.cast("double")).alias("longitude"),
        F.timestamp_seconds(i * 60).cast("timestamp_ntz").alias("event_time"), "event_year")


@pytest.fixture
def lake(spark, tmp_path):
    class Lake:
        silver, root, parts = (str(tmp_path / name) for name in ("silver", "gold", "parts"))
        schema = events(spark, (2020, 1)).schema

        def put(self, *parts, mode="append"):
            write_table(events(spark, *parts), self.silver, ["event_year"], mode)

        def refresh(self):
            written, changed = gold.refresh_changed(spark, self.silver, self.root, self.parts, self.schema)
            whole = gold.refresh_gold(spark, spark.read.schema(self.schema).parquet(self.silver), f"{self.root}-whole")
            for name, df in whole.items():
                assert sorted(map(str, written[name].select(*df.columns).collect())) == sorted(map(str, df.collect())), name
            return changed

    return Lake()


def test_only_touched_partitions_are_made_again(lake):
    lake.put((2020, 40), (2021, 30), (None, 9))
    assert lake.refresh() == ["2020", "2021", "__HIVE_DEFAULT_PARTITION__"]
    assert lake.refresh() == []
    lake.put((2021, 5), (2022, 12))
    assert lake.refresh() == ["2021", "2022"]
    lake.put((None, 3))
    assert lake.refresh() == ["__HIVE_DEFAULT_PARTITION__"]


def test_partitions_that_are_rewritten_or_gone(lake, spark):
    lake.put((2020, 40), (2021, 30))
    lake.refresh()
    lake.put((2021, 7), mode="overwrite")  # 2020 is gone, 2021 another
    assert lake.refresh() == ["2021"]
    assert gold.partition_states(spark, lake.silver).count() == 1


def test_a_run_that_fails_is_made_good(lake, spark, monkeypatch):
    lake.put((2020, 40), (2021, 30))
    monkeypatch.setattr(gold, "_written", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lake.refresh()
    monkeypatch.undo()
    assert lake.refresh() == ["2020", "2021"]


def test_untouched_partitions_are_not_read(lake, spark):
    lake.put((2020, 40), (2021, 30), (None, 2))
    silver = spark.read.schema(lake.schema).parquet(lake.silver)
    for parts, expected in ((["2021"], ["2021"]), (["2020", gold._MISSING], ["2020", gold._MISSING])):
        read = gold.gold_cells(gold.in_parts(silver, parts))
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "event_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
        files = gold.in_parts(silver, parts).select(F.input_file_name().alias("f")).distinct().collect()
        assert sorted({r["f"].split("event_year=")[1].split("/")[0] for r in files}) == sorted(expected)
    # The scan has these partitions' files alone.
    assert gold.in_parts(silver, []).count() == 0
