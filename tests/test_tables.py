"""Table layout, compaction, counts, scratch folders."""

import os

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.plans.gold import refresh_gold
from millrace.sources import tables


def files_below(path):
    return [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_partitioned_write_gives_few_files(spark, tmp_path):
    # One year has a third of the rows; still every year is one small file here, not one per task.
    df = spark.range(0, 9000, 1, 16).withColumn(
        "year", F.when(F.col("id") % 3 == 0, 2000).otherwise(2000 + F.col("id") % 5).cast("int"))
    path = str(tmp_path / "t")
    tables.write_table(df, path, ["year"])
    assert len(files_below(path)) <= 10
    assert spark.read.parquet(path).count() == 9000


def test_a_hot_partition_is_split(spark, tmp_path):
    """Two thirds of the rows in one year: the write spreads them over several tasks."""
    df = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 3 < 2, 2000).otherwise(2001).alias("year"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        tables.write_table(df, str(tmp_path / "t"), ["year"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len(files_below(str(tmp_path / "t" / "year=2000"))) > 2


def test_compaction(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(2000).withColumn("p", (F.col("id") % 4).cast("int"))
    df.repartition(20).write.partitionBy("p").parquet(source)
    before = tables.file_inventory(spark, source).first()
    compacted = tables.compact(spark, source, target, ["p"])
    after = tables.file_inventory(spark, target).first()
    assert before["files"] == len(files_below(source)) > 40 and after["files"] <= 8
    assert after["bytes"] < before["bytes"] and after["last_commit"] >= before["last_commit"]
    assert compacted.exceptAll(df).isEmpty() and df.exceptAll(compacted).isEmpty()


def test_shuffles_are_sized_by_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(50_000), path)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    with tables.sized_shuffles(spark, path) as number:
        assert number == int(before)
    monkeypatch.setattr(tables, "SHUFFLE_TASK_BYTES", 1)
    with pytest.raises(KeyError), tables.sized_shuffles(spark, path) as number:
        assert number == int(spark.conf.get(setting)) > 100_000  # no cap
        raise KeyError
    assert spark.conf.get(setting) == before


def test_compaction_without_partitions(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(4000).repartition(100).write.parquet(source)
    assert len(files_below(source)) == 100
    assert tables.compact(spark, source, target).count() == 4000
    assert len(files_below(target)) == 1


def test_last_commits_come_from_the_listing(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("a", "b")}
    for path in paths.values():
        tables.write_table(spark.range(5).coalesce(1), path)
    rows = {r["table_name"]: r for r in tables.last_commits(spark, paths).collect()}
    assert set(rows) == {"a", "b"} and rows["a"]["files"] == 1
    assert rows["a"]["last_commit"] <= rows["b"]["last_commit"]


def test_a_new_column_shows_in_a_plain_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(2), path, mode="append")
    tables.write_table(spark.range(2, 4).withColumn("x", F.lit("a")), path, mode="append")
    assert sorted((r["id"], r["x"]) for r in tables.read_table(spark, path).collect()) == [
        (0, None), (1, None), (2, "a"), (3, "a")]


def test_a_run_clears_its_folder(spark):
    with pytest.raises(KeyError), session.scratch_run(spark) as folder:
        stored = session.materialize(spark.range(3), "inside")
        assert stored.count() == 3 and os.listdir(folder)
        raise KeyError
    assert not os.path.exists(folder)
    assert not session.scratch_path(spark, "x").startswith(folder)


def test_broadcasts_are_bounded_in_rows_and_bytes(spark):
    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString()

    wide = spark.range(3).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert hinted(session.broadcast_if_small(wide))
    assert not hinted(session.broadcast_if_small(wide, max_rows=2))
    assert not hinted(session.broadcast_if_small(wide, max_bytes=2000))


def test_overwrite_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(3), path)
    tables.write_table(spark.range(2).withColumn("x", F.lit("a")), path)
    assert tables.read_table(spark, path).columns == ["id", "x"]


def test_no_table_before_the_first_commit(spark, tmp_path):
    (tmp_path / "empty" / "_temporary").mkdir(parents=True)
    assert tables.table_if_exists(spark, str(tmp_path / "empty")) is None
    assert tables.table_if_exists(spark, str(tmp_path / "missing")) is None


def test_counts_read_no_columns(spark, tmp_path):
    tables.write_table(spark.range(7), str(tmp_path / "t"))
    counted = tables.row_counts({"t": spark.read.parquet(str(tmp_path / "t"))})
    assert counted.collect()[0]["row_count"] == 7
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().executedPlan().toString()


def test_scratch_folder_is_the_cluster_setting(spark, monkeypatch):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Conf:
        def __init__(self, **values):
            self.values = {k.replace("_", "."): v for k, v in values.items()}

        def get(self, name, default=None):
            return self.values.get(name, default)

        def set(self, name, value):
            self.values[name] = value

    class Fake:
        def __init__(self, **values):
            self.conf = Conf(**values)

    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.scratch_root(Fake(spark_master=master))
    local = Fake(spark_master="local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_materialize_keeps_types(spark):
    df = spark.range(4).select("id", (F.col("id") % 2 == 0).alias("even"), F.lit("01").alias("code"))
    stored = session.materialize(df, "t", ("even", "code"))
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(stored.collect()) == sorted(df.collect())


def test_refresh_gold(spark, tmp_path):
    rows = [(1, "A", 1, 1.0, 2.0, True, False, 3, "2024-01-01"), (2, "B", 1, 3.0, 4.0, False, None, 4, "2024-01-02")]
    silver = spark.createDataFrame(
        rows, "id BIGINT, primary_type STRING, district INT, latitude DOUBLE, longitude DOUBLE, "
              "arrest BOOLEAN, domestic BOOLEAN, hour_of_day INT, event_time STRING")
    for _ in range(2):
        gold = refresh_gold(spark, silver, str(tmp_path))
    assert gold["type_stats"].count() == 2 and gold["hourly_stats"].count() == 2
    assert gold["district_stats"].first()["avg_latitude"] == 2.0
