"""Insert-only merge and the streaming jobs."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import keyindex, merge
from millrace.plans.silver import rebuild_silver
from millrace.sources.messages import file_messages, to_messages, with_envelope
from millrace.sources.tables import read_table, table_if_exists, write_table
from millrace.spec import MESSAGE_SCHEMA, PAYLOAD_SCHEMA, SILVER_COLUMNS
from millrace.streaming.ingest import ingest_writer
from millrace.streaming.run import backlog_bytes, drain, run_continuously
from millrace.streaming.upsert import batch_upsert, growing_upsert_writer, raw_table_stream, upsert_writer


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k BIGINT, v STRING, p INT")


@pytest.mark.parametrize("limit", [merge.BROADCAST_BYTES, 0])
def test_merge_keeps_what_is_there(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(merge, "BROADCAST_BYTES", limit)
    path = str(tmp_path / "t")
    assert table_if_exists(spark, path) is None
    first = keyed(spark, [(1, "a", 1), (2, "a", 2)])
    second = keyed(spark, [(2, "b", 1), (3, "b", 3)])
    for batch in (first, second, second, keyed(spark, [])):  # the third is a retry
        merge.merge_new_keys(batch, path, "k", ["p"])
    assert sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect())) == [
        (1, "a", 1), (2, "a", 2), (3, "b", 3)]


def test_merge_reports_rows_and_sizes_keys(spark, tmp_path):
    batch = keyed(spark, [(n, "x", 0) for n in range(10)])
    rows, size = merge.key_bytes(batch, "k")
    assert rows == 10 and size >= 10 * 64
    assert merge.key_bytes(batch.limit(0), "k") == (0, 0)
    assert merge.merge_new_keys(batch, str(tmp_path / "t"), "k") == 10


def test_target_is_not_shuffled_for_a_small_source(spark):
    source, target = keyed(spark, [(1, "a", 1)]), spark.range(100_000).withColumnRenamed("id", "k")
    plan = merge.unmatched(source, target, "k", source)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_stable_partitions_prune_the_target(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge.merge_new_keys(keyed(spark, [(n, "a", n % 4) for n in range(40)]), path, "k", ["p"])
    batch = keyed(spark, [(n, "b", n % 4) for n in range(0, 80, 4)])
    pruned = merge.same_partitions(batch, spark.read.parquet(path), "p")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 10 and "PartitionFilters: [isnotnull(p" in plan
    monkeypatch.setattr(merge, "MOST_PARTITIONS", 0)
    assert merge.same_partitions(batch, spark.read.parquet(path), "p").count() == 40
    monkeypatch.undo()
    merge.merge_new_keys(batch, path, "k", ["p"], stable_partitions=True)
    assert spark.read.parquet(path).groupBy("v").count().orderBy("v").collect() == [("a", 40), ("b", 10)]
    unknown = keyed(spark, [(500, "c", None)])
    for _ in range(2):
        merge.merge_new_keys(unknown, path, "k", ["p"], stable_partitions=True)
    assert spark.read.parquet(path).count() == 51


def test_missing_keys_are_merged_once(spark, tmp_path):
    path, batch = str(tmp_path / "t"), keyed(spark, [(None, "a", 1), (1, "a", 1)])
    for _ in range(3):
        merge.merge_new_keys(batch, path, "k", ["p"], indexed=True)
    assert spark.read.parquet(path).count() == 2
    plain = str(tmp_path / "plain")
    for _ in range(3):
        merge.merge_new_keys(batch, plain, "k")
    assert spark.read.parquet(plain).count() == 2


@pytest.mark.parametrize("limit", [merge.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("looked_up", [keyindex.LOOKED_UP, 0])
def test_merge_by_index_equals_merge_without(spark, tmp_path, monkeypatch, limit, looked_up):
    monkeypatch.setattr(merge, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(keyindex, "LOOKED_UP", looked_up)
    paths = str(tmp_path / "indexed"), str(tmp_path / "plain")
    for batch in ([(n * 7 % 500, "a", n % 3) for n in range(200)], [(7, "b", 1), (501, "b", 2), (None, "b", 0)],
                  [(n, "c", 1) for n in range(0, 600, 3)], [(None, "d", 1), (1, "d", 1)]):
        for path, indexed in zip(paths, (True, False)):
            merge.merge_new_keys(keyed(spark, batch).dropDuplicates(["k"]), path, "k", ["p"], indexed=indexed)
    one, other = (Counter(map(tuple, read_table(spark, path).select("k", "v", "p").collect())) for path in paths)
    assert one == other


def years(spark, start):
    """20,000 rows over seven years, their keys mixed over the whole range."""
    key = (F.col("id") * 48_271 + start) % 2_147_483_647
    return spark.range(20_000).select(key.alias("k"), F.lit("x").alias("v"), (2018 + F.col("id") % 7).cast("int").alias("p"))


def test_a_merge_writes_a_file_a_year_and_small_batches_open_few(spark, tmp_path):
    path = str(tmp_path / "t")
    for start in (0, 10**7, 2 * 10**7):
        merge.merge_new_keys(years(spark, start), path, "k", ["p"], indexed=True)
    table = read_table(spark, path)
    files = merge.table_files(table, path)
    assert table.count() == 60_000 and len(files) == 21
    # 200 keys that are spread over all files' ranges, and one year's rows of one merge.
    absent = spark.range(200).select(((F.col("id") * 9_999_991) % 2_000_000_000 + 3).alias("k"))
    opened = merge.files_of_keys(table, path, absent, "k", 200)
    assert len(opened.inputFiles()) < len(files) // 2
    there = years(spark, 0).where("p = 2019").limit(200)
    found = merge.files_of_keys(table, path, there, "k", 200)
    assert len(found.inputFiles()) < len(files) // 2 and found.join(there.select("k"), "k").count() == 200
    merge.merge_new_keys(there.withColumn("v", F.lit("again")), path, "k", ["p"], indexed=True)
    assert read_table(spark, path).count() == 60_000


def test_files_that_no_index_knows_are_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.merge_new_keys(keyed(spark, [(1, "a", 1)]), path, "k", ["p"], indexed=True)
    write_table(keyed(spark, [(2, "a", 1)]), path, ["p"], "append")  # a run that ended before its index was written
    merge.merge_new_keys(keyed(spark, [(1, "b", 1), (2, "b", 1), (3, "b", 2)]), path, "k", ["p"], indexed=True)
    assert {(r["k"], r["v"]) for r in read_table(spark, path).collect()} == {(1, "a"), (2, "a"), (3, "b")}


def test_filters_have_no_false_misses_and_few_false_hits(spark, tmp_path):
    rows = spark.range(10_000).select((F.col("id") * 2).alias("k"))
    rows.coalesce(1).sortWithinPartitions("k").write.parquet(str(tmp_path / "t"))
    path = str(tmp_path / "t")
    listed = merge.table_files(spark.read.parquet(path), path)
    keyindex.add_files(spark, path, listed, "k")
    index = spark.read.parquet(f"{path}/{keyindex.FOLDER}")
    assert index.count() == 7  # pages
    def hits(keys):
        return [k for k in keys if keyindex.files_with(spark, path, listed, spark.createDataFrame([(k,)], "k BIGINT"), "k", 1)]
    assert hits(range(0, 20_000, 2_500)) == list(range(0, 20_000, 2_500))
    asked = spark.range(10_000).select((F.col("id") * 2 + 1).alias("k")).withColumn("positions", keyindex._positions(F.col("k")))
    false = index.join(asked, F.col("k").between(F.col("low"), F.col("high"))).where(
        F.forall("positions", lambda p: keyindex._has(F.col("bits"), p))).count()
    assert false <= 20


def test_columns_are_noted_and_no_footer_is_opened_for_them(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(keyed(spark, [(1, "a", 1)]), path, ["p"])
    write_table(keyed(spark, [(2, "a", 1)]).withColumn("new", F.lit(5)), path, ["p"], "append")
    (tmp_path / "t" / "p=1" / "part-broken.parquet").write_bytes(b"no parquet at all")
    assert read_table(spark, path).columns == ["k", "v", "new", "p"]  # the plan needs no file
    (tmp_path / "t" / "p=1" / "part-broken.parquet").unlink()
    assert {(r["k"], r["new"]) for r in read_table(spark, path).collect()} == {(1, None), (2, 5)}
    with pytest.raises(ValueError, match="new"):
        write_table(keyed(spark, [(3, "a", 1)]).withColumn("new", F.lit("text")), path, ["p"], "append")
    write_table(keyed(spark, [(9, "z", 1)]), path)
    assert read_table(spark, path).columns == ["k", "v", "p"]


def test_an_append_to_a_table_without_a_note_keeps_its_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    keyed(spark, [(1, "a", 1)]).withColumn("old", F.lit(1)).write.parquet(path)
    write_table(keyed(spark, [(2, "b", 1)]).withColumn("new", F.lit(2)), path, mode="append")
    assert set(read_table(spark, path).columns) == {"k", "v", "p", "old", "new"}


def payload(spark, ids, note, hour=10):
    rows = [(i, f"c{i}", "T", note, "L", True, False, 1, 2, 3, 4, "F", 2024, 1.0, 2.0,
             int(datetime(2024 + i % 2, 1, 1 + i % 3, hour).timestamp() * 1000), i) for i in ids]
    return spark.createDataFrame(rows, PAYLOAD_SCHEMA)


def send(spark, folder, ids, note, hour=10, mode="append"):
    number = F.col("key").cast("bigint")
    sent = with_envelope(to_messages(payload(spark, ids, note, hour)), "t", number % 2, number,
                         F.lit("2024-01-01"))
    sent.coalesce(1).write.mode(mode).parquet(folder)


class Pipeline:
    def __init__(self, spark, root):
        self.spark, self.sent = spark, f"{root}/sent"
        self.raw, self.clean = f"{root}/raw", f"{root}/clean"
        self.raw_cp, self.clean_cp = f"{root}/raw-cp", f"{root}/clean-cp"

    def run(self):
        drain(ingest_writer(file_messages(self.spark, self.sent, 1), self.raw, self.raw_cp))
        drain(upsert_writer(raw_table_stream(self.spark, self.raw, 1), self.clean, self.clean_cp))
        return self.spark.read.parquet(self.clean)


def test_stream_with_overlaps_restart_and_an_empty_batch(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    send(spark, pipeline.sent, range(0, 10), "first")
    assert pipeline.run().count() == 10
    # A restart continues from the checkpoints: overlapping keys, then a file without rows.
    send(spark, pipeline.sent, range(5, 15), "second", hour=20)
    spark.createDataFrame([], MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(pipeline.sent)
    clean = pipeline.run()
    assert clean.count() == 15 and clean.select("id").distinct().count() == 15
    assert {r["id"] for r in clean.where("description = 'second'").collect()} == set(range(10, 15))
    # Nothing new: nothing written.
    assert pipeline.run().count() == 15
    assert spark.read.parquet(pipeline.raw).count() == 20
    # The batch rebuild keeps the newest version instead.
    rebuilt = str(tmp_path / "rebuilt")
    assert rebuild_silver(spark, pipeline.raw, rebuilt) == 15
    newest = spark.read.parquet(rebuilt).where("description = 'second'")
    assert {r["id"] for r in newest.collect()} == set(range(5, 15))


def test_batch_equals_stream_for_unique_keys(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    for start in (0, 10, 20):
        send(spark, pipeline.sent, range(start, start + 10), "once")
    streamed = pipeline.run().select(*SILVER_COLUMNS)
    rebuild_silver(spark, pipeline.raw, str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch")).select(*SILVER_COLUMNS)
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()


def test_repeated_batch_adds_nothing(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    send(spark, pipeline.sent, range(6), "x")
    pipeline.run()
    again = batch_upsert(pipeline.clean)
    for _ in range(2):
        again(spark.read.parquet(pipeline.raw), 7)
    assert spark.read.parquet(pipeline.clean).count() == 6


def test_rebuild_without_complete_rows_keeps_the_old_table(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    send(spark, pipeline.sent, range(3), "x")
    pipeline.run()
    empty = str(tmp_path / "none")
    spark.read.parquet(pipeline.raw).withColumn("latitude", F.lit(None).cast("double")).write.parquet(empty)
    with pytest.raises(RuntimeError):
        rebuild_silver(spark, empty, pipeline.clean)
    assert spark.read.parquet(pipeline.clean).count() == 3


@pytest.mark.parametrize("writers", [1, 2])
def test_writers_per_date(spark, tmp_path, writers):
    pipeline = Pipeline(spark, tmp_path)
    for start in range(0, 400, 100):
        send(spark, pipeline.sent, range(start, start + 100), "x")
    drain(ingest_writer(file_messages(spark, pipeline.sent), pipeline.raw, pipeline.raw_cp, writers))
    raw = spark.read.parquet(pipeline.raw)
    dates = raw.select("event_date").distinct().count()
    assert raw.count() == 400 and dates == 6 and len(raw.inputFiles()) <= dates * writers


def test_continuous_run(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    send(spark, pipeline.sent, range(4), "x")
    query = run_continuously(
        ingest_writer(file_messages(spark, pipeline.sent), pipeline.raw, pipeline.raw_cp), 1)
    try:
        query.processAllAvailable()
        assert spark.read.parquet(pipeline.raw).count() == 4
    finally:
        query.stop()


def test_a_running_stream_takes_in_a_new_column(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    fields = PAYLOAD_SCHEMA.split(", ")
    without = ", ".join(f for f in fields if not f.startswith("ward "))

    def ingest(schema):
        drain(ingest_writer(file_messages(spark, pipeline.sent), pipeline.raw, pipeline.raw_cp, payload_schema=schema))

    send(spark, pipeline.sent, range(4), "before")
    ingest(without)
    query = run_continuously(growing_upsert_writer(spark, pipeline.raw, pipeline.clean, pipeline.clean_cp), 1)
    try:
        query.processAllAvailable()
        assert "ward" not in read_table(spark, pipeline.clean).columns
        send(spark, pipeline.sent, range(2, 8), "after")
        ingest(PAYLOAD_SCHEMA)
        query.processAllAvailable()
    finally:
        query.stop()
    rows = {r["id"]: r["ward"] for r in read_table(spark, pipeline.clean).collect()}
    assert set(rows) == set(range(8)) and {i for i, ward in rows.items() if ward is None} == set(range(4))
    # Started again, it goes on behind what it has seen.
    drain(growing_upsert_writer(spark, pipeline.raw, pipeline.clean, pipeline.clean_cp))
    assert read_table(spark, pipeline.clean).count() == 8


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_pages_are_made_as_rows_are_read(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    key = F.when(F.col("id") % 50 != 0, F.col("id")).cast(kind)
    odd = F.when(F.col("id") == 7, F.lit("NaN").cast("double")).otherwise(key) if kind == "double" else key
    rows = spark.range(8_000).select(odd.alias("k"), (F.col("id") % 2).alias("p"))
    rows.coalesce(2).sortWithinPartitions("p", "k").write.partitionBy("p").parquet(path)
    table = spark.read.parquet(path)
    made = keyindex.pages(table, path, "k")
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange hash" not in plan  # neither a file nor its positions are sorted or dealt out
    found = {(r["file"], r["page"]): (r["low"], r["high"], r["missing"], bytes(r["bits"])) for r in made.collect()}
    placed = table.select(F.substring_index(F.input_file_name(), "/t/", -1).alias("file"), F.floor(F.col("_metadata.row_index") / keyindex.PAGE).alias("page"),
                          "k", F.explode(keyindex._positions(F.col("k"))).alias("position"))
    wanted = placed.groupBy("file", "page").agg(
        F.min("k").alias("low"), F.max("k").alias("high"), (F.count_if(F.col("k").isNull()) / keyindex.POSITIONS).cast("int").alias("missing"),
        F.bitmap_construct_agg("position").alias("bits")).collect()
    assert {(r["file"], r["page"]) for r in wanted} == set(found) and len(wanted) == 8
    for r in wanted:
        assert str(found[r["file"], r["page"]]) == str((r["low"], r["high"], r["missing"], bytes(r["bits"])))


def test_a_long_backlog_is_drained_in_few_batches(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    assert backlog_bytes(spark, str(path), 5) == 5
    for n in range(64):
        (path / f"part-{n}.parquet").write_bytes(b"x" * 1_000)
    assert backlog_bytes(spark, str(path), 5_000) == 5_000  # a short one in batches as small as asked for
    assert backlog_bytes(spark, str(path), 10) == 4_000


def test_a_drained_backlog_of_many_files_stays_whole(spark, tmp_path):
    pipeline = Pipeline(spark, tmp_path)
    for start in range(0, 400, 10):
        send(spark, pipeline.sent, range(start, start + 12), "x")
    query = ingest_writer(file_messages(spark, pipeline.sent, backlog_bytes(spark, pipeline.sent, 1)), pipeline.raw, pipeline.raw_cp)
    run = query.trigger(availableNow=True).start()
    run.awaitTermination()
    assert 8 <= sum(p["numInputRows"] > 0 for p in run.recentProgress) <= 20  # 40 files, which are 40 batches by their bytes
    drain(upsert_writer(raw_table_stream(spark, pipeline.raw, backlog_bytes(spark, pipeline.raw, 1)), pipeline.clean, pipeline.clean_cp))
    clean = read_table(spark, pipeline.clean)
    assert clean.count() == 402 and clean.select("id").distinct().count() == 402


def test_sent_messages_come_in_files_of_bounded_size(spark, monkeypatch):
    from workload import stream

    monkeypatch.setattr(stream, "FILE_ROWS", 300)
    sent = spark.read.parquet(stream._sent_messages(spark, "/root/testdata/sf0.001"))
    files = sent.groupBy(F.input_file_name()).count()
    assert files.count() >= 6 and files.agg(F.max("count")).first()[0] <= 300
    assert sent.count() == 1334 and sent.select("offset").distinct().count() == 1334  # 1,000 events, 334 of them twice
