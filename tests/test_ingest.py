"""Delimited text, messages, cleaning, deduplication."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators.clean import clean_events, complete_rows, newest_per_key
from millrace.sources import messages, text
from millrace.spec import PAYLOAD_SCHEMA, SILVER_COLUMNS, SOURCE_COLUMNS
from millrace.streaming.run import drain

SOURCE_ROW = {
    "ID": "12", "Case Number": "HX1", "Date": "05/13/2023 11:30:00 PM", "Primary Type": "THEFT",
    "Description": 'OVER, "BIG"', "Arrest": "true", "Domestic": "false", "Beat": "0111",
    "District": "011", "Ward": "", "Community Area": "12.0", "FBI Code": "06", "Year": "2023",
    "Latitude": "41.8", "Longitude": "-87.6",
}


def write_source(path, rows):
    import csv
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, SOURCE_COLUMNS, restval="")
        writer.writeheader()
        writer.writerows(rows)


def test_source_file_to_payload(spark, tmp_path):
    bad = [{"ID": "x"}, {"ID": ""}, {"Date": ""}, {"Date": "garbage"}, {"Primary Type": ""}]
    write_source(tmp_path / "a.csv", [SOURCE_ROW] + [{**SOURCE_ROW, **change} for change in bad])
    parsed = text.parse_source(text.read_source(spark, str(tmp_path)))
    assert parsed.count() == 6
    (row,) = text.admit(parsed).collect()
    assert (row["id"], row["district"], row["beat"], row["ward"], row["community_area"]) == (12, 11, 111, None, None)
    assert row["description"].startswith("OVER, ") and row["arrest"] and not row["domestic"]
    assert row["event_time_ms"] == 1684020600000
    stamped = text.stamp_ingest(text.admit(parsed))
    assert [f.split()[0] for f in PAYLOAD_SCHEMA.split(", ")] == stamped.columns


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Case Number,Remark,ID\nHZ1,x,7\n")
    raw = text.read_source(spark, str(tmp_path))
    assert tuple(raw.columns) == SOURCE_COLUMNS
    row = raw.first()
    assert (row["ID"], row["Case Number"], row["Ward"]) == ("7", "HZ1", None)
    # A file with another header must not be read by position.
    (tmp_path / "b.csv").write_text("ID,Remark,Case Number\n8,x,HZ2\n")
    with pytest.raises(Exception, match="CSV header"):
        text.read_source(spark, str(tmp_path)).collect()


def test_white_space_around_flags(spark):
    from millrace.functions.lenient import lenient_bool
    spellings = ["\ttrue", "YES\n", " 1\r", "tr ue", "\x0b", None]
    rows = spark.createDataFrame([(s,) for s in spellings], "s STRING").select(lenient_bool(F.col("s")).alias("b"))
    assert [r["b"] for r in rows.collect()] == [True, True, True, False, False, False]


def test_source_stream_equals_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(3):
        write_source(tmp_path / "in" / f"{n}.csv", [{**SOURCE_ROW, "ID": str(n * 10 + i)} for i in range(5)])
    stream = text.parse_source(text.stream_source(spark, str(tmp_path / "in"), batch_bytes=1))
    out = str(tmp_path / "out")
    drain(stream.writeStream.format("parquet").option("path", out)
          .option("checkpointLocation", str(tmp_path / "cp")))
    batch = text.parse_source(text.read_source(spark, str(tmp_path / "in")))
    assert sorted(spark.read.parquet(out).collect()) == sorted(batch.collect())


def test_origin_of_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(2):
        write_source(tmp_path / "in" / f"{n}.csv", [{**SOURCE_ROW, "ID": str(n)}])
    batch = text.with_origin(text.read_source(spark, str(tmp_path / "in")))
    assert {r["ID"]: r["source_file"][-5:] for r in batch.collect()} == {"0": "0.csv", "1": "1.csv"}
    out = str(tmp_path / "out")
    stream = text.with_origin(text.stream_source(spark, str(tmp_path / "in")))
    drain(stream.select("ID", "source_file", "source_time").writeStream.format("parquet")
          .option("path", out).option("checkpointLocation", str(tmp_path / "cp")))
    stored = spark.read.parquet(out)
    assert stored.where("source_file LIKE '%.csv' AND source_time IS NOT NULL").count() == 2


def decode(spark, values):
    rows = [(str(i).encode(), None if v is None else v.encode(), i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key BINARY, value BINARY, n BIGINT")
    sent = messages.with_envelope(df, "t", F.col("n") % 2, F.col("n"), F.lit("2024-01-01"))
    return messages.decode_messages(sent).orderBy("kafka_offset").collect()


def test_message_decoding(spark):
    good = {"id": 1, "primary_type": "A", "district": 3, "latitude": 1.5, "event_time_ms": 1700000000123}
    rows = decode(spark, [
        json.dumps(good), json.dumps(good)[:20], json.dumps({**good, "district": "north"}),
        json.dumps({"id": 4}), json.dumps({**good, "extra": 1}), None,
        '{"id": 7, "latitude": NaN}',
    ])
    assert rows[0]["id"] == 1 and str(rows[0]["event_time"]) == "2023-11-14 22:13:20.123000"
    assert str(rows[0]["event_date"]) == "2023-11-14" and rows[0]["kafka_key"] == "0"
    assert rows[1]["id"] is None and rows[1]["kafka_key"] == "1"
    assert rows[2]["id"] == 1 and rows[2]["district"] is None
    assert rows[3]["id"] == 4 and rows[3]["event_time"] is None
    assert rows[4]["id"] == 1
    assert rows[5]["id"] is None and rows[5]["kafka_offset"] == 5
    assert rows[6]["latitude"] != rows[6]["latitude"]


def test_message_round_trip(spark):
    schema = PAYLOAD_SCHEMA
    row = (9, "c", "T", None, "S", True, None, 1, 2, None, 4, "F", 2024, 1.25, -3.5, 1700000000000, 5)
    sent = messages.to_messages(spark.createDataFrame([row], schema))
    first = sent.first()
    assert first["key"] == "9" and '"description":null' in first["value"]
    back = sent.select(F.from_json("value", schema).alias("p")).select("p.*").first()
    assert tuple(back) == row


def test_kafka_stream_needs_its_connector(spark):
    with pytest.raises(AnalysisException):
        messages.kafka_messages(spark, "localhost:9092", "t")


EVENT = ("id BIGINT, primary_type STRING, district INT, latitude DOUBLE, longitude DOUBLE, "
         "event_time TIMESTAMP_NTZ, kafka_offset BIGINT, note STRING")


def events(spark, rows):
    as_text = EVENT.replace("TIMESTAMP_NTZ", "STRING")
    df = spark.createDataFrame(rows, as_text)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def test_newest_wins_with_ties_and_missing_times(spark):
    rows = events(spark, [
        (1, "A", 1, 0.0, 0.0, "2024-01-01", 1, "old"), (1, "A", 1, 0.0, 0.0, "2024-01-03", 2, "new"),
        (1, "A", 1, 0.0, 0.0, "2024-01-02", 9, "mid"),
        (2, "A", 1, 0.0, 0.0, "2024-01-01", 5, "first"), (2, "A", 1, 0.0, 0.0, "2024-01-01", 6, "later offset"),
        (3, "A", 1, 0.0, 0.0, None, 9, "no time"), (3, "A", 1, 0.0, 0.0, "2020-01-01", 1, "time"),
        (4, "A", 1, 0.0, 0.0, None, 1, "only"),
    ])
    for layout in (rows, rows.repartition(7), rows.coalesce(1)):
        kept = newest_per_key(layout, "id", ["event_time", "kafka_offset"])
        assert {r["id"]: r["note"] for r in kept.collect()} == {
            1: "new", 2: "later offset", 3: "time", 4: "only"}
    twice = newest_per_key(newest_per_key(rows, "id", ["event_time"]), "id", ["event_time"])
    assert twice.count() == 4


def test_hot_key_is_cut_before_the_shuffle(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    kept = newest_per_key(rows, "k", ["t"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert kept.count() == n - n // 3 + 1
    assert kept.where("k = 0").first()["t"] == n - 3


def test_incomplete_rows_are_dropped(spark):
    good = (1, "A", 1, 0.0, 0.0, "2024-01-01", 1, "x")
    gaps = [tuple(None if j == i else v for j, v in enumerate(good)) for i in range(5)]
    kept = complete_rows(events(spark, [good, *gaps, (2, "A", 1, float("nan"), 0.0, None, 1, "nan stays")]))
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]


def test_clean_columns_and_calendar(spark):
    fields = PAYLOAD_SCHEMA.replace("event_time_ms BIGINT", "event_time STRING")
    row = (1, "c", "T", "d", "l", True, False, 1, 2, 3, 4, "F", 2024, 1.0, 2.0, "2024-03-02 23:10:00", 5)
    df = spark.createDataFrame([row], fields).withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    cleaned = clean_events(df.withColumn("event_date", F.to_date("event_time")))
    assert tuple(cleaned.columns) == SILVER_COLUMNS
    out = cleaned.first()
    assert (out["event_year"], out["hour_of_day"], out["day_of_week"], out["month"]) == (2024, 23, 7, 3)
