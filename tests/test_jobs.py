"""All jobs in order, from source files to scored rows."""

import json

from millrace import jobs
from millrace.spec import FEATURE_VIEW_COLUMNS, PREDICTION_COLUMNS, SILVER_COLUMNS
from test_ingest import SOURCE_ROW, write_source


def test_source_to_predictions(spark, tmp_path):
    source, root = tmp_path / "source", str(tmp_path / "lake")
    source.mkdir()
    kinds = ("THEFT", "BATTERY", "ARSON")
    write_source(source / "a.csv", [{
        **SOURCE_ROW, "ID": str(n), "Primary Type": kinds[n % 3], "District": f"{n % 3:03d}",
        "Date": f"{n % 12 + 1}/{n % 28 + 1}/{2020 + n % 3} {n % 12 + 1}:05:00 {'AM' if n % 2 else 'PM'}",
        "Beat": str(n % 3 * 10), "Ward": str(n % 4), "Latitude": str(41 + n % 3 / 10),
    } for n in range(300)] + [{**SOURCE_ROW, "ID": "none"}])

    def job(*argv):
        jobs.main([argv[0], "--root", root, *argv[1:]], spark)

    job("produce", "--source", str(source))
    job("ingest")
    job("clean")
    table = spark.read.parquet(f"{root}/clean")
    assert table.count() == 300 and set(table.columns) == set(SILVER_COLUMNS)
    # A second delivery changes nothing, streamed or rebuilt.
    job("produce", "--source", str(source), "--most", "50")
    job("ingest")
    raw = spark.read.parquet(f"{root}/raw")
    # Offsets go on after the first delivery's.
    assert raw.count() == 350 and raw.select("kafka_offset").distinct().count() == 350
    job("clean")
    assert spark.read.parquet(f"{root}/clean").count() == 300
    job("rebuild")
    assert spark.read.parquet(f"{root}/clean").count() == 300

    job("gold")
    assert spark.read.parquet(f"{root}/gold/type_stats").count() == 3
    job("summary")
    document = json.loads(spark.read.text(f"{root}/summary").first()[0])
    assert document["total_rows"] == 300 and document["unique_year"] == 3 and len(document["yearly_trend"]) == 3
    assert spark.read.parquet(f"{root}/gold/eda_overview").count() == 5
    job("features")
    assert tuple(spark.read.parquet(f"{root}/gold/feature_view").columns) == FEATURE_VIEW_COLUMNS
    job("train", "--models", "decision_tree", "naive_bayes", "--partitions", "4")
    assert spark.read.parquet(f"{root}/runs").count() == 2
    job("predict")
    scored = spark.read.parquet(f"{root}/gold/predictions")
    assert tuple(scored.columns) == PREDICTION_COLUMNS
    assert scored.where("actual_label = predicted_label").count() > 270
    job("compact", "--target", str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == 300
