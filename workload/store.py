"""Tables: layout, merge, schema growth, compaction, counts, freshness, result files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from millrace.operators.clean import newest_per_key
from millrace.operators.evaluation import confusion_counts, per_class_metrics
from millrace.operators.merge import merge_new_keys
from millrace.plans.gold import refresh_changed, refresh_gold
from millrace.plans.silver import rebuild_silver
from millrace.session import materialize, scratch_path
from millrace.sources import tables, text
from millrace.spec import SILVER_COLUMNS
from workload import Query
from workload.aggregate import rounded
from workload.bindings import INCIDENTS, PAYLOAD, incidents, payload, raw_events, table
from workload.evaluate import PER_CLASS, rule_predictions
from workload.ingest import SILVER_CLEAN


def _lines(spark, sf):
    # Line numbers have one digit, so this number is unique per order line.
    line_id = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return table(spark, sf, "lineitem").select(
        line_id.alias("line_id"), "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus",
        "l_shipdate", F.year("l_shipdate").alias("ship_year"))


def merge_insert_only(spark, sf):
    """A table of finished lines, then all lines merged into it: keys it has stay as they were."""
    path = scratch_path(spark, "lines")
    lines = _lines(spark, sf)
    for batch in (lines.where("l_linestatus = 'F'"), lines):
        newest = materialize(newest_per_key(batch, "line_id", ["l_shipdate"]), "newest-lines")
        merge_new_keys(newest, path, "line_id", ["ship_year"], indexed=True)
    return tables.read_table(spark, path)


def _newest(condition: str) -> str:
    return f"""SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY line_id
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
           l_linestatus DESC) AS rk FROM lines WHERE {condition}) WHERE rk = 1"""


_LINES = """lines AS (SELECT l_orderkey * 10 + l_linenumber AS line_id, l_partkey, l_suppkey,
  l_quantity, l_extendedprice, l_linestatus, l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS ship_year
FROM lineitem)"""
MERGE = f"""WITH {_LINES}, target AS ({_newest("l_linestatus = 'F'")}), source AS ({_newest("true")})
SELECT * FROM target
UNION ALL SELECT * FROM source WHERE line_id NOT IN (SELECT line_id FROM target)"""


def silver_roundtrip(spark, sf):
    """All lines written by year, overwritten without partitions, read back."""
    by_year, flat = scratch_path(spark, "by-year"), scratch_path(spark, "flat")
    tables.write_table(_lines(spark, sf), by_year, ["ship_year"])
    tables.write_table(tables.read_table(spark, by_year), flat)
    return tables.read_table(spark, flat)


def schema_evolve(spark, sf):
    """A table whose later files have a column more."""
    path = scratch_path(spark, "evolving")
    events = payload(spark, sf)
    tables.write_table(events.where("arrest").select("id", "district"), path, mode="append")
    tables.write_table(events.where("NOT arrest").select("id", "district", "ward"), path, mode="append")
    return tables.read_table(spark, path, merge_schema=True)


def compact_table(spark, sf):
    """Order lines appended in waves, as a stream leaves them: every task of every wave writes a
    sliver of every year. Then compacted; the contents stay the same."""
    scattered, compacted = scratch_path(spark, "scattered"), scratch_path(spark, "compacted")
    lines = _lines(spark, sf)
    finished = F.coalesce(F.col("l_linestatus") == "F", F.lit(False))
    for wave in (lines.where(finished), lines.where(~finished)):
        wave.write.mode("append").partitionBy("ship_year").parquet(scattered)
    return tables.compact(spark, scattered, compacted, ["ship_year"])


COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def table_counts(spark, sf):
    return tables.row_counts({name: table(spark, sf, name) for name in COUNTED})


TIMES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}


def table_freshness(spark, sf):
    return tables.freshness({name: (table(spark, sf, name), time) for name, time in TIMES.items()})


def gold_refresh(spark, sf):
    """All aggregate tables written and read back: every row's keys and measures."""
    return _gold_rows(refresh_gold(spark, incidents(spark, sf), scratch_path(spark, "gold")))


# Days of the first load; of one of them some events come later, with the other days.
FIRST_DAYS, LATE_DAY = "2024-01-20", "2024-01-03"


def gold_incremental(spark, sf):
    """The same tables from parts: after a first load of some days, only the days that an append touched are read again."""
    silver, root, parts = (scratch_path(spark, name) for name in ("days", "gold", "parts"))
    rows = incidents(spark, sf)
    late = (F.col("event_date") == LATE_DAY) & (F.col("id") % 3 == 0)
    first = (F.col("event_date") <= FIRST_DAYS) & ~late
    schema = rows.drop("event_date").withColumn("event_date", F.lit(None).cast("date")).schema
    for wave in (rows.where(first), rows.where(~first)):
        tables.write_table(wave, silver, ["event_date"], mode="append")
        written, _ = refresh_changed(spark, silver, root, parts, schema, column="event_date")
    return _gold_rows(written)


def _gold_rows(written):
    shown = {
        "type_stats": (["primary_type"], F.col("arrest_count"), F.col("frequency_bucket")),
        "district_stats": (["district"], F.col("unique_types"), F.col("top_primary_type")),
        "hourly_stats": (["hour_of_day", "primary_type"], F.lit(None), F.lit(None)),
    }
    parts = [written[name].select(
        F.lit(name).alias("table_name"), F.concat_ws(" ", *map(F.col, keys)).alias("keys"), "crime_count",
        number.cast("bigint").alias("measure"), label.cast("string").alias("label"))
        for name, (keys, number, label) in shown.items()]
    return reduce(DataFrame.unionByName, parts)


GOLD = """, typed AS (SELECT primary_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE arrest) AS arrests
  FROM incidents GROUP BY primary_type),
cells AS (SELECT district, primary_type, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY district
  ORDER BY COUNT(*) DESC, primary_type) AS rk FROM incidents GROUP BY district, primary_type)
SELECT 'type_stats' AS table_name, primary_type AS keys, n AS crime_count, arrests AS measure,
       CASE WHEN n >= 100000 THEN 'very_high' WHEN n >= 10000 THEN 'high'
            WHEN n >= 1000 THEN 'medium' ELSE 'low' END AS label FROM typed
UNION ALL SELECT 'district_stats', CAST(district AS VARCHAR), CAST(SUM(n) AS BIGINT), COUNT(primary_type),
       MAX(CASE WHEN rk = 1 THEN primary_type END) FROM cells GROUP BY district
UNION ALL SELECT 'hourly_stats', hour_of_day || ' ' || primary_type, COUNT(*), NULL, NULL
FROM incidents GROUP BY hour_of_day, primary_type"""


def silver_rebuild(spark, sf):
    """The raw table written to files, rebuilt into the clean table, read back: newest version wins."""
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    tables.write_table(raw_events(spark, sf), raw, ["event_date"])
    rebuild_silver(spark, raw, clean)
    return tables.read_table(spark, clean).select(*SILVER_COLUMNS)


def csv_roundtrip(spark, sf):
    """Per-class results written as a delimited file with a header and read back."""
    path = scratch_path(spark, "per-class")
    text.write_result(per_class_metrics(confusion_counts(rule_predictions(spark, sf))), path)
    schema = ("label DOUBLE, tp BIGINT, fp BIGINT, fn BIGINT, precision DOUBLE, recall DOUBLE, "
              "f1 DOUBLE")
    return rounded(text.read_result(spark, path, schema), "precision", "recall", "f1")


QUERIES = {
    "merge_insert_only": Query(merge_insert_only, MERGE),
    "silver_roundtrip": Query(silver_roundtrip, f"WITH {_LINES} SELECT * FROM lines"),
    "schema_evolve": Query(schema_evolve, f"""WITH {PAYLOAD}
SELECT id, district, CASE WHEN NOT arrest THEN ward END AS ward FROM payload"""),
    "compact_table": Query(compact_table, f"WITH {_LINES} SELECT * FROM lines"),
    "table_counts": Query(table_counts, " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in COUNTED)),
    "table_freshness": Query(table_freshness, " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, MAX({time}) AS latest FROM {name}"
        for name, time in TIMES.items())),
    "gold_refresh": Query(gold_refresh, f"WITH {INCIDENTS}" + GOLD),
    "gold_incremental": Query(gold_incremental, f"WITH {INCIDENTS}" + GOLD),
    "silver_rebuild": Query(silver_rebuild, SILVER_CLEAN),
    "csv_roundtrip": Query(csv_roundtrip, PER_CLASS),
}
