"""The table of model runs, with one run derived from every event."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import reshape, runs
from millrace.session import materialize
from workload import Query
from workload.bindings import table

RENAMES = {
    "params.model_type": "model_type", "params.numTrees": "numTrees", "params.maxDepth": "maxDepth",
    "metrics.accuracy": "accuracy", "metrics.weighted_f1": "weighted_f1",
    "metrics.train_seconds": "train_seconds",
}
NUMBERS = ("accuracy", "weighted_f1", "train_seconds", "numTrees", "maxDepth")


def logged_runs(spark, sf):
    """Runs as a tracker logs them: everything text, some accuracies missing or unreadable."""
    i, k = F.col("event_id"), F.col("k")
    # A column of its own, so that the text is parsed once per row.
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    logged = events.select(
        F.concat(F.lit("run-"), i).alias("run_id"),
        F.col("ts").alias("start_time"),
        F.col("event_type").alias("params.model_type"),
        F.when(i % 11 != 0, ((k % 5 + 1) * 10).cast("string")).alias("params.numTrees"),
        F.when(i % 7 != 0, (F.col("user_id") % 4 + 5).cast("string")).alias("params.maxDepth"),
        F.when(i % 17 == 0, "n/a").when(i % 19 != 0, (F.col("value") / 1000).cast("string"))
         .alias("metrics.accuracy"),
        ((k * 7 % 100) / 100).cast("string").alias("metrics.weighted_f1"),
        F.when(i % 23 != 0, (k + 0.5).cast("string")).alias("metrics.train_seconds"),
    )
    return runs.typed_runs(logged, RENAMES, NUMBERS)


LOGGED = """logged AS (
SELECT 'run-' || event_id AS run_id, ts AS start_time, event_type AS model_type,
       CASE WHEN event_id % 11 <> 0 THEN CAST((k % 5 + 1) * 10 AS DOUBLE) END AS "numTrees",
       CASE WHEN event_id % 7 <> 0 THEN CAST(user_id % 4 + 5 AS DOUBLE) END AS "maxDepth",
       CASE WHEN event_id % 17 <> 0 AND event_id % 19 <> 0 THEN value / 1000 END AS accuracy,
       CAST(k * 7 % 100 AS DOUBLE) / 100 AS weighted_f1,
       CASE WHEN event_id % 23 <> 0 THEN CAST(k AS DOUBLE) + 0.5::DOUBLE END AS train_seconds
FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events)),
done AS (SELECT * FROM logged WHERE accuracy IS NOT NULL AND model_type IS NOT NULL)"""
_BEST = """best AS (SELECT * EXCLUDE (rk) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY model_type
  ORDER BY accuracy DESC, run_id) AS rk FROM done) WHERE rk = 1)"""


def runs_best(spark, sf):
    return runs.best_per_model(logged_runs(spark, sf))


def runs_best_overall(spark, sf):
    return runs.best_run(logged_runs(spark, sf))


def runs_recent(spark, sf):
    return runs.recent_runs(logged_runs(spark, sf))


def runs_sweep(spark, sf):
    """Both slices: trees varied at the usual depth, depth varied at the usual number of trees."""
    # The table of runs is a stored one; each slice reads the columns it needs from it.
    logged = materialize(logged_runs(spark, sf), "logged-runs")
    slices = [runs.sweep(logged, fixed, varied).withColumn("varied", F.lit(varied))
              for fixed, varied in (("maxDepth", "numTrees"), ("numTrees", "maxDepth"))]
    return slices[0].unionByName(slices[1])


def _sweep_sql(fixed: str, varied: str) -> str:
    return (f"""SELECT *, '{varied}' AS varied FROM done WHERE "{fixed}" = (SELECT "{fixed}" FROM done """
            f"""WHERE "{fixed}" IS NOT NULL GROUP BY "{fixed}" ORDER BY COUNT(*) DESC, "{fixed}" LIMIT 1)""")


def runs_pairs(spark, sf):
    return runs.accuracy_time_pairs(logged_runs(spark, sf))


def runs_frontier(spark, sf):
    return runs.frontier(logged_runs(spark, sf))


def metrics_melt(spark, sf):
    return reshape.melt(runs_best(spark, sf), ["model_type"], ["accuracy", "weighted_f1"])


QUERIES = {
    "runs_best": Query(runs_best, f"WITH {LOGGED}, {_BEST} SELECT * FROM best"),
    "runs_best_overall": Query(
        runs_best_overall, f"WITH {LOGGED} SELECT * FROM done ORDER BY accuracy DESC, run_id LIMIT 1"),
    "runs_recent": Query(
        runs_recent, f"WITH {LOGGED} SELECT * FROM logged ORDER BY start_time DESC, run_id LIMIT 50"),
    "runs_sweep": Query(runs_sweep, f"""WITH {LOGGED}
{_sweep_sql('maxDepth', 'numTrees')} UNION ALL {_sweep_sql('numTrees', 'maxDepth')}"""),
    "runs_pairs": Query(runs_pairs, f"""WITH {LOGGED}
SELECT run_id, model_type, train_seconds, accuracy FROM done WHERE train_seconds IS NOT NULL"""),
    "runs_frontier": Query(runs_frontier, f"""WITH {LOGGED},
timed AS (SELECT run_id, model_type, train_seconds, accuracy, ROW_NUMBER() OVER (
  PARTITION BY train_seconds ORDER BY accuracy DESC, run_id) AS place FROM done WHERE train_seconds IS NOT NULL)
SELECT run_id, model_type, train_seconds, accuracy FROM timed t WHERE place = 1 AND NOT EXISTS (
  SELECT 1 FROM timed o WHERE o.train_seconds < t.train_seconds AND o.accuracy >= t.accuracy)"""),
    "metrics_melt": Query(metrics_melt, f"""WITH {LOGGED}, {_BEST}
SELECT model_type, 'accuracy' AS metric, accuracy AS value FROM best
UNION ALL SELECT model_type, 'weighted_f1', weighted_f1 FROM best"""),
}
