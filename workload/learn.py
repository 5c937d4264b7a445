"""Features, labels, samples, training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import evaluation, features, sampling, toplists
from millrace.plans import modelling
from millrace.session import materialize, scratch_path
from millrace.spec import MODEL_FEATURES, EventSpec
from workload import Query
from workload.aggregate import rounded
from workload.bindings import INCIDENTS, incidents, table

BRAND = EventSpec(type="p_brand")


def feature_view(spark, sf):
    return features.feature_view(incidents(spark, sf))


FEATURE_VIEW = f"""WITH {INCIDENTS}
SELECT id, primary_type, hour_of_day, day_of_week, month, event_year,
       CAST(day_of_week IN (1, 7) AS INTEGER) AS is_weekend,
       CAST(hour_of_day >= 22 OR hour_of_day <= 5 AS INTEGER) AS is_night,
       district, ward, community_area, beat, latitude, longitude,
       CAST(arrest AS INTEGER) AS arrest_int, CAST(domestic AS INTEGER) AS domestic_int
FROM incidents WHERE primary_type IS NOT NULL"""


def fill_zero(spark, sf):
    return features.fill_zero(incidents(spark, sf), ["ward", "community_area", "arrest"]).select(
        "id", "ward", "community_area", "arrest", "description")


def _branded(spark, sf):
    """Order lines with the brand of their part."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")


def _brand_counts(spark, sf):
    """Order lines per brand, stored. Counted per part first, so that a part with very many lines
    joins as one row."""
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    per_part = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    joined = per_part.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return materialize(joined.groupBy("p_brand").agg(F.sum("n").alias("n")), "brand-counts")


def _top_brands(counts):
    return toplists.largest(counts, "n", 5, ["p_brand"])


def _labelled(spark, sf, counts):
    return features.with_label(_branded(spark, sf), _top_brands(counts), BRAND)


def _labels(counts):
    named = features.with_label(counts, _top_brands(counts), BRAND)
    return features.label_index(named, weight="n")


LABELLED = """branded AS (
SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey),
labelled AS (SELECT *, CASE WHEN p_brand IN (SELECT p_brand FROM branded GROUP BY p_brand
  ORDER BY COUNT(*) DESC, p_brand LIMIT 5) THEN p_brand ELSE 'OTHER' END AS label_raw FROM branded),
numbered AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, label_raw) - 1 AS INTEGER) AS idx,
  label_raw AS label, COUNT(*) AS label_count FROM labelled GROUP BY label_raw)"""


def label_topn_other(spark, sf):
    return _labelled(spark, sf, _brand_counts(spark, sf))


def label_index(spark, sf):
    return _labels(_brand_counts(spark, sf))


def decode_labels(spark, sf):
    """Class numbers 0 to 7 for six classes: two stay unknown."""
    counts = _brand_counts(spark, sf)
    rows = _labelled(spark, sf, counts).withColumn(
        "prediction", (F.col("l_partkey") % 8).cast("double"))
    decoded = features.decode_labels(rows, materialize(_labels(counts), "labels"))
    return decoded.select("l_orderkey", "l_linenumber", "l_partkey", "label_raw", "predicted_label")


def hash_sample(spark, sf):
    return sampling.hash_sample(incidents(spark, sf), "id", 0.2, portable=True).select("id", "primary_type")


def hash_split(spark, sf):
    return sampling.hash_split(incidents(spark, sf), "id", 0.8, portable=True).select("id", "is_train")


def _bucket_sql(salt: str) -> str:
    return f"CAST('0x' || substr(md5(id || '{salt}'), 1, 8) AS BIGINT) % 10000"


# Columns that tell a rule's class, each for one of them; the last class has none.
TELLING = ("district", "ward", "community_area", "beat")


def ruled(spark, sf):
    """Events of five types, of which four columns tell exactly, with a wide margin: what a model
    that learns anything has to find."""
    kind = F.col("beat") % 5
    told = {name: F.when(kind == number, 10).otherwise(0) for number, name in enumerate(TELLING)}
    events = incidents(spark, sf).withColumn("primary_type", F.concat(F.lit("rule_"), kind))
    return events.withColumns(told)


RULED = f"""{INCIDENTS}, ruled AS (SELECT id, latitude, longitude, hour_of_day, day_of_week,
  'rule_' || (beat % 5) AS primary_type, CASE WHEN beat % 5 = 0 THEN 10 ELSE 0 END AS district FROM incidents)"""


def _trained(spark, sf, name, light):
    data = modelling.prepare(ruled(spark, sf), portable=True)
    trained = modelling.train_one(data, name, modelling.estimator(name, light, parallelism=5))
    if "error" in trained.run:
        raise RuntimeError(trained.run["error"])
    return data, trained


def train_eval(name: str, light: bool = False):
    """Fit on 80 % of all events; what it makes of the rest, class by class, and how good that is."""
    def run(spark, sf):
        data, trained = _trained(spark, sf, name, light)
        measured = {key: trained.run[key] for key in (
            "accuracy", "weighted_f1", "auc_ovr_macro", "majority_share", "n_rows", "n_features", "n_classes")}
        named = modelling.named_confusion(trained.confusion, data.classes)
        return rounded(named.withColumns({
            "model_type": F.lit(name), **{key: F.lit(value) for key, value in measured.items()}}), "majority_share")
    return run


def _train_eval_sql(name: str) -> str:
    return f"""WITH {RULED}, tested AS (SELECT * FROM ruled WHERE NOT ({_bucket_sql('split')} < 8000)),
counts AS (SELECT primary_type AS actual, primary_type AS predicted, COUNT(*) AS n FROM tested GROUP BY primary_type)
SELECT *, '{name}' AS model_type, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS weighted_f1, 1.0::DOUBLE AS auc_ovr_macro,
       round((SELECT MAX(n) / SUM(n) FROM counts), 6) AS majority_share, (SELECT COUNT(*) FROM ruled) AS n_rows,
       {len(MODEL_FEATURES)} AS n_features, (SELECT CAST(COUNT(DISTINCT primary_type) AS INTEGER) FROM ruled) AS n_classes
FROM counts"""


def nb_confusion(spark, sf):
    """Gaussian naive Bayes told to find latitude bands, on a split that SQL can repeat."""
    band = F.least(F.floor(F.col("latitude") / 10), F.lit(7))
    banded = incidents(spark, sf).withColumn("primary_type", F.concat(F.lit("band_"), band))
    data = modelling.prepare(banded, portable=True)
    model = modelling.estimator("naive_bayes").fit(data.train)
    return evaluation.confusion_counts(model.transform(data.test))


def _per_feature(form: str, joint: str = ", ") -> str:
    return joint.join(form.format(i=i, name=name) for i, name in enumerate(MODEL_FEATURES))


# Class priors, means and variances, every variance raised by a billionth of the largest overall one.
NB_CONFUSION = f"""WITH {INCIDENTS}, banded AS (
SELECT * REPLACE ('band_' || LEAST(CAST(floor(latitude / 10) AS INTEGER), 7) AS primary_type),
       CAST(arrest AS INTEGER) AS arrest_int, CAST(domestic AS INTEGER) AS domestic_int FROM incidents),
named AS (SELECT *, CASE WHEN primary_type IN (SELECT primary_type FROM banded GROUP BY primary_type
  ORDER BY COUNT(*) DESC, primary_type LIMIT 5) THEN primary_type ELSE 'OTHER' END AS label_raw FROM banded),
classes AS (SELECT label_raw, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, label_raw) - 1 AS class
  FROM named GROUP BY label_raw),
vectors AS (SELECT id, class, {{bucket}} < 8000 AS is_train,
  {_per_feature("CAST(COALESCE({name}, 0) AS DOUBLE) AS x{i}")} FROM named JOIN classes USING (label_raw)),
overall AS (SELECT 1e-9::DOUBLE * GREATEST({_per_feature("VAR_POP(x{i})")}) AS eps, COUNT(*) AS total
  FROM vectors WHERE is_train),
model AS (SELECT class AS guess, ln(COUNT(*) / MAX(total)) AS prior,
  {_per_feature("AVG(x{i}) AS m{i}, VAR_POP(x{i}) + MAX(eps) AS v{i}")}
  FROM vectors, overall WHERE is_train GROUP BY class),
scored AS (SELECT id, class, guess,
  prior - ({_per_feature("ln(2 * pi() * v{i}) + (x{i} - m{i}) * (x{i} - m{i}) / v{i}", " + ")}) / 2 AS score
  FROM vectors, model WHERE NOT is_train),
picked AS (SELECT class, guess, ROW_NUMBER() OVER (PARTITION BY id ORDER BY score DESC) AS rk FROM scored)
SELECT CAST(class AS DOUBLE) AS label, CAST(guess AS DOUBLE) AS prediction, COUNT(*) AS n
FROM picked WHERE rk = 1 GROUP BY class, guess"""


def feature_importance(spark, sf):
    """A rule of one column: the tree needs no other, so all importance is there."""
    events = ruled(spark, sf)
    rule = F.when(F.col("district") > 0, "inside").otherwise("outside")
    data = modelling.prepare(events.withColumn("primary_type", rule), portable=True)
    model = modelling.estimator("decision_tree").fit(data.train)
    return modelling.feature_importance(spark, model, data.features)


CHOSEN = ("decision_tree", "logistic_regression", "naive_bayes")


def _train_chosen(spark, events):
    runs_path = scratch_path(spark, "runs")
    modelling.train_all(spark, modelling.prepare(events, portable=True), runs_path,
                        modelling.new_model_root(spark), CHOSEN)
    return runs_path


def predict_best(spark, sf):
    """Train three models, then score all events with the most accurate one."""
    events = ruled(spark, sf)
    return modelling.predict_best(spark, events, _train_chosen(spark, events))


def runs_logged(spark, sf):
    """The runs of three trained models as the runs table has them, without times, ids and paths."""
    logged = spark.read.parquet(_train_chosen(spark, ruled(spark, sf)))
    return logged.select(
        "run_name", "model_type", "accuracy", "weighted_f1", "weighted_precision", "weighted_recall", "auc_ovr_macro",
        "n_rows", "n_features", "n_classes", "maxDepth", "numTrees", F.col("params")["top_n_types"].alias("top_n_types"),
        F.col("model_path").isNotNull().alias("stored"), F.col("start_time").isNotNull().alias("started"), "error")


RUNS_LOGGED = f"""WITH {RULED}, size AS (SELECT COUNT(*) AS n_rows, CAST(COUNT(DISTINCT primary_type) AS INTEGER) AS n_classes
FROM ruled)
SELECT 'model-' || model_type AS run_name, model_type, 1.0::DOUBLE AS accuracy, 1.0::DOUBLE AS weighted_f1,
       1.0::DOUBLE AS weighted_precision, 1.0::DOUBLE AS weighted_recall, 1.0::DOUBLE AS auc_ovr_macro, n_rows,
       {len(MODEL_FEATURES)} AS n_features, n_classes, depth AS "maxDepth", CAST(NULL AS INTEGER) AS "numTrees",
       '5' AS top_n_types, true AS stored, true AS started, CAST(NULL AS VARCHAR) AS error
FROM size, (VALUES ('decision_tree', 15), ('logistic_regression', NULL), ('naive_bayes', NULL)) AS chosen(model_type, depth)"""


QUERIES = {
    "feature_view": Query(feature_view, FEATURE_VIEW),
    "fill_zero": Query(fill_zero, f"""WITH {INCIDENTS}
SELECT id, COALESCE(ward, 0) AS ward, COALESCE(community_area, 0) AS community_area, arrest, description
FROM incidents"""),
    "label_topn_other": Query(label_topn_other, f"WITH {LABELLED} SELECT * FROM labelled"),
    "label_index": Query(label_index, f"WITH {LABELLED} SELECT * FROM numbered"),
    "decode_labels": Query(decode_labels, f"""WITH {LABELLED}
SELECT l_orderkey, l_linenumber, l_partkey, label_raw, COALESCE(label, 'UNKNOWN') AS predicted_label
FROM labelled LEFT JOIN numbered ON l_partkey % 8 = idx"""),
    "hash_sample": Query(hash_sample, f"""WITH {INCIDENTS}
SELECT id, primary_type FROM incidents WHERE {_bucket_sql('sample')} < 2000"""),
    "hash_split": Query(hash_split, f"""WITH {INCIDENTS}
SELECT id, {_bucket_sql('split')} < 8000 AS is_train FROM incidents"""),
    **{f"train_eval_{short}": Query(train_eval(name), _train_eval_sql(name)) for short, name in (
        ("lr", "logistic_regression"), ("dt", "decision_tree"), ("rf", "random_forest"),
        ("gbt", "gbt_ovr"), ("nb", "naive_bayes"))},
    # The smaller forest and boosting of the published comparison.
    **{f"train_light_{short}": Query(train_eval(name, light=True), _train_eval_sql(name)) for short, name in (
        ("rf", "random_forest"), ("gbt", "gbt_ovr"))},
    "nb_confusion": Query(nb_confusion, NB_CONFUSION.format(bucket=_bucket_sql("split"))),
    "feature_importance": Query(feature_importance, f"""WITH {INCIDENTS}, names AS (
SELECT unnest({list(MODEL_FEATURES)}) AS feature, (SELECT COUNT(*) FROM incidents) AS n)
SELECT feature, CASE WHEN feature = 'district' AND n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance FROM names"""),
    "predict_best": Query(predict_best, f"""WITH {RULED}
SELECT primary_type AS actual_label, primary_type AS predicted_label, district, latitude, longitude,
       hour_of_day, day_of_week FROM ruled"""),
    "runs_logged": Query(runs_logged, RUNS_LOGGED),
}
