"""Evaluation, sampling, labels, runs, training, scoring."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import evaluation, features, runs, sampling
from millrace.plans import modelling
from millrace.sources.text import read_result
from millrace.spec import PREDICTION_COLUMNS

QUICK = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def predictions(spark, pairs):
    return spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label DOUBLE, prediction DOUBLE")


# Class 2 is never predicted, class 3 is never true, class 4 is perfect.
PAIRS = [(0, 0), (0, 1), (1, 1), (1, 3), (2, 0), (2, 1), (4, 4), (4, 4), (0, 0)]


def test_per_class_metrics(spark):
    counts = evaluation.confusion_counts(predictions(spark, PAIRS))
    assert counts.agg(F.sum("n")).first()[0] == len(PAIRS)
    rated = {r["label"]: r for r in evaluation.per_class_metrics(counts).collect()}
    assert tuple(rated[0.0])[1:4] == (2, 1, 1) and rated[0.0]["precision"] == pytest.approx(2 / 3)
    assert tuple(rated[2.0])[1:] == (0, 0, 2, 0.0, 0.0, 0.0)
    assert tuple(rated[3.0])[1:] == (0, 1, 0, 0.0, 0.0, 0.0)
    assert tuple(rated[4.0])[1:] == (2, 0, 0, 1.0, 1.0, 1.0)
    listed = spark.createDataFrame([(5.0,), (0.0,)], "label DOUBLE")
    more = evaluation.per_class_metrics(counts, classes=listed)
    assert more.count() == 6 and more.where("label = 5").first()["tp"] == 0


def test_confusion_matrix(spark):
    counts = evaluation.confusion_counts(predictions(spark, PAIRS))
    matrix = evaluation.confusion_matrix(counts, [0.0, 1.0, 2.0, 3.0, 4.0])
    cells = {r["label"]: tuple(r)[1:] for r in matrix.collect()}
    assert cells[0.0] == (2, 1, 0, 0, 0, 0) and cells[2.0] == (1, 1, 0, 0, 0, 0)
    assert sum(map(sum, cells.values())) == len(PAIRS)


@QUICK
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=1, max_size=40))
def test_weighted_metrics_equal_mllib(spark, pairs):
    df = predictions(spark, pairs)
    ours = evaluation.weighted_metrics(
        evaluation.per_class_metrics(evaluation.confusion_counts(df))).first()
    for mllib, name in (("accuracy", "accuracy"), ("f1", "weighted_f1"),
                        ("weightedPrecision", "weighted_precision"), ("weightedRecall", "weighted_recall")):
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=mllib).evaluate(df))


def test_auc_equals_mllib_with_ties_and_a_class_without_rows(spark):
    rows = [(float(n * 7 % 3), [n * 31 % 10 / 10, n * 17 % 4 / 4, n / 100, 0.5]) for n in range(100)]
    df = spark.createDataFrame(rows, "label DOUBLE, scores ARRAY<DOUBLE>").repartition(3)
    areas = {r["class"]: r["auc"] for r in evaluation.auc_per_class(df).collect()}
    for number in range(3):
        binary = df.select((F.col("label") == number).cast("double").alias("label"),
                           F.col("scores")[number].alias("rawPrediction"))
        assert areas[number] == pytest.approx(BinaryClassificationEvaluator(numBins=0).evaluate(binary))
    assert areas[3] is None
    macro = evaluation.macro_auc(evaluation.auc_per_class(df)).first()
    assert macro["classes"] == 3
    assert macro["auc_ovr_macro"] == pytest.approx(sum(areas[n] for n in range(3)) / 3)
    coarse = evaluation.auc_per_class(df, digits=1).where("class = 0").first()
    assert coarse["auc"] == pytest.approx(areas[0])


def test_scores_fall_back_to_raw(spark):
    vector = Vectors.dense([0.2, 0.8])
    raw = spark.createDataFrame([(vector,)], ["rawPrediction"])
    both = spark.createDataFrame([(vector, Vectors.dense([1.0, 0.0]))], ["rawPrediction", "probability"])
    assert evaluation.scores_as_array(raw).first()["scores"] == [0.2, 0.8]
    assert evaluation.scores_as_array(both).first()["scores"] == [1.0, 0.0]


def test_match_rate_counts_equal_nulls(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, None), ("a", "b")],
                               "actual_label STRING, predicted_label STRING")
    assert evaluation.match_rate(df).first()[0] == 0.5


@pytest.mark.parametrize("portable", [False, True])
def test_sample_and_split_depend_on_the_key_alone(spark, portable):
    df = spark.range(10_000)
    once = sampling.hash_sample(df, "id", 0.2, portable=portable)
    again = sampling.hash_sample(df.repartition(9), "id", 0.2, portable=portable)
    assert 1800 < once.count() < 2200 and once.exceptAll(again).isEmpty()
    split = sampling.hash_split(df, "id", 0.8, portable=portable)
    assert 7800 < split.where("is_train").count() < 8200
    assert split.where("is_train IS NULL").isEmpty()
    # The sample and the split are independent of each other.
    inside = sampling.hash_split(once, "id", 0.8, portable=portable).where("is_train").count()
    assert 0.76 < inside / once.count() < 0.84
    assert sampling.hash_sample(df, "id", 1.0).count() == 10_000


def test_labels_and_their_numbers(spark):
    rows = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [("d",)] + [("e",)]
    df = spark.createDataFrame(rows, "primary_type STRING")
    labelled = features.with_label(df, features.top_labels(df, n=2))
    assert {tuple(r) for r in labelled.groupBy("label_raw").count().collect()} == {("a", 5), ("b", 3), ("OTHER", 5)}
    index = features.label_index(labelled)
    assert [tuple(r) for r in index.orderBy("idx").collect()] == [(0, "OTHER", 5), (1, "a", 5), (2, "b", 3)]
    decoded = features.decode_labels(
        spark.createDataFrame([(0.0,), (2.0,), (7.0,), (None,)], "prediction DOUBLE"), index)
    assert sorted(r["predicted_label"] for r in decoded.collect()) == ["OTHER", "UNKNOWN", "UNKNOWN", "b"]


def test_fill_zero_leaves_other_types(spark):
    df = spark.createDataFrame([(None, None, None)], "n INT, b BOOLEAN, s STRING")
    assert tuple(features.fill_zero(df, ["n", "b", "s"]).first()) == (0, None, None)


RAW = [
    ("r1", "rf", "0.5", 40, 10, "3.0"), ("r2", "rf", "0.7", 100, 10, None), ("r3", "rf", "0.7", 40, 15, "9"),
    ("r4", "dt", "0.6", None, 15, "1.0"), ("r5", "dt", None, None, 10, "1.0"), ("r6", "nb", "bad", None, None, "x"),
]


def logged(spark):
    raw = spark.createDataFrame(
        [(*r, datetime(2024, 1, 1 + n)) for n, r in enumerate(RAW)],
        "run_id STRING, `params.model_type` STRING, `metrics.accuracy` STRING, numTrees INT, maxDepth INT, "
        "train_seconds STRING, start_time TIMESTAMP")
    return runs.typed_runs(raw, {"params.model_type": "model_type", "metrics.accuracy": "accuracy"},
                           ["accuracy", "train_seconds"])


def test_runs(spark):
    table = logged(spark)
    assert [r["run_id"] for r in runs.best_per_model(table).collect()] == ["r2", "r4"]
    assert runs.best_run(table).first()["run_id"] == "r2"
    assert [r["run_id"] for r in runs.recent_runs(table, 2).collect()] == ["r6", "r5"]
    assert [r["run_id"] for r in runs.sweep(table, "maxDepth", "numTrees").collect()] == ["r1", "r2"]
    assert [r["run_id"] for r in runs.sweep(table, "numTrees", "maxDepth").collect()] == ["r1", "r3"]
    assert {r["run_id"] for r in runs.accuracy_time_pairs(table).collect()} == {"r1", "r3", "r4"}


def training_table(spark, n=600):
    i = F.col("id")
    return spark.range(n).select(
        "id", F.concat(F.lit("t"), F.when(i % 3 == 0, 0).otherwise(i % 8)).alias("primary_type"),
        (i % 8).cast("int").alias("district"), F.when(i % 9 != 0, (i % 8).cast("int")).alias("ward"),
        (i % 5).cast("int").alias("community_area"), (i % 8 * 10).cast("int").alias("beat"),
        (i % 24).cast("int").alias("hour_of_day"), (i % 7 + 1).cast("int").alias("day_of_week"),
        (i % 12 + 1).cast("int").alias("month"), F.lit(2024).alias("year"),
        (i % 3 * 10.0 + i % 8).cast("double").alias("latitude"), F.lit(-87.0).alias("longitude"),
        (i % 3 == 0).alias("arrest"), F.when(i % 2 == 0, True).alias("domestic"))


def test_training_logs_every_model_and_survives_a_failure(spark, tmp_path, monkeypatch):
    table, runs_path = training_table(spark), str(tmp_path / "runs")
    data = modelling.prepare(table)
    assert len(data.classes) == 6 and "OTHER" in data.classes
    assert data.train.count() + data.test.count() == 600
    build = modelling.estimator

    def sabotaged(name, *args, **kwargs):
        if name == "naive_bayes":
            return build(name, modelType="multinomial")  # refuses negative longitudes
        return build(name, *args, **{**kwargs, **({"maxIter": 2, "maxDepth": 2} if name == "gbt_ovr" else {})})

    monkeypatch.setattr(modelling, "estimator", sabotaged)
    trained = modelling.train_all(spark, data, runs_path, str(tmp_path / "models"), light=True, parallelism=3)
    logged_runs = {r["model_type"]: r for r in spark.read.parquet(runs_path).collect()}
    assert set(logged_runs) == set(modelling.PARAMS)
    assert 0 < len(logged_runs["naive_bayes"]["error"]) <= 500 and logged_runs["naive_bayes"]["accuracy"] is None
    assert logged_runs["random_forest"]["numTrees"] == 40 and logged_runs["random_forest"]["params"]["maxDepth"] == "10"
    assert logged_runs["gbt_ovr"]["auc_ovr_macro"] > 0.5
    best = logged_runs["decision_tree"]
    assert best["accuracy"] > 0.9 and best["n_rows"] == 600 and best["params"]["top_n_types"] == "5"
    def stored(name, schema):
        return read_result(spark, f"{best['model_path']}/{name}", schema)
    per_class = stored("per_class", "label STRING, tp INT, fp INT, fn INT, precision DOUBLE, recall DOUBLE, f1 DOUBLE")
    assert {r["label"] for r in per_class.collect()} == set(data.classes)
    assert per_class.agg(F.sum(F.col("tp") + F.col("fn"))).first()[0] == data.test.count()
    matrix = stored("confusion_matrix", ", ".join(f"`{c}` STRING" for c in ("actual", *data.classes, "unlisted")))
    assert matrix.count() == 6
    assert stored("feature_importance", "feature STRING, importance DOUBLE").count() == 12
    for name in ("logistic_regression", "decision_tree", "random_forest", "gbt_ovr"):
        importance = modelling.feature_importance(spark, trained[name].model).collect()
        assert len(importance) == 12
        assert [r["importance"] for r in importance] == sorted((r["importance"] for r in importance), reverse=True)

    scored = modelling.predict_best(spark, table, runs_path)
    assert tuple(scored.columns) == PREDICTION_COLUMNS and scored.count() == 600
    assert evaluation.match_rate(scored).first()[0] > 0.9
    # A type unknown at training time is OTHER, whatever is frequent in the scored table.
    strange = table.withColumn("primary_type", F.lit("new"))
    assert modelling.predict_best(spark, strange, runs_path).where("actual_label <> 'OTHER'").isEmpty()
    assert 0 < modelling.predict_best(spark, table, runs_path, fraction=0.3).count() < 300


def test_models_do_not_depend_on_the_cores(spark, tmp_path):
    """The same rows at the same places, whatever the layout of the input and the number of read tasks."""
    table = training_table(spark, 3000).withColumn("latitude", F.rand(7) * 100)
    table = table.sparkSession.createDataFrame(table.collect(), table.schema)
    found = []
    for parts, split in ((1, "128m"), (7, "8k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            data = modelling.prepare(table.repartition(parts))
            model = modelling.estimator("random_forest", numTrees=3, maxDepth=6).fit(data.train)
            found.append((model.toDebugString.split("\n", 1)[1],
                          sorted(map(tuple, modelling.evaluate(model.transform(data.test))[0].collect()))))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert found[0] == found[1]


def test_training_parts_grow_with_the_rows(spark, monkeypatch):
    assert modelling.prepare(training_table(spark)).train.rdd.getNumPartitions() == modelling.PARTITIONS
    monkeypatch.setattr(modelling, "PART_ROWS", 20)
    data = modelling.prepare(training_table(spark))
    assert data.partitions == 24 and data.train.rdd.getNumPartitions() == 24  # 0.8 of 600 rows
    assert modelling.prepare(training_table(spark), partitions=30).partitions == 30


def test_members_of_large_tables_are_fitted_one_after_the_other(spark, monkeypatch):
    data, seen, fit = modelling.prepare(training_table(spark)), [], OneVsRest._fit

    def watched(self, dataset):
        seen.append((self.getParallelism(), dataset.storageLevel.useDisk, dataset.storageLevel.useMemory))
        return fit(self, dataset)

    monkeypatch.setattr(OneVsRest, "_fit", watched)
    trees = []
    for most in (modelling.SIDE_ROWS, 600):
        monkeypatch.setattr(modelling, "SIDE_ROWS", most)
        est = modelling.estimator("gbt_ovr", parallelism=3, maxIter=2, maxDepth=2)
        trained = modelling.train_one(data, "gbt_ovr", est)
        assert "error" not in trained.run and est.getParallelism() == 3
        trees.append([member.toDebugString.split("\n", 1)[1] for member in trained.model.models])
    assert seen == [(3, True, False), (1, True, False)] and trees[0] == trees[1]
    assert modelling.side_by_side(5, 0, 16, 4) == 5
    assert modelling.side_by_side(5, 36_000_000, 144, 12) == 1
    assert modelling.side_by_side(5, 5_000_000, 25, 64) == 3  # few parts on many cores


def test_other_features_keep_their_names(spark, tmp_path):
    chosen = ("district", "latitude")
    data = modelling.prepare(training_table(spark), features=chosen)
    trained = modelling.train_all(spark, data, str(tmp_path / "runs"), str(tmp_path / "models"), ["decision_tree"])
    run = trained["decision_tree"].run
    assert run["n_features"] == 2 and "error" not in run
    names = modelling.feature_importance(spark, trained["decision_tree"].model, data.features)
    assert {r["feature"] for r in names.collect()} == set(chosen)
    assert modelling.predict_best(spark, training_table(spark), str(tmp_path / "runs")).count() == 600


def test_areas_from_counts_equal_areas_from_rows(spark):
    data = modelling.prepare(training_table(spark))
    scored = modelling.estimator("naive_bayes").fit(data.train).transform(data.test)
    _, auc = modelling.evaluate(scored)
    direct = evaluation.auc_per_class(evaluation.scores_as_array(scored))
    assert sorted(map(tuple, auc.collect())) == sorted(map(tuple, direct.collect()))


def test_the_rule_is_learnt_far_above_the_largest_class(spark):
    from workload import learn
    row = learn.train_eval("decision_tree")(spark, "/root/testdata/sf0.001").first()
    assert row["accuracy"] == 1.0 and row["majority_share"] < 0.4


def test_binary_and_unweighted_models_have_importances_or_none(spark):
    data = modelling.prepare(training_table(spark).where("primary_type IN ('t0', 't1')"))
    binary = LogisticRegression(maxIter=3).fit(data.train)
    assert modelling.feature_importance(spark, binary).count() == 12
    bayes = modelling.estimator("naive_bayes").fit(data.train)
    assert modelling.feature_importance(spark, bayes).isEmpty()


def test_no_run_to_score_with(spark, tmp_path):
    runs.append_run(spark, str(tmp_path / "runs"), {"run_id": "x", "model_type": "dt", "error": "lost"})
    with pytest.raises(RuntimeError):
        modelling.predict_best(spark, training_table(spark), str(tmp_path / "runs"))
