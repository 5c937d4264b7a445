"""Joins by time, grouped totals, sketches, differences of tables, variants: what is at their borders."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.variants import field, parsed, undeclared
from millrace.operators import runs, sketches
from millrace.operators.ranking import running_maximum
from millrace.operators.timejoins import asof_join, interval_join
from millrace.operators.totals import LEVEL, grouped_totals, rollup_sets, table_difference


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def many_slices(spark):
    """As many slices as there are shuffle partitions, none merged."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


LEFT, RIGHT = "k STRING, t BIGINT, v BIGINT", "k STRING, t BIGINT, v BIGINT, w STRING"


def asof_brute(left, right, order=lambda r: (r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "")):
    found = Counter()
    for k, t, v in left:
        before = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t]
        top = max(before, key=lambda r: (r[1], *order(r))) if before else (None,) * 4
        found[(k, t, v, *top)] += 1
    return found


def asof(spark, left, right, **how):
    return Counter(map(tuple, asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", **how).collect()))


def test_last_row_before_over_slices_of_one_key(spark, many_slices):
    random.seed(1)
    left = [("hot", random.randrange(5_000), i) for i in range(800)] + [("cold", random.randrange(50), i) for i in range(40)]
    right = [("hot", random.randrange(5_000), i, "x") for i in range(0, 300)] + [("cold", 49, 1, None)] + [("unasked", 1, 1, "x")]
    assert asof(spark, left, right) == asof_brute(left, right)
    # A right row of the first slice reaches over all others.
    assert asof(spark, left, [("hot", 0, 7, "first")]) == asof_brute(left, [("hot", 0, 7, "first")])


def test_ties_missing_values_and_repeated_rows(spark, many_slices):
    left = [("a", 5, 1), ("a", 5, 1), ("a", 4, 2), (None, 5, 3), ("a", None, 4), ("b", 5, 5), ("c", 5, None)]
    right = [("a", 5, 1, "x"), ("a", 5, 2, "b"), ("a", 5, 2, "c"), ("a", 5, None, "z"), (None, 1, 1, "n"), ("a", None, 9, "n"), ("b", 6, 1, "x"), ("c", 5, None, None)]
    assert asof(spark, left, right) == asof_brute(left, right)
    kept = asof(spark, left, right, keep_left=False)
    assert kept == Counter({row: n for row, n in asof_brute(left, right).items() if row[4] is not None})
    assert asof(spark, left, right, order=["w"])["a", 5, 1, "a", 5, None, "z"] == 2


def test_empty_sides(spark):
    assert asof(spark, [], [("a", 1, 1, "x")]) == Counter()
    assert asof(spark, [("a", 1, 1)], []) == Counter({("a", 1, 1, None, None, None, None): 1})


def spans(n, seed, long):
    random.seed(seed)
    rows = [(i % 3, random.randrange(-10_000, 10_000), i) for i in range(n)]
    return [(k, a, a + (random.randrange(40) if i % long else random.randrange(20_000)), i) for k, a, i in rows]


SPAN = "k INT, a BIGINT, b BIGINT, i INT"


def overlaps(spark, left, right, by=("k",)):
    pair = (F.col("a"), F.col("b"))
    return interval_join(spark.createDataFrame(left, SPAN), spark.createDataFrame(right, SPAN), pair, pair, by)


def overlap_brute(left, right, by=True):
    return Counter((l[3], r[3]) for l in left for r in right if None not in (*l[1:3], *r[1:3]) and l[1] <= l[2] and r[1] <= r[2]
                   and l[1] <= r[2] and r[1] <= l[2] and (not by or l[0] == r[0] and l[0] is not None))


@pytest.mark.parametrize("long_left, long_right", [(7, 1_000), (1, 2), (1_000, 1_000)])
def test_overlaps_equal_brute_force(spark, long_left, long_right):
    left, right = spans(300, 1, long_left), spans(200, 2, long_right)
    assert Counter(map(tuple, overlaps(spark, left, right).select("i", "other_i").collect())) == overlap_brute(left, right)


def test_overlaps_of_odd_spans(spark):
    big = (1 << 60) + 1
    left = [(1, 0, 0, 1), (1, 0, 0, 1), (1, 5, 4, 2), (None, 0, 9, 3), (1, None, 3, 4), (1, -7, -1, 5), (1, big, big, 6), (1, -(1 << 50), 1 << 50, 7)]
    right = [(1, 0, 0, 1), (1, -1, 1, 2), (2, 0, 0, 3), (1, big - 1, big, 4), (1, big + 1, big + 2, 5), (1, -3, -2, 6)]
    for by in (("k",), ()):
        assert Counter(map(tuple, overlaps(spark, left, right, by).select("i", "other_i").collect())) == overlap_brute(left, right, bool(by))
    assert overlaps(spark, left, []).count() == overlaps(spark, [], right).count() == 0


def test_overlaps_are_no_nested_loop(spark):
    plan = plan_of(overlaps(spark, spans(300, 1, 7), spans(200, 2, 9), ()))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_few_long_spans_do_not_fill_short_bins(spark):
    left = [(1, i * 100, i * 100 + 10, i) for i in range(200)] + [(1, 0, 1 << 40, 999)]
    found = overlaps(spark, left, [(1, 50, 55, 0)])
    binned = found._jdf.queryExecution().executedPlan()
    assert found.count() == 1 and binned is not None
    assert Counter(map(tuple, found.select("i", "other_i").collect())) == overlap_brute(left, [(1, 50, 55, 0)])


CELLS = [("a", "x", 1.0), ("a", None, 2.0), (None, "x", 4.0), (None, None, 8.0), ("a", "x", 16.0)]


def totals(spark, rows=CELLS, sets=None):
    measures = {"n": (F.count("*"), F.sum), "top": (F.max("v"), F.max)}
    return grouped_totals(spark.createDataFrame(rows, "r STRING, c STRING, v DOUBLE"), ["r", "c"], measures, sets)


def test_missing_groups_are_told_from_totals(spark):
    found = {tuple(r)[:3]: tuple(r)[3:] for r in totals(spark).select("r", "c", LEVEL, "n", "top").collect()}
    assert found == {
        ("a", "x", ""): (2, 16.0), ("a", None, ""): (1, 2.0), (None, "x", ""): (1, 4.0), (None, None, ""): (1, 8.0),
        ("a", None, "c"): (3, 16.0), (None, None, "c"): (2, 8.0), (None, "x", "r"): (3, 16.0), (None, None, "r"): (2, 8.0),
        (None, None, "r,c"): (5, 16.0)}


def test_all_totals_come_from_cells_in_one_shuffle(spark):
    plan = plan_of(totals(spark))
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Expand") == 1
    # The expansion reads cells, not rows.
    assert plan.index("Expand") < plan.rindex("Exchange hashpartitioning")


def test_totals_of_chosen_sets_and_of_nothing(spark):
    assert {r[LEVEL] for r in totals(spark, sets=rollup_sets(["r", "c"])).collect()} == {"", "c", "r,c"}
    assert [tuple(r) for r in totals(spark, [], [["r"], ["r", "c"]]).collect()] == []


def test_sketches_of_days_merge_to_those_of_a_range(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 10).alias("d"), (F.col("id") * 7 % 20_011).alias("user"), F.sqrt("id").alias("v"),
        F.lit(None).cast("string").alias("none"))
    daily = sketches.daily_sketches(rows, F.col("d"), ["user", "none"], ["v"])
    assert daily.count() == 10
    for low, high in ((0, 9), (2, 4), (7, 7)):
        inside = F.col("day").between(low, high)
        got = sketches.merged(daily.where(inside), ["user", "none"], ["v"]).select(
            "rows", sketches.distinct_count(F.col("user_distinct")), sketches.distinct_count(F.col("none_distinct")),
            *[sketches.quantile(F.col("v_quantiles"), q) for q in (0.1, 0.5, 0.99)]).first()
        exact = rows.where(F.col("d").between(low, high))
        n, users = exact.agg(F.count("*"), F.count_distinct("user")).first()
        assert got[0] == n and abs(got[1] - users) <= sketches.DISTINCT_ERROR * users and got[2] == 0
        for share, value in zip((0.1, 0.5, 0.99), got[3:]):
            assert abs(exact.where(F.col("v") <= value).count() / n - share) <= sketches.RANK_ERROR


def test_sketches_pass_over_missing_values_and_nan(spark):
    rows = spark.createDataFrame([(1, 1.0), (1, None), (1, float("nan")), (2, None)], "d INT, v DOUBLE")
    daily = {r["day"]: r for r in sketches.daily_sketches(rows, F.col("d"), ["v"], ["v"]).select(
        "day", "rows", sketches.distinct_count(F.col("v_distinct")).alias("different"),
        F.kll_sketch_get_n_double("v_quantiles").alias("n")).collect()}
    assert daily[1]["n"] == 1 and daily[1]["rows"] == 3 and daily[1]["different"] == 2
    assert not daily[2]["n"] and daily[2]["different"] == 0


def difference(spark, one, other):
    kind = "k INT, v DOUBLE, s STRING"
    rows = table_difference(spark.createDataFrame(one, kind), spark.createDataFrame(other, kind).select("s", "v", "k")).collect()
    return {(r["k"], "nan" if r["v"] is not None and math.isnan(r["v"]) else r["v"], r["s"]): (r["missing"], r["surplus"]) for r in rows}


def test_tables_differ_as_multisets(spark):
    one = [(1, 1.0, "a")] * 3 + [(2, None, None), (3, float("nan"), "n"), (4, 0.0, "z")]
    other = [(1, 1.0, "a")] + [(2, None, None)] * 2 + [(3, float("nan"), "n"), (4, -0.0, "z"), (5, 1.0, "new")]
    assert difference(spark, one, other) == {(1, 1.0, "a"): (2, 0), (2, None, None): (0, 1), (5, 1.0, "new"): (0, 1)}
    assert difference(spark, one, one) == {} and difference(spark, [], []) == {}
    with pytest.raises(ValueError):
        table_difference(spark.range(1), spark.range(1).withColumnRenamed("id", "x"))


def test_tables_are_compared_in_one_shuffle_after_combining(spark):
    one = spark.range(100).withColumn("s", F.lit("same"))
    plan = plan_of(table_difference(one, one.where("id < 50")))
    assert plan.count("Exchange") == 1 and plan.index("partial_sum") > plan.index("Exchange")


JSON = ['{"k": 1, "x": {"y": [1, {"z": "deep"}]}, "t": null}', '{"k": "one"}', '{"k": 1', "", None, "[1, 2]", "7", '{"k": 2, "k": 3}']


def test_variants_by_path_after_a_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(JSON)], "i INT, t STRING")
    rows.select("i", parsed(F.col("t")).alias("p")).write.parquet(str(tmp_path / "v"))
    p = F.col("p")
    found = {r["i"]: tuple(r)[1:] for r in spark.read.parquet(str(tmp_path / "v")).select(
        "i", field(p, "$.k", "int"), field(p, "$.x.y[1].z", "string"), F.array_sort(F.map_keys(undeclared(p, ["k"]))), p.isNull()).collect()}
    assert found[0] == (1, "deep", ["t", "x"], False) and found[1] == (None, None, [], False)
    assert all(found[i][3] for i in (2, 3, 4)) and found[5][:3] == (None, None, None) and found[6][:3] == (None, None, None)


RUNS = [("r1", "m", 1.0, 0.5), ("r2", "m", 1.0, 0.7), ("r0", "m", 1.0, 0.7), ("r3", "m", 2.0, 0.7), ("r4", "m", 3.0, 0.9),
        ("r5", "m", None, 0.99), ("r6", "m", 4.0, None), ("r7", None, 0.1, 0.1), ("r8", "m", 9.0, 0.2)]


def test_frontier_has_the_first_of_equal_runs(spark):
    rows = spark.createDataFrame(RUNS, "run_id STRING, model_type STRING, train_seconds DOUBLE, accuracy DOUBLE")
    assert sorted(r["run_id"] for r in runs.frontier(rows).collect()) == ["r0", "r4"]
    assert runs.frontier(rows.limit(0)).count() == 0


def test_largest_so_far_over_slices(spark, many_slices):
    random.seed(3)
    values = [None if i % 5 == 0 else random.random() for i in range(600)]
    found = running_maximum(spark.createDataFrame(list(enumerate(values)), "i INT, v DOUBLE"), ["i"], "v", "m").collect()
    for r in found:
        assert r["m"] == max((v for v in values[:r["i"]] if v is not None), default=None)
    assert len(found) == 600
