"""Every registered query against its SQL, on whole tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from oracle import connect, difference
from workload import load

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


# Queries registered by the text operators are compared in their own tests.
QUERIES = load()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, duck, name):
    assert difference(QUERIES[name].run(spark, str(SF)), duck, QUERIES[name].sql) is None


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_point.queries())
    assert all(query.sql for query in QUERIES.values())


def test_every_sql_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).agg({"crime_count": "sum"}).first()[0] == 1000


def test_importance_names_every_feature(spark):
    rows = entry_point.queries()["feature_importance"](spark, str(SF)).collect()
    assert len(rows) == 12
    assert sum(row["importance"] for row in rows) == pytest.approx(1.0)


def test_predict_best_scores_every_event(spark):
    scored = entry_point.queries()["predict_best"](spark, str(SF))
    assert scored.count() == 1000
    assert scored.where("predicted_label IS NULL OR predicted_label = 'UNKNOWN'").count() == 0
