"""URL lists: equal to SQL on whole tables, interval edges, odd rows."""

from datetime import date

from millrace.llm import url_lists
from millrace.llm.queries import QUERIES
from oracle import connect, difference

EVENTS = "list string, pattern string, kind string, event string, on date"
D = {n: date(2024, 1, n) for n in range(1, 32)}


def test_query_equals_sql(spark, sf):
    query = QUERIES["op2_url_lists"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None


def test_intervals(spark):
    rows = [("a", "x.com", "block", "added", D[3]), ("a", "x.com", "block", "removed", D[9]),
            ("a", "x.com", "block", "added", D[20]), ("a", "x.com", "block", "added", D[20]),
            ("a", "y.com", "block", "removed", D[2]), ("a", "y.com", "block", "added", D[2]),
            ("a", None, "block", "added", D[2]), ("a", "z.com", "block", "added", None)]
    found = url_lists.intervals(spark.createDataFrame(rows, EVENTS)).collect()
    assert {(r["pattern"], r["valid_from"], r["valid_to"]) for r in found} == {
        ("x.com", D[3], D[9]), ("x.com", D[20], None), ("y.com", D[2], None)}


def test_the_longest_active_pattern_decides(spark):
    events = spark.createDataFrame([
        ("spam", "x.com", "block", "added", D[1]), ("good", "a.x.com", "allow", "added", D[10]),
        ("good", "a.x.com", "allow", "removed", D[20]), ("bad", "http://a.x.com/p", "block", "added", D[12]),
        ("both", "y.com", "block", "added", D[1]), ("also", "y.com", "allow", "added", D[1])], EVENTS)
    captures = [(1, "http://A.x.com/q", D[9], 1), (2, "http://a.x.com/q", D[10], 1), (3, "http://a.x.com/q", D[19], 1),
                (4, "http://a.x.com/q", D[20], 1), (5, "http://a.x.com/p", D[12], 1), (6, "https://u@b.y.com:80/?x", D[2], 1),
                (7, "http://xx.com/", D[2], 1), (8, None, D[2], 1), (9, "http://x.com", None, 1), (10, "", D[2], 1),
                (11, "no url", D[2], 1), (1, "http://A.x.com/q", D[9], 1), (None, "http://x.com", D[31], 1)]
    rows = url_lists.evaluate(
        spark.createDataFrame(captures, "page_id long, url string, fetched_on date, blocked int"), events).collect()
    assert len(rows) == len(captures)
    by = {r["page_id"]: (r["blocked"], r["rule"], r["lists"], r["n_entries"]) for r in rows}
    assert by[1] == (True, "x.com", "spam", 1) == by[4] == by[None]
    assert by[2] == by[3] == (False, "a.x.com", "good,spam", 2)
    assert by[5] == (True, "http://a.x.com/p", "bad,good,spam", 3)
    assert by[6] == (False, "y.com", "also,both", 2)
    assert all(by[i] == (False, None, "", 0) for i in (7, 8, 9, 10, 11))
    assert sum(r["page_id"] == 1 for r in rows) == 2


def test_empty_tables(spark):
    pages = spark.createDataFrame([], "page_id long, url string, fetched_on date")
    events = spark.createDataFrame([("a", "x.com", "block", "added", D[1])], EVENTS)
    assert url_lists.evaluate(pages, events).count() == 0
    one = spark.createDataFrame([(1, "http://x.com", D[5])], "page_id long, url string, fetched_on date")
    row = url_lists.evaluate(one, events.limit(0)).first()
    assert (row["blocked"], row["n_entries"]) == (False, 0)
