import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from millrace.llm import ranked
from millrace.llm.ranked import search, shared_sums, terms
from oracle import connect, difference


def brute(docs, items, limit):
    """By the definition, text by text."""
    def cut(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(ranked.TERM, lower)

    counted = [(key, Counter(cut(text))) for key, text in docs]
    counted = [(key, c) for key, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for key, text in items:
        asked.setdefault(key, set()).update(cut(text))
    rows = Counter()
    for item, wanted in asked.items():
        found = []
        for key, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in wanted if t in c)
            if score > 0:
                found.append((-score, key is not None, key or 0, key))
        for rank, row in enumerate(sorted(found, key=lambda r: r[:3])[:limit], 1):
            rows[item, rank, row[3], -row[0]] += 1
    return rows


def ours(df):
    return Counter(tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect())


@given(st.lists(st.lists(st.integers(0, 11), max_size=9), max_size=8))
@settings(max_examples=200, deadline=None)
def test_every_item_is_the_sum_of_its_terms(items):
    pairs, sums = shared_sums(items, 12)
    inside = {node: Counter([node]) for node in range(12)}
    for k, (a, b) in enumerate(pairs, 12):
        assert a < k and b < k
        inside[k] = inside[a] + inside[b]
    for item, nodes in zip(items, sums):
        assert sum((inside[node] for node in nodes), Counter()) == Counter(set(item))


def test_shared_sets_become_nodes():
    items = [[0, 1, 2, 3], [0, 1, 2, 4], [0, 1, 5]]
    pairs, sums = shared_sums(items, 6)
    assert pairs[0] == (0, 1) and sum(map(len, sums)) < sum(map(len, items))
    # Equal items are one node.
    assert [len(nodes) for nodes in shared_sums([[3, 1, 2]] * 2, 4)[1]] == [1, 1]


def test_terms_are_the_matches():
    text = "AÉ-b_c 9\x00ÀB\u0085x ＡＢ 😀ok @[`{"
    assert [t.decode() for t in terms(text)] == re.findall(ranked.TERM, "aÉ-b_c 9\x00Àb\u0085x ＡＢ 😀ok @[`{")


@pytest.mark.parametrize("limit, characters", [(50, ranked.PASS_CHARACTERS), (3, 20)])
def test_odd_rows(spark, odd_docs, limit, characters):
    items = [(1, "two WORDS a"), (2, None), (3, "..."), (None, "line same"), (4, "a"), (4, "word"), (5, "absent"), (1, "two WORDS a")]
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("item_id", "text", "7 AS doc_id", "1 AS score")
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert ours(search(odd_docs, asked, limit=limit, pass_characters=characters)) == brute(docs, items, limit)


def test_ties_come_by_key_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(ranked, "HELD", 64)
    docs = [(i, f"alpha beta {'gamma ' * (i % 3)}") for i in range(300)] + [(i, "delta") for i in range(300, 700)]
    items = [(0, "alpha gamma"), (1, "beta"), (2, "beta alpha")]
    found = search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
                   spark.createDataFrame(items, "item_id long, text string"), limit=10)
    assert ours(found) == brute(docs, items, 10)


def test_empty_tables(spark, no_docs, sf):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search(no_docs, items).count() == 0
    assert search(items.withColumnRenamed("item_id", "doc_id"), no_docs.selectExpr("doc_id AS item_id", "text")).count() == 0


def test_query_equals_sql(spark, sf):
    from millrace.llm.queries import QUERIES

    query = QUERIES["op13_ranked_search"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None
