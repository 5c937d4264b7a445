import hashlib
from collections import Counter, defaultdict

import pytest

from millrace.llm import prefix_trie
from millrace.llm.prefix_trie import measured, nodes
from oracle import connect, difference

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(conversations):
    """Node by node, from ``{key: [(role, text), ...]}``."""
    members = defaultdict(list)
    for key, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(key)
    rows = Counter()
    for node, inside in members.items():
        below = [u for u in members if u[:len(node)] == node]
        children = [u for u in below if len(u) == len(node) + 1]
        leaves = [u for u in below if not any(v[:-1] == u for v in members if v)]
        saved = sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in below if u)
        ends = ",".join(map(str, sorted(k for k in inside if len(conversations[k]) == len(node))))
        rows[min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children), len(leaves),
             saved, hashlib.sha256(ends.encode()).hexdigest()] += 1
    return rows


def table(spark, conversations):
    return spark.createDataFrame(
        [(key, i, role, text) for key, turns in conversations.items() for i, (role, text) in enumerate(turns)],
        "conv_id long, turn long, role string, text string")


def keys(spark, names):
    return spark.createDataFrame([(k,) for k in names], "conv_id long")


def ours(df):
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def families(n):
    """Conversations that begin alike to all depths, some of them equal, some a beginning of others, some without turns."""
    found = {}
    for i in range(n):
        turns = [("user" if d % 2 == 0 else "assistant", f"é{(i * 7 % 11) >> max(0, 3 - d)} {d}") for d in range(i * 5 % 9)]
        found[i * 3 % n if n % 3 else i] = turns
    found[n + 5] = [("user", "deep")] * 70
    found[n + 6] = [("user", "deep")] * 68 + [("user", "other")]
    return found


@pytest.mark.parametrize("shards", [1, 4, 60])
def test_equals_brute_force_for_any_number_of_shards(spark, shards):
    conversations = families(200)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(shards))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = ours(nodes(measured(table(spark, conversations)), keys(spark, conversations)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == brute(conversations)


def test_a_skeleton_too_large_to_send(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SKELETON_NODES", 0)
    conversations = families(90)
    assert ours(nodes(measured(table(spark, conversations)), keys(spark, conversations))) == brute(conversations)


def test_ends_of_many_conversations_are_hashed_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    conversations = {i: [("user", "same")] if i % 3 else [] for i in range(500)}
    assert ours(nodes(measured(table(spark, conversations)), keys(spark, conversations))) == brute(conversations)


def test_missing_values_ties_and_clashing_columns(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "b", "x"), (1, 0, "a", "y"), (1, 0, "a", "y"),
            (None, 0, "user", "nobody's"), (2, 5, "user", "first"), (2, 9, "", ""), (3, 0, "user", "x" * 300_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'k' AS key", "1 AS place", "'d' AS digest", "2 AS depth")
    expected = {1: [("user", "first"), ("", ""), ("a", "y"), ("a", "y"), ("b", "x")], 2: [("user", "first"), ("", "")],
                3: [("user", "x" * 300_000)], 4: []}
    named = keys(spark, [1, 2, 3, 4, 4, None])
    assert ours(nodes(measured(turns), named)) == brute(expected)


def test_role_and_text_do_not_run_into_each_other(spark):
    conversations = {1: [("ab", "c")], 2: [("a", "bc")]}
    assert ours(nodes(measured(table(spark, conversations)), keys(spark, conversations))) == brute(conversations)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert nodes(measured(none), none.select("conv_id")).count() == 0
    assert ours(nodes(measured(none), keys(spark, [4, 9]))) == brute({4: [], 9: []})


def test_query_equals_sql(spark, sf):
    from millrace.llm.queries import QUERIES

    query = QUERIES["op11_prefix_trie"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None
