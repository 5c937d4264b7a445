"""Fingerprints: equal to SQL on whole tables; nothing of a text is left out of its tree."""

from pyspark.sql import functions as F

from llm.conftest import ODD
from millrace.llm import merkle
from millrace.llm.queries import QUERIES
from oracle import connect, difference

TEXTS = [t or "" for t in ODD] + ["One. Two! Three?\nFour.\n\n\nNext section. 😀\n \n", "a\n\nb", "\n\na", "x" * 63 + ". y",
                                  "é" * 130 + "!\n", "\r\n\r\n", "no end\n\n\n"]


def test_query_equals_sql(spark, sf):
    query = QUERIES["op4_fingerprints"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None


def test_passages_make_up_the_text(spark):
    def parts(text, pattern):
        return F.regexp_extract_all(text, F.lit(pattern), 0)

    def paragraph(p):
        return F.array_join(parts(p, merkle.PASSAGES), "")

    def section(s):
        return F.array_join(F.transform(parts(s, merkle.PARAGRAPHS), paragraph), "")

    whole = F.array_join(F.transform(parts(F.col("t"), merkle.SECTIONS), section), "")
    assert spark.createDataFrame([(t,) for t in TEXTS], "t string").where(whole != F.col("t")).count() == 0


def test_equal_prints_mean_equal_texts(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS + TEXTS], "t string").select(
        "t", merkle.fingerprint(merkle.tree(F.col("t"))).alias("print")).collect()
    assert len({r["print"] for r in rows}) == len({r["t"] for r in rows})
    assert len({(r["t"], r["print"]) for r in rows}) == len({r["t"] for r in rows})


def test_branches_that_differ_locate_edits(spark):
    one = "A. B.\nC.\n\nD.\nE.\nF.\n\nG."
    other = "A. B.\nC.\n\nD.\nX.\nF.\n\nG."
    row = spark.createDataFrame([(one, other)], "a string, b string").select(
        merkle.changed(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("there"),
        merkle.changed(merkle.tree(F.col("a")), merkle.tree(F.col("a"))).alias("nowhere")).first()
    assert [(p["section"], p["paragraph"]) for p in row["there"]] == [(1, 1)]
    assert row["nowhere"] == []


def test_odd_texts(spark, odd_docs, no_docs):
    found = merkle.with_next_document(odd_docs).collect()
    assert len(found) == len(ODD) + 2
    texts = {i: t or "" for i, t in enumerate(ODD)} | {None: "no key"}
    order = [None, *range(len(ODD))]
    for r in found:
        text, after = texts[r["doc_id"]], texts[order[order.index(r["doc_id"]) - 1]]
        half = len(text) // 2
        assert r["text"] == text and r["edited"] == text[:len(text) - half] + after[:half]
    assert merkle.with_next_document(no_docs).count() == 0
    single = merkle.with_next_document(odd_docs.where("doc_id = 7")).first()
    assert single["edited"] == "a ba "


def test_rows_of_one_key_follow_each_other(spark):
    docs = spark.createDataFrame([(1, "abcd"), (1, "wxyz"), (2, "0123")], "doc_id long, text string")
    edited = {r["text"]: r["edited"] for r in merkle.with_next_document(docs).collect()}
    assert {edited["0123"], edited["abcd"], edited["wxyz"]} in (
        {"01ab", "abwx", "wx01"}, {"01wx", "wxab", "ab01"})


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op4_fingerprints"].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
