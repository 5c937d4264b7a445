"""Line dedup: equal to SQL on whole tables, and to brute force on sequences full of repeats."""

import random

import pytest

from llm.conftest import ODD
from millrace.llm import lines
from millrace.llm.queries import QUERIES
from oracle import connect, difference


def test_query_equals_sql(spark, sf):
    query = QUERIES["op8_line_dedup"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None


def brute(texts, least):
    """Deleted lines per document: every run of enough words after its first place, not overlapping it."""
    begins, at = {}, 0
    for i, text in texts:
        begins[i] = at
        at += len(text.split("\n")) + 1
    first, deleted = {}, {i: set() for i, _ in texts}
    for i, text in texts:
        parts = text.split("\n")
        words = [len(p.encode().split()) for p in parts]
        for s in range(len(parts)):
            for e in range(s + 1, len(parts) + 1):
                if sum(words[s:e]) >= least:
                    p = begins[i] + s
                    if p - first.setdefault(tuple(parts[s:e]), p) >= e - s:
                        deleted[i].update(range(s, e))
    return deleted


@pytest.mark.parametrize("seed, least", [(1, 3), (2, 6), (3, 1)])
def test_random_repeats(spark, seed, least):
    draw = random.Random(seed)
    some = ["", "a", "b c", "d e f", "g", " ", "h\ti"]
    texts = []
    for i in range(40):
        if texts and draw.random() < 0.4:
            parts = draw.choice(texts)[1].split("\n")
            cut = draw.randrange(len(parts))
            parts = parts[cut:cut + draw.randint(1, 9)] + draw.choices(some, k=draw.randint(0, 4))
        else:
            parts = draw.choices(some, k=draw.randint(1, 14)) + [f"only {i}"] * draw.randint(0, 1)
        texts.append((i, "\n".join(parts)))
    rows = lines.without_later_copies(
        spark.createDataFrame(texts, "doc_id long, text string"), least_words=least).collect()
    wanted = brute(texts, least)
    assert len(rows) == len(texts)
    for r in rows:
        gone, parts = wanted[r["doc_id"]], dict(texts)[r["doc_id"]].split("\n")
        # Longer runs than the shortest ones add nothing, so both ways agree.
        assert set(r["deleted_lines"]) == gone
        assert r["text"] == "\n".join(p for k, p in enumerate(parts) if k not in gone)


def test_many_copies_and_a_long_repetition(spark):
    passage = "\n".join(f"line {i} of it" for i in range(40))
    texts = [(i, f"own {i}\n{passage}\nend {i}") for i in range(50)] + [(90, "\n".join(["ha ha"] * 300))]
    rows = {r["doc_id"]: r for r in lines.without_later_copies(
        spark.createDataFrame(texts, "doc_id long, text string"), least_words=50).collect()}
    assert rows[0]["deleted_lines"] == []
    assert all(rows[i]["text"] == f"own {i}\nend {i}" for i in range(1, 50))
    assert rows[90]["text"] == "\n".join(["ha ha"] * 25)


def test_odd_texts(spark, odd_docs, no_docs):
    found = lines.without_later_copies(odd_docs, least_words=2)
    assert found.columns == [*odd_docs.columns, "deleted_lines"]
    rows = found.collect()
    assert len(rows) == len(ODD) + 2
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["text"] is None and by[0]["text"] == "" and by[4]["text"] == "\n\n\n"
    assert by[13]["text"] == "same line" and by[13]["deleted_lines"] == [1, 2]
    # A row that stands twice is one document, so neither is a later copy.
    assert [r["text"] for r in rows if r["doc_id"] == 6] == ["Two words"] * 2
    assert by[5]["score"] == "kept"
    assert lines.without_later_copies(no_docs).count() == 0


def test_missing_keys_come_first(spark):
    texts = [(None, "one two three"), (1, "one two three"), (2, "x\none two three")]
    rows = lines.without_later_copies(
        spark.createDataFrame(texts, "doc_id long, text string"), least_words=3).collect()
    assert {(r["doc_id"], r["text"]) for r in rows} == {(None, "one two three"), (1, ""), (2, "x")}
