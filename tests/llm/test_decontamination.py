"""Decontamination against the whole edit matrix of every document and item."""

import random

import numpy as np
import pytest

from llm.conftest import ODD
from millrace.llm import decontamination
from millrace.llm.queries import QUERIES
from workload.bindings import table


def fewest_edits(pattern, text):
    """Of all passages of ``text``, row by row of the edit matrix."""
    codes = np.array([ord(c) for c in text], dtype=np.int64)
    places = np.arange(len(codes) + 1)
    row = np.zeros(len(codes) + 1, dtype=np.int64)
    for i, c in enumerate(pattern, 1):
        below = np.empty_like(row)
        below[0] = i
        below[1:] = np.minimum(row[:-1] + (codes != ord(c)), row[1:] + 1)
        row = np.minimum.accumulate(below - places) + places
    return int(row.min())


def brute(texts, items, rate):
    found = {}
    for j, body in items:
        item = decontamination.plain(body or "")
        for i, text in texts:
            words = decontamination.plain(text or "")
            if item:
                edits = fewest_edits(item, words)
                if edits <= int(rate * len(item)):
                    found[i, j] = edits
    return found


def test_query_equals_the_edit_matrix(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    rows = QUERIES["op3_decontamination"].run(spark, sf).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in rows} == brute(docs, items, decontamination.RATE)
    texts, bodies = dict(docs), dict(items)
    for r in rows:
        passage = decontamination.plain(texts[r["doc_id"]][r["start"]:r["end"]])
        item = decontamination.plain(bodies[r["item_id"]])
        assert fewest_edits(item, passage) == r["edits"]
        assert abs(len(passage) - len(item)) <= r["edits"]
    assert rows


def edited(text, n, draw):
    out = list(text)
    for _ in range(n):
        at, what = draw.randrange(len(out)), draw.randrange(3)
        out[at:at + (what != 0)] = draw.choice("abcdeé ") if what < 2 else ""
    return "".join(out)


@pytest.mark.parametrize("pass_characters", [1 << 20, 100])
def test_planted_edits(spark, pass_characters):
    draw = random.Random(7)
    bodies = ["".join(draw.choices("abcde  é", k=draw.randint(1, 220))) for _ in range(12)] + ["", None, "ab"]
    items = list(enumerate(bodies))
    texts = []
    for i in range(80):
        body = draw.choice([b for b in bodies if b and len(b) > 30])
        noise = ["".join(draw.choices("fghij  k", k=draw.randint(0, 60))) for _ in range(2)]
        texts.append((i, f"{noise[0]} {edited(body, draw.randint(0, 16), draw)} {noise[1]}"))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = decontamination.leaks(docs, spark.createDataFrame(items, "item_id long, text string"),
                                 pass_characters=pass_characters).collect()
    assert {(r["doc_id"], r["item_id"]): r["edits"] for r in rows} == brute(texts, items, decontamination.RATE)


def test_odd_texts(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "Two words"), (1, "same line same line"), (2, None)],
                                  "item_id long, text string")
    rows = decontamination.leaks(odd_docs, items).collect()
    assert sorted((r["doc_id"], r["item_id"], ODD[r["doc_id"]][r["start"]:r["end"]]) for r in rows) == [
        (6, 1, "Two words"), (6, 1, "Two words"), (13, 1, "same line\nsame line")]
    assert decontamination.leaks(no_docs, items).count() == 0
    assert decontamination.leaks(odd_docs, items.limit(0)).count() == 0
