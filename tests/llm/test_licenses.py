"""License scans against a search of every place, and the base columns against SQL."""

import re

import pytest

from llm.conftest import ODD
from millrace.llm import licenses
from millrace.llm.queries import QUERIES
from oracle import connect, difference
from workload.bindings import table


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.span()) for m in re.finditer(licenses.WORD, lower)]


def brute_places(text):
    """``(first word, label)`` of every place of every phrase."""
    words = [w for w, _ in words_of(text)]
    return sorted((i, label) for phrase, label in licenses.PHRASES for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split())


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def nearest(pattern, text):
    """Fewest edits that turn any stretch of the text into the pattern."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        before, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return min(row)


def scanned(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in licenses.scan(docs).collect()}


def notices(row):
    return sorted((f["label"], f["edits"]) for f in row["findings"] if not f["exact"])


def edited(text, places):
    for at, to in sorted(places, reverse=True):
        text = text[:at] + to + text[at + 1:]
    return text


def test_places_of_phrases_equal_brute_force(spark):
    texts = ["cc by cc-by CC BY, ccby", "All rights\nreserved all rights reserved", "xcc by", "cc byé", "General Public\x00License.", "cc by" * 3] + ODD
    found = scanned(spark, texts)
    for i, text in enumerate(texts):
        assert found[i]["n_words"] == len(words_of(text))
        assert sorted((f["first_word"], f["label"]) for f in found[i]["findings"] if f["exact"]) == brute_places(text), text


def test_notices_with_as_many_errors_as_allowed(spark):
    texts, expected = [], []
    for body, label in licenses.NOTICES:
        errors = len(body) // licenses.CHARACTERS_PER_ERROR
        step = len(body) // (errors + 1)
        for n in (0, 1, errors, errors + 3):
            # Letters doubled, dropped and changed in turn, spread over the notice.
            places = [((k + 1) * step if k < errors else 2 + 5 * (k - errors), ("zz", "", "q")[k % 3]) for k in range(n)]
            changed = edited(body, places)
            texts.append(f"before it. {changed.title()}, after")
            expected.append((label, nearest(body, " before it " + changed + " after "), errors))
    found = scanned(spark, texts)
    for i, (label, edits, errors) in enumerate(expected):
        own = [e for name, e in notices(found[i]) if name == label]
        assert (own == [] if edits > errors else len(own) == 1 and edits <= own[0] <= errors), (texts[i], label, edits, own)


def test_spans_are_the_texts_own(spark):
    text = "é 😀 — Licensed under the  APACHE License,\nVersion 2.0! All Rights Reserved"
    row = scanned(spark, [text])[0]
    shown = {f["label"]: text[f["start"]:f["end"]] for f in row["findings"]}
    assert shown["reserved"] == "All Rights Reserved" and shown["apache-notice"] == "Licensed under the  APACHE License,\nVersion 2.0"
    words = words_of(text)
    for f in row["findings"]:
        assert (words[f["first_word"]][1][0], words[f["last_word"]][1][1]) == (f["start"], f["end"])
        assert f["score"] == 1.0 - f["edits"] / 1e9 if f["exact"] else 0 < f["score"] <= 1


def test_a_notice_far_into_a_very_long_text_and_twice(spark):
    notice = "released under the mit license"
    text = "filler words " * 40_000 + notice + " x" * 50_000 + " relesed undr the mit license"
    found = notices(scanned(spark, [text])[0])
    assert found == [("mit-notice", 0), ("mit-notice", 2)]


def test_odd_rows(spark, odd_docs, no_docs):
    rows = licenses.scan(odd_docs).collect()
    assert len(rows) == len(ODD) + 2 and all(r["findings"] == [] for r in rows)
    assert licenses.scan(odd_docs).columns == ["doc_id", "n_words", "findings"]
    assert {r["n_words"] for r in rows if r["doc_id"] in (0, 1, 2)} == {0}
    assert sum(r["doc_id"] is None for r in rows) == 1
    assert licenses.scan(no_docs).count() == 0
    assert licenses.scan(odd_docs, phrases=(), notices=()).count() == len(ODD) + 2


def test_labels_of_the_query_are_those_of_all_findings(spark, sf):
    docs = table(spark, sf, "documents")
    found = {r["doc_id"]: r["findings"] for r in licenses.scan(docs).collect()}
    for row in QUERIES["op10_license_scan"].run(spark, sf).collect():
        own = found[row["doc_id"]]
        assert row["labels"] == ",".join(sorted({f["label"] for f in own}))
        assert row["score"] == max((f["score"] for f in own), default=0.0)
        assert len(row["notices"]) == sum(not f["exact"] for f in own)


@pytest.mark.parametrize("name", ["op10_license_scan"])
def test_base_columns_equal_sql(spark, sf, name):
    from millrace.llm.queries import OP10_BASE_SQL

    base = QUERIES[name].run(spark, sf).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert difference(base, connect(sf), OP10_BASE_SQL) is None


def test_fuzzy_labels_equal_a_search_of_short_texts(spark, sf):
    texts = [r["text"] for r in table(spark, sf, "documents").collect() if len(r["text"] or "") < 400]
    found = scanned(spark, texts)
    for i, text in enumerate(texts):
        plain = " " + " ".join(w for w, _ in words_of(text)) + " "
        expected = {label for body, label in licenses.NOTICES if nearest(body, plain) <= len(body) // licenses.CHARACTERS_PER_ERROR}
        assert {label for label, _ in notices(found[i])} == expected, text
