"""Toxicity: the folded table against the kernel itself, held-out accuracy, defined results for odd rows."""

import tracemalloc
from itertools import combinations

import numpy as np
import pytest

from llm.conftest import ODD
from millrace.llm import toxicity
from millrace.llm.queries import QUERIES
from workload.bindings import table

LARGER = "/root/testdata/sf0.01"


def plain_features(word, letters):
    codes = [int(letters[ord(c)]) for c in word]
    found = {}
    for places in combinations(range(len(word)), toxicity.ORDER):
        stretch = places[-1] - places[0] + 1
        if stretch <= toxicity.STRETCH and all(codes[i] for i in places):
            key = tuple(codes[i] for i in places)
            found[key] = found.get(key, 0.0) + toxicity.DECAY ** stretch
    return found


def test_margins_are_sums_over_subsequences():
    letters = toxicity._letters()
    draw = np.random.default_rng(2)
    model = toxicity.Model(draw.normal(size=1 << 5 * toxicity.ORDER).astype(np.float32), 0.25, np.zeros(1))
    model.weights[0] = 0.0  # stands for no subsequence
    words = ["", "abc", "abcd", "i-d1ot", "banana", "achlichkeit", "é" * 6, "1d10t$", "x" * 24]
    for word, margin in zip(words, model.word_margins(words, letters)):
        features = plain_features(word, letters)
        square = sum(toxicity.DECAY ** (2 * (p[-1] - p[0] + 1))
                     for p in combinations(range(len(word)), toxicity.ORDER)
                     if p[-1] - p[0] < toxicity.STRETCH and all(letters[ord(word[i])] for i in p))
        total = sum(v * model.weights[sum(c << 5 * (toxicity.ORDER - 1 - i) for i, c in enumerate(k))]
                    for k, v in features.items())
        assert margin == pytest.approx(0.25 + (total / square ** 0.5 if square else 0.0), rel=1e-4, abs=1e-4)


def test_gaps_and_inserted_characters_are_tolerated():
    clean = [f"the {a}{b} and {b}{a} went to {a}. Then {b}." for a in ("house", "river", "paper", "stone")
             for b in ("green", "light", "water", "round")]
    bad = [t + f" You {w} there." for t in clean for w in ("idiot", "clown")]
    model = toxicity.learn(clean + bad, [0] * len(clean) + [1] * len(bad))
    letters = toxicity._letters()

    def margin(text):
        words, _ = toxicity.units(text)
        return model.word_margins(words, letters).max()

    for text in ("idiot", "i-d-i-o-t", "i d i o t", "idxiot", "1di0t", "IDIOTS!", "clo.wn"):
        assert margin(text) > 0, text
    assert margin("the house went to water and stone") < 0


def test_wide_gaps_repeats_and_split_words():
    clean = [f"the {a}{b} and {b}{a} went to {a}. Then {b}." for a in ("house", "river", "paper", "stone")
             for b in ("green", "light", "water", "round")]
    bad = [t + f" You {w} there." for t in clean for w in ("idiot", "trash")]
    model = toxicity.learn(clean + bad, [0] * len(clean) + [1] * len(bad))
    letters = toxicity._letters()

    def margin(text):
        words, _ = toxicity.units(text)
        return model.word_margins(words, letters).max()

    for text in ("i--d--i--o--t", "i**d**i**o**t", "i------d------i------o------t", "iiiiddddiiiioooottttt",
                 "idi ot", "tra sh", "t r ash", "id i ot"):
        assert margin(text) > 0, text
    assert margin("the house went to water and stone") < 0


def test_held_out_accuracy(spark, sf):
    rows = {r["doc_id"]: r for r in QUERIES["op9_toxicity"].run(spark, LARGER).collect()}
    assert len(rows) == table(spark, LARGER, "documents").count()
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, LARGER, "labels").collect()}
    held = [i for i in labels if rows[i]["held_out"]]
    assert 0.2 < len(held) / len(labels) < 0.5
    assert sum(rows[i]["predicted"] == labels[i] for i in held) / len(held) > 0.93
    caught = [rows[i]["predicted"] for i in held if labels[i]]
    assert sum(caught) / len(caught) > 0.5
    assert all((r["score"] >= 0.7) == (r["predicted"] == 1) and 0 <= r["score"] <= 1 for r in rows.values())


def test_odd_texts(spark, odd_docs, no_docs):
    model = toxicity.learn(["plain words here"] * 5 + ["an idiot there"] * 5, [0] * 5 + [1] * 5)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == len(ODD) + 2
    by = {r["doc_id"]: r["score"] for r in rows}
    assert len({by[0], by[1], by[2]}) == 1
    assert all(0 <= s <= 1 for s in by.values())
    assert toxicity.score(no_docs, model).count() == 0
    assert {r["score"] for r in toxicity.score(odd_docs, None).collect()} == {0.0}
    # Nothing that could mark a class.
    assert toxicity.learn(["a", "b"], [0, 1]).bias == -1.0


def test_accents_and_other_alphabets():
    clean = [f"the {a}{b} and {b}{a} went to {a}. Then {b}." for a in ("house", "river", "paper", "stone")
             for b in ("green", "light", "water", "round")]
    bad = [t + f" You {w} there." for t in clean for w in ("idiot", "trash")]
    model = toxicity.learn(clean + bad, [0] * len(clean) + [1] * len(bad))
    letters = toxicity._letters()

    def margin(text):
        words, _ = toxicity.units(text)
        return model.word_margins(words, letters).max()

    for text in ("ídiot", "idïot", "ÌDÎÖT", "trâsh", "tr\u0301ash"):
        assert margin(text) > 0, text
    for text in ("привет мир", "こんにちは世界", "été où garçon"):
        assert margin(text) < 0, text


def test_long_words_are_counted_like_listed_ones(monkeypatch):
    letters = toxicity._letters()
    draw = np.random.default_rng(5)
    weights = np.where(draw.random(1 << 5 * toxicity.ORDER) < 0.01, draw.normal(size=1 << 5 * toxicity.ORDER), 0).astype(np.float32)
    model = toxicity.Model(weights, 0.1, np.zeros(1))
    words = ["".join(draw.choice(list("abcdefgh-é1"), n)) for n in (4, 9, 10, 14, 15, 20, 24, 24)]
    by_place = model.word_margins(words, letters)
    monkeypatch.setattr(toxicity, "LISTED", toxicity.WINDOW)
    assert model.word_margins(words, letters) == pytest.approx(by_place, rel=1e-3, abs=1e-4)
    monkeypatch.setattr(toxicity, "LISTED", 0)
    assert model.word_margins(words, letters) == pytest.approx(by_place, rel=1e-3, abs=1e-4)


def test_held_out_recall_and_precision_by_language(spark):
    """On the larger table; languages with at least 20 toxic documents held out have to reach the bound alone."""
    larger = "/root/testdata/sf0.1"
    docs, labels = table(spark, larger, "documents"), table(spark, larger, "labels")
    rows = QUERIES["op9_toxicity"].run(spark, larger).where("held_out").join(labels, "doc_id").join(
        docs.select("doc_id", "lang"), "doc_id").select("lang", "toxic", "predicted").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) / len(toxic) >= 0.9
    assert sum(r["predicted"] for r in toxic) / sum(r["predicted"] for r in rows) >= 0.95
    for lang in {r["lang"] for r in toxic}:
        own = [r["predicted"] for r in toxic if r["lang"] == lang]
        assert len(own) < 20 or sum(own) / len(own) >= 0.9, lang


def most_held(work):
    """Bytes that were allocated at once while ``work`` ran, beyond those before, and what it returned."""
    tracemalloc.start()
    try:
        found = work()
        return tracemalloc.get_traced_memory()[1], found
    finally:
        tracemalloc.stop()


def test_scoring_holds_no_word_twice():
    draw = np.random.default_rng(5)
    vocabulary = ["".join(map(chr, row)) for row in draw.integers(97, 123, size=(300, 9))]
    texts = [" ".join(draw.choice(vocabulary, 400)) + "." for _ in range(1_000)]
    model = toxicity.Model(draw.normal(size=1 << 5 * toxicity.ORDER).astype(np.float32), -0.5, np.full(10, 0.1))
    likely = toxicity.scorer(model)
    assert len(likely(texts[:1])) == 1
    held, scores = most_held(lambda: likely(texts))
    # 400,000 words of 60 bytes and more.
    assert held < 400_000 * 50
    # Scores do not hang on what is scored together, nor on what was before.
    one_by_one = toxicity.scorer(model)
    assert scores[:50] == pytest.approx([one_by_one([text])[0] for text in texts[:50]], abs=1e-9)


def test_words_are_forgotten_and_met_again(monkeypatch):
    draw = np.random.default_rng(6)
    texts = ["", "one two. idiot!", *[" ".join("".join(map(chr, row)) for row in draw.integers(97, 123, size=(40, 6)))
                                      for _ in range(30)], "idiot"]
    model = toxicity.Model(draw.normal(size=1 << 5 * toxicity.ORDER).astype(np.float32), -0.5, np.full(10, 0.1))
    whole = toxicity.scorer(model)(texts)
    monkeypatch.setattr(toxicity, "REMEMBERED", 60)
    likely = toxicity.scorer(model)
    assert np.concatenate([likely(texts[i:i + 2]) for i in range(0, len(texts), 2)]) == pytest.approx(whole, abs=1e-9)
    assert len(likely([])) == 0


def test_machine_is_solved_in_parts(monkeypatch):
    draw = np.random.default_rng(7)
    x = np.hstack([draw.normal(size=(40_000, 31)), np.ones((40_000, 1))]).astype(np.float32)
    y = np.where(x[:, 0] + 0.3 * draw.normal(size=len(x)) > 0.5, 1.0, -1.0)
    weight = np.where(y > 0, 2.0, 1.0)
    monkeypatch.setattr(toxicity, "AT_ONCE", 4_096, raising=False)
    held, w = most_held(lambda: toxicity._machine(x, y, weight))
    assert held < x.nbytes * 2
    monkeypatch.setattr(toxicity, "AT_ONCE", len(x))
    assert w == pytest.approx(toxicity._machine(x, y, weight), abs=1e-9)


def test_rows_of_words_come_in_bounded_parts(monkeypatch):
    words = [c * n for n in (3, 0, 5) for c in "abcdefg"]
    letters = toxicity._letters()
    whole = {int(place): codes.tolist() for places, rows in toxicity._rows(words, letters) for place, codes in zip(places, rows)}
    monkeypatch.setattr(toxicity, "TOGETHER", 4)
    parts = list(toxicity._rows(words, letters))
    assert max(len(places) for places, _ in parts) <= 4
    assert {int(place): codes.tolist() for places, rows in parts for place, codes in zip(places, rows)} == whole
    assert sorted(whole) == [i for i, word in enumerate(words) if word]
