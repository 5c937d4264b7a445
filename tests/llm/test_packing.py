"""Packing: an exact round trip, ids of the tokenizers library, and the cheapest cuts by brute force."""

import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm.conftest import ODD
from millrace.llm import packing
from millrace.llm.queries import QUERIES, packed
from workload.bindings import table


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*found.encode(text or "", add_special_tokens=False).ids, 0]


def check(rows, texts, library, size=1024):
    """Every id lies in one piece, sequences are gapless; returns padding and tokens."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        ids = library(texts[i])
        pieces.sort(key=lambda r: r["start"])
        assert sum((np.frombuffer(r["ids"], "<u4").tolist() for r in pieces), []) == ids
        assert [r["start"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces]])[:-1].tolist()
        assert {r["doc_tokens"] for r in pieces} == {len(ids)}
    lengths = []
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = np.cumsum([0, *[r["length"] for r in pieces]])
        assert [r["offset"] for r in pieces] == ends[:-1].tolist()
        lengths.append(int(ends[-1]))
    assert max(lengths) <= size
    return sum(0 if n & (n - 1) == 0 else size - n for n in lengths), sum(lengths)


def test_round_trip_and_padding(spark, sf, library):
    docs = table(spark, sf, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    padding, tokens = check(packed(docs).collect(), texts, library)
    assert padding < 0.02 * tokens
    names = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
    assert QUERIES["op7_packing"].run(spark, sf).columns == names


def test_ids_equal_the_library(library):
    encode = packing.Encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN)
    draw = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(draw.choices("ab .,é\n\t 1' \u0085\x1c😀", k=draw.randint(0, 60)))
                                      for _ in range(400)]
    for _ in range(2):  # the second time from memory
        for text, (ids, ends) in zip(texts, encode(texts)):
            assert ids.tolist() == library(text)
            assert all(0 < e < len(ids) for e in ends)


def test_added_tokens_equal_the_library(library):
    encode = packing.Encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN)
    draw = random.Random(4)
    end = "<|endoftext|>"
    texts = [end, f"hello {end} world", f"{end} a", f"a {end}", f"a.{end}b", end * 3, f" {end} {end}\n", f"a\n{end}  b",
             "<|endoftext", "<| endoftext|>", f"<{end}>", f"é{end}. \ud83d{end}".encode("utf-8", "ignore").decode()]
    texts += ["".join(draw.choices([end, "a", "bc", " ", ".", "\n", "é", "<|", "'s"], k=draw.randint(1, 25)))
              for _ in range(400)]
    assert library(texts[1]) == [31373, 220, 50256, 995, 0]
    for _ in range(2):  # the second time from memory
        for text, (ids, ends) in zip(texts, encode(texts)):
            assert ids.tolist() == library(text)
            assert all(0 < e < len(ids) for e in ends)


@pytest.mark.parametrize("seed", range(20))
def test_cuts_are_the_cheapest(seed):
    draw = random.Random(seed)
    size = 1024
    places = np.cumsum([0, *[draw.randint(1, 300) for _ in range(40)]])
    penalties = np.array([draw.choice([0.0, 1.0, 8.0]) for _ in places])

    def cost(i, j):
        n = int(places[j] - places[i])
        return (0 if n in packing._POWERS else size - n) + penalties[j]

    @lru_cache(None)
    def best(j):
        return 0.0 if j == 0 else min(best(i) + cost(i, j) for i in range(j) if places[j] - places[i] <= size)

    cuts = packing.best_cuts(places, penalties, size)
    assert cuts[0] == 0 and cuts[-1] == len(places) - 1
    assert sum(cost(i, j) for i, j in zip(cuts, cuts[1:])) == pytest.approx(best(len(places) - 1))


def test_odd_texts(spark, odd_docs, no_docs, library):
    # One key stands twice: it is packed twice, so its pieces are checked by their number only.
    single = odd_docs.where("doc_id is null or doc_id <> 6")
    texts = {i: t for i, t in enumerate(ODD) if i != 6} | {None: "no key"}
    check(packed(single).collect(), texts, library)
    twice = [r for r in packed(odd_docs).collect() if r["doc_id"] == 6]
    assert sum(r["length"] for r in twice) == 2 * len(library(ODD[6]))
    assert packed(no_docs).count() == 0


def test_an_order_can_be_asked_for(spark, sf, library):
    docs = table(spark, sf, "documents")
    rows = packing.pack(docs, public_tokenizers.path(packing.VOCABULARY), public_tokenizers.PATTERN,
                        order=["doc_id"]).collect()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, library)
    stream = sorted((r["sequence_id"], r["offset"], r["doc_id"], r["start"]) for r in rows)
    assert [r[2:] for r in stream] == sorted(r[2:] for r in stream)
