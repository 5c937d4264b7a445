"""SimHash against plain Python on all pairs."""

import random
from itertools import combinations

import pytest
from xxhash import xxh64_intdigest

from llm.conftest import ODD
from millrace.llm import simhash
from millrace.llm.components import components
from millrace.llm.queries import QUERIES
from workload.bindings import table


def plain_fingerprint(text, words):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w]
    parts = [" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))] if found else []
    hashes = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(values, distance):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(root), 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {v: find(v) for v in root}


def test_query_equals_brute_force(spark, sf):
    rows = QUERIES["op6_simhash_classes"].run(spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    prints = {i: plain_fingerprint(t, 3) for i, t in texts.items()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    roots = plain_classes(set(prints.values()), 2)
    smallest = {}
    for i, p in sorted(prints.items()):
        smallest.setdefault(roots[p], i)
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: smallest[roots[p]] for i, p in prints.items()}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("joined", [0, 3, 32])
def test_links_connect_all_near_fingerprints(spark, joined):
    """Balls of near values, large ones included, whichever way their keys are treated."""
    draw = random.Random(5)
    values = {draw.getrandbits(64) for _ in range(60)}
    for _ in range(4):
        centre = draw.getrandbits(64)
        for _ in range(40):
            v = centre
            for bit in draw.sample(range(64), draw.randint(0, 4)):
                v ^= 1 << bit
            values.add(v)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    found = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "bits long, doc_id long")
    rows = simhash.classes(found, "doc_id", 2, joined).collect()
    wanted = plain_classes(set(signed), 2)
    classes = {}
    for r in rows:
        classes.setdefault(r["component_id"], set()).add(r["bits"])
    expected = {}
    for v, root in wanted.items():
        expected.setdefault(root, set()).add(v)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, expected.values()))


def test_odd_texts(spark, odd_docs, no_docs):
    found = simhash.fingerprints(odd_docs)
    assert found.columns == ["doc_id", "bits"]
    rows = simhash.classes(found, "doc_id", 2).collect()
    assert len(rows) == len(ODD) + 2
    by = {r["doc_id"]: r for r in rows}
    assert {by[i]["bits"] for i in (0, 1, 2, 3, 4)} == {0}
    assert {by[i]["component_id"] for i in (0, 1, 2, 3, 4)} == {0}
    assert all(by[i]["bits"] % 2**64 == plain_fingerprint(t, 3) for i, t in enumerate(ODD))
    assert by[None]["component_id"] is None
    assert simhash.classes(simhash.fingerprints(no_docs), "doc_id", 2).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 260)] + [(7, 7), (None, 3)]
    found = components(spark.createDataFrame(chain, "a long, b long"), "a", "b").collect()
    assert {(r["node"], r["root"]) for r in found} == (
        {(i, 0) for i in range(1, 61)} | {(i, 200) for i in range(201, 260)})
