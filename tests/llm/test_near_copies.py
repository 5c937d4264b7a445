"""Near copies against all pairs' shingles."""

import random

import numpy as np
import pyarrow as pa
import pytest

from llm.conftest import ODD
from millrace.llm import near_copies, texts


def shingle_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(texts, likeness=0.8):
    """``{i: smallest index reachable}`` over pairs that share enough, equal words and no words included."""
    sets = [shingle_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared, every = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            if every == 0 or shared / every >= likeness:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(texts))]


def edited(words, share, draw, vocabulary):
    return [draw.choice(vocabulary) if draw.random() < share else w for w in words]


def planted(n_groups, size, share, seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 7))) for _ in range(3000)]
    texts = []
    for _ in range(n_groups):
        words = draw.choices(vocabulary, k=draw.randint(60, 400))
        texts += [" ".join(edited(words, share, draw, vocabulary)) for _ in range(draw.randint(1, size))]
        texts += [" ".join(words)] * draw.randint(0, 2)
    draw.shuffle(texts)
    return texts


def classes(spark, texts):
    rows = near_copies.groups(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    found = {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        found.setdefault(r["root"], []).append(r["doc_id"])
    return sorted(found.values())


def as_classes(roots):
    found = {}
    for i, r in enumerate(roots):
        found.setdefault(r, []).append(i)
    return sorted(found.values())


def test_planted_groups(spark):
    texts = planted(40, 6, 0.002, 1)
    assert classes(spark, texts) == as_classes(brute_groups(texts))


def test_one_large_group(spark):
    texts = planted(1, 1, 0.0, 3)[:1]
    draw = random.Random(4)
    words = texts[0].split()
    texts += [" ".join(edited(words, 0.004, draw, ["x", "y", "zz"])) for _ in range(250)] + planted(10, 2, 0.002, 5)
    assert classes(spark, texts) == as_classes(brute_groups(texts))


def test_block_edits(spark):
    """A sentence added or a stretch replaced, a tenth of the text."""
    draw = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(60):
        words = draw.choices(vocabulary, k=300)
        texts += [" ".join(words), " ".join(words[:290] + draw.choices(vocabulary, k=12))]
    found = {tuple(c) for c in classes(spark, texts)}
    assert sum((i, i + 1) in found for i in range(0, 120, 2)) >= 59


def test_every_pair_at_the_least_likeness(spark):
    """Single pairs of 8 to 400 words, J 0.80 to 0.90, linked by nothing else."""
    draw = random.Random(21)
    vocabulary = [f"w{i}" for i in range(5000)]
    texts = []
    for n in [8, 9, 10, 12, 16, 24, 40, 100, 400] * 20:
        words = draw.choices(vocabulary, k=n)
        # Of n - 4 shingles, as many new ones at the end as the least likeness allows, or half of them.
        most = int((n - 4) * (1 / near_copies.LIKENESS - 1) + 1e-9)
        more = draw.choices(vocabulary, k=max(1, draw.choice([most, most, most // 2])))
        texts += [" ".join(words), " ".join(words + more)]
    draw.shuffle(texts)
    expected = as_classes(brute_groups(texts))
    assert sum(len(c) > 1 for c in expected) == 180
    assert classes(spark, texts) == expected


def test_one_of_each_keeps_columns_and_the_smallest(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(5, text, "b", 1), (3, text.upper(), "a", 2), (3, text.upper(), "a", 2), (9, "another text", None, None),
            (None, "another  text\n", "n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string, mark int")
    kept = near_copies.one_of_each(docs)
    assert kept.columns == docs.columns
    assert {tuple(r) for r in kept.collect()} == {rows[1], rows[4]} and kept.count() == 2


def test_odd_texts(spark, odd_docs, no_docs):
    kept = near_copies.one_of_each(odd_docs)
    rows = kept.collect()
    assert kept.columns == odd_docs.columns
    empty = [r["doc_id"] for r in rows if not (r["text"] or "").strip(" \n")]
    assert empty == [0]
    # "Two words" stands twice.
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [
        i for i in range(len(ODD)) if i not in (1, 2, 3, 4)]
    assert near_copies.one_of_each(no_docs).count() == 0


def test_fingerprint_bits():
    hashes = np.array([1, 2, 3, 3, 3], dtype=np.uint64)
    # Repeats do not count, and every word mixes anew.
    words = near_copies.wide_fingerprint(hashes)
    assert (words == near_copies.wide_fingerprint(hashes[:3])).all()
    assert len(set(words.tolist())) == near_copies.WORDS
    assert len(near_copies.block_values(words)) == near_copies.BLOCKS
    assert not near_copies.wide_fingerprint(hashes[:0]).any()


def test_bitmaps_never_rule_out_what_is_shared():
    draw = random.Random(7)
    for n, m, shared in [(0, 0, 0), (1, 1, 1), (5, 4, 3), (60, 70, 58), (900, 300, 200), (70_000, 80_000, 60_000), (40, 90_000, 40)]:
        pool = [draw.getrandbits(64) for _ in range(n + m - shared)]
        a, b = (np.array(sorted(x), dtype=np.uint64) for x in (pool[:n], pool[n - shared:]))
        most = near_copies.most_shared(n, near_copies.bitmap(a), m, near_copies.bitmap(b))
        assert shared <= most <= min(n, m) and most == near_copies.most_shared(m, near_copies.bitmap(b), n, near_copies.bitmap(a))
    # Sets without anything in common are far apart.
    a, b = (np.array([draw.getrandbits(64) for _ in range(600)], dtype=np.uint64) for _ in range(2))
    assert near_copies.most_shared(600, near_copies.bitmap(a), 600, near_copies.bitmap(b)) < 500


def test_groups_larger_than_a_part_and_lists_too_long_to_send(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "GROUP", 4)
    monkeypatch.setattr(near_copies, "ASKED_ROWS", 10)
    draw = random.Random(11)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(words, 0.004, draw, ["x", "y", "zz"])) for _ in range(60)] + planted(10, 4, 0.002, 6)
    assert classes(spark, texts) == as_classes(brute_groups(texts))


def crowd(size, draw):
    """A text and copies of it with 0 to 6 of 150 words replaced by words of their own; 3 at most leave them alike to it."""
    words = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(size):
        own = list(words)
        for j, at in enumerate(draw.sample(range(5, 145), i % 7)):
            own[at] = f"x{i}_{j}"
        texts.append(" ".join(own))
    return texts


def test_pairs_met_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    met, stored = [], near_copies.materialize

    def counted(df, label):
        found = stored(df, label)
        if label in ("led", "met"):
            met.append(found.count())
        return found

    monkeypatch.setattr(near_copies, "materialize", counted)
    pairs = []
    for size in (140, 280):
        # Fingerprints find no hub, so that the second step is left alone with the group.
        monkeypatch.setattr(near_copies, "MOST", -1)
        met.clear()
        texts = crowd(size, random.Random(13))
        assert classes(spark, texts) == as_classes(brute_groups(texts))
        pairs.append(sum(met))
    assert pairs[1] <= 2.5 * pairs[0] and pairs[1] <= 10 * 280


def test_texts_travel_in_small_batches(spark, monkeypatch):
    real = near_copies.map_rows
    before = spark.conf.get(texts._BATCH_ROWS)
    seen = set()

    def noted(df, *rest):
        seen.add(df.sparkSession.conf.get(texts._BATCH_ROWS))
        return real(df, *rest)

    monkeypatch.setattr(near_copies, "map_rows", noted)
    monkeypatch.setattr(texts, "BATCH_ROWS", 50)
    docs = spark.range(0, 300, 1, 1).selectExpr("id as doc_id", "concat_ws(' ', 'one', id % 100, 'two', id % 100, 'three four') as text")
    assert near_copies.groups(docs).select("root").distinct().count() == 100
    assert seen == {"50"} and spark.conf.get(texts._BATCH_ROWS) == before

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    with texts.text_batches(spark):
        assert [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()] == [50] * 6
    with pytest.raises(ZeroDivisionError), texts.text_batches(spark):
        1 / 0
    assert spark.conf.get(texts._BATCH_ROWS) == before
