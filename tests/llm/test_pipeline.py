"""Every stage against a plain version on its own input, and the whole run."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from llm.test_decontamination import brute as brute_leaks
from llm.test_lines import brute as brute_lines
from llm.test_near_copies import brute_groups
from llm.test_packing import check
from millrace.llm import decontamination, lines, toxicity
from millrace.llm.queries import PREDICTED, QUERIES, toxicity_model
from millrace.session import materialize
from workload.bindings import table


def texts_of(df):
    return dict(sorted((r["doc_id"], r["text"]) for r in df.collect()))


def test_stages(spark, sf):
    docs = table(spark, sf, "documents")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, sf), "stage")
        if name != "packing":
            assert after.schema == docs.schema
        steps[name] = docs, after
        docs = after

    before, after = steps["toxicity"]
    model = toxicity_model(before, table(spark, sf, "labels"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(before, model).collect()}
    kept = texts_of(after)
    assert kept == {i: t for i, t in texts_of(before).items() if scores[i] < PREDICTED}

    before, after = steps["line dedup"]
    given = list(texts_of(before).items())
    gone = brute_lines_fast(given)
    wanted = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in given}
    assert texts_of(after) == {i: t for i, t in wanted.items() if t.strip(" ") or not dict(given)[i].strip(" ")}
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = steps["near dedup"]
    given = list(texts_of(before).items())
    roots = brute_groups([t for _, t in given])
    assert texts_of(after) == {i: t for k, (i, t) in enumerate(given) if roots[k] == k}

    before, after = steps["decontamination"]
    given = texts_of(before)
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    leaks = {i for i, _ in brute_leaks(list(given.items()), items, decontamination.RATE)}
    assert texts_of(after) == {i: t for i, t in given.items() if i not in leaks}

    before, after = steps["packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check(after.collect(), texts_of(before),
          lambda text: [*library.encode(text, add_special_tokens=False).ids, 0])


def brute_lines_fast(given):
    """As ``brute_lines``, for runs as short as their words allow: longer ones add nothing."""
    begins, at = {}, 0
    for i, text in given:
        begins[i] = at
        at += len(text.split("\n")) + 1
    first, gone = {}, {i: set() for i, _ in given}
    for i, text in given:
        parts = text.split("\n")
        words = [len(p.encode().split()) for p in parts]
        runs = set()
        for s in range(len(parts)):
            total = 0
            for e in range(s, len(parts)):
                total += words[e]
                if total >= lines.LEAST_WORDS:
                    runs.add((s, e + 1))
                    break
        for e in range(len(parts)):
            total = 0
            for s in range(e, -1, -1):
                total += words[s]
                if total >= lines.LEAST_WORDS:
                    runs.add((s, e + 1))
                    break
        for s, e in sorted(runs):
            p = begins[i] + s
            if p - first.setdefault(tuple(parts[s:e]), p) >= e - s:
                gone[i].update(range(s, e))
    return gone


def test_the_fast_version_is_right():
    given = [(0, "a b\nc\nd e"), (1, "x\na b\nc\nd e\nc"), (2, "c\nd e")]
    least, lines.LEAST_WORDS = lines.LEAST_WORDS, 3
    try:
        assert brute_lines_fast(given) == brute_lines(given, 3)
    finally:
        lines.LEAST_WORDS = least


def test_odd_rows_pass_every_stage(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            left = materialize(stage(spark, docs, sf), "odd")
            assert left.columns == docs.columns
            assert left.count() <= n
            docs = left
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
        assert (packed.count() > 0) == (n > 0)


def test_query_is_registered(spark, sf):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in QUERIES} >= {f"op{i}" for i in range(3, 11)} | {"op1"}
