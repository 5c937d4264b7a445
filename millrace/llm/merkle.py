"""Merkle trees over a text's sections, paragraphs and passages.

A section ends with blank lines, a paragraph with its newline, a passage with a sentence's end or
after ``PASSAGE`` characters; together they are the text, nothing left out. A passage's digest is of its
characters, every other digest of those below it. So equal roots mean equal texts, and an edit is found by
going down where digests differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.session import broadcast_if_small, materialize

PASSAGE = 64
SECTIONS = r"(?s).+?(?:\n\n+|\z)"
PARAGRAPHS = r"[^\n]*\n|[^\n]+"
PASSAGES = rf"(?s).{{0,{PASSAGE - 1}}}?[.!?][ \t\r\n]|.{{1,{PASSAGE}}}"
# Hexadecimal digits kept of the digests of passages, and of paragraphs and sections.
LEAF, BRANCH = 8, 16


def _parts(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), 0)


def _above(kind: str, digests: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(digests, "")), 256)


def tree(text: Column) -> Column:
    """An array of sections (``digest``, ``paragraphs``), a paragraph being ``digest`` and ``leaves``."""
    def paragraph(part: Column) -> Column:
        return F.transform(_parts(part, PASSAGES), lambda p: F.left(F.sha2(p, 256), F.lit(LEAF)))

    def section(part: Column) -> Column:
        leaves = F.transform(_parts(part, PARAGRAPHS), paragraph)
        return F.transform(leaves, lambda of: F.struct(
            F.left(_above("p", of), F.lit(BRANCH)).alias("digest"), of.alias("leaves")))

    return F.transform(F.transform(_parts(text, SECTIONS), section), lambda of: F.struct(
        F.left(_above("s", F.transform(of, lambda p: p["digest"])), F.lit(BRANCH)).alias("digest"),
        of.alias("paragraphs")))


def root(of: Column) -> Column:
    return _above("r", F.transform(of, lambda s: s["digest"]))


def _paragraphs(of: Column) -> Column:
    return F.flatten(F.transform(of, lambda s: s["paragraphs"]))


def fingerprint(of: Column) -> Column:
    """The tree as text: its root, then its leaves in order."""
    leaves = F.flatten(F.transform(_paragraphs(of), lambda p: p["leaves"]))
    return F.concat_ws("-", root(of), leaves)


def likeness(one: Column, other: Column) -> Column:
    """Of two fingerprints: 1 for equal ones, else twice the shared different leaves over all of both."""
    a, b = (F.array_distinct(F.slice(F.split(x, "-"), 2, 2**31 - 1)) for x in (one, other))
    shared = F.size(F.array_intersect(a, b))
    return F.when(one == other, 1.0).otherwise(2.0 * shared / F.greatest(F.size(a) + F.size(b), F.lit(1)))


def changed(one: Column, other: Column) -> Column:
    """Where ``one`` has what ``other`` lacks: ``section`` and ``paragraph``, counted from 0.

    Only sections without an equal in the other tree are opened, so whatever has merely moved is not reported.
    """
    known = F.transform(_paragraphs(other), lambda p: p["digest"])
    sections = F.transform(other, lambda s: s["digest"])
    numbered = F.transform(one, lambda s, i: F.struct(s.alias("s"), i.alias("i")))
    opened = F.filter(numbered, lambda x: ~F.array_contains(sections, x["s"]["digest"]))
    return F.flatten(F.transform(opened, lambda x: F.filter(
        F.transform(x["s"]["paragraphs"], lambda p, j: F.struct(
            x["i"].alias("section"), j.alias("paragraph"), p["digest"].alias("digest"))),
        lambda p: ~F.array_contains(known, p["digest"]))))


def cyclic_successors(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``next``, a struct of the row before in ascending order; the first gets the last.

    ``rows`` must be unique in ``order``. They are cut into slices by a range shuffle and numbered within them; only
    each slice's last row is looked at across slices.
    """
    cut = materialize(
        rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices")
    row = F.struct(*rows.columns)
    tails = cut.groupBy("_slice").agg(F.max(F.struct(F.struct(*order).alias("at"), row.alias("row"))).alias("tail"))
    by_slice = Window.orderBy("_slice")
    every = by_slice.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # As many rows as there were tasks.
    before = tails.select(F.col("_slice").alias("_at"), F.coalesce(
        F.lag("tail").over(by_slice), F.last("tail").over(every))["row"].alias("_tail"))
    inside = Window.partitionBy("_slice").orderBy(*order)
    return cut.withColumn("_lag", F.lag(row).over(inside)).join(
        broadcast_if_small(before), F.col("_slice") == F.col("_at")).select(
        *rows.columns, F.coalesce("_lag", "_tail").alias("next"))


def with_next_document(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``text``, ``edited``, ``next_fingerprint``: every document beside its next by falling key.

    ``edited`` is the text with its last half of code points replaced by the next document's first ones. After the smallest key comes
    the largest. A missing text is empty, missing keys come after all others; rows of one key are in the order of
    their texts' hashes, and equal rows are one document that is returned as often as it stands. Whole texts are
    shuffled once; of the next documents only the half that is used, and their digests. Keys must be of a type that
    comes back from text unchanged.
    """
    base = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text"))
    ids = base.select("key", "mark", F.length("text").alias("n")).distinct()

    def never_null(column: str) -> list[Column]:
        return [F.coalesce(F.col(column).cast("string"), F.lit("")), F.col(column).isNull()]

    own_keys, donor_keys, owner_keys = (
        [f"{name}_{part}" for part in ("text", "null", "mark")] for name in ("own", "donor", "owner"))
    pairs = cyclic_successors(ids, ("key", "mark")).select(
        *[c.alias(n) for c, n in zip([*never_null("key"), F.col("mark")], owner_keys)],
        *[c.alias(n) for c, n in zip([*never_null("next.key"), F.col("next.mark")], donor_keys)],
        F.expr("n div 2").cast("int").alias("half"))
    # Keys that are never null, so that grouping and both joins agree on how rows are dealt out; the key itself
    # stays behind, so that both joins take the same columns and share one shuffle of whole texts.
    keyed = base.select("text", *[c.alias(n) for c, n in zip([*never_null("key"), F.col("mark")], own_keys)])
    given = keyed.join(pairs, [F.col(a) == F.col(b) for a, b in zip(own_keys, donor_keys)]).select(
        *owner_keys, "half", F.left("text", F.col("half")).alias("head"),
        fingerprint(tree(F.col("text"))).alias("next_fingerprint")).dropDuplicates(owner_keys)
    own = F.when(~F.col(own_keys[1]), F.col(own_keys[0]).cast(docs.schema[key].dataType))
    return keyed.join(given, [F.col(a) == F.col(b) for a, b in zip(own_keys, owner_keys)]).select(
        own.alias(key), F.col("text").alias(text),
        F.concat(F.left("text", F.length("text") - F.col("half")), "head").alias("edited"), "next_fingerprint")
