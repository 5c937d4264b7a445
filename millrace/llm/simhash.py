"""SimHash fingerprints and their classes under a small Hamming distance.

A document's fingerprint takes, bit by bit, the majority of its shingles' hashes. Fingerprints that
differ in at most ``d`` of 64 bits, cut into ``d + 2`` blocks, agree in two blocks at least: they are
joined on every pair of blocks, and the Hamming distance decides. Keys shared by more than
``JOINED`` fingerprints are not joined: there, each fingerprint is written under every value within
``d / 2`` flipped bits of it. Two of them meet under a value exactly when they are within ``d``,
and each is linked to the smallest it meets, so a large group costs a fixed number of rows
per fingerprint and loses no link.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate, combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.texts import keyed_texts, map_rows
from millrace.session import materialize

BITS = 64
SEED = 42
# Largest number of fingerprints of one key that are compared pair by pair.
JOINED = 32
# Hashes counted at a time.
_COUNTED = 1 << 15


def shingles(text: str, words: int) -> tuple[Iterable[bytes], int]:
    """The text's shingles, A-Z lower-cased, single blanks between words, and how many they are.

    Fewer words than ``words`` make one shingle, no words none.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if len(found) <= words:
        return ([b" ".join(found)], 1) if found else ([], 0)
    joined = b" ".join(found)
    ends = list(accumulate(map((1).__add__, map(len, found))))
    starts = [0, *ends[:-words]]
    return (map(joined.__getitem__, map(slice, starts, map((-1).__add__, ends[words - 1:]))),
            len(starts))


def majority(hashes: np.ndarray) -> int:
    """Each of 64 bits: 1 if set in over half of the hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), _COUNTED):
        part = hashes[start:start + _COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """Per row its key and ``bits``, the fingerprint as a long; without words it is zero.

    Texts are read whole and only once, in the task that holds them; a missing text is empty, and
    repeated rows stay repeated.
    """
    schema = T.StructType([docs.schema[key], T.StructField("bits", T.LongType())])

    def prepare():
        from xxhash import xxh64_intdigest

        def hashed(columns: dict[str, list]) -> dict[str, list]:
            found = []
            for body in columns[text]:
                parts, n = shingles(body, words)
                found.append(majority(np.fromiter(
                    map(xxh64_intdigest, parts, repeat(SEED)), dtype=np.uint64, count=n)))
            return {key: columns[key], "bits": found}

        return hashed

    return map_rows(keyed_texts(docs, key, text), [key, text], schema, prepare)


def block_keys(bits: Column, distance: int) -> Column:
    """An array of ``(pair, value)``: which two blocks, and what stands in them."""
    blocks = distance + 2
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    both = [x | y for x, y in combinations(masks, 2)]
    return F.array(*[F.struct(
        F.lit(i).alias("pair"),
        bits.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask)).alias("value"))
        for i, mask in enumerate(both)])


def neighbours(bits: Column, flips: int) -> Column:
    """All values within ``flips`` flipped bits."""
    masks = [sum(1 << b for b in chosen) for n in range(flips + 1)
             for chosen in combinations(range(BITS), n)]
    return F.transform(
        F.array(*[F.lit(m - (1 << BITS) if m >> (BITS - 1) else m).cast("bigint") for m in masks]),
        lambda mask: bits.bitwiseXOR(mask))


def links(distinct: DataFrame, distance: int, joined: int = JOINED) -> DataFrame:
    """``(a, b)`` of distinct fingerprints, such that all within ``distance`` (even) are connected.

    Every link is within the distance. Below ``joined`` fingerprints to a key, all its pairs are
    there; above, a pair may be connected over others of their links instead.
    """
    if distance % 2:
        raise ValueError("an even distance is needed, to halve it")
    keyed = distinct.select("bits", F.inline(block_keys(F.col("bits"), distance)))
    members = materialize(keyed, "blocks")
    sizes = members.groupBy("pair", "value").count().where("count > 1")
    shared = materialize(members.join(sizes, ["pair", "value"]), "shared-blocks")
    few = shared.where(F.col("count") <= joined)
    other = few.select("pair", "value", F.col("bits").alias("larger"))
    near = (F.col("bits") < F.col("larger")) & (
        F.bit_count(F.col("bits").bitwiseXOR(F.col("larger"))) <= distance)
    pairs = few.join(other, [few["pair"] == other["pair"], few["value"] == other["value"], near]) \
        .select(F.col("bits").alias("a"), F.col("larger").alias("b"))
    many = shared.where(F.col("count") > joined).select("bits").distinct()
    # At most as many fingerprints as a value has neighbours stand under it.
    met = Window.partitionBy("value")
    stars = many.select("bits", F.explode(neighbours(F.col("bits"), distance // 2)).alias("value")) \
        .withColumn("smallest", F.min("bits").over(met)).where("bits > smallest") \
        .select(F.col("smallest").alias("a"), F.col("bits").alias("b"))
    return pairs.unionByName(stars)


def classes(found: DataFrame, key: str, distance: int, joined: int = JOINED) -> DataFrame:
    """Rows of ``fingerprints`` with ``component_id``, the smallest key reachable over links.

    Rows of one fingerprint share a class; those without a key take part and may lend the class
    no name. The graph's nodes are distinct fingerprints, so copies add nothing to it.
    """
    rows = materialize(found, "fingerprints")
    distinct = rows.groupBy("bits").agg(F.min(key).alias("first"))
    roots = components(links(distinct.select("bits"), distance, joined), "a", "b")
    placed = distinct.join(roots, F.col("bits") == F.col("node"), "left").select(
        "bits", "first", F.coalesce("root", "bits").alias("root"))
    names = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(names, "root").select("bits", "component_id")
    return rows.join(named, "bits").select(*rows.columns, "component_id")


def hexadecimal(bits: Column) -> Column:
    """16 lower-case digits."""
    return F.lpad(F.lower(F.hex(bits)), BITS // 4, "0")
