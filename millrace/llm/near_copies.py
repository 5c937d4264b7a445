"""Near copies: wide SimHash fingerprints for the bulk of large groups, an exact join on shingles for every pair.

* First each document meets one hub. Fingerprints have ``WORDS`` words of 64 bits; ``BLOCKS`` blocks of ``BLOCK_BITS`` bits
  are cut from them; of all documents it shares a block with and that lead theirs, a document is compared with the
  one that shares most: in a group of copies the original or the like of it. Verified links make components, so a group
  of many copies costs one comparison each and not all pairs.
* Then documents of different components are compared whenever they can be alike. A set's prefix is
  its first ``n - ceil(likeness n) + 1`` of ``n`` shingles in an order that is the same for all documents. Two sets that
  are alike share a shingle of their prefixes, whatever the order; common shingles come last in it, so that few
  documents meet that are not alike. Sizes and places rule out most pairs; of the rest, bitmaps of their shingles rule out
  all but a few before any text moves: a bit that only one of two sets has is a shingle that the other lacks.

Pairs are decided by their shingles. They are gathered around one of the two, so that its set is sent once for up to ``GROUP``
partners, and texts stay where they are as long as the list of those asked for is small.

Fingerprints only save work: a pair that they miss is met in the second step.
"""

from __future__ import annotations

from itertools import repeat
from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.simhash import SEED, shingles
from millrace.llm.texts import map_rows, text_batches
from millrace.session import broadcast_if_small, materialize

WORDS, BLOCK_BITS, BLOCKS = 24, 24, 32
SHINGLE, LIKENESS = 5, 0.8
# Differing bits at most between a document and its hub: of the first word, and of a whole fingerprint.
MOST_IN_WORD, MOST = 20, 275
# One document in so many is looked at for common shingles; common are those that so many of them have, or this share.
# The most frequent so many of them go to all tasks: only an order hangs on it.
SAMPLED, OFTEN, COMMON, MOST_COMMON = 16, 4, 1 / 4096, 500_000
# Bits of a set's bitmap: a power of two, at least as many as it has shingles, within these powers.
LEAST_BITS, MOST_BITS = 6, 16
# Documents that share a shingle of their prefixes, beyond which they first meet one of them.
CROWDED = 32
# Partners that one copy of a set is sent for, and parts of a set's pairs that are counted apart.
GROUP, SLICES = 256, 64
# Largest list of texts asked for that is sent to the texts, in rows and bytes.
ASKED_ROWS, ASKED_BYTES = 1_000_000, 128 << 20
_COUNTED = 1 << 12


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` words; each bit is the majority over the different hashes, mixed anew for each word."""
    hashes = np.unique(hashes)
    counts = np.zeros(WORDS * 64, dtype=np.int64)
    salt = np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for start in range(0, len(hashes), _COUNTED):
        x = hashes[start:start + _COUNTED, None] + salt[None, :]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return np.packbits((2 * counts > len(hashes)).astype(np.uint8), bitorder="little").view("<i8")


def block_values(words: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(words.view(np.uint8), bitorder="little")[:BLOCKS * BLOCK_BITS]
    return bits.reshape(BLOCKS, BLOCK_BITS).astype(np.int32) @ (1 << np.arange(BLOCK_BITS, dtype=np.int32))


def bitmap(hashes: np.ndarray) -> bytes:
    """A bit for each of the different hashes, by its last bits."""
    bits = np.zeros(1 << min(MOST_BITS, max(LEAST_BITS, (len(hashes) - 1).bit_length())), dtype=np.uint8)
    bits[hashes & np.uint64(len(bits) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def most_shared(n: int, one: bytes, m: int, other: bytes) -> int:
    """How many of ``n`` and ``m`` hashes two sets with these bitmaps can have in common at most."""
    a, b = np.frombuffer(one, np.uint8), np.frombuffer(other, np.uint8)
    if len(a) > len(b):
        a = np.bitwise_or.reduce(a.reshape(-1, len(b)), axis=0)
    elif len(b) > len(a):
        b = np.bitwise_or.reduce(b.reshape(-1, len(a)), axis=0)
    return min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))


def _node(body: str) -> int:
    """The hash of a text's words in lower case."""
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(b" ".join(body.encode("utf-8", "surrogatepass").lower().split())) - (1 << 63)


def _sketches(docs: DataFrame) -> DataFrame:
    """Per row: its key and mark, ``node`` (the hash of its words in lower case), fingerprint, blocks, and of its different shingles
    their number ``n`` and ``bitmap``."""
    schema = T.StructType([docs.schema["key"], T.StructField("mark", T.LongType()), T.StructField("node", T.LongType()),
                           T.StructField("bits", T.ArrayType(T.LongType())),
                           T.StructField("blocks", T.ArrayType(T.IntegerType())), T.StructField("n", T.IntegerType()),
                           T.StructField("bitmap", T.BinaryType())])

    def prepare():
        from xxhash import xxh64_intdigest

        def sketched(columns: dict[str, list]) -> dict[str, list]:
            found: dict[str, list] = {name: [] for name in ("node", "bits", "blocks", "n", "bitmap")}
            for body in columns["text"]:
                found["node"].append(_node(body))
                parts, n = shingles(body, SHINGLE)
                hashes = np.unique(np.fromiter(map(xxh64_intdigest, parts, repeat(SEED)), dtype=np.uint64, count=n))
                words = wide_fingerprint(hashes)
                found["bits"].append(words)
                found["blocks"].append(block_values(words))
                found["n"].append(len(hashes))
                found["bitmap"].append(bitmap(hashes))
            return {"key": columns["key"], "mark": columns["mark"], **found}

        return sketched

    return map_rows(docs, ["key", "mark", "text"], schema, prepare)


def _requests(pairs: DataFrame) -> DataFrame:
    """Whose sets are needed where: of each pair ``b`` as a partner (``role`` 1) in one of the parts of ``a``, and ``a`` once
    in each of its parts (``role`` 0). A part has about ``GROUP`` partners at most, however many ``a`` has."""
    sliced = pairs.withColumn("slice", F.pmod(F.xxhash64("b"), F.lit(SLICES)))
    sizes = sliced.groupBy("a", "slice").agg(F.count("*").alias("n"))
    parts = sizes.select("a", "slice", F.ceil(F.sum("n").over(Window.partitionBy("a")) / GROUP).alias("parts"))
    placed = sliced.join(parts, ["a", "slice"]).select(
        "a", "b", F.pmod(F.xxhash64("b", F.lit(SEED)), F.col("parts")).alias("part"))
    partners = placed.select(F.col("b").alias("node"), F.col("a").alias("group"), "part", F.lit(1).alias("role"))
    heads = placed.select(F.col("a").alias("node"), F.col("a").alias("group"), "part", F.lit(0).alias("role")).distinct()
    return partners.unionByName(heads)


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """``group``, ``part``, ``role``, ``node`` and ``set``: the text's different shingles' hashes in rising order, as unsigned 32-bit numbers."""
    schema = T.StructType([T.StructField("group", T.LongType()), T.StructField("part", T.LongType()),
                           T.StructField("role", T.IntegerType()), T.StructField("node", T.LongType()),
                           T.StructField("set", T.BinaryType())])

    def prepare():
        from xxhash import xxh3_64_intdigest

        def collected(columns: dict[str, list]) -> dict[str, list]:
            sets, last, of = [], None, b""
            for node, body in zip(columns["node"], columns["text"]):
                if node != last:  # a text asked for several times comes several times in a row
                    parts, n = shingles(body, SHINGLE)
                    hashes = np.fromiter(map(xxh3_64_intdigest, parts), dtype=np.uint64, count=n)
                    last, of = node, np.unique(hashes.astype(np.uint32)).astype("<u4").tobytes()
                sets.append(of)
            return {**{name: columns[name] for name in ("group", "part", "role", "node")}, "set": sets}

        return collected

    return map_rows(texts, ["group", "part", "role", "node", "text"], schema, prepare)


def _alike(sets: DataFrame, likeness: float) -> DataFrame:
    """The pairs ``a``, ``b`` of a part's head and its partners whose sets share enough."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def prepare():
        head, own = None, np.zeros(0, dtype="<u4")

        def compared(columns: dict[str, list]) -> dict[str, list]:
            nonlocal head, own
            rows: dict[str, list] = {"a": [], "b": []}
            for group, part, role, node, found in zip(*(columns[name] for name in ("group", "part", "role", "node", "set"))):
                other = np.frombuffer(found, "<u4")
                if role == 0:
                    head, own = (group, part), other
                elif head == (group, part):
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    if shared >= likeness * (len(own) + len(other) - shared):
                        rows["a"].append(group)
                        rows["b"].append(node)
                else:
                    raise ValueError("a part without its head")
            return rows

        return compared

    dealt = sets.repartition("group", "part").sortWithinPartitions("group", "part", "role")
    return map_rows(dealt, ["group", "part", "role", "node", "set"], schema, prepare)


def _can_share(pairs: DataFrame, contents: DataFrame, likeness: float) -> DataFrame:
    """The pairs whose bitmaps leave room for enough shared shingles."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def prepare():
        def compared(columns: dict[str, list]) -> dict[str, list]:
            rows: dict[str, list] = {"a": [], "b": []}
            for a, b, n, m, one, other in zip(*(columns[name] for name in ("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b"))):
                if most_shared(n, one, m, other) >= (n + m) * likeness / (1 + likeness) - 1e-6:
                    rows["a"].append(a)
                    rows["b"].append(b)
            return rows

        return compared

    both = pairs
    for side in ("a", "b"):
        both = both.join(contents.select(
            F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bitmap").alias(f"bitmap_{side}")), side)
    return map_rows(both, ["a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b"], schema, prepare)


def _differing(one: Column, other: Column) -> Column:
    return F.aggregate(F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def _common_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that many documents of a sample have, in rising order, and how many. Only an order hangs on it."""
    schema = T.StructType([T.StructField("token", T.LongType())])

    def prepare():
        def listed(columns: dict[str, list]) -> dict[str, np.ndarray]:
            sets = [_hashes(body) for body in columns["text"]]
            return {"token": np.concatenate(sets) if sets else []}

        return listed

    sample = docs.where(F.pmod("mark", F.lit(SAMPLED)) == 0)
    least = max(OFTEN, sample.count() * COMMON)
    found = map_rows(sample, ["text"], schema, prepare).groupBy("token").agg(F.count("*").alias("n")) \
        .where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(MOST_COMMON).toArrow()
    tokens, counts = (found.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(tokens)
    return tokens[order], counts[order]


def _hashes(body: str) -> np.ndarray:
    """The text's different shingles as signed 64-bit hashes in rising order."""
    from xxhash import xxh3_64_intdigest

    parts, n = shingles(body, SHINGLE)
    return np.unique(np.fromiter(map(xxh3_64_intdigest, parts), dtype=np.uint64, count=n).view(np.int64))


def _prefixes(docs: DataFrame, likeness: float) -> DataFrame:
    """Per content ``node``, ``size`` (its different shingles) and ``tokens``, its prefix."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("size", T.IntegerType()),
                           T.StructField("tokens", T.ArrayType(T.LongType()))])
    common, counts = _common_shingles(docs)

    def prepare():
        def cut(columns: dict[str, list]) -> dict[str, list]:
            sizes, found = [], []
            for body in columns["text"]:
                tokens = _hashes(body)
                n = len(tokens)
                often = np.zeros(n, dtype=np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
                    often = np.where(common[at] == tokens, counts[at], 0)
                # Rounding must not shorten a prefix.
                least = ceil(likeness * n - 1e-6)
                sizes.append(n)
                found.append(tokens[np.lexsort((tokens, often))[:max(0, n - least + 1)]])
            return {"node": [_node(body) for body in columns["text"]], "size": sizes, "tokens": found}

        return cut

    return map_rows(docs, ["text"], schema, prepare).dropDuplicates(["node"])


def _can_be_alike(likeness: float) -> Column:
    """Whether sizes and places leave room for enough shared shingles, if the one that stands there is the first shared one.

    That one is the first in the order of both sets, so only what stands from it on can be shared. Every pair that is alike
    has one with room: its first.
    """
    n, m, i, j = (F.col(name) for name in ("size", "_size", "place", "_place"))
    return F.least(n - i, m - j) >= (n + m) * F.lit(likeness / (1 + likeness)) - F.lit(1e-6)


def _members(prefixes: DataFrame) -> DataFrame:
    """The places of shingles that stand in several prefixes."""
    placed = prefixes.select("node", "size", F.posexplode("tokens").alias("place", "token"))
    several = placed.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    return materialize(placed.join(several, "token"), "members")


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    return materialize(members.join(
        roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
            "token", "node", "size", "place", F.coalesce("root", "node").alias("root")), "rooted")


def _led(rooted: DataFrame, likeness: float) -> DataFrame:
    """Pairs ``a``, ``b`` around one document ``a`` of each crowded shingle, the one with the fewest shingles before it.

    In a group of copies that is the one with the fewest edits. One pair a row at most, so the number grows with the documents.
    """
    leads = rooted.groupBy("token").agg(F.count("*").alias("n"), F.min(F.struct("place", "node", "size", "root")).alias("lead")) \
        .where(F.col("n") > CROWDED).select("token", *[F.col(f"lead.{name}").alias(f"_{name}")
                                                      for name in ("place", "node", "size", "root")])
    return rooted.join(leads, "token").where((F.col("root") != F.col("_root")) & _can_be_alike(likeness)).select(
        F.col("_node").alias("a"), F.col("node").alias("b")).distinct()


def _meeting(rooted: DataFrame, likeness: float) -> DataFrame:
    """Pairs ``a``, ``b`` of different components that share a shingle of their prefixes and can be alike."""
    # Within a shingle's largest component nothing is compared again.
    largest = rooted.groupBy("token", "root").count().groupBy("token").agg(
        F.max(F.struct("count", "root")).alias("top"), F.count("*").alias("roots")).where("roots > 1").select(
        "token", F.col("top.root").alias("top"))
    mixed = materialize(rooted.join(largest, "token"), "mixed")
    outside = mixed.where(F.col("root") != F.col("top")).select(
        *[F.col(name).alias(f"_{name}") for name in ("token", "node", "size", "place", "root")])
    # Two documents outside the largest component meet once, not from both sides.
    return mixed.join(outside, (F.col("token") == F.col("_token")) & (F.col("root") != F.col("_root"))
                      & ((F.col("root") == F.col("top")) | (F.col("node") < F.col("_node"))) & _can_be_alike(likeness)).select(
        F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def _near(pairs: DataFrame, contents: DataFrame) -> DataFrame:
    """The pairs whose fingerprints are near."""
    near = pairs
    for side, bits in (("a", "bits_a"), ("b", "bits_b")):
        near = near.join(contents.select(F.col("node").alias(side), F.col("bits").alias(bits)), side)
    return near.where(_differing(F.col("bits_a"), F.col("bits_b")) <= MOST).select("a", "b")


def _verified(pairs: DataFrame, contents: DataFrame, docs: DataFrame, likeness: float) -> DataFrame:
    """The pairs whose shingles are alike, written out."""
    owners = contents.select("node", F.col("owner.key").alias("_key"), F.col("owner.mark").alias("_mark"))
    asked = materialize(_requests(materialize(pairs, "near")).join(owners, "node"), "asked")
    texts = docs.join(broadcast_if_small(asked, ASKED_ROWS, ASKED_BYTES),
                      F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark")))
    return materialize(_alike(_shingle_sets(texts), likeness).distinct(), "near-links")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """``key``, ``mark`` (the text's hash) and ``root`` of every row: equal roots are copies of each other.

    Texts are compared without regard to A-Z's case and to white space. Texts without words are copies of each other; a missing text is empty.
    """
    with text_batches(docs.sparkSession):
        return _groups(docs, key, text, likeness)


def _groups(docs: DataFrame, key: str, text: str, likeness: float) -> DataFrame:
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text"))
    rows = materialize(_sketches(own), "sketches")
    contents = materialize(rows.groupBy("node").agg(
        F.min(F.struct("key", "mark")).alias("owner"), *[F.first(name).alias(name) for name in ("bits", "blocks", "n", "bitmap")]),
        "contents")
    # A block's number and value in one long: these are the most rows of all, so they are kept narrow.
    keyed = contents.select("node", F.posexplode("blocks").alias("place", "value")).select(
        "node", (F.shiftleft(F.col("place").cast("bigint"), BLOCK_BITS) + F.col("value")).alias("block"))
    sizes = keyed.groupBy("block").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(keyed.join(sizes, "block"), "shared")

    def close(one: Column, other: Column) -> Column:
        return F.bit_count(one.bitwiseXOR(other)) <= MOST_IN_WORD

    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    led = degrees.join(contents.select("node", F.col("bits")[0].alias("word")), "node")
    ranked = materialize(shared.join(led, "node").select("block", "node", "word", "degree"), "ranked")
    leads = ranked.groupBy("block").agg(F.max(F.struct("degree", "node", "word")).alias("hub"))
    hubs = ranked.join(leads, "block").where(
        (F.col("node") != F.col("hub.node")) & close(F.col("word"), F.col("hub.word"))) \
        .groupBy("node").agg(F.max(F.struct("hub.degree", "hub.node")).alias("hub")) \
        .select(F.col("hub.node").alias("a"), F.col("node").alias("b"))
    first = _verified(_near(hubs, contents), contents, own, likeness)
    members = _members(materialize(_prefixes(own, likeness), "prefixes"))
    rooted = _rooted(members, components(first, "a", "b"))
    led = materialize(_led(rooted, likeness), "led")
    if not led.isEmpty():
        first = first.unionByName(_verified(_can_share(led, contents, likeness), contents, own, likeness))
        rooted = _rooted(members, components(first, "a", "b"))
    met = materialize(_meeting(rooted, likeness), "met")
    second = _verified(_can_share(met, contents, likeness), contents, own, likeness)
    final = components(first.unionByName(second), "a", "b").withColumnRenamed("node", "_node")
    return rows.join(final, F.col("node") == F.col("_node"), "left").select(
        F.col("key").alias(key), "mark", F.coalesce("root", "node").alias("root"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", likeness: float = LIKENESS) -> DataFrame:
    """The row with the smallest key of each group of near copies, all its columns as they are.

    Rows of equal key and text are copies like any other, so one of them stays. Rows without a key come first.
    """
    stay = groups(docs, key, text, likeness).groupBy("root").agg(
        F.min(F.struct(F.col(key).alias("key"), "mark")).alias("of")).select(
        F.col("of.key").alias("_of_key"), F.col("of.mark").alias("_of_mark"))
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    kept = docs.join(stay, F.col(key).eqNullSafe(F.col("_of_key")) & (mark == F.col("_of_mark")))
    # Equal rows meet here only if one document stands several times.
    place = F.row_number().over(Window.partitionBy("_of_key", "_of_mark").orderBy(
        *[F.col(name).cast("string") for name in docs.columns if name not in (key, text)] or [F.lit(0)]))
    return kept.withColumn("_of_place", place).where("_of_place = 1").select(*docs.columns)
