"""Ranked lexical search for many items at once, by common subexpressions.

An item's score of a document is a sum over the item's terms, so items that share terms share parts of their sums.
``shared_sums`` mines the term sets that several items have in common and makes each of them a node: the sum of two earlier
nodes. The nodes form a graph without cycles, from single terms over shared sets to items. A pass over the documents
keeps per document what any item can ask of it, its postings; over these, each node's accumulators are added up once for
a batch of documents, and every larger node and every item above it reads them there.

Integers add up to the same score in any order, so sharing changes no result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from millrace.llm.texts import keyed_texts, pieces
from millrace.session import materialize

# A term, and the text's bytes as terms are cut from them: A-Z in lower case, blanks for what separates terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_PLAIN = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))
BEST = 50
# Characters of items that one pass over the documents answers; more items take more passes.
PASS_CHARACTERS = 1 << 20
# Accumulators that a task holds at a time: nodes times documents of a batch.
HELD = 1 << 21
# Lists that the tasks' own best rows are gathered in before the last step.
LISTS = 256


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()


def shared_sums(items: Sequence[Sequence[int]], first: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """``(pairs, sums)``: node ``first + k`` is the sum of the two earlier nodes ``pairs[k]``, and each item the sum of its nodes.

    ``items`` are sets of nodes below ``first``. All are written in one order, nodes of most items first, so that what
    many items share stands side by side; then, round by round, each two neighbours that several items have become one node,
    pairs of most items before others. A round costs one look at all items, and it shortens every item with a repeated pair.
    """
    often = Counter(node for item in items for node in set(item))
    sums = [sorted(set(item), key=lambda node: (-often[node], node)) for item in items]
    pairs: list[tuple[int, int]] = []
    while True:
        counts = Counter(pair for nodes in sums for pair in zip(nodes, nodes[1:]))
        numbers: dict[tuple[int, int], int] = {}
        for i, nodes in enumerate(sums):
            places = [k for k in range(len(nodes) - 1) if counts[nodes[k], nodes[k + 1]] > 1]
            taken: set[int] = set()
            for k in sorted(places, key=lambda k: (-counts[nodes[k], nodes[k + 1]], nodes[k], nodes[k + 1])):
                if not {k - 1, k, k + 1} & taken:
                    taken.add(k)
            if taken:
                for k in taken:
                    numbers.setdefault((nodes[k], nodes[k + 1]), first + len(pairs) + len(numbers))
                sums[i] = [numbers[node, nodes[k + 1]] if k in taken else node
                           for k, node in enumerate(nodes) if k - 1 not in taken]
        if not numbers:
            return pairs, sums
        pairs += numbers


def _postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Per row its key, ``n`` (all terms), and of the vocabulary's terms it has ``terms`` (numbers) and ``tfs``."""
    schema = T.StructType([docs.schema[key], T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sizes, ends, found, tfs = [], [0], [], []
            for body in piece.column(1).to_pylist():
                words = terms(body)
                counts = Counter(filter(vocabulary.__contains__, words))
                sizes.append(len(words))
                found += map(vocabulary.__getitem__, counts)
                tfs += counts.values()
                ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], names=[key, "n", "terms", "tfs"])

    return docs.select(key, text).mapInArrow(run, schema)


def _best(postings: DataFrame, key: str, weights: np.ndarray, n_docs: int, n_terms: int,
          pairs: list[tuple[int, int]], sums: list[list[int]], limit: int) -> DataFrame:
    """``(item, key, score)``: of each task's documents the best ``limit`` of every item, by its number."""
    schema = T.StructType([T.StructField("item", T.IntegerType()), postings.schema[key], T.StructField("score", T.LongType())])
    single = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(16, HELD // (single + len(pairs)))
        lists: list[list[tuple]] = [[] for _ in sums]
        # A document has to reach this score; equal ones may still have a smaller key.
        least = np.ones(len(sums), dtype=np.int64)

        def cut(i: int) -> None:
            lists[i].sort(key=lambda row: (-row[0], row[1] is not None, row[1] if row[1] is not None else 0))
            del lists[i][limit:]
            if len(lists[i]) == limit:
                least[i] = lists[i][-1][0]

        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                keys, rows = part.column(0).to_pylist(), part.num_rows
                # Python's own integers: n times N may be large.
                m = np.array([50 + 50 * n * n_docs // max(1, n_terms) for n in part.column(1).to_pylist()], dtype=np.int64)
                lengths = part.column(2).value_lengths().to_numpy(zero_copy_only=False)
                found = part.column(2).flatten().to_numpy()
                tf = part.column(3).flatten().to_numpy()
                of = np.repeat(np.arange(rows), lengths)
                held = np.zeros((single + len(pairs), rows), dtype=np.int64)
                held[found, of] = weights[found] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[of]))
                for k, (a, b) in enumerate(pairs, single):
                    np.add(held[a], held[b], out=held[k])
                scores = np.stack([held[nodes].sum(axis=0) for nodes in sums])
                bar = least
                if rows > limit:
                    bar = np.maximum(bar, np.partition(scores, rows - limit, axis=1)[:, rows - limit])
                touched, columns = np.nonzero(scores >= bar[:, None])
                for i, d, score in zip(touched.tolist(), columns.tolist(), scores[touched, columns].tolist()):
                    lists[i].append((score, keys[d]))
                for i in np.unique(touched).tolist():
                    if len(lists[i]) > limit:
                        cut(i)
        for i in range(len(lists)):
            cut(i)
        numbers = np.repeat(np.arange(len(lists), dtype=np.int32), list(map(len, lists)))
        rows = [row for found in lists for row in found]
        yield pa.RecordBatch.from_arrays([
            pa.array(numbers), pa.array([k for _, k in rows], type=arrow_key), pa.array([s for s, _ in rows], pa.int64())],
            names=["item", key, "score"])

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_key = to_arrow_type(postings.schema[key].dataType)
    return postings.mapInArrow(run, schema)


def _top(found: DataFrame, item: str, key: str, limit: int) -> DataFrame:
    """The best rows of each item with ``rank``; the tasks' lists are gathered in a bounded number of lists first."""
    listed = found.withColumn("_list", F.spark_partition_id() % LISTS)
    order = [F.col("score").desc(), F.col(key).asc_nulls_first()]
    place = F.row_number().over(Window.partitionBy(item, "_list").orderBy(*order))
    some = listed.withColumn("_place", place).where(F.col("_place") <= limit).drop("_list", "_place")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy(item).orderBy(*order)))
    return ranked.where(F.col("rank") <= limit)


def _portions(items: DataFrame, item_key: str, item_text: str, characters: int) -> Iterator[tuple[list[tuple], bool]]:
    """Items with their different terms, in portions of about ``characters``, and whether there are several portions.

    Rows of one key are one item.
    """
    searched = items.select(F.col(item_key).alias("key"), F.coalesce(F.col(item_text), F.lit("")).alias("body"))
    total = searched.agg(F.sum(F.length("body"))).first()[0] or 0
    portions = max(1, math.ceil(total / characters))
    for number in range(portions):
        gathered: dict[object, set[bytes]] = {}
        for row in searched.where(F.pmod(F.xxhash64("key"), F.lit(portions)) == number).toLocalIterator():
            gathered.setdefault(row["key"], set()).update(terms(row["body"]))
        chosen = [(k, sorted(found)) for k, found in gathered.items() if found]
        if chosen:
            yield chosen, portions > 1


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
           item_text: str = "text", limit: int = BEST, pass_characters: int = PASS_CHARACTERS) -> DataFrame:
    """Per item its ``limit`` best documents with a score above 0: item key, ``rank``, document key, ``score``.

    A term's weight is ``floor(1000 ln((2N + 2) / (2 df + 1)))`` over all documents that have terms. Equal scores come by key, a
    missing one first. A missing or empty text has no terms and does not count in N; a document that stands several times
    is ranked each time; rows of one item key are one item, a missing key included; an item without terms finds nothing.
    Other columns of either table are not looked at. Whole texts count, and each pass reads all documents; items
    come in passes of at most ``pass_characters``, one longer item aside.

    Runs jobs while it is planned: the postings are written to the shared folder, and each item term's number of documents
    comes to the driver.
    """
    if item_key in (key, "rank", "score"):
        raise ValueError(f"{item_key} cannot name the items")
    spark = docs.sparkSession
    own = keyed_texts(docs, key, text)
    # Result columns of any name: the document's key is called _doc until the end.
    own = own.select(F.col(key).alias("_doc"), F.col(text).alias("_text"))
    schema = T.StructType([
        T.StructField("_item", items.schema[item_key].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("_doc", docs.schema[key].dataType), T.StructField("score", T.LongType())])
    results: list[DataFrame] = []
    for chosen, several in _portions(items, item_key, item_text, pass_characters):
        vocabulary: dict[bytes, int] = {}
        for _, found in chosen:
            for term in found:
                vocabulary.setdefault(term, len(vocabulary))
        postings = materialize(_postings(own, vocabulary, "_doc", "_text"), "postings")
        n_docs, n_terms = postings.agg(
            F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for row in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
            df[row["term"]] = row["df"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
        pairs, sums = shared_sums([[vocabulary[term] for term in found] for _, found in chosen], len(vocabulary))
        found = _top(_best(postings, "_doc", weights, n_docs, n_terms, pairs, sums, limit), "item", "_doc", limit)
        names = spark.createDataFrame(
            [(number, name) for number, (name, _) in enumerate(chosen)],
            T.StructType([T.StructField("item", T.IntegerType()), schema["_item"]]))
        named = found.join(F.broadcast(names), "item").select("_item", "rank", "_doc", "score")
        results.append(materialize(named, "ranked") if several else named)
    whole = reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], schema)
    return whole.select(F.col("_item").alias(item_key), "rank", F.col("_doc").alias(key), "score")
