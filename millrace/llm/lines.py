"""Repeated runs of lines, found by a suffix array over the corpus's lines, and their later copies removed.

The corpus is one sequence of line identities, in order of keys, with a gap after each document. Prefix doubling
ranks all suffixes by their first line, then by their first 2, 4, 8 lines: the pair of ranks at a place
and half a length further on is ranked anew. A rank is where the suffixes that share those lines begin in the
suffix array, so a class of equal ranks is an interval of common prefixes; suffixes that are alone in theirs drop out at once. Any number
of lines is compared by the ranks of two powers of two that cover it.

A run counts if it has ``least_words`` words. For each line the shortest such runs that begin and that end with it
are looked up; wherever one stands a second time, its later copies go. Together they cover every longer repeated run, as
each of its lines lies in such a run inside it. Only whole lines count: of a passage that begins or ends inside a line, the
parts in those lines are outside the method.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from millrace.llm.texts import map_rows, text_batches
from millrace.operators.ranking import running_totals
from millrace.session import materialize

LEAST_WORDS = 50


def _lines(docs: DataFrame, key: str, least_words: int) -> DataFrame:
    """A row per line: its document, number, identity, and how many lines its shortest runs take (0 for none)."""
    long = T.LongType()
    schema = T.StructType([T.StructField("key", docs.schema[key].dataType), *[
        T.StructField(name, long) for name in ("mark", "lines", "line", "high", "low", "forward", "back")]])

    def prepare():
        from xxhash import xxh3_128_digest

        def split(columns: dict[str, list]) -> dict[str, np.ndarray | list]:
            keys, found = [], {name: [] for name in schema.fieldNames()[1:]}
            for name, mark, body in zip(columns["key"], columns["mark"], columns["text"]):
                lines = body.encode("utf-8", "surrogatepass").split(b"\n")
                n = len(lines)
                total = np.cumsum([0, *[len(line.split()) for line in lines]])
                ends = np.searchsorted(total, total[:-1] + least_words)
                starts = np.searchsorted(total, total[1:] - least_words, side="right") - 1
                at = np.arange(n)
                digests = np.frombuffer(b"".join(map(xxh3_128_digest, lines)), dtype="<i8").reshape(n, 2)
                keys += [name] * n
                for column, values in (
                        ("mark", np.full(n, mark)), ("lines", np.full(n, n)), ("line", at),
                        ("high", digests[:, 0]), ("low", digests[:, 1]),
                        ("forward", np.where(ends <= n, ends - at, 0)),
                        ("back", np.where(starts >= 0, at + 1 - starts, 0))):
                    found[column].append(values)
            return {"key": keys, **{
                name: np.concatenate(parts) if parts else [] for name, parts in found.items()}}

        return split

    return map_rows(docs, ["key", "mark", "text"], schema, prepare)


def _ranked(places: DataFrame, keys: list[str]) -> DataFrame:
    """``p`` and ``rank`` of the places that share their keys with others."""
    classes = places.groupBy(*keys).agg(F.count("*").alias("size")).where("size > 1")
    ranks = running_totals(classes, [], keys, ["size"]).select(
        *[F.col(name).alias(f"_{name}") for name in keys], F.col("before_size").alias("_begin"))
    same = [F.col(name) == F.col(f"_{name}") for name in keys]
    return materialize(places.join(ranks, same).select("p", F.col("_begin").alias("rank")), "ranks")


def later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 least_words: int = LEAST_WORDS) -> DataFrame:
    """``key``, ``mark`` (the text's hash) and ``runs``, an array of ``line`` and ``count``: what to delete.

    A run is deleted where it stands after its first place in order of keys, then of the texts' hashes, without overlapping it. Lines are
    compared byte by byte; words are divided by white space. Rows of equal key and text are one document. Missing
    texts have no lines that count. Documents without deletions have no row.
    """
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "mark", F.xxhash64("text"))
    with text_batches(docs.sparkSession):
        lines = materialize(_lines(own, "key", least_words), "lines")
    # A document takes one place more than it has lines, so no run reaches into the next.
    sizes = lines.where("line = 0").select("key", "mark", (F.col("lines") + 1).alias("size")).distinct()
    begins = running_totals(sizes, [], ["key", "mark"], ["size"]).select(
        F.col("key").alias("_key"), F.col("mark").alias("_mark"), F.col("before_size").alias("begin"))
    placed = lines.join(begins, F.col("key").eqNullSafe(F.col("_key")) & (F.col("mark") == F.col("_mark"))).select(
        (F.col("begin") + F.col("line")).alias("p"), "key", "mark", "line", "high", "low", "forward", "back") \
        .dropDuplicates(["p"])
    sequence = materialize(placed, "line-places")
    rank = _ranked(sequence.select("p", "high", "low"), ["high", "low"])
    kept = sequence.join(rank.select("p"), "p", "left_semi")
    runs = materialize(
        kept.where("forward > 0").select("p", "key", "mark", "line", F.col("forward").alias("count")).unionByName(
            kept.where("back > 0").select(
                (F.col("p") - F.col("back") + 1).alias("p"), "key", "mark",
                (F.col("line") - F.col("back") + 1).alias("line"), F.col("back").alias("count"))).distinct(), "runs")
    longest = runs.agg(F.max("count")).first()[0] or 0

    found, size = None, 1
    while size <= longest:
        # Runs of size to 2 size - 1 lines, by the ranks of their first and last ``size`` lines.
        last = rank.select(F.col("p").alias("q"), F.col("rank").alias("last"))
        covered = runs.where(F.col("count").between(size, 2 * size - 1)).join(rank, "p").join(
            last, F.col("p") + F.col("count") - size == F.col("q")).select(
            "p", "key", "mark", "line", "count", "rank", "last")
        firsts = covered.groupBy("rank", "last", "count").agg(F.min("p").alias("first"), F.count("*").alias("n")) \
            .where("n > 1").select(F.col("rank").alias("_rank"), F.col("last").alias("_last"),
                                   F.col("count").alias("_count"), "first")
        copies = materialize(covered.join(firsts, [
            F.col("rank") == F.col("_rank"), F.col("last") == F.col("_last"), F.col("count") == F.col("_count"),
            F.col("p") - F.col("first") >= F.col("count")]).select("key", "mark", "line", "count"), "copies")
        found = copies if found is None else found.unionByName(copies)
        if 2 * size <= longest:
            further = rank.select((F.col("p") - size).alias("p"), F.col("rank").alias("next"))
            rank = _ranked(rank.join(further, "p"), ["rank", "next"])
            if rank.isEmpty():
                break
        size *= 2
    if found is None:
        found = runs.select("key", "mark", "line", "count").limit(0)
    return found.groupBy("key", "mark").agg(F.array_sort(F.collect_set(F.struct("line", "count"))).alias("runs")) \
        .select(F.col("key").alias(key), "mark", "runs")


def without_later_copies(docs: DataFrame, key: str = "doc_id", text: str = "text",
                         least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with ``text`` rid of later copies, and ``deleted_lines``, an array of line numbers.

    All rows and all other columns stay as they are, texts that lose every line as empty ones; only a column named
    ``deleted_lines`` is replaced.
    """
    names = [name for name in docs.columns if name != "deleted_lines"]
    runs = later_copies(docs, key, text, least_words).select(
        F.col(key).alias("_of_key"), F.col("mark").alias("_of_mark"), F.col("runs").alias("_of_runs"))
    marked = docs.select(*names).join(
        runs, F.col(key).eqNullSafe(F.col("_of_key"))
        & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("_of_mark")), "left")
    numbers = F.array_sort(F.array_distinct(F.flatten(F.transform(
        "_of_runs", lambda r: F.sequence(r["line"], r["line"] + r["count"] - 1)))))
    deleted = F.coalesce(numbers, F.array().cast("array<bigint>"))
    split = F.split(F.col(text), "\n")
    left = F.array_except(F.sequence(F.lit(0).cast("bigint"), F.size(split).cast("bigint") - 1), deleted)
    rest = F.array_join(F.transform(left, lambda i: F.get(split, i.cast("int"))), "\n")
    return marked.withColumn("deleted_lines", deleted).withColumn(
        text, F.when(F.size("deleted_lines") > 0, rest).otherwise(F.col(text))).select(*names, "deleted_lines")
