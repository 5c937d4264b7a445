"""The trie of conversations by their first turns, from sorted shards and a skeleton of splitter paths.

A conversation is a path of turn digests; equal paths are counted together before anything is sorted. The different
paths are dealt by range into shards, each of which is a stretch of the sorted order. A node's conversations are such a
stretch too, so a node that reaches over a border between two shards is a common prefix of the paths on both sides of it.
Those nodes are the skeleton, the trie of the splitter paths: it is known from the shards' outermost paths alone,
as the length of the prefix that neighbours share, and is sent to all tasks. A task sweeps its sorted shard once and
finishes all other nodes; of skeleton nodes it has a part, and the parts are added up by key.

Every measure is a sum or a minimum over shards: of a skeleton node, the shard where it begins counts it as a child of its
parent and takes its one free copy off what sharing saves, and no other shard does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql import types as T

from millrace.session import broadcast_if_small, materialize

# Bytes of a turn's digest.
DIGEST = 16
# Keys that one row brings to the hash of a node's ends, and rows of one batch that a task returns.
CHUNK, ROWS = 4_096, 10_000
# Largest skeleton that is sent to all tasks, in nodes and bytes.
SKELETON_NODES, SKELETON_BYTES = 1_000_000, 64 << 20


def measured(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per turn the key, its ``place`` from 1 by turn, ``digest`` (of role and text) and ``bytes`` (of the text in UTF-8).

    A missing turn comes first, equal turns by role and digest; a missing role or text is empty. Rows without a key are
    left out. Texts end here: only digests are shuffled.
    """
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in (role, text))
    rows = turns.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.col(turn).alias("turn"), role.alias("role"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("turn").asc_nulls_first(), "role", "digest"))
    return rows.select(F.col("key").alias(key), place.cast("bigint").alias("place"), "digest", "bytes")


def _paths(turns: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Per key its ``path`` and the ``sizes`` of its turns; keys without turns have empty ones."""
    rows = turns.select(F.col(key).alias("key"), F.struct("place", "digest", "bytes").alias("turn")).unionByName(
        keys.select(F.col(key).alias("key")).withColumn(
            "turn", F.lit(None).cast("struct<place: bigint, digest: string, bytes: bigint>")))
    gathered = rows.groupBy("key").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    return gathered.select(
        "key", F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["bytes"]).alias("sizes"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of end and key as rows of up to ``CHUNK`` keys, joined by commas."""
    end, gathered, rows = None, [], []

    def flush() -> None:
        if gathered:
            rows.append((end, gathered[0], ",".join(map(str, gathered))))
            gathered.clear()

    def told() -> pa.RecordBatch:
        full = _batch(rows, ["end", "key", "keys"], [pa.string(), kind, pa.string()])
        rows.clear()
        return full

    for batch in batches:
        kind = batch.schema.field(1).type
        for of, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if of != end or len(gathered) == CHUNK:
                flush()
                end = of
            gathered.append(key)
        if rows:
            yield told()
    flush()
    if rows:
        yield told()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks of ends as one row per end: the hash of its chunks, joined by commas."""
    end, digest, rows = None, hashlib.sha256(), []
    for batch in batches:
        for of, keys in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if of != end:
                if end is not None:
                    rows.append((end, digest.hexdigest()))
                end, digest = of, hashlib.sha256(keys.encode())
            else:
                digest.update(b"," + keys.encode())
        if rows:
            yield _batch(rows, ["end", "ends_sha256"], [pa.string(), pa.string()])
            rows = []
    if end is not None:
        yield _batch([(end, digest.hexdigest())], ["end", "ends_sha256"], [pa.string(), pa.string()])


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names=names)


def _ends(paths: DataFrame) -> DataFrame:
    """Per ``end``, a path's digest, the hash of its keys in rising order.

    Keys are first joined in slices of the sorted order, so that the one task that hashes an end of very many
    conversations reads few rows, one after the other.
    """
    kind = paths.schema["key"].dataType
    pairs = paths.select(F.md5("path").alias("end"), "key")
    chunks = pairs.repartitionByRange("end", "key").sortWithinPartitions("end", "key").mapInArrow(_chunks, T.StructType([
        T.StructField("end", T.StringType()), T.StructField("key", kind), T.StructField("keys", T.StringType())]))
    return chunks.repartition("end").sortWithinPartitions("end", "key").mapInArrow(
        _digests, "end string, ends_sha256 string")


def _skeleton(shards: DataFrame) -> DataFrame:
    """Per shard, how many turns its first path shares with the path before it (``before``) and its last one with the path
    after it (``after``); -1 where there is none. One row a shard."""
    borders = shards.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    order = Window.orderBy("shard")  # as many rows as shards

    def shared(one, other):
        turns = (F.least(F.length(one), F.length(other)) / DIGEST).cast("int")
        same = F.when(turns > 0, F.aggregate(
            F.sequence(F.lit(1), F.greatest(turns, F.lit(1))), F.lit(0),
            lambda n, i: F.when((n == i - 1) & (
                F.substring(one, (i - 1) * DIGEST + 1, F.lit(DIGEST)) == F.substring(other, (i - 1) * DIGEST + 1, F.lit(DIGEST))),
                i).otherwise(n))).otherwise(0)
        return F.when(one.isNull() | other.isNull(), -1).otherwise(same)

    return borders.withColumns({"previous": F.lag("last").over(order), "next": F.lead("first").over(order)}).select(
        "shard", shared(F.col("first"), F.col("previous")).alias("before"), shared(F.col("last"), F.col("next")).alias("after"))


class _Node:
    """An open node of a sweep: what its closed children have added to it, and their rows, which wait for its key."""

    __slots__ = ("size", "begun", "key", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, size: int, begun: bool):
        self.size, self.begun, self.key, self.ends = size, begun, None, None
        self.n = self.children = self.leaves = self.saved = 0
        self.waiting: list[tuple] = []

    def add(self, key, n: int) -> None:
        self.key = key if self.key is None else min(self.key, key)
        self.n += n


class _Sweep:
    """One pass over the sorted paths of a shard; ``rows`` are its finished nodes and its parts of skeleton nodes.

    Memory: the open path, and a row for each child of an open node; a shard is bounded by its range.
    """

    def __init__(self, before: int, after: int):
        self.before, self.after = before, after
        self.path, self.stack, self.rows, self.first = b"", [_Node(0, before < 0)], [], True

    def take(self, path: bytes, sizes: list[int], key, n: int, ends: str) -> None:
        depth, least = 0, min(len(path), len(self.path)) // DIGEST
        while depth < least and path[depth * DIGEST:(depth + 1) * DIGEST] == self.path[depth * DIGEST:(depth + 1) * DIGEST]:
            depth += 1
        self.close(depth + 1, False)
        self.stack += [_Node(size, not (self.first and d <= self.before)) for d, size in enumerate(sizes[depth:], depth + 1)]
        self.path, self.first = path, False
        self.stack[-1].add(key, n)
        self.stack[-1].ends = ends

    def close(self, least: int, last: bool) -> None:
        """Closes the open nodes from depth ``least`` on; ``last``: the shard ends here."""
        while len(self.stack) > least:
            node, depth = self.stack.pop(), len(self.stack)
            skeleton = not node.begun or last and depth <= self.after
            leaves = node.leaves + (not node.children and not skeleton)
            saved = node.saved + (node.n - node.begun) * node.size
            name = hashlib.md5(self.path[:depth * DIGEST]).hexdigest() if skeleton else None
            for row in node.waiting:
                self.rows.append((*row, name, None if skeleton else node.key))
            row = (name, node.key, depth, node.n, node.children, leaves, saved, node.ends)
            if self.stack:
                above = self.stack[-1]
                above.add(node.key, node.n)
                above.children += node.begun
                above.leaves += leaves
                above.saved += saved
                above.waiting.append(row)
            else:
                self.rows.append((*row, None, None))


def _sweep(kind: pa.DataType):
    names = ["node", "key", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "parent", "parent_key"]
    kinds = [pa.string(), kind, *[pa.int64()] * 5, pa.string(), pa.string(), kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, sweep, done = None, None, []
        for batch in batches:
            for of, before, after, path, sizes, key, n, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if of != shard:
                    if sweep:
                        sweep.close(0, True)
                        done += sweep.rows
                    shard, sweep = of, _Sweep(before, after)
                sweep.take(path, sizes, key, n, ends)
                if len(sweep.rows) >= ROWS:
                    done += sweep.rows
                    sweep.rows = []
                if len(done) >= ROWS:
                    yield _batch(done, names, kinds)
                    done = []
        if sweep:
            sweep.close(0, True)
            done += sweep.rows
        for start in range(0, len(done), ROWS):
            yield _batch(done[start:start + ROWS], names, kinds)

    return run


def nodes(turns: DataFrame, keys: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per node: the smallest ``key`` of its conversations, ``depth``, the parent's ``parent_<key>`` (none for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (over its subtree, copies beyond the first of each last
    text, in bytes) and ``ends_sha256`` (of the keys of conversations that end here, rising, joined by commas).

    ``turns`` has the columns of ``measured``; ``keys`` names all conversations, those without turns included, which end at the root.
    Repeated keys count once, missing ones are left out, and no conversations at all make no nodes.
    A conversation's path, 16 bytes a turn, has to fit in a task; conversations of equal paths need not.
    Runs jobs while it is planned: shards and their nodes are written to the shared folder, as both are used more than once.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = keys.schema[key].dataType
    paths = materialize(_paths(turns, keys.where(F.col(key).isNotNull()), key), "paths")
    different = paths.groupBy("path").agg(
        F.first("sizes").alias("sizes"), F.min("key").alias("key"), F.count("*").alias("n"))
    told = different.withColumn("end", F.md5("path")).join(_ends(paths), "end")
    shards = materialize(told.drop("end").repartitionByRange("path").withColumn("shard", F.spark_partition_id()), "shards")
    placed = shards.join(F.broadcast(_skeleton(shards)), "shard").select(
        "shard", "before", "after", "path", "sizes", "key", "n", "ends_sha256")
    schema = T.StructType([
        T.StructField("node", T.StringType()), T.StructField("key", kind),
        *[T.StructField(name, T.LongType()) for name in ("depth", "n_convs", "n_children", "n_leaves", "saved_tokens")],
        T.StructField("ends_sha256", T.StringType()), T.StructField("parent", T.StringType()), T.StructField("parent_key", kind)])
    swept = materialize(placed.repartitionByRange("shard").sortWithinPartitions("shard", "path").mapInArrow(
        _sweep(to_arrow_type(kind)), schema), "nodes")
    skeleton = swept.where("node IS NOT NULL").groupBy("node").agg(
        F.min("key").alias("key"), F.max("depth").alias("depth"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256"), F.max("parent").alias("parent"), F.max("parent_key").alias("parent_key"))
    skeleton = materialize(skeleton, "skeleton")
    names = skeleton.select(F.col("node").alias("parent"), F.col("key").alias("_key"))
    found = swept.where("node IS NULL").unionByName(skeleton)
    below = found.where("parent IS NOT NULL").join(
        broadcast_if_small(names, SKELETON_NODES, SKELETON_BYTES), "parent").withColumn("parent_key", F.col("_key")).drop("_key")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return found.where("parent IS NULL").unionByName(below.select(*found.columns)).select(
        F.col("key").alias(key), "depth", F.col("parent_key").alias(f"parent_{key}"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
