"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.session import materialize


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every linked node but the roots; a root is its component's smallest node.

    Two steps alternate until nothing changes. In the first, every node hands its smallest
    neighbour to its larger neighbours; in the second, to its smaller ones. Links become stars
    around the roots in a logarithmic number of rounds, and their number never grows. Each round is written to the
    shared folder, so that a lost executor costs no more than the round. Links of a node to itself
    and repeated links change nothing; links with a missing end are left out.
    """
    a, b = F.col(left), F.col(right)
    found = materialize(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(), "links")
    state = _state(found)
    while True:
        both = found.unionByName(found.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(smallest, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        parents = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(parents, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("to")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("to")))).alias("l"))
        found = materialize(
            small.select("l.u", F.col("l.to").alias("v")).where("u <> v").distinct(), "links")
        before, state = state, _state(found)
        if state == before:
            return found.select(F.col("u").alias("node"), F.col("v").alias("root"))
