"""Totals over several groupings at once, and how many rows two tables differ by."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

Measures = Mapping[str, tuple[Column, Callable[[str], Column]]]
# Name of the column that tells totals from groups whose value is missing.
LEVEL = "total_over"


def cube_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(chosen) for n in range(len(dims), -1, -1) for chosen in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    return [list(dims[:n]) for n in range(len(dims), -1, -1)]


def grouped_totals(df: DataFrame, dims: Sequence[str], measures: Measures, sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """``measures`` for every grouping in ``sets`` (all of them, unless given), with ``total_over``: the dimensions summed
    over, joined by commas, empty at the finest level. There a missing value is a group of its own.

    A measure is an aggregate over rows, and how parts of it are put together: ``{"n": (F.count("*"), F.sum)}``.

    The finest level is made first, so rows are shuffled once, combined; its cells alone are written out once for each
    grouping and meet in one more shuffle, however many groupings there are. Of the grand total each task makes one row
    before that. An empty table has no groups, the grand total aside if it is asked for: there measures say what they say of no cells.
    """
    cells = df.groupBy(*dims).agg(*[part.alias(name) for name, (part, _) in measures.items()])
    wanted = [list(chosen) for chosen in (cube_sets(dims) if sets is None else sets)]
    over = F.concat_ws(",", *[F.when(F.grouping(name) == 1, name) for name in dims])
    return cells.groupingSets([[F.col(name) for name in chosen] for chosen in wanted], *dims).agg(
        over.alias(LEVEL), *[merge(name).alias(name) for name, (_, merge) in measures.items()]).select(*dims, LEVEL, *measures)


def table_difference(one: DataFrame, other: DataFrame, missing: str = "missing", surplus: str = "surplus") -> DataFrame:
    """Rows that ``one`` and ``other`` do not hold equally often: how many ``other`` lacks, and how many it has too many.

    Equal tables give no rows. Columns are matched by name and must be the same; missing values are equal to each other, as are
    NaNs. Both tables are combined in each task and meet in one shuffle, as signed counts, so a row that fills a third of a table is no
    burden. Maps have no order and cannot be compared.
    """
    if sorted(one.columns) != sorted(other.columns):
        raise ValueError(f"columns differ: {sorted(one.columns)} / {sorted(other.columns)}")
    both = one.withColumn("_sign", F.lit(1).cast("bigint")).unionByName(other.withColumn("_sign", F.lit(-1).cast("bigint")))
    counted = both.groupBy(*one.columns).agg(F.sum("_sign").alias("_more")).where("_more <> 0")
    return counted.select(*one.columns, F.greatest("_more", F.lit(0)).alias(missing), F.greatest(-F.col("_more"), F.lit(0)).alias(surplus))
