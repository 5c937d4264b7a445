"""Distinct counts and quantiles from sketches that are stored per day and merged for any range of days.

A sketch has a bounded size whatever it has seen. A range of days reads its days' sketches, so the events
themselves are read once, when their day is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Buckets of a distinct-count sketch, as a power of two, and rows of a quantile sketch's levels.
LG_BUCKETS, QUANTILE_K = 12, 400
# Bounds held with high probability: relative error of a distinct count (three standard deviations), error of a quantile's rank.
DISTINCT_ERROR = 3 * 1.04 / (1 << LG_BUCKETS) ** 0.5
RANK_ERROR = 0.01


def daily_sketches(df: DataFrame, day: Column, distinct: Sequence[str], quantiles: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per ``day`` and ``by``: ``rows``, for each of ``distinct`` a sketch ``<name>_distinct``, for each of ``quantiles`` a sketch ``<name>_quantiles``.

    Missing values are in no sketch; a column without any has an empty one for the distinct count and none for quantiles. NaNs are no
    quantile. Sketches are made in each task and merged in the shuffle, so a day with most of the rows is no burden.
    """
    kinds = dict(df.dtypes)

    def counted(name: str) -> Column:
        # Values of other types count by their text.
        return F.col(name) if kinds[name] in ("int", "bigint", "string", "binary") else F.col(name).cast("string")

    return df.groupBy(day.alias("day"), *by).agg(
        F.count("*").alias("rows"),
        *[F.hll_sketch_agg(counted(name), LG_BUCKETS).alias(f"{name}_distinct") for name in distinct],
        *[F.kll_sketch_agg_double(F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double")), QUANTILE_K).alias(
            f"{name}_quantiles") for name in quantiles])


def merged(sketches: DataFrame, distinct: Sequence[str], quantiles: Sequence[str], by: Sequence[Column | str] = ()) -> DataFrame:
    """Sketches of several days, or of several groups, as one each for ``by``."""
    return sketches.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        *[F.hll_union_agg(f"{name}_distinct").alias(f"{name}_distinct") for name in distinct],
        *[F.kll_merge_agg_double(f"{name}_quantiles", QUANTILE_K).alias(f"{name}_quantiles") for name in quantiles])


def distinct_count(sketch: Column) -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile(sketch: Column, share: float) -> Column:
    """The value below which this share of the rows lies, about."""
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def rank(sketch: Column, value: Column) -> Column:
    """The share of rows up to ``value``, about."""
    return F.kll_sketch_get_rank_double(sketch, value)
