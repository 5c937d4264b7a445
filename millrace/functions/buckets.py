"""Size classes from thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Fixed values: (lowest count, class); counts below the last threshold get the rest class.
FREQUENCY_LEVELS = ((100_000, "very_high"), (10_000, "high"), (1_000, "medium"))
FREQUENCY_REST = "low"
SIZE_LEVELS = ((200_000, "large"), (50_000, "medium"))
SIZE_REST = "small"


def threshold_bucket(value: Column, levels: Sequence[tuple[int, str]], rest: str) -> Column:
    """Name of the highest level ``value`` reaches."""
    rising = sorted(levels)
    return reduce(
        lambda lower, level: F.when(value >= level[0], level[1]).otherwise(lower),
        rising,
        F.lit(rest),
    )
