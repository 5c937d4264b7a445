"""Samples and splits decided by the row's key.

The same key always falls on the same side, whatever the partitioning, so a rerun after a lost
executor, a training run and a later scoring run all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.hashing import key_bucket

# Resolution of fractions.
_STEPS = 10_000


def below_fraction(key: Column, fraction: float, salt: str, portable: bool = False) -> Column:
    return key_bucket(key, _STEPS, salt, portable) < round(fraction * _STEPS)


def hash_sample(df: DataFrame, key: str, fraction: float, salt: str = "sample",
                portable: bool = False) -> DataFrame:
    """About ``fraction`` of the keys, without replacement."""
    if fraction >= 1.0:
        return df
    return df.where(below_fraction(F.col(key), fraction, salt, portable))


def hash_split(df: DataFrame, key: str, train_ratio: float = 0.8, salt: str = "split",
               portable: bool = False) -> DataFrame:
    """Adds ``is_train``. Uses a salt of its own, independent of the sample's."""
    return df.withColumn("is_train", below_fraction(F.col(key), train_ratio, salt, portable))
