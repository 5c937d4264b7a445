"""Summary documents as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_document(df: DataFrame, path: str) -> None:
    """One JSON object per row, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_document(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
