"""Corpus preparation in stages; each reads what the one before it kept.

Stages work on ``documents`` with whatever further columns it has, and return the same columns, the last one the packed
pieces. A missing text is an empty document, rows that stand twice are copies, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import decontamination, lines, near_copies, toxicity
from millrace.llm.queries import PREDICTED, packed, toxicity_model
from millrace.session import materialize


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic, by a model of the labelled ones among them."""
    model = toxicity_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.below(docs, model, PREDICTED)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of long runs of lines; those that lose all their text go."""
    names = docs.columns
    marked = docs.withColumn("_had_words", F.length(F.trim("text")) > 0)
    clean = lines.without_later_copies(marked)
    emptied = (F.size("deleted_lines") > 0) & F.col("_had_words") & (F.length(F.trim("text")) == 0)
    left = clean.where(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in names:
        left = left.withColumn("n_chars", F.when(F.size("deleted_lines") > 0, F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*names)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return near_copies.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packed(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("near dedup", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", pack),
]

# The stages train a model and pack tokens, which SQL cannot express; a test compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
