"""Command line: one subcommand per job, e.g. ``spark-submit jobs.py gold --root R``.

Below the root: ``messages`` (message files), ``raw``, ``clean``, ``gold/<table>``, ``summary``,
``runs``, ``models`` and ``checkpoints``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.features import feature_view
from millrace.operators.merge import index_files
from millrace.operators.ranking import first_rows
from millrace.plans.eda import OVERVIEW_METRICS, summary_document, summary_sections
from millrace.plans.gold import refresh_gold
from millrace.plans.modelling import PARAMS, PARTITIONS, predict_best, prepare, train_all
from millrace.plans.silver import rebuild_silver
from millrace.session import build_session, scratch_run
from millrace.sources.documents import write_document
from millrace.sources.messages import (
    BATCH_BYTES, file_messages, kafka_messages, publish, to_messages, with_envelope,
)
from millrace.sources.tables import (
    compact, read_table, sized_shuffles, table_if_exists, write_table,
)
from millrace.spec import INCIDENTS, TOPIC_BATCH
from millrace.sources.text import admit, parse_source, read_source, stamp_ingest
from millrace.streaming.ingest import ingest_writer
from millrace.streaming.run import INGEST_SECONDS, UPSERT_SECONDS, drain, run_continuously
from millrace.streaming.upsert import growing_upsert_writer


def _clean(spark: SparkSession, args) -> DataFrame:
    return read_table(spark, f"{args.root}/clean")


def _run_stream(writer, args, seconds: int) -> None:
    if args.continuous:
        run_continuously(writer, seconds).awaitTermination()
    else:
        drain(writer, args.timeout)


def produce(spark: SparkSession, args) -> None:
    """Delimited source files to messages, in a topic or in files."""
    rows = stamp_ingest(admit(parse_source(read_source(spark, args.source))))
    if args.most:
        rows = first_rows(rows, ["id"], args.most)
    messages = to_messages(rows)
    if args.servers:
        publish(messages, args.servers, args.topic)
        return
    # Offsets go on where the last run stopped: a later message of equal time is the newer one.
    sent = table_if_exists(spark, f"{args.root}/messages")
    last = sent.agg(F.max("offset")).first()[0] if sent is not None else None
    offset = F.monotonically_increasing_id() + (0 if last is None else last + 1)
    enveloped = with_envelope(messages, args.topic, F.lit(0), offset, F.current_timestamp())
    enveloped.write.mode("append").parquet(f"{args.root}/messages")


def ingest(spark: SparkSession, args) -> None:
    """Messages to the raw table."""
    if args.servers:
        messages = kafka_messages(spark, args.servers, args.topic, args.per_trigger)
    else:
        messages = file_messages(spark, f"{args.root}/messages", args.batch_bytes)
    writer = ingest_writer(messages, f"{args.root}/raw", f"{args.root}/checkpoints/raw",
                           args.writers_per_date)
    _run_stream(writer, args, INGEST_SECONDS)


def clean(spark: SparkSession, args) -> None:
    """Raw table to the clean table, as a stream."""
    writer = growing_upsert_writer(spark, f"{args.root}/raw", f"{args.root}/clean", f"{args.root}/checkpoints/clean",
                                   batch_bytes=args.batch_bytes)
    _run_stream(writer, args, UPSERT_SECONDS)


def rebuild(spark: SparkSession, args) -> None:
    """Raw table to the clean table, all at once."""
    with sized_shuffles(spark, f"{args.root}/raw"):
        print(rebuild_silver(spark, f"{args.root}/raw", f"{args.root}/clean"), "rows")


def gold(spark: SparkSession, args) -> None:
    """Clean table to the aggregate tables."""
    refresh_gold(spark, _clean(spark, args), f"{args.root}/gold")


def summary(spark: SparkSession, args) -> None:
    """Clean table to the summary document and the overview table."""
    sections = summary_sections(_clean(spark, args))
    published = F.col("label").isin(*OVERVIEW_METRICS)
    overview = sections.where("section = 'overview'").where(published).selectExpr(
        "label AS metric", "value")
    write_table(overview, f"{args.root}/gold/eda_overview")
    write_document(summary_document(sections), f"{args.root}/summary")


def features(spark: SparkSession, args) -> None:
    """Clean table to the feature snapshot."""
    write_table(feature_view(_clean(spark, args)), f"{args.root}/gold/feature_view")


def train(spark: SparkSession, args) -> None:
    """Train and log the chosen models."""
    data = prepare(_clean(spark, args), fraction=args.fraction, top_n=args.top,
                   partitions=args.partitions)
    train_all(spark, data, f"{args.root}/runs", f"{args.root}/models", args.models, args.light,
              args.auc_digits, args.parallelism)


def predict(spark: SparkSession, args) -> None:
    """Score the clean table with the best logged model."""
    scored = predict_best(spark, _clean(spark, args), f"{args.root}/runs", fraction=args.fraction)
    write_table(scored, f"{args.root}/gold/predictions")


def compact_clean(spark: SparkSession, args) -> None:
    """Rewrite the clean table into a new folder of few, even files, with an index of their keys."""
    with sized_shuffles(spark, f"{args.root}/clean"):
        compact(spark, f"{args.root}/clean", args.target, ["event_year"], [INCIDENTS.key])
    index_files(spark, args.target, INCIDENTS.key, set())


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    jobs = top.add_subparsers(required=True)

    def job(name: str, run, *options) -> None:
        sub = jobs.add_parser(name, help=run.__doc__)
        sub.add_argument("--root", required=True)
        for flags, settings in options:
            sub.add_argument(flags, **settings)
        sub.set_defaults(run=run)

    topic = [("--servers", {}), ("--topic", {"default": "events"})]
    streaming = [("--continuous", {"action": "store_true"}),
                 ("--timeout", {"type": int}), ("--batch-bytes", {"type": int, "default": BATCH_BYTES})]
    fraction = ("--fraction", {"type": float, "default": 1.0})
    job("produce", produce, ("--source", {"required": True}), ("--most", {"type": int}), *topic)
    job("ingest", ingest, *topic, ("--per-trigger", {"type": int, "default": TOPIC_BATCH}),
        ("--writers-per-date", {"type": int}), *streaming)
    job("clean", clean, *streaming)
    job("rebuild", rebuild)
    job("gold", gold)
    job("summary", summary)
    job("features", features)
    job("train", train, fraction, ("--top", {"type": int, "default": 5}),
        ("--light", {"action": "store_true"}), ("--auc-digits", {"type": int}),
        ("--partitions", {"type": int, "default": PARTITIONS}), ("--parallelism", {"type": int, "default": 1}),
        ("--models", {"nargs": "+", "choices": list(PARAMS), "default": list(PARAMS)}))
    job("predict", predict, fraction)
    job("compact", compact_clean, ("--target", {"required": True}))
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    session = spark or build_session("millrace")
    with scratch_run(session):
        args.run(session, args)
