"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Remembers a local session's own folder; the cluster's setting cannot be changed at run time.
_OWN_SCRATCH = "spark.millrace.scratch"
# The folder of the job that is running, below the shared one.
_RUN = "spark.millrace.run"
# Rows and bytes of a side that every executor gets.
BROADCAST_ROWS, BROADCAST_BYTES = 10_000, 32 << 20


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings every job relies on; the master comes from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # State of streams beside the heap, its changes and not its whole written with each batch.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKS)
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        # A stream's rows become sessions in each task before they are shuffled.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        # Size of one post-shuffle task, and so of one file written after a rebalance.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a machine-local path
    would be invisible to the other executors, so its absence is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_SCRATCH, None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(_OWN_SCRATCH, root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A folder name not used before, below the running job's folder or the shared one."""
    root = spark.conf.get(_RUN, None) or scratch_root(spark)
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """While it lasts, everything stored on the way goes into one folder; at its end that folder is
    removed, whether the job succeeded or not. What the job returns must be written by then."""
    path = f"{scratch_root(spark)}/run-{uuid.uuid4().hex}"
    before = spark.conf.get(_RUN, None)
    spark.conf.set(_RUN, path)
    try:
        yield path
    finally:
        if before is None:
            spark.conf.unset(_RUN)
        else:
            spark.conf.set(_RUN, before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that outlive lost executors, and lets several consumers share
    one computation with column pruning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    # Partition columns are declared rather than inferred, so their types do not change.
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS,
                       max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if it has been measured to be small, else leave the join to the planner.

    Runs a job while the plan is being built: it counts the rows and their size as text, and stops
    reading past the largest number of rows.
    """
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df
