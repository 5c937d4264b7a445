"""Delimited text: the raw source files and small result files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.lenient import (
    blank_to_null, lenient_bool, lenient_double, lenient_int, source_date_millis,
)
from millrace.spec import SOURCE_COLUMNS


# A header line, quotes doubled inside quoted fields, spaces kept.
_FORMAT = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False}
# With a schema, headers are compared with it, and one that differs is an error.
_CHECKED = {**_FORMAT, "enforceSchema": False}
# Bytes of source files in a micro-batch; at least one file is read.
BATCH_BYTES = 1 << 30


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _all_text(columns: Sequence[str]) -> str:
    return ", ".join(f"{_quoted(name)} STRING" for name in columns)


def _by_name(files: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns wherever they stand; those the files lack as NULL."""
    return files.select(*[
        F.col(_quoted(name)) if name in files.columns else F.lit(None).cast("string").alias(name)
        for name in columns])


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names as the first file's first line has them; no other line is read."""
    return spark.read.options(**_FORMAT).csv(path).columns


def read_source(spark: SparkSession, path: str, columns: Sequence[str] = SOURCE_COLUMNS,
                multi_line: bool = False) -> DataFrame:
    """Header-led delimited files, every column as text: nothing is inferred, nothing is lost.

    Columns are found by their names in the header: their order does not matter, further ones are
    left out, missing ones are NULL. All files of a folder must have the same header; another one
    is an error when its file is read.

    ``multi_line`` admits line breaks inside quoted fields; such files cannot be split, so it is
    off unless the data needs it.
    """
    reader = spark.read.schema(_all_text(_header(spark, path)))
    return _by_name(reader.options(**_CHECKED, multiLine=multi_line).csv(path), columns)


def stream_source(spark: SparkSession, path: str, columns: Sequence[str] = SOURCE_COLUMNS,
                  batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The same files as a stream, so many bytes at a time: new files are picked up as they land.

    The header is read when the stream starts, so one file must be there.
    """
    reader = spark.readStream.schema(_all_text(_header(spark, path)))
    return _by_name(reader.options(**_CHECKED, maxBytesPerTrigger=batch_bytes).csv(path), columns)


def with_origin(files: DataFrame) -> DataFrame:
    """Adds the file each row came from and that file's time; for batch and stream alike."""
    return files.select("*", F.col("_metadata.file_path").alias("source_file"),
                        F.col("_metadata.file_modification_time").alias("source_time"))


def parse_source(raw: DataFrame) -> DataFrame:
    """Text columns to the typed payload.

    The date comes out of a one-element ``explode``: a filter on a plain column would be moved
    below the projection and read every date twice.
    """
    text = F.col
    return raw.select(
        lenient_int(text("ID"), "bigint").alias("id"),
        blank_to_null(text("Case Number")).alias("case_number"),
        blank_to_null(text("Primary Type")).alias("primary_type"),
        blank_to_null(text("Description")).alias("description"),
        blank_to_null(text("Location Description")).alias("location_description"),
        lenient_bool(text("Arrest")).alias("arrest"),
        lenient_bool(text("Domestic")).alias("domestic"),
        lenient_int(text("Beat")).alias("beat"),
        lenient_int(text("District")).alias("district"),
        lenient_int(text("Ward")).alias("ward"),
        lenient_int(text("Community Area")).alias("community_area"),
        blank_to_null(text("FBI Code")).alias("fbi_code"),
        lenient_int(text("Year")).alias("year"),
        lenient_double(text("Latitude")).alias("latitude"),
        lenient_double(text("Longitude")).alias("longitude"),
        F.explode(F.array(source_date_millis(text("Date")))).alias("event_time_ms"),
    )


def admit(parsed: DataFrame) -> DataFrame:
    """Rows worth sending on: a date, a key and a type were readable."""
    return parsed.na.drop(subset=["event_time_ms", "id", "primary_type"])


def stamp_ingest(payload: DataFrame) -> DataFrame:
    """Adds the time of ingestion, the same for all rows of a run."""
    return payload.withColumn("ingestedAt", F.unix_millis(F.current_timestamp()))


def write_result(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_FORMAT).csv(path)


def read_result(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**_FORMAT).csv(path)
