"""WARC archives without repeated payloads: revisit records resolved by payload digest, written with fresh headers.

Headers alone are shuffled by digest: each digest's original is found from partial maxima, one a digest and slice, so that a
payload that a third of all records carry is spread over ``SLICES`` tasks, both when originals are found and when
they are joined back. Payloads move once, to the archive that they are written to; copies of one record are merged before that.

An archive is a text file whose lines end in the two line breaks that end a WARC record, so Spark's own writer makes it, on any file
system and with any bytes in it. Reading takes files whole, one at a time, and goes by the lengths in the headers.
"""

from __future__ import annotations

import gzip
import io
import math
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from millrace.llm.texts import PIECE_BYTES, PIECE_ROWS
from millrace.session import materialize

# Parts of a digest's records that are looked at apart.
SLICES = 64
# Payload bytes that go into one archive.
ARCHIVE_BYTES = 128 << 20
RESPONSE, REVISIT, BROKEN = "response", "revisit", "broken"
END = "\r\n\r\n"
# Fixed values of the format.
VERSION = "WARC/1.0"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# The field that carries a row's key, percent-encoded.
KEY_FIELD = "X-Source-Key"

SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in (
    "record_id", "kind", "uri", "date", "key", "stated_digest", "refers_to")] + [T.StructField("payload", T.BinaryType())])


def payload_digest(payload: Column) -> Column:
    """SHA-1 in base 32, upper case: 160 bits in four runs of 40."""
    digest = F.sha1(payload)
    return F.translate(F.concat(*[
        F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]), DIGITS32, BASE32)


def _header_text(value: Column) -> Column:
    """Without the characters that would end a header line: controls and blanks are percent-encoded."""
    controls = [chr(c) for c in (*range(0x21), 0x7F)]
    clean = reduce(lambda text, c: F.replace(text, F.lit(c), F.lit(f"%{ord(c):02X}")), controls, value)
    return F.when(value.rlike(r"[\x00-\x20\x7F]"), clean).otherwise(value)


def from_pages(pages: DataFrame, key: str = "page_id", uri: str = "url", html: str = "html",
               date: Column | None = None) -> DataFrame:
    """Pages as response records: ``key``, ``uri``, ``date`` (text in UTC; now, unless given), ``kind``, ``stated_digest`` (none) and
    ``payload``. A missing text is an empty payload, a missing address an empty one; other columns are not looked at."""
    when = F.to_utc_timestamp(F.current_timestamp() if date is None else date, F.current_timezone())
    return pages.select(
        F.col(key).alias("key"), F.coalesce(F.col(uri), F.lit("")).alias("uri"),
        F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), F.lit(RESPONSE).alias("kind"),
        F.lit(None).cast("string").alias("stated_digest"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))


def _headers(records: DataFrame) -> DataFrame:
    """A record's columns without its payload, but with its ``digest`` and ``bytes``.

    A response's digest is that of its payload, whatever it states; a revisit has only the stated one.
    """
    has = F.col("kind") == RESPONSE
    return records.select(
        *[name for name in records.columns if name != "payload"],
        F.when(has, payload_digest(F.col("payload"))).otherwise(F.col("stated_digest")).alias("digest"),
        F.when(has, F.octet_length("payload")).cast("bigint").alias("bytes"))


def resolve(headers: DataFrame, least: int = 0) -> DataFrame:
    """``headers`` with ``original``, a struct of ``key``, ``record_id``, ``uri``, ``date``, ``bytes`` and ``digest``: of the responses
    with an equal payload of at least ``least`` bytes the one with the largest key, itself perhaps.

    ``headers`` has these columns, ``kind`` and a unique ``record_id``. Missing keys are the smallest; of equal ones the one whose
    ``record_id`` has the largest hash counts. Smaller responses, and revisits whose payload no response has, have none.
    """
    sliced = headers.withColumn("_digest", F.coalesce("digest", "record_id")).withColumn(
        "_id", F.xxhash64("record_id")).withColumn("_slice", F.pmod("_id", F.lit(SLICES)))
    small = F.col("bytes") < least
    # What is shuffled to find originals is narrow: a digest, a key and a number.
    candidate = F.when((F.col("kind") == RESPONSE) & ~small, F.struct("key", "_id"))
    parts = sliced.groupBy("_digest", "_slice").agg(F.max(candidate).alias("top"))
    # One row a slice of a digest.
    tops = parts.withColumn("_top", F.max("top").over(Window.partitionBy("_digest"))).select(
        "_digest", "_slice", F.col("_top._id").alias("_top"))
    placed = sliced.join(tops, ["_digest", "_slice"])
    own = F.struct("key", "record_id", "uri", "date", "bytes", "digest")
    alone = (F.col("kind") == RESPONSE) & small | F.col("_top").isNull()
    itself = placed.where(alone | (F.col("_top") == F.col("_id"))).select(
        *headers.columns, F.when(~alone, own).alias("original"))
    # Only records that refer to another one look for what its header says.
    others = placed.where(~alone & (F.col("_top") != F.col("_id")))
    originals = headers.where(F.col("kind") == RESPONSE).select(F.xxhash64("record_id").alias("_top"), own.alias("original"))
    spread = others.withColumn("_slice", F.pmod(F.xxhash64("_id"), F.lit(SLICES)))
    asked = spread.select("_top", "_slice").distinct()
    known = asked.join(originals, "_top")
    return itself.unionByName(spread.join(known, ["_top", "_slice"]).select(*headers.columns, "original"))


def _record_id(*parts: Column) -> Column:
    digest = F.md5(F.concat_ws("\n", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in cuts]))


def _lines(fields: list[tuple[str, Column]], length: Column) -> Column:
    """A record's header; a field without a value is left out."""
    lines = [F.lit(VERSION), *[F.concat(F.lit(f"{name}: "), value) for name, value in fields],
             F.concat(F.lit("Content-Length: "), length.cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END))


@contextmanager
def _shuffled_to(spark: SparkSession, tasks: int) -> Iterator[None]:
    """While it lasts, shuffles have so many tasks at least; adaptive execution merges what turns out small."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, max(tasks, int(before)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_archives(records: DataFrame, path: str, least: int = 0) -> None:
    """Writes compressed archives to a new folder: of records with equal payloads of at least ``least`` bytes one response, the
    others as revisits of it; smaller ones are all responses.

    ``records`` has the columns of ``from_pages`` or of ``read_archives``; a revisit among them is resolved to the response whose payload
    has its digest, and keeps its own reference if there is none. Record ids, digests, lengths and references are all
    written anew. Records that stand several times are written each time. Records of other kinds are left out.
    """
    spark = records.sparkSession
    records = records.where(F.col("kind").isin(RESPONSE, REVISIT))
    if "refers_to" not in records.columns:
        records = records.withColumn("refers_to", F.lit(None).cast("string"))
    own = records.drop("record_id").withColumn("mark", F.xxhash64("key", "uri"))
    # The number is good for one run of the scan only, so it is written with the headers.
    headers = materialize(_headers(own).withColumn("number", F.monotonically_increasing_id()), "headers").withColumn(
        "record_id", _record_id(F.lit(uuid.uuid4().hex), F.col("number"), F.col("key"), F.col("digest")))
    decided = materialize(resolve(headers, least), "decided")
    total = headers.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    original = F.col("original")
    repeats = (F.col("kind") == REVISIT) | (original.isNotNull() & (original["record_id"] != F.col("record_id")))
    payloads = own.where(F.col("kind") == RESPONSE).select(
        "mark", payload_digest(F.col("payload")).alias("digest"), F.col("payload").cast("string").alias("payload")) \
        .groupBy("mark", "digest").agg(F.first("payload").alias("payload"))
    named = [
        ("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        ("WARC-Date", F.col("date")), ("WARC-Target-URI", _header_text(F.col("uri"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        (KEY_FIELD, F.url_encode(F.col("key").cast("string")))]
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    responses = decided.where(~repeats).join(payloads, ["mark", "digest"]).select(F.concat(_lines(
        [("WARC-Type", F.lit(RESPONSE)), *named, ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.octet_length(http) + F.col("bytes")), http, F.col("payload")).alias("record"))
    refers = F.coalesce(original["record_id"], F.col("refers_to"))
    revisits = decided.where(repeats).select(_lines([
        ("WARC-Type", F.lit(REVISIT)), *named, ("WARC-Profile", F.lit(PROFILE)),
        ("WARC-Refers-To", F.concat(F.lit("<"), refers, F.lit(">"))),
        ("WARC-Refers-To-Target-URI", _header_text(original["uri"])),
        ("WARC-Refers-To-Date", original["date"])], F.lit(0)).alias("record"))
    with _shuffled_to(spark, math.ceil(total / ARCHIVE_BYTES)):
        responses.unionByName(revisits).write.option("lineSep", END).option("compression", "gzip").text(path)


def _records(content: bytes) -> Iterator[tuple]:
    """The records of one archive, compressed or not; a last one of kind ``BROKEN`` where it cannot be read on."""
    raw = io.BytesIO(content)
    file = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if content[:2] == b"\x1f\x8b" else raw
    try:
        while line := file.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError("no record begins here")
            fields: dict[str, str] = {}
            while (line := file.readline()).strip():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                fields[name.strip().lower()] = value.strip()
            length = int(fields["content-length"])
            block = file.read(length)
            if len(block) < length:
                raise ValueError("the record breaks off")
            kind = fields.get("warc-type", "")
            if kind == RESPONSE and fields.get("content-type", "").startswith("application/http"):
                block = block.partition(b"\r\n\r\n")[2]
            yield fields, kind, block if kind == RESPONSE else None
    except (ValueError, KeyError, EOFError, OSError):
        yield {}, BROKEN, None


def _row(fields: dict[str, str], kind: str, payload: bytes | None) -> tuple:
    from urllib.parse import unquote_plus

    def bare(name: str) -> str | None:
        return fields[name].strip("<>") if name in fields else None

    key, digest = fields.get(KEY_FIELD.lower()), fields.get("warc-payload-digest")
    return (bare("warc-record-id"), kind, fields.get("warc-target-uri"), fields.get("warc-date"),
            None if key is None else unquote_plus(key), digest and re.sub("^sha1:", "", digest), bare("warc-refers-to"), payload)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = SCHEMA.fieldNames()
    kinds = [pa.string()] * (len(names) - 1) + [pa.binary()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    rows, size = [], 0
    for files in batches:
        for content in files.column(0):
            for record in _records(content.as_py()):
                rows.append(_row(*record))
                size += len(record[2] or b"")
                if size > PIECE_BYTES or len(rows) == PIECE_ROWS:
                    yield batch(rows)
                    rows, size = [], 0
    if rows:
        yield batch(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in a folder: ``record_id``, ``kind``, ``uri``, ``date``, ``key``, ``stated_digest``, ``refers_to`` (a record id)
    and, of responses, ``payload``, without the transfer's own headers.

    A task holds a file's bytes and a few records. A file that breaks off ends in a record of kind ``broken``.
    """
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_read, SCHEMA)


def resolved(records: DataFrame) -> DataFrame:
    """The headers of records read, with ``digest`` and ``bytes`` of their payloads; of revisits those of the original's, and ``original``."""
    found = resolve(_headers(records))
    of = F.when(F.col("kind") == REVISIT, F.col("original"))
    return found.select(
        "record_id", "kind", "uri", "date", "key", "refers_to", F.coalesce(of["digest"], "digest").alias("digest"),
        F.coalesce(of["bytes"], "bytes").alias("bytes"), of.alias("original"))
