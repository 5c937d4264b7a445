import base64
import gzip
import hashlib
from collections import Counter, defaultdict
from datetime import datetime

import pytest

from millrace.llm import warc
from millrace.llm.warc import from_pages, read_archives, resolve, resolved, write_archives
from millrace.session import scratch_path
from oracle import connect, difference

PAGES = "page_id long, url string, html string"


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def brute(pages, least=0):
    """Page by page; a missing key is the smallest."""
    def place(key):
        return (key is not None, key or 0)

    groups = defaultdict(list)
    for key, _, html in pages:
        groups[(html or "").encode()].append(key)
    rows = Counter()
    for payload, keys in groups.items():
        top = max(keys, key=place)
        for i, key in enumerate(sorted(keys, key=place, reverse=True)):
            response = i == 0 or len(payload) < least
            rows[key, len(payload), digest(payload), "response" if response else "revisit", None if response else top] += 1
    return rows


def written(spark, pages, least=0, extra=""):
    path = scratch_path(spark, "archives")
    table = spark.createDataFrame(pages, PAGES)
    write_archives(from_pages(table.selectExpr("*", *filter(None, [extra]))), path, least)
    return path


def ours(records):
    return Counter((r["key"] and int(r["key"]), r["bytes"], r["digest"], r["kind"], r["original"] and r["original"]["key"] and int(
        r["original"]["key"])) for r in resolved(records).collect())


ODD = [(1, "http://a/1", "<p>\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\n\r\n</p>"), (2, None, None), (3, "http://b/ x\r\nX-Source-Key: 9", ""),
       (4, "http://a/4", "é\x00\x01😀" * 3), (5, "http://a/5", "é\x00\x01😀" * 3), (5, "http://a/5", "é\x00\x01😀" * 3),
       (None, "http://c/ü", "no key"), (7, "http://a/7", "x" * 300_000), (8, "http://a/8", "\r\n\r\n"), (9, "", "no key"),
       (-3, "http://a/9", "\n")]


@pytest.mark.parametrize("least", [0, 7])
def test_round_trip_of_odd_pages(spark, least):
    records = read_archives(spark, written(spark, ODD, least, "'k' AS key"))
    assert ours(records) == brute(ODD, least)
    payloads = {r["payload"].decode() for r in records.where("kind = 'response'").collect()}
    assert payloads == {html or "" for _, _, html in ODD}


def test_archives_are_readable_records(spark):
    path = written(spark, ODD)
    content = b"".join(gzip.decompress(r["content"]) for r in spark.read.format("binaryFile").load(path).collect())
    found = list(warc._records(content))
    assert len(found) == len(ODD) and len({fields["warc-record-id"] for fields, _, _ in found}) == len(ODD)
    ids = {fields["warc-record-id"]: fields for fields, _, _ in found}
    for fields, kind, payload in found:
        datetime.strptime(fields["warc-date"], "%Y-%m-%dT%H:%M:%SZ")
        assert not set(fields["warc-target-uri"]) & set(" \r\n")
        if kind == "response":
            assert fields["warc-payload-digest"] == "sha1:" + digest(payload)
        else:
            first = ids[fields["warc-refers-to"]]
            assert first["warc-type"] == "response" and fields["warc-refers-to-date"] == first["warc-date"]
            assert fields["warc-payload-digest"] == first["warc-payload-digest"]
            assert fields["warc-refers-to-target-uri"] == first["warc-target-uri"]


def test_written_again_archives_say_the_same(spark):
    records = read_archives(spark, written(spark, ODD))
    again = scratch_path(spark, "archives")
    write_archives(records.withColumn("key", records["key"].cast("bigint")), again)
    second = read_archives(spark, again)
    assert ours(second) == brute(ODD)
    ids = [{r["record_id"] for r in found.select("record_id").collect()} for found in (records, second)]
    assert not ids[0] & ids[1]


def test_two_archives_become_one_without_repeats(spark):
    one, other = ODD[:6], [(20, "http://z", ODD[4][2]), (21, "http://y", "new")]
    records = read_archives(spark, written(spark, one)).unionByName(read_archives(spark, written(spark, other)))
    path = scratch_path(spark, "archives")
    write_archives(records.withColumn("key", records["key"].cast("bigint")), path)
    assert ours(read_archives(spark, path)) == brute(one + other)


def test_a_payload_of_very_many_pages(spark):
    pages = [(i, f"http://h/{i}", "same" if i % 3 else f"own {i}") for i in range(3_000)]
    assert ours(read_archives(spark, written(spark, pages))) == brute(pages)


def test_revisits_without_a_response_stay(spark):
    path = written(spark, ODD[3:5])
    lone = read_archives(spark, path).where("kind = 'revisit'")
    again = scratch_path(spark, "archives")
    write_archives(lone, again)
    kept = read_archives(spark, again).collect()
    assert len(kept) == 1 and kept[0]["kind"] == "revisit" and kept[0]["refers_to"] == lone.first()["refers_to"]
    assert resolved(read_archives(spark, again)).first()["original"] is None


@pytest.mark.parametrize("content", [b"", b"junk", b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 50\r\n\r\nshort",
                                     b"WARC/1.0\r\nWARC-Type: response\r\n\r\n", gzip.compress(b"WARC/1.0\r\n" * 50)[:30]])
def test_broken_files_end_in_a_row_that_says_so(spark, tmp_path, content):
    (tmp_path / "a.warc").write_bytes(content)
    kinds = [r["kind"] for r in read_archives(spark, str(tmp_path)).collect()]
    assert kinds == (["broken"] if content else [])


def test_every_record_a_member_of_its_own(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(record % k) for k in (b"warcinfo", b"response", b"request")))
    rows = read_archives(spark, str(tmp_path)).collect()
    assert [(r["kind"], r["payload"] and bytes(r["payload"])) for r in rows] == [("warcinfo", None), ("response", b"ab"), ("request", None)]


def test_empty_table(spark):
    assert read_archives(spark, written(spark, [])).count() == 0


def test_query_equals_sql(spark, sf):
    from millrace.llm.queries import QUERIES

    query = QUERIES["op12_warc"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None
