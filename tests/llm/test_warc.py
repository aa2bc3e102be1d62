"""Archives: round trip, records on their own, revisits."""

import struct

import pytest
import zstandard

from conftest import SF0001
from sluice.llm import warc
from sluice.llm.common import shared_folder
from sqlcheck import matches_sql

PAGES = [(1, "http://a/ü", "<p>same</p>"), (2, None, "<p>same</p>"), (3, "http://c/\nx", None), (4, "u", ""), (5, "u", "é" * 70_000),
         (None, "n", "<p>same</p>"), (None, "n", "only null id"), (7, "u", "tie"), (7, "v", "tie"), (8, "w", "a\r\n\r\nWARC/1.1\r\n\r\nb")]


def expected(pages, least=0):
    out = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        ids = [p for p, _, h in pages if (h or "").encode() == body and p is not None]
        last = max(ids, default=None)
        response = len(body) < least or page_id == last
        out.append((page_id, len(body), warc.digest(body), "response" if response else "revisit", None if response else last))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,archive_bytes", [(0, 16 << 20), (5, 300)])
def test_round_trip(spark, least, archive_bytes):
    rows = [(*p, "x", 1) for p in PAGES]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string, sha int").repartition(2)
    folder = shared_folder(spark, "warc-test")
    manifest = warc.write_archives(pages, folder, least, archive_bytes)
    got = warc.read_archives(spark, folder, manifest).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(PAGES, least)
    assert all(r.intact for r in got)
    bodies = {(p, (h or "").encode()) for p, _, h in PAGES}
    assert all((r.payload is None) == (r.record_type == "revisit") and (r.payload is None or (r.page_id, bytes(r.payload)) in bodies) for r in got)


def test_no_rows(spark):
    assert warc.warc_round_trip(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_files_of_lost_attempts_do_not_count(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    folder = shared_folder(spark, "warc-test")
    warc.write_archives(pages, folder)
    manifest = warc.write_archives(pages, folder)
    assert warc.read_archives(spark, folder, manifest).count() == len(PAGES)


def test_each_record_is_a_frame_after_the_dictionary():
    records = [warc.record(i, f"http://x/{i}", f"<html><p>page number {i} of many</p>{'text ' * (i % 7)}</html>".encode(), None, False, "2020-01-01T00:00:00Z") for i in range(400)]
    data = warc.archive(records)
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and size > 0
    assert list(warc.read_archive(data)) == records
    assert len(data) < len(b"".join(zstandard.compress(r) for r in records)) / 1.5


def test_query_matches_sql(spark):
    assert matches_sql(spark, "op2_warc", SF0001) > 0


def test_large_records_get_a_dictionary_too():
    import random
    rng = random.Random(3)
    words = [f"word{i}" for i in range(2000)]
    records = [warc.record(i, f"http://x/{i}", " ".join(rng.choices(words, k=40_000)).encode(), None, False, "2020-01-01T00:00:00Z") for i in range(50)]
    data = warc.archive(records)
    size = int.from_bytes(data[4:8], "little")
    assert sum(map(len, records)) > 2 * warc.SAMPLE_BYTES and size > 10_000
    assert list(warc.read_archive(data)) == records
    few = warc.archive(records[:warc.LEAST_SAMPLES - 1])
    assert few[4:8] == b"\0\0\0\0" and list(warc.read_archive(few)) == records[:warc.LEAST_SAMPLES - 1]


def test_reading_takes_time_in_proportion_and_sees_broken_ends():
    import time
    records = [warc.record(i, None, b"payload %d" % i, None, False, "2020-01-01T00:00:00Z") for i in range(40_000)]
    times = []
    for n in (10_000, 40_000):
        data = warc.archive(records[:n])
        start = time.perf_counter()
        assert sum(1 for _ in warc.read_archive(data)) == n
        times.append(time.perf_counter() - start)
    assert times[1] < 10 * times[0]
    with pytest.raises(ValueError):
        list(warc.read_archive(data[:-5]))
