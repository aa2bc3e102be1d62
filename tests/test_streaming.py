"""Incremental pickup: the stream checkpoint plays the manifest."""

import datetime as dt
import os
import time

from conftest import write_text
from sluice.streaming.pickup import MALFORMED, UNKNOWN, batch_writer, read_pickup, rejected_path_of, run_incremental_clean

HEADER = ["CMS Certification Number (CCN)", "Provider Name"]
LINE = "CMS Certification Number (CCN),Provider Name\n"


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def rejected(spark, out):
    return sorted((os.path.basename(r.file), r.line, r.reason) for r in read_pickup(spark, rejected_path_of(out)).collect())


def test_second_run_reads_only_new_files(spark, tmp_root):
    raw = local(tmp_root) + "/raw"
    out, ckpt = tmp_root + "/out", tmp_root + "/ckpt"
    write_text(raw, "a.csv", LINE + "1, Home A \n")
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-31")
    first = read_pickup(spark, out)
    assert first.columns == ["facility_number", "facility_name", "etl_date"]
    assert [tuple(r) for r in first.collect()] == [("1", "Home A", dt.date(2025, 1, 31))]
    # nothing new: no new rows
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-31")
    assert read_pickup(spark, out).count() == 1
    # a new file is picked up; a changed file under a known path is not re-read
    write_text(raw, "b.csv", LINE + "2,Home B\n")
    time.sleep(1)
    write_text(raw, "a.csv", LINE + "1,Changed\n")
    os.utime(os.path.join(raw, "a.csv"))
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-31")
    got = sorted(tuple(r)[:2] for r in read_pickup(spark, out).collect())
    assert got == [("1", "Home A"), ("2", "Home B")]


def test_odd_files_and_lines_are_set_aside_and_later_files_load(spark, tmp_root):
    raw = local(tmp_root) + "/raw"
    out, ckpt = tmp_root + "/out", tmp_root + "/ckpt"
    write_text(raw, "good one.csv", LINE + "1,Home A\n2,Home B,EXTRA\n3\n")
    write_text(raw, "turned.csv", "provider name,CMS Certification Number (CCN)\nHome D,4\n")
    write_text(raw, "drifted%20.csv", "Something,Provider Name\n5,Home E\n")
    write_text(raw, "twice.csv", "Provider Name,Provider-Name\n6,Home F\n")
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-31")
    assert sorted(tuple(r)[:2] for r in read_pickup(spark, out).collect()) == [("1", "Home A"), ("4", "Home D")]
    aside = [("drifted%2520.csv", "5,Home E", UNKNOWN), ("drifted%2520.csv", "Something,Provider Name", UNKNOWN),
             ("good%20one.csv", "2,Home B,EXTRA", MALFORMED), ("good%20one.csv", "3", MALFORMED),
             ("twice.csv", "6,Home F", UNKNOWN), ("twice.csv", "Provider Name,Provider-Name", UNKNOWN)]
    assert rejected(spark, out) == aside
    write_text(raw, "later.csv", LINE + "7,Home G\n")
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-31")
    assert sorted(r.facility_number for r in read_pickup(spark, out).collect()) == ["1", "4", "7"]
    assert rejected(spark, out) == aside


def test_a_folder_of_unknown_files_only(spark, tmp_root):
    raw = local(tmp_root) + "/raw"
    write_text(raw, "a.csv", "x\n1\n")
    run_incremental_clean(spark, raw, HEADER, tmp_root + "/out", tmp_root + "/ckpt")
    assert read_pickup(spark, tmp_root + "/out") is None and len(rejected(spark, tmp_root + "/out")) == 2


def test_a_repeated_batch_replaces_itself(spark, tmp_root):
    raw = local(tmp_root) + "/raw"
    write_text(raw, "a.csv", LINE + "1,A\n2,B,C\n")
    out = tmp_root + "/out"
    write = batch_writer(HEADER, out, rejected_path_of(out), {}, "2025-01-31", False, None)
    files = spark.read.format("binaryFile").load(raw).select("path")
    for number in (0, 0, 1):
        write(files, number)
    assert read_pickup(spark, out).count() == 2 and len(rejected(spark, out)) == 2


def test_stream_partitioned_by_load_date(spark, tmp_root):
    raw = local(tmp_root) + "/raw"
    out, ckpt = tmp_root + "/out", tmp_root + "/ckpt"
    write_text(raw, "a.csv", LINE + "1,A\n")
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-30", partition_by_date=True)
    write_text(raw, "b.csv", LINE + "2,B\n")
    run_incremental_clean(spark, raw, HEADER, out, ckpt, as_of="2025-01-31", partition_by_date=True)
    got = sorted((r.facility_number, str(r.etl_date)) for r in read_pickup(spark, out).collect())
    assert got == [("1", "2025-01-30"), ("2", "2025-01-31")]
    assert sorted(p for p in os.listdir(local(out)) if p.startswith("etl_date=")) == [
        "etl_date=2025-01-30", "etl_date=2025-01-31"]
