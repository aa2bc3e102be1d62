import os
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from sluice.sources.csv import CORRUPT_COLUMN, header_groups, read_raw, write_csv
from sluice.sources.files import list_files
from sluice.sources.manifest import append_manifest, read_manifest
from sluice.sources.parquet import read_domain, write_domain, write_facets


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_header_drift_realigned_d22(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "f1.csv", "a,b,c\n1,2,3\n4,5,6\n")
    write_text(d, "f2.csv", "c,a,b,x\n9,7,8,X\n")
    assert header_groups(spark, d).count() == 2
    out = read_raw(spark, d)
    got = {(r.a, r.b, r.c, r.x) for r in out.collect()}
    assert got == {("1", "2", "3", None), ("4", "5", "6", None), ("7", "8", "9", "X")}
    assert out.columns[-1] == CORRUPT_COLUMN


def test_one_header_per_folder_when_disabled(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "f1.csv", "a,b\n1,2\n")
    out = read_raw(spark, d, align_headers=False, keep_corrupt=False)
    assert out.columns == ["a", "b"] and out.first() == ("1", "2")


def test_bad_lines_kept_in_corrupt_column(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "f.csv", "a,b\n1,2,3\n4\n5,6\n")
    rows = {(r.a, r.b, r[CORRUPT_COLUMN]) for r in read_raw(spark, d).collect()}
    assert ("1", "2", "1,2,3") in rows and ("4", None, "4") in rows and ("5", "6", None) in rows


def test_duplicate_headers_numbered_d26(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "f.csv", "a,b,c,d,e,f,Dup,Dup\n1,2,3,4,5,6,7,8\n")
    assert read_raw(spark, d).columns[6:8] == ["Dup6", "Dup7"]


def test_header_only_file_is_empty(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "f.csv", "a,b\n")
    assert read_raw(spark, d).isEmpty()


def test_csv_roundtrip_keeps_spaces(spark, tmp_root):
    df = spark.createDataFrame([(" x ", "  ")], "a string, b string")
    write_csv(df, tmp_root + "/csv")
    assert read_raw(spark, tmp_root + "/csv").first()[:2] == (" x ", "  ")


def test_parquet_overwrite_replaces(spark, tmp_root):
    write_domain(spark.range(3), tmp_root, "t")
    write_domain(spark.range(5, 7), tmp_root, "t")
    assert sorted(r.id for r in read_domain(spark, tmp_root, "t").collect()) == [5, 6]


def test_facets_written_and_stamped(spark, tmp_root):
    df = spark.range(4).selectExpr("id AS facility_number", "id * 2 AS staffing_x", "id AS rating")
    paths = write_facets({"a": df.select("facility_number", "staffing_x"),
                          "b": df.select("facility_number", "rating")}, tmp_root, "2025-01-31")
    a = spark.read.parquet(paths["a"])
    assert a.columns == ["facility_number", "staffing_x", "row_id", "etl_date"]
    assert a.count() == 4 and spark.read.parquet(paths["b"]).count() == 4


def test_inventory_domains_and_hidden(spark, tmp_root):
    root = local(tmp_root) + "/raw"
    write_text(root + "/provider_info", "a.csv", "x\n1\n")
    write_text(root + "/provider_info", "_SUCCESS", "")
    write_text(root + "/penalties/sub", "b.csv", "x\n1\n")
    write_text(root, "top.csv", "x\n")
    inv = list_files(spark, root)
    got = {(r.domain, r.file_name, r.hidden) for r in inv.collect()}
    assert ("provider_info", "a.csv", False) in got
    # markers such as _SUCCESS never count as data (the listing skips them)
    assert all(name != "_SUCCESS" for _, name, _ in got)
    assert ("penalties", "b.csv", False) in got
    assert (None, "top.csv", False) in got
    assert list_files(spark, root + "/nope").count() == 0


def test_manifest_absent_is_empty_and_appends(spark, tmp_root):
    path = tmp_root + "/manifest"
    assert read_manifest(spark, path).count() == 0
    old = spark.createDataFrame([("1", "a.csv", "raw/other/a.csv", "2025-01-01T00:00:00Z")],
                                read_manifest(spark, path).schema)
    new = old.withColumn("file_id", F.lit("2"))
    old.write.mode("append").json(path)
    new.write.mode("append").json(path)
    assert sorted(r.file_id for r in read_manifest(spark, path).collect()) == ["1", "2"]
    assert append_manifest(old, new).count() == 2


def test_legacy_manifest_array(spark, tmp_root):
    d = local(tmp_root)
    os.makedirs(d, exist_ok=True)
    with open(d + "/processed_files.json", "w") as fh:
        fh.write('[\n {"file_id": "x1", "file_name": "a.csv", "s3_key": "raw/other/a.csv",'
                 ' "synced_at": "2025-01-01T00:00:00Z"}\n]')
    m = read_manifest(spark, d + "/processed_files.json", legacy_array=True)
    assert [r.file_id for r in m.collect()] == ["x1"]


def test_observed_row_count_on_empty_and_full_writes(spark, tmp_root):
    from sluice.plans.gates import publish_counted
    cases = {"zero_partitions": spark.range(0), "filtered": spark.range(10).where("id < 0"),
             "full": spark.range(0, 1000, numPartitions=7)}
    got = {n: publish_counted(df, lambda d, n=n: write_domain(d, tmp_root, n))[1]
           for n, df in cases.items()}
    assert got == {"zero_partitions": 0, "filtered": 0, "full": 1000}


def test_listing_tasks_follow_the_number_of_files(spark, tmp_root):
    from sluice.sources import files
    root = local(tmp_root)
    for i in range(3000):
        write_text(f"{root}/many/d{i % 7}", f"{i}.csv", "x")
    for i in range(24):
        write_text(f"{root}/large/d", f"{i}.csv", "x" * 6_000_000)
    many, large = (list_files(spark, f"{root}/{n}") for n in ("many", "large"))
    tasks = [df.select(F.spark_partition_id().alias("p")).distinct().count() for df in (many, large)]
    assert tasks[0] == -(-3000 // files.FILES_PER_TASK) and tasks[1] == 1
    assert many.select("path").distinct().count() == 3000 and large.count() == 24


def test_many_folders_are_listed_by_few_tasks(spark, tmp_root):
    from sluice.sources import files
    root = tmp_root[len("file:"):] if tmp_root.startswith("file:") else tmp_root
    for i in range(files.LISTING_TASKS + 100):
        write_text(f"{root}/d/{i}", "a.txt", str(i))
    sc, key = spark.sparkContext, "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    tracker = sc.statusTracker()

    def tasks_of_jobs(group):
        with spark_job_group(sc, group):
            inventory = list_files(spark, tmp_root)
        # the jobs of listing alone: the frame has not run yet
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        return max(tracker.getStageInfo(s).numTasks for s in stages), inventory.count()

    assert tasks_of_jobs("listing") == (files.LISTING_TASKS, files.LISTING_TASKS + 100)
    assert spark.conf.get(key) == before
    spark.conf.set(key, "40")
    try:                                     # a lower setting stands
        assert tasks_of_jobs("listing-40")[0] == 40 and spark.conf.get(key) == "40"
    finally:
        spark.conf.unset(key)


@contextmanager
def spark_job_group(sc, group):
    sc.setJobGroup(group, group)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_texts_are_files_and_replace_what_is_there(spark, tmp_root):
    from sluice.sources.files import write_texts
    rows = spark.createDataFrame([("a/x y%.txt", "ü\n"), ("a/b/c.txt", ""), ("d", "1")], "key string, text string")
    for n in range(2):
        assert write_texts(rows.withColumn("text", F.concat("text", F.lit(str(n)))), tmp_root + "/t/") == 3
        got = {r.rel_path: r.length for r in list_files(spark, tmp_root + "/t").collect()}
        assert got == {"a/x y%.txt": 4, "a/b/c.txt": 1, "d": 2}
    assert write_texts(rows.limit(0), tmp_root + "/none") == 0
    with pytest.raises(Exception):
        write_texts(rows.withColumn("text", F.lit(None).cast("string")), tmp_root + "/none")


def test_six_layouts_are_aligned_by_one_data_scan(spark, tmp_root):
    d = local(tmp_root) + "/raw/d o m"
    write_text(d, "1 a.csv", "a,b b,c\n1,2,3\n")
    write_text(d, "2.csv", "c,a,b b\n6,4,5\n")
    write_text(d, "3.csv", '"b b",a\n8,7\n,\n')
    write_text(d, "4%20.csv", "a,b b,c,x\n9,10,11,X\n")
    write_text(d, "5.csv", "x,Dup,dup,\nY,d1,d2,blank\n")
    write_text(d, "6.csv", 'a,"q,uoted"\n12,"v,\\"w\\", z"\n')
    write_text(d, "7.csv", "")
    out = read_raw(spark, d)
    assert set(out.columns) == {"a", "b b", "c", "x", "Dup1", "dup2", "_c3", "q,uoted", CORRUPT_COLUMN} and out.columns[-1] == CORRUPT_COLUMN
    got = {tuple(r[c] for c in ("a", "b b", "c", "x", "Dup1", "dup2", "_c3", "q,uoted", CORRUPT_COLUMN)) for r in out.collect()}
    n = None
    assert got == {("1", "2", "3", n, n, n, n, n, n), ("4", "5", "6", n, n, n, n, n, n), ("7", "8", n, n, n, n, n, n, n),
                   (n, n, n, n, n, n, n, n, n), ("9", "10", "11", "X", n, n, n, n, n), (n, n, n, "Y", "d1", "d2", "blank", n, n),
                   ("12", n, n, n, n, n, n, 'v,"w", z', n)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("FileScan csv") == 1


def test_bad_lines_of_narrow_files_are_told_from_good_ones(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "wide.csv", "a,b,c,d\n1,2,3,4\n5,6\n1,2,3,4,5\n")
    write_text(d, "narrow.csv", 'b,a\n2,1\n4\n6,5,7\n"x,y",\n,\n8" in,9\n')
    rows = [tuple(r) for r in read_raw(spark, d).select("a", "b", "d", CORRUPT_COLUMN).collect()]
    assert sorted(rows, key=str) == sorted([
        ("1", "2", "4", None), ("5", "6", None, "5,6"), ("1", "2", "4", "1,2,3,4,5"), ("1", "2", None, None), (None, "4", None, "4"),
        ("5", "6", None, "6,5,7"), (None, "x,y", None, None), (None, None, None, None), ("9", '8" in', None, None)], key=str)


def test_headers_with_line_breaks_in_quotes(spark, tmp_root):
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "1.csv", '"Zip\nCode",b\n1,"x\ny"\n')
    write_text(d, "2.csv", 'b,"Zip\nCode",c\nz,2,w\n')
    out = read_raw(spark, d, options={"multiLine": "true"})
    assert {(r["Zip\nCode"], r.b, r.c, r[CORRUPT_COLUMN]) for r in out.collect()} == {("1", "x\ny", None, None), ("2", "z", "w", None)}


def test_names_that_meet_within_a_layout(spark, tmp_root):
    import pytest

    from sluice.functions.names import NameCollisionError, plan_normalized_names
    d = local(tmp_root) + "/raw/dom"
    write_text(d, "1.csv", "Zip Code,zip-code\n1,2\n")
    write_text(d, "2.csv", "x,ZIP.CODE\n4,3\n")
    with pytest.raises(NameCollisionError):
        read_raw(spark, d, name_rule=plan_normalized_names)
    out = read_raw(spark, d, name_rule=lambda names: plan_normalized_names(names, "suffix"))
    assert {(r.zip_code, r.zip_code_2, r.x) for r in out.collect()} == {("1", "2", None), ("3", None, "4")}
