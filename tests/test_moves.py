"""Moves: committed before anything is removed, repeatable."""

import os

import pytest

from conftest import write_text
from sluice.operators.inventory import move_plan
from sluice.plans import moves
from sluice.sources.files import list_files, open_store


def local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def tree(path):
    out = {}
    for folder, _, files in os.walk(local(path)):
        for f in files:
            if not f.startswith((".", "_")) and "_moves" not in folder:
                with open(os.path.join(folder, f), "rb") as fh:
                    out[os.path.relpath(os.path.join(folder, f), local(path))] = fh.read().decode(errors="replace")
    return out


def build(root):
    raw = local(root) + "/raw"
    write_text(raw + "/good", "a b%20.csv", "x\n1\n")
    write_text(raw + "/good/sub", "ü.csv", "x\n2\n")
    write_text(raw + "/failed", "c.csv", "x\n3\n")
    write_text(raw + "/other", "d.csv", "y" * 100_000_000)   # more than a block
    write_text(raw, "top.csv", "stays\n")
    return root + "/raw", root + "/processed", root + "/error"


def plan_of(spark, raw, processed, error):
    return move_plan(list_files(spark, raw).where("NOT hidden"), ["good", "failed"], raw, processed, error, failed=["failed"])


def test_files_are_found_under_their_targets_and_a_second_run_moves_nothing(spark, tmp_root):
    raw, processed, error = roots = build(tmp_root)
    log = moves.apply_moves(spark, plan_of(spark, *roots), processed + "/_moves")
    assert {(r.key, r.status, r.outcome, r.bytes) for r in log.collect()} == {
        ("good/a b%20.csv", "processed", "landed", 4), ("good/sub/ü.csv", "processed", "landed", 4),
        ("failed/c.csv", "error", "landed", 4), ("other/d.csv", "error", "landed", 100_000_000)}
    assert tree(processed) == {"good/a b%20.csv": "x\n1\n", "good/sub/ü.csv": "x\n2\n"}
    assert tree(error) == {"failed/c.csv": "x\n3\n", "other/d.csv": "y" * 100_000_000}
    assert tree(raw) == {"top.csv": "stays\n"}
    assert moves.apply_moves(spark, plan_of(spark, *roots), processed + "/_moves").count() == 0
    # the same file again, changed, replaces what is there
    write_text(local(raw) + "/good", "a b%20.csv", "x\n9\n9\n")
    assert moves.apply_moves(spark, plan_of(spark, *roots), processed + "/_moves").count() == 1
    assert tree(processed)["good/a b%20.csv"] == "x\n9\n9\n" and tree(raw) == {"top.csv": "stays\n"}


def test_nothing_is_removed_before_the_commit(spark, tmp_root):
    raw, processed, error = roots = build(tmp_root)
    write_text(local(processed), "good", "a file where a folder must go")
    before = tree(raw)
    with pytest.raises(Exception):
        moves.apply_moves(spark, plan_of(spark, *roots), tmp_root + "/log")
    assert tree(raw) == before
    assert not any(".moving-" in f for _, _, files in os.walk(local(tmp_root)) for f in files)
    os.remove(local(processed) + "/good")
    assert moves.apply_moves(spark, plan_of(spark, *roots), tmp_root + "/log").count() == 4
    assert tree(raw) == {"top.csv": "stays\n"} and len(tree(processed)) == len(tree(error)) == 2


def test_a_source_that_changed_after_it_landed_stays(spark, tmp_root):
    raw, processed, error = roots = build(tmp_root)
    plan = plan_of(spark, *roots).cache()
    plan.count()
    rows = {r.key: r for r in plan.collect()}
    got = moves._copy(rows["failed/c.csv"].source, rows["failed/c.csv"].target)
    write_text(local(raw) + "/failed", "c.csv", "new load\n")
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"source": rows["failed/c.csv"].source, "bytes": got[1], "modified": got[2]}])
    assert [b.num_rows for b in moves._remove(iter([batch]))] == [0]
    assert tree(raw)["failed/c.csv"] == "new load\n"
    assert {r.outcome for r in moves.apply_moves(spark, plan, tmp_root + "/log").collect()} == {"landed"}
    # planned files that are gone by now
    assert {r.outcome for r in moves.apply_moves(spark, plan, tmp_root + "/log", "again").collect()} == {"gone"}
    plan.unpersist()


def test_stores_of_paths():
    assert [open_store(p)[1] for p in ("/a b/c%20", "file:/a b/c", "file:///a/b")] == ["/a b/c%20", "/a b/c", "/a/b"]


def test_copy_tasks_take_more_files_once_there_are_many():
    assert [moves.copy_tasks(n) for n in (0, 1, 64, 65, 6400, 64_000, 128_000, 1_000_000)] == [1, 1, 1, 2, 100, 256, 256, 2000]


def test_removing_takes_few_tasks(spark, tmp_root):
    raw, processed, error = tmp_root + "/raw", tmp_root + "/processed", tmp_root + "/error"
    for i in range(600):
        write_text(f"{local(raw)}/good/{i}", "a.csv", str(i))
    log = moves.apply_moves(spark, plan_of(spark, raw, processed, error), tmp_root + "/log", "r")
    assert log.count() == 600 and tree(raw) == {} and tree(processed) == {f"good/{i}/a.csv": str(i) for i in range(600)}
    removed = [f for f in os.listdir(local(tmp_root) + "/log/run-r/removed") if f.startswith("part-")]
    assert len(removed) <= 2 and spark.read.parquet(tmp_root + "/log/run-r/removed").count() == 600


def test_move_query_keeps_a_file_for_each_page(spark, tmp_root):
    from sluice.plans.catalog import q_move_apply
    pages = [(1, "https://h/en/1"), (1, "https://h/en/1"), (2, "https://h/de/ü\"\n"), (3, "https://h//x"), (4, "https://h/a b%/x"), (5, None), (6, "https://h/_e/x"), (None, "https://h/fr/6")]
    spark.createDataFrame(pages, "page_id long, url string").repartition(3).write.parquet(tmp_root + "/pages.parquet")
    out = q_move_apply(spark, tmp_root)
    target = lambda u: "processed" if u and u.split("/")[3] in ("en", "de", "fr") else "error"
    assert sorted(map(tuple, out.collect()), key=str) == sorted(((target(u), p, u, 0, 0) for p, u in pages), key=str)
    assert out.rdd.getNumPartitions() <= 2           # not one for every few files


def test_cli_moves_by_the_clean_status(spark, tmp_root):
    from sluice import cli
    raw = local(tmp_root) + "/raw"
    write_text(raw + "/good", "a.csv", "x\n1\n")
    write_text(raw + "/bad", "b.csv", "Zip Code,Zip-Code\n1,2\n")
    where = ["--processed", tmp_root + "/processed", "--error", tmp_root + "/error", "--tracked", "good,bad"]
    assert cli.main(["clean", "--source", raw, "--staging", tmp_root + "/staging", "--error", tmp_root + "/error",
                     "--status-out", tmp_root + "/status"]) == 1
    assert cli.main(["moves", "--source", raw, *where, "--status", tmp_root + "/status", "--apply"]) == 0
    assert tree(tmp_root + "/processed") == {"good/a.csv": "x\n1\n"}
    assert tree(raw) == {} and "bad/b.csv" in tree(tmp_root + "/error")


def test_run_applies_moves_after_cleaning(spark, tmp_root):
    from test_chain import build_raw
    from sluice.plans.chain import RunConfig, run
    from sluice.sources.parquet import read_domain
    build_raw(local(tmp_root) + "/raw")
    cfg = RunConfig(raw_root=tmp_root + "/raw", staging_root=tmp_root + "/staging", transform_root=tmp_root + "/transform",
                    error_root=tmp_root + "/error", processed_root=tmp_root + "/processed", as_of="2025-01-31", apply_moves=True)
    res = run(spark, cfg)
    assert {r.key for r in res.moves.where("status = 'processed'").collect()} == {
        "provider_info/p.csv", "survey_summary/s.csv", "penalties/x.csv", "qualitymsr_mds/q.csv"}
    assert tree(tmp_root + "/raw") == {} and len(tree(tmp_root + "/processed")) == 4
    again = run(spark, cfg)                       # nothing new: the tables stay, nothing moves
    assert again.moves.count() == 0 and read_domain(spark, tmp_root + "/transform", "facility").count() == 3
