"""Publishing: whatever step raises, readers keep the last good tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.session import file_system
from sluice.sources import versions
from sluice.sources.parquet import read_domain, write_domain, write_facets

FACETS = ("facility", "staffing", "rating", "surveys", "penalties")


def ids(spark, root, name="t"):
    return sorted(r.id for r in read_domain(spark, root, name).collect())


def folders(spark, root, name):
    fs, where = file_system(spark, f"{root}/{name}")
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def boom(*_):
    raise OSError("store")


@pytest.mark.parametrize("step", ["_put", "state", "file_system", "new_version"])
def test_any_step_may_raise(spark, tmp_root, monkeypatch, step):
    write_domain(spark.range(3), tmp_root, "t")
    real = getattr(versions, step)
    for at in range(12):               # the step's first, second ... use raises
        uses = iter(range(1000))
        with monkeypatch.context() as m:
            m.setattr(versions, step, lambda *a, **k: boom() if next(uses) == at else real(*a, **k))
            try:
                write_domain(spark.range(10 + at, 12 + at), tmp_root, "t")
                done = True
            except OSError:
                done = False
        now = ids(spark, tmp_root)
        assert now == [10 + at, 11 + at] if done else now in ([0, 1, 2], [10 + at, 11 + at], [9 + at, 10 + at])
        write_domain(spark.range(3), tmp_root, "t")
        assert ids(spark, tmp_root) == [0, 1, 2]
        if done:
            return
    raise AssertionError("never went through")


def test_first_load_that_fails_leaves_no_table(spark, tmp_root):
    with pytest.raises(Exception):
        write_domain(spark.range(3).select(F.raise_error(F.lit("late"))), tmp_root, "t")
    assert folders(spark, tmp_root, "t") == [] and versions.state(spark, tmp_root) == (0, {})


def test_half_a_commit_file_is_no_commit(spark, tmp_root):
    write_domain(spark.range(3), tmp_root, "t")
    versions._put(spark, f"{tmp_root}/_commits/{2:020d}.json", '{"tables": {"t": ["v-no')
    assert ids(spark, tmp_root) == [0, 1, 2]
    write_domain(spark.range(4), tmp_root, "t")
    assert ids(spark, tmp_root) == [0, 1, 2, 3] and versions.state(spark, tmp_root)[0] == 3


def test_a_taken_number_is_tried_again(spark, tmp_root, monkeypatch):
    write_domain(spark.range(3), tmp_root, "t")
    real, first = versions._put, iter([True])

    def late(session, path, text):
        if next(first, False):      # another run commits its own table just before
            real(session, path, '{"tables": {"other": ["v-1"], "t": ["%s"]}}' % versions.state(spark, tmp_root)[1]["t"][0])
        return real(session, path, text)

    monkeypatch.setattr(versions, "_put", late)
    write_domain(spark.range(5), tmp_root, "t")
    number, tables = versions.state(spark, tmp_root)
    assert number == 3 and tables["other"] == ["v-1"] and ids(spark, tmp_root) == [0, 1, 2, 3, 4]


def test_third_facet_failing_leaves_all_five(spark, tmp_root):
    def facets(load, bad=None):
        return {n: spark.range(load, load + 2).select(F.raise_error(F.lit("late")).alias("id") if n == bad else F.col("id")) for n in FACETS}

    write_facets(facets(0), tmp_root, "2025-01-31", stamp_rows=False)
    before = {n: versions.resolve(spark, tmp_root, n) for n in FACETS}
    with pytest.raises(Exception, match="late"):
        write_facets(facets(7, "rating"), tmp_root, "2025-01-31", stamp_rows=False)
    assert {n: versions.resolve(spark, tmp_root, n) for n in FACETS} == before
    assert all(ids(spark, tmp_root, n) == [0, 1] for n in FACETS)
    assert all(len(folders(spark, tmp_root, n)) == 1 for n in FACETS)     # what was written is gone
    write_facets(facets(7), tmp_root, "2025-01-31", stamp_rows=False)
    assert all(ids(spark, tmp_root, n) == [7, 8] for n in FACETS)


def test_a_frame_read_before_a_publish_stays_readable(spark, tmp_root):
    write_domain(spark.range(3), tmp_root, "t")
    old = read_domain(spark, tmp_root, "t")
    write_domain(spark.range(5), tmp_root, "t")
    assert old.count() == 3 and ids(spark, tmp_root) == [0, 1, 2, 3, 4]
    write_domain(spark.range(6), tmp_root, "t")
    assert len(folders(spark, tmp_root, "t")) == versions.KEPT


def test_concurrent_publishes_keep_each_other(spark, tmp_root):
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda i: write_domain(spark.range(i), tmp_root, f"t{i}"), range(1, 13)))
    assert [read_domain(spark, tmp_root, f"t{i}").count() for i in range(1, 13)] == list(range(1, 13))


def test_recover_removes_what_no_commit_lists(spark, tmp_root):
    write_domain(spark.range(3), tmp_root, "t")
    write_domain(spark.range(3), tmp_root, "_bad_lines/t")
    spark.range(9).write.parquet(f"{tmp_root}/t/v-dead")
    spark.range(9).write.parquet(f"{tmp_root}/_bad_lines/t/v-dead")
    assert versions.recover(spark, tmp_root) == []                       # it may be a run that is still writing
    gone = versions.recover(spark, tmp_root, dt.timedelta(seconds=-5))
    assert sorted(p[len(tmp_root):] for p in gone) == ["/_bad_lines/t/v-dead", "/t/v-dead"]
    assert ids(spark, tmp_root) == ids(spark, tmp_root, "_bad_lines/t") == [0, 1, 2]


def test_plain_folders_are_read_and_replaced(spark, tmp_root):
    spark.range(3).write.parquet(f"{tmp_root}/t")
    assert ids(spark, tmp_root) == [0, 1, 2]
    write_domain(spark.range(5), tmp_root, "t")
    assert ids(spark, tmp_root) == [0, 1, 2, 3, 4]
    write_domain(spark.range(5, 6), tmp_root, "t", mode="append")
    assert ids(spark, tmp_root) == [0, 1, 2, 3, 4, 5]
