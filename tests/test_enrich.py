import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.operators.enrich import ColumnOverlapError, fanout_report, left_enrich


def rows(df):
    return sorted(df.collect(), key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("strategy", ["split", "join"])
def test_fixture_left_join_nulls(spark, strategy):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), ("a", 11), (None, 12)], "k string, y int")
    out = left_enrich(left, right, "k", strategy=strategy)
    assert out.columns == ["k", "x", "y"]
    got = {tuple(r) for r in out.collect()}
    assert got == {("a", 1, 10), ("a", 1, 11), ("b", 3, None), (None, 2, None)}
    assert out.count() == 4


def test_drop_list_applied_to_detail(spark):
    left = spark.createDataFrame([("a", 1)], "k string, x int")
    right = spark.createDataFrame([("a", "n", "z", 5)], "k string, facility_name string, zip_code string, y int")
    out = left_enrich(left, right, "k", drop=["facility_name", "zip_code"])
    assert out.columns == ["k", "x", "y"]


def test_d16_overlap_error_or_suffix(spark):
    left = spark.createDataFrame([("a", 1)], "k string, x int")
    right = spark.createDataFrame([("a", 2)], "k string, X int")
    with pytest.raises(ColumnOverlapError):
        left_enrich(left, right, "k")
    out = left_enrich(left, right, "k", on_overlap="suffix")
    assert out.columns == ["k", "x", "X_detail"] and out.first() == ("a", 1, 2)


def test_fanout_report_d15(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 4)], "k string, y int")
    r = fanout_report(left, right, "k").first()
    assert (r.left_rows, r.output_rows, r.max_matches, r.repeated_left_rows) == (3, 5, 3, 1)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", None]), max_size=8),
       st.lists(st.sampled_from(["a", "b", "d", None]), max_size=12))
def test_split_equals_join_property(spark, lkeys, rkeys):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(lkeys)], "k string, x int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(rkeys)], "k string, y int")
    split = sorted(map(tuple, left_enrich(left, right, "k").collect()), key=str)
    join = sorted(map(tuple, left_enrich(left, right, "k", strategy="join").collect()), key=str)
    assert split == join
    # every left row kept; rows = sum(max(1, matches))
    matches = {k: sum(1 for r in rkeys if r == k and k is not None) for k in set(lkeys)}
    assert len(split) == sum(max(1, matches[k]) for k in lkeys)


def test_hot_key_detail(spark):
    """One key holds a third of the detail rows; results stay whole."""
    left = spark.range(0, 300).selectExpr("id AS k", "id * 2 AS x")
    right = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 5 ELSE id % 200 END AS k", "id AS y")
    out = left_enrich(left, right, "k")
    expect = left_enrich(left, right, "k", strategy="join")
    assert out.count() == expect.count()
    assert out.where("k = 5").count() == right.where("k = 5").count()


def test_salted_equals_join_with_hot_key(spark):
    left = spark.range(0, 300).selectExpr("id AS k", "id * 2 AS x").union(
        spark.createDataFrame([(None, -1)], "k long, x long"))
    right = spark.range(0, 9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 200 END AS k", "id AS y")
    salted = left_enrich(left, right, "k", strategy="salted", rows_per_split=500)
    joined = left_enrich(left, right, "k", strategy="join")
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str)
    # the hot key's rows were spread over several salts: the left row is repeated in the plan
    assert "Generate explode" in salted._jdf.queryExecution().executedPlan().toString()
