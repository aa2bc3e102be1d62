import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.columns import (cast_audit, cast_schema, drop_if_exists, select_fixed,
                                      select_keywords, trim_strings)
from sluice.operators.stamps import add_etl_date, add_row_id

INT_CASES = [("12", 12), ("12.7", 12), ("-3.9", -3), ("+5", 5), ("5.", 5), ("abc", None),
             ("", None), ("1,234.5", None), ("$5", None), ("1e2", None), ("12d", None),
             ("3000000000", None), (".5", None), ("+.5", None), (".", None), (" 42 ", 42),
             (None, None)]


def test_trim_spaces_only(spark):
    df = spark.createDataFrame([(" ACME  ",), (None,), ("  ",), (" a\t ",)], "v string")
    assert [r.v for r in trim_strings(df).collect()] == ["ACME", None, "", "a\t"]


def test_trim_leaves_non_strings(spark):
    df = spark.createDataFrame([(" x ", 1)], "s string, n int")
    out = trim_strings(df)
    assert out.schema["n"].dataType == T.IntegerType() and out.first().s == "x"


@pytest.mark.parametrize("text,expected", INT_CASES)
def test_int_cast_legacy_rule_d1(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert cast_schema(df, {"v": T.IntegerType()}).first().v == expected


def test_long_cast_exact_above_2_53(spark):
    df = spark.createDataFrame([("9007199254740993",)], "v string")
    assert cast_schema(df, {"v": T.LongType()}).first().v == 9007199254740993


@pytest.mark.parametrize("text,expected", [("abc", None), ("", None), ("1,234.5", None),
                                           ("$5", None), ("12.5", 12.5), ("-3", -3.0)])
def test_double_cast(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert cast_schema(df, {"v": T.DoubleType()}).first().v == expected


@pytest.mark.parametrize("text,expected", [("2024-01-15", dt.date(2024, 1, 15)),
                                           (" 2024-01-15 ", dt.date(2024, 1, 15)),
                                           ("01/15/2024", None), ("1", None)])
def test_date_cast(spark, text, expected):
    df = spark.createDataFrame([(text,)], "v string")
    assert cast_schema(df, {"v": T.DateType()}).first().v == expected


def test_cast_schema_only_present_columns_and_audit_d2(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01"), ("y", "z", "soon")], "a string, b string, d string")
    out = cast_schema(df, {"a": T.IntegerType(), "d": T.DateType(), "missing": T.LongType()})
    assert out.columns == ["a", "b", "d"]
    audit = cast_audit(df, {"a": T.IntegerType(), "d": T.DateType()}).first()
    assert audit.a == 1 and audit.d == 1


def test_select_fixed_missing_raises(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(KeyError):
        select_fixed(df, ["a", "b"])


def test_select_keywords_keeps_source_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "b_price int, a int, c_price int")
    assert select_keywords(df, ["price"]).columns == ["b_price", "c_price"]


def test_drop_if_exists_ignores_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert drop_if_exists(df, ["b", "zz"]).columns == ["a"]


def test_monotonic_ids_follow_partitions_d14(spark):
    df = spark.range(6).repartition(3).sortWithinPartitions("id")
    ids = sorted(r.row_id for r in add_row_id(df.coalesce(3)).collect())
    assert len(set(ids)) == 6 and ids[0] == 0
    assert all(i >> 33 <= 2 for i in ids)


def test_dense_ids_exact_under_repartition(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5003 AS k", "id").repartition(13)
    out = add_row_id(df, mode="dense", order_by=["k"]).collect()
    by_k = sorted(out, key=lambda r: r.k)
    assert [r.row_id for r in by_k] == list(range(5000))


def test_dense_ids_with_hot_key_ties(spark):
    # a third of the rows share one key: ids stay 0..n-1 and respect the key order
    df = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id")
    out = add_row_id(df, mode="dense", order_by=["k"]).collect()
    assert sorted(r.row_id for r in out) == list(range(3000))
    ordered = sorted(out, key=lambda r: r.row_id)
    assert [r.k for r in ordered] == sorted(r.k for r in out)


def test_etl_date_fixed(spark):
    df = add_etl_date(spark.range(2), "2025-01-31")
    assert {r.etl_date for r in df.collect()} == {dt.date(2025, 1, 31)}
    assert df.schema["etl_date"].dataType == T.DateType()


FLOAT_TEXTS = ["1e2", "12d", "12.5f", "NaN", "-Infinity", "inf", "+INF", " 7 ", "\t8\n", "0x1p3",
               "0X1.8P1", ".5", "5.", "+.5e-3", "1e", "e5", "Brand#17", "1x", "1,5", "", "--1",
               "0x1", "1.2.3", "nan1", "١"]


def test_guarded_double_cast_equals_try_cast(spark):
    df = spark.createDataFrame([(t,) for t in FLOAT_TEXTS], "v string")
    guarded = [r.v for r in cast_schema(df, {"v": T.DoubleType()}).collect()]
    plain = [r.v for r in df.select(df.v.try_cast("double").alias("v")).collect()]
    assert [str(x) for x in guarded] == [str(x) for x in plain]
    assert guarded[0] == 100.0 and guarded[9] == 8.0 and guarded[16] is None


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.eEdDfFxXpP+-aAnNiItTyY \t#", max_size=8),
                min_size=1, max_size=30))
def test_guarded_double_cast_property(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    guarded = [r.v for r in cast_schema(df, {"v": T.DoubleType()}).collect()]
    plain = [r.v for r in df.select(df.v.try_cast("double").alias("v")).collect()]
    assert [str(x) for x in guarded] == [str(x) for x in plain]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.+- \t\x01\x0be", max_size=7), min_size=1, max_size=30))
def test_int_fast_path_equals_pattern_path(spark, texts):
    from pyspark.sql import functions as F
    from sluice.functions.casts import INT_TEXT_PATTERN
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    fast = [r.v for r in cast_schema(df, {"v": T.IntegerType()}).collect()]
    slow = [r.v for r in df.select(F.regexp_extract("v", INT_TEXT_PATTERN, 1)
                                   .try_cast("int").alias("v")).collect()]
    assert fast == slow


@pytest.mark.parametrize("by_search", [False, True])
def test_dense_ids_follow_nulls_types_and_hot_keys(spark, monkeypatch, by_search):
    import random

    from sluice.operators import stamps
    if by_search:
        monkeypatch.setattr(stamps, "_CELLS", 2)          # every cell is hot
    rng = random.Random(4)
    days = [None, *(dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(5))]
    rows = [(rng.choice([None, "a", "a", "a", "b", "\u00fc", ""]), rng.choice([None, 0.5, -1.0, float("inf"), float("nan"), 1e300]), rng.choice(days), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "s string, `x.y` double, d date, i int").repartition(5)
    for keys in (["s", "x.y", "d", "i"], ["x.y", "i"], ["d", "i"], ["i"]):
        out = add_row_id(df, mode="dense", order_by=keys)
        got = [tuple(r) for r in out.orderBy("row_id").collect()]
        want = [tuple(r) for r in df.orderBy(*[f"`{k}`" for k in keys]).collect()]
        assert [r[3] for r in got] == [r[3] for r in want] and [r[-1] for r in got] == list(range(2000))
    assert add_row_id(df.where("i < 0"), mode="dense", order_by=["i"]).count() == 0
    same = df.select(F.lit(1).alias("k"), F.lit("x").alias("v"))            # equal in every column
    assert sorted(r.row_id for r in add_row_id(same, mode="dense", order_by=["k"]).collect()) == list(range(2000))
    down = add_row_id(df, mode="dense", order_by=[F.desc("i")])
    assert [r.i for r in down.orderBy("row_id").collect()] == list(range(1999, -1, -1))


def test_dense_ids_are_lazy_and_write_nothing(spark):
    df = spark.range(0, 5000).selectExpr("id * 7 % 5000 AS k", "id AS v")
    out = add_row_id(df, mode="dense", order_by=["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "SinglePartition" not in plan.split("BroadcastExchange")[0]
    assert out.where("row_id <> k").isEmpty()
