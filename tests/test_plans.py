"""Plan shape: no Python in any plan, pruned scans, pushed filters."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF0001
from sluice.operators.columns import normalize_names, trim_strings
from sluice.operators.stamps import add_etl_date


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["left_enrich", "trim_strings", "cast_schema", "route_known",
                                 "classify_route", "ingest_plan", "move_plan", "fanout_report"])
def test_no_python_nodes(spark, key):
    text = plan_text(E.queries()[key](spark, SF0001))
    assert "Python" not in text and "ArrowEval" not in text and "BatchEval" not in text


def test_scan_is_pruned(spark):
    df = E.queries()["select_keywords"](spark, SF0001)
    text = plan_text(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in text


def test_filter_pushed_below_stamps(spark):
    base = spark.read.parquet(f"{SF0001}/customer.parquet")
    df = add_etl_date(trim_strings(normalize_names(base)), "2025-01-31").where("c_nationkey = 3")
    assert "PushedFilters: [IsNotNull(c_nationkey), EqualTo(c_nationkey,3)]" in plan_text(df)


def test_detail_scan_is_pruned_in_enrich(spark):
    text = plan_text(E.queries()["left_enrich"](spark, SF0001))
    scans = [line for line in text.splitlines() if "ReadSchema" in line and "o_orderkey" in line]
    assert scans and all("o_orderpriority" not in line and "o_orderstatus" not in line for line in scans)


def test_key_just_above_the_split_size_is_split(spark):
    """In a detail table of any size: no share of the rows is needed to be hot."""
    from sluice.operators.enrich import left_enrich
    left = spark.range(0, 5000).selectExpr("id AS k")
    right = spark.range(0, 50000).selectExpr("CASE WHEN id < 21 THEN 7 ELSE id % 5000 + 10000 END AS k", "id AS y")
    out = left_enrich(left, right, "k", strategy="salted", rows_per_split=20)
    assert out.where("k = 7").count() == 21 and out.count() == 5020
    from sluice.operators import enrich
    salted = enrich._salted(left, right.withColumn("part", F.spark_partition_id()), ["k"], 20)
    assert "Generate explode" in plan_text(salted) and salted.count() == 21


def test_hot_facet_keys_without_match_are_spread(spark):
    from sluice.operators.enrich import left_enrich
    left = spark.range(0, 900).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 5 ELSE id END AS k", "id AS x")
    right = spark.createDataFrame([(8, 1), (8, 2), (11, 3)], "k long, y int")
    got = sorted(map(tuple, left_enrich(left, right, "k", strategy="salted", rows_per_split=50).collect()), key=str)
    assert got == sorted(map(tuple, left_enrich(left, right, "k", strategy="join").collect()), key=str)


@pytest.mark.parametrize("strategy", ["split", "salted", "join"])
def test_keys_match_in_any_case(spark, strategy):
    from sluice.operators.enrich import left_enrich
    left = spark.createDataFrame([("a", 1), ("b", 2)], "Facility_Number string, x int")
    right = spark.createDataFrame([("a", 10)], "FACILITY_NUMBER string, y int")
    out = left_enrich(left, right, "facility_number", strategy=strategy)
    assert [c.lower() for c in out.columns] == ["facility_number", "x", "y"]
    assert sorted(map(tuple, out.collect())) == [("a", 1, 10), ("b", 2, None)]


SKEW_CONFS = {"spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
              "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_hot_detail_key_is_split_only_by_split_strategy(spark):
    """A third of the detail rows on one key: with sort-merge joins forced and
    skew thresholds scaled down, adaptive execution splits the hot partition
    of the split plan's inner join; the plain left outer join cannot."""
    from sluice.operators.enrich import left_enrich
    old = {k: spark.conf.get(k, None) for k in SKEW_CONFS}
    try:
        for k, v in SKEW_CONFS.items():
            spark.conf.set(k, v)
        left = spark.range(0, 400).selectExpr("id AS k", "id * 2 AS x")
        right = spark.range(0, 60000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 400 END AS k", "id AS y", "repeat('z', 20) AS pad")
        plans = {}
        for strategy in ("split", "join"):
            df = left_enrich(left, right, "k", strategy=strategy)
            assert len(df.collect()) == 60000
            plans[strategy] = plan_text(df)
        assert "SortMergeJoin(skew=true)" in plans["split"]
        assert "skew=true" not in plans["join"]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cleaning_is_one_codegen_stage_without_shuffle(spark, tmp_root):
    from sluice.plans import catalog
    from sluice.plans.clean import clean_frame
    from sluice.sources.csv import read_raw, write_csv
    write_csv(catalog._raw_customers(spark, SF0001), tmp_root)
    text = plan_text(clean_frame(read_raw(spark, tmp_root, "check"), as_of="2025-01-31"))
    lines = [line for line in text.splitlines() if line.strip()]
    assert "Exchange" not in text
    assert all(line.lstrip(" +-:").startswith(("*(1)", "FileScan")) for line in lines)
    # per-column trims are one projection, not one node per column
    assert sum("trim(" in line for line in lines) == 1


def test_facet_scans_are_pruned(spark, tmp_root):
    from sluice.plans import catalog
    from sluice.plans.transform import provider_facets
    from sluice.sources.parquet import read_domain, write_domain
    write_domain(catalog._provider_like(spark, SF0001), tmp_root, "provider_info")
    write_domain(catalog._penalty_detail(spark, SF0001), tmp_root, "penalties")
    prov = read_domain(spark, tmp_root, "provider_info")
    det = read_domain(spark, tmp_root, "penalties")
    staffing = plan_text(provider_facets(prov, det, det)["staffing"])
    scan = [line for line in staffing.splitlines() if "ReadSchema" in line][0]
    assert "staffing_rating" in scan and "total_turnover" in scan
    assert "facility_name" not in scan and "number_of_fines" not in scan
