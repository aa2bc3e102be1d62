import pytest
from pyspark.sql import functions as F

from sluice.functions.paths import route_expr
from sluice.operators.inventory import (MissingRequiredError, count_by_domain, missing_required,
                                        move_plan, pending_files, present_domains,
                                        require_present, route_known)
from sluice.plans.ingest import ingest_plan
from sluice.plans.presets import DEFAULT_ROUTE, ROUTE_REMOVE_TOKENS, ROUTES


def test_preset_routes_fixture_d19(spark):
    names = ["NH_ProviderInfo_Jan2025.csv", "NH_QualityMDS_x.csv", "NH_QualityMsr_MDS_Jan2025.csv",
             "NH_SurveySummary_Penalties.csv", "misc.csv"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.t for r in df.select(route_expr(F.col("name"), ROUTES, DEFAULT_ROUTE, ROUTE_REMOVE_TOKENS).alias("t")).collect()]
    # the reference map alone sends QualityMsr_MDS to raw/other/; our added pattern catches it
    assert got == ["raw/provider_info/", "raw/qualitymsr_mds/", "raw/qualitymsr_mds/",
                   "raw/penalties/", "raw/other/"]
    ref_only = [p for p in ROUTES if p[0] != "QualityMsrMDS"]
    got_ref = [r.t for r in df.select(route_expr(F.col("name"), ref_only, DEFAULT_ROUTE, ROUTE_REMOVE_TOKENS).alias("t")).collect()]
    assert got_ref[2] == "raw/other/"


def test_ingest_plan_second_run_is_empty(spark):
    listing = spark.createDataFrame(
        [("1", "NH_ProviderInfo_A", "application/vnd.google-apps.spreadsheet", "t1"),
         ("2", "NH_Penalties_B.csv", "text/csv", "t1"),
         ("3", "notes.pdf", "application/pdf", "t1")], "id string, name string, mimeType string, modifiedTime string")
    empty = spark.createDataFrame([], "file_id string, file_name string, s3_key string, synced_at string")
    first = ingest_plan(listing, empty, synced_at="2025-01-31 05:00:00")
    rows = {(r.file_id, r.s3_key) for r in first.collect()}
    assert rows == {("1", "raw/provider_info/NH_ProviderInfo_A.csv"), ("2", "raw/penalties/NH_Penalties_B.csv")}
    assert first.first().synced_at == "2025-01-31T05:00:00.000000Z"
    assert ingest_plan(listing, first).count() == 0


def test_changed_file_detection_d20(spark):
    listing = spark.createDataFrame([("1", "t2")], "id string, modifiedTime string")
    manifest = spark.createDataFrame([("1", "t1")], "file_id string, modifiedTime string")
    assert pending_files(listing, manifest, "id").count() == 0
    assert pending_files(listing, manifest, "id", modified_col="modifiedTime").count() == 1


def test_route_known_and_failed_d7(spark):
    inv = spark.createDataFrame([("a", "provider_info"), ("b", "other"), ("c", "penalties")], "f string, domain string")
    got = {r.f: r.target for r in route_known(inv, ["provider_info", "penalties"], failed=["penalties"]).collect()}
    assert got == {"a": "processed", "b": "error", "c": "error"}
    known = inv.sparkSession.createDataFrame([("provider_info",), ("penalties",)], "d string")
    got2 = {r.f: r.target for r in route_known(inv, known).collect()}
    assert got2 == {"a": "processed", "b": "error", "c": "processed"}


def test_required_gate_lists_all_and_raises_d8(spark):
    present = spark.createDataFrame([("provider_info",), ("penalties",)], "domain string")
    missing = {r.domain for r in missing_required(["provider_info", " survey_summary", "qualitymsr_mds"], present).collect()}
    assert missing == {"survey_summary", "qualitymsr_mds"}
    with pytest.raises(MissingRequiredError):
        require_present(["provider_info", "survey_summary"], present)
    require_present(["provider_info"], present)


def test_present_and_counts(spark):
    rec = spark.createDataFrame([("a",), ("a",), ("b",)], "domain string")
    assert {r.domain for r in present_domains(["a", "c"], rec).collect()} == {"a"}
    assert {(r.domain, r.n_files) for r in count_by_domain(rec).collect()} == {("a", 2), ("b", 1)}


def test_move_plan_dry_run(spark):
    inv = spark.createDataFrame([("provider_info/a.csv", "provider_info"), ("zzz/b.csv", "zzz")],
                                "rel_path string, domain string")
    plan = {r.key: (r.source, r.target) for r in move_plan(inv, ["provider_info"], "s3://src/raw/", "s3://ok/raw", "s3://bad/raw").collect()}
    assert plan == {"provider_info/a.csv": ("s3://src/raw/provider_info/a.csv", "s3://ok/raw/provider_info/a.csv"),
                    "zzz/b.csv": ("s3://src/raw/zzz/b.csv", "s3://bad/raw/zzz/b.csv")}


def test_filter_mime_folder(spark):
    from sluice.operators.inventory import filter_mime
    listing = spark.createDataFrame(
        [("1", "text/csv", ["F1"]), ("2", "text/csv", ["F2"]), ("3", "application/pdf", ["F1"]),
         ("4", "application/vnd.google-apps.spreadsheet", ["F0", "F1"])],
        "id string, mimeType string, parents array<string>")
    mimes = ["text/csv", "application/vnd.google-apps.spreadsheet"]
    assert sorted(r.id for r in filter_mime(listing, mimes, folder="F1").collect()) == ["1", "4"]
    assert sorted(r.id for r in filter_mime(listing, mimes).collect()) == ["1", "2", "4"]


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["provider_info", "penalties", "other", "zz"]), max_size=12),
       st.lists(st.sampled_from(["provider_info", "penalties", "other"]), max_size=3))
def test_move_plan_partitions_files(spark, domains, tracked):
    inv = spark.createDataFrame([(f"{d}/f{i}.csv", d) for i, d in enumerate(domains)],
                                "rel_path string, domain string")
    plan = move_plan(inv, tracked, "s3://src/raw", "s3://ok/raw", "s3://bad/raw").collect()
    assert len(plan) == len(domains)                         # processed + error = total
    assert all((r.status == "processed") == (r.domain in tracked) for r in plan)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=15), st.lists(st.integers(0, 20), max_size=15))
def test_pending_plus_known_is_listing(spark, listed, known):
    listing = spark.createDataFrame([(str(i),) for i in listed], "id string")
    manifest = spark.createDataFrame([(str(i),) for i in known], "file_id string")
    pending = [r.id for r in pending_files(listing, manifest, "id").collect()]
    seen = [r.id for r in listing.join(manifest, listing.id == manifest.file_id, "left_semi").collect()]
    assert sorted(pending + seen) == sorted(str(i) for i in listed)
