"""End to end over raw CSV fixtures shaped like the reference's domains."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import write_text
from sluice.plans import gates
from sluice.plans.chain import RunConfig, run
from sluice.plans.clean import clean_all, clean_domain, clean_frame
from sluice.plans.transform import quality_transform, run_transform
from sluice.sources.parquet import read_domain, write_domain

PROVIDER = ("CMS Certification Number (CCN),Provider Name,Provider Address,City/Town,State,ZIP Code,"
            "Telephone Number,Provider SSA County Code,County/Parish,Ownership Type,"
            "Number of Certified Beds,Average Number of Residents per Day,"
            "Average Number of Residents per Day Footnote,Provider Type,Provider Resides in Hospital,"
            "Legal Business Name,Date First Approved to Provide Medicare and Medicaid Services,"
            "Affiliated Entity Name,Affiliated Entity ID,Continuing Care Retirement Community,"
            "Special Focus Status,Abuse Icon,Overall Rating,Staffing Rating,Staffing Rating Footnote,"
            "Reported Hours per Resident,Total Turnover,Case-Mix Index,Adjusted Total,"
            "Rating Cycle 1 Score,Health Deficiency Score,Revisit Score 1,"
            "Total Weighted Health Survey Score,Generating Capacity,Staff Count,"
            "Number of Facility Reported Incidents,Number of Substantiated Complaints,"
            "Number of Citations from Infection Control Inspections,Number of Fines,"
            "Total Amount of Fines in Dollars,Number of Payment Denials,Total Number of Penalties\n")


def provider_row(i):
    vals = [f"{i:06d}", f" Home {i} ", "1 Main St", "Town", "CA", "90001", "555", "12", "County",
            "For profit", f"{100 + i}", "88.5", "fn", "Medicare", "N", "Legal", "2001-02-03",
            "Ent", "E1", "N", "SFF text", "N", "4", "3", "f1", "3.5", "40", "1.1", "2.2",
            "1", "2", "3", "4", "x", "9", "0", "1", "2", "3", "1000", "0", "4"]
    return ",".join(vals) + "\n"


def build_raw(root):
    write_text(root + "/provider_info", "p.csv", PROVIDER + "".join(provider_row(i) for i in range(3)))
    write_text(root + "/survey_summary", "s.csv",
               "CMS Certification Number (CCN),Provider Name,Survey Date,Deficiency Tag Number\n"
               "000000,Home 0,2024-01-01,F1\n000000,Home 0,2024-02-01,F2\n000001,Home 1,2024-03-01,F3\n")
    write_text(root + "/penalties", "x.csv",
               "CMS Certification Number (CCN),City/Town,Penalty Date,Fine Amount\n"
               "000002,T,2024-05-05,100\n")
    write_text(root + "/qualitymsr_mds", "q.csv",
               "CMS Certification Number (CCN),Provider Name,Measure Code,Measure Description,Resident Type,"
               "Q1 Measure Score,Footnote for Q1 Measure Score,Q2 Measure Score,Footnote for Q2 Measure Score,"
               "Q3 Measure Score,Footnote for Q3 Measure Score,Q4 Measure Score,Footnote for Q4 Measure Score,"
               "Four Quarter Average Score,Footnote for Four Quarter Average Score,"
               "Used in Quality Measure Five Star Rating,Measure Period,Location,Processing Date\n"
               "000000,H,401,Desc,Long,1.5,,2.5,,bad,,4,,2.1,9,Y,2024Q1,Loc,2025-01-01\n")
    write_text(root + "/unknown", "u.csv", "Zip Code,Zip-Code\n1,2\n")   # D3 collision
    write_text(root + "/emptydom", "e.csv", "a,b\n")


@pytest.fixture
def roots(tmp_root):
    base = tmp_root
    build_raw(base + "/raw")
    return base


def test_clean_all_statuses_and_quarantine(spark, roots):
    status = {r.domain: r for r in clean_all(spark, roots + "/raw", roots + "/staging",
                                              roots + "/error", as_of="2025-01-31").collect()}
    assert status["provider_info"].status == gates.OK and status["provider_info"].rows == 3
    assert status["emptydom"].status == gates.SKIPPED
    assert status["unknown"].status == gates.QUARANTINED
    assert status["unknown"].reason == "NameCollisionError"
    # D4: the error root holds this domain's own raw rows
    err = read_domain(spark, roots + "/error", "unknown")
    assert err.columns == ["Zip Code", "Zip-Code", "_corrupt_record"] and err.count() == 1
    staged = read_domain(spark, roots + "/staging", "provider_info")
    assert "facility_number" in staged.columns and "facility_name" in staged.columns
    assert staged.where(F.col("facility_name") == "Home 1").count() == 1   # trimmed


def test_strict_raises_after_all(spark, roots):
    with pytest.raises(gates.DomainFailedError):
        clean_all(spark, roots + "/raw", roots + "/staging", roots + "/error", strict=True)
    # the good domains were still written
    assert read_domain(spark, roots + "/staging", "penalties").count() == 1


def test_full_run(spark, roots):
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                    transform_root=roots + "/transform", error_root=roots + "/error",
                    processed_root=roots + "/processed", as_of="2025-01-31")
    res = run(spark, cfg)
    moves = {r.domain: r.status for r in res.moves.collect()}
    assert moves["provider_info"] == "processed" and moves["unknown"] == "error"
    t = roots + "/transform"
    facility = read_domain(spark, t, "facility")
    assert len(facility.columns) == 24
    assert facility.schema["number_of_certified_beds"].dataType.typeName() == "integer"
    assert facility.schema["special_focus_status"].dataType.typeName() == "string"   # D2
    assert facility.first()["special_focus_status"] == "SFF text"
    surveys = read_domain(spark, t, "surveys")
    assert surveys.count() == 4          # 2 + 1 + 1 null-extended
    assert "provider_name" not in surveys.columns and "facility_name" not in surveys.columns
    penalties = read_domain(spark, t, "penalties")
    assert penalties.count() == 3 and penalties.where("fine_amount = '100'").count() == 1
    rating = read_domain(spark, t, "rating")
    assert "generating_capacity" in rating.columns and "staff_count" not in rating.columns
    q = read_domain(spark, t, "qualitymsr_mds")
    assert q.columns[:2] == ["facility_number", "measure_code"] and q.count() == 1
    assert res.transforms["quality"].status == gates.OK


def test_quality_typed_variant_and_bad_domain(spark, roots):
    clean_all(spark, roots + "/raw", roots + "/staging", roots + "/error")
    st = quality_transform(spark, roots + "/staging", roots + "/t2", roots + "/error", typed=True)
    assert st.status == gates.OK
    q = read_domain(spark, roots + "/t2", "qualitymsr_mds").first()
    assert q.q3_measure_score is None and q.q1_measure_score == 1.5
    assert q.footnote_for_four_quarter_average_score == "9"
    with pytest.raises(ValueError):
        run_transform(spark, "nope", roots + "/staging", roots + "/t2")


def test_clean_frame_single_projection(spark):
    df = spark.createDataFrame([(" a ", " b ")], ["Col A", "Provider Name"])
    out = clean_frame(df, as_of="2025-01-31")
    assert out.columns == ["col_a", "facility_name", "row_id", "etl_date"]
    assert out.first()[:2] == ("a", "b")


def test_clean_domain_auto_realigns_drift(spark, tmp_root):
    from sluice.plans.clean import clean_domain
    raw = tmp_root + "/raw"
    write_text(raw + "/dom", "f1.csv", "A,B\n1,2\n")
    write_text(raw + "/dom", "f2.csv", "B,A\n4,3\n")
    st = clean_domain(spark, raw, tmp_root + "/stg", "dom", as_of="2025-01-31")
    assert st.status == gates.OK and st.rows == 2
    got = {(r.a, r.b) for r in read_domain(spark, tmp_root + "/stg", "dom").collect()}
    assert got == {("1", "2"), ("3", "4")}
    # same layout everywhere: the single checked pass is enough
    write_text(raw + "/same", "f1.csv", "A,B\n1,2\n")
    write_text(raw + "/same", "f2.csv", "A,B\n3,4\n")
    assert clean_domain(spark, raw, tmp_root + "/stg", "same").rows == 2


def test_freshness_gate_d9(spark, tmp_root):
    from sluice.sources.parquet import stamp, write_domain
    write_domain(stamp(spark.range(3), "2025-01-30"), tmp_root, "old")
    write_domain(stamp(spark.range(3), "2025-01-31"), tmp_root, "new")
    assert gates.stale_domains(spark, tmp_root, ["old", "new", "absent"], "2025-01-31") == ["old", "absent"]


def test_cli_stages(spark, roots):
    from sluice import cli
    raw, stg, err = roots + "/raw", roots + "/staging", roots + "/error"
    # one domain is quarantined: the command says so
    assert cli.main(["clean", "--source", raw, "--staging", stg, "--error", err,
                     "--as-of", "2025-01-31"]) == 1
    assert cli.main(["clean", "--source", raw, "--staging", stg, "--error", err,
                     "--as-of", "2025-01-31", "--domains", "provider_info,penalties"]) == 0
    assert cli.main(["validate", "--staging", stg, "--required", "provider_info,penalties",
                     "--as-of", "2025-01-31"]) == 0
    with pytest.raises(Exception):
        cli.main(["validate", "--staging", stg, "--required", "provider_info,nothing_here"])
    assert cli.main(["transform", "--domain", "provider", "--staging", stg,
                     "--transform", roots + "/t"]) == 0
    assert cli.main(["moves", "--source", raw, "--processed", roots + "/p", "--error", err,
                     "--tracked", "provider_info", "--out", roots + "/plan"]) == 0
    assert spark.read.parquet(roots + "/plan").count() == 6
    cli.main(["moves", "--source", raw, "--processed", roots + "/p", "--error", err, "--tracked",
              "provider_info", "--failed", "provider_info", "--out", roots + "/plan"])
    assert spark.read.parquet(roots + "/plan").where("status = 'processed'").count() == 0   # D7


def test_run_with_ingest_stage_d24(spark, roots):
    listing = spark.createDataFrame(
        [("f1", "NH_ProviderInfo_Jan", "application/vnd.google-apps.spreadsheet"),
         ("f2", "NH_Penalties_Jan.csv", "text/csv"), ("f3", "x.pdf", "application/pdf")],
        "id string, name string, mimeType string")
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                    transform_root=roots + "/transform", error_root=roots + "/error",
                    processed_root=roots + "/processed", as_of="2025-01-31",
                    listing=listing, manifest_path=roots + "/manifest", dry_run=True)
    res = run(spark, cfg)
    assert res.ingest.count() == 2
    from sluice.sources.manifest import read_manifest
    assert read_manifest(spark, roots + "/manifest").count() == 0       # dry run
    from sluice.sources.files import list_files
    assert list_files(spark, roots + "/staging").count() == 0            # nothing written at all
    cfg.dry_run = False
    assert run(spark, cfg).ingest.count() == 2
    assert read_manifest(spark, roots + "/manifest").count() == 0       # neither file has landed
    write_text(roots.replace("file:", "") + "/raw/penalties", "NH_Penalties_Jan.csv", "a\n1\n")
    assert run(spark, cfg).ingest.count() == 2
    assert [r.file_id for r in read_manifest(spark, roots + "/manifest").collect()] == ["f2"]
    assert [r.file_id for r in run(spark, cfg).ingest.collect()] == ["f1"]   # planned until it lands


def test_detect_changes_d20_and_routes(spark, roots):
    from sluice.sources.manifest import read_manifest
    listing = spark.createDataFrame(
        [("f1", "Pen.csv", "text/csv", "2025-01-01", ["up"]), ("f2", "x.csv", "text/csv", "2025-01-01", ["other"])],
        "id string, name string, mimeType string, modifiedTime string, parents array<string>")
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                    transform_root=roots + "/transform", error_root=roots + "/error",
                    processed_root=roots + "/processed", as_of="2025-01-31", listing=listing,
                    manifest_path=roots + "/manifest", detect_changes=True, folder="up",
                    routes=[("pen", "raw/penalties/")])
    write_text(roots.replace("file:", "") + "/raw/penalties", "Pen.csv", "a\n1\n")
    assert [r.s3_key for r in run(spark, cfg).ingest.collect()] == ["raw/penalties/Pen.csv"]
    assert run(spark, cfg).ingest.count() == 0
    # changed after the file that is there was written: not landed, so planned until it is
    cfg.listing = listing.withColumn("modifiedTime", F.lit("2125-02-01T10:00:00.000Z"))
    for _ in range(2):
        assert run(spark, cfg).ingest.count() == 1
        assert read_manifest(spark, roots + "/manifest", modified=True).where("modified_time > '2026'").count() == 0
    os.utime(roots.replace("file:", "") + "/raw/penalties/Pen.csv", (4896000000, 4896000000))   # in 2125
    assert run(spark, cfg).ingest.count() == 1
    assert read_manifest(spark, roots + "/manifest", modified=True).where("modified_time > '2125'").count() == 1
    assert run(spark, cfg).ingest.count() == 0


def test_failed_clean_keeps_the_last_good_table(spark, tmp_root):
    raw = tmp_root.replace("file:", "") + "/raw/dom"
    write_text(raw, "a.csv", "Zip Code,x\n1,2\n3,4\n")
    args = (spark, tmp_root + "/raw", tmp_root + "/staging", "dom", tmp_root + "/error")
    assert clean_domain(*args).status == gates.OK
    write_text(raw, "b.csv", "Zip Code,zip-code\n5,6\n")              # collides within one file
    assert clean_domain(*args).status == gates.QUARANTINED
    assert read_domain(spark, tmp_root + "/staging", "dom").count() == 2
    from sluice.sources.files import list_files
    assert list_files(spark, tmp_root + "/staging").where("domain <> 'dom'").count() == 0


def test_failed_transform_keeps_the_last_good_table(spark, roots):
    clean_all(spark, roots + "/raw", roots + "/staging", roots + "/error")
    assert quality_transform(spark, roots + "/staging", roots + "/t", roots + "/error").status == gates.OK
    bad = spark.range(3).selectExpr("raise_error('late') AS facility_number")
    st = gates.run_quarantined(spark, "qualitymsr_mds", build=lambda raw: bad,
                               publish=lambda out: write_domain(out, roots + "/t", "qualitymsr_mds"),
                               error_root=None, raw=lambda: spark.range(1))
    assert st.status == gates.FAILED and read_domain(spark, roots + "/t", "qualitymsr_mds").count() == 1


def test_layouts_meet_by_cleaned_name_in_paths_with_spaces(spark, tmp_root):
    raw = tmp_root.replace("file:", "") + "/raw/do m"
    write_text(raw, "NH Jan.csv", "Zip Code,x\n1,2\n")
    write_text(raw, "NH Feb.csv", "x,Zip-Code,extra\n3,4,5\n")
    st = clean_domain(spark, tmp_root + "/raw", tmp_root + "/staging", "do m", tmp_root + "/error")
    assert st.status == gates.OK, st
    got = read_domain(spark, tmp_root + "/staging", "do m").select("zip_code", "x", "extra").collect()
    assert sorted(map(tuple, got), key=str) == [("1", "2", None), ("4", "3", "5")]


def test_bad_lines_are_kept_apart(spark, tmp_root):
    raw = tmp_root.replace("file:", "") + "/raw/dom"
    write_text(raw, "a.csv", "k,v\n1,x\n2,y,EXTRA\n3\n")
    st = clean_domain(spark, tmp_root + "/raw", tmp_root + "/staging", "dom", tmp_root + "/error")
    staged = read_domain(spark, tmp_root + "/staging", "dom")
    assert (st.status, st.reason, st.rows) == (gates.OK, "2 malformed lines", 1)
    assert "_corrupt_record" not in staged.columns
    assert [tuple(r)[:2] for r in staged.collect()] == [("1", "x")]
    lines = read_domain(spark, tmp_root + "/error", "_bad_lines/dom")
    assert {(r.line, r.k) for r in lines.collect()} == {("2,y,EXTRA", "2"), ("3", "3")}
    # by load date: the same, and a load without bad lines clears the last one's
    dated = clean_domain(spark, tmp_root + "/raw", tmp_root + "/dated", "dom", tmp_root + "/error",
                         as_of="2025-01-31", partition_by_date=True)
    assert dated.rows == 1 and read_domain(spark, tmp_root + "/dated", "dom", "2025-01-31").count() == 1
    write_text(raw, "a.csv", "k,v\n1,x\n")
    assert clean_domain(spark, tmp_root + "/raw", tmp_root + "/staging", "dom", tmp_root + "/error").reason is None
    assert read_domain(spark, tmp_root + "/error", "_bad_lines/dom").count() == 0
    write_text(raw, "a.csv", "k,v\n1\n")                     # bad lines only: an empty table
    st = clean_domain(spark, tmp_root + "/raw", tmp_root + "/staging", "dom", tmp_root + "/error")
    assert st.rows == 0 and read_domain(spark, tmp_root + "/staging", "dom").count() == 0


def test_strict_sees_transform_failures(spark, roots):
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                    transform_root=roots + "/transform", error_root=roots + "/error",
                    processed_root=roots + "/processed", as_of="2025-01-31")
    stages = {(r.stage, r.domain): r.status for r in run(spark, cfg).stages.collect()}
    assert stages["clean", "unknown"] == gates.QUARANTINED and stages["provider", "facility"] == gates.OK
    cfg.strict = True
    with pytest.raises(gates.DomainFailedError):
        run(spark, cfg)


def test_dated_staging_without_as_of_reads_one_load(spark, roots):
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                    transform_root=roots + "/transform", error_root=roots + "/error",
                    processed_root=roots + "/processed", as_of="2025-01-30", partition_by_date=True)
    run(spark, cfg)
    cfg.as_of = None
    run(spark, cfg)
    assert read_domain(spark, roots + "/transform", "facility").count() == 3


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from sluice.session import ScratchFolderError, require_local
    for master in ("local", "local[4]", "local[*]", "local[2,3]"):
        require_local(master)
    for master in ("yarn", "spark://h:7077", "k8s://h", "local-cluster[2,1,1024]"):
        with pytest.raises(ScratchFolderError):
            require_local(master)


def test_reclean_same_apart_from_stamps(spark, roots):
    from sluice.plans.clean import clean_domain
    a = clean_domain(spark, roots + "/raw", roots + "/s1", "provider_info", as_of="2025-01-31")
    b = clean_domain(spark, roots + "/raw", roots + "/s2", "provider_info", as_of="2025-02-01")
    assert a.rows == b.rows == 3
    one = read_domain(spark, roots + "/s1", "provider_info").drop("row_id", "etl_date")
    two = read_domain(spark, roots + "/s2", "provider_info").drop("row_id", "etl_date")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_staging_partitioned_by_load_date(spark, roots):
    from sluice.plans.clean import clean_domain
    for day in ("2025-01-30", "2025-01-31", "2025-01-31"):
        st = clean_domain(spark, roots + "/raw", roots + "/stg", "penalties", as_of=day,
                          partition_by_date=True)
        assert st.status == gates.OK
    everything = read_domain(spark, roots + "/stg", "penalties")
    assert everything.count() == 2                      # one row per day; the re-run replaced its day
    day = read_domain(spark, roots + "/stg", "penalties", as_of="2025-01-31")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(etl_date" in plan


def test_full_run_with_dated_staging(spark, roots):
    kw = dict(raw_root=roots + "/raw", staging_root=roots + "/staging",
              transform_root=roots + "/transform", error_root=roots + "/error",
              processed_root=roots + "/processed", partition_by_date=True)
    run(spark, RunConfig(as_of="2025-01-30", **kw))
    run(spark, RunConfig(as_of="2025-01-31", **kw))
    # staging holds both loads; the transform of the second run saw only its own day
    assert read_domain(spark, roots + "/staging", "penalties").count() == 2
    assert read_domain(spark, roots + "/transform", "penalties").count() == 3
    assert read_domain(spark, roots + "/transform", "surveys").count() == 4


def test_cli_run_with_listing_dry_run(spark, roots):
    import json
    import os
    from sluice import cli
    from sluice.sources.manifest import read_manifest
    listing = os.path.join(roots.replace("file:", ""), "listing.json")
    os.makedirs(os.path.dirname(listing), exist_ok=True)
    with open(listing, "w") as fh:
        for rec in ({"id": "a", "name": "NH_Penalties_X.csv", "mimeType": "text/csv"},
                    {"id": "b", "name": "deck", "mimeType": "application/pdf"}):
            fh.write(json.dumps(rec) + "\n")
    args = ["run", "--raw", roots + "/raw", "--staging", roots + "/staging",
            "--transform", roots + "/transform", "--error", roots + "/error",
            "--processed", roots + "/processed", "--as-of", "2025-01-31",
            "--listing", listing, "--manifest", roots + "/manifest", "--dry-run"]
    assert cli.main(args) == 0
    assert read_manifest(spark, roots + "/manifest").count() == 0
    write_text(roots.replace("file:", "") + "/raw/penalties", "NH_Penalties_X.csv", "a\n1\n")
    assert cli.main(args[:-1]) == 1                                       # a domain is quarantined
    assert [r.s3_key for r in read_manifest(spark, roots + "/manifest").collect()] == [
        "raw/penalties/NH_Penalties_X.csv"]


def test_run_reports_file_counts(spark, roots):
    res = run(spark, RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                               transform_root=roots + "/transform", error_root=roots + "/error",
                               processed_root=roots + "/processed", as_of="2025-01-31"))
    counts = {r.domain: r.n_files for r in res.file_counts.collect()}
    assert counts["provider_info"] == 1 and counts["emptydom"] == 1


def test_clean_domain_with_spark_renamed_headers(spark, tmp_root):
    """Duplicate and blank header names: Spark renames them (Dup6/Dup7, _c8),
    its per-file check then reports a mismatch, and the regrouping path
    still cleans the folder."""
    from sluice.plans.clean import clean_domain
    raw = tmp_root + "/raw"
    write_text(raw + "/dom", "f1.csv", "a,b,c,d,e,f,Dup,Dup,\n1,2,3,4,5,6,7,8,9\n")
    write_text(raw + "/dom", "f2.csv", "a,b,c,d,e,f,Dup,Dup,\n1,2,3,4,5,6,7,8,9\n")
    st = clean_domain(spark, raw, tmp_root + "/stg", "dom", as_of="2025-01-31")
    assert st.status == gates.OK and st.rows == 2
    cols = read_domain(spark, tmp_root + "/stg", "dom").columns
    assert cols[6:9] == ["dup6", "dup7", "_c8"]


def test_run_reports_fanout_d15(spark, roots):
    res = run(spark, RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging",
                               transform_root=roots + "/transform", error_root=roots + "/error",
                               processed_root=roots + "/processed", as_of="2025-01-31"))
    rep = {r.facet: (r.left_rows, r.output_rows, r.max_matches, r.repeated_left_rows)
           for r in res.fanout.collect()}
    assert rep == {"surveys": (3, 4, 2, 1), "penalties": (3, 3, 1, 0)}


def test_run_lists_lost_values_and_rows_per_facet(spark, roots):
    raw = roots.replace("file:", "") + "/raw/provider_info/p.csv"
    with open(raw) as fh:
        text = fh.read()
    with open(raw, "w") as fh:
        fh.write(text.replace(",100,", ",many,").replace(",2001-02-03,", ",02/03/2001,", 2))
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging", transform_root=roots + "/transform",
                    error_root=roots + "/error", processed_root=roots + "/processed", as_of="2025-01-31")
    stages = {(r.stage, r.domain): r for r in run(spark, cfg).stages.collect()}
    assert stages["provider", "facility"].reason == (
        "lost values: date_first_approved_to_provide_medicare_and_medicaid_services=2, number_of_certified_beds=1")
    assert {d: r.rows for (s, d), r in stages.items() if s == "provider"} == {
        "facility": 3, "staffing": 3, "rating": 3, "surveys": 4, "penalties": 3}
    typed = quality_transform(spark, roots + "/staging", roots + "/typed", typed=True)
    assert typed.reason == "lost values: q3_measure_score=1"


def test_failed_facet_leaves_the_last_set(spark, roots):
    cfg = RunConfig(raw_root=roots + "/raw", staging_root=roots + "/staging", transform_root=roots + "/transform",
                    error_root=roots + "/error", processed_root=roots + "/processed", as_of="2025-01-31")
    run(spark, cfg)
    before = {n: read_domain(spark, cfg.transform_root, n).count() for n in ("facility", "surveys", "penalties")}
    write_text(roots.replace("file:", "") + "/raw/survey_summary", "s.csv", "Something Else\n1\n")
    write_text(roots.replace("file:", "") + "/raw/provider_info", "more.csv", PROVIDER + provider_row(7))
    stages = {(r.stage, r.domain): r.status for r in run(spark, cfg).stages.collect()}
    assert {s for (stage, _), s in stages.items() if stage == "provider"} == {gates.FAILED}
    assert {n: read_domain(spark, cfg.transform_root, n).count() for n in before} == before
