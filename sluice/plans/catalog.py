"""Registered queries: every operator re-aimed at the driver's tables.

The driver tables stand in for the domain data (customer for providers,
orders for penalty and survey details, events for domain records, documents
for a file listing, pages for an inventory).  Each query reads whole tables;
the matching DuckDB SQL in :data:`ORACLE_SQL` states the expected result
independently (expected values, not the same expressions), and every
computed column carries the same alias on both sides.

Queries that land data first (CSV, staging, facets) write under the shared
scratch folder and return the table read back.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.columns import (cast_audit, cast_schema, drop_if_exists, normalize_names,
                                      rename_map, select_fixed, select_keywords, trim_strings)
from sluice.operators.enrich import fanout_report, left_enrich
from sluice.operators.inventory import (count_by_domain, discover_domains, filter_mime,
                                        missing_required, move_plan, pending_files,
                                        present_domains, route_known, with_export_name,
                                        with_route)
from sluice.operators.stamps import add_etl_date, add_row_id
from sluice.plans import gates
from sluice.plans.chain import landed
from sluice.plans.clean import BAD_LINES, clean_all, clean_domain
from sluice.plans.ingest import ingest_plan, next_manifest
from sluice.plans.moves import apply_moves
from sluice.plans.presets import (CSV_MIME, DROP_LIST_A, EXPORT_MIMES, FACILITY_COLUMNS,
                                  FACILITY_SCHEMA, LISTED_MIMES, PENALTY_COLUMNS,
                                  QUALITY_SCHEMA, SPREADSHEET_MIME)
from sluice.plans.transform import provider_fanout, provider_transform, quality_frame, quality_transform
from sluice.session import scratch_path
from sluice.sources.csv import read_raw, write_csv
from sluice.sources.files import by_files, few_listing_tasks, inventory_from_paths, list_files, write_texts
from sluice.sources.manifest import compact_manifest, manifest_entries, read_manifest, write_manifest_entries
from sluice.sources.parquet import read_domain, stamp, write_domain, write_facets
from sluice.streaming.pickup import read_pickup, rejected_path_of, run_incremental_clean

# ---- fixed values for the registered queries ----
AS_OF = "2025-01-31"
SYNCED_AT = "2025-01-31 05:00:00"
SYNCED_AT_TEXT = "2025-01-31T05:00:00.000000Z"
OLD_SYNCED_AT_TEXT = "2025-01-01T00:00:00.000000Z"
PDF_MIME = "application/pdf"
PAGE_ROUTES = [("Blog", "raw/blog/"), ("example.org", "raw/org/"), ("/FR/", "raw/french/"),
               ("m.", "raw/mobile/")]
KNOWN_EVENT_TYPES = ["click", "view", "purchase"]
REQUIRED_EVENT_TYPES = ["click", "signup", "refund", "view", "chargeback"]
REQUESTED_EVENT_TYPES = ["click", "view", "refund"]
KNOWN_LANGS = ["en", "de", "fr"]
LANDING_ROOT = "s3://landing/raw"
PROCESSED_ROOT = "s3://processed/raw"
ERROR_ROOT = "s3://error/raw"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# ---------------------------------------------------------------- names


def q_normalize_names(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    messy = part.select(F.col("p_partkey").alias(" Part Key "), F.col("p_name").alias("Name (Full)"),
                        F.col("p_brand").alias("Brand/Maker"), F.col("p_type").alias("Type-Code"),
                        F.col("p_size").alias("Size.Value"),
                        F.col("p_retailprice").alias("Retail Price"))
    return normalize_names(messy)


def q_rename_map(spark, sf_dir):
    mapping = {" S_SUPPKEY": "supplier_id", "s_name ": "supplier_name", "s_phone": "supplier_phone"}
    return rename_map(table(spark, sf_dir, "supplier"), mapping)


def q_select_fixed(spark, sf_dir):
    return select_fixed(table(spark, sf_dir, "orders"),
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"])


def q_drop_if_exists(spark, sf_dir):
    return drop_if_exists(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_comment", "o_clerk"])


def q_select_keywords(spark, sf_dir):
    return select_keywords(table(spark, sf_dir, "lineitem"), ["price", "disc", "orderkey"])


# ---------------------------------------------------------------- trim / casts


def q_trim_strings(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    dirty = c.select(
        "c_custkey",
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("c_name"),
        "c_nationkey",
        F.when(F.col("c_nationkey") == 3, F.lit("   "))
        .when(F.col("c_nationkey") == 5, F.lit(None).cast("string"))
        .when(F.col("c_nationkey") == 7, F.concat(F.lit(" \t"), seg, F.lit(" ")))
        .otherwise(F.concat(F.lit(" "), seg, F.lit("  "))).alias("c_mktsegment"))
    return trim_strings(dirty)


def _part_texts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("string")
    month = F.lpad(((F.col("p_size") % 12) + 1).cast("string"), 2, "0")
    return p.select(
        "p_partkey",
        F.regexp_extract("p_brand", "[0-9]+", 0).alias("brand_num"),
        F.col("p_name").alias("name_num"),
        F.concat(size, F.lit("."), (F.col("p_partkey") % 10).cast("string")).alias("size_text"),
        F.concat(F.lit("-"), size, F.lit(".9")).alias("neg_text"),
        F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(" ")).alias("key_text"),
        F.concat(size, F.lit(".5")).alias("size_half"),
        F.concat(F.lit("2024-"), month, F.lit("-15")).alias("first_date"),
        F.concat(month, F.lit("/15/2024")).alias("slash_date"),
        "p_type")


PART_TEXT_SCHEMA = {
    "brand_num": T.IntegerType(), "name_num": T.DoubleType(), "size_text": T.IntegerType(),
    "neg_text": T.IntegerType(), "key_text": T.LongType(), "size_half": T.DoubleType(),
    "first_date": T.DateType(), "slash_date": T.DateType(), "absent_col": T.IntegerType(),
}


def q_cast_schema(spark, sf_dir):
    return cast_schema(_part_texts(spark, sf_dir), PART_TEXT_SCHEMA)


def q_cast_audit(spark, sf_dir):
    return cast_audit(_part_texts(spark, sf_dir), PART_TEXT_SCHEMA)


def _facility_texts(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    nk = F.col("c_nationkey").cast("string")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("facility_number"),
        F.col("c_name").alias("facility_address"),
        F.col("n_name").alias("city_town"),
        F.col("c_mktsegment").alias("ownership_type"),
        nk.alias("number_of_certified_beds"),
        F.concat(nk, F.lit(".25")).alias("average_number_of_residents_per_day"),
        F.concat(F.lit("fn "), F.col("n_regionkey").cast("string"))
        .alias("average_number_of_residents_per_day_footnote"),
        F.concat(F.lit("20"), F.lpad(nk, 2, "0"), F.lit("-03-01"))
        .alias("date_first_approved_to_provide_medicare_and_medicaid_services"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("Yes")).otherwise(F.lit("No"))
        .alias("special_focus_status"),
        F.col("c_custkey").cast("string").alias("row_id"),
        F.lit(AS_OF).alias("etl_date"))


def q_facility_schema(spark, sf_dir):
    return cast_schema(_facility_texts(spark, sf_dir), FACILITY_SCHEMA)


def _quality_texts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part")
    ln = F.col("l_linenumber").cast("string")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_orderkey").cast("string").alias("facility_number"),
        ln.alias("measure_code"),
        F.col("p_name").alias("measure_description"),
        F.col("p_type").alias("resident_type"),
        F.concat(ln, F.lit(".5")).alias("q1_measure_score"),
        F.col("l_returnflag").alias("footnote_for_q1_measure_score"),
        F.concat(F.lit("-"), F.col("p_size").cast("string")).alias("q2_measure_score"),
        F.col("l_linestatus").alias("footnote_for_q2_measure_score"),
        F.col("p_brand").alias("q3_measure_score"),
        F.col("p_type").alias("footnote_for_q3_measure_score"),
        F.concat(ln, F.lit("x")).alias("q4_measure_score"),
        F.col("l_returnflag").alias("footnote_for_q4_measure_score"),
        F.concat(F.col("p_size").cast("string"), F.lit(".0")).alias("four_quarter_average_score"),
        F.col("l_linestatus").alias("footnote_for_four_quarter_average_score"),
        F.when(F.col("l_returnflag") == "R", F.lit("Y")).otherwise(F.lit("N"))
        .alias("used_in_quality_measure_five_star_rating"),
        F.date_format("l_shipdate", "yyyy-MM").alias("measure_period"),
        F.col("p_brand").alias("location"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("processing_date"),
        F.col("p_name").alias("facility_name"),
        F.concat(F.lit("addr "), ln).alias("provider_address"))


def q_quality_schema(spark, sf_dir):
    return cast_schema(_quality_texts(spark, sf_dir).drop("facility_name", "provider_address"),
                       QUALITY_SCHEMA)


# ---------------------------------------------------------------- stamps


def q_add_row_id(spark, sf_dir):
    return add_row_id(table(spark, sf_dir, "orders"), mode="dense", order_by=["o_orderkey"])


def q_add_row_id_monotonic(spark, sf_dir):
    """Ids are unique, and each non-empty partition numbers its rows from 0
    in the low 33 bits (an empty first split makes the smallest id 2**33,
    so the smallest *position* is the invariant, not the smallest id)."""
    ids = add_row_id(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    position = F.col("row_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ids.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("row_id").alias("n_ids"),
                   F.min(position).alias("min_position"))


def q_add_etl_date(spark, sf_dir):
    return add_etl_date(table(spark, sf_dir, "region"), AS_OF)


# ---------------------------------------------------------------- joins


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_nationkey", "c_mktsegment")


def _shifted(key, every):
    """Every n-th key made negative: both sides of an enrichment get unmatched keys
    while all rows are read."""
    return F.when(key % every == 0, -key - 1).otherwise(key)


def _order_detail(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .select(_shifted(F.col("o_custkey"), 3).alias("custkey"), "o_orderkey",
                    "o_totalprice", "o_orderdate", "o_orderpriority"))


def q_left_enrich(spark, sf_dir):
    return left_enrich(_customers(spark, sf_dir), _order_detail(spark, sf_dir), "custkey",
                       drop=["o_orderpriority"])


def q_left_enrich_join(spark, sf_dir):
    return left_enrich(_customers(spark, sf_dir), _order_detail(spark, sf_dir), "custkey",
                       drop=["o_orderpriority"], strategy="join")


def q_left_enrich_salted(spark, sf_dir):
    """Salted inner join; a small split size so customers with many orders
    are actually salted at test scale."""
    return left_enrich(_customers(spark, sf_dir), _order_detail(spark, sf_dir), "custkey",
                       drop=["o_orderpriority"], strategy="salted", rows_per_split=4)


def q_fanout_report(spark, sf_dir):
    return fanout_report(_customers(spark, sf_dir), _order_detail(spark, sf_dir), "custkey")


def q_penalties_slice(spark, sf_dir):
    """Minimum slice: fixed facet projection, detail stripped by the drop list,
    left join on the key, stamps; written and read back."""
    facets = {"penalties": left_enrich(_provider_like(spark, sf_dir)
                                       .select(*PENALTY_COLUMNS),
                                       _penalty_detail(spark, sf_dir), "facility_number",
                                       drop=DROP_LIST_A + ["row_id", "etl_date"])}
    root = scratch_path(spark, "transform")
    paths = write_facets(facets, root, AS_OF)
    return spark.read.parquet(paths["penalties"]).drop("row_id")


# ---------------------------------------------------------------- listings / inventory


def _doc_listing(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    ident = F.col("doc_id").cast("string")
    name = (F.when(F.col("lang") == "en", F.concat(F.lit("NH_ProviderInfo_"), ident))
            .when(F.col("lang") == "fr", F.concat(F.lit("NH_Penalties_"), ident))
            .when(F.col("lang") == "de", F.concat(F.lit("NH_QualityMsr_MDS_"), ident))
            .otherwise(F.concat(F.lit("misc_"), ident)))
    mime = (F.when(F.col("lang") == "en", F.lit(SPREADSHEET_MIME))
            .when(F.col("lang") == "es", F.lit(PDF_MIME)).otherwise(F.lit(CSV_MIME)))
    return d.select(ident.alias("id"), name.alias("name"), mime.alias("mimeType"))


def _labels_manifest(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    files = lab.select(F.col("doc_id").cast("string").alias("id"),
                       F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".csv"))
                       .alias("name"), F.lit("raw/other/").alias("folder"))
    return manifest_entries(files, "id", "name", "folder", F.lit(OLD_SYNCED_AT_TEXT))


def q_classify_route(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return with_route(pages, "url", PAGE_ROUTES, "raw/other/")


def q_export_name(spark, sf_dir):
    listing = _doc_listing(spark, sf_dir)
    return with_export_name(listing, "name", "mimeType", EXPORT_MIMES)


def q_filter_mime(spark, sf_dir):
    return filter_mime(_doc_listing(spark, sf_dir), LISTED_MIMES)


def q_pending_files(spark, sf_dir):
    return pending_files(_doc_listing(spark, sf_dir), _labels_manifest(spark, sf_dir), "id")


def q_route_known(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("domain"))
    return route_known(ev, KNOWN_EVENT_TYPES)


def q_required_present(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("domain"))
    return missing_required(REQUIRED_EVENT_TYPES, ev)


def q_skip_empty(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("domain"))
    return present_domains(REQUESTED_EVENT_TYPES, ev)


def q_count_by_domain(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(F.col("event_type").alias("domain"))
    return count_by_domain(ev)


def _page_inventory(spark, sf_dir, part_index):
    pages = table(spark, sf_dir, "pages")
    folder = F.element_at(F.split("url", "/"), part_index)
    paths = pages.select(F.concat(F.lit(LANDING_ROOT + "/"), folder, F.lit("/"),
                                  F.col("page_id").cast("string"), F.lit(".html")).alias("path"))
    return inventory_from_paths(paths, LANDING_ROOT)


def q_discover_domains(spark, sf_dir):
    return discover_domains(_page_inventory(spark, sf_dir, 3))


def q_discover_domains_files(spark, sf_dir):
    """Domains of a real folder tree: pages written one folder per language,
    listed with the binary-file source (contents never read)."""
    root = scratch_path(spark, "landing")
    pages = table(spark, sf_dir, "pages")
    (pages.select(F.element_at(F.split("url", "/"), 4).alias("lang"), "page_id", "url")
     .write.partitionBy("lang").json(root))
    return discover_domains(list_files(spark, root))


def q_required_present_files(spark, sf_dir):
    """The required-data gate over a real staged tree: events written one
    folder per type, listed (marker files ignored), missing folders reported."""
    root = scratch_path(spark, "staging")
    table(spark, sf_dir, "events").write.partitionBy("event_type").parquet(root)
    present = list_files(spark, root).where("NOT hidden")
    return missing_required([f"event_type={t}" for t in REQUIRED_EVENT_TYPES], present)


def q_move_plan(spark, sf_dir):
    return move_plan(_page_inventory(spark, sf_dir, 4), KNOWN_LANGS, LANDING_ROOT,
                     PROCESSED_ROOT, ERROR_ROOT)


def q_move_summary(spark, sf_dir):
    """Files to move per target (the totals a move run reports)."""
    plan = q_move_plan(spark, sf_dir)
    return plan.groupBy("status").agg(F.count(F.lit(1)).alias("n_files"))


# ---------------------------------------------------------------- manifest / ingest


def q_manifest_read(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    _labels_manifest(spark, sf_dir).write.mode("append").json(path)
    return read_manifest(spark, path)


def q_ingest_plan(spark, sf_dir):
    return ingest_plan(_doc_listing(spark, sf_dir), _labels_manifest(spark, sf_dir),
                       synced_at=SYNCED_AT)


def q_manifest_append(spark, sf_dir):
    path = scratch_path(spark, "manifest")
    _labels_manifest(spark, sf_dir).write.mode("append").json(path)
    return next_manifest(_doc_listing(spark, sf_dir), read_manifest(spark, path),
                         synced_at=SYNCED_AT)


# ---------------------------------------------------------------- sources / sinks


#: Column orders of six files' headers; a name with a space, and columns that some files lack.
CSV_LAYOUTS = [["s_suppkey", "s_name", "s_nationkey"], ["s_nationkey", "s_suppkey", "s_name"], ["s_name", "s_nationkey", "s_suppkey"],
               ["s_suppkey", "s_name"], ["s_name", "Also Known", "s_suppkey", "s_nationkey"], ["Also Known", "s_suppkey"]]


def q_csv_scan(spark, sf_dir):
    """Files of six layouts in one folder, parsed once and aligned by name."""
    s = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "raw-supplier")
    texts = s.select(*[F.col(c).cast("string").alias(c) for c in ("s_suppkey", "s_name", "s_nationkey")],
                     F.concat(F.lit("aka, "), "s_name").alias("Also Known"), F.coalesce(F.pmod("s_suppkey", F.lit(len(CSV_LAYOUTS))), F.lit(0)).alias("layout"))
    for i, names in enumerate(CSV_LAYOUTS):
        write_csv(texts.where(F.col("layout") == i).select(*names), path, "append")
    return read_raw(spark, path)


def q_parquet_scan(spark, sf_dir):
    root = scratch_path(spark, "staging")
    write_domain(table(spark, sf_dir, "region"), root, "region")
    return read_domain(spark, root, "region")


def q_parquet_overwrite(spark, sf_dir):
    root = scratch_path(spark, "staging")
    write_domain(table(spark, sf_dir, "region"), root, "dim")
    write_domain(table(spark, sf_dir, "nation"), root, "dim")
    return read_domain(spark, root, "dim")


FANOUT_FACETS = {"pricing": ["price", "disc", "tax", "orderkey"],
                 "status": ["flag", "status", "orderkey"],
                 "shipping": ["ship", "quantity", "orderkey"]}


def q_facet_fanout(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "facets")
    paths = write_facets({n: select_keywords(li, k) for n, k in FANOUT_FACETS.items()}, root,
                         AS_OF)
    out = None
    for name in FANOUT_FACETS:
        back = spark.read.parquet(paths[name])
        counted = back.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("facet"), "n_rows", F.lit(len(back.columns)).alias("n_cols"))
        out = counted if out is None else out.unionByName(counted)
    return out


def q_quarantine(spark, sf_dir):
    staging = scratch_path(spark, "staging")
    errors = scratch_path(spark, "error")
    runs = [
        ("orders", lambda: table(spark, sf_dir, "orders"),
         lambda df: select_fixed(df, ["o_orderkey", "o_custkey"])),
        ("part", lambda: table(spark, sf_dir, "part"),
         lambda df: select_fixed(df, ["p_partkey", "p_container"])),
        ("refunds", lambda: table(spark, sf_dir, "events").where(F.col("event_type") == "refund"),
         lambda df: df),
    ]
    statuses = [gates.run_quarantined(spark, name, build=build,
                                      publish=lambda out, n=name: write_domain(out, staging, n),
                                      error_root=errors, raw=raw)
                for name, raw, build in runs]
    return gates.status_frame(spark, statuses)


# ---------------------------------------------------------------- composite jobs


def _raw_customers(spark, sf_dir):
    """customer as a raw provider file: messy headers, padded values."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("CMS Certification Number (CCN)"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit("  ")).alias("Provider Name"),
        F.col("c_nationkey").cast("string").alias(" State "),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("Ownership-Type"))


def q_clean_domain(spark, sf_dir):
    raw_root = scratch_path(spark, "raw")
    staging = scratch_path(spark, "staging")
    write_csv(_raw_customers(spark, sf_dir), f"{raw_root}/provider_info")
    status = clean_domain(spark, raw_root, staging, "provider_info", as_of=AS_OF)
    if status.status != gates.OK:
        raise RuntimeError(f"clean_domain failed: {status}")
    return read_domain(spark, staging, "provider_info").drop("row_id")


def q_clean_documents(spark, sf_dir):
    """Whole texts (newlines, quotes, up to 20,000 words) landed as raw CSV
    with quoted multi-line values, then cleaned."""
    d = table(spark, sf_dir, "documents")
    raw_root = scratch_path(spark, "raw")
    staging = scratch_path(spark, "staging")
    write_csv(d.select(F.col("doc_id").cast("string").alias("Doc ID"), F.col("lang").alias("Lang"),
                       F.col("source").alias("Source"), F.col("text").alias("Text")),
              f"{raw_root}/documents")
    status = clean_domain(spark, raw_root, staging, "documents", as_of=AS_OF,
                          csv_options={"multiLine": "true"})
    if status.status != gates.OK:
        raise RuntimeError(f"clean_documents failed: {status}")
    return read_domain(spark, staging, "documents").drop("row_id")


def q_incremental_clean(spark, sf_dir):
    raw = _raw_customers(spark, sf_dir)
    raw_path = scratch_path(spark, "raw-stream")
    out = scratch_path(spark, "staging-stream")
    ckpt = scratch_path(spark, "stream-ckpt")
    low = F.coalesce(F.col(" State ").cast("int") < 12, F.lit(False))
    header = raw.columns
    write_csv(raw.where(low), raw_path, "append")
    run_incremental_clean(spark, raw_path, header, out, ckpt, as_of=AS_OF)
    write_csv(raw.where(~low), raw_path, "append")
    run_incremental_clean(spark, raw_path, header, out, ckpt, as_of=AS_OF)
    return read_pickup(spark, out)


def _write_bad_lines(spark, sf_dir, path):
    """A raw provider file with a field too many on the line of every seventh customer."""
    c = table(spark, sf_dir, "customer").where("c_custkey % 7 = 0")
    header = ",".join(_raw_customers(spark, sf_dir).columns)
    lines = c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment", F.lit("one too many")).alias(header))
    # a column of whole lines under a header of whole names
    lines.write.mode("append").option("header", True).option("sep", "\u0001").option("quote", "\u0000").option("escapeQuotes", False).csv(path)


def q_clean_bad_lines(spark, sf_dir):
    """Good rows reach staging, malformed lines the error root, by one write."""
    raw_root, staging, error = (scratch_path(spark, n) for n in ("raw", "staging", "error"))
    write_csv(_raw_customers(spark, sf_dir), f"{raw_root}/provider_info")
    _write_bad_lines(spark, sf_dir, f"{raw_root}/provider_info")
    status = clean_domain(spark, raw_root, staging, "provider_info", error, as_of=AS_OF)
    good = read_domain(spark, staging, "provider_info").select("facility_number", F.lit(None).cast("string").alias("line"))
    bad = read_domain(spark, error, f"{BAD_LINES}/provider_info").select("facility_number", "line")
    return good.unionAll(bad).withColumn("reason", F.lit(status.reason)).withColumn("n_good", F.lit(status.rows))


def q_incremental_rejects(spark, sf_dir):
    """A file with other columns and malformed lines beside a good file, and a later
    good one: what landed, and what was set aside and why."""
    raw = _raw_customers(spark, sf_dir)
    raw_path, out, ckpt = (scratch_path(spark, n) for n in ("raw-stream", "staging-stream", "stream-ckpt"))
    odd = F.coalesce(F.pmod(F.col("`CMS Certification Number (CCN)`").cast("long"), F.lit(2)) == 1, F.lit(False))
    turned = list(reversed(raw.columns))
    write_csv(raw.where(odd), raw_path, "append")
    write_csv(table(spark, sf_dir, "nation").select("n_nationkey", "n_name").coalesce(1), raw_path, "append")
    _write_bad_lines(spark, sf_dir, raw_path)
    run_incremental_clean(spark, raw_path, raw.columns, out, ckpt, as_of=AS_OF)
    write_csv(raw.where(~odd).select(*[f"`{c}`" for c in turned]), raw_path, "append")
    run_incremental_clean(spark, raw_path, raw.columns, out, ckpt, as_of=AS_OF)
    landed_rows = read_pickup(spark, out).select(F.concat_ws("|", "facility_number", "facility_name", "state", "ownership_type").alias("line"), F.lit("landed").alias("reason"))
    return landed_rows.unionAll(read_pickup(spark, rejected_path_of(out)).select("line", "reason"))


def _provider_like(spark, sf_dir):
    """customer as a staged provider table (every column text)."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    nk = F.col("c_nationkey")
    given = {
        "facility_number": key,
        "facility_name": F.col("c_name"),
        "state": nk.cast("string"),
        "ownership_type": F.col("c_mktsegment"),
        "number_of_certified_beds": (nk + 10).cast("string"),
        "average_number_of_residents_per_day": F.concat(nk.cast("string"), F.lit(".5")),
        "date_first_approved_to_provide_medicare_and_medicaid_services":
            F.concat(F.lit("20"), F.lpad(nk.cast("string"), 2, "0"), F.lit("-06-30")),
        "number_of_facility_reported_incidents": (nk % 4).cast("string"),
        "number_of_substantiated_complaints": (nk % 5).cast("string"),
        "number_of_citations_from_infection_control_inspections": (nk % 3).cast("string"),
        "number_of_fines": (nk % 2).cast("string"),
        "total_amount_of_fines_in_dollars": (nk * 1000).cast("string"),
        "number_of_payment_denials": (nk % 6).cast("string"),
        "total_number_of_penalties": (nk % 7).cast("string"),
        "overall_rating": ((nk % 5) + 1).cast("string"),
        "staffing_rating": ((nk % 4) + 1).cast("string"),
        "staffing_rating_footnote": F.concat(F.lit("sf"), nk.cast("string")),
        "reported_hours_per_resident": F.concat(nk.cast("string"), F.lit(".25")),
        "total_turnover": (nk % 9).cast("string"),
        "case_mix_index": F.concat(F.lit("1."), nk.cast("string")),
        "adjusted_total": (nk * 3).cast("string"),
        "rating_cycle_1_score": (nk % 8).cast("string"),
        "health_deficiency_score": (nk % 10).cast("string"),
        "revisit_score_1": (nk % 11).cast("string"),
        "total_weighted_health_survey_score": (nk * 2).cast("string"),
        "generating_capacity": F.concat(F.lit("g"), nk.cast("string")),
        "staff_count": (nk + 1).cast("string"),
    }
    cols = [given.get(name, F.concat(F.lit(name[:4] + ":"), key)).alias(name)
            for name in FACILITY_COLUMNS if name not in ("row_id", "etl_date")]
    cols += [v.alias(k) for k, v in given.items() if k not in FACILITY_COLUMNS]
    staged = c.select(*cols)
    return stamp(staged, "2025-01-30")


def _penalty_detail(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return stamp(o.select(
        _shifted(F.col("o_custkey"), 3).cast("string").alias("facility_number"),
        F.col("o_orderkey").cast("string").alias("penalty_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("penalty_date"),
        F.col("o_orderpriority").alias("penalty_type"),
        F.lit("somewhere").alias("city_town")), "2025-01-30")


def _survey_detail(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return stamp(o.select(
        _shifted(F.col("o_custkey"), 4).cast("string").alias("facility_number"),
        F.col("o_orderkey").cast("string").alias("survey_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("survey_date"),
        F.lit("name").alias("facility_name"), F.lit("zip").alias("zip_code")), "2025-01-30")


def _provider_run(spark, sf_dir):
    staging = scratch_path(spark, "staging")
    write_domain(_provider_like(spark, sf_dir), staging, "provider_info")
    write_domain(_survey_detail(spark, sf_dir), staging, "survey_summary")
    write_domain(_penalty_detail(spark, sf_dir), staging, "penalties")
    transform = scratch_path(spark, "transform")
    return provider_transform(spark, staging, transform, as_of=AS_OF)


def q_provider_transform(spark, sf_dir):
    paths = _provider_run(spark, sf_dir)
    return spark.read.parquet(paths["penalties"]).drop("row_id")


def q_provider_facility(spark, sf_dir):
    """Facility facet: 24 fixed columns, typed; staging stamps kept."""
    paths = _provider_run(spark, sf_dir)
    return spark.read.parquet(paths["facility"]).drop("row_id")


def q_provider_surveys(spark, sf_dir):
    """Surveys facet: keyword columns left-enriched with the survey detail."""
    paths = _provider_run(spark, sf_dir)
    return spark.read.parquet(paths["surveys"]).drop("row_id")


def q_provider_staffing(spark, sf_dir):
    """Staffing facet: keyword columns without the drop list, re-stamped."""
    return spark.read.parquet(_provider_run(spark, sf_dir)["staffing"]).drop("row_id")


def q_provider_rating(spark, sf_dir):
    """Rating facet: the loose rating keywords also take every footnote column."""
    return spark.read.parquet(_provider_run(spark, sf_dir)["rating"]).drop("row_id")


def q_provider_untyped(spark, sf_dir):
    """Facility facet of the variant without casts: every column stays text."""
    staging, transform = scratch_path(spark, "staging"), scratch_path(spark, "transform")
    for name, frame in (("provider_info", _provider_like(spark, sf_dir)), ("survey_summary", _survey_detail(spark, sf_dir)), ("penalties", _penalty_detail(spark, sf_dir))):
        write_domain(frame, staging, name)
    return spark.read.parquet(provider_transform(spark, staging, transform, as_of=AS_OF, typed=False)["facility"]).drop("row_id")


def q_provider_facets(spark, sf_dir):
    paths = _provider_run(spark, sf_dir)
    out = None
    for name in ("facility", "staffing", "rating", "surveys", "penalties"):
        back = spark.read.parquet(paths[name])
        counted = back.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("facet"), "n_rows", F.lit(len(back.columns)).alias("n_cols"))
        out = counted if out is None else out.unionByName(counted)
    return out


def q_provider_fanout(spark, sf_dir):
    """Fan-out report of the provider enrichments (surveys, penalties)."""
    return provider_fanout(_provider_like(spark, sf_dir), _survey_detail(spark, sf_dir),
                           _penalty_detail(spark, sf_dir))


def q_quality_transform(spark, sf_dir):
    staging = scratch_path(spark, "staging")
    write_domain(stamp(_quality_texts(spark, sf_dir), "2025-01-30"), staging, "qualitymsr_mds")
    transform = scratch_path(spark, "transform")
    out = quality_frame(read_domain(spark, staging, "qualitymsr_mds"), as_of=AS_OF)
    write_domain(out, transform, "qualitymsr_mds")
    return read_domain(spark, transform, "qualitymsr_mds").drop("row_id")


def q_quality_transform_typed(spark, sf_dir):
    """Typed variant: every staged column kept, schema casts, re-stamped."""
    staging = scratch_path(spark, "staging")
    write_domain(stamp(_quality_texts(spark, sf_dir), "2025-01-30"), staging, "qualitymsr_mds")
    transform = scratch_path(spark, "transform")
    out = quality_frame(read_domain(spark, staging, "qualitymsr_mds"), typed=True, as_of=AS_OF)
    write_domain(out, transform, "qualitymsr_mds")
    return read_domain(spark, transform, "qualitymsr_mds").drop("row_id")


# ---------------------------------------------------------------- runs


def q_publish_on_failure(spark, sf_dir):
    """A good load, then one that fails while it is written: the first load's
    rows are still there."""
    staging = scratch_path(spark, "staging")
    good = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    write_domain(good, staging, "customers")
    late = good.withColumn("c_name", F.when(F.col("c_custkey") >= 0, F.raise_error(F.lit("late")))
                           .otherwise(F.col("c_name")))
    status = gates.run_quarantined(
        spark, "customers", build=lambda raw: late,
        publish=lambda out: write_domain(out, staging, "customers"), error_root=None,
        raw=lambda: good)
    return read_domain(spark, staging, "customers").withColumn("last_load", F.lit(status.status))


def q_facets_as_set(spark, sf_dir):
    """Five facets published, then a load whose third facet fails while it is
    written: all five are those of the first load."""
    root = scratch_path(spark, "facets")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity")
    names = ("facility", "staffing", "rating", "surveys", "penalties")

    def load(n, bad=None):
        frames = {f: li.select("l_orderkey", F.lit(n).alias("load")) for f in names}
        if bad:
            frames[bad] = li.select(F.when(F.col("l_orderkey") >= 0, F.raise_error(F.lit("late"))).otherwise(F.col("l_orderkey")).alias("l_orderkey"), F.lit(n).alias("load"))
        return write_facets(frames, root, AS_OF, stamp_rows=False)

    load(1)
    try:
        load(2, "rating")
        outcome = "published"
    except Exception:  # noqa: BLE001 - the failure is what is asked for
        outcome = "refused"
    out = [read_domain(spark, root, f).groupBy("load").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(f).alias("facet"), "load", "n_rows") for f in names]
    return reduce(DataFrame.unionAll, out).withColumn("second_load", F.lit(outcome))


def q_lost_values(spark, sf_dir):
    """Status of the typed quality transform: the values that its casts turned to
    null, counted by the write itself."""
    staging, transform = scratch_path(spark, "staging"), scratch_path(spark, "transform")
    write_domain(_quality_texts(spark, sf_dir), staging, "qualitymsr_mds")
    return gates.status_frame(spark, [quality_transform(spark, staging, transform, as_of=AS_OF, typed=True)])


def q_move_apply(spark, sf_dir):
    """Pages as files under one folder per language, a file each and a folder for
    every 10,000 ids, moved by the plan: what is found under each target, what is
    left, and how many files a second run moves."""
    raw, processed, error = (scratch_path(spark, n) for n in ("raw", "processed", "error"))

    def folder(name, value):
        return F.concat(F.lit(f"{name}="), F.coalesce(F.nullif(F.url_encode(value), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")))

    pages = table(spark, sf_dir, "pages").select(F.element_at(F.split("url", "/"), 4).alias("lang"), F.col("page_id").alias("page"), "url")
    name = F.concat_ws("-", F.lit("page"), F.col("page").cast("string"), F.monotonically_increasing_id().cast("string"))
    write_texts(pages.select(F.concat(folder("lang", F.col("lang")), F.lit("/"), folder("block", F.expr("string(page div 10000)")), F.lit("/"), name, F.lit(".json")).alias("key"),
                             F.concat(F.to_json(F.struct("page", "url")), F.lit("\n")).alias("text")), raw)

    def run():
        plan = move_plan(list_files(spark, raw).where("NOT hidden"), [f"lang={x}" for x in KNOWN_LANGS], raw, processed, error)
        return apply_moves(spark, plan, f"{processed}/_moves")

    run()
    again = run().count()
    left = list_files(spark, raw).where("NOT hidden").count()
    with few_listing_tasks(spark):
        found = [by_files(spark.read.schema("page long, url string").json(root, recursiveFileLookup=True)).select(F.lit(name).alias("target"), "page", "url")
                 for name, root in (("processed", processed), ("error", error)) if not list_files(spark, root).isEmpty()]
    return reduce(DataFrame.unionAll, found).withColumn("moved_again", F.lit(again)).withColumn("left_behind", F.lit(left))


def q_manifest_compact(spark, sf_dir):
    """The labels' records by two runs, of which the second is repeated and has a
    newer record of every third file; compacted, then read."""
    lab = table(spark, sf_dir, "labels")
    path = scratch_path(spark, "manifest")

    def entries(rows, time):
        files = rows.select(F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"), F.lit("raw/other/").alias("folder"), F.lit(time).alias("time"))
        return manifest_entries(files, "id", "name", "folder", F.lit(OLD_SYNCED_AT_TEXT), "time")

    write_manifest_entries(entries(lab, "2025-01-01"), path, "first")
    for _ in range(2):
        write_manifest_entries(entries(lab.where("doc_id % 3 = 0"), "2025-02-01"), path, "second")
    before = read_manifest(spark, path).count()
    parts = compact_manifest(spark, path)
    return read_manifest(spark, path, modified=True).select("file_id", "modified_time").withColumn("records_before", F.lit(before)).withColumn("parts", F.lit(parts))


def q_run_status(spark, sf_dir):
    """One status row per stage and table of a run in which one domain cannot
    be cleaned (two of its headers clean to one name)."""
    raw, staging, error = (scratch_path(spark, n) for n in ("raw", "staging", "error"))
    write_csv(_raw_customers(spark, sf_dir), f"{raw}/customers")
    n = table(spark, sf_dir, "nation")
    write_csv(n.select(F.col("n_nationkey").alias("Nation Key"), F.col("n_name").alias("Nation-Key")), f"{raw}/nations")
    cleaned = clean_all(spark, raw, staging, error, as_of=AS_OF)
    rows = [gates.Status(*r) for r in cleaned.orderBy("domain").collect()]
    return gates.stage_frame(spark, {"clean": rows})


def q_ingest_changed(spark, sf_dir):
    """Change detection: of the listed documents every label knows an older
    modified time of those with even ids, so they are landed again."""
    listing = _doc_listing(spark, sf_dir).withColumn("modifiedTime", F.lit("2025-02-01"))
    seen = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.concat(F.lit("doc_"), F.col("doc_id")).alias("name"),
        F.lit("raw/other/").alias("folder"),
        F.when(F.col("doc_id") % 2 == 0, "2025-01-01").otherwise("2025-02-01").alias("modifiedTime"))
    path = scratch_path(spark, "manifest")
    manifest_entries(seen, "id", "name", "folder", F.lit(OLD_SYNCED_AT_TEXT), "modifiedTime").write.json(path)
    plan = ingest_plan(listing, read_manifest(spark, path, modified=True), modified_col="modifiedTime")
    return plan.select("file_id", "modified_time")


def q_manifest_landed_only(spark, sf_dir):
    """Of the planned files those whose ids end in 0 have landed: only they
    are recorded."""
    plan = ingest_plan(_doc_listing(spark, sf_dir), _labels_manifest(spark, sf_dir))
    there = plan.where(F.col("file_id").endswith("0")).select(F.concat(F.lit("s3a://landing/"), F.col("s3_key")).alias("path"))
    return landed(plan, there, "s3a://landing").select("file_id", "file_name")


QUERIES: dict[str, Query] = {
    "publish_on_failure": q_publish_on_failure,
    "run_status": q_run_status,
    "facets_as_set": q_facets_as_set,
    "lost_values": q_lost_values,
    "move_apply": q_move_apply,
    "manifest_compact": q_manifest_compact,
    "clean_bad_lines": q_clean_bad_lines,
    "incremental_rejects": q_incremental_rejects,
    "provider_staffing": q_provider_staffing,
    "provider_rating": q_provider_rating,
    "provider_untyped": q_provider_untyped,
    "ingest_changed": q_ingest_changed,
    "manifest_landed_only": q_manifest_landed_only,
    "csv_scan": q_csv_scan,
    "parquet_scan": q_parquet_scan,
    "parquet_overwrite": q_parquet_overwrite,
    "facet_fanout": q_facet_fanout,
    "discover_domains": q_discover_domains,
    "discover_domains_files": q_discover_domains_files,
    "manifest_read": q_manifest_read,
    "manifest_append": q_manifest_append,
    "normalize_names": q_normalize_names,
    "rename_map": q_rename_map,
    "trim_strings": q_trim_strings,
    "cast_schema": q_cast_schema,
    "cast_audit": q_cast_audit,
    "facility_schema": q_facility_schema,
    "quality_schema": q_quality_schema,
    "select_fixed": q_select_fixed,
    "select_keywords": q_select_keywords,
    "drop_if_exists": q_drop_if_exists,
    "add_row_id": q_add_row_id,
    "add_row_id_monotonic": q_add_row_id_monotonic,
    "add_etl_date": q_add_etl_date,
    "classify_route": q_classify_route,
    "export_name": q_export_name,
    "filter_mime": q_filter_mime,
    "skip_empty": q_skip_empty,
    "left_enrich": q_left_enrich,
    "left_enrich_join": q_left_enrich_join,
    "left_enrich_salted": q_left_enrich_salted,
    "fanout_report": q_fanout_report,
    "pending_files": q_pending_files,
    "route_known": q_route_known,
    "required_present": q_required_present,
    "required_present_files": q_required_present_files,
    "count_by_domain": q_count_by_domain,
    "move_plan": q_move_plan,
    "move_summary": q_move_summary,
    "quarantine": q_quarantine,
    "clean_domain": q_clean_domain,
    "clean_documents": q_clean_documents,
    "incremental_clean": q_incremental_clean,
    "penalties_slice": q_penalties_slice,
    "provider_transform": q_provider_transform,
    "provider_facets": q_provider_facets,
    "provider_facility": q_provider_facility,
    "provider_surveys": q_provider_surveys,
    "provider_fanout": q_provider_fanout,
    "quality_transform": q_quality_transform,
    "quality_transform_typed": q_quality_transform_typed,
    "ingest_plan": q_ingest_plan,
}
