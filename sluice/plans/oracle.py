"""Expected results of the registered queries, as DuckDB SQL over the same
Parquet tables.  Written from the operator semantics (expected values), not
by mirroring the Spark expressions."""

from __future__ import annotations

_LISTING = """listing AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
         CASE lang WHEN 'en' THEN 'NH_ProviderInfo_' WHEN 'fr' THEN 'NH_Penalties_'
                   WHEN 'de' THEN 'NH_QualityMsr_MDS_' ELSE 'misc_' END
           || CAST(doc_id AS VARCHAR) AS name,
         CASE lang WHEN 'en' THEN 'application/vnd.google-apps.spreadsheet'
                   WHEN 'es' THEN 'application/pdf' ELSE 'text/csv' END AS mimeType
  FROM documents)"""

_OLD_MANIFEST = """SELECT CAST(doc_id AS VARCHAR) AS file_id,
       'doc_' || CAST(doc_id AS VARCHAR) || '.csv' AS file_name,
       'raw/other/doc_' || CAST(doc_id AS VARCHAR) || '.csv' AS s3_key,
       '2025-01-01T00:00:00.000000Z' AS synced_at
FROM labels"""

_NEW_MANIFEST = """SELECT id AS file_id, fname AS file_name,
       CASE WHEN contains(k, 'providerinfo') THEN 'raw/provider_info/'
            WHEN contains(k, 'penalties') THEN 'raw/penalties/'
            WHEN contains(k, 'surveysummary') THEN 'raw/survey_summary/'
            WHEN contains(k, 'qualitymds') THEN 'raw/qualitymsr_mds/'
            WHEN contains(k, 'qualitymsrmds') THEN 'raw/qualitymsr_mds/'
            ELSE 'raw/other/' END || fname AS s3_key,
       '2025-01-31T05:00:00.000000Z' AS synced_at
FROM (SELECT id, fname, lower(replace(replace(fname, 'NH_', ''), '_', '')) AS k
      FROM (SELECT id, CASE WHEN mimeType = 'application/vnd.google-apps.spreadsheet'
                            THEN name || '.csv' ELSE name END AS fname
            FROM listing l
            WHERE mimeType IN ('text/csv', 'application/vnd.google-apps.spreadsheet')
              AND NOT EXISTS (SELECT 1 FROM labels b WHERE CAST(b.doc_id AS VARCHAR) = l.id)))"""

_CUSTOMER_CLEAN = """SELECT CAST(c_custkey AS VARCHAR) AS facility_number, c_name AS facility_name,
       CAST(c_nationkey AS VARCHAR) AS state, c_mktsegment AS ownership_type{extra},
       DATE '2025-01-31' AS etl_date
FROM customer"""

_PENALTIES = """SELECT CAST(c.c_custkey AS VARCHAR) AS facility_number,
       CAST(c_nationkey % 4 AS VARCHAR) AS number_of_facility_reported_incidents,
       CAST(c_nationkey % 5 AS VARCHAR) AS number_of_substantiated_complaints,
       CAST(c_nationkey % 3 AS VARCHAR) AS number_of_citations_from_infection_control_inspections,
       CAST(c_nationkey % 2 AS VARCHAR) AS number_of_fines,
       CAST(c_nationkey * 1000 AS VARCHAR) AS total_amount_of_fines_in_dollars,
       CAST(c_nationkey % 6 AS VARCHAR) AS number_of_payment_denials,
       CAST(c_nationkey % 7 AS VARCHAR) AS total_number_of_penalties,
       CAST(o.o_orderkey AS VARCHAR) AS penalty_id,
       strftime(o.o_orderdate, '%Y-%m-%d') AS penalty_date,
       o.o_orderpriority AS penalty_type,
       DATE '2025-01-31' AS etl_date
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_custkey % 3 <> 0"""

_LEFT_ENRICH = """SELECT c.c_custkey AS custkey, c.c_name, c.c_nationkey, c.c_mktsegment,
       o.o_orderkey, o.o_totalprice, o.o_orderdate
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_custkey % 3 <> 0"""

_MOVE_BASE = """(SELECT page_id, split_part(url, '/', 4) AS lang FROM pages)"""

# Facility facet: the columns given explicitly, then the generic text rule
# ('<first four letters of the name>:' || key) for the others.
_FACILITY_GIVEN = {
    "facility_number": "CAST(c_custkey AS VARCHAR)",
    "facility_name": "c_name",
    "state": "CAST(c_nationkey AS VARCHAR)",
    "ownership_type": "c_mktsegment",
    "number_of_certified_beds": "c_nationkey + 10",
    "average_number_of_residents_per_day": "CAST(c_nationkey AS DOUBLE) + 0.5",
    "date_first_approved_to_provide_medicare_and_medicaid_services":
        "make_date(2000 + c_nationkey, 6, 30)",
    "etl_date": "DATE '2025-01-30'",
}


def _facility_sql(instead: dict[str, str] | None = None) -> str:
    from sluice.plans.presets import FACILITY_COLUMNS
    cols = []
    for name in FACILITY_COLUMNS:
        if name == "row_id":
            continue
        expr = (_FACILITY_GIVEN | (instead or {})).get(name, f"'{name[:4]}:' || CAST(c_custkey AS VARCHAR)")
        cols.append(f"{expr} AS {name}")
    return "SELECT " + ",\n       ".join(cols) + "\nFROM customer"


ORACLE_SQL: dict[str, str] = {
    "csv_scan": """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN k <> 5 THEN s_name END AS s_name,
       CASE WHEN k NOT IN (3, 5) THEN CAST(s_nationkey AS VARCHAR) END AS s_nationkey,
       CASE WHEN k IN (4, 5) THEN 'aka, ' || s_name END AS "Also Known", CAST(NULL AS VARCHAR) AS _corrupt_record
FROM (SELECT *, coalesce(s_suppkey % 6, 0) AS k FROM supplier)""",
    "parquet_scan": "SELECT * FROM region",
    "parquet_overwrite": "SELECT * FROM nation",
    "facet_fanout": """SELECT 'pricing' AS facet, count(*) AS n_rows, 6 AS n_cols FROM lineitem
UNION ALL SELECT 'status', count(*), 5 FROM lineitem
UNION ALL SELECT 'shipping', count(*), 5 FROM lineitem""",
    "discover_domains": "SELECT DISTINCT split_part(url, '/', 3) AS domain FROM pages",
    "discover_domains_files": """SELECT DISTINCT 'lang=' || CASE WHEN split_part(url, '/', 4) = ''
                                   THEN '__HIVE_DEFAULT_PARTITION__'
                                   ELSE split_part(url, '/', 4) END AS domain
FROM pages""",
    "manifest_read": _OLD_MANIFEST,
    "manifest_append": f"WITH {_LISTING}\n{_OLD_MANIFEST}\nUNION ALL\n{_NEW_MANIFEST}",
    "normalize_names": """SELECT p_partkey AS part_key, p_name AS name_full, p_brand AS brand_maker,
       p_type AS type_code, p_size AS size_value, p_retailprice AS retail_price
FROM part""",
    "rename_map": """SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey, s_acctbal
FROM supplier""",
    "trim_strings": """SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_nationkey = 3 THEN '' WHEN c_nationkey = 5 THEN NULL
            WHEN c_nationkey = 7 THEN chr(9) || c_mktsegment ELSE c_mktsegment END AS c_mktsegment
FROM customer""",
    "cast_schema": """SELECT p_partkey,
       CAST(regexp_extract(p_brand, '[0-9]+', 0) AS INTEGER) AS brand_num,
       CAST(NULL AS DOUBLE) AS name_num,
       p_size AS size_text,
       -p_size AS neg_text,
       p_partkey AS key_text,
       CAST(p_size AS DOUBLE) + 0.5 AS size_half,
       make_date(2024, p_size % 12 + 1, 15) AS first_date,
       CAST(NULL AS DATE) AS slash_date,
       p_type
FROM part""",
    "cast_audit": """SELECT CAST(0 AS BIGINT) AS brand_num, count(*) AS name_num,
       CAST(0 AS BIGINT) AS size_text, CAST(0 AS BIGINT) AS neg_text,
       CAST(0 AS BIGINT) AS key_text, CAST(0 AS BIGINT) AS size_half,
       CAST(0 AS BIGINT) AS first_date, count(*) AS slash_date
FROM part""",
    "facility_schema": """SELECT CAST(c_custkey AS VARCHAR) AS facility_number, c_name AS facility_address,
       n_name AS city_town, c_mktsegment AS ownership_type,
       c_nationkey AS number_of_certified_beds,
       CAST(c_nationkey AS DOUBLE) + 0.25 AS average_number_of_residents_per_day,
       'fn ' || CAST(n_regionkey AS VARCHAR) AS average_number_of_residents_per_day_footnote,
       make_date(2000 + c_nationkey, 3, 1)
         AS date_first_approved_to_provide_medicare_and_medicaid_services,
       CASE WHEN c_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS special_focus_status,
       c_custkey AS row_id, DATE '2025-01-31' AS etl_date
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "quality_schema": """SELECT CAST(l_orderkey AS VARCHAR) AS facility_number,
       CAST(l_linenumber AS VARCHAR) AS measure_code, p_name AS measure_description,
       p_type AS resident_type, CAST(l_linenumber AS DOUBLE) + 0.5 AS q1_measure_score,
       l_returnflag AS footnote_for_q1_measure_score, -CAST(p_size AS DOUBLE) AS q2_measure_score,
       l_linestatus AS footnote_for_q2_measure_score, CAST(NULL AS DOUBLE) AS q3_measure_score,
       p_type AS footnote_for_q3_measure_score, CAST(NULL AS DOUBLE) AS q4_measure_score,
       l_returnflag AS footnote_for_q4_measure_score,
       CAST(p_size AS DOUBLE) AS four_quarter_average_score,
       l_linestatus AS footnote_for_four_quarter_average_score,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS used_in_quality_measure_five_star_rating,
       strftime(l_shipdate, '%Y-%m') AS measure_period, p_brand AS location,
       CAST(l_shipdate AS DATE) AS processing_date
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "select_fixed": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "select_keywords": "SELECT l_orderkey, l_extendedprice, l_discount FROM lineitem",
    "drop_if_exists": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders",
    "add_row_id": "SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders",
    "add_row_id_monotonic": """SELECT count(*) AS n_rows, count(*) AS n_ids, CAST(0 AS BIGINT) AS min_position
FROM lineitem""",
    "add_etl_date": "SELECT *, DATE '2025-01-31' AS etl_date FROM region",
    "classify_route": """SELECT page_id, url,
       CASE WHEN contains(k, 'blog') THEN 'raw/blog/' WHEN contains(k, 'example.org') THEN 'raw/org/'
            WHEN contains(k, '/fr/') THEN 'raw/french/' WHEN contains(k, 'm.') THEN 'raw/mobile/'
            ELSE 'raw/other/' END AS target_path
FROM (SELECT page_id, url, lower(replace(replace(url, 'NH_', ''), '_', '')) AS k FROM pages)""",
    "export_name": f"""WITH {_LISTING}
SELECT id, name, mimeType,
       CASE WHEN mimeType = 'application/vnd.google-apps.spreadsheet' THEN name || '.csv'
            ELSE name END AS file_name
FROM listing""",
    "filter_mime": f"""WITH {_LISTING}
SELECT * FROM listing WHERE mimeType IN ('text/csv', 'application/vnd.google-apps.spreadsheet')""",
    "skip_empty": """SELECT d AS domain FROM (VALUES ('click'), ('view'), ('refund')) t(d)
WHERE d IN (SELECT event_type FROM events)""",
    "left_enrich": _LEFT_ENRICH,
    "left_enrich_join": _LEFT_ENRICH,
    "left_enrich_salted": _LEFT_ENRICH,
    "fanout_report": """WITH m AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey % 3 <> 0
           GROUP BY o_custkey)
SELECT count(*) AS left_rows,
       CAST(sum(greatest(coalesce(m.n, 0), 1)) AS BIGINT) AS output_rows,
       max(coalesce(m.n, 0)) AS max_matches,
       count(CASE WHEN coalesce(m.n, 0) > 1 THEN 1 END) AS repeated_left_rows
FROM customer c LEFT JOIN m ON m.o_custkey = c.c_custkey""",
    "pending_files": f"""WITH {_LISTING}
SELECT * FROM listing l
WHERE NOT EXISTS (SELECT 1 FROM labels b WHERE CAST(b.doc_id AS VARCHAR) = l.id)""",
    "route_known": """SELECT event_id, event_type AS domain,
       CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'processed' ELSE 'error' END AS target
FROM events""",
    "required_present": """SELECT d AS domain
FROM (VALUES ('click'), ('signup'), ('refund'), ('view'), ('chargeback')) t(d)
WHERE d NOT IN (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)""",
    "required_present_files": """SELECT 'event_type=' || d AS domain
FROM (VALUES ('click'), ('signup'), ('refund'), ('view'), ('chargeback')) t(d)
WHERE d NOT IN (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)""",
    "count_by_domain": "SELECT event_type AS domain, count(*) AS n_files FROM events GROUP BY event_type",
    "move_plan": """SELECT lang AS domain,
       lang || '/' || CAST(page_id AS VARCHAR) || '.html' AS key,
       's3://landing/raw/' || lang || '/' || CAST(page_id AS VARCHAR) || '.html' AS source,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN 's3://processed/raw/' ELSE 's3://error/raw/' END
         || lang || '/' || CAST(page_id AS VARCHAR) || '.html' AS target,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN 'processed' ELSE 'error' END AS status
FROM (SELECT page_id, split_part(url, '/', 4) AS lang FROM pages)""",
    "move_summary": f"""SELECT CASE WHEN lang IN ('en', 'de', 'fr') THEN 'processed' ELSE 'error' END
         AS status, count(*) AS n_files
FROM {_MOVE_BASE} GROUP BY 1""",
    "provider_facility": _facility_sql(),
    "provider_surveys": """SELECT CAST(c.c_custkey AS VARCHAR) AS facility_number,
       CAST(c_nationkey % 8 AS VARCHAR) AS rating_cycle_1_score,
       CAST(c_nationkey % 10 AS VARCHAR) AS health_deficiency_score,
       CAST(c_nationkey % 11 AS VARCHAR) AS revisit_score_1,
       CAST(c_nationkey * 2 AS VARCHAR) AS total_weighted_health_survey_score,
       CAST(o.o_orderkey AS VARCHAR) AS survey_id,
       strftime(o.o_orderdate, '%Y-%m-%d') AS survey_date,
       DATE '2025-01-31' AS etl_date
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_custkey % 4 <> 0""",
    "provider_fanout": """WITH m AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
f AS (SELECT 'surveys' AS facet, coalesce(m.n, 0) AS n
      FROM customer c LEFT JOIN m ON m.o_custkey % 4 <> 0 AND m.o_custkey = c.c_custkey
      UNION ALL
      SELECT 'penalties' AS facet, coalesce(m.n, 0) AS n
      FROM customer c LEFT JOIN m ON m.o_custkey % 3 <> 0 AND m.o_custkey = c.c_custkey)
SELECT facet, count(*) AS left_rows, CAST(sum(greatest(n, 1)) AS BIGINT) AS output_rows,
       max(n) AS max_matches, count(CASE WHEN n > 1 THEN 1 END) AS repeated_left_rows
FROM f GROUP BY facet""",
    "quality_transform_typed": """SELECT CAST(l_orderkey AS VARCHAR) AS facility_number,
       CAST(l_linenumber AS VARCHAR) AS measure_code, p_name AS measure_description,
       p_type AS resident_type, CAST(l_linenumber AS DOUBLE) + 0.5 AS q1_measure_score,
       l_returnflag AS footnote_for_q1_measure_score, -CAST(p_size AS DOUBLE) AS q2_measure_score,
       l_linestatus AS footnote_for_q2_measure_score, CAST(NULL AS DOUBLE) AS q3_measure_score,
       p_type AS footnote_for_q3_measure_score, CAST(NULL AS DOUBLE) AS q4_measure_score,
       l_returnflag AS footnote_for_q4_measure_score,
       CAST(p_size AS DOUBLE) AS four_quarter_average_score,
       l_linestatus AS footnote_for_four_quarter_average_score,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS used_in_quality_measure_five_star_rating,
       strftime(l_shipdate, '%Y-%m') AS measure_period, p_brand AS location,
       CAST(l_shipdate AS DATE) AS processing_date,
       p_name AS facility_name, 'addr ' || CAST(l_linenumber AS VARCHAR) AS provider_address,
       DATE '2025-01-31' AS etl_date
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "quarantine": """SELECT 'orders' AS domain, 'ok' AS status, CAST(NULL AS VARCHAR) AS reason,
       (SELECT count(*) FROM orders) AS rows
UNION ALL SELECT 'part', 'quarantined', 'KeyError', (SELECT count(*) FROM part)
UNION ALL SELECT 'refunds', 'skipped', 'empty', CAST(0 AS BIGINT)""",
    "clean_domain": _CUSTOMER_CLEAN.format(extra=", CAST(NULL AS VARCHAR) AS _corrupt_record"),
    "incremental_clean": _CUSTOMER_CLEAN.format(extra=""),
    "clean_documents": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, trim(lang, ' ') AS lang,
       trim(source, ' ') AS source, trim(text, ' ') AS text,
       CAST(NULL AS VARCHAR) AS _corrupt_record, DATE '2025-01-31' AS etl_date
FROM documents""",
    "penalties_slice": _PENALTIES,
    "provider_transform": _PENALTIES,
    "provider_facets": """SELECT 'facility' AS facet, count(*) AS n_rows, 24 AS n_cols FROM customer
UNION ALL SELECT 'staffing', count(*), 9 FROM customer
UNION ALL SELECT 'rating', count(*), 9 FROM customer
UNION ALL SELECT 'surveys', count(*), 9
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_custkey % 4 <> 0
UNION ALL SELECT 'penalties', count(*), 13
  FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey AND o.o_custkey % 3 <> 0""",
    "quality_transform": """SELECT CAST(l_orderkey AS VARCHAR) AS facility_number,
       CAST(l_linenumber AS VARCHAR) AS measure_code, p_name AS measure_description,
       p_type AS resident_type, CAST(l_linenumber AS VARCHAR) || '.5' AS q1_measure_score,
       l_returnflag AS footnote_for_q1_measure_score, '-' || CAST(p_size AS VARCHAR) AS q2_measure_score,
       l_linestatus AS footnote_for_q2_measure_score, p_brand AS q3_measure_score,
       p_type AS footnote_for_q3_measure_score, CAST(l_linenumber AS VARCHAR) || 'x' AS q4_measure_score,
       l_returnflag AS footnote_for_q4_measure_score,
       CAST(p_size AS VARCHAR) || '.0' AS four_quarter_average_score,
       l_linestatus AS footnote_for_four_quarter_average_score,
       CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS used_in_quality_measure_five_star_rating,
       strftime(l_shipdate, '%Y-%m') AS measure_period, p_brand AS location,
       strftime(l_shipdate, '%Y-%m-%d') AS processing_date, DATE '2025-01-31' AS etl_date
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "ingest_plan": f"WITH {_LISTING}\n{_NEW_MANIFEST}",
    "publish_on_failure": "SELECT c_custkey, c_name, 'failed' AS last_load FROM customer",
    "run_status": """SELECT 'clean' AS stage, 'customers' AS domain, 'ok' AS status, CAST(NULL AS VARCHAR) AS reason, count(*) AS rows FROM customer
UNION ALL SELECT 'clean', 'nations', 'quarantined', 'NameCollisionError', count(*) FROM nation""",
    "facets_as_set": """SELECT facet, 1 AS load, (SELECT count(*) FROM lineitem) AS n_rows, 'refused' AS second_load
FROM (VALUES ('facility'), ('staffing'), ('rating'), ('surveys'), ('penalties')) t(facet)""",
    "lost_values": """SELECT 'qualitymsr_mds' AS domain, 'ok' AS status,
       'lost values: q3_measure_score=' || count(*) || ', q4_measure_score=' || count(*) AS reason, count(*) AS rows
FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "move_apply": """SELECT CASE WHEN split_part(url, '/', 4) IN ('en', 'de', 'fr') THEN 'processed' ELSE 'error' END AS target,
       page_id AS page, url, 0 AS moved_again, 0 AS left_behind FROM pages""",
    "manifest_compact": """SELECT CAST(doc_id AS VARCHAR) AS file_id, CASE WHEN doc_id % 3 = 0 THEN '2025-02-01' ELSE '2025-01-01' END AS modified_time,
       (SELECT count(*) + count(CASE WHEN doc_id % 3 = 0 THEN 1 END) FROM labels) AS records_before, 2 AS parts FROM labels""",
    "clean_bad_lines": """WITH r AS (SELECT count(CASE WHEN c_custkey % 7 = 0 THEN 1 END) || ' malformed lines' AS reason, count(*) AS n_good FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS facility_number, CAST(NULL AS VARCHAR) AS line, r.reason, r.n_good FROM customer, r
UNION ALL SELECT CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || CAST(c_nationkey AS VARCHAR) || ',' || c_mktsegment || ',one too many',
       r.reason, r.n_good FROM customer, r WHERE c_custkey % 7 = 0""",
    "incremental_rejects": """SELECT CAST(c_custkey AS VARCHAR) || '|' || c_name || '|' || CAST(c_nationkey AS VARCHAR) || '|' || c_mktsegment AS line, 'landed' AS reason FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR) || ',' || c_name || ',' || CAST(c_nationkey AS VARCHAR) || ',' || c_mktsegment || ',one too many', 'malformed line'
FROM customer WHERE c_custkey % 7 = 0
UNION ALL SELECT CAST(n_nationkey AS VARCHAR) || ',' || n_name, 'unknown layout' FROM nation
UNION ALL SELECT 'n_nationkey,n_name', 'unknown layout'""",
    "provider_staffing": """SELECT CAST(c_custkey AS VARCHAR) AS facility_number, CAST(c_nationkey % 4 + 1 AS VARCHAR) AS staffing_rating,
       'sf' || CAST(c_nationkey AS VARCHAR) AS staffing_rating_footnote, CAST(c_nationkey AS VARCHAR) || '.25' AS reported_hours_per_resident,
       CAST(c_nationkey % 9 AS VARCHAR) AS total_turnover, '1.' || CAST(c_nationkey AS VARCHAR) AS case_mix_index,
       CAST(c_nationkey * 3 AS VARCHAR) AS adjusted_total, DATE '2025-01-31' AS etl_date FROM customer""",
    "provider_rating": """SELECT CAST(c_custkey AS VARCHAR) AS facility_number, 'aver:' || CAST(c_custkey AS VARCHAR) AS average_number_of_residents_per_day_footnote,
       CAST(c_nationkey % 5 + 1 AS VARCHAR) AS overall_rating, CAST(c_nationkey % 4 + 1 AS VARCHAR) AS staffing_rating,
       'sf' || CAST(c_nationkey AS VARCHAR) AS staffing_rating_footnote, CAST(c_nationkey % 8 AS VARCHAR) AS rating_cycle_1_score,
       'g' || CAST(c_nationkey AS VARCHAR) AS generating_capacity, DATE '2025-01-31' AS etl_date FROM customer""",
    "provider_untyped": _facility_sql({
        "number_of_certified_beds": "CAST(c_nationkey + 10 AS VARCHAR)",
        "average_number_of_residents_per_day": "CAST(c_nationkey AS VARCHAR) || '.5'",
        "date_first_approved_to_provide_medicare_and_medicaid_services": "strftime(make_date(2000 + c_nationkey, 6, 30), '%Y-%m-%d')"}),
    "ingest_changed": f"""WITH {_LISTING}
SELECT l.id AS file_id, '2025-02-01' AS modified_time FROM listing l
WHERE l.mimeType IN ('text/csv', 'application/vnd.google-apps.spreadsheet')
  AND NOT EXISTS (SELECT 1 FROM labels b WHERE CAST(b.doc_id AS VARCHAR) = l.id AND b.doc_id % 2 = 1)""",
    "manifest_landed_only": f"""WITH {_LISTING}
SELECT l.id AS file_id, CASE WHEN l.mimeType = 'text/csv' THEN l.name ELSE l.name || '.csv' END AS file_name FROM listing l
WHERE l.mimeType IN ('text/csv', 'application/vnd.google-apps.spreadsheet') AND l.id LIKE '%0'
  AND NOT EXISTS (SELECT 1 FROM labels b WHERE CAST(b.doc_id AS VARCHAR) = l.id)""",
}
