"""Shipped presets.  Operators take all of these as arguments; these are
only the defaults the reference pipeline runs with.

Fixed values: they must equal the reference's for identical results.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (header renames, in the reference's order) ----
RENAME_MAP = {
    "cms_certification_number_ccn": "facility_number",
    "provider_name": "facility_name",
    "provider_address": "facility_address",
    "provider_type": "facility_type",
    "deficiency_tag_number": "deficiency_tag",
    "scope_severity_code": "severity_level",
}

KEY = "facility_number"

# ---- fixed values (columns dropped from detail tables before a join) ----
DROP_LIST_A = ["facility_name", "facility_address", "city_town", "zip_code"]

# ---- fixed values (facility typed schema).  Two footnote-like columns and
# special_focus_status are text (dates in the reference would null them). ----
FACILITY_SCHEMA = T.StructType([
    T.StructField("facility_number", T.StringType()),
    T.StructField("facility_address", T.StringType()),
    T.StructField("city_town", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("telephone_number", T.StringType()),
    T.StructField("ownership_type", T.StringType()),
    T.StructField("number_of_certified_beds", T.IntegerType()),
    T.StructField("average_number_of_residents_per_day", T.DoubleType()),
    T.StructField("average_number_of_residents_per_day_footnote", T.StringType()),
    T.StructField("facility_type", T.StringType()),
    T.StructField("provider_resides_in_hospital", T.StringType()),
    T.StructField("legal_business_name", T.StringType()),
    T.StructField("date_first_approved_to_provide_medicare_and_medicaid_services", T.DateType()),
    T.StructField("affiliated_entity_name", T.StringType()),
    T.StructField("affiliated_entity_id", T.StringType()),
    T.StructField("continuing_care_retirement_community", T.StringType()),
    T.StructField("special_focus_status", T.StringType()),
    T.StructField("abuse_icon", T.StringType()),
    T.StructField("row_id", T.LongType()),
    T.StructField("etl_date", T.DateType()),
])

# ---- fixed values (facility projection, 24 columns, in order) ----
FACILITY_COLUMNS = [
    "facility_number", "facility_name", "facility_address", "city_town", "state",
    "zip_code", "telephone_number", "provider_ssa_county_code", "county_parish",
    "ownership_type", "number_of_certified_beds", "average_number_of_residents_per_day",
    "average_number_of_residents_per_day_footnote", "facility_type",
    "provider_resides_in_hospital", "legal_business_name",
    "date_first_approved_to_provide_medicare_and_medicaid_services",
    "affiliated_entity_name", "affiliated_entity_id",
    "continuing_care_retirement_community", "special_focus_status", "abuse_icon",
    "row_id", "etl_date",
]

# ---- fixed values (facet keyword lists) ----
STAFFING_KEYWORDS = ["facility_number", "staffing", "hours_per", "turnover", "case_mix",
                     "adjusted"]
RATING_KEYWORDS = ["rating", "footnote", "facility_number"]
SURVEY_KEYWORDS = ["rating_cycle", "health_deficiency", "revisit_score",
                   "total_weighted_health_survey_score", "facility_number"]

# ---- fixed values (penalties facet projection) ----
PENALTY_COLUMNS = [
    "facility_number", "number_of_facility_reported_incidents",
    "number_of_substantiated_complaints",
    "number_of_citations_from_infection_control_inspections", "number_of_fines",
    "total_amount_of_fines_in_dollars", "number_of_payment_denials",
    "total_number_of_penalties",
]

# ---- fixed values (quality typed schema); the average-score footnote is text ----
QUALITY_SCHEMA = T.StructType([
    T.StructField("facility_number", T.StringType()),
    T.StructField("measure_code", T.StringType()),
    T.StructField("measure_description", T.StringType()),
    T.StructField("resident_type", T.StringType()),
    T.StructField("q1_measure_score", T.DoubleType()),
    T.StructField("footnote_for_q1_measure_score", T.StringType()),
    T.StructField("q2_measure_score", T.DoubleType()),
    T.StructField("footnote_for_q2_measure_score", T.StringType()),
    T.StructField("q3_measure_score", T.DoubleType()),
    T.StructField("footnote_for_q3_measure_score", T.StringType()),
    T.StructField("q4_measure_score", T.DoubleType()),
    T.StructField("footnote_for_q4_measure_score", T.StringType()),
    T.StructField("four_quarter_average_score", T.DoubleType()),
    T.StructField("footnote_for_four_quarter_average_score", T.StringType()),
    T.StructField("used_in_quality_measure_five_star_rating", T.StringType()),
    T.StructField("measure_period", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("processing_date", T.DateType()),
    T.StructField("row_id", T.LongType()),
    T.StructField("etl_date", T.DateType()),
])

# ---- fixed values (quality projection, 18 columns, in order) ----
QUALITY_COLUMNS = [
    "facility_number", "measure_code", "measure_description", "resident_type",
    "q1_measure_score", "footnote_for_q1_measure_score",
    "q2_measure_score", "footnote_for_q2_measure_score",
    "q3_measure_score", "footnote_for_q3_measure_score",
    "q4_measure_score", "footnote_for_q4_measure_score",
    "four_quarter_average_score", "footnote_for_four_quarter_average_score",
    "used_in_quality_measure_five_star_rating", "measure_period", "location",
    "processing_date",
]

# ---- fixed values (file routing: ordered pattern -> folder, and default).
# The extra "QualityMsrMDS" entry is ours: it catches names that the
# reference sent to the default folder. ----
ROUTES = [
    ("ProviderInfo", "raw/provider_info/"),
    ("Penalties", "raw/penalties/"),
    ("SurveySummary", "raw/survey_summary/"),
    ("QualityMDS", "raw/qualitymsr_mds/"),
    ("QualityMsrMDS", "raw/qualitymsr_mds/"),
]
DEFAULT_ROUTE = "raw/other/"
ROUTE_REMOVE_TOKENS = ("NH_", "_")

# ---- fixed values (listing mime types; exported ones get ".csv") ----
CSV_MIME = "text/csv"
SPREADSHEET_MIME = "application/vnd.google-apps.spreadsheet"
LISTED_MIMES = [CSV_MIME, SPREADSHEET_MIME]
EXPORT_MIMES = [SPREADSHEET_MIME]

# ---- fixed values (domains the pipeline requires and tracks) ----
REQUIRED_DOMAINS = ["provider_info", "qualitymsr_mds", "survey_summary", "penalties"]

# ---- fixed values (manifest record layout) ----
MANIFEST_SCHEMA = T.StructType([
    T.StructField("file_id", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("s3_key", T.StringType()),
    T.StructField("synced_at", T.StringType()),
])
