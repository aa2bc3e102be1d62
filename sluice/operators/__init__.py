"""DataFrame operators: columns, stamps, enrichment, inventories."""

from sluice.operators.columns import (cast_audit, cast_schema, drop_if_exists, normalize_names,
                                      rename_map, select_fixed, select_keywords, trim_strings)
from sluice.operators.enrich import fanout_report, left_enrich
from sluice.operators.inventory import (count_by_domain, discover_domains, filter_mime,
                                        missing_required, move_plan, pending_files,
                                        present_domains, require_present, route_known,
                                        with_export_name, with_route)
from sluice.operators.stamps import add_dense_id, add_etl_date, add_row_id

__all__ = [
    "cast_audit", "cast_schema", "drop_if_exists", "normalize_names", "rename_map",
    "select_fixed", "select_keywords", "trim_strings", "fanout_report", "left_enrich",
    "count_by_domain", "discover_domains", "filter_mime", "missing_required", "move_plan",
    "pending_files", "present_domains", "require_present", "route_known", "with_export_name",
    "with_route", "add_dense_id", "add_etl_date", "add_row_id",
]
