"""Column-expression and name-level building blocks (all JVM-side, no UDFs)."""

from sluice.functions.casts import INT_TEXT_PATTERN, safe_cast
from sluice.functions.names import (keyword_columns, normalize_name, plan_normalized_names,
                                    plan_renames)
from sluice.functions.paths import (export_name_expr, first_folder_expr, relative_path_expr,
                                    route_expr, route_key_expr)

__all__ = [
    "INT_TEXT_PATTERN", "safe_cast", "keyword_columns", "normalize_name",
    "plan_normalized_names", "plan_renames", "export_name_expr", "first_folder_expr",
    "relative_path_expr", "route_expr", "route_key_expr",
]
