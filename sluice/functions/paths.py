"""Expressions over file names and paths (routing, export names, folders)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from urllib.parse import urlparse

from pyspark.sql import Column
from pyspark.sql import functions as F


def route_key_expr(name: Column, remove: Sequence[str] = ()) -> Column:
    """Normalised routing key: delete each token in order, then lower-case
    (the shipped tokens are ``ROUTE_REMOVE_TOKENS`` in the presets)."""
    out = name
    for token in remove:
        out = F.replace(out, F.lit(token), F.lit(""))
    return F.lower(out)


def route_expr(name: Column, routes: Iterable[tuple[str, str]], default: str,
               remove: Sequence[str] = ()) -> Column:
    """Target path of a file name: the first pattern (in the given order,
    lower-cased) contained in the routing key wins, else ``default``."""
    key = route_key_expr(name, remove)
    expr = None
    for pattern, path in routes:
        cond = key.contains(pattern.lower())
        expr = F.when(cond, F.lit(path)) if expr is None else expr.when(cond, F.lit(path))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def export_name_expr(name: Column, mime: Column, export_mimes: Iterable[str],
                     suffix: str = ".csv") -> Column:
    """Name a file gets when landed: exported documents get ``suffix``."""
    return F.when(mime.isin(list(export_mimes)), F.concat(name, F.lit(suffix))).otherwise(name)


def _strip_scheme(path: Column) -> Column:
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def relative_path_expr(path: Column, root: str) -> Column:
    """Path below ``root`` (scheme and authority ignored on both sides);
    null for paths outside it."""
    root_path = (urlparse(root).path if "://" in root or root.startswith("file:") else root)
    root_path = root_path.rstrip("/") + "/"
    bare = _strip_scheme(path)
    return F.when(bare.startswith(root_path), F.substr(bare, F.lit(len(root_path) + 1)))


def first_folder_expr(relative: Column) -> Column:
    """First path element of a relative path, null when the path has none
    (a file directly under the root)."""
    parts = F.split(relative, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, 1))
