"""Ingest plan: which listed files to land, under which name and folder.

listing -> mime filter -> not in manifest -> export name -> route ->
manifest records.  Pure DataFrame work; the transfer itself is outside Spark.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from sluice.operators.inventory import filter_mime, pending_files, with_export_name, with_route
from sluice.plans.presets import (DEFAULT_ROUTE, EXPORT_MIMES, LISTED_MIMES, ROUTE_REMOVE_TOKENS,
                                  ROUTES)
from sluice.sources.manifest import MODIFIED_FIELD, append_manifest, iso_stamp, manifest_entries


def ingest_plan(listing: DataFrame, manifest: DataFrame,
                routes: Iterable[tuple[str, str]] = ROUTES, default: str = DEFAULT_ROUTE,
                listed_mimes: Sequence[str] = LISTED_MIMES,
                export_mimes: Sequence[str] = EXPORT_MIMES,
                synced_at: dt.datetime | str | None = None, id_col: str = "id",
                name_col: str = "name", mime_col: str = "mimeType",
                modified_col: str | None = None, folder: str | None = None,
                parents_col: str = "parents") -> DataFrame:
    """New manifest records for files to land (the dry-run report).

    ``modified_col`` turns on change detection: the manifest must have been
    read with ``modified=True`` and a file whose listed time differs from
    every record of it is new again."""
    files = filter_mime(listing, listed_mimes, mime_col, folder, parents_col)
    new = pending_files(files, manifest, id_col, "file_id", modified_col, MODIFIED_FIELD.name)
    new = with_export_name(new, name_col, mime_col, export_mimes, out="_sl_name")
    new = with_route(new, "_sl_name", list(routes), default, out="_sl_target",
                     remove=ROUTE_REMOVE_TOKENS)
    return manifest_entries(new, id_col, "_sl_name", "_sl_target", iso_stamp(synced_at), modified_col)


def next_manifest(listing: DataFrame, manifest: DataFrame, **kwargs) -> DataFrame:
    """The whole manifest after the run: old records plus the new ones."""
    return append_manifest(manifest, ingest_plan(listing, manifest, **kwargs))
