"""Cleaning: raw CSV domain -> staging Parquet.

normalize names -> rename map -> trim -> stamps, as one projection over the
CSV scan.  No shuffle: at any scale this is a map-only job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.names import NameCollisionError, plan_normalized_names, plan_renames
from sluice.operators.columns import normalize_names, rename_map, trim_strings
from sluice.operators.inventory import discover_domains
from sluice.operators.stamps import add_etl_date, add_row_id
from sluice.plans import gates
from sluice.plans.presets import RENAME_MAP
from sluice.session import drop_scratch, scratch_path
from sluice.sources.csv import CORRUPT_COLUMN, is_header_mismatch, read_raw
from sluice.sources.files import list_files
from sluice.sources.parquet import read_domain, table_path, write_apart, write_domain
from sluice.sources.versions import state

#: Tables of malformed lines, one per domain, under the error root.
BAD_LINES = "_bad_lines"


def clean_frame(df: DataFrame, renames: Mapping[str, str] = RENAME_MAP,
                as_of: dt.date | str | None = None, on_collision: str = "error",
                row_id: bool = True) -> DataFrame:
    """Header rule, renames, trim of every text column, then the stamps."""
    out = rename_map(normalize_names(df, on_collision), renames, on_collision)
    out = trim_strings(out, [c for c in out.columns if c != CORRUPT_COLUMN])
    if row_id:
        out = add_row_id(out)
    return add_etl_date(out, as_of)


def clean_domain(spark: SparkSession, raw_root: str, staging_root: str, domain: str,
                 error_root: str | None = None, renames: Mapping[str, str] = RENAME_MAP,
                 as_of: dt.date | str | None = None, on_collision: str = "error",
                 align_headers: bool | str = "auto", keep_corrupt: bool = True,
                 csv_options: Mapping[str, str] | None = None,
                 partition_by_date: bool = False) -> gates.Status:
    """Clean one domain folder; an empty folder is skipped (its old staging
    data is left alone), a failure quarantines this domain's raw rows.

    ``align_headers="auto"`` reads optimistically in one pass with Spark's
    per-file header check; only when some file's header differs does it run
    again with files grouped by header and united by cleaned name (the failed
    attempt wrote to its run folder only, so the last good table stays).

    Malformed lines go, with what was parsed of them, to the table
    ``_bad_lines/<domain>`` under ``error_root`` and not to staging, which gets
    the good rows and the domain's own columns; one write splits the two, so
    the folder is parsed once.  The status counts the good rows and says how
    many lines were malformed.  Without ``error_root`` every row stays, with the
    text of malformed lines beside them in ``_corrupt_record``.

    ``partition_by_date`` keeps one partition per load date: re-running a day
    replaces that day only, and readers select a day by partition pruning
    (``read_domain(..., as_of=...)``)."""
    path = table_path(raw_root, domain)

    def rule(names):
        return plan_renames(plan_normalized_names(names, on_collision), renames, on_collision)

    bad_lines, n_bad = f"{BAD_LINES}/{domain}", [0]

    def keep_bad(rows):
        n_bad[0] = rows.count()
        if n_bad[0] or bad_lines in state(spark, error_root)[1]:   # a load without bad lines clears the last one's
            write_domain(rows.withColumnRenamed(CORRUPT_COLUMN, "line"), error_root, bad_lines)

    def publish(out):
        parts = ["etl_date"] if partition_by_date else None
        if error_root is None or CORRUPT_COLUMN not in out.columns:
            return write_domain(out, staging_root, domain, partition_by=parts)
        if parts is None:
            return write_apart(out, CORRUPT_COLUMN, staging_root, domain, keep_bad)
        # partitions are replaced in place: split in a scratch table first
        root = scratch_path(spark, "clean")
        try:
            write_apart(out, CORRUPT_COLUMN, root, domain, keep_bad)
            return write_domain(read_domain(spark, root, domain), staging_root, domain, partition_by=parts)
        finally:
            drop_scratch(spark, root)

    def attempt(mode, reraise=None):
        named = [mode is True]  # whether the columns have their final names as they are read

        def raw():
            try:
                return read_raw(spark, path, mode, keep_corrupt, csv_options, rule if named[0] else None)
            except NameCollisionError:
                # read under the files' own names: building fails on the collision, and
                # the quarantine gets the rows
                named[0] = False
                return read_raw(spark, path, mode, keep_corrupt, csv_options)

        return gates.run_quarantined(
            spark, domain,
            build=lambda df: clean_frame(df, {} if named[0] else renames, as_of, on_collision),
            publish=publish, error_root=error_root, raw=raw, reraise=reraise,
            counted=F.col(CORRUPT_COLUMN).isNull() if keep_corrupt and error_root is not None else None,
            note=lambda: f"{n_bad[0]} malformed lines" if n_bad[0] else None)

    if align_headers != "auto":
        return attempt(align_headers)
    def other_layout(exc):
        # a collision may come from one file's header alone: align, then judge
        return is_header_mismatch(exc) or isinstance(exc, NameCollisionError)

    try:
        return attempt("check", reraise=other_layout)
    except Exception as exc:  # noqa: BLE001 - only header drift comes back here
        if not other_layout(exc):
            raise
        return attempt(True)


def clean_all(spark: SparkSession, raw_root: str, staging_root: str, error_root: str | None = None,
              domains: Iterable[str] | None = None, renames: Mapping[str, str] = RENAME_MAP,
              as_of: dt.date | str | None = None, on_collision: str = "error",
              parallel: int | None = None, strict: bool = False,
              csv_options: Mapping[str, str] | None = None,
              partition_by_date: bool = False) -> DataFrame:
    """Clean every domain folder under ``raw_root`` (or the given ones) as
    concurrent jobs; returns the status table."""
    if domains is None:
        found = discover_domains(list_files(spark, raw_root).where("NOT hidden"))
        domains = sorted(r["domain"] for r in found.collect())  # folder names only
    domains = list(domains)
    workers = parallel or min(8, max(1, len(domains)))  # one job per domain, up to 8 at once
    with ThreadPoolExecutor(max_workers=workers) as pool:
        statuses = list(pool.map(
            lambda d: clean_domain(spark, raw_root, staging_root, d, error_root, renames,
                                   as_of, on_collision, csv_options=csv_options,
                                   partition_by_date=partition_by_date), domains))
    if strict:
        gates.check_strict(statuses)
    return gates.status_frame(spark, statuses)
