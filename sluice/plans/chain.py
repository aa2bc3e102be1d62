"""One run of the whole chain, in the reference's stage order:

ingest plan (when a listing is given: new files, names, folders, manifest
records) -> clean every raw domain -> plan the moves of raw files
(processed / error, by name *and* clean status) -> gate on required staged
domains -> provider and quality transforms.  State passes between stages only
through the storage roots, the manifest and the status table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.paths import relative_path_expr
from sluice.operators.inventory import (count_by_domain, discover_domains, move_plan,
                                        require_present)
from sluice.plans import gates
from sluice.plans.clean import clean_all
from sluice.plans.ingest import ingest_plan
from sluice.plans.moves import apply_moves
from sluice.plans.presets import (DEFAULT_ROUTE, EXPORT_MIMES, LISTED_MIMES, RENAME_MAP,
                                  REQUIRED_DOMAINS, ROUTES)
from sluice.plans.transform import PROVIDER_FACETS, provider_fanout, provider_transform, quality_transform
from sluice.session import scratch_path
from sluice.sources.files import list_files
from sluice.sources.manifest import MODIFIED_FIELD, latest_records, read_manifest, write_manifest_entries
from sluice.sources.parquet import read_domain
from sluice.sources.versions import recover, state


@dataclass
class RunConfig:
    raw_root: str
    staging_root: str
    transform_root: str
    error_root: str
    processed_root: str
    as_of: dt.date | str | None = None
    required: list[str] = field(default_factory=lambda: list(REQUIRED_DOMAINS))
    tracked: list[str] = field(default_factory=lambda: list(REQUIRED_DOMAINS))
    renames: dict = field(default_factory=lambda: dict(RENAME_MAP))
    min_rows: int = 0
    require_fresh: bool = False
    listing: DataFrame | None = None      # id, name, mimeType[, modifiedTime]
    manifest_path: str | None = None
    routes: list[tuple[str, str]] = field(default_factory=lambda: list(ROUTES))
    default_route: str = DEFAULT_ROUTE
    folder: str | None = None             # only listed files whose parents hold it
    listed_mimes: list[str] = field(default_factory=lambda: list(LISTED_MIMES))
    export_mimes: list[str] = field(default_factory=lambda: list(EXPORT_MIMES))
    detect_changes: bool = False          # a changed modifiedTime makes a file new (D20)
    landing_root: str | None = None       # what manifest keys are relative to (default: the parent of raw_root)
    dry_run: bool = False                 # plan only: nothing is written
    apply_moves: bool = False             # move the raw files after they were cleaned, not only plan it
    moves_log: str | None = None          # where the log of moves goes (default: _moves under processed_root)
    partition_by_date: bool = False       # staging keeps one partition per load date
    strict: bool = False
    parallel: int | None = None           # concurrent domain jobs (default: one per domain, ≤ 8)


@dataclass
class RunResult:
    clean_status: DataFrame
    moves: DataFrame
    transforms: dict
    stages: DataFrame                      # one status row per stage and table
    ingest: DataFrame | None = None
    file_counts: DataFrame | None = None   # raw files per domain at the start of the run
    fanout: DataFrame | None = None        # D15 report of the provider enrichments (lazy)


def staged_inventory(spark: SparkSession, staging_root: str, min_rows: int = 0,
                     counted: Mapping[str, int] | None = None) -> DataFrame:
    """Staged files by domain, ignoring '_'/'.' names (markers, checksums).

    With ``min_rows``, only domains with that many rows: as ``counted`` by the
    writes of this run, else by one job over the tables' Parquet footers each,
    all at once."""
    inv = list_files(spark, staging_root).where("NOT hidden AND domain IS NOT NULL AND NOT startswith(domain, '_')")
    # of versioned tables only the committed files count; the list is as long as there are tables
    current = [f"{name}/{v[0].split('/')[0]}" for name, v in state(spark, staging_root)[1].items()]
    folder = F.element_at(F.split("rel_path", "/"), 2)
    inv = inv.where(F.concat("domain", F.lit("/"), folder).isin(current) | ~folder.rlike("^v-[0-9a-f]{32}$"))
    if min_rows <= 0:
        return inv
    counted = dict(counted or {})
    names = [r["domain"] for r in inv.select("domain").distinct().collect()]  # one row per folder

    def rows(name: str) -> int:
        if name not in counted:
            counted[name] = read_domain(spark, staging_root, name).count()
        return counted[name]

    with ThreadPoolExecutor(max_workers=min(8, max(1, len(names)))) as pool:
        enough = [n for n, c in zip(names, pool.map(rows, names), strict=True) if c >= min_rows]
    return inv.where(F.col("domain").isin(enough))


def plan_ingest(spark: SparkSession, cfg: RunConfig) -> DataFrame | None:
    """New manifest records for the listing: the files to land."""
    if cfg.listing is None:
        return None
    if cfg.manifest_path is None:
        raise ValueError("a listing needs manifest_path")
    manifest = latest_records(read_manifest(spark, cfg.manifest_path, modified=cfg.detect_changes))
    return ingest_plan(cfg.listing, manifest, cfg.routes, cfg.default_route, cfg.listed_mimes, cfg.export_mimes,
                       modified_col="modifiedTime" if cfg.detect_changes else None, folder=cfg.folder)


def landed(plan: DataFrame, raw_files: DataFrame, landing_root: str) -> DataFrame:
    """Planned records whose file is among the raw files: only those may be
    recorded, so a transfer that failed is planned again by the next run.

    A record with a modified time (change detection) needs a raw file that was
    written at or after it; the file of an earlier load under the same key
    does not count.  A modified time that is no timestamp counts by key alone."""
    key = relative_path_expr(F.col("path"), landing_root).alias("s3_key")
    if MODIFIED_FIELD.name not in plan.columns or "modification_time" not in raw_files.columns:
        return plan.join(raw_files.select(key).distinct(), "s3_key", "left_semi").select(*plan.columns)
    there = raw_files.groupBy(key).agg(F.max("modification_time").alias("_sl_written"))
    listed = F.try_to_timestamp(F.col(MODIFIED_FIELD.name))
    found = plan.join(there, "s3_key").where(listed.isNull() | (F.col("_sl_written") >= listed))
    return found.select(*plan.columns)


def run(spark: SparkSession, cfg: RunConfig) -> RunResult:
    # one load date for every table of the run, also across midnight
    as_of = cfg.as_of if cfg.as_of is not None else spark.range(1).select(F.current_date()).first()[0]
    ingest = plan_ingest(spark, cfg)
    if not cfg.dry_run:
        for root in (cfg.staging_root, cfg.transform_root, cfg.error_root):
            recover(spark, root)   # what runs left behind that died before their commit
    if cfg.dry_run:
        raw_files = list_files(spark, cfg.raw_root).where("NOT hidden")
        moves = move_plan(raw_files, cfg.tracked, cfg.raw_root, cfg.processed_root, cfg.error_root)
        return RunResult(gates.status_frame(spark, []), moves, {}, gates.stage_frame(spark, {}), ingest, count_by_domain(raw_files))
    # one listing of the raw root serves domain discovery and the move plan;
    # written once (one row per file) so the plan refers to the files that
    # were there when the run started, and nothing stays cached
    listing_path = scratch_path(spark, "raw-inventory")
    list_files(spark, cfg.raw_root).where("NOT hidden").write.parquet(listing_path)
    raw_files = spark.read.parquet(listing_path)
    if ingest is not None:
        staged = scratch_path(spark, "ingest-plan")
        ingest.write.mode("overwrite").parquet(staged)
        ingest = spark.read.parquet(staged)
        root = cfg.landing_root or cfg.raw_root.rstrip("/").rsplit("/", 1)[0]
        write_manifest_entries(landed(ingest, raw_files, root), cfg.manifest_path)
    domains = sorted(r["domain"] for r in discover_domains(raw_files).collect())
    status = clean_all(spark, cfg.raw_root, cfg.staging_root, cfg.error_root, domains=domains,
                       renames=cfg.renames, as_of=as_of, parallel=cfg.parallel,
                       partition_by_date=cfg.partition_by_date)
    cleaned = [gates.Status(*r) for r in status.collect()]  # one row per domain
    failed = gates.failed_domains(status)
    moves = move_plan(raw_files, cfg.tracked, cfg.raw_root, cfg.processed_root, cfg.error_root,
                      failed=failed)
    if cfg.apply_moves:
        moves = apply_moves(spark, moves, cfg.moves_log or f"{cfg.processed_root.rstrip('/')}/_moves")
    counted = {} if cfg.partition_by_date else {s.domain: s.rows for s in cleaned if s.status == gates.OK}
    require_present(cfg.required, staged_inventory(spark, cfg.staging_root, cfg.min_rows, counted))
    if cfg.require_fresh:
        stale = gates.stale_domains(spark, cfg.staging_root, cfg.required, str(as_of))
        if stale:
            raise gates.DomainFailedError(f"staged domains not loaded on {as_of}: {stale}")
    # the two transforms are independent: run them as concurrent jobs
    day = as_of if cfg.partition_by_date else None

    def provider() -> tuple[dict, list[gates.Status]]:
        statuses: list[gates.Status] = []
        try:
            return provider_transform(spark, cfg.staging_root, cfg.transform_root, as_of, staging_as_of=day, statuses=statuses), statuses
        except Exception as exc:  # noqa: BLE001 - the set is published whole or not at all
            return {}, [gates.Status(name, gates.FAILED, gates.error_class(exc)) for name in PROVIDER_FACETS]

    with ThreadPoolExecutor(max_workers=2) as pool:
        facets = pool.submit(provider)
        quality = pool.submit(quality_transform, spark, cfg.staging_root, cfg.transform_root,
                              cfg.error_root, as_of, staging_as_of=day)
        paths, facet_status = facets.result()
        transforms = {"provider": paths, "quality": quality.result()}
    stages = {"clean": cleaned, "provider": facet_status, "quality": [transforms["quality"]]}
    if cfg.strict:
        gates.check_strict([s for statuses in stages.values() for s in statuses])
    staged = {d: read_domain(spark, cfg.staging_root, d, day)
              for d in ("provider_info", "survey_summary", "penalties")}
    try:
        fanout = provider_fanout(staged["provider_info"], staged["survey_summary"], staged["penalties"])
    except AnalysisException:        # a staged table without the key: the facets' status tells it
        fanout = None
    return RunResult(status, moves, transforms, gates.stage_frame(spark, stages), ingest, count_by_domain(raw_files), fanout)
