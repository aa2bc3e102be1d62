"""Run status, quarantine and gates.

Every domain run yields one status row; failures do not stop the other
domains, and ``strict`` raises once all have run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sources.parquet import read_domain, write_domain

STATUS_SCHEMA = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("rows", T.LongType()),
])

OK, SKIPPED, QUARANTINED, FAILED = "ok", "skipped", "quarantined", "failed"


class DomainFailedError(RuntimeError):
    """Raised by strict runs after all domains were tried."""


@dataclass
class Status:
    domain: str
    status: str
    reason: str | None = None
    rows: int | None = None

    def as_tuple(self):
        return (self.domain, self.status, self.reason, self.rows)


def lost_values(lost: Mapping[str, int]) -> str | None:
    """What casts turned to null, as the reason of a status."""
    return "lost values: " + ", ".join(f"{c}={n}" for c, n in sorted(lost.items())) if lost else None


def error_class(exc: BaseException) -> str:
    """Short, stable reason: Spark's error class when there is one."""
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    try:
        name = cond() if cond else None
    except Exception:
        name = None
    return name or type(exc).__name__


def publish_counted(df: DataFrame, publish: Callable[[DataFrame], str],
                    counted: Column | None = None) -> tuple[str, int]:
    """Publish ``df`` and count its rows (those for which ``counted`` holds) in
    the same job: an observed metric of the write, merged once per finished
    partition."""
    obs = Observation(f"sluice-rows-{uuid.uuid4().hex}")
    which = F.lit(1) if counted is None else F.when(counted, 1)
    path = publish(df.observe(obs, F.count(which).alias("rows")))
    return path, int(obs.get["rows"])


def run_quarantined(spark: SparkSession, domain: str,
                    build: Callable[[DataFrame], DataFrame],
                    publish: Callable[[DataFrame], str], error_root: str | None,
                    raw: Callable[[], DataFrame], is_empty_skip: bool = True,
                    reraise: Callable[[BaseException], bool] | None = None,
                    counted: Column | None = None,
                    note: Callable[[], str | None] = lambda: None) -> Status:
    """Read this domain (``raw``), transform it (``build``) and publish it.
    Failures for which ``reraise`` is true propagate instead (for retries).
    ``counted`` says which published rows the status counts, ``note`` what it
    tells of a success.

    On failure *this domain's* raw frame goes to ``error_root`` and the status
    says why.  The try encloses the write, where lazy errors (bad casts, bad
    files) surface.  ``isEmpty`` stops at the first row and stays in the JVM.
    """
    raw_df = None
    try:
        raw_df = raw()
        if is_empty_skip and raw_df.isEmpty():
            return Status(domain, SKIPPED, "empty", 0)
        _, rows = publish_counted(build(raw_df), publish, counted)
        return Status(domain, OK, note(), rows)
    except Exception as exc:  # noqa: BLE001 - every failure becomes a status row
        if reraise is not None and reraise(exc):
            raise
        reason = error_class(exc)
        if raw_df is None or error_root is None:
            return Status(domain, FAILED, reason, None)
        try:
            _, rows = publish_counted(raw_df, lambda df: write_domain(df, error_root, domain))
            return Status(domain, QUARANTINED, reason, rows)
        except Exception as nested:  # noqa: BLE001
            return Status(domain, FAILED, f"{reason}; {error_class(nested)}", None)


def status_frame(spark: SparkSession, statuses: Iterable[Status]) -> DataFrame:
    """Status table (one row per domain; bounded by the domain count)."""
    return spark.createDataFrame([s.as_tuple() for s in statuses], STATUS_SCHEMA)


def stage_frame(spark: SparkSession, stages: Mapping[str, Iterable[Status]]) -> DataFrame:
    """Status table of a whole run: one row per stage and table."""
    rows = [(stage, *s.as_tuple()) for stage, statuses in stages.items() for s in statuses]
    return spark.createDataFrame(rows, T.StructType([T.StructField("stage", T.StringType()), *STATUS_SCHEMA.fields]))


def failed_domains(status: DataFrame) -> DataFrame:
    return status.where(F.col("status").isin(QUARANTINED, FAILED)).select("domain")


def any_failed(status: DataFrame) -> bool:
    return not failed_domains(status).isEmpty()


def check_strict(statuses: Iterable[Status]) -> None:
    bad = [s for s in statuses if s.status in (QUARANTINED, FAILED)]
    if bad:
        raise DomainFailedError("; ".join(f"{s.domain}: {s.status} ({s.reason})" for s in bad))


def stale_domains(spark: SparkSession, root: str, domains: Iterable[str], as_of: str,
                  date_col: str = "etl_date") -> list[str]:
    """Domains under ``root`` with no row stamped ``as_of`` (or no table).

    The date filter reaches the Parquet scan, whose min/max statistics skip
    row groups of older loads; ``limit(1)`` stops at the first hit.  The loop
    runs over the configured domain names only.
    """
    stale = []
    for domain in domains:
        try:
            df = read_domain(spark, root, domain)
            fresh = not df.where(F.col(date_col) == F.lit(as_of).cast("date")).limit(1).isEmpty()
        except AnalysisException as exc:  # a missing or empty table is stale
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            fresh = False
        if not fresh:
            stale.append(domain)
    return stale
