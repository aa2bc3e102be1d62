"""Transforms: staging domains -> facet tables.

Provider: one wide table cut into facets (fixed lists and keyword
selections), two of them left-enriched with detail tables.  Quality: a fixed
projection (or a typed copy) of the measure table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.columns import cast_observed, cast_schema, drop_if_exists, select_fixed, select_keywords
from sluice.operators.enrich import fanout_report, left_enrich
from sluice.plans import gates
from sluice.plans.presets import (DROP_LIST_A, FACILITY_COLUMNS, FACILITY_SCHEMA, KEY,
                                  PENALTY_COLUMNS, QUALITY_COLUMNS, QUALITY_SCHEMA,
                                  RATING_KEYWORDS, STAFFING_KEYWORDS, SURVEY_KEYWORDS)
from sluice.sources.csv import CORRUPT_COLUMN
from sluice.sources.parquet import read_domain, stamp, write_domain, write_facets

#: Tables of the provider set, published together.
PROVIDER_FACETS = ("facility", "penalties", "rating", "staffing", "surveys")
STAMP_COLUMNS = ("row_id", "etl_date", CORRUPT_COLUMN)


def provider_facets(provider: DataFrame, survey_summary: DataFrame, penalties: DataFrame,
                    key: str = KEY, drop: Sequence[str] = DROP_LIST_A,
                    facility_columns: Sequence[str] = FACILITY_COLUMNS,
                    schema: T.StructType | None = FACILITY_SCHEMA,
                    staffing_keywords: Iterable[str] = STAFFING_KEYWORDS,
                    rating_keywords: Iterable[str] = RATING_KEYWORDS,
                    survey_keywords: Iterable[str] = SURVEY_KEYWORDS,
                    penalty_columns: Sequence[str] = PENALTY_COLUMNS,
                    strategy: str = "split", lost: dict[str, Callable[[], dict[str, int]]] | None = None,
                    ) -> dict[str, DataFrame]:
    """The five provider facets as lazy frames.

    With ``lost``, the facility facet (which holds the cast columns) counts the
    values that its casts turn to null while it is written; its entry gives
    them afterwards.

    ``facility`` keeps the staging stamps; the others are re-stamped when
    written.  Detail tables lose ``drop`` and their own stamps before the
    join, so the key is the only shared name.
    """
    provider = drop_if_exists(provider, [CORRUPT_COLUMN])
    base = cast_schema(provider, schema) if schema is not None else provider
    detail_drop = list(drop) + list(STAMP_COLUMNS)
    surveys = drop_if_exists(select_keywords(base, survey_keywords), drop)
    facility = base
    if lost is not None and schema is not None:
        facility, lost["facility"] = cast_observed(provider, schema)
    return {
        "facility": select_fixed(facility, facility_columns),
        "staffing": drop_if_exists(select_keywords(base, staffing_keywords), drop),
        "rating": drop_if_exists(select_keywords(base, rating_keywords), drop),
        "surveys": left_enrich(surveys, survey_summary, key, drop=detail_drop, strategy=strategy),
        "penalties": left_enrich(select_fixed(base, penalty_columns), penalties, key,
                                 drop=detail_drop, strategy=strategy),
    }


def provider_fanout(provider: DataFrame, survey_summary: DataFrame, penalties: DataFrame,
                    key: str = KEY) -> DataFrame:
    """Fan-out of the two enrichments (D15): per facet, facet rows, rows the
    left join writes, the most detail rows behind one facility and how many
    facilities are repeated.  Summing provider-level totals over the joined
    rows overcounts exactly where ``repeated_left_rows`` > 0."""
    out = None
    for name, detail in (("surveys", survey_summary), ("penalties", penalties)):
        rep = fanout_report(provider.select(key), detail.select(key), key).select(
            F.lit(name).alias("facet"), "*")
        out = rep if out is None else out.unionByName(rep)
    return out


def provider_transform(spark: SparkSession, staging_root: str, transform_root: str,
                       as_of: dt.date | str | None = None, typed: bool = True,
                       strategy: str = "split", parallel: int | None = None,
                       provider_domain: str = "provider_info",
                       survey_domain: str = "survey_summary",
                       penalty_domain: str = "penalties",
                       staging_as_of: dt.date | str | None = None,
                       statuses: list[gates.Status] | None = None) -> dict[str, str]:
    """Read the three staged domains (only the ``staging_as_of`` load when
    given), write the facets as one set; returns their paths.  ``statuses`` gets
    a row per facet: its rows, and the values that casts lost by column."""
    lost: dict = {}
    counts: dict[str, int] = {}
    facets = provider_facets(
        read_domain(spark, staging_root, provider_domain, staging_as_of),
        read_domain(spark, staging_root, survey_domain, staging_as_of),
        read_domain(spark, staging_root, penalty_domain, staging_as_of),
        schema=FACILITY_SCHEMA if typed else None, strategy=strategy, lost=lost)
    restamp = [name for name in facets if name != "facility"]
    paths = write_facets(facets, transform_root, as_of, stamp_rows=restamp, parallel=parallel, counts=counts)
    if statuses is not None:
        statuses += [gates.Status(n, gates.OK, gates.lost_values(lost[n]()) if n in lost else None, counts[n]) for n in sorted(facets)]
    return paths


def quality_frame(df: DataFrame, typed: bool = False, drop: Sequence[str] = DROP_LIST_A,
                  columns: Sequence[str] = QUALITY_COLUMNS,
                  schema: T.StructType = QUALITY_SCHEMA,
                  as_of: dt.date | str | None = None,
                  lost: dict[str, Callable[[], dict[str, int]]] | None = None) -> DataFrame:
    """Projected variant: drop list, fixed 18 columns, stamps.
    Typed variant: every column kept, schema casts, stamps; with ``lost``, the
    values that the casts lose are counted as the frame is written."""
    df = drop_if_exists(df, [CORRUPT_COLUMN])
    if not typed:
        return stamp(select_fixed(drop_if_exists(df, drop), columns), as_of)
    if lost is None:
        return stamp(cast_schema(df, schema), as_of)
    out, lost["quality"] = cast_observed(df, schema)
    return stamp(out, as_of)


def quality_transform(spark: SparkSession, staging_root: str, transform_root: str,
                      error_root: str | None = None, as_of: dt.date | str | None = None,
                      typed: bool = False, domain: str = "qualitymsr_mds",
                      staging_as_of: dt.date | str | None = None) -> gates.Status:
    """Quality domain with quarantine of its staged rows on failure; the status
    of the typed variant tells the values that casts lost by column."""
    lost: dict = {}
    return gates.run_quarantined(
        spark, domain,
        build=lambda raw: quality_frame(raw, typed, as_of=as_of, lost=lost),
        note=lambda: gates.lost_values(lost["quality"]()) if lost else None,
        publish=lambda out: write_domain(out, transform_root, domain),
        error_root=error_root,
        raw=lambda: read_domain(spark, staging_root, domain, staging_as_of),
        is_empty_skip=False)


def run_transform(spark: SparkSession, domain: str, staging_root: str, transform_root: str,
                  **kwargs):
    """Entry by domain argument: ``provider`` or ``qualitymsr``."""
    if domain == "provider":
        return provider_transform(spark, staging_root, transform_root, **kwargs)
    if domain == "qualitymsr":
        return quality_transform(spark, staging_root, transform_root, **kwargs)
    raise ValueError("domain must be 'provider' or 'qualitymsr'")
