"""Operators over an inventory: a DataFrame with one row per file.

The reference made these decisions in driver loops over object listings;
here they are joins, filters and aggregations over the inventory table, so
they hold for any number of files.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.paths import export_name_expr, route_expr
from sluice.operators.columns import col
from sluice.plans.presets import ROUTE_REMOVE_TOKENS


class MissingRequiredError(RuntimeError):
    """A required domain has no files (or too few rows)."""


def _domain_frame(spark: SparkSession, domains: Iterable[str] | DataFrame,
                  name: str = "domain") -> DataFrame:
    """A domain list as a one-column frame (config lists are small; frames
    pass through)."""
    if isinstance(domains, DataFrame):
        return domains.select(col(domains.columns[0]).alias(name))
    items = [d.strip() for d in domains]
    return spark.createDataFrame([(d,) for d in items],
                                 T.StructType([T.StructField(name, T.StringType())]))


def discover_domains(inventory: DataFrame, domain_col: str = "domain") -> DataFrame:
    """Distinct first-level folders that hold at least one file."""
    return inventory.select(col(domain_col).alias("domain")).where(F.col("domain").isNotNull()).distinct()


def filter_mime(listing: DataFrame, mimes: Sequence[str], mime_col: str = "mimeType",
                folder: str | None = None, parents_col: str = "parents") -> DataFrame:
    """Listing rows whose mime type is one of ``mimes`` and, when ``folder``
    is given, whose parents (an array column, or one parent as text) hold it."""
    cond = col(mime_col).isin(list(mimes))
    if folder is not None:
        field = listing.schema[parents_col]
        inside = (F.array_contains(col(parents_col), folder)
                  if isinstance(field.dataType, T.ArrayType) else col(parents_col) == folder)
        cond = cond & inside
    return listing.where(cond)


def pending_files(listing: DataFrame, manifest: DataFrame, id_col: str = "file_id",
                  manifest_id_col: str = "file_id", modified_col: str | None = None,
                  manifest_modified_col: str | None = None) -> DataFrame:
    """Listed files not yet in the manifest (anti join on the id).

    With ``modified_col`` the key is (id, modified time), so a changed file is
    picked up again; by default only the id counts."""
    left_keys = [id_col] + ([modified_col] if modified_col else [])
    right_keys = [manifest_id_col] + ([manifest_modified_col or modified_col] if modified_col else [])
    # distinct first: a map-side partial aggregate, so an id repeated in the
    # manifest (one record per change) is one row per task before the shuffle
    seen = manifest.select(*[col(r).alias(f"_sl_k{i}") for i, r in enumerate(right_keys)]).distinct()
    cond = None
    for i, k in enumerate(left_keys):
        c = listing[k] == seen[f"_sl_k{i}"]
        cond = c if cond is None else cond & c
    return listing.join(seen, cond, "left_anti")


def with_export_name(listing: DataFrame, name_col: str, mime_col: str,
                     export_mimes: Iterable[str], out: str = "file_name",
                     suffix: str = ".csv") -> DataFrame:
    """Add the landed file name (exported documents get ``suffix``)."""
    return listing.withColumn(out, export_name_expr(col(name_col), col(mime_col), export_mimes,
                                                    suffix))


def with_route(listing: DataFrame, name_col: str, routes: Iterable[tuple[str, str]],
               default: str, out: str = "target_path",
               remove: Sequence[str] = ROUTE_REMOVE_TOKENS) -> DataFrame:
    """Add the target folder chosen by ordered name patterns."""
    return listing.withColumn(out, route_expr(col(name_col), routes, default, remove))


def route_known(inventory: DataFrame, known: Iterable[str] | DataFrame,
                domain_col: str = "domain", processed: str = "processed",
                error: str = "error", out: str = "target",
                failed: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Tracked domains go to ``processed``, all others to ``error``.

    ``failed`` (domains whose cleaning failed) also go to ``error``: routing
    looks at the name and the clean status, not the name alone.
    """
    spark = inventory.sparkSession
    if isinstance(known, DataFrame) or isinstance(failed, DataFrame):
        ok = _domain_frame(spark, known, "_sl_known").distinct()
        if failed is not None:
            ok = ok.join(_domain_frame(spark, failed, "_sl_known"), "_sl_known", "left_anti")
        flagged = inventory.join(ok.withColumn("_sl_ok", F.lit(True)),
                                 inventory[domain_col] == ok["_sl_known"], "left")
        return (flagged.withColumn(out, F.when(F.col("_sl_ok"), F.lit(processed))
                                   .otherwise(F.lit(error)))
                .drop("_sl_known", "_sl_ok"))
    known_list = [k.strip() for k in known]
    cond = col(domain_col).isin(known_list)
    if failed is not None:
        cond = cond & ~col(domain_col).isin(list(failed))
    return inventory.withColumn(out, F.when(cond, F.lit(processed)).otherwise(F.lit(error)))


def count_by_domain(inventory: DataFrame, domain_col: str = "domain",
                    out: str = "n_files") -> DataFrame:
    """Files per domain (map-side partial count, then one row per domain)."""
    return inventory.groupBy(col(domain_col).alias("domain")).agg(F.count(F.lit(1)).alias(out))


def missing_required(required: Iterable[str] | DataFrame, present: DataFrame,
                     domain_col: str = "domain", spark: SparkSession | None = None) -> DataFrame:
    """Required domains that do not occur in ``present`` (a table of file
    or row records with a domain column)."""
    spark = spark or present.sparkSession
    req = _domain_frame(spark, required).distinct()
    have = present.select(col(domain_col).alias("domain")).distinct()
    return req.join(have, "domain", "left_anti")


def require_present(required: Iterable[str] | DataFrame, present: DataFrame,
                    domain_col: str = "domain") -> None:
    """Gate: raise listing every missing required domain."""
    missing = [r["domain"] for r in missing_required(required, present, domain_col)
               .orderBy("domain").collect()]
    if missing:
        raise MissingRequiredError(f"required domains without data: {missing}")


def present_domains(domains: Iterable[str] | DataFrame, records: DataFrame,
                    domain_col: str = "domain") -> DataFrame:
    """Requested domains that have at least one record (empty ones are
    skipped): a semi join against the record table's domains."""
    req = _domain_frame(records.sparkSession, domains).distinct()
    have = records.select(col(domain_col).alias("domain")).distinct()  # hot domains collapse map-side
    return req.join(have, "domain", "left_semi")


def move_plan(inventory: DataFrame, known: Iterable[str] | DataFrame, source_root: str,
              processed_root: str, error_root: str, key_col: str = "rel_path",
              domain_col: str = "domain", failed: Iterable[str] | DataFrame | None = None,
              ) -> DataFrame:
    """(domain, key, source, target) for every file under a domain folder.

    This is the dry-run report; :func:`sluice.plans.moves.apply_moves` carries it
    out."""
    routed = route_known(inventory.where(col(domain_col).isNotNull()), known, domain_col,
                         processed="processed", error="error", out="_sl_dest", failed=failed)
    root = F.when(F.col("_sl_dest") == "processed", F.lit(processed_root.rstrip("/")))\
        .otherwise(F.lit(error_root.rstrip("/")))
    return routed.select(
        col(domain_col).alias("domain"),
        col(key_col).alias("key"),
        F.concat(F.lit(source_root.rstrip("/") + "/"), col(key_col)).alias("source"),
        F.concat(root, F.lit("/"), col(key_col)).alias("target"),
        F.col("_sl_dest").alias("status"))
