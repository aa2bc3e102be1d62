"""The landing manifest: one record per landed file, as a compacted log.

A folder of JSON lines: each run appends a folder of its own, ``run-<id>/``,
which a repeated run replaces, so no record is appended twice.
:func:`compact_manifest` writes the latest record of each file as a snapshot and
then removes the runs that are in it; a record that stands in both for a while
is one to :func:`latest_records`.  A legacy single JSON array file is read with
``legacy_array=True``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.columns import col
from sluice.plans.presets import MANIFEST_SCHEMA
from sluice.session import file_system, remove_path
from sluice.sources.versions import publish, resolve, state

#: The compacted records, a versioned table inside the manifest's folder.
SNAPSHOT = "snapshot"

#: Optional fifth field of a record.
MODIFIED_FIELD = T.StructField("modified_time", T.StringType())

# Fixed value: manifest stamps are UTC ISO-8601 text with microseconds and 'Z'.
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def read_manifest(spark: SparkSession, path: str, legacy_array: bool = False,
                  modified: bool = False) -> DataFrame:
    """Manifest records; an absent manifest is empty.  ``modified`` adds the
    listed modified time (null in records that were written without it)."""
    schema = T.StructType(MANIFEST_SCHEMA.fields + ([MODIFIED_FIELD] if modified else []))
    parts = [path] if legacy_array else [part for part, _ in _parts(spark, path)]
    try:
        if parts:
            return spark.read.schema(schema).json(parts, multiLine=legacy_array)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], schema)


def _parts(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(folder or file, whether a snapshot replaces it) that hold the records:
    the snapshot, and as many runs as there were since it was taken."""
    path = path.rstrip("/")
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return []
    if fs.getFileStatus(where).isFile():
        return [(path, False)]
    inside = [s for s in fs.listStatus(where) if not s.getPath().getName().startswith(("_", "."))]
    out = [(f"{path}/{s.getPath().getName()}", True) for s in inside if s.isFile() or s.getPath().getName().startswith("run-")]
    return out + ([(resolve(spark, path, SNAPSHOT), False)] if SNAPSHOT in state(spark, path)[1] else [])


def latest_records(manifest: DataFrame) -> DataFrame:
    """One record per file id: that with the latest modified time (if the manifest
    was read with it), then the latest stamp; one row per id and task is shuffled."""
    order = [c for c in (MODIFIED_FIELD.name, "synced_at", "s3_key", "file_name") if c in manifest.columns]
    best = manifest.groupBy("file_id").agg(F.max_by(F.struct(*manifest.columns), F.struct(*order)).alias("_sl_r"))
    return best.select("_sl_r.*")


def compact_manifest(spark: SparkSession, path: str) -> int:
    """Replace the log by a snapshot of the latest records; returns how many
    parts it took in.  Parts go only after the snapshot is committed, and
    those appended meanwhile stay."""
    path = path.rstrip("/")
    parts = _parts(spark, path)
    taken = [part for part, replaced in parts if replaced]
    if not taken:
        return 0
    schema = T.StructType([*MANIFEST_SCHEMA.fields, MODIFIED_FIELD])
    records = latest_records(spark.read.schema(schema).json([part for part, _ in parts]))
    publish(spark, path, {SNAPSHOT: lambda folder: records.write.json(folder)})
    for part in taken:
        remove_path(spark, part)
    return len(taken)


def iso_stamp(at: dt.datetime | str | None = None) -> Column:
    """UTC ISO-8601 text with a trailing 'Z' (session zone must be UTC)."""
    ts = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return F.date_format(ts, ISO_UTC_FORMAT)


def manifest_entries(files: DataFrame, id_col: str, name_col: str, path_col: str,
                     synced_at: Column, modified_col: str | None = None) -> DataFrame:
    """Manifest records for landed files: key = target folder + name; with
    ``modified_col`` also the listed modified time, for change detection."""
    changed = [col(modified_col).cast("string").alias(MODIFIED_FIELD.name)] if modified_col else []
    return files.select(
        col(id_col).cast("string").alias("file_id"),
        col(name_col).alias("file_name"),
        F.concat(col(path_col), col(name_col)).alias("s3_key"),
        synced_at.alias("synced_at"), *changed)


def append_manifest(existing: DataFrame, new_entries: DataFrame) -> DataFrame:
    """The manifest after a run: existing records then the new ones."""
    names = [*MANIFEST_SCHEMA.fieldNames(), *([MODIFIED_FIELD.name] if MODIFIED_FIELD.name in existing.columns else [])]
    return existing.unionByName(new_entries.select(*[c for c in new_entries.columns if c in names]), allowMissingColumns=True)


def write_manifest_entries(new_entries: DataFrame, path: str, run_id: str | None = None) -> None:
    """Persist only the new records, as the part of one run; the same run
    again replaces its part."""
    new_entries.write.mode("overwrite").json(f"{path.rstrip('/')}/run-{run_id or uuid.uuid4().hex}")
