"""Incremental pickup of new raw files as a Structured Streaming job.

The stream is over files, not lines: its checkpoint plays the manifest, so
each path is picked up once (a changed file under a known path is not read
again, as in the manifest rule).  A micro-batch reads its files once, each by its own
header: columns are found by name in any order, malformed lines and files with
other columns go to a dead-letter table, and everything else lands.  One odd
file therefore stops neither the files beside it nor later ones.
``availableNow`` processes what is there and stops, which suits a schedule.

A batch is written under its own partition, which a repeated batch replaces.
Row ids are left out: ``monotonically_increasing_id`` restarts per
micro-batch, so it would not be unique across the stream.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.names import normalize_name, plan_normalized_names, plan_renames
from sluice.operators.columns import trim_strings
from sluice.operators.stamps import add_etl_date
from sluice.plans.presets import RENAME_MAP
from sluice.session import drop_scratch, scratch_path
from sluice.sources.csv import CORRUPT_COLUMN, read_matching
from sluice.sources.parquet import LINE_COLUMN

#: Partition column of what a batch wrote: the stream's id and the batch's number.
BATCH = "batch"
#: Files of a micro-batch; their names go through the driver.
FILES_PER_BATCH = 1000
MALFORMED, UNKNOWN = "malformed line", "unknown layout"


def file_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """Stream of the files of a folder: path, modificationTime, length; contents are not read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    return (spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .load(path).select("path", "modificationTime", "length"))


def _write(df: DataFrame, path: str, batch: str, by: list[str]) -> None:
    (df.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by, BATCH).parquet(path))


def batch_writer(header_names: list[str], out_path: str, rejected_path: str, renames: Mapping[str, str],
                 as_of: dt.date | str | None, partition_by_date: bool,
                 options: Mapping[str, str] | None) -> Callable[[DataFrame, int], None]:
    """What a micro-batch of files does."""
    expected = plan_renames(plan_normalized_names(header_names), renames)

    def rule(name: str) -> str:
        return plan_renames([normalize_name(name)], renames)[0]

    def write(files: DataFrame, number: int) -> None:
        spark = files.sparkSession
        paths = [r["path"] for r in files.select("path").collect()]   # FILES_PER_BATCH at most
        if not paths:
            return
        batch = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{number}"
        rows, other = read_matching(spark, paths, expected, rule, options)
        reason = lambda text: F.lit(text).alias("reason")
        lost = [r["file"] for r in other.collect()]
        rejected, staged = [], scratch_path(spark, "pickup")
        if lost:
            lines = spark.read.text([_plain(f) for f in lost])
            rejected.append(lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), reason(UNKNOWN)))
        if rows is not None:                       # parsed once, then split
            rows.withColumnRenamed(CORRUPT_COLUMN, LINE_COLUMN).write.parquet(staged)
            rows = spark.read.parquet(staged).withColumnRenamed(LINE_COLUMN, CORRUPT_COLUMN)
            good = trim_strings(rows.where(F.col(CORRUPT_COLUMN).isNull()).select(*expected))
            _write(add_etl_date(good, as_of), out_path, batch, ["etl_date"] if partition_by_date else [])
            rejected.append(rows.where(F.col(CORRUPT_COLUMN).isNotNull())
                            .select(F.col("_sl_file").alias("file"), F.col(CORRUPT_COLUMN).alias("line"), reason(MALFORMED)))
        out = rejected[0] if len(rejected) == 1 else rejected[0].unionByName(rejected[1])
        _write(out, rejected_path, batch, [])
        drop_scratch(spark, staged)

    return write


def _plain(file: str) -> str:
    """The metadata column percent-encodes paths, the reader takes them plain."""
    from urllib.parse import unquote
    return unquote(file)


def rejected_path_of(out_path: str) -> str:
    return f"{out_path.rstrip('/')}_rejected"


def incremental_clean(spark: SparkSession, raw_path: str, header_names: list[str],
                      out_path: str, checkpoint: str, renames: Mapping[str, str] = RENAME_MAP,
                      as_of: dt.date | str | None = None, partition_by_date: bool = False,
                      rejected_path: str | None = None, max_files_per_trigger: int = FILES_PER_BATCH,
                      csv_options: Mapping[str, str] | None = None) -> StreamingQuery:
    """Clean new files under ``raw_path`` into the Parquet table at ``out_path``
    (read it with :func:`read_pickup`); returns the (already triggered) query.

    ``header_names`` are the raw names of a good file's columns.  Malformed lines
    and all lines of files with other columns go, with file and reason, to
    ``rejected_path`` (default: ``out_path`` + ``_rejected``).  With
    ``partition_by_date`` the table keeps one folder per load date."""
    write = batch_writer(header_names, out_path, rejected_path or rejected_path_of(out_path), renames, as_of, partition_by_date, csv_options)
    return (file_stream(spark, raw_path, max_files_per_trigger).writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_incremental_clean(spark: SparkSession, raw_path: str, header_names: list[str],
                          out_path: str, checkpoint: str, **kwargs) -> None:
    """Run one pickup to completion."""
    q = incremental_clean(spark, raw_path, header_names, out_path, checkpoint, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def read_pickup(spark: SparkSession, out_path: str) -> DataFrame | None:
    """The rows that were picked up (or rejected) so far; None before the first."""
    try:
        return spark.read.parquet(out_path).drop(BATCH)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
