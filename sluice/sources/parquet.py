"""Staging and transform layers: Parquet tables, one folder per name."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.stamps import add_etl_date, add_row_id
from sluice.session import file_system
from sluice.sources.versions import commit, publish, resolve, state, write_tables

#: Column of a malformed line's text in versions written by write_apart, and their two parts.
LINE_COLUMN, GOOD_ROWS, BAD_ROWS = "_sl_line", "malformed=false", "malformed=true"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_domain(spark: SparkSession, root: str, domain: str,
                as_of: dt.date | str | None = None, date_col: str = "etl_date") -> DataFrame:
    """A table's current version (Parquet keeps its own schema).  With ``as_of``,
    only that load: on a table partitioned by the date this prunes partitions."""
    path = resolve(spark, root, domain)
    df = spark.read.parquet(path)
    if path.endswith(f"/{GOOD_ROWS}"):
        df = df.drop(LINE_COLUMN)
    if as_of is not None:
        df = df.where(F.col(date_col) == F.lit(str(as_of)).cast("date"))
    return df


def write_domain(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                 partition_by: list[str] | None = None) -> str:
    """Replace (or append to) a table; returns the path of its files.

    A replacement is a new version that readers see once its commit is there
    (:mod:`sluice.sources.versions`), so a run that fails at any step leaves the
    last good table as it is.  Partitioned overwrites replace only the
    partitions written (history is kept), and appends add files to the current
    version; both are staged by Spark's own commit, in place."""
    if partition_by:
        path = table_path(root, name)
        (df.write.mode(mode).partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
         .parquet(path))
        unversion(df.sparkSession, root, name)
        return path
    if mode != "overwrite":
        path = resolve(df.sparkSession, root, name)
        df.write.mode(mode).parquet(path)
        return path
    return write_tables({name: df}, root)[name]


def write_apart(df: DataFrame, line_column: str, root: str, name: str,
                aside: Callable[[DataFrame], object]) -> str:
    """Replace a table by the rows of ``df`` without text in ``line_column``; the
    others go to ``aside`` before the table is committed.  Returns the path.

    Both kinds are written in one job by a flag partition of the new version,
    so the source is scanned once; readers see the good part only."""
    spark = df.sparkSession
    flagged = df.withColumnRenamed(line_column, LINE_COLUMN).withColumn("malformed", F.col(LINE_COLUMN).isNotNull())
    schema = flagged.drop("malformed").schema

    def write(path: str) -> str:
        flagged.write.partitionBy("malformed").parquet(path)
        if not _exists(spark, f"{path}/{GOOD_ROWS}"):
            spark.createDataFrame([], schema).write.parquet(f"{path}/{GOOD_ROWS}")
        bad = f"{path}/{BAD_ROWS}"
        rows = spark.read.schema(schema).parquet(bad) if _exists(spark, bad) else spark.createDataFrame([], schema)
        aside(rows.withColumnRenamed(LINE_COLUMN, line_column))
        return GOOD_ROWS

    return publish(spark, root, {name: write})[name]


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = file_system(spark, path)
    return fs.exists(where)


def unversion(spark: SparkSession, root: str, name: str) -> None:
    """Take a table that is now written in place out of the commits, with its versions."""
    versions = state(spark, root)[1].get(name)
    if versions:
        commit(spark, root, {name: None})


def stamp(df: DataFrame, as_of: dt.date | str | None = None, row_id: bool = True) -> DataFrame:
    """Row id and load date; stamps carried over from staging are replaced
    in place (and so pruned from the scan)."""
    out = add_row_id(df) if row_id else df
    return add_etl_date(out, as_of)


def write_facets(frames: Mapping[str, DataFrame], root: str, as_of: dt.date | str | None = None,
                 stamp_rows: bool | Iterable[str] = True, parallel: int | None = None,
                 share_parent: DataFrame | None = None, counts: dict[str, int] | None = None) -> dict[str, str]:
    """Write several named frames as concurrent Spark jobs (all at once by
    default, so small facets fill the slots a large one leaves idle) and
    publish them as one set: readers see all new facets or none.

    ``stamp_rows``: True stamps every frame, False none, or the names of the
    frames to stamp (others keep the stamps they carry).  Each facet scan
    reads only its own columns from Parquet, so by default nothing is
    cached.  ``share_parent`` persists that frame (memory and disk) for the
    duration of the writes when facets overlap heavily.  ``counts`` is filled
    with the rows of each facet, counted as they are written.
    """
    if isinstance(stamp_rows, bool):
        restamp = set(frames) if stamp_rows else set()
    else:
        restamp = set(stamp_rows)
    if not frames:
        return {}
    if share_parent is not None:
        share_parent.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = {name: stamp(frame, as_of) if name in restamp else frame for name, frame in frames.items()}
        if counts is None:
            return write_tables(out, root, parallel)
        seen = {name: Observation(f"sluice-rows-{uuid.uuid4().hex}") for name in out}
        paths = write_tables({name: frame.observe(seen[name], F.count(F.lit(1)).alias("n")) for name, frame in out.items()}, root, parallel)
        counts.update({name: int(o.get["n"]) for name, o in seen.items()})
        return paths
    finally:
        if share_parent is not None:
            share_parent.unpersist()
