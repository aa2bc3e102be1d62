"""Applying a move plan: files land under their targets, then leave the source.

A move is committed in two jobs over the plan.  The first copies each file's
bytes beside its target, puts it in place and writes one log row per file; the
log's own commit (Spark's) is the commit of the move.  The second reads the
committed log and removes the sources of files that landed and have not changed
since.  A run that dies before the commit has removed nothing, one that dies
after it leaves sources that the next run moves again, to the same bytes; a
second run finds nothing to move.

The plan's rows, not file lists, are dealt out to the tasks; a file is copied in
blocks by one of them, so neither its size nor the number of files is bounded
by memory.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources import files
from sluice.sources.files import open_store, put_file

#: Files that one task copies, as they may be large; once there are EVEN_TASKS
#: tasks, their files even out, and they take up to MOST_FILES before there are more.
FILES_PER_TASK, EVEN_TASKS, MOST_FILES = 64, 256, 500
#: Bytes that a task holds at a time.
BLOCK = 8 << 20

LANDED, GONE = "landed", "gone"
LOG = "domain string, key string, source string, target string, status string, outcome string, bytes long, modified timestamp"


def _log_schema() -> pa.Schema:
    text = [pa.field(c, pa.string()) for c in ("domain", "key", "source", "target", "status", "outcome")]
    return pa.schema([*text, pa.field("bytes", pa.int64()), pa.field("modified", pa.timestamp("us", "UTC"))])


def _copy(source: str, target: str) -> tuple[str, int | None, dt.datetime | None]:
    """Put a file's bytes in the place of its target: (outcome, size, modification time)."""
    from pyarrow import fs

    old, there = open_store(source)
    info = old.get_file_info(there)
    if info.type != fs.FileType.File:
        return GONE, None, None          # another run has moved it
    with old.open_input_stream(there) as src:
        put_file(target, iter(lambda: src.read(BLOCK), b""), info.size)
    return LANDED, info.size, info.mtime


def copy_tasks(n_files: int) -> int:
    return max(1, min(-(-n_files // FILES_PER_TASK), EVEN_TASKS), -(-n_files // MOST_FILES))


def _land(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            row["outcome"], row["bytes"], row["modified"] = _copy(row["source"], row["target"])
        yield from pa.Table.from_pylist(rows, _log_schema()).to_batches()


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sources that went, of those in the log."""
    from pyarrow import fs

    for batch in batches:
        gone = []
        for row in batch.to_pylist():
            store, there = open_store(row["source"])
            info = store.get_file_info(there)
            same = info.type == fs.FileType.File and info.size == row["bytes"] and info.mtime == row["modified"]
            if same:                     # a file that came meanwhile under this name stays
                store.delete_file(there)
                gone.append(row["source"])
        yield pa.RecordBatch.from_arrays([pa.array(gone, pa.string())], names=["source"])


def apply_moves(spark: SparkSession, plan: DataFrame, log_root: str, run_id: str | None = None) -> DataFrame:
    """Carry out a move plan; returns the log: (domain, key, source, target, status,
    outcome, bytes, modified), with outcome ``landed`` or, for files that are no
    longer there, ``gone``.

    The log is kept under ``log_root``, a folder per run; a repeated run id
    replaces its log.  A target that exists is replaced, as a later load of the
    same file does.  Rows without source or target are left out.
    """
    run = f"{log_root.rstrip('/')}/run-{run_id or uuid.uuid4().hex}"
    wanted = plan.select("domain", "key", "source", "target", "status").where("source IS NOT NULL AND target IS NOT NULL AND source <> target")
    n_files = wanted.count()
    dealt = wanted.repartition(copy_tasks(n_files), "source")
    dealt.mapInArrow(_land, LOG).write.mode("overwrite").parquet(f"{run}/landed")
    log = spark.read.schema(LOG).parquet(f"{run}/landed")
    # removing a file takes the same time whatever its size
    left = log.where(F.col("outcome") == LANDED).select("source", "bytes", "modified").repartition(max(1, -(-n_files // files.FILES_PER_TASK)), "source")
    left.mapInArrow(_remove, "source string").write.mode("overwrite").parquet(f"{run}/removed")
    return log
