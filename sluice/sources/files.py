"""File inventory: one row per file under a root, read by Spark.

``binaryFile`` lists in parallel and, with ``content`` pruned from the
projection, never opens the files.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from urllib.parse import quote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.paths import first_folder_expr, relative_path_expr


#: Files whose status one task looks up.
FILES_PER_TASK = 500
#: Tasks that list the folders of one folder.  Spark starts one for each up to
#: 10,000, and starting one takes longer than listing a small folder does.
LISTING_TASKS = 256
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_lock = threading.RLock()


def open_store(uri: str):
    """(file system, path) of a file, for tasks that read or write it themselves:
    local paths, ``file:`` and what pyarrow opens (hdfs, s3, gs, abfs)."""
    from pyarrow import fs

    scheme, rest = re.fullmatch(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(.*)", uri, re.S).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem(), re.sub("^//+", "/", rest)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{quote(rest)}")


def put_file(target: str, blocks: Iterable[bytes], size: int | None = None) -> None:
    """Write a file beside its place and put it there in one step; raises if it
    did not get ``size`` bytes."""
    from pyarrow import fs

    store, place = open_store(target)
    folder, _, name = place.rpartition("/")
    draft = f"{folder}/.moving-{uuid.uuid4().hex}-{name}"
    store.create_dir(folder, recursive=True)
    try:
        with store.open_output_stream(draft) as out:
            for block in blocks:
                out.write(block)
        if size is not None and (got := store.get_file_info(draft).size) != size:
            raise OSError(f"{target} got {got} bytes of {size}")
        if store.type_name == "hdfs" and store.get_file_info(place).type == fs.FileType.File:
            store.delete_file(place)     # its rename does not replace
        store.move(draft, place)
    except BaseException:
        if store.get_file_info(draft).type == fs.FileType.File:
            store.delete_file(draft)
        raise


def _put_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for target, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            put_file(target, [content.encode()])
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])


def write_texts(frame: DataFrame, root: str, key_col: str = "key", text_col: str = "text") -> int:
    """Write each row's text as a file of its own, ``root/key``; returns how many.

    For many small files: Spark's writers take a commit step on the driver for
    each.  Keys must differ and be the same when a task is repeated."""
    rows = frame.select(F.concat(F.lit(root.rstrip("/") + "/"), F.col(key_col)).alias("target"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_put_rows, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def inventory_from_paths(paths: DataFrame, root: str, path_col: str = "path") -> DataFrame:
    """Add ``rel_path``, ``domain`` (first folder below root, null for files
    at the root), ``file_name`` and ``hidden`` (name starts with '_' or '.')."""
    rel = relative_path_expr(F.col(path_col), root)
    name = F.element_at(F.split(F.col(path_col), "/"), -1)
    return (paths.withColumn("rel_path", rel)
            .withColumn("domain", first_folder_expr(F.col("rel_path")))
            .withColumn("file_name", name)
            .withColumn("hidden", name.startswith("_") | name.startswith(".")))


def _n_files(scan: DataFrame) -> int:
    """Files of a file scan, counted in the driver's JVM; their names are not fetched."""
    leaf = scan._jdf.queryExecution().analyzed().collectLeaves().head()
    return len(leaf.relation().location().inputFiles()) if hasattr(leaf, "relation") and "LogicalRelation" in leaf.getClass().getName() else 0


@contextmanager
def few_listing_tasks(spark: SparkSession):
    """Within this, a reader that lists many folders starts LISTING_TASKS tasks at
    most for them; listings of other threads wait."""
    with _lock:
        old = spark.conf.get(_LISTING, None)
        spark.conf.set(_LISTING, str(min(LISTING_TASKS, int(old or LISTING_TASKS))))
        try:
            yield
        finally:
            if old is None:
                spark.conf.unset(_LISTING)
            else:
                spark.conf.set(_LISTING, old)


def by_files(scan: DataFrame) -> DataFrame:
    """A scan of small files in tasks of FILES_PER_TASK files; moves no rows."""
    return scan.coalesce(max(1, -(-_n_files(scan) // FILES_PER_TASK)))


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Inventory of every file below ``root``: path, modification_time,
    length, rel_path, domain, file_name, hidden.  Files without a byte are not
    listed (Spark's file sources pass over them).

    Spark lists the folders when the frame is made, by jobs of LISTING_TASKS tasks
    if there are many; the frame's tasks look up the files, FILES_PER_TASK each, however large
    they are."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        with few_listing_tasks(spark):
            raw = reader.load(root)
    except AnalysisException as exc:  # a missing root is an empty inventory
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    # splits are packed by file length although no file is opened
    paths = by_files(raw).select("path", F.col("modificationTime").alias("modification_time"), "length")
    return inventory_from_paths(paths, root)
