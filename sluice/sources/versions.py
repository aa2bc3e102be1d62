"""Versioned tables: what readers see changes by one small file, written last.

A replaced table is a folder of versions, ``<root>/<name>/v-<id>/``, each
written once and never changed.  ``<root>/_commits/<number>.json`` lists the
latest versions of every table under the root; the commit with the highest
number is the truth.  A publish writes its versions first, then the next
commit, which takes its final name by one rename that fails if the name is
taken; several tables switch together or not at all.  Versions that the new
commit no longer lists are removed after it has been read back.  Whatever a run
leaves behind that raises or dies before its commit, no reader sees;
:func:`recover` removes it.

The newest commit keeps the previous version of each table too, so frames that
were read before a publish stay readable until the next one.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from sluice.session import file_system, remove_path

COMMITS = "_commits"
#: Versions of a table that the newest commit lists, the current one included.
KEPT = 2
#: Commit files that stay.
HISTORY = 20
#: Times a commit is tried again when another run has taken its number.
ATTEMPTS = 100

_LOCK = threading.Lock()


class CommitError(OSError):
    """A publish that could not be committed; the tables are as before."""


def _numbered(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """(number, path) of the commit files, highest first."""
    fs, where = file_system(spark, f"{root.rstrip('/')}/{COMMITS}")
    if not fs.exists(where):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(where)]
    return sorted(((int(n[:-5]), f"{where}/{n}") for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def _text_of(spark: SparkSession, path: str) -> str:
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def state(spark: SparkSession, root: str) -> tuple[int, dict[str, list[str]]]:
    """(highest number taken, versions of each table, the current one first)."""
    taken = _numbered(spark, root)
    for _, path in taken:
        try:
            return taken[0][0], json.loads(_text_of(spark, path))["tables"]
        except (ValueError, KeyError):      # half a file, on a store without atomic renames
            continue
    return (taken[0][0] if taken else 0), {}


def resolve(spark: SparkSession, root: str, name: str) -> str:
    """Folder with the current files of a table: its committed version, or
    the table's own folder if it is not a versioned one."""
    versions = state(spark, root)[1].get(name)
    base = f"{root.rstrip('/')}/{name}"
    return f"{base}/{versions[0]}" if versions else base


def _put(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file under a name that must not be taken; False if it is."""
    sc = spark.sparkContext
    fs, target = file_system(spark, path)
    _, draft = file_system(spark, f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}")
    if fs.exists(target):
        return False
    out = fs.create(draft, False)
    try:
        out.writeBytes(text)
    finally:
        out.close()
    hadoop = sc._jvm.org.apache.hadoop.fs
    try:
        files = hadoop.FileContext.getFileContext(target.toUri(), sc._jsc.hadoopConfiguration())
        files.rename(draft, target, sc._gateway.new_array(hadoop.Options.Rename, 0))
    except Py4JJavaError as exc:
        kind = exc.java_exception.getClass().getSimpleName()
        if kind == "FileAlreadyExistsException":
            fs.delete(draft, False)
            return False
        if kind != "UnsupportedFileSystemException" or not fs.rename(draft, target):
            raise
    return True


def _drop(spark: SparkSession, path: str) -> None:
    """Remove what no reader sees; what cannot be removed now is left to recover()."""
    try:
        remove_path(spark, path)
    except Py4JJavaError:
        pass


def commit(spark: SparkSession, root: str, new: Mapping[str, str | None]) -> int:
    """Make ``new`` (table: version, or None for a table that is no longer
    versioned) current, all at once; returns the commit's number."""
    root = root.rstrip("/")
    with _LOCK:
        for _ in range(ATTEMPTS):
            number, before = state(spark, root)
            after = {name: list(versions) for name, versions in before.items()}
            for name, version in new.items():
                versions = after.pop(name, [])
                if version is not None:
                    after[name] = [version, *versions][:KEPT]
            if _put(spark, f"{root}/{COMMITS}/{number + 1:020d}.json", json.dumps({"tables": after}, sort_keys=True)):
                break
        else:
            raise CommitError(f"no free commit number under {root}")
        last, seen = state(spark, root)
    # another run may have gone on from here; else these must be the current versions
    if last <= number or last == number + 1 and seen != after:
        raise CommitError(f"commit {number + 1} under {root} cannot be read back")
    for name, versions in before.items():
        for version in set(versions) - set(after.get(name, [])):
            _drop(spark, f"{root}/{name}/{version.split('/')[0]}")
    for _, path in _numbered(spark, root)[HISTORY:]:
        _drop(spark, path)
    return number + 1


def new_version() -> str:
    return f"v-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, writes: Mapping[str, Callable[[str], str | None]],
            parallel: int | None = None) -> dict[str, str]:
    """Write a new version of each table by ``writes[name](folder)``, as
    concurrent jobs, then commit all of them at once; returns their paths.

    A write may return the part of its folder that readers shall see.  If any
    fails, none is committed and what was written goes.
    """
    root, versions = root.rstrip("/"), {name: new_version() for name in writes}
    try:
        with ThreadPoolExecutor(max_workers=parallel or min(8, max(1, len(writes)))) as pool:
            jobs = {name: pool.submit(write, f"{root}/{name}/{versions[name]}") for name, write in writes.items()}
            parts = {name: job.result() for name, job in jobs.items()}
        seen = {name: versions[name] if not part else f"{versions[name]}/{part}" for name, part in parts.items()}
        commit(spark, root, seen)
    except Exception:
        tables = state(spark, root)[1]
        for name, version in versions.items():
            if version not in {v.split("/")[0] for v in tables.get(name, [])}:
                _drop(spark, f"{root}/{name}/{version}")
        raise
    return {name: f"{root}/{name}/{version}" for name, version in seen.items()}


def write_tables(frames: Mapping[str, DataFrame], root: str, parallel: int | None = None) -> dict[str, str]:
    """Replace several tables as one set; returns the paths of their new versions."""
    spark = next(iter(frames.values())).sparkSession

    def writer(frame: DataFrame) -> Callable[[str], None]:
        return lambda path: frame.write.parquet(path)

    return publish(spark, root, {name: writer(frame) for name, frame in frames.items()}, parallel)


def recover(spark: SparkSession, root: str, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove versions and commit drafts that no commit lists and that were
    last changed longer ago than any run takes; returns the paths.  Bounded by
    the number of tables and of their versions."""
    root = root.rstrip("/")
    known, gone = state(spark, root)[1], []
    before = (dt.datetime.now(dt.timezone.utc) - older_than).timestamp() * 1000
    fs, _ = file_system(spark, root)

    def children(path: str) -> list:
        _, where = file_system(spark, path)
        return list(fs.listStatus(where)) if fs.exists(where) else []

    found = [(f"{root}/{COMMITS}/{s.getPath().getName()}", s) for s in children(f"{root}/{COMMITS}") if s.getPath().getName().startswith(".draft-")]
    for top in [s for s in children(root) if s.isDirectory() and s.getPath().getName() != COMMITS]:
        name = top.getPath().getName()
        folders = {name: children(f"{root}/{name}")}
        if name.startswith("_"):                 # tables one level deeper
            folders = {f"{name}/{s.getPath().getName()}": children(f"{root}/{name}/{s.getPath().getName()}") for s in folders[name] if s.isDirectory()}
        for table, inside in folders.items():
            listed = {v.split("/")[0] for v in known.get(table, [])}
            found += [(f"{root}/{table}/{s.getPath().getName()}", s) for s in inside
                      if s.isDirectory() and s.getPath().getName().startswith("v-") and s.getPath().getName() not in listed]
    for path, status in found:
        if status.getModificationTime() < before:
            _drop(spark, path)
            gone.append(path)
    return gone
