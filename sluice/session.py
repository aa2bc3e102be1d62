"""Session construction and the shared scratch folder.

Scratch tables (materialised intermediates, test fixtures) always live under
the folder the cluster names in ``spark.checkpoint.dir``.  Only when that is
unset (local tests, benches) do we create one of our own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


class ScratchFolderError(RuntimeError):
    """No shared scratch folder, or a path outside it."""


_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.scheduler.mode": "FAIR",          # concurrent facet / domain jobs share slots
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "sluice", driver_memory: str = "8g",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and benches; a cluster passes its own session in."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in {**_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    work_dir(spark)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder for scratch tables: ``spark.checkpoint.dir``.

    Set to a fresh local folder only when the session has none and its master
    is local (tests); a cluster without the setting raises, because executors
    could not see each other's local folders.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    require_local(sc.master)
    local = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(local)
    return local


def require_local(master: str) -> None:
    """Raise unless ``master`` runs everything in one process (``local-cluster`` does not)."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ScratchFolderError("set spark.checkpoint.dir to a folder that all executors share: "
                                 f"master {master!r} cannot use a machine-local one")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a scratch table once nothing reads it any more."""
    if not path.startswith(f"{work_dir(spark)}/sluice/"):
        raise ScratchFolderError(f"{path!r} is not under the scratch folder")
    remove_path(spark, path)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a path, whatever store it is in."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove_path(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared scratch folder."""
    return f"{work_dir(spark)}/sluice/{name}-{uuid.uuid4().hex[:12]}"
