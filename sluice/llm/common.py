"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII white space, in Java's regex syntax; words are what lies between.
BLANK = r"[ \t\n\x0B\f\r]+"

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that tasks can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    path = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="code-")), f"{name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(top):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch folder for files that tasks write themselves."""
    return scratch_path(spark, name)


def open_folder(uri: str):
    """(file system, path) of a shared folder, in a task; made if it isn't there."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path, recursive=True)
    return store, path


def lower_ascii(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column, gap: str = BLANK) -> Column:
    """The words between matches of gap; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def summed(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


#: Bytes of a table that all tasks may get; beyond, it is joined by a shuffle.
BROADCAST = 32 << 20


def few(df: DataFrame, most_bytes: int = BROADCAST) -> DataFrame:
    """df, marked for a broadcast if its rows take few bytes; else Spark decides how to join it.

    Rows of numbers (and structs of them) take the bytes of their schema; those with
    texts or arrays, whose lengths vary, are never marked.
    """
    return F.broadcast(df) if (width := _width(df.schema)) and df.count() * width <= most_bytes else df


def _width(kind: T.DataType) -> int | None:
    """Bytes of a value, null flags included; None if that varies."""
    if isinstance(kind, T.StructType):
        widths = [_width(f.dataType) for f in kind.fields]
        return None if None in widths else 8 + sum(widths)
    return 8 if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)) else None


def text_id(text: str | Column = "text") -> Column:
    """Tells apart rows that share an id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id (null equals null) and text_id are among those of ``gone``."""
    d = docs.select(F.struct("*").alias("row"), text_id().alias("text_id")).alias("d")
    g = few(keep(gone.select("doc_id", "text_id").distinct(), "gone")).alias("g")
    left = d.join(g, F.col("d.row.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.text_id") == F.col("g.text_id")), "left_anti")
    return left.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def crc32_of(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))
