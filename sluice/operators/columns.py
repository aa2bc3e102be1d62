"""Single-projection column operators: names, trim, casts, selections.

Each operator builds one ``select``/``toDF`` instead of a per-column
``withColumn`` chain: the chain is re-analysed once per column (quadratic
on wide tables) even though the optimizer collapses it afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.casts import safe_cast
from sluice.functions.names import keyword_columns, plan_normalized_names, plan_renames


def col(name: str) -> Column:
    """Column by exact name, safe for dots and other odd characters."""
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_names(df: DataFrame, on_collision: str = "error") -> DataFrame:
    """Rename every column by the header rule; collisions raise before any
    data is touched, or get numbered suffixes."""
    return df.toDF(*plan_normalized_names(df.columns, on_collision))


def rename_map(df: DataFrame, mapping: Mapping[str, str], on_collision: str = "error") -> DataFrame:
    """Rename by lookup (case-insensitive after strip); absent sources ignored."""
    return df.toDF(*plan_renames(df.columns, mapping, on_collision))


def trim_strings(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Trim spaces (only ' ') at both ends of string columns; null stays null
    and an all-space value becomes ''."""
    wanted = None if columns is None else set(columns)
    out = []
    for field in df.schema.fields:
        c = col(field.name)
        if isinstance(field.dataType, T.StringType) and (wanted is None or field.name in wanted):
            c = F.trim(c).alias(field.name)
        out.append(c)
    return df.select(*out)


def _schema_items(schema: T.StructType | Mapping[str, T.DataType]) -> list[tuple[str, T.DataType]]:
    if isinstance(schema, T.StructType):
        return [(f.name, f.dataType) for f in schema.fields]
    return list(schema.items())


def cast_schema(df: DataFrame, schema: T.StructType | Mapping[str, T.DataType]) -> DataFrame:
    """Cast each schema entry present in ``df``; unparseable values become null."""
    types = dict(_schema_items(schema))
    out = []
    for field in df.schema.fields:
        target = types.get(field.name)
        if target is None or target == field.dataType:
            out.append(col(field.name))
        else:
            out.append(safe_cast(col(field.name), target, field.dataType).alias(field.name))
    return df.select(*out)


def _lost_counts(df: DataFrame, schema: T.StructType | Mapping[str, T.DataType]) -> list[Column]:
    """Per column that is cast, the count of non-null values that become null."""
    present = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for name, target in _schema_items(schema):
        if name in present and present[name] != target:
            lost = col(name).isNotNull() & safe_cast(col(name), target, present[name]).isNull()
            aggs.append(F.count(F.when(lost, 1)).alias(name))
    return aggs


def cast_observed(df: DataFrame, schema: T.StructType | Mapping[str, T.DataType]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """:func:`cast_schema` that counts what it loses as the frame is written:
    the frame, and a function that gives the lost values per column (those that
    lost any) once one action over it has ended.  No extra scan."""
    counts = _lost_counts(df, schema)
    if not counts:
        return cast_schema(df, schema), dict
    seen = Observation(f"sluice-lost-{uuid.uuid4().hex}")
    return cast_schema(df.observe(seen, *counts), schema), lambda: {c: int(n) for c, n in seen.get.items() if n}


def cast_audit(df: DataFrame, schema: T.StructType | Mapping[str, T.DataType]) -> DataFrame:
    """One row: per cast column, how many non-null values the cast turns to
    null.  One scan, partial aggregation per task."""
    aggs = _lost_counts(df, schema)
    if not aggs:
        return df.sparkSession.range(1).select(F.lit(0).alias("no_casts")).where(F.lit(False))
    return df.agg(*aggs)


def select_fixed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fixed projection; a missing column raises with the full list."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise KeyError(f"select_fixed: missing columns {missing}")
    return df.select(*[col(c) for c in columns])


def select_keywords(df: DataFrame, keywords: Iterable[str]) -> DataFrame:
    """Keep columns whose name contains any keyword (case-sensitive), in
    source order."""
    return df.select(*[col(c) for c in keyword_columns(df.columns, keywords)])


def drop_if_exists(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist; others are ignored."""
    drop = set(columns)
    return df.select(*[col(c) for c in df.columns if c not in drop])
