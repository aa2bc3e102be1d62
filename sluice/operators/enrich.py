"""Left enrichment of a facet with a detail table on a key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.columns import col, drop_if_exists


class ColumnOverlapError(ValueError):
    """Both sides carry the same non-key column name."""


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _spelled(df: DataFrame, key: str) -> str:
    """The key as the frame spells it."""
    return next((c for c in df.columns if c.lower() == key.lower()), key)


def _resolve_overlap(left: DataFrame, right: DataFrame, keys: list[str], on_overlap: str,
                     suffix: str) -> DataFrame:
    keyset = {k.lower() for k in keys}
    left_names = {c.lower() for c in left.columns}
    overlap = [c for c in right.columns if c.lower() in left_names and c.lower() not in keyset]
    if not overlap:
        return right
    if on_overlap == "error":
        raise ColumnOverlapError(f"left_enrich: both sides have columns {overlap}")
    if on_overlap != "suffix":
        raise ValueError(f"on_overlap must be 'error' or 'suffix', got {on_overlap!r}")
    return right.toDF(*[c + suffix if c in overlap else c for c in right.columns])


def _hash_of(df: DataFrame) -> Column:
    """A deterministic hash of the row, so task retries see the same salts."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                        if not isinstance(f.dataType, T.MapType)])


def _salted(left: DataFrame, right: DataFrame, keys: list[str], rows_per_split: int,
            how: str = "inner") -> DataFrame:
    """Join with the hot keys of ``right`` spread over several tasks.

    A key is hot when it has more than ``rows_per_split`` right rows; those
    rows get one of ``ceil(rows / rows_per_split)`` salts from the row's hash
    and its left rows are repeated once per salt.  Other keys keep salt 0.
    The table of hot keys has at most rows / ``rows_per_split`` entries; the
    join with it is left to adaptive execution, which measures it.
    """
    counts = right.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_sl_n"))
    hot = (counts.where(F.col("_sl_n") > rows_per_split)
           .select(*[col(k) for k in keys],
                   F.ceil(F.col("_sl_n") / F.lit(rows_per_split)).alias("_sl_splits")))
    splits = F.coalesce(F.col("_sl_splits"), F.lit(1).cast("long"))
    right_s = (right.join(hot, keys, "left")
               .withColumn("_sl_salt", F.pmod(_hash_of(right), splits))
               .drop("_sl_splits"))
    left_s = (left.join(hot, keys, "left")
              .withColumn("_sl_salt", F.explode(F.sequence(F.lit(0).cast("long"), splits - 1)))
              .drop("_sl_splits"))
    return left_s.join(right_s, keys + ["_sl_salt"], how).drop("_sl_salt")


def _salted_anti(left: DataFrame, right_keys: DataFrame, keys: list[str],
                 rows_per_split: int) -> DataFrame:
    """Left rows without a match, with the hot keys of ``left`` spread over
    several tasks (``right_keys`` has each key once).  Rows with a null key
    match nothing and stay out of the shuffle."""
    known = None
    for k in keys:
        c = col(k).isNotNull()
        known = c if known is None else known & c
    rest = left.where(known)
    counts = rest.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_sl_n"))
    hot = (counts.where(F.col("_sl_n") > rows_per_split)
           .select(*[col(k) for k in keys],
                   F.ceil(F.col("_sl_n") / F.lit(rows_per_split)).alias("_sl_splits")))
    splits = F.coalesce(F.col("_sl_splits"), F.lit(1).cast("long"))
    rest = (rest.join(hot, keys, "left")
            .withColumn("_sl_salt", F.pmod(_hash_of(left), splits)).drop("_sl_splits"))
    repeated = (right_keys.join(hot, keys, "left")
                .withColumn("_sl_salt", F.explode(F.sequence(F.lit(0).cast("long"), splits - 1)))
                .drop("_sl_splits"))
    anti = rest.join(repeated, keys + ["_sl_salt"], "left_anti").drop("_sl_salt")
    return anti.select(*left.columns).unionByName(left.where(~known))


def left_enrich(left: DataFrame, right: DataFrame, on: str | Sequence[str],
                drop: Iterable[str] = (), on_overlap: str = "error",
                suffix: str = "_detail", strategy: str = "split",
                rows_per_split: int = 1_000_000) -> DataFrame:
    """``left`` LEFT JOIN ``right`` USING (``on``), after dropping ``drop``
    from ``right``.  Output columns: keys, left's others, right's others.

    ``strategy="join"`` is one left outer join.  Spark can split a skewed
    partition of the preserved (left) side only, so a hot key in the detail
    table lands in one task.

    ``strategy="split"`` (default) computes the same rows as
    inner join  UNION ALL  (left anti distinct right keys, null-extended).
    Adaptive execution may split skewed partitions on both sides of the inner
    join, and the anti join sees each right key once after a map-side
    distinct, so no task holds a hot key's detail rows alone.

    ``strategy="salted"`` is the split plan with hot keys of either side salted
    explicitly (see :func:`_salted` and :func:`_salted_anti`), for clusters where
    adaptive skew handling is off or its thresholds do not fire: no task gets
    many more than ``rows_per_split`` rows of one key.

    Key names match in any case, as column names do in Spark; the output has
    the left side's spelling.
    """
    keys = [_spelled(left, k) for k in _keys(on)]
    spelled = {k.lower(): k for k in keys}
    right = right.toDF(*[spelled.get(c.lower(), c) for c in right.columns])
    right = _resolve_overlap(left, drop_if_exists(right, drop), keys, on_overlap, suffix)
    if strategy == "join":
        return left.join(right, keys, "left")
    if strategy not in ("split", "salted"):
        raise ValueError(f"strategy must be 'split', 'salted' or 'join', got {strategy!r}")
    if strategy == "salted":
        matched = _salted(left, right, keys, rows_per_split)
    else:
        matched = left.join(right, keys, "inner")
    key_cond = None
    for k in keys:
        c = col(k).isNotNull()
        key_cond = c if key_cond is None else key_cond & c
    right_keys = right.select(*[col(k) for k in keys]).where(key_cond).distinct()
    if strategy == "salted":
        unmatched = _salted_anti(left, right_keys, keys, rows_per_split)
    else:
        unmatched = left.join(right_keys, keys, "left_anti")
    keyset = set(keys)
    right_fields = [f for f in right.schema.fields if f.name not in keyset]
    left_rest = [c for c in left.columns if c not in keyset]
    unmatched = unmatched.select(
        *[col(k) for k in keys], *[col(c) for c in left_rest],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in right_fields])
    return matched.unionByName(unmatched)


def fanout_report(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """One row: left rows, rows a left join would output, largest number of
    detail rows behind one left row, and left rows repeated more than once.

    Right keys are counted with a map-side partial aggregate, so a hot key
    costs one row per task before the shuffle."""
    keys = _keys(on)
    counts = right.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_sl_matches"))
    joined = left.select(*[col(k) for k in keys]).join(counts, keys, "left")
    m = F.coalesce(F.col("_sl_matches"), F.lit(0))
    return joined.agg(
        F.count(F.lit(1)).alias("left_rows"),
        F.sum(F.greatest(m, F.lit(1))).alias("output_rows"),
        F.max(m).alias("max_matches"),
        F.count(F.when(m > 1, 1)).alias("repeated_left_rows"))
