"""Load stamps: row ids and the load date.

Stamps go last in a plan: a filter above ``monotonically_increasing_id``
is not pushed into the scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.columns import col
from sluice.session import scratch_path

_POS_BITS = 33  # monotonically_increasing_id keeps the in-partition position here


def add_etl_date(df: DataFrame, as_of: dt.date | str | None = None,
                 name: str = "etl_date") -> DataFrame:
    """Load date: ``as_of`` when given (one date for every table of a run),
    else the query's ``current_date()``."""
    value = F.current_date() if as_of is None else F.lit(as_of).cast(T.DateType())
    return df.withColumn(name, value)


def add_row_id(df: DataFrame, name: str = "row_id", mode: str = "monotonic",
               order_by: Sequence[str | Column] | None = None,
               work_path: str | None = None) -> DataFrame:
    """Row id column.

    ``monotonic``: unique, increasing, not contiguous (partition index in the
    upper bits).  No shuffle; changes with the partitioning.

    ``dense``: exactly 0..n-1 in ``order_by`` order, see :func:`add_dense_id`.
    """
    if mode == "monotonic":
        return df.withColumn(name, F.monotonically_increasing_id())
    if mode == "dense":
        if not order_by:
            raise ValueError("dense row ids need order_by")
        return add_dense_id(df, order_by, name, work_path)
    raise ValueError(f"mode must be 'monotonic' or 'dense', got {mode!r}")


def _hashable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, T.MapType)


def add_dense_id(df: DataFrame, order_by: Sequence[str | Column], name: str = "row_id",
                 work_path: str | None = None, tie_break: bool = True) -> DataFrame:
    """Ids 0..n-1 following ``order_by``, without a one-partition window.

    With column names (ascending, nulls first) the plan is lazy, nothing is
    written and each row moves once.  A sample of the keys gives cells of equal
    width of the first key, by which rows are shuffled; cells with more than an
    even share of the sample are parted further by cut points of the whole key.
    Counts per part (partial sums before their shuffle) give running offsets,
    and a window numbers each part's rows.  A hash of the row breaks ties, in the cut
    points too, so a hot key value spreads; rows that are equal in every column
    share a part.  The sample holds the keys with the smallest hashes, so every
    execution finds the same parts as long as the source does not change.

    Sort expressions (``F.desc("x")``) cannot be compared with cut points; for
    those the sorted rows are written to ``work_path`` (or the scratch folder).
    """
    if not all(isinstance(k, str) for k in order_by):
        return _dense_id_by_write(df, order_by, name, work_path, tie_break)
    keys = [col(k) for k in order_by] + ([F.col("_sl_tie")] if tie_break else [])
    bits = max(3, min(_MOST_BITS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length()))
    rows = df.withColumn("_sl_tie", _row_hash(df)) if tie_break else df
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    place = _as_number(keys[0], df.schema[_field_of(df, order_by[0])].dataType)
    sample = rows.select(key.alias("k"), place.alias("at")).orderBy(F.xxhash64("k")).limit((1 << bits) * _SAMPLED)
    plan = _range_plan(sample, 1 << bits)
    ranged = (rows.withColumn("_sl_plan", plan.scalar())
              .withColumn("_sl_cell", _cell(place, F.col("_sl_plan.low"), F.col("_sl_plan.high")))
              .withColumn("_sl_cut", F.when(F.array_contains("_sl_plan.hot", F.col("_sl_cell")), _search("_sl_plan.cuts", key, bits)).otherwise(F.lit(0)))
              .drop("_sl_plan"))
    counts = ranged.groupBy("_sl_cell", "_sl_cut").agg(F.count(F.lit(1)).alias("_sl_n"))
    offsets = counts.select(F.col("_sl_cell").alias("_sl_c"), F.col("_sl_cut").alias("_sl_d"),
                            (F.sum("_sl_n").over(Window.orderBy("_sl_cell", "_sl_cut")) - F.col("_sl_n")).alias("_sl_off"))
    spot = F.row_number().over(Window.partitionBy("_sl_cell", "_sl_cut").orderBy(*keys)) - 1
    numbered = ranged.withColumn("_sl_spot", spot)
    same = (numbered["_sl_cell"] == offsets["_sl_c"]) & (numbered["_sl_cut"] == offsets["_sl_d"])
    # a left join: every range has an offset, and an inner one would compute it again to drop nulls
    return (numbered.join(F.broadcast(offsets), same, "left")
            .select(*[col(c) for c in df.columns], (F.col("_sl_off") + F.col("_sl_spot")).alias(name)))


#: Cells of equal width between the least and the greatest sampled first key.
_CELLS = 1 << 14
#: Cut points inside hot cells are a power of two less one, this power at most; keys sampled for each.
_MOST_BITS, _SAMPLED = 14, 64


def _field_of(df: DataFrame, name: str) -> str:
    return next(f.name for f in df.schema.fields if f.name.lower() == name.lower())


def _as_number(key: Column, kind: T.DataType) -> Column:
    """A number that never falls as the key grows; null for kinds without one, and for null keys."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return key.cast("double") if isinstance(kind, T.NumericType) else key.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(key).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(key).cast("double")
    return F.lit(None).cast("double")


def _cell(place: Column, low: Column, high: Column) -> Column:
    """The cell of a key, rising with it: -1 for nulls and keys without a number, the last for NaN."""
    step = F.floor((place - low) / F.nullif(high - low, F.lit(0.0)) * _CELLS)
    inside = F.least(F.greatest(step, F.lit(0)), F.lit(_CELLS)).cast("int")
    return (F.when(place.isNull(), F.lit(-1)).when(F.isnan(place), F.lit(_CELLS + 1))
            .when(place < low, F.lit(0)).when(place > high, F.lit(_CELLS)).otherwise(F.coalesce(inside, F.lit(0))))


def _range_plan(sample: DataFrame, ranges: int) -> DataFrame:
    """One row and column: least and greatest number, cells that hold more than an even share of the
    sampled keys, and cut points that part the sampled keys in even shares."""
    finite = F.when(~F.isnan("at") & (F.abs("at") < F.lit(float("inf"))), F.col("at"))
    ends = sample.agg(F.min(finite).alias("low"), F.max(finite).alias("high"), F.sort_array(F.collect_list("k")).alias("s"), F.collect_list(F.struct("at")).alias("p"))
    cells = ends.withColumn("c", F.transform("p", lambda x: _cell(x["at"], F.col("low"), F.col("high"))))
    share = F.greatest(F.lit(2), F.floor(F.size("s") / ranges).cast("int"))

    def crowded(each: Column) -> Column:
        """Of sorted cells, those that the one an even share further on equals."""
        return F.array_distinct(F.filter(each, lambda c, i: F.coalesce(F.get(each, i + share) == c, F.lit(False))))

    # one-element arrays, so that what lies in them is made once and not for each element
    hot = F.get(F.transform(F.array(F.array_sort("c")), crowded), F.lit(0))
    cuts = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("s", F.floor(i * F.size("s") / ranges).cast("int")))
    return cells.select(F.struct("low", "high", hot.alias("hot"), cuts.alias("cuts")).alias("plan"))


def _search(cuts: str, key: Column, bits: int) -> Column:
    """The number of cut points at or below a key: a binary search."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])

    def search(k: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda low, step: low + F.when(
            F.get(cuts, low + step - 1) <= k, step).otherwise(F.lit(0)))

    # a one-element array again: the key is made once and not at each step
    return F.get(F.transform(F.array(key), search), F.lit(0))


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[col(f.name) for f in df.schema.fields if _hashable(f)])


def _dense_id_by_write(df: DataFrame, order_by: Sequence[str | Column], name: str,
                       work_path: str | None, tie_break: bool) -> DataFrame:
    """1. Global sort (range-partitioned by Spark, sampled bounds), ties broken
       by the row hash.
    2. Each row records its partition and in-partition position; the result
       is written once to the shared scratch folder, which fixes the order
       for the next steps and survives executor loss.
    3. Per-partition counts (one row per partition: a bounded table) give
       running offsets, broadcast back; id = offset + position.
    """
    spark = df.sparkSession
    path = work_path or scratch_path(spark, "dense-id")
    keys = [col(k) if isinstance(k, str) else k for k in order_by]
    if tie_break:
        keys.append(_row_hash(df))
    staged = df.orderBy(*keys).select(
        "*", F.spark_partition_id().alias("_sl_part"),
        F.monotonically_increasing_id().alias("_sl_mid"))
    staged.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    counts = back.groupBy("_sl_part").agg(F.count(F.lit(1)).alias("_sl_n"))
    offsets = counts.select(
        "_sl_part",
        (F.sum("_sl_n").over(Window.orderBy("_sl_part")) - F.col("_sl_n")).alias("_sl_off"))
    pos = F.col("_sl_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    return (back.join(F.broadcast(offsets), "_sl_part")
            .select(*[col(c) for c in df.columns],
                    (F.col("_sl_off") + pos).alias(name)))
