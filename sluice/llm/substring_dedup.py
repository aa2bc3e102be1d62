"""Substring dedup: windows that repeat, found level by level with doubled lengths.

The first level has half a window's length.  Of each window's first-level
pieces, that with the least hash is its anchor: equal windows choose equal
anchors at the same place, so posting anchors alone (about a sixth of all places)
loses no repeat.  Pieces that repeat are extended to whole windows, those that
repeat to twice the length, and so on until no candidates survive:

* level ``length // 2``: counts of all anchors; those that occur once are dropped.
* level ``length``: anchors that agree in the whole reach of the windows around them
  are one class, settled by its first member; where the members of an anchor
  differ, the windows of each class's first member are counted one by one.
* levels 2, 4, 8 ... times ``length``: windows that start at an anchor which is the
  least of a span as long (half as many at each level), if their first half repeats.

Word sequences are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep, ship, text_id
from sluice.llm.sequences import BASE, U, Words, bits_of, mix, passes, signed, small_batches


class Texts(Words):
    """Texts with the anchors of their windows."""

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(places, hashes) of all anchors; windows and the anchor of each."""
        piece = length // 2
        none = np.zeros(0, np.int64)
        if self.n < length:
            return none, np.zeros(0, U), none, none
        h = self.hashes(np.arange(self.n - piece + 1), piece)
        least, place, have, width = h, np.arange(len(h)), 1, length - piece + 1
        while have < width:  # the least of ``have`` pieces, the leftmost of equal ones
            step = min(have, width - have)
            right = least[step:] < least[:-step]
            place = np.where(right, place[step:], place[:-step])
            least = np.where(right, least[step:], least[:-step])
            have += step
        windows = np.flatnonzero(np.arange(len(place)) + length <= self.to[:len(place)])
        of = place[windows]
        places = np.unique(of)
        return places, h[places], windows, of

    def reach(self, places: np.ndarray, hashes: np.ndarray, piece: int) -> np.ndarray:
        """Length of the longest span of words in which each of all anchors is the least."""
        at, h, first, last = (x.tolist() for x in (places, hashes, self.from_[places], self.to[places]))
        left, right, stack = list(first), list(last), []
        for i, x in enumerate(h):
            if stack and first[stack[-1]] != first[i]:
                stack.clear()
            while stack and h[stack[-1]] > x:
                right[stack.pop()] = at[i] + piece - 1
            if stack:
                left[i] = at[stack[-1]] + 1
            stack.append(i)
        return np.array(right, np.int64) - np.array(left, np.int64)


ROW = "doc_id long, text_id long"


def _rows_of(batch: pa.RecordBatch, which: np.ndarray) -> list[pa.Array]:
    return [batch.column(c).take(pa.array(which)) for c in ("doc_id", "text_id")]


def _keys(docs: DataFrame, length: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([signed(Texts(batch.column("text")).anchors(length)[1])], names=["key"])

    return docs.select("text").mapInArrow(find, "key long")


def _postings(docs: DataFrame, length: int, bitmap: np.ndarray) -> DataFrame:
    """(key, ctx, doc_id, text_id, at, lo, hi): anchors that the filter lets through.  ctx tells apart what lies in the
    reach of the windows around an anchor, the words from lo to hi."""
    known, piece = docs.sparkSession.sparkContext.broadcast(bitmap), length // 2

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        for batch in small_batches(batches):
            w = Texts(batch.column("text"))
            places, h, _, _ = w.anchors(length)
            on = passes(bits, h)
            places, h = places[on], h[on]
            first = w.from_[places]
            lo, hi = np.maximum(places - (length - piece), first), np.minimum(places + length, w.to[places])
            ctx = mix(w.hashes(lo, hi - lo) + (places - lo).astype(U) * U(BASE))
            yield pa.RecordBatch.from_arrays(
                [signed(h), signed(ctx), *_rows_of(batch, w.text[places]), *(pa.array((x - first).astype(np.int32)) for x in (places, lo, hi))],
                names=["key", "ctx", "doc_id", "text_id", "at", "lo", "hi"])

    return docs.mapInArrow(find, f"key long, ctx long, {ROW}, at int, lo int, hi int")


def _windows(docs: DataFrame, length: int) -> DataFrame:
    """(level, h, doc_id, text_id, at): at level 0 the windows of the anchors ``near``, at the others those that start at the anchors ``all``."""
    piece = length // 2

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            w = Texts(batch.column("text"))
            places, h, windows, of = w.anchors(length)
            marked = []
            for column in ("near", "all"):
                lists = batch.column(column)
                spots = [w.first[i] + np.asarray(x.values, np.int64) for i, x in enumerate(lists) if x.is_valid]
                marked.append(np.concatenate([*spots, np.zeros(0, np.int64)]))
            mine = windows[np.isin(of, marked[0])]
            out = [(np.zeros(len(mine), np.int32), w.hashes(mine, length), mine)]
            wanted = np.isin(places, marked[1])
            reach, level, places = np.minimum(w.reach(places, h, piece)[wanted], (w.to[places] - places)[wanted]), length, places[wanted]
            while len(places):
                on = reach >= level
                places, reach = places[on], reach[on]
                out.append((np.full(len(places), level, np.int32), w.hashes(places, level), places))
                level *= 2
            levels, hashes, at = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(levels), signed(hashes), *_rows_of(batch, w.text[at]), pa.array((at - w.from_[at]).astype(np.int32))],
                                             names=["level", "h", "doc_id", "text_id", "at"])

    return docs.mapInArrow(find, f"level int, h long, {ROW}, at int")


def _start() -> Column:
    """Order in which windows start: rows without doc_id last, rows that share one by the hash of their texts."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id", "at")


def _same_row(a: DataFrame, b: DataFrame, how: str, on: list[str] | None = None) -> DataFrame:
    """Join of two tables by row (rows without doc_id are equal there) and the columns ``on``, kept once."""
    b = b.withColumnsRenamed({c: f"{c}_b" for c in ["doc_id", "text_id", *(on or [])]})
    same = a["doc_id"].eqNullSafe(b["doc_id_b"]) & (a["text_id"] == b["text_id_b"])
    for c in on or []:
        same &= a[c] == b[f"{c}_b"]
    return a.join(b, same, how).drop("doc_id_b", "text_id_b", *(f"{c}_b" for c in on or []))


def _levels(windows: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_id, longest): the greatest level at which one of a row's windows repeats."""
    level, alive, found = length, None, []
    while alive is None or not alive.isEmpty():
        here = windows.where(F.col("level") == level)
        if alive is not None:
            here = _same_row(here, alive, "left_semi", ["at"])
        often = keep(here.groupBy("h").count().where("count > 1").select("h"), "substring-level")
        alive = keep(here.join(often, "h").select("doc_id", "text_id", "at"), "substring-alive")
        found.append(alive.select("doc_id", "text_id").distinct().withColumn("longest", F.lit(level).cast("long")))
        level *= 2
    return reduce(DataFrame.unionAll, found).groupBy("doc_id", "text_id").agg(F.max("longest").alias("longest"))


def _kept(docs: DataFrame) -> DataFrame:
    """Texts without the words of the spans (lo << 32 | hi)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            out: list[list] = [[], [], []]
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(words) + 1, np.int64)
                if spans.is_valid:
                    x = np.asarray(spans.values, np.int64)
                    np.add.at(gone, x >> 32, 1)
                    np.add.at(gone, x & 0xFFFFFFFF, -1)
                stay = np.cumsum(gone)[:-1] == 0
                out[0].append(b" ".join(words if stay.all() else [words[i] for i in np.flatnonzero(stay)]))
                out[1].append(len(words))
                out[2].append(len(words) - int(stay.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_id"), pa.array(out[0], pa.binary()).cast(pa.string()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64()), batch.column("longest")], names=["doc_id", "text_id", "text", "n_words", "n_removed", "longest"])

    return docs.mapInArrow(cut, f"{ROW}, text string, n_words long, n_removed long, longest long")


def substring_dedup(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc_id, text_id, text, n_words, n_removed, longest) for each row of (doc_id, text).

    A window is ``length`` words of a text in a row; each word is removed that lies in
    a window whose words also start earlier: in a row with a smaller doc_id, or earlier
    in the same text.  ``text`` has the words left, joined by one space.  ``longest`` is
    the greatest level at which a window of the row was found twice, 0 if none was: a
    passage of twice a level's words or more reaches that level.

    Null and empty texts, and texts shorter than a window, have no windows and lose
    nothing; null gives ''.  Rows without doc_id come after all others; rows that share
    one are in the order of their texts' hashes; rows equal in both are one text and
    get equal results, a row each.  Empty tables give empty results; other columns are
    ignored.  Texts are never cut: one takes some 30 times its bytes in a task.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_id().alias("text_id"), "text")
    often = keep(_keys(docs, length).groupBy("key").count().where("count > 1").select("key"), "substring-keys")
    found = keep(_postings(rows, length, bits_of(often)).join(often, "key"), "substring-anchors")
    classes = keep(found.groupBy("key", "ctx").agg(F.min(_start()).alias("first"), F.count("*").alias("n")), "substring-classes")
    later = found.join(classes.where("n > 1").select("key", "ctx", "first"), ["key", "ctx"]).where(_start() != F.col("first")).select("doc_id", "text_id", "lo", "hi")
    differ = classes.groupBy("key").count().where("count > 1").select("key")
    near = classes.join(differ, "key").select("first.doc_id", "first.text_id", F.col("first.at").alias("near"), F.lit(None).cast("int").alias("at"))
    marks = found.select("doc_id", "text_id", F.lit(None).cast("int").alias("near"), "at").unionAll(near)
    marks = marks.groupBy("doc_id", "text_id").agg(F.collect_set("near").alias("near"), F.collect_set("at").alias("all"))
    windows = keep(_windows(_same_row(rows, marks, "inner"), length), "substring-windows")
    exact = windows.where("level = 0")
    first = keep(exact.groupBy("h").agg(F.min(_start()).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "first"), "substring-first")
    again = exact.join(first, "h").where(_start() != F.col("first")).select("doc_id", "text_id", F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))
    spans = later.unionAll(again).select("doc_id", "text_id", (F.shiftleft(F.col("lo").cast("long"), 32) + F.col("hi")).alias("span"), F.lit(0).cast("long").alias("longest"))
    longest = _levels(windows.where("level > 0"), length).select("doc_id", "text_id", F.lit(None).cast("long").alias("span"), "longest")
    known = spans.unionAll(longest).groupBy("doc_id", "text_id").agg(F.collect_set("span").alias("spans"), F.max("longest").alias("longest"))
    return _kept(_same_row(rows, known, "left").withColumn("longest", F.coalesce("longest", F.lit(0).cast("long"))))
