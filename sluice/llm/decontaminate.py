"""Benchmark decontamination by a prefix-filtered join of shingles.

An item's windows (``window`` consecutive words, or a shorter item whole) are
sets of word shingles, and a document holds a window only if it holds all its
shingles.  For whole containment the prefix of a set ordered by rarity is its
rarest shingle, so:

1. count the benchmark's shingles over all documents;
2. order each window's shingles by that count and join only the rarest one;
3. bound the window by the match's position (it must begin at or after the first
   word and end at or before the last);
4. verify the document's words against the window's, word by word.

Documents stream past the windows, which are broadcast in slices of a bounded
number of rows: one slice for a usual benchmark, more passes for a huge one.
Nothing of the documents is shuffled but the verified occurrences.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep, lower_ascii, text_id, words

#: Everything but ASCII letters and digits and characters beyond ASCII, in Java's regex syntax.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Windows broadcast at a time, of at most ``window`` words each.
BROADCAST_ROWS = 100_000


def gram(n: Column | int, at: list[Column]) -> Column:
    """A long that stands for up to three words; their number tells apart those with none behind."""
    return F.xxhash64(F.lit(n) if isinstance(n, int) else n, *at)


def item_windows(items: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(windows, shingles): (key, size, win, of items) and their shingles (key, size, win, off, k, gram)."""
    w = items.select("item_id", words(lower_ascii(F.col("text")), GAP).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("size", F.least(F.lit(window), F.size("w")))
    w = w.select("item_id", "size", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("s"))
    w = keep(w.select("item_id", "size", F.slice("w", F.col("s"), F.col("size")).alias("win")), "benchmark-windows")
    distinct = w.select("size", "win").distinct()
    k = F.least(F.lit(shingle), F.col("size"))
    offs = distinct.select("size", "win", k.alias("k"), F.explode(F.sequence(F.lit(0), F.col("size") - k)).alias("off"))
    at = [F.when(F.col("k") > i, F.get("win", F.col("off") + i)) for i in range(shingle)]
    return w, offs.withColumn("gram", gram(F.col("k"), at))


def slices(df: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """df in parts of about ``rows`` rows by key, for one broadcast each."""
    n = -(-df.count() // rows)
    return [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)] if n > 1 else [df]


def spots(docs: DataFrame, sizes: list[int], shingle: int) -> DataFrame:
    """(doc_id, text_id, w, pos, gram) for each shingle of each document.

    Exploding, hashing and the broadcast join that follows are one generated
    loop, so the words are not copied for each of the rows.
    """
    d = docs.select("doc_id", text_id().alias("text_id"),
                    words(lower_ascii(F.col("text")), GAP).alias("w"))
    d = d.select("doc_id", "text_id", "w", F.posexplode_outer("w").alias("pos", "first"))
    at = [F.col("first"), *(F.get("w", F.col("pos") + i) for i in range(1, shingle))]
    grams = [F.when(F.col("pos") + k <= F.size("w"), gram(k, at[:k])) for k in sizes]
    if len(grams) == 1:
        return d.withColumn("gram", grams[0])
    return d.select("doc_id", "text_id", "w", "pos", F.explode(F.array(*grams)).alias("gram"))


def occurrences(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3,
                rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(occurrences (doc_id, text_id, start, size, win), windows by item)."""
    by_item, shingles = item_windows(items, window, shingle)
    shingles = keep(shingles, "benchmark-shingles")
    sizes = [r["k"] for r in shingles.select("k").distinct().orderBy("k").collect()]  # at most ``shingle`` numbers
    if not sizes:
        none = docs.select("doc_id", F.lit(0).cast("long").alias("text_id"), F.lit(0).alias("start"), F.lit(0).alias("size"),
                           F.array(F.lit("")).alias("win")).where(F.lit(False))
        return none, by_item
    found = spots(docs, sizes, shingle)
    counts = [found.select("gram").join(F.broadcast(part), "gram").groupBy("gram").count()
              for part in slices(shingles.select("gram").distinct(), "gram", rows)]
    rarity = keep(reduce(DataFrame.unionAll, counts), "benchmark-rarity")
    ranked = shingles.join(rarity, "gram", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    prefix = (ranked.groupBy("size", "win").agg(F.min(F.struct("count", "off", "gram")).alias("first"))
              .where(F.col("first.count") > 0).select("size", "win", "first.off", "first.gram"))
    prefix = keep(prefix, "benchmark-prefix")
    start = F.col("pos") - F.col("off")
    in_bounds = (start >= 0) & (start + F.col("size") <= F.size("w"))
    same = F.slice("w", F.greatest(start + 1, F.lit(1)), F.col("size")) == F.col("win")
    parts = [found.join(F.broadcast(part), "gram").where(in_bounds & same).select("doc_id", "text_id", start.alias("start"), "size", "win")
             for part in slices(prefix, "gram", rows)]
    return reduce(DataFrame.unionAll, parts), by_item


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 3, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Per row of docs: doc_id, text_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and empty texts have no words and nothing hit; null or repeated
    doc_ids keep a row each (rows are told apart by a hash of their text);
    items without words match nothing, items without id hit words but aren't
    counted; repeated items and ids count once; with no items nothing is hit.
    """
    found, by_item = occurrences(docs, items, window, shingle, rows)
    found = keep(found, "benchmark-occurrences")
    # a document's own occurrences, as many as it has words
    spans = found.groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("s"))
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    n_hit = F.aggregate("s", zero, lambda a, x: F.struct(
        F.greatest(a["end"], x["start"] + x["size"]).alias("end"),
        (a["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(a["end"], x["start"]))).alias("n")), lambda a: a["n"])
    hit = spans.select("doc_id", "text_id", n_hit.alias("n_hit"))
    ids = (found.select("doc_id", "text_id", "size", "win").distinct().join(by_item.distinct(), ["size", "win"])
           .groupBy("doc_id", "text_id").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("ids")))
    per_doc = hit.join(ids, (hit.doc_id.eqNullSafe(ids.doc_id)) & (hit.text_id == ids.text_id), "left").select(hit.doc_id, hit.text_id, "n_hit", "ids")
    d = docs.select("doc_id", text_id().alias("text_id"),
                    F.size(words(lower_ascii(F.col("text")), GAP)).cast("long").alias("n_words")).alias("d")
    p = per_doc.alias("p")
    none = F.array().cast("array<string>")
    return (d.join(p, F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d.text_id") == F.col("p.text_id")), "left")
            .select("d.doc_id", "d.text_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.size(F.coalesce("ids", none)).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.coalesce("ids", none), ",").cast("binary"), 256).alias("items_sha256"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))
