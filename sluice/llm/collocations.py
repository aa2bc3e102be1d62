"""Phrase collocations by set-oriented mining of sorted occurrence relations.

The occurrences of phrases of k words are a relation (piece, position, words),
persisted in order of piece and position, some texts to a row.  It is merge-joined
with itself on the piece and the adjacent position to get the occurrences of k + 1
words, which are counted by groups; the frequent groups' phrases are found by a
semi-join of the joined relation, which is persisted before the next length.  Texts
are never cut or shuffled, so that the join meets sorted columns side by side; what
is shuffled are counts.  The semi-join goes through a filter of the frequent groups
that all tasks hold: what it lets through wrongly is dropped with the next counts.
Phrases are told apart by 64-bit hashes; with each count comes one of the blocks that
hold the phrase, and that block alone tells its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import LOWER, UPPER, keep, ship
from sluice.llm.sequences import BASE, U, Words, bits_of, mix, passes, signed, small_batches

#: What ends a piece, and white space between its words; in bytes, all of ASCII.
STOPS, GAPS = ".,;:!?\n\x0b\x0c\r", " \t"
_MAP = bytes.maketrans((UPPER + STOPS + GAPS).encode(), (LOWER + "\n" * len(STOPS) + " " * len(GAPS)).encode())
#: Language of texts that name none.
UNKNOWN = "und"
#: Words a task remembers to have spelt; beyond that it starts anew.
SEEN = 1_000_000
#: Parts in which a language's phrases are ranked before they meet.
SALTS = 64

ROWS = "block long, lang string, size long, columns binary, key long, phrase array<long>"
_ROWS = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("columns", pa.binary()), ("key", pa.int64()), ("phrase", pa.list_(pa.int64()))])


class Pieces(Words):
    """Words of some texts with their language's, piece and position; pieces of different texts differ."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        super().__init__(pa.array([None if x is None else x.encode("utf-8", "surrogatepass").translate(_MAP) for x in texts.to_pylist()], pa.large_binary()))
        self.langs = langs.to_pylist()
        salt = np.array([xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) for x in self.langs], U)
        self.words = mix(self.hashes(np.arange(self.n), 1) + salt[self.text]) if self.n else np.zeros(0, U)
        self.piece = (np.cumsum(self.data == 10)[self.start] + self.text).astype(np.int32)
        opens = np.flatnonzero(np.diff(self.piece, prepend=-1))
        self.spot = (np.arange(self.n) - np.repeat(opens, np.diff(opens, append=self.n))).astype(np.int32)

    def word(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().decode("utf-8", "replace")


def phrase_key(words: list[np.ndarray]) -> np.ndarray:
    """Of the sequences in columns of word hashes; a word's is itself."""
    return reduce(lambda key, w: mix(key * U(BASE) + w), words)


COUNTS = "key long, lang string, n long, block long"


def counted(keys: np.ndarray, block: int = 0) -> pa.RecordBatch:
    k, n = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([signed(k), pa.nulls(len(k), pa.string()), pa.array(n, pa.int64()), pa.array(np.full(len(k), block))], names=["key", "lang", "n", "block"])


def _relation(lang: str, piece: np.ndarray, spot: np.ndarray, words: list[np.ndarray], block: int | None = None) -> pa.RecordBatch:
    """One row that holds occurrences: their columns, pieces and positions as differences, compressed together."""
    steps = [np.diff(x, prepend=np.int32(0)) for x in (piece, spot)]
    raw = b"".join(x.tobytes() for x in (*steps, *words))
    block = xxhash.xxh3_64_intdigest(raw) - (1 << 63) if block is None else block
    values = (block, lang, len(piece), pa.compress(raw, codec="zstd", asbytes=True), None, None)
    return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _ROWS.types, strict=True)], schema=_ROWS)


def _occurrences(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int, str, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """The rows' block, language and columns, of phrases of k words."""
    for batch in batches:
        for block, lang, n, packed in zip(*(batch.column(c) for c in ("block", "lang", "size", "columns")), strict=True):
            n = n.as_py()
            raw = pa.decompress(packed.as_buffer(), decompressed_size=n * 8 * (k + 1), codec="zstd") if n else b""
            piece, spot = (np.cumsum(np.frombuffer(raw, np.int32, n, i * 4 * n), dtype=np.int32) for i in (0, 1))
            yield block.as_py(), lang.as_py(), piece, spot, [np.frombuffer(raw, U, n, 8 * n * (i + 1)) for i in range(k)]


def joined(piece: np.ndarray, spot: np.ndarray, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Occurrences of one word more: a merge join on the piece and the adjacent position of the sorted relation with itself."""
    at = np.flatnonzero((piece[1:] == piece[:-1]) & (spot[1:] == spot[:-1] + 1))
    return piece[at], spot[at], [*(w[at] for w in words), words[-1][at + 1]]


def _count_words(docs: DataFrame) -> DataFrame:
    """(key, lang, n): occurrences of words, and under a null key of all words of a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            p = Pieces(batch.column("text"), batch.column("lang"))
            yield counted(p.words)
            of = {}
            for lang, n in zip(p.langs, np.diff(p.first).tolist(), strict=True):
                of[lang] = of.get(lang, 0) + n
            yield pa.RecordBatch.from_arrays([pa.nulls(len(of), pa.int64()), pa.array(of.keys(), pa.string()), pa.array(of.values(), pa.int64()), pa.nulls(len(of), pa.int64())],
                                             names=["key", "lang", "n", "block"])

    return docs.mapInArrow(count, COUNTS).groupBy("key", "lang").agg(F.sum("n").alias("n"))


def _words(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """The relation of frequent words; a row holds those of some texts of one language."""
    known = docs.sparkSession.sparkContext.broadcast(bits)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            p = Pieces(batch.column("text"), batch.column("lang"))
            on, langs = passes(known.value, p.words), np.array(p.langs, object)
            for lang in dict.fromkeys(p.langs):
                at = np.flatnonzero(on & (langs == lang)[p.text])
                yield _relation(lang, p.piece[at], p.spot[at], [p.words[at]])

    return docs.mapInArrow(find, ROWS)


def _count_longer(relation: DataFrame, k: int) -> DataFrame:
    """(key, n, block): occurrences of phrases of one word more, and the least of the blocks that hold them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, *row in _occurrences(batches, k):
            yield counted(phrase_key(joined(*row)[2]), block)

    return relation.mapInArrow(count, COUNTS).groupBy("key").agg(F.sum("n").alias("n"), F.min("block").alias("block"))


def at_block(key: np.ndarray, block: int) -> np.ndarray:
    return mix(key + np.full(1, block, np.int64).view(U) * U(BASE))


def _at_block(counts: DataFrame) -> DataFrame:
    """The counts' keys, each with its block, as hashes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, block = (batch.column(c).to_numpy().view(U) for c in ("key", "block"))
            yield pa.RecordBatch.from_arrays([signed(mix(key + block * U(BASE)))], names=["key"])

    return counts.select("key", "block").mapInArrow(find, "key long")


def _longer(relation: DataFrame, k: int, bits: np.ndarray, told: np.ndarray, last: bool) -> DataFrame:
    """The relation of frequent phrases of one word more (not if ``last``), and rows (key, lang, phrase) that tell the
    words of those that this block is to tell."""
    known, telling = (relation.sparkSession.sparkContext.broadcast(x) for x in (bits, told))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lang, *row in _occurrences(batches, k):
            piece, spot, words = joined(*row)
            key = phrase_key(words)
            at = np.flatnonzero(passes(known.value, key))
            key, words = key[at], [w[at] for w in words]
            if not last:
                yield _relation(lang, piece[at], spot[at], words, block)
            new = np.unique(key, return_index=True)[1]
            new = new[passes(telling.value, at_block(key[new], block))]
            phrase = pa.array(list(np.stack([w[new] for w in words], 1).view(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.nulls(len(new), pa.int64()), pa.array([lang] * len(new), pa.string()), *(pa.nulls(len(new), t) for t in _ROWS.types[2:4]),
                                              signed(key[new]), phrase], schema=_ROWS)

    return relation.mapInArrow(find, ROWS)


def _cut(phrases: DataFrame) -> DataFrame:
    """(key, lang, phrase, n, parts, inner): the keys of the parts that cuts leave (first and rest, by cut) and those of
    shorter phrases inside."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("phrase")
            lengths = np.diff(lists.offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            for k in np.unique(lengths):
                some = batch.filter(pa.array(lengths == k))
                words = list(np.stack(some.column("phrase").to_numpy(zero_copy_only=False)).view(U).T)
                parts = [phrase_key(x) for cut in range(1, k) for x in (words[:cut], words[cut:])]
                inner = [phrase_key(words[i:i + m]) for m in range(2, k) for i in range(k - m + 1)]
                more = [pa.array(list(np.stack(x, 1).view(np.int64)) if x else [[]] * some.num_rows, pa.list_(pa.int64())) for x in (parts, inner)]
                yield pa.RecordBatch.from_arrays([*some.columns, *more], names=[*some.schema.names, "parts", "inner"])

    return phrases.select("key", "lang", "phrase", "n").mapInArrow(find, "key long, lang string, phrase array<long>, n long, parts array<long>, inner array<long>")


def _spelt(docs: DataFrame, bits: np.ndarray) -> DataFrame:
    """(key, word) of the words that the filter lets through, at least."""
    known = docs.sparkSession.sparkContext.broadcast(bits)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in small_batches(batches):
            p = Pieces(batch.column("text"), batch.column("lang"))
            keys, at = np.unique(p.words, return_index=True)
            on = passes(known.value, keys)
            new = [(k, p.word(i)) for k, i in zip(keys[on].view(np.int64).tolist(), at[on].tolist(), strict=True) if k not in seen]
            if len(seen) > SEEN:
                seen.clear()
            seen.update(k for k, _ in new)
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in new], pa.int64()), pa.array([w for _, w in new], pa.string())], names=["key", "word"])

    return docs.mapInArrow(find, "key long, word string")


def collocations(docs: DataFrame, most_words: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of each language of (lang, text).

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and pieces into words at blanks and tabs;
    n is the language's number of words.  Phrases are 2 to ``most_words`` words in a row within a piece that occur
    a >= ``least`` times, overlaps included.  A cut leaves parts that occur l and r times and scores
    floor(1000000 * a * a / (l * r)); the lowest counts, of equal ones the first.  A phrase goes if a longer one that
    contains it has at least ``share`` percent of its occurrences.  Ranks are by score, then a, both descending, then
    the phrase's bytes.

    Null and empty texts have no words; texts without lang are of ``und``.  Repeated rows count each; texts of any
    length count whole; languages without phrases, and empty tables, have no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    words = keep(_count_words(texts).where(f"key is null or n >= {int(least)}"), "phrase-words")
    sizes, often = words.where("key is null").select("lang", F.col("n").alias("total")), words.where("key is not null").select("key", "n")
    relation, counts, found = keep(_words(texts, bits_of(often)), "phrase-relation"), [often], []
    for k in range(2, most_words + 1):
        pairs = relation.where("key is null")
        often = keep(_count_longer(pairs, k - 1).where(f"n >= {int(least)}"), "phrase-counts")
        if often.isEmpty():
            break
        relation = keep(_longer(pairs, k - 1, bits_of(often), bits_of(_at_block(often)), k == most_words), "phrase-relation")
        told = relation.where("key is not null").groupBy("key").agg(F.first("lang").alias("lang"), F.first("phrase").alias("phrase"))
        found.append(keep(_cut(told.join(often, "key")), "phrase-found"))
        counts.append(often.select("key", "n"))
    out = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    if not found:
        return spark.createDataFrame([], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
    phrases, counts = reduce(DataFrame.unionAll, found), keep(reduce(DataFrame.unionAll, counts), "phrase-lengths")
    inside = phrases.select(F.explode("inner").alias("key"), F.col("n").alias("longer")).groupBy("key").agg(F.max("longer").alias("longer"))
    stay = phrases.join(inside, "key", "left").where(F.coalesce(100 * F.col("longer").cast("decimal(30)") < share * F.col("n").cast("decimal(30)"), F.lit(True)))
    both = F.expr("transform(sequence(1, size(phrase) - 1), i -> struct(parts[2 * i - 2] as first, parts[2 * i - 1] as rest))")
    cuts = stay.select("key", "lang", "phrase", F.col("n").alias("a"), F.posexplode(both).alias("cut", "part"))
    cuts = keep(cuts.select("key", "lang", "phrase", "a", "cut", "part.first", "part.rest"), "phrase-cuts")
    cuts = cuts.join(counts.select(F.col("key").alias("first"), F.col("n").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("key").alias("rest"), F.col("n").alias("r")), "rest")
    a, l, r = (F.col(c).cast("decimal(18)") for c in "alr")
    cuts = cuts.withColumn("square", F.lit(1_000_000).cast("decimal(7)") * (a * a)).withColumn("product", l * r).withColumn("score", F.expr("square div product"))
    scored = cuts.groupBy("key").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"), *(F.first(c).alias(c) for c in ("lang", "phrase", "a")))
    scored = scored.select("lang", F.col("phrase").alias("words"), "a", "best.score", "best.l", "best.r", F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt"))
    order = [F.desc("score"), F.desc("a")]
    for by in (["lang", "salt"], ["lang"]):  # those that tie with the last stay until their words are known
        scored = scored.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    scored = keep(scored.withColumn("id", F.monotonically_increasing_id()), "phrase-scored")
    wanted = scored.select("id", F.posexplode("words").alias("at", "key"))
    spelt = _spelt(texts, bits_of(keep(wanted.select("key").distinct(), "phrase-wanted"))).distinct()
    spelt = wanted.join(spelt, "key").groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = scored.join(spelt, "id").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(*out[:1], F.col("rank").cast("long").alias("rank"), *out[2:6], F.col("total").alias("n"), "score")
