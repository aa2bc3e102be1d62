"""Masked pseudo-likelihood of documents by a bidirectional window network.

Each token is predicted from its neighbours on both sides, in two factors:
p(class | neighbours) * p(word | class).  A frequent word is a class of its own;
the others share classes by a hash.  The first factor is a network, a hidden layer
over the neighbours' embeddings and a softmax over the classes.  The second is the
word's share of its class in the counts of all words of the corpus, which are a
table as long as its vocabulary and are joined to the documents' words.  A document's
score is the sum of its tokens' conditional log-probabilities.

As the window is one word to either side, the corpus enters training only
through its counts of (left, right, token) classes, which Spark sums over all
documents; they are at most ``size ** 3`` numbers, whatever the corpus, and
training in numpy on them is training on every token of the corpus.  For the same
reason the trained network is a table of as many log-probabilities, in which
scoring looks each token up.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep, lower_ascii, ship, words

FREQUENT, BUCKETS = 96, 31
HIDDEN, EPOCHS, RATE = 32, 200, 0.03
#: What each word, and one that was never counted, has in its class besides its count.
SMOOTH = 0.5
#: Distinct words a Python worker remembers; beyond that it starts anew.
CACHE = 1_000_000


class Vocabulary:
    """Word numbers: frequent words, then buckets of others, then the edge mark."""

    def __init__(self, frequent: list[str], buckets: int = BUCKETS):
        self.frequent, self.buckets = list(frequent), buckets
        self.edge = len(self.frequent) + buckets
        self.size = self.edge + 1
        self.seen: dict[bytes, int] = {w.encode(): i for i, w in enumerate(self.frequent)}

    def __getstate__(self):
        return {**self.__dict__, "seen": {w.encode(): i for i, w in enumerate(self.frequent)}}

    def numbers(self, text: str | None) -> np.ndarray:
        get, out = self.seen.get, []
        for w in (text or "").encode("utf-8", "surrogatepass").lower().split():
            i = get(w)
            if i is None:
                if len(self.seen) >= CACHE:
                    self.seen = {w.encode(): i for i, w in enumerate(self.frequent)}
                    get = self.seen.get
                i = self.seen[w] = len(self.frequent) + zlib.crc32(w) % self.buckets
            out.append(i)
        return np.array(out, dtype=np.int64)

    def shared(self, text: str | None, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash, times) of the distinct words that share their class with others; t are the text's numbers."""
        w = (text or "").encode("utf-8", "surrogatepass").lower().split()
        found = [xxhash.xxh64_intdigest(w[i], 42) for i in np.flatnonzero(t >= len(self.frequent))]
        return np.unique(np.array(found, np.uint64).view(np.int64), return_counts=True)

    def cells(self, t: np.ndarray) -> np.ndarray:
        """(left, right, token) of each token of a text's numbers as one number."""
        if not len(t):
            return t
        left, right = np.r_[self.edge, t[:-1]], np.r_[t[1:], self.edge]
        return (left * self.size + right) * self.size + t


class WindowNetwork:
    def __init__(self, size: int, hidden: int = HIDDEN, seed: int = 3):
        r = np.random.default_rng(seed)
        self.size = size
        self.p = {"left": r.normal(0, 0.1, (size, hidden)), "right": r.normal(0, 0.1, (size, hidden)), "bias": np.zeros(hidden),
                  "out": r.normal(0, 0.1, (hidden, size)), "out_bias": np.zeros(size)}

    def log_probabilities(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hidden layer, log-probabilities of all tokens) for each pair of neighbours."""
        h = np.tanh(self.p["left"][left] + self.p["right"][right] + self.p["bias"])
        z = h @ self.p["out"] + self.p["out_bias"]
        z -= z.max(axis=1, keepdims=True)
        return h, z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def train(self, counts: np.ndarray, epochs: int = EPOCHS, rate: float = RATE) -> list[float]:
        """Adam on the whole corpus' likelihood; counts[left * size + right, token]."""
        used = np.flatnonzero(counts.sum(axis=1))
        if not len(used):
            return []
        left, right, c = used // self.size, used % self.size, counts[used].astype(np.float64)
        weight, total = c.sum(axis=1, keepdims=True), c.sum()
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        losses = []
        for step in range(1, epochs + 1):
            h, logp = self.log_probabilities(left, right)
            losses.append(float(-(c * logp).sum() / total))
            dz = (weight * np.exp(logp) - c) / total
            dh = (dz @ self.p["out"].T) * (1 - h * h)
            g = {"out": h.T @ dz, "out_bias": dz.sum(axis=0), "bias": dh.sum(axis=0), "left": np.zeros_like(self.p["left"]), "right": np.zeros_like(self.p["right"])}
            np.add.at(g["left"], left, dh)
            np.add.at(g["right"], right, dh)
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-9)
        return losses

    def table(self) -> np.ndarray:
        """log p(token | left, right) at each (left, right, token)."""
        out = np.empty((self.size ** 2, self.size), np.float32)
        for a in range(0, len(out), 4096):
            at = np.arange(a, min(a + 4096, len(out)))
            out[at] = self.log_probabilities(at // self.size, at % self.size)[1]
        return out.reshape(-1)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) over all documents."""
    return keep(docs.select(F.explode(words(lower_ascii(F.col("text")))).alias("word")).groupBy("word").count(), "lm-words")


def vocabulary(counts: DataFrame, frequent: int = FREQUENT, buckets: int = BUCKETS) -> Vocabulary:
    """The most frequent words, ties by the word."""
    return Vocabulary([r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(frequent).collect()], buckets)


def shares(counts: DataFrame, vocab: Vocabulary) -> tuple[DataFrame, dict[int, float]]:
    """(word hash, log p(word | class)) of all words that share a class, and that of a word never counted by class."""
    rest = counts.where(~F.col("word").isin(vocab.frequent)) if vocab.frequent else counts
    rest = rest.select(F.xxhash64("word").alias("h"), (len(vocab.frequent) + F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(vocab.buckets))).cast("int").alias("class"), "count")
    totals = {r["class"]: r["n"] + SMOOTH * (r["v"] + 1) for r in rest.groupBy("class").agg(F.sum("count").alias("n"), F.count("*").alias("v")).collect()}
    none = {c: math.log(SMOOTH / totals.get(c, SMOOTH)) for c in range(len(vocab.frequent), vocab.edge)}
    total = F.element_at(F.create_map(*[F.lit(x) for c in none for x in (c, float(totals.get(c, SMOOTH)))]), F.col("class"))
    return rest.groupBy("h", "class").agg(F.sum("count").alias("count")).select("h", F.log((F.col("count") + SMOOTH) / total).alias("log_share")), none


def count_windows(docs: DataFrame, vocab: Vocabulary) -> np.ndarray:
    """counts[left * size + right, token] over all documents."""
    known, cells = docs.sparkSession.sparkContext.broadcast(vocab), vocab.size ** 3

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, total = known.value, np.zeros(cells, np.int64)
        for batch in batches:
            for text in batch.column(0):
                at, n = np.unique(v.cells(v.numbers(text.as_py())), return_counts=True)
                total[at] += n
        at = np.flatnonzero(total)
        for a in range(0, len(at), 100_000):
            yield pa.RecordBatch.from_pydict({"cell": pa.array(at[a:a + 100_000], pa.int64()), "n": pa.array(total[at[a:a + 100_000]], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = rows.toArrow()  # at most size ** 3 rows
    out = np.zeros(cells, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(-1, vocab.size)


def train(docs: DataFrame, frequent: int = FREQUENT, buckets: int = BUCKETS) -> tuple[Vocabulary, WindowNetwork, DataFrame]:
    """Vocabulary, network and word counts of a corpus."""
    ship(docs.sparkSession)
    counts = word_counts(docs)
    vocab = vocabulary(counts, frequent, buckets)
    network = WindowNetwork(vocab.size)
    network.train(count_windows(docs, vocab))
    return vocab, network, counts


def score(docs: DataFrame, vocab: Vocabulary, network: WindowNetwork, counts: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, log_prob, mean_log_prob) for each row of docs.

    Null and empty texts have no tokens, log_prob 0 and no mean; words that the
    counts don't have get SMOOTH in their class; repeated rows and null ids keep
    a row each; without rows the result is empty; other columns are ignored.
    Texts count whole, however long.
    """
    spark = docs.sparkSession
    ship(spark)
    table, none = shares(counts, vocab)
    model = spark.sparkContext.broadcast((vocab, network.table()))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, log_prob = model.value
        for batch in batches:
            n, total, hashes, times = [], [], [], []
            for text in batch.column(1):
                t = v.numbers(text.as_py())
                n.append(len(t))
                total.append(float(log_prob[v.cells(t)].sum(dtype=np.float64)))
                h, k = v.shared(text.as_py(), t)
                hashes.append(h)
                times.append(k)
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (hashes, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(total, pa.float64()), *lists], names=["doc_id", "n_tokens", "class_log_prob", "hashes", "times"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(look_up, "doc_id long, n_tokens long, class_log_prob double, hashes array<long>, times array<long>")
    rows = keep(rows.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    word = rows.select("row", F.explode(F.arrays_zip("hashes", "times")).alias("w")).select("row", F.col("w.hashes").alias("h"), F.col("w.times").alias("times"))
    # a word that was never counted: the mean over classes of what it would get
    unseen = F.lit(sum(none.values()) / max(1, len(none)))
    of_row = word.join(table, "h", "left").groupBy("row").agg(F.sum(F.col("times") * F.coalesce("log_share", unseen)).alias("word_log_prob"))
    out = rows.drop("hashes", "times").join(of_row, "row", "left")
    out = out.select("doc_id", "n_tokens", (F.col("class_log_prob") + F.coalesce("word_log_prob", F.lit(0.0))).alias("log_prob"))
    return out.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))


def pseudo_likelihood(docs: DataFrame) -> DataFrame:
    return score(docs, *train(docs))
