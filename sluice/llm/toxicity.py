"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

Two strings are alike as far as they share character subsequences of length
three, each weighted by ``DECAY`` to the length it spans; gaps and inserted
characters lower a match but don't end it.  The strings are the words of a text
(letters only, between marks of their ends, so ``i.d-i_o t`` is ``idiot``; runs of single letters make one
word; a long word is read in overlapping windows).

The machine learns from sentences and documents that are labelled as a whole:
words that come so much more often in toxic ones that chance can't explain it
start as positives; then, for some rounds, each toxic text gives its worst word
as a positive, if no clean text has it, and each clean text its worst word as a
negative.  Nyström landmarks turn the kernel into features
in which a linear machine is trained.  As every feature is a sum over
subsequences, the trained machine folds into one weight for each subsequence,
and a word is scored without a look at the landmarks.  A document's score is a
logistic function of its worst word and of how many words are toxic.

Learning uses a bounded sample: at most ``TOXIC_ROWS`` and ``CLEAN_ROWS``
labelled rows, those with the smallest hashes of doc_id.  Scoring reads all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import crc32_of, keep, ship

DECAY = 0.5
#: Letters of the alphabet of the machine; rarer ones match nothing.
LETTERS = 45
#: Window and step of the windows in which long words are read.
WIDTH, STEP = 16, 8
#: Landmarks of either kind at most, and the similarity from which a word is none beside another.
LANDMARKS, ALIKE = 300, 0.85
#: Labelled rows from which is learnt, and words for training of either kind.
TOXIC_ROWS, CLEAN_ROWS = 2_000, 8_000
POSITIVES, NEGATIVES = 1_500, 6_000
ROUNDS = 4
RIDGE = 1e-5
#: Margins of words are cut off here; a text without words has the least.
LIMIT = 3.0
#: Words whose margins a Python worker remembers; beyond that it starts anew.
CACHE = 300_000
TOXIC_FROM = 0.7

_NOT_LETTER = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[\W\d_]{1,3}[^\W\d_](?![^\W\d_])){2,}")


def letters(word: str) -> str:
    return word if word.isalpha() else _NOT_LETTER.sub("", word)


def raw_words(text: str | None) -> set[str]:
    """Distinct words of a text in lower case, marks included, and runs of single letters."""
    low = (text or "").lower()
    return {*low.split(), *_SPACED.findall(low)}


def windows(word: str) -> list[str]:
    if len(word) <= WIDTH:
        return [word]
    return [word[i:i + WIDTH] for i in range(0, len(word) - STEP, STEP)]


def encode(words: list[str], code: dict[str, int]) -> np.ndarray:
    """Letters of equally long words between marks of their ends as numbers; 0 is any other letter."""
    get = code.get
    return np.array([[get(c, 0) for c in f"^{w}$"] for w in words], dtype=np.int32).reshape(len(words), -1)


def triples(x: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, float]]:
    """Each subsequence of three as (its number in an alphabet of size letters, weight)."""
    n = x.shape[1]
    for i in range(n - 2):
        for j in range(i + 1, n - 1):
            two = (x[:, i] * size + x[:, j]) * size
            for k in range(j + 1, n):
                yield two + x[:, k], DECAY ** (k - i + 1)


def self_kernel(x: np.ndarray) -> np.ndarray:
    """k(s, s): pairs of equal letters, joined to longer ones over decaying gaps on both sides."""
    n, size = x.shape
    same = ((x[:, :, None] == x[:, None, :]) & (x[:, :, None] > 0)).astype(np.float32) * DECAY ** 2
    gap = np.array([[DECAY ** (i - j - 1) if j < i else 0 for j in range(size)] for i in range(size)], dtype=np.float32)
    d = same
    for _ in range(2):
        right = (d.reshape(-1, size) @ gap.T).reshape(n, size, size)
        both = (right.transpose(0, 2, 1).reshape(-1, size) @ gap.T).reshape(n, size, size).transpose(0, 2, 1)
        d = same * both
    return d.reshape(n, -1).sum(axis=1)


def by_length(words: Iterable[str]) -> Iterator[list[str]]:
    """Batches of equally long words of three letters or more."""
    groups: dict[int, list[str]] = {}
    for w in words:
        if len(w) >= 3:
            groups.setdefault(len(w), []).append(w)
    for ws in groups.values():
        for i in range(0, len(ws), 8192):
            yield ws[i:i + 8192]


class Machine:
    """The folded machine: margin(s) = sum of weights over subsequences / sqrt(k(s, s)) + bias."""

    def __init__(self, code: dict[str, int], weight: np.ndarray, bias: float, link: tuple[float, float, float] = (0.0, 1.0, 0.0)):
        self.code, self.weight, self.bias, self.link = code, weight, bias, link
        self.seen: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "seen": {}}

    def margins(self, words: Iterable[str]) -> dict[str, float]:
        out, size = {}, len(self.code) + 1
        for ws in by_length(words):
            x = encode(ws, self.code)
            total = np.zeros(len(ws), np.float32)
            for at, w in triples(x, size):
                total += np.float32(w) * self.weight[at]
            got = total / np.sqrt(np.maximum(self_kernel(x), 1e-12)) + self.bias
            out.update(zip(ws, np.clip(got, -LIMIT, LIMIT).tolist(), strict=True))
        return out

    def learn_words(self, raw: Iterable[str]) -> None:
        """Margins of words not met before."""
        if len(self.seen) >= CACHE:
            self.seen.clear()
        new = {w: windows(letters(w)) for w in raw if w not in self.seen}
        got = self.margins({p for ps in new.values() for p in ps})
        for w, ps in new.items():
            self.seen[w] = max(got.get(p, -LIMIT) for p in ps)

    def document(self, raw: set[str]) -> tuple[float, int, str]:
        """(worst margin, toxic words, worst word) of a text whose words are known."""
        worst, count, word = -LIMIT, 0, ""
        for w in raw:
            m = self.seen[w]
            count += m > 0
            if m > worst or (m == worst and w < word):
                worst, word = m, w
        return worst, count, word

    def score(self, worst: float, count: int) -> float:
        a, b, c = self.link
        return float(1 / (1 + np.exp(-np.clip(a + b * worst + c * np.log1p(count), -30, 30))))


def kernel_to(words: list[str], landmarks: list[str], code: dict[str, int], block: int = 128) -> np.ndarray:
    """Normalised kernel of each word with each landmark; 0 for words under three letters.

    Landmarks are taken ``block`` at a time, which bounds the table of their subsequences.
    """
    out = np.zeros((len(words), len(landmarks)), np.float32)
    where = {w: i for i, w in enumerate(words)}
    groups = [(ws, x, np.sqrt(np.maximum(self_kernel(x), 1e-12))[:, None]) for ws in by_length(dict.fromkeys(words)) for x in [encode(ws, code)]]
    for first in range(0, len(landmarks), block):
        place, table = _subsequences(landmarks[first:first + block], code)
        for ws, x, norm in groups:
            k = np.zeros((len(ws), table.shape[1]), np.float32)
            for at, w in triples(x, len(code) + 1):
                k += np.float32(w) * table[place[at]]
            out[[where[w] for w in ws], first:first + block] = k / norm
    return out


def _subsequences(landmarks: list[str], code: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(row of each subsequence, table of their weights in each landmark); row 0 is for those of none."""
    size = len(code) + 1
    parts, number = [], {w: i for i, w in enumerate(landmarks)}
    for ws in by_length(landmarks):
        x = encode(ws, code)
        rows = np.array([number[w] for w in ws])
        norm = np.sqrt(np.maximum(self_kernel(x), 1e-12))
        for at, w in triples(x, size):
            parts.append((at, rows, w / norm))
    place = np.zeros(size ** 3, np.int32)
    if not parts:
        return place, np.zeros((1, len(landmarks)), np.float32)
    at, col, val = (np.concatenate([p[i] for p in parts]) for i in range(3))
    known = np.unique(at)
    known = known[(known // size ** 2 > 0) & (known // size % size > 0) & (known % size > 0)]
    place[known] = np.arange(1, len(known) + 1)
    table = np.zeros((len(known) + 1, len(landmarks)), np.float32)
    np.add.at(table, (place[at], col), val)
    table[0] = 0
    return place, table


def spread(words: list[str], code: dict[str, int], most: int) -> list[str]:
    """The first words that aren't alike."""
    words = words[:2 * most]
    k, out = kernel_to(words, words, code), []
    for i in range(len(words)):
        if len(out) < most and (not out or k[i, out].max() < ALIKE):
            out.append(i)
    return [words[i] for i in out]


def squared_hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1000.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps on those within the margin."""
    n = z.shape[1] + 1
    w = np.zeros(n)
    keep_small = np.eye(n)
    keep_small[-1, -1] = 1e-6
    for _ in range(30):
        inside = np.flatnonzero(y * (z @ w[:-1].astype(z.dtype) + w[-1]) < 1)
        left, right = keep_small / cost, np.zeros(n)
        for a in range(0, len(inside), 2048):
            rows = inside[a:a + 2048]
            x = np.hstack([z[rows], np.ones((len(rows), 1))]).astype(np.float64)
            each = x * weight[rows, None]
            left, right = left + x.T @ each, right + each.T @ y[rows]
        new = np.linalg.solve(left, right)
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    return w


def parts_of(words: dict[str, float], stretch: bool) -> dict[str, float]:
    """The windows of words with their weights, weightiest first; stretched ones have a letter inserted."""
    out: dict[str, float] = {}
    for w, much in sorted(words.items(), key=lambda x: (-x[1], x[0])):
        more = [w[:len(w) // 2] + "x" + w[len(w) // 2:]] if stretch and 3 <= len(w) < WIDTH else []
        for p in [*windows(w), *more]:
            if len(p) >= 3:
                out.setdefault(p, much)
    return out


def train_words(toxic: dict[str, float], clean: dict[str, float]) -> Machine:
    """The folded machine of toxic and clean words with their weights."""
    toxic = parts_of(toxic, True)
    clean = {p: much for p, much in parts_of(clean, False).items() if p not in toxic}
    positive, negative = list(toxic), list(clean)
    count: dict[str, int] = {}
    for w in [*positive, *negative]:
        for c in w:
            count[c] = count.get(c, 0) + 1
    code = {c: i + 1 for i, c in enumerate(["^", "$", *sorted(count, key=lambda c: (-count[c], c))[:LETTERS]])}
    size = len(code) + 1
    if not positive or not negative:
        return Machine(code, np.zeros(size ** 3, np.float32), -1.0)
    marks = spread(positive, code, LANDMARKS) + spread(negative, code, LANDMARKS)
    words = positive + negative
    k = kernel_to(words, marks, code)
    base = kernel_to(marks, marks, code).astype(np.float64)
    values, vectors = np.linalg.eigh((base + base.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 0) + RIDGE) @ vectors.T
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    p, n = (np.array(list(x.values())) for x in (toxic, clean))
    each = np.r_[p / p.sum(), n / n.sum()] * len(y) / 2
    k = k @ root.astype(np.float32)
    w = squared_hinge(k, y, each)
    alpha = root @ w[:-1]
    weight = np.zeros(size ** 3, np.float32)
    for ws in by_length(marks):
        x = encode(ws, code)
        share = alpha[[marks.index(m) for m in ws]] / np.sqrt(np.maximum(self_kernel(x), 1e-12))
        for at, decay in triples(x, size):
            real = (at // size ** 2 > 0) & (at // size % size > 0) & (at % size > 0)
            np.add.at(weight, at[real], (decay * share)[real])
    return Machine(code, weight, float(w[-1]))


def fit_link(worst: np.ndarray, count: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of labels on (worst margin, log of 1 + toxic words)."""
    x = np.c_[np.ones(len(worst)), worst, np.log1p(count)]
    b = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag([0.01, 0.01, 0.01])
        step = np.linalg.solve(h, x.T @ (toxic - p) - 0.01 * b)
        b += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(b.tolist())


def _scored(docs: DataFrame, machine: Machine, extra: str = "") -> DataFrame:
    """docs (doc_id, text, more columns of type long) with worst, toxic_words, word and score."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [raw_words(t.as_py()) for t in part.column(1)]
                m.learn_words(set().union(*found))
                worst, count, word = zip(*(m.document(f) for f in found), strict=True)
                out = {n: part.column(i) for i, n in enumerate(part.schema.names) if i != 1}
                yield pa.RecordBatch.from_pydict({**out, "worst": pa.array(worst, pa.float64()), "toxic_words": pa.array(count, pa.int64()), "word": word,
                                                  "score": pa.array([m.score(a, b) for a, b in zip(worst, count, strict=True)], pa.float64())})

    return docs.mapInArrow(score, f"doc_id long{extra}, worst double, toxic_words long, word string, score double")


def words_of(sample: DataFrame) -> DataFrame:
    """(word, toxic) once for each text and word."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                ws = sorted({letters(w) for w in raw_words(text.as_py())} - {""})
                yield pa.RecordBatch.from_pydict({"word": pa.array(ws, pa.string()), "toxic": pa.array([toxic] * len(ws), pa.int64())})

    return sample.select("text", "toxic").mapInArrow(split, "word string, toxic long")


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(doc_id, text, toxic) of the bounded sample of labelled rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    known = known.where(usable & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS).unionAll(known.where("toxic = 0").orderBy(*order).limit(CLEAN_ROWS))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # TOXIC_ROWS + CLEAN_ROWS rows of two numbers at most
    return rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")


def train(docs: DataFrame, labels: DataFrame, usable: Column) -> Machine:
    """Learn from the labelled rows for which ``usable`` holds."""
    spark = docs.sparkSession
    ship(spark)
    sample = keep(training_rows(docs, labels, usable), "toxicity-sample")
    sums = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = max(sums.get(1, 0), 1), max(sums.get(0, 0), 1)
    counts = keep(words_of(sample).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
                  .where(F.length("word") >= 3), "toxicity-words")
    lift = (F.col("t") / n_toxic) / ((F.col("c") + 0.5) / n_clean)
    # by chance alone a word of t texts has them all among the toxic with the t-th power of their share
    chance = F.pow(F.lit(n_toxic / (n_toxic + n_clean)), "t") * F.pow(F.lit(2.0), F.col("c") * 2)
    head = counts.where((F.col("t") >= 3) & (lift > 5) & (chance * max(counts.count(), 1) < 1)).orderBy(F.desc("t"), "word").limit(POSITIVES).collect()
    clean = counts.where((F.col("c") >= 1) & (lift < 2))
    common = clean.orderBy(F.desc("c"), "word").limit(NEGATIVES // 2).collect()
    mixed = clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVES // 2).collect()
    positive, negative = ({r["word"]: r[n] ** 0.5 for r in rows} for rows, n in ((head, "t"), ([*common, *mixed], "c")))
    machine = train_words(positive, negative)
    for turn in range(ROUNDS):
        # a row for each row of the sample
        top = _scored(sample.select("doc_id", "text", "toxic"), machine, ", toxic long").select("toxic", "worst", "toxic_words", "word").collect()
        if turn == ROUNDS - 1:
            break
        hard = {letters(r["word"]) for r in top if r["toxic"] == 0}
        asked = hard | {letters(r["word"]) for r in top if r["toxic"] == 1 and r["worst"] > 0}
        asked = spark.createDataFrame([(w,) for w in sorted(asked)], "word string")  # a word for each row of the sample
        found = counts.join(F.broadcast(asked), "word").collect()
        positive |= {r["word"]: r["t"] ** 0.5 for r in found if r["c"] == 0 and r["t"] > 1}
        negative |= {r["word"]: max(2 * r["c"] ** 0.5, negative.get(r["word"], 0)) for r in found if r["word"] in hard}
        positive = {w: much for w, much in positive.items() if w not in negative}
        machine = train_words(positive, negative)
    a = np.array([[r["worst"], r["toxic_words"], r["toxic"]] for r in top], dtype=np.float64).reshape(-1, 3)
    machine.link = fit_link(a[:, 0], a[:, 1], a[:, 2]) if len(a) and 0 < a[:, 2].sum() < len(a) else (-2.0, 1.0, 0.0)
    return machine


def toxicity(docs: DataFrame, machine: Machine, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """(doc_id, score, predicted, word) for each row of docs; ``word`` is the worst one.

    Null and empty texts have the score of a text without words; null and
    repeated ids and rows keep a row each; other columns are ignored.  Without
    labels of both kinds every text has the same middling score under the bar.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _scored(rows, machine).select("doc_id", "score", (F.col("score") >= toxic_from).cast("int").alias("predicted"), "word")


def without_toxic(docs: DataFrame, machine: Machine, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """docs, with all columns, but for the rows whose score reaches the bar."""
    ship(docs.sparkSession)
    model, place = docs.sparkSession.sparkContext.broadcast(machine), docs.columns.index("text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [raw_words(t.as_py()) for t in part.column(place)]
                m.learn_words(set().union(*found))
                yield part.filter(pa.array([m.score(*m.document(f)[:2]) < toxic_from for f in found]))

    return docs.mapInArrow(choose, docs.schema)


def held_out(column: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(crc32_of(column) % 3 == 1, F.lit(False))
