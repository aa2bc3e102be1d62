"""Quality rules as weak supervision.

Each rule looks at a document's measures and votes good (1), bad (0) or
abstains (null).  Expectation-maximisation over the vote patterns of all
documents estimates how often each rule raises a false alarm, how the rules vote
on each kind of bad documents and how common good ones are; a document's
posterior probability of being good then decides, not the agreement of all rules.

The corpus is read once for the measures, which are kept; the patterns are
counted by Spark (at most 3 ** number of rules rows, whatever the corpus), and
only those counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import BLANK, keep, summed, words

#: Signs that the measure n_symbols counts.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Rounds of estimation; it ends earlier when no estimate moves by more than STILL.
ROUNDS, STILL = 100, 1e-9
#: Rates of bad (0), good (1) and no votes (None) to begin with.  On good documents this belief counts
#: as much as all documents do: a rule is taken to be precise until many others contradict it.
EXPECT, STRENGTH = {0: 0.005, 1: 0.4975, None: 0.4975}, 10.0
#: Share of good documents to begin with, and how often a rule finds the defect that it is about.
GOOD, HIT = 0.8, 0.95
KEEP_FROM = 0.5


def share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def vote(good: Column | None, bad: Column) -> Column:
    v = F.when(bad, 0)
    return v if good is None else v.when(good, 1)


def rules() -> dict[str, Column]:
    """Votes over the measures of ``measure``; a rule for one defect abstains where it finds none."""
    symbols, repeats, dup = share("n_symbols", "n_words"), share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines")
    length, upper = share("word_chars", "n_words"), share("n_upper", "word_chars")
    shouts, stops = share("n_shouts", "n_words"), share("n_stops", "n_words")
    long = F.col("n_words") >= 30
    return {
        "symbols": vote(None, long & (symbols > 0.1)),
        "repeats": vote(None, long & (repeats > 0.2)),
        "repeated_lines": vote(None, (F.col("n_lines") >= 3) & (dup > 0.3)),
        "word_length": vote(length.between(3, 9), (length < 2) | (length > 15)),
        "capitals": vote(upper.between(0.002, 0.1), long & (upper > 0.4)),
        "shouting": vote(None, long & (shouts > 0.2)),
        "sentences": vote(stops.between(0.02, 0.3), long & (stops < 0.005)),
        "size": vote(F.col("n_words") >= 50, F.col("n_words") < 5),
    }


def repeated_words(hashes: str) -> Column:
    """Words in windows that occur twice or more, from the windows' sorted (hash, start) pairs."""
    def twice(x: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(hashes, i - 1)["h"])
        return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(F.get(hashes, i + 1)["h"])

    return F.array_sort(F.transform(F.filter(hashes, twice), lambda x: x["at"]))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of each text; a null text is empty."""
    text = F.coalesce("text", F.lit(""))
    has_word = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\x0b\f\r", "")) > 0)
    d = docs.select("doc_id", text.alias("text"))
    d = d.select(
        "doc_id", words(F.col("text")).alias("w"), has_word.alias("lines"),
        F.length(F.translate("text", " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("text") - F.length(F.translate("text", "!", ""))).cast("long").alias("n_shouts"),
        (F.length("text") - F.length(F.translate("text", ".?", ""))).cast("long").alias("n_stops"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))
    plain = ["doc_id", "word_chars", "n_symbols", "n_shouts", "n_stops", "n_upper"]
    d = d.select(*plain, F.size("w").cast("long").alias("n_words"), F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    window = [F.get("w", F.col("i") + k) for k in range(WINDOW)]
    plain += ["n_words", "n_lines", "n_dup_lines"]
    # windows of five word hashes: their positions and hashes, sorted only where some hash comes twice
    first = F.when(F.size("w") >= WINDOW, F.sequence(F.lit(0), F.size("w") - WINDOW)).otherwise(F.array().cast("array<int>"))
    d = d.select(*plain, F.transform(first, lambda i: F.xxhash64(*(F.get("w", i + k) for k in range(len(window))))).alias("g"))
    d = d.select(*plain, F.when(F.size(F.array_distinct("g")) < F.size("g"),
                                F.sort_array(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("at"))))).alias("g"))
    d = d.select(*plain, repeated_words("g").alias("at"))
    # each window covers up to the next one's first word
    covered = F.aggregate(F.transform("at", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - x, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select(*plain, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


class VoteModel:
    """Good documents, and bad ones of as many kinds as there are rules: kind j is what rule j is about.

    ``shares`` says how common each class is (good first) and ``rates[c][j]``
    how often rule j votes bad (0), good (1) or not at all (None) on documents of
    class c.  Rule j finds its own kind at the rate HIT, which says what the
    kind is; all other rates, among them each rule's false alarms on good
    documents, are estimated.
    """

    def __init__(self, shares: Sequence[float], rates: Sequence[Sequence[dict]]):
        self.shares, self.rates = list(shares), [list(r) for r in rates]

    def weights(self) -> list[float]:
        return [math.log(x) for x in self.shares]

    def likelihoods(self, votes: Sequence[int | None]) -> list[float]:
        logs = [w + sum(math.log(r[v]) for r, v in zip(rates, votes, strict=True)) for w, rates in zip(self.weights(), self.rates, strict=True)]
        top = max(logs)
        return [math.exp(x - top) for x in logs]

    def good(self, votes: Sequence[int | None]) -> float:
        got = self.likelihoods(votes)
        return got[0] / sum(got)

    @classmethod
    def fit(cls, patterns: Sequence[tuple[Sequence[int | None], int]], n: int) -> VoteModel:
        """Expectation-maximisation from (votes of n rules, number of documents)."""
        own = {0: HIT, 1: (1 - HIT) / 2, None: (1 - HIT) / 2}
        belief = [max(STRENGTH, sum(count for _, count in patterns)), *[STRENGTH] * n]
        start = [[own if c == j + 1 else EXPECT for j in range(n)] for c in range(n + 1)]
        model = cls([GOOD, *[(1 - GOOD) / max(n, 1)] * n], start)
        for _ in range(ROUNDS):
            sizes = [STRENGTH * GOOD, *[STRENGTH * (1 - GOOD) / max(n, 1)] * n]
            seen = [[{v: weight * x for v, x in EXPECT.items()} for _ in range(n)] for weight in belief]
            for votes, count in patterns:
                got = model.likelihoods(votes)
                total = sum(got)
                for c, x in enumerate(got):
                    sizes[c] += count * x / total
                    for j, v in enumerate(votes):
                        seen[c][j][v] += count * x / total
            rates = [[own if c == j + 1 else {v: x / sum(d.values()) for v, x in d.items()} for j, d in enumerate(row)] for c, row in enumerate(seen)]
            new = cls([x / sum(sizes) for x in sizes], rates)
            moved = max(abs(a - b) for a, b in zip(new.shares, model.shares, strict=True))
            model = new
            if moved < STILL:
                break
        return model

    def posterior(self, votes: Sequence[Column]) -> Column:
        """The probability of being good as an expression over the rules' votes."""
        logs = []
        for w, rates in zip(self.weights(), self.rates, strict=True):
            parts = [F.when(v == 1, math.log(r[1])).when(v == 0, math.log(r[0])).otherwise(math.log(r[None])) for v, r in zip(votes, rates, strict=True)]
            logs.append(summed([F.lit(w), *parts]))
        return 1 / (F.lit(1.0) + summed([F.lit(0.0), *(F.exp(x - logs[0]) for x in logs[1:])]))


def quality(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """Measures, base_failed, posterior and kept for each row of docs.

    Null and empty texts have no words, so they fail the base rule; repeated
    rows and null or repeated ids keep a row each; other columns are ignored; an
    empty table gives no rows.
    """
    votes = rules()
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    d = keep(measure(docs), "quality-measures")
    cast = d.select(*(v.cast("int").alias(k) for k, v in votes.items()))
    patterns = cast.groupBy(*votes).count().orderBy(*votes).collect()  # at most 3 ** rules rows
    model = VoteModel.fit([([r[k] for k in votes], r["count"]) for r in patterns], len(votes))
    scored = d.withColumn("base_failed", failed).withColumn("posterior", model.posterior(list(votes.values())))
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
