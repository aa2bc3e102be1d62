"""Window network: gradients, counts and sums against plain Python, held-out order."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from sluice.llm import lm_score as L


def test_counts_and_scores_equal_a_pass_over_the_tokens(spark):
    rows = [(1, "the cat the dog"), (2, ""), (None, None), (3, "one"), (3, "one"), (4, "the " * 20_000 + "É é Cat"), (5, "\x0bthe\x1cdog\n")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, log_prob double").repartition(3)
    vocab, net, counts = L.train(docs, frequent=3, buckets=4)
    assert vocab.frequent == ["the", "cat", "one"]
    told = Counter(w for _, text in rows for w in plain(text))
    in_class = {}
    for w, n in told.items():
        if w not in vocab.frequent:
            in_class.setdefault(3 + zlib.crc32(w.encode()) % 4, {})[w] = n
    want = np.zeros((vocab.size ** 2, vocab.size), np.int64)
    sums = []
    for key, text in rows:
        t = vocab.numbers(text).tolist()
        total = 0.0
        for i, x in enumerate(t):
            left, right = t[i - 1] if i else vocab.edge, t[i + 1] if i + 1 < len(t) else vocab.edge
            want[left * vocab.size + right, x] += 1
            if len(t) < 100:
                total += net.log_probabilities(np.array([left]), np.array([right]))[1][0, x]
                if x >= 3:
                    words = in_class[x]
                    total += math.log((words[plain(text)[i]] + L.SMOOTH) / (sum(words.values()) + L.SMOOTH * (len(words) + 1)))
        sums.append((key, len(t), total))
    assert (L.count_windows(docs, vocab) == want).all()
    got = L.score(docs, vocab, net, counts).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in got), key=repr) == sorted(((k, n) for k, n, _ in sums), key=repr)
    for r in got:
        if r.n_tokens < 100:
            assert any(k == r.doc_id and n == r.n_tokens and abs(s - r.log_prob) < 1e-3 * max(1, n) for k, n, s in sums)
        assert (r.mean_log_prob is None) == (r.n_tokens == 0)


def plain(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def test_gradients_are_those_of_the_likelihood():
    """One step of the optimiser moves every weight against the numeric derivative of the loss."""
    r = np.random.default_rng(4)
    counts = r.integers(0, 5, (16, 4))

    def loss(net):
        used = np.arange(16)
        logp = net.log_probabilities(used // 4, used % 4)[1]
        return -(counts * logp).sum() / counts.sum()

    for name in ("left", "right", "bias", "out", "out_bias"):
        net = L.WindowNetwork(4, hidden=3, seed=9)
        before = {k: v.copy() for k, v in net.p.items()}
        moved = L.WindowNetwork(4, hidden=3, seed=9)
        moved.train(counts, epochs=1, rate=1e-3)
        step = moved.p[name] - before[name]
        numeric = np.zeros_like(before[name])
        for i in np.ndindex(*numeric.shape):
            for sign in (1, -1):
                net.p[name] = before[name].copy()
                net.p[name][i] += sign * 1e-6
                numeric[i] += sign * loss(net) / 2e-6
        # the first step of Adam is the rate in the direction of each gradient
        clear = np.abs(numeric) > 1e-6
        assert clear.any() and (np.sign(step[clear]) == -np.sign(numeric[clear])).all() and np.allclose(np.abs(step[clear]), 1e-3, rtol=1e-2)


def test_words_of_a_class_share_its_probability(spark):
    """Summed over all words, and one that was never counted, the shares of a class are 1."""
    docs = spark.createDataFrame([(1, "a b c d e f g h a b c a a q r s t"), (2, "u v w x y z u v w")], "doc_id long, text string")
    counts = L.word_counts(docs)
    vocab = L.Vocabulary(["a"], buckets=3)
    table, none = L.shares(counts, vocab)
    by = {}
    words = {x.word: x.h for x in counts.selectExpr("word", "xxhash64(word) AS h").collect()}
    log_share = {x.h: x.log_share for x in table.collect()}
    assert words["a"] not in log_share and len(log_share) == len(words) - 1
    for w, h in words.items():
        if w != "a":
            c = 1 + zlib.crc32(w.encode()) % 3
            by[c] = by.get(c, 0) + math.exp(log_share[h])
            assert vocab.shared(w, vocab.numbers(w))[0].tolist() == [h]
    for c, total in by.items():
        assert abs(total + math.exp(none[c]) - 1) < 1e-9


def test_gibberish_scores_below_rare_words(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    vocab, net, counts = L.train(docs)
    rare = [x.word for x in counts.where("count BETWEEN 4 AND 8").orderBy("word").limit(200).collect()]
    made = [f"zq{i}xk" for i in range(200)]
    # the same class and the same neighbours: only the word differs
    pairs = [(a, b) for a in rare for b in made if vocab.numbers(a)[0] == vocab.numbers(b)[0]][:50]
    rows = [(2 * i + j, f"the {w} of") for i, pair in enumerate(pairs) for j, w in enumerate(pair)]
    got = {x.doc_id: x.log_prob for x in L.score(spark.createDataFrame(rows, "doc_id long, text string"), vocab, net, counts).collect()}
    assert len(pairs) == 50 and all(got[2 * i] > got[2 * i + 1] for i in range(50))


def test_training_lowers_the_loss():
    r = np.random.default_rng(1)
    net = L.WindowNetwork(5, hidden=4)
    losses = net.train(r.integers(0, 9, (25, 5)), epochs=60)
    assert losses[-1] < losses[0] and abs(np.exp(net.table().reshape(25, 5)).sum(axis=1) - 1).max() < 1e-4


def test_no_rows(spark):
    assert L.pseudo_likelihood(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_shuffled_words_are_less_likely(spark):
    import random

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    vocab, net, _ = L.train(docs.where("doc_id % 2 = 0"))
    r, scores = random.Random(2), []
    log_prob = net.table()
    for d in docs.where("doc_id % 2 = 1 and n_chars > 1500").limit(60).collect():
        w = d.text.split()
        mixed = r.sample(w, len(w))
        scores.append([log_prob[vocab.cells(vocab.numbers(" ".join(x)))].mean() for x in (w, mixed)])
    assert np.mean([a >= b for a, b in scores]) > 0.5


@pytest.mark.parametrize("text,words", [("A b", 2), (None, 0), (" \n", 0), ("x" * 100_000, 1)])
def test_tokens(text, words):
    v = L.Vocabulary(["a"])
    assert len(v.numbers(text)) == words and (not words or v.numbers(text).max() < v.edge)
