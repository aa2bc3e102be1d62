"""Substring dedup against every window of every text, and its SQL."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from conftest import SF001
from sqlcheck import matches_sql

from sluice.llm.substring_dedup import Words, substring_dedup

SCHEMA = "doc_id long, text string"


def brute(rows, length):
    """{(doc_id, text): (words, removed, text left, longest repeat)}, rows without id last."""
    first, count, words = {}, {}, {}
    for row in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        w = words[row] = (row[1] or "").encode().split()
        for n in range(length, len(w) + 1):
            for p in range(len(w) - n + 1):
                k = tuple(w[p:p + n])
                first.setdefault(k, (row, p))
                count[k] = count.get(k, 0) + 1
    out = {}
    for row, w in words.items():
        gone = set()
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] != (row, p):
                gone.update(range(p, p + length))
        longest = max((n for n in range(length, len(w) + 1) for p in range(len(w) - n + 1) if count.get(tuple(w[p:p + n]), 0) > 1), default=0)
        out[row] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode(), longest)
    return out


def check(spark, rows, length):
    df = spark.createDataFrame(rows, SCHEMA)
    got = substring_dedup(df, length).collect()
    assert len(got) == len(rows)
    want = brute(rows, length)
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["text"], r["n_words"], r["n_removed"]), []).append(r["longest"])
    texts = {}
    for (d, t), (n, gone, left, longest) in want.items():
        texts.setdefault((d, left, n, gone), []).append(longest)
    assert by.keys() == texts.keys()
    for k, levels in by.items():
        for level in levels:
            assert any(level <= longest < max(4 * level, 2 * length) for longest in texts[k])
    return want


def test_random_texts_with_shared_passages(spark):
    rng = random.Random(5)
    passages = [" ".join(rng.choice("abcdefgh") + rng.choice("xyz") for _ in range(rng.randint(3, 40))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 4))]
        rows.append((i * 7 % 60, rng.choice([" ", "\n", "\t ", "\x0b"]).join(parts)))
    assert sum(x[1] for x in check(spark, rows, 6).values()) > 200
    check(spark, rows, 20)


def test_one_word_again_and_again(spark):
    check(spark, [(1, "a " * 50), (2, "a " * 11), (3, "b " * 8 + "a " * 8), (4, "a b " * 20)], 8)


def test_nulls_ties_repeats_and_clashes(spark):
    x = "one two three four five six seven eight"
    rows = [(None, x), (2, x), (2, x), (1, "zero " + x), (3, None), (4, ""), (5, " \n "), (6, "one two"), (None, "zero " + x), (2, "ünï ço dé " * 6)]
    check(spark, rows, 6)
    df = spark.createDataFrame([(7, x, "k", 1, "s", 9), (8, x, "k", 2, "t", 9)], "doc_id long, text string, key string, at long, spans string, longest long")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup(df, 6).collect()}
    assert got == {7: 0, 8: 8}
    assert substring_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(1)
    body = " ".join(f"w{rng.randint(0, 10 ** 6)}" for _ in range(300_000))
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup(spark.createDataFrame([(2, "start " + body), (1, body + " end"), (3, "x" * 3_000_000)], SCHEMA)).collect()}
    assert got == {1: (300_001, 0), 2: (300_001, 300_000), 3: (1, 0)}


def test_hashes_of_words_do_not_depend_on_what_lies_around():
    rng = random.Random(2)
    words = [hashlib.md5(str(rng.random()).encode()).hexdigest()[:rng.randint(1, 9)] for _ in range(500)]
    a, b = Words(pa.array([" ".join(words)])), Words(pa.array([None, "\t\n".join(words[100:300]), "", " x"]))
    assert (a.hashes(np.arange(100, 280), 20) == b.hashes(np.arange(0, 180), 20)).all()
    assert b.n == 201 and b.first.tolist() == [0, 0, 200, 200, 201]


def test_sql(spark):
    assert matches_sql(spark, "op11_substring_dedup", SF001) == 1000
