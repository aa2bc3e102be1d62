"""Collocations against counts in dicts, and their SQL."""

import random
import re
from collections import Counter

from conftest import SF001
from sqlcheck import matches_sql

from sluice.llm.collocations import collocations

SCHEMA = "lang string, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, most, least, share, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = {(lang, w[i:i + m]) for (lang, w), b in found.items() for m in range(2, len(w)) for i in range(len(w) - m + 1) if 100 * b >= share * f[lang, w[i:i + m]]}
    out = {}
    for (lang, w), a in found.items():
        if (lang, w) not in gone:
            score, _, left, right = min((1_000_000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for i, (s, a, p, x, y) in enumerate(sorted(v)[:top]))


def ours(spark, rows, **args):
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], f"{SCHEMA}, word string, key int, n long").repartition(4)
    return sorted(map(tuple, collocations(df, **args).collect()))


def texts(seed, n):
    rng = random.Random(seed)
    common = "the The of und Über ☃ a_b x-1 \x0bq".split(" ")
    fixed = ["new york city", "New York", "of the people", "à la carte", "a a a a a"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(common) for _ in range(rng.randint(0, 25))]
        out.append((rng.choice(["en", "fr", None, "", "und"]), "".join(p + rng.choice([" ", "\t", "  ", ". ", "\n", ", "] if rng.random() < 0.2 else [" "]) for p in parts)))
    return out


def test_against_counts(spark):
    rows = [*texts(3, 150), (None, None), ("en", None), ("de", ""), ("de", " .\n "), ("es", "one two")]
    for args in ({"most": 3, "least": 3, "share": 50, "top": 2000}, {"most": 4, "least": 2, "share": 90, "top": 7}, {"most": 2, "least": 5, "share": 50, "top": 1}):
        want = brute(rows, **args)
        assert len(want) >= 4
        assert ours(spark, rows, most_words=args["most"], least=args["least"], share=args["share"], top=args["top"]) == want


def test_repeats_long_texts_ties_and_empty_tables(spark):
    long = "lorem ipsum " * 60_000
    rows = [("en", long), ("en", "B c. b C. d e! d e")] * 5
    got = ours(spark, rows, most_words=3, least=10, share=101)
    assert got == brute(rows, 3, 10, 101, 2000)
    assert [r[2] for r in got if r[7] == 1_000_000] == ["lorem ipsum", "b c", "d e"]
    assert ours(spark, [("en", "a b c")]) == []
    assert collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations(spark.createDataFrame([], SCHEMA)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_sql(spark):
    assert matches_sql(spark, "op13_collocations", SF001) == 1455
