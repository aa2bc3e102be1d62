"""Benchmark windows in documents against brute force."""

import hashlib
import random
import re

import pytest

from conftest import SF0001
from sluice.llm.decontaminate import decontaminate
from sqlcheck import matches_sql

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, window=10):
    out = []
    found = [(i, WORD.findall(ascii_lower(t))) for i, t in items]
    for key, text in docs:
        w, hit, ids = WORD.findall(ascii_lower(text)), set(), set()
        for i, iw in found:
            size = min(window, len(iw))
            wins = {tuple(iw[s:s + size]) for s in range(len(iw) - size + 1)} if iw else set()
            for s in range(len(w) - size + 1):
                if tuple(w[s:s + size]) in wins:
                    hit |= set(range(s, s + size))
                    ids.add(i)
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((key, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def ours(spark, docs, items, **more):
    d = spark.createDataFrame([(*r, "x", "y") for r in docs], "doc_id long, text string, win string, item_id string")
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    got = decontaminate(d, b, **more).drop("text_id").collect()
    return sorted(map(tuple, got), key=repr)


BASE = "one two three four five six seven eight nine ten eleven twelve Thirteen Ünter fourteen"
ITEMS = [(1, BASE), (2, "short item"), (3, "solo"), (4, None), (5, ""), (6, "..!"), (None, "no id at all here"), (7, BASE), (1, "Second text of one"),
         (10, "a a a a a a a a a a a a"), (11, "four five six")]
DOCS = [(1, "x " + BASE + " y"), (2, BASE.upper()), (3, BASE.replace("Ü", "ü")), (4, "One, two; three-four five six seven eight nine (ten) eleven"),
        (5, None), (6, ""), (7, "!!"), (None, "a SHORT Item"), (8, "solo solo, no id at all here"), (9, "a " * 40), (9, "a " * 40), (9, "second text of one"),
        (10, BASE + " " + BASE), (11, "two three four five six seven eight nine ten eleven twelve"), (12, "zz " * 4000 + BASE + " zz" * 4000)]


@pytest.mark.parametrize("rows", [1, 3, 100_000])
def test_equals_brute_force(spark, rows):
    assert ours(spark, DOCS, ITEMS, rows=rows) == brute(DOCS, ITEMS)


def test_random_texts(spark):
    r = random.Random(5)
    items = [(i, " ".join(r.choices("abc", k=r.randint(0, 16)))) for i in range(30)]
    docs = [(i, " ".join(r.choices("abc", k=r.randint(0, 60)))) for i in range(60)]
    assert ours(spark, docs, items, window=5) == brute(docs, items, 5)


def test_empty_tables(spark):
    assert ours(spark, [], ITEMS) == []
    assert ours(spark, DOCS, []) == brute(DOCS, [])
    assert ours(spark, DOCS, [(1, None)]) == brute(DOCS, [])


def test_query_matches_sql(spark):
    assert matches_sql(spark, "op9_decontaminate", SF0001) == 200
