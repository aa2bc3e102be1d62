"""Components of n-gram sets against brute force."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF0001
from sluice.llm import jaccard as J
from sqlcheck import matches_sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, num, den):
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(key, ids.get(find(i), key))
    return sorted(((key, len(s), ids.get(find(i)) if s else key) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))), key=repr)


def ours(spark, rows, n, num, den):
    docs = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, id int, tokens string").repartition(3)
    return sorted(map(tuple, J.jaccard_components(docs, n, num, den).drop("text_id").collect()), key=repr)


def corpus(seed, families, copies, edits):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, passage = [], " ".join(r.choices(vocabulary, k=40))
    for _ in range(families):
        base = r.choices(vocabulary, k=r.choice([4, 9, 12, 20, 60, 150, 400]))
        for _ in range(r.randint(1, copies)):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                at = r.randrange(len(w))
                w[at:at + r.randint(0, 1)] = r.choices(vocabulary, k=r.randint(0, 1))
            rows.append(" ".join(w))
    rows += [f"{passage} {' '.join(r.choices(vocabulary, k=12))}" for _ in range(30)]
    r.shuffle(rows)
    return list(enumerate(rows, 100))


EDGE = [(5, ""), (6, None), (7, " \n"), (8, "one"), (9, "ONE"), (10, "two words"), (None, "two words"), (None, None), (3, "two words"), (3, "two words"),
        (3, "other text of the same id"), (12, "É a b"), (13, "é a b"), (14, "É A B"), (None, "only without id " * 5), (20, "long " * 30_000)]


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 8, 10)])
def test_components_equal_brute_force(spark, n, num, den, monkeypatch):
    monkeypatch.setattr(J, "GROUP", 4)
    monkeypatch.setattr(J, "FREQUENT", 10)
    rows = corpus(n, 25, 14, 4) + EDGE
    assert ours(spark, rows, n, num, den) == brute(rows, n, num, den)


def test_large_group_with_links_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(J, "GROUP", 8)
    rows = corpus(11, 2, 60, 9)
    assert ours(spark, rows, 3, 90, 100) == brute(rows, 3, 90, 100)


def test_no_rows(spark):
    assert ours(spark, [], 3, 90, 100) == []
    assert ours(spark, [(1, None), (2, "alone")], 3, 90, 100) == [(1, 0, 1), (2, 1, 2)]


@given(st.integers(1, 120), st.integers(0, 10**6), st.sampled_from([(90, 100), (85, 100), (8, 10), (5, 10)]))
@settings(max_examples=300, deadline=None)
def test_sets_that_link_share_a_signature(size, seed, bar):
    r = np.random.default_rng(seed)
    t = J.Threshold(*bar)
    a = np.unique(r.integers(0, 1 << 62, size).astype(J.U))
    b = a
    for _ in range(40):  # the farthest set that still links
        new = b[r.random(len(b)) > 0.02] if r.random() < 0.5 else np.union1d(b, r.integers(0, 1 << 62, 1).astype(J.U))
        same = np.float64(len(np.intersect1d(a, new)))
        if len(new) and t.links(same, np.float64(len(a)), np.float64(len(new))):
            b = new
    if not np.array_equal(a, b):
        assert set(t.signatures(a).tolist()) & set(t.signatures(b).tolist())


@given(st.integers(1, 200), st.integers(0, 10**6), st.sampled_from([(8, 10), (5, 10), (7, 10)]))
@settings(max_examples=300, deadline=None)
def test_sets_that_link_pass_the_filter_of_repeated_tokens(size, seed, bar):
    r = np.random.default_rng(seed)
    t = J.Threshold(*bar)
    a = np.unique(r.integers(0, 1 << 62, size).astype(J.U))
    b = a
    for _ in range(60):
        new = b[r.random(len(b)) > 0.02] if r.random() < 0.5 else np.union1d(b, r.integers(0, 1 << 62, 1).astype(J.U))
        if len(new) and t.links(np.float64(len(np.intersect1d(a, new))), np.float64(len(a)), np.float64(len(new))):
            b = new
    firsts, n = np.unique(np.concatenate([x[:t.wide(len(x))] for x in (a, b)]), return_counts=True)
    bits = np.zeros(1 << 17, np.uint8)          # wide enough that no other token passes by chance
    spots = firsts[n > 1] & J.U((1 << 20) - 1)
    np.bitwise_or.at(bits, spots >> J.U(3), (128 >> (spots & J.U(7)).astype(np.int64)).astype(np.uint8))
    assert t.may_link(a, bits) and t.may_link(b, bits)


def test_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = dict(map(tuple, J.components(edges).collect()))
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_long_chains_of_ids_in_any_order_become_one_component(spark):
    ids = random.Random(5).sample(range(-10**12, 10**12), 4000)
    edges = spark.createDataFrame([*zip(ids[:3000], ids[1:3000]), *zip(ids[3000:], ids[3001:])], "a long, b long")
    got = dict(map(tuple, J.components(edges).collect()))
    assert got == {**dict.fromkeys(ids[:3000], min(ids[:3000])), **dict.fromkeys(ids[3000:], min(ids[3000:]))}


def test_query_matches_sql(spark):
    assert matches_sql(spark, "op1_jaccard_join", SF0001) == 200
