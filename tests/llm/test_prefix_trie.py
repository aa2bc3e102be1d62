"""Prefix trie against a trie of dicts, and its SQL."""

import hashlib
import random
import zlib

import pytest
from conftest import SF001
from sqlcheck import matches_sql

from sluice.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def trie(convs):
    """Rows of the trie of {conv_id: [(turn, chars)]}."""
    if not convs:
        return []
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for k, members in nodes.items():
        below = [x for x in nodes if x[:len(k)] == k]
        leaves = sum(not any(y[:-1] == x for y in below if y) for x in below)
        ends = sorted(c for c in members if len(convs[c]) == len(k))
        out.append((min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), sum(y[:-1] == k for y in below if y), leaves,
                    sum((len(nodes[x]) - 1) * x[-1][1] for x in below if x), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def sequences(spark, convs):
    return spark.createDataFrame([(c, [x[0] for x in t], [x[1] for x in t]) for c, t in convs.items()], "conv_id long, turns array<long>, chars array<long>").repartition(3)


@pytest.mark.parametrize(("seed", "parts", "group"), [(1, 1, 64), (2, 7, 64), (3, 20, 2), (4, 33, 3)])
def test_random_tries_in_several_rounds(spark, monkeypatch, seed, parts, group):
    rng = random.Random(seed)
    monkeypatch.setattr(P, "GROUP", group)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    chars = [rng.randint(0, 9) for _ in range(4)]
    convs = {rng.randint(-10 ** 6, 10 ** 6): [(x, chars[x]) for x in rng.choices(range(4), [9, 3, 1, 1], k=rng.choice([0, 1, 2, 3, 8, 14]))] for _ in range(150)}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        assert sorted(map(tuple, P.prefix_trie(sequences(spark, convs)).collect()), key=repr) == trie(convs)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_copies_deep_paths_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(P, "CHUNK", 8)
    deep = [(i % 5, 2) for i in range(120)]
    convs = {i - 30: deep for i in range(90)} | {200: deep[:60] + [(9, 1)] * 40, 201: deep[:60], 202: []}
    assert sorted(map(tuple, P.prefix_trie(sequences(spark, convs)).collect()), key=repr) == trie(convs)
    assert P.prefix_trie(sequences(spark, {0: []}).where("conv_id > 0")).collect() == []
    assert list(map(tuple, P.prefix_trie(sequences(spark, {7: []})).collect())) == trie({7: []})


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [x[2] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = [(x, len(x[1])) for x in own.get(c // 100 * 100, [])[:h] + turns[h:]]
    return out


def test_conversations_with_nulls_ties_and_clashing_columns(spark):
    rng = random.Random(9)
    rows = []
    for c in [*range(0, 40), *range(300, 330), *range(401, 420)]:  # 400 is absent
        for t in range(rng.randint(1, 9)):
            rows.append((c, None if rng.random() < 0.1 and t == 0 else t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "héllo ☃", "x" * 2000])))
    want = trie(rebuilt(rows))
    df = spark.createDataFrame([(*r, 1, "k", 5) for r in [*rows, (None, 1, "user", "lost")]], f"{SCHEMA}, depth int, key string, n long")
    got = P.conversation_trie(df.repartition(5)).collect()
    assert sorted(map(tuple, got), key=repr) == want
    # equal rows are turns of their own, whatever their order
    same = [(100, 1, "user", "a")] * 3
    assert sorted(map(tuple, P.conversation_trie(spark.createDataFrame(same, SCHEMA)).collect()), key=repr) == trie(rebuilt(same))
    assert P.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql(spark):
    assert matches_sql(spark, "op12_prefix_trie", SF001) == 325
