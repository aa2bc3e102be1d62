"""Edit join of lines against brute force."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import line_dedup as L


def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def brute(docs, edits, least):
    """Texts without lines that an earlier equal or near line repeats, and lines gone; order needs the text hashes."""
    firsts = {}
    for i, (at, text) in enumerate(docs):
        for n, line in enumerate((text or "").split("\n")):
            if len(line) >= least:
                firsts[line] = min(firsts.get(line, (at, n)), (at, n))
    near = {x for x in firsts for y in firsts if x != y and abs(len(x) - len(y)) <= edits and firsts[y] < firsts[x] and distance(x, y) <= edits}
    out = []
    for at, text in docs:
        if text is None:
            out.append((None, 0))
            continue
        lines = text.split("\n")
        kept = [x for n, x in enumerate(lines) if len(x) < least or (x not in near and firsts[x] == (at, n))]
        out.append(("\n".join(kept), len(lines) - len(kept)))
    return out


def ours(spark, rows, edits, least):
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, gone string, h1 int").repartition(3)
    got = L.dedup_lines(docs, edits, least).collect()
    assert all(r.gone == "c" and r.h1 == 1 for r in got)
    return sorted(((r.doc_id, r.text, r.n_lines_gone) for r in got), key=repr)


def want(spark, rows, edits, least):
    ids = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t in rows], "t string").select("t", F.xxhash64(F.coalesce("t", F.lit(""))).alias("h")).collect()}
    order = [((i is None, i or 0, ids[t]), t) for i, t in rows]
    return sorted(((i, *o) for (i, _), o in zip(rows, brute(order, edits, least), strict=True)), key=repr)


def noisy(seed, n, edits):
    r = random.Random(seed)
    bases = ["".join(r.choices("abcdé ", k=r.randint(6, 40))) for _ in range(12)]
    out = []
    for i in range(n):
        lines = []
        for _ in range(r.randint(1, 5)):
            w = list(r.choice(bases))
            for _ in range(r.randint(0, edits + 2)):
                at = r.randint(0, len(w))
                w[at:at + r.randint(0, 1)] = r.choices("abz", k=r.randint(0, 1))
            lines.append("".join(w))
        out.append((i, "\n".join(lines)))
    return out


EDGE = [(None, "line without any id here\nx"), (None, None), (900, ""), (901, "\n\n"), (902, "short"), (903, "short\nshort"), (904, "a same line of some length"),
        (904, "a same line of some length"), (904, "a same line of some lengths\nother"), (905, "é" * 30), (906, "é" * 29 + "e"), (907, "long " * 20_000),
        (908, "long " * 20_000 + "x"), (909, "line without any id here")]


@pytest.mark.parametrize("edits", [1, 2])
def test_equals_brute_force(spark, edits):
    rows = noisy(edits, 60, edits) + [r for r in EDGE if not r[1] or len(r[1]) < 1000]
    assert ours(spark, rows, edits, 6) == want(spark, rows, edits, 6)


def test_defaults_and_long_lines(spark):
    got = {(r[0], (r[1] or "")[:24]): r[2] for r in ours(spark, EDGE, 2, 24)}
    assert got[908, ""] == 1 and got[907, ("long " * 5)[:24]] == 0 and got[906, ""] == 1
    assert got[903, "short\nshort"] == 0 and got[909, "line without any id here"] == 0 and got[None, "x"] == 1


def test_equal_lines_of_any_length_and_near_short_ones(spark):
    rows = [(1, "Home\nContact us\nOk\n--\nNext page please now\n" + "=" * 30), (2, "Home\nContact ux\nOn\n--\n\nNext page plaese now"),
            (3, "Ok\nContect ux\nHom\nNo\n" + "=" * 30), (4, "Home\nOk\nby\nNext page please")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.text, r.n_lines_gone) for r in L.dedup_lines(docs).collect()}
    # "Contect ux" is one edit off a line that goes itself
    assert got == {1: (rows[0][1], 0), 2: ("On\n--\n", 3), 3: ("Hom\nNo", 3), 4: ("by\nNext page please", 2)}


def registered(docs):
    """What the registered configuration leaves: near lines have an edit for each eight characters of the shorter one, two at most."""
    firsts = {}
    for at, text in docs:
        for n, line in enumerate(text.split("\n")):
            if len(line) >= L.WORDLESS_CHARS or any(c.isalnum() for c in line):
                firsts[line] = min(firsts.get(line, (at, n)), (at, n))
    near = {x for x in firsts for y in firsts if firsts[y] < firsts[x] and x != y and abs(len(x) - len(y)) <= 2 and distance(x, y) <= min(2, min(len(x), len(y)) // L.CHARS_AN_EDIT)}
    out = {}
    for at, text in docs:
        kept = [x for n, x in enumerate(text.split("\n")) if x not in firsts or (x not in near and firsts[x] == (at, n))]
        out[at] = "\n".join(kept)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_registered_configuration_with_large_groups_of_near_copies(spark, seed):
    r = random.Random(seed)
    # bases that share segments with one another, and many variants of each within 0 to 4 edits, in any order
    parts = ["".join(r.choices("abcdefg hij", k=9)) for _ in range(5)]
    bases = ["".join(r.choices(parts, k=r.randint(1, 3))) for _ in range(6)] + ["Ok", "Home", "12345678"]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(r.randint(1, 3)):
            w = list(r.choice(bases))
            for _ in range(r.choice([0, 1, 1, 2, 2, 3])):
                at = r.randint(0, len(w))
                w[at:at + r.randint(0, 1)] = r.choices("abz1", k=r.randint(0, 1))
            lines.append("".join(w))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {x.doc_id: x.text for x in L.dedup_lines(df).collect()} == registered(docs)


def test_no_rows(spark):
    assert ours(spark, [], 2, 24) == []


@given(st.lists(st.tuples(st.text("abé", max_size=9), st.text("abé", max_size=9)), min_size=1, max_size=60), st.integers(1, 3))
@settings(max_examples=12, deadline=None)
def test_banded_distance(spark, pairs, edits):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = {r.i for r in L.within(df, edits).collect()}
    assert got == {i for i, (a, b) in enumerate(pairs) if distance(a, b) <= edits}


def test_generated_methods_are_small_enough_to_be_compiled(spark, monkeypatch):
    # the JVM only ever interprets methods of more than 8,000 bytes
    sizes, real = {}, L.keep

    def keep(df, name):
        if name in ("line-keys", "line-texts"):
            spark.conf.set("spark.sql.adaptive.enabled", "false")   # else the plan has no code yet
            try:
                code = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
            finally:
                spark.conf.set("spark.sql.adaptive.enabled", "true")
            sizes[name] = max(int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code))
        return real(df, name)

    monkeypatch.setattr(L, "keep", keep)
    docs = spark.createDataFrame([(1, "a line of some length, twice"), (2, "a line of some lengths, twice")], "doc_id long, text string")
    L.repeated_lines(docs)
    assert len(sizes) == 2 and max(sizes.values()) <= 8000, sizes
