"""Quality rules: measures against plain Python, the vote model against its expression, held-out labels."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from sluice.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["", None, " \n\t ", "one", "a b c d e", "a b c d e a b c d e", "x " * 3000, "é É ß ü Ünï",
         "same line\nsame line\n\n \nother\nsame line", "a b c d e f a b c d e f g " * 40, "## $$ %% <a> | b & *",
         "1 2 3 4 5 6 7 8 9 10 1 2 3 4 5", "tie tie tie tie tie tie", "a\x0bb\x0cc\rd e"]


def plain(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    twice = {i for i, g in enumerate(grams) if grams.count(g) > 1} if len(grams) < 2000 else {i for i, g in enumerate(grams) if len(set(grams)) < len(grams)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len({i + k for i in twice for k in range(5)}))


def test_measures_equal_plain_python(spark):
    rows = [(i, t, "clash", i) for i, t in enumerate(TEXTS)] + [(None, "null id words", "c", 1), (3, "one", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept int")
    got = Q.quality(docs).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    want = sorted(((i, *plain(t)) for i, t, *_ in rows), key=key)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed) and 0 <= r.posterior <= 1


@given(st.lists(st.sampled_from("ab"), max_size=30))
@settings(max_examples=25, deadline=None)
def test_repeated_words_of_any_order(spark, letters):
    text = " ".join(letters)
    got = Q.measure(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_repeat_words == plain(text)[4]


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert Q.quality(docs).collect() == []


def test_expression_equals_the_model(spark):
    patterns = [((1, None, 1), 900), ((0, None, 1), 60), ((None, 0, None), 25), ((1, 0, 0), 5), ((None, None, None), 10)]
    model = Q.VoteModel.fit(patterns, 3)
    df = spark.createDataFrame([v for v, _ in patterns], "a int, b int, c int")
    got = df.select("a", "b", "c", model.posterior([F.col(x) for x in "abc"]).alias("p")).collect()
    assert all(abs(r.p - model.good((r.a, r.b, r.c))) < 1e-12 for r in got)
    assert model.good((1, None, 1)) > 0.5 > model.good((1, 0, 0))


@pytest.fixture(scope="module")
def judged(spark):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    return Q.quality(spark.read.parquet(f"{SF001}/documents.parquet")).join(labels, "doc_id").where("toxic = 0").collect()


def test_labelled_good_documents_stay_and_most_junk_goes(judged):
    kept = {q: [r.kept for r in judged if r.quality == q and not r.base_failed] for q in (0, 1)}
    assert sum(kept[1]) >= 0.99 * len(kept[1])
    assert sum(kept[0]) <= 0.4 * len(kept[0])
