"""String kernel against its definition, the folded machine against the kernel, held-out labels, gapped words."""

import zlib
from itertools import combinations

import numpy as np
import pytest

from conftest import SF001
from sluice.llm import toxicity as T


def kernel(s, t):
    """Subsequences of three, each weighted by DECAY to the length it spans in both."""
    def parts(x):
        x, out = f"^{x}$", {}
        for i, j, k in combinations(range(len(x)), 3):
            u = x[i] + x[j] + x[k]
            out[u] = out.get(u, 0) + T.DECAY ** (k - i + 1)
        return out
    a, b = parts(s), parts(t)
    return sum(v * b.get(u, 0) for u, v in a.items())


WORDS = ["idiot", "idxiot", "moron", "banana", "the", "oder", "aaa"]


def test_kernel_is_its_definition():
    code = {c: i + 1 for i, c in enumerate(["^", "$", *sorted(set("".join(WORDS)))])}
    for w in WORDS:
        assert T.self_kernel(T.encode([w], code))[0] == pytest.approx(kernel(w, w), rel=1e-5)
    got = T.kernel_to(WORDS, WORDS[:3], code)
    want = [[kernel(a, b) / np.sqrt(kernel(a, a) * kernel(b, b)) for b in WORDS[:3]] for a in WORDS]
    assert np.allclose(got, want, atol=1e-5)


def test_letters_outside_the_alphabet_match_nothing():
    code = {"^": 1, "$": 2, "a": 3}
    assert T.self_kernel(T.encode(["bcd"], code))[0] == 0


@pytest.fixture(scope="module")
def machine():
    clean = ["the", "and", "house", "water", "station", "reader", "monitor", "motion", "idea", "edit", "trust", "class", "scale", "pathway"]
    return T.train_words({w: 1.0 for w in ("idiot", "moron", "scum", "trash", "pathetic")}, {w: 1.0 for w in clean})


def test_gapped_and_stretched_words_are_found(machine):
    texts = ["you idiot", "you i.d.i.o.t", "you i d i o t !", "idxiot", "MORON", "mo-ron", "p4thetic trash"]
    for t in texts:
        raw = T.raw_words(t)
        machine.learn_words(raw)
        assert machine.document(raw)[0] > 0, t
    for t in ("the house and the water", "a b", "", None, "reader at the station"):
        raw = T.raw_words(t)
        machine.learn_words(raw)
        assert machine.document(raw)[0] < 0, t


def test_long_words_are_read_whole(machine):
    raw = T.raw_words("z" * 5000 + "idiot" + "z" * 5000)
    machine.learn_words(raw)
    assert machine.document(raw)[0] > -T.LIMIT


def test_rows_stay_as_they_are(spark, machine):
    rows = [(1, "the idiot", "x", 1), (None, "the water", "x", 1), (2, None, "x", 1), (2, "", "x", 1), (3, "tie idiot", "x", 1), (3, "tie idiot", "x", 1), (4, "house " * 9000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, score int")
    machine.link = (0.0, 4.0, 0.0)
    got = sorted(((r.doc_id, r.predicted) for r in T.toxicity(docs, machine).collect()), key=repr)
    assert got == sorted([(1, 1), (None, 0), (2, 0), (2, 0), (3, 1), (3, 1), (4, 0)], key=repr)
    assert T.toxicity(docs.limit(0), machine).collect() == []


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "any text here"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = T.toxicity(docs, T.train(docs, labels, ~T.held_out())).collect()
    assert [r.predicted for r in got] == [0, 0] and all(0 <= r.score <= 1 for r in got)


def test_held_out_labels(spark):
    import __spark_entry__ as entry

    got = entry.queries()["op10_toxicity"](spark, SF001)
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    clean, toxic = ([r.predicted for r in held if r.toxic == k] for k in (0, 1))
    assert sum(clean) <= 0.05 * len(clean) and sum(toxic) >= 0.6 * len(toxic)
