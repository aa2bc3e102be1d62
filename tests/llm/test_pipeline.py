"""The corpus pipeline: each stage on its predecessor's output, against plain versions."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from conftest import SF0001, SF001
from sluice.llm import byte_bpe
from test_decontaminate import brute as benchmark_hits
from test_jaccard import brute as linked


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF0001}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs.collect(), docs.columns))
        docs = corpus_pipeline.keep(stage(spark, docs, SF0001), "test-stage")
    return [*out, ("end", docs.collect(), docs.columns)]


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_all_but_the_last_return_documents(steps):
    assert [s[0] for s in steps] == ["toxicity", "line_dedup", "near_duplicates", "decontaminate", "byte_bpe", "end"]
    assert all(s[2] == ["doc_id", "text", "lang", "source", "n_chars"] for s in steps[:-1])
    assert all(r.n_chars == len(r.text) for r in steps[2][1])


def test_near_duplicates_keep_one_of_each_group(steps):
    before, after = steps[2][1], steps[3][1]
    stay = {key for key, _, least in linked([(r.doc_id, r.text) for r in before], 5, 8, 10) if key == least}
    assert {r.doc_id for r in after} == stay and texts(after).items() <= texts(before).items()


def test_contaminated_documents_go(spark, steps):
    before, after = steps[3][1], steps[4][1]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF0001}/benchmark.parquet").collect()]
    clean = {r[0] for r in benchmark_hits([(r.doc_id, r.text) for r in before], items) if not r[-1]}
    assert {r.doc_id for r in after} == clean and len(clean) < len(before)


def test_ids_of_what_is_left(steps):
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=byte_bpe.tiktoken_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    want = {r.doc_id: hashlib.sha256(np.array(enc.encode_ordinary(r.text), "<u4")).hexdigest() for r in steps[4][1]}
    assert {r.doc_id: r.ids_sha256 for r in steps[5][1]} == want


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF0001).collect())) == sorted(map(tuple, steps[5][1]))


def test_toxic_documents_go_and_clean_ones_stay(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, SF001).select("doc_id").collect()}
    labels = spark.read.parquet(f"{SF001}/labels.parquet").collect()
    clean, toxic = ([r.doc_id in left for r in labels if r.toxic == k] for k in (0, 1))
    assert sum(clean) >= 0.95 * len(clean) and sum(toxic) <= 0.4 * len(toxic)


def test_stages_of_no_rows(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF0001).collect() == []


def test_rows_with_nulls_ties_and_more_columns_pass(spark):
    rows = [(1, None, "x", 1), (None, None, None, None), (2, "", "x", 1), (3, "some words of a line that is long enough to count", "a", 2),
            (3, "some words of a line that is long enough to count", "a", 2), (4, "some words of a line that is long enough to count.", None, None), (None, "a text without id", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_id string, row int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF0001)
        assert out.columns == docs.columns and out.count() >= 5, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF0001).count() == len(rows)
