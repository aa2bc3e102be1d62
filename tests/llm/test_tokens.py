"""Token-id shards and byte-level BPE against the libraries on whole texts."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluice.llm import byte_bpe, token_output

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

TEXTS = ["", None, " ", "a b", "it's don't WE'LL 3rd 12.5%", "ÀÉ ß İstanbul Σας naïve ÿ",
         "x\x1cy z\x85q\xa0w v", "<|endoftext|> a<|startoftext|>b", "é e ́x", "日本語 テスト foo_bar",
         "A.,b!? ..", "two  spaces   three\n\n  lines \n x\t\ty", " lead and trail ", "a\n b \nc", "nul\0 in\0side text",
         "word " * 5000, "tie", "tie", "\U0001f600 ‍!"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i % 17 if i != 3 else None, t, "x", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int").repartition(3)


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(WORD_FILE)
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.fixture(scope="module")
def ranks():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.tiktoken_ranks(RANKS), special_tokens={})


@pytest.mark.parametrize("shard_ids", [3, 8_000_000])
def test_token_shards_hold_every_document_in_order(docs, whole, shard_ids):
    got = token_output.token_shards(docs, WORD_FILE, shard_ids=shard_ids).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for key, text in rows:
        ids = whole(text)
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_shards_of_no_rows(docs):
    assert token_output.token_shards(docs.limit(0), WORD_FILE).collect() == []


@given(st.lists(st.integers(0, 5000), max_size=700))
@settings(max_examples=40, deadline=None)
def test_elias_fano_selects_each_end(steps):
    ends = np.cumsum(steps, dtype=np.int64)
    data = token_output.shard_bytes([bytes(2 * s) for s in steps], 2, list(range(len(steps))))
    ids, ef, keys = token_output.read_shard(data)
    assert ef.all().tolist() == ends.tolist() == [ef.select(i) for i in range(len(steps))]
    assert len(ids) == sum(steps) and keys == list(range(len(steps)))


@given(st.lists(st.sampled_from([*"abÉß ", " ", "  ", "\n", "'s", "1", "é́", ".", "###", "<|", " ", "Ω"]), max_size=14))
@settings(max_examples=300, deadline=None)
def test_chunks_encode_as_the_whole_text(whole, parts):
    text = "".join(parts)
    got = np.frombuffer(token_output.encoder(WORD_FILE)(text), "<u2").tolist()
    assert got == whole(text)[:-1]


@pytest.mark.parametrize("block_chars", [10, 32_000_000])
def test_byte_bpe_is_tiktoken_on_whole_texts(docs, ranks, block_chars):
    got = byte_bpe.digests(byte_bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, block_chars=block_chars)).collect()
    want = []
    for r in docs.collect():
        ids, text = ranks.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4")).hexdigest(), hashlib.sha256(text).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@given(st.lists(st.sampled_from([*"abÉ", " ", "  ", "\n", "\t", "'s", " '", "12", ".", " ", "\x1c"]), max_size=16))
@settings(max_examples=400, deadline=None)
def test_pieces_have_the_pre_tokens_of_the_text(parts):
    import regex

    text, block = "".join(parts), byte_bpe.Block(public_tokenizers.PATTERN)
    block.add(1, text)
    names = list(block.number)
    assert [names[i] for i in block.found[0]] == regex.findall(public_tokenizers.PATTERN, text)


def test_byte_bpe_of_no_rows(docs):
    assert byte_bpe.encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_decode_joins_the_token_bytes(spark, ranks):
    texts = ["naïve texts", "", "\U0001f600 x"]
    ids = spark.createDataFrame([(i, ranks.encode_ordinary(t)) for i, t in enumerate(texts)] + [(9, None)], "doc_id long, ids array<int>")
    got = byte_bpe.decode(ids, byte_bpe.token_table(spark, RANKS)).collect()
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in got} == {**dict(enumerate(texts)), 9: ""}
