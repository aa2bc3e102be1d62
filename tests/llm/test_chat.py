"""Tool calls and results: links, order, validation, canonical JSON."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from conftest import SF0001
from sluice.llm import chat
from sqlcheck import matches_sql

SCHEMAS = {"add": {"properties": {"a": {"type": "number"}, "b": {"type": ["number", "string"]}}, "required": ["a"], "additionalProperties": False},
           "say": {"properties": {"tone": {"enum": ["low", "high"]}, "parts": {"type": "array", "items": {"type": "string"}}}}}


def call(i, name, arguments):
    return {"id": i, "name": name, "arguments": arguments}


def calls(*cs, content=None):
    return json.dumps({"tool_calls": list(cs), "content": content})


def result(i, content):
    return json.dumps({"tool_call_id": i, "content": content})


ROWS = [
    (1, 0, "user", "héllo \"x\""), (1, 1, "assistant", calls(call("c", "add", {"a": "$b", "b": 1}), call("b", "add", {"a": "$a"}), call("a", "add", {"b": 2.5, "a": 1}), content="z")),
    (1, 2, "tool", result("a", {"z": 1, "y": [2]})), (1, 3, "tool", result("b", None)), (1, 4, "tool", result("a", "second result")), (1, 5, "tool", result("nobody", 1)),
    (2, 0, "assistant", calls(call("a", "say", {"tone": "mid"}), call("x", "add", {"a": "$y"}), call("y", "add", {"a": "$x"}), call("w", "add", {"a": "$x"}), call("v", "add", {"a": "$elsewhere"}))),
    (3, 0, "assistant", calls(call("a", "add", "{\"a\": 3}"), call("a", "add", {"a": True}), call(7, "add", {}), "not a call", call("q", "fly", {}))),
    (3, 1, "tool", result("a", 5)), (4, 0, "user", None), (4, 1, "user", ""), (4, 1, "user", ""), (None, 0, "assistant", calls(call("a", "add", {"a": 1}))), (None, 1, "tool", result("a", 1)),
    (5, 0, "user", "{not json"), (5, 1, "user", "{\"a\": NaN}"), (5, 2, "user", "word " * 30_000), (6, None, None, "[1]"),
]


@pytest.fixture(scope="module")
def got(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "conv_id long, turn long, role string, text string, json string, depth int").repartition(3)
    return chat.link_tool_calls(df, SCHEMAS).collect()


def row(got, conv, turn):
    return next(r for r in got if (r.conv_id, r.turn) == (conv, turn))


def test_every_message_has_a_row(got):
    assert sorted(((r.conv_id, r.turn, r.role) for r in got), key=repr) == sorted((r[:3] for r in ROWS), key=repr)
    assert all(r.json == chat.canonical(json.loads(r.json)) for r in got)


def test_calls_follow_those_they_refer_to_and_have_results(got):
    r = row(got, 1, 1)
    m = json.loads(r.json)
    assert [c["id"] for c in m["tool_calls"]] == ["a", "b", "c"] and m["content"] == "z"
    assert m["tool_calls"][0]["result"] == {"y": [2], "z": 1} and m["tool_calls"][1]["result"] is None and "result" not in m["tool_calls"][2]
    assert (r.n_calls, r.n_linked, r.n_invalid, r.n_cyclic) == (3, 2, 0, 0)
    assert row(got, 1, 5).orphan and not row(got, 1, 2).orphan


def test_cycles_come_last_and_are_counted(got):
    r = row(got, 2, 0)
    assert [c["id"] for c in json.loads(r.json)["tool_calls"]] == ["a", "v", "x", "y", "w"]
    # "$elsewhere" names no call of the conversation: a string where a number must be
    assert (r.n_calls, r.n_cyclic, r.n_invalid) == (5, 3, 2)


def test_repeated_and_broken_calls(got):
    r = row(got, 3, 0)
    assert (r.n_calls, r.n_linked, r.n_invalid) == (5, 1, 4)
    m = {c["id"]: c for c in json.loads(r.json)["tool_calls"] if c["valid"]}
    assert m["a"]["result"] == 5 and m["a"]["arguments"] == {"a": 3}
    assert row(got, None, 0).n_linked == 0 and row(got, None, 1).orphan


def test_other_texts_are_messages(got):
    for r in got:
        if r.conv_id in (4, 5, 6):
            text = next(t for c, u, _, t in ROWS if (c, u) == (r.conv_id, r.turn))
            assert json.loads(r.json)["content"] == text and r.n_calls == 0


def test_texts_without_a_canonical_form_are_messages(spark):
    deep = json.dumps({"tool_calls": [call("a", "add", {"a": 1})], "content": None})[:-5] + "[" * 3000 + "]" * 3000 + "}"
    nested = {"a": 1}
    for _ in range(400):
        nested = {"x": [nested, "$a"]}
    texts = ['{"tool_calls":[{"id":"a","name":"add","arguments":{"a":1e999}}]}', '{"content":1e999,"tool_calls":[]}', '{"tool_call_id":"a","content":"\\ud800"}',
             '{"tool_calls":[{"id":"\\udc00","name":"add","arguments":{"a":1}}]}', '{"content":-Infinity,"tool_calls":[]}', deep, "{" * 100_000,
             calls(call("a", "add", {"a": "$5 off"}), call("b", "say", {"tone": "$low"}), call("c", "say", {"parts": ["$a", "$b"]}), call("d", ["add"], {}), call("e", "say", nested))]
    df = spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat.link_tool_calls(df, SCHEMAS).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts[:-1]):
        if got[i].n_calls == 0:
            assert json.loads(got[i].json)["content"] == t
    assert [got[i].n_calls for i in (0, 1, 2, 3, 4, 6)] == [0] * 6
    last = got[len(texts) - 1]
    assert {c["id"]: c["valid"] for c in json.loads(last.json)["tool_calls"]} == {"a": False, "b": False, "c": True, "d": False, "e": True}


def test_no_rows(spark):
    assert chat.link_tool_calls(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


@given(st.recursive(st.none() | st.booleans() | st.integers() | st.text(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8))
def test_canonical_json_is_one_spelling(value):
    assert json.loads(chat.canonical(value)) == value and chat.canonical(json.loads(chat.canonical(value))) == chat.canonical(value)
    assert chat.problem(value, {}) is None


def test_query_matches_sql(spark):
    assert matches_sql(spark, "op5_chat_tools", SF0001) > 0
