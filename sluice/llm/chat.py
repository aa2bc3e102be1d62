"""Tool-call linking in conversations.

A message's text may be a JSON object that holds calls
(``{"content": ..., "tool_calls": [{"id", "name", "arguments"}, ...]}``) or a
result (``{"tool_call_id": ..., "content": ...}``); any other text is a plain
message, as is JSON that has no canonical form (numbers beyond all bounds, half
surrogates, nesting too deep to write).  Calls and results are joined by
(conversation, identifier).  A string ``"$id"`` among a call's arguments refers to
the result of another call of the conversation, if it has one of that identifier:
calls come in an order in which each follows those that it refers to, and such a
string fits any schema.  Arguments are validated against the tools' schemas, other
strings that begin with ``$`` as the strings they are.  Messages are written as
canonical JSON: sorted keys, no spaces, one spelling for each value.

Calls and results are rows of their own, so a conversation of any length is
joined and ordered without being gathered; only the calls of one message meet.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import keep, ship

EVENTS = ("row long, conv_id long, turn long, role string, kind string, nth int, call_id string, name string, arguments string, "
          "content string, refs array<string>, problem string")
NAMES = ["row", "conv_id", "turn", "role", "kind", "nth", "call_id", "name", "arguments", "content", "refs", "problem"]

_TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def has_type(value: object, name: str) -> bool:
    if name == "integer":
        return isinstance(value, int) and not isinstance(value, bool)
    if name == "number":
        return isinstance(value, int | float) and not isinstance(value, bool)
    return name in _TYPES and isinstance(value, _TYPES[name])


def problem(value: object, schema: dict, path: str = "$", resolved: frozenset[str] = frozenset()) -> str | None:
    """The first way in which a value breaks a schema (type, enum, required, properties, additionalProperties, items);
    no deeper than the schema.  References to ``resolved`` calls stand for results and fit."""
    if isinstance(value, str) and value.startswith("$") and value[1:] in resolved:
        return None
    types = schema.get("type")
    if types is not None and not any(has_type(value, t) for t in ([types] if isinstance(types, str) else types)):
        return f"{path}: not {types}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{path}: not in enum"
    if isinstance(value, dict):
        for k in schema.get("required", []):
            if k not in value:
                return f"{path}.{k}: missing"
        known = schema.get("properties", {})
        for k in sorted(value):
            if k in known:
                if found := problem(value[k], known[k], f"{path}.{k}", resolved):
                    return found
            elif schema.get("additionalProperties") is False:
                return f"{path}.{k}: unknown"
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            if found := problem(x, schema["items"], f"{path}[{i}]", resolved):
                return found
    return None


def references(value: object) -> set[str]:
    """The identifiers that strings in a value refer to, however deep."""
    found, waiting = set(), [value]
    while waiting:
        x = waiting.pop()
        if isinstance(x, str):
            if x.startswith("$") and len(x) > 1:
                found.add(x[1:])
        elif isinstance(x, dict | list):
            waiting.extend(x.values() if isinstance(x, dict) else x)
    return found


def finite(text: str) -> float:
    x = float(text)
    if not math.isfinite(x):
        raise ValueError("beyond all bounds")
    return x


def read_object(text: str | None) -> dict | None:
    if not text or not text.lstrip().startswith("{"):
        return None
    try:
        got = json.loads(text, parse_constant=finite, parse_float=finite)
        canonical(got).encode()
    except (ValueError, RecursionError):  # half surrogates raise a ValueError, too
        return None
    return got if isinstance(got, dict) else None


def events_of(text: str | None, schemas: dict[str, dict]) -> list[dict]:
    """The message and its calls, or the result, that a text holds."""
    found = read_object(text)
    if found is not None and isinstance(found.get("tool_call_id"), str):
        return [{"kind": "result", "nth": 0, "call_id": found["tool_call_id"], "content": canonical(found.get("content"))}]
    calls = found.get("tool_calls") if found is not None else None
    if not isinstance(calls, list):
        return [{"kind": "message", "nth": 0, "content": canonical(text)}]
    out = [{"kind": "message", "nth": 0, "content": canonical(found.get("content"))}]
    for i, c in enumerate(calls, 1):
        c = c if isinstance(c, dict) else {}
        args = c.get("arguments")
        if isinstance(args, str):  # arguments are often JSON within JSON
            inner = read_object(args)
            args = args if inner is None else inner
        name, call_id = c.get("name"), c.get("id")
        why = "no id" if not isinstance(call_id, str) else "unknown tool" if not isinstance(name, str) or name not in schemas else None
        out.append({"kind": "call", "nth": i, "call_id": call_id if isinstance(call_id, str) else None, "name": name if isinstance(name, str) else None,
                    "arguments": canonical(args), "refs": sorted(references(args)), "problem": why})
    return out


def events(conversations: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), *[pa.string()] * 4, pa.list_(pa.string()), pa.string()]
        schema = pa.schema(list(zip(NAMES, kinds, strict=True)))
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                rows += [{"row": r["row"], "conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], **e} for e in events_of(r["text"], schemas)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    rows = conversations.select(F.monotonically_increasing_id().alias("row"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    return keep(rows.mapInArrow(parse, EVENTS), "chat-events")


def resolved_references(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, ref): references to calls that the conversation has."""
    ids = calls.select("conv_id", "call_id").where("conv_id is not null and call_id is not null").distinct()
    refs = calls.select("conv_id", "call_id", F.explode("refs").alias("ref")).distinct()
    return keep(refs.join(ids.withColumnRenamed("call_id", "ref"), ["conv_id", "ref"]), "chat-edges")


def depths(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): 0 without references, else one more than the deepest call referred to.

    References to calls that the conversation doesn't have are ignored.  Calls
    are resolved round by round, as long as that resolves some; those on a cycle,
    or behind one, have no depth.
    """
    ids = calls.select("conv_id", "call_id").where("conv_id is not null and call_id is not null").distinct()
    done = keep(ids.join(edges, ["conv_id", "call_id"], "left_anti").withColumn("depth", F.lit(0)), "chat-depths")
    if edges.isEmpty():
        return done
    while True:
        known = edges.join(done.select("conv_id", F.col("call_id").alias("ref"), "depth"), ["conv_id", "ref"], "left")
        ready = known.groupBy("conv_id", "call_id").agg((F.max("depth") + 1).alias("depth"), F.bool_and(F.col("depth").isNotNull()).alias("all"))
        new = keep(ready.where("all").drop("all").join(done, ["conv_id", "call_id"], "left_anti"), "chat-ready")
        if new.isEmpty():
            return done
        done = keep(done.unionByName(new), "chat-depths")


def link_tool_calls(conversations: DataFrame, schemas: dict[str, dict] | None = None) -> DataFrame:
    """A row for each message: conv_id, turn, role, n_calls, n_linked, n_invalid, n_cyclic, orphan, json.

    ``n_linked`` counts calls with a result, ``orphan`` marks a result without call.
    Of several results, or calls, with one identifier the first by (turn, place) is
    linked, by row on ties.  Null conversations and identifiers link with nothing; null and
    empty texts are messages with that content; repeated rows keep a row each;
    other columns are ignored.
    """
    ship(conversations.sparkSession)
    schemas = schemas or {}
    ev = events(conversations, schemas)
    calls, results = ev.where("kind = 'call'"), ev.where("kind = 'result'")
    by = ["conv_id", "call_id"]
    usable = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = results.where(usable).groupBy(*by).agg(F.min(F.struct("turn", "row", "content")).alias("r")).select(*by, F.col("r.content").alias("result"), F.lit(True).alias("linked"))
    owner = calls.where(usable).groupBy(*by).agg(F.min(F.struct("turn", "row", "nth")).alias("o")).select(*by, F.col("o.row").alias("row"), F.col("o.nth").alias("nth"))
    edges = resolved_references(calls)
    known_refs = edges.groupBy(*by).agg(F.collect_set("ref").alias("resolved"))
    linked = calls.join(owner.join(first, by), [*by, "row", "nth"], "left").join(depths(calls, edges), by, "left").join(known_refs, by, "left")
    order = F.struct(F.coalesce("depth", F.lit(2**31 - 1)).alias("depth"), "nth", "call_id", "name", "arguments", "result", "problem", F.sort_array("resolved").alias("resolved"), F.coalesce("linked", F.lit(False)).alias("linked"),
                     (F.col("depth").isNull() & usable).alias("cyclic"))
    # the calls of one message
    of_row = linked.groupBy("row").agg(F.sort_array(F.collect_list(order)).alias("calls"))
    messages = ev.where("kind = 'message'").join(of_row, "row", "left").select("row", "conv_id", "turn", "role", "content", "calls", F.lit(None).cast("string").alias("call_id"), F.lit(False).alias("orphan"))
    known = owner.select(*by, F.lit(True).alias("called"))
    answers = results.join(known, by, "left").select("row", "conv_id", "turn", "role", "content", F.lit(None).cast(of_row.schema["calls"].dataType).alias("calls"), "call_id", F.col("called").isNull().alias("orphan"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), *((n, pa.int64()) for n in ("n_calls", "n_linked", "n_invalid", "n_cyclic")), ("orphan", pa.bool_()), ("json", pa.string())])
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                listed = [{**c, "problem": c["problem"] or problem(json.loads(c["arguments"]), {"type": "object", **schemas.get(c["name"], {})}, resolved=frozenset(c["resolved"] or ()))}
                          for c in r["calls"] or []]
                value = {"turn": r["turn"], "role": r["role"], "content": json.loads(r["content"])}
                if listed:
                    value["tool_calls"] = [{"id": c["call_id"], "name": c["name"], "arguments": json.loads(c["arguments"]), "valid": c["problem"] is None,
                                            **({"result": json.loads(c["result"])} if c["linked"] else {})} for c in listed]
                if r["call_id"] is not None:
                    value["tool_call_id"] = r["call_id"]
                rows.append({"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], "n_calls": len(listed), "n_linked": sum(c["linked"] for c in listed),
                             "n_invalid": sum(c["problem"] is not None for c in listed), "n_cyclic": sum(c["cyclic"] for c in listed), "orphan": r["orphan"], "json": canonical(value)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return messages.unionByName(answers).mapInArrow(write, "conv_id long, turn long, role string, n_calls long, n_linked long, n_invalid long, n_cyclic long, orphan boolean, json string")
