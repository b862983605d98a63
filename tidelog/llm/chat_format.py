r"""Chat formatting: tool calls linked to their results, ordered, validated and serialised.

* An assistant message ``{"tool_calls": [{"id", "name", "arguments"}, ...]}`` holds calls; a
  tool message ``{"tool_call_id", "content"}`` holds a result.  ``{"$result": id}`` anywhere in
  a call's arguments makes the call depend on that result.
* Calls and results meet by an equi-join on (conversation, identifier), each side first
  reduced to one row an identifier, so repeated identifiers never multiply; the first turn
  counts and later ones are marked repeated.
* Topological order: a result comes after its call, a call after the results that it cites.
  ``level`` is the longest chain before an event and ``order_turn`` the last turn that it must
  wait for; sorting a conversation by (order_turn, level, turn, part) is a topological order.
  Rounds equal the longest chain of citations; none is needed without citations.  Events in a
  cycle, or that cite what nobody answered, have no level.
* Arguments are validated against the tool's JSON schema; unknown tools are invalid.
* Every event is one canonical JSON text: sorted keys, no spaces, characters as they are.

No conversation is gathered: rows stay one an event, and only keys are joined.

Edge cases: null conversation ids, turns, roles and texts are values like any other; texts
that aren't such JSON are plain messages; empty tables give empty results; extra columns are
ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import lean, prepare, saved, table

_EVENT = "conv_id long, turn long, role string, part int, kind string, call_id string, name string, arguments string, content string, cites array<string>"

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}


def _is(value: Any, kind: str) -> bool:
    if kind == "integer":
        return not isinstance(value, bool) and (isinstance(value, int) or isinstance(value, float) and value.is_integer())
    if kind == "number":
        return not isinstance(value, bool) and isinstance(value, int | float)
    return isinstance(value, _TYPES[kind])


def valid(value: Any, schema: Any) -> bool:
    """Does a JSON value meet a schema (type, enum, const, properties, required, additionalProperties, items, bounds, lengths, pattern)?"""
    if isinstance(schema, bool):
        return schema
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return False
    if "enum" in schema and not any(canonical(value) == canonical(x) for x in schema["enum"]):
        return False
    if "const" in schema and canonical(value) != canonical(schema["const"]):
        return False
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", [])):
            return False
        rest = schema.get("additionalProperties", True)
        return all(valid(v, known.get(k, rest)) for k, v in value.items())
    if isinstance(value, list):
        return schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)) and all(valid(v, schema.get("items", True)) for v in value)
    if isinstance(value, str):
        return schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)) and ("pattern" not in schema or re.search(schema["pattern"], value) is not None)
    if isinstance(value, int | float) and not isinstance(value, bool):
        return schema.get("minimum", value) <= value <= schema.get("maximum", value)
    return True


_SURROGATE = re.compile("[\ud800-\udfff]")


def _sound(text: str) -> str:
    """text with unpaired surrogates, which UTF-8 cannot hold, as JSON escapes."""
    return _SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: Any) -> str:
    """Sorted keys, no spaces; ValueError for numbers that JSON does not have."""
    return _sound(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _cited(value: Any) -> set[str]:
    """Identifiers in {"$result": id} anywhere below."""
    found: set[str] = set()
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if set(x) == {"$result"} and isinstance(x["$result"], str):
                found.add(x["$result"])
            todo += x.values()
        elif isinstance(x, list):
            todo += x
    return found


def _parse(role: str | None, text: str | None) -> list[dict]:
    """The events of one message; what is not sound JSON (NaN, numbers beyond a double, nesting too deep) is plain text."""
    plain = [{"part": 0, "kind": "message", "content": text}]
    if role not in ("assistant", "tool") or not text or text.lstrip()[:1] != "{":
        return plain
    try:
        found = _embedded(role, json.loads(text), plain)
    except (ValueError, RecursionError):
        return plain
    return [{k: _sound(v) if isinstance(v, str) else [_sound(x) for x in v] if isinstance(v, list) else v for k, v in e.items()} for e in found]


def _embedded(role: str, body: dict, plain: list[dict]) -> list[dict]:
    if role == "tool":
        if not isinstance(body.get("tool_call_id"), str):
            return plain
        return [{"part": 0, "kind": "result", "call_id": body["tool_call_id"], "content": canonical(body.get("content"))}]
    calls = body.get("tool_calls")
    if not isinstance(calls, list) or not calls or not all(isinstance(c, dict) and isinstance(c.get("id"), str) for c in calls):
        return plain
    return [{"part": k, "kind": "call", "call_id": c["id"], "name": c.get("name") if isinstance(c.get("name"), str) else None, "arguments": canonical(c.get("arguments")), "content": body.get("content") if k == 0 and isinstance(body.get("content"), str) else None, "cites": sorted(_cited(c.get("arguments")))} for k, c in enumerate(calls)]


def parse_events(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, part, kind, call_id, name, arguments, content, cites) of every message."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("part", pa.int32()), *((c, pa.string()) for c in ("kind", "call_id", "name", "arguments", "content")), ("cites", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"conv_id": c, "turn": t, "role": r, "cites": []} | e for c, t, r, x in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True) for e in _parse(r, x)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")).mapInArrow(lean(run), _EVENT)


def turn_pairs(events: DataFrame, tool: str = "respond") -> DataFrame:
    """Plain user and assistant messages as calls of one tool and their results: an assistant turn answers the turn before it."""
    user, reply = (F.col("kind") == "message") & (F.col("role") == "user"), (F.col("kind") == "message") & (F.col("role") == "assistant") & (F.col("turn") > 0)
    number = F.when(user, F.col("turn")).when(reply, F.col("turn") - 1)
    return events.withColumns({
        "kind": F.when(user, "call").when(reply, "result").otherwise(F.col("kind")),
        "call_id": F.coalesce("call_id", F.concat(F.lit("turn-"), number.cast("string"))),
        "name": F.when(user, F.lit(tool)).otherwise(F.col("name")),
        "arguments": F.when(user, F.col("content")).otherwise(F.col("arguments")),
        "content": F.when(user, F.lit(None)).otherwise(F.col("content")),
        "_raw": user | reply,
    })


def _levels(calls: DataFrame) -> DataFrame:
    """(conv, call_id, level, at) of calls (conv, call_id, call_turn, result_turn, cites): level of the call, and the turn that it waits for."""
    done = calls.where("size(cites) = 0").select("conv", "call_id", F.lit(0).alias("level"), F.col("call_turn").alias("at"))
    open_ = calls.where("size(cites) > 0")
    if open_.isEmpty():
        return done
    answers = calls.where("result_turn is not null").select("conv", F.col("call_id").alias("cite"), F.col("result_turn"))
    needs = saved(open_.select("conv", "call_id", "call_turn", F.size(F.array_distinct("cites")).alias("n"), F.explode(F.array_distinct("cites")).alias("cite")).join(answers, ["conv", "cite"], "left"), "cites")
    done = saved(done, "levels")
    while True:
        ready = needs.where("result_turn is not null").join(done.select("conv", F.col("call_id").alias("cite"), F.col("level").alias("below"), F.col("at").alias("waits")), ["conv", "cite"])
        new = ready.groupBy("conv", "call_id", "n").agg(F.count("*").alias("have"), (F.max("below") + 2).alias("level"), F.max(F.greatest("waits", "result_turn", "call_turn")).alias("at")).where("have = n")
        new = saved(new.select("conv", "call_id", "level", "at").join(done.select("conv", "call_id"), ["conv", "call_id"], "left_anti"), "levels")
        if new.isEmpty():
            return done
        done = saved(done.unionByName(new.select("conv", "call_id", F.col("level").cast("int").alias("level"), "at")), "levels")


def link(events: DataFrame) -> DataFrame:
    """events with linked_turn, status, order_turn and level."""
    keyed = events.withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    first = lambda kind, name: keyed.where(F.col("kind") == kind).groupBy("conv", "call_id").agg(F.min(F.struct(F.coalesce("turn", F.lit(-1)).alias("turn"), "part", F.xxhash64("content", "arguments").alias("h"), "cites")).alias("f")).select("conv", "call_id", F.col("f.turn").alias(f"{name}_turn"), *([F.col("f.cites").alias("cites")] if kind == "call" else []))
    pairs = saved(first("call", "call").join(first("result", "result"), ["conv", "call_id"], "full"), "pairs")
    levels = _levels(pairs.where("call_turn is not null"))
    known = pairs.join(levels, ["conv", "call_id"], "left").select(F.col("conv").alias("_v"), F.col("call_id").alias("_i"), "call_turn", "result_turn", F.col("level").alias("_level"), F.col("at").alias("_at"))
    joined = keyed.join(known, (F.col("conv") == F.col("_v")) & (F.col("call_id") == F.col("_i")), "left")
    call, result = F.col("kind") == "call", F.col("kind") == "result"
    own = F.coalesce("turn", F.lit(-1))
    return joined.withColumns({
        "linked_turn": F.when(call, F.col("result_turn")).when(result, F.col("call_turn")),
        "status": F.when(call & (own != F.col("call_turn")) | result & (own != F.col("result_turn")), "repeated")
        .when(call, F.when(F.col("result_turn").isNull(), "unanswered").otherwise("linked"))
        .when(result, F.when(F.col("call_turn").isNull(), "orphan").otherwise("linked")).otherwise("plain"),
        "order_turn": F.when(call, F.greatest(own, "_at")).when(result, F.greatest(own, "_at")).otherwise(own),
        "level": F.when(call, F.col("_level")).when(result, F.when(F.col("call_turn").isNull(), 0).otherwise(F.col("_level") + 1)).otherwise(0).cast("int"),
    }).drop("conv", "_v", "_i", "call_turn", "result_turn", "_level", "_at")


def format_events(linked: DataFrame, schemas: dict[str, Any], raw_argument: str = "prompt") -> DataFrame:
    """linked events with ``valid`` (calls only) and ``canonical``; arguments marked raw are texts for ``raw_argument``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok, out = [], []
            for e in b.select(["conv_id", "turn", "role", "kind", "call_id", "name", "arguments", "content", "_raw"]).to_pylist():
                raw = e.pop("_raw")
                body = {k: v for k, v in e.items() if v is not None and k not in ("kind",)}
                good = None
                if e["kind"] == "call":
                    arguments = {raw_argument: e["arguments"]} if raw else json.loads(e["arguments"])
                    body["arguments"] = arguments
                    good = e["name"] in schemas and valid(arguments, schemas[e["name"]])
                elif e["kind"] == "result" and not raw:
                    body["content"] = json.loads(e["content"])
                ok.append(good), out.append(canonical(body))
            keep = [b.column(n) for n in ("conv_id", "turn", "role", "part", "kind", "call_id", "linked_turn", "status", "order_turn", "level")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(ok, pa.bool_()), pa.array(out, pa.string())], list("abcdefghijkl"))

    raw = linked if "_raw" in linked.columns else linked.withColumn("_raw", F.lit(False))
    return raw.mapInArrow(lean(run), "conv_id long, turn long, role string, part int, kind string, call_id string, linked_turn long, status string, order_turn long, level int, valid boolean, canonical string")


#: The tool that plain turns are taken to call.
TURN_SCHEMAS = {"respond": {"type": "object", "required": ["prompt"], "additionalProperties": False, "properties": {"prompt": {"type": "string", "minLength": 1}}}}


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = turn_pairs(parse_events(table(spark, sf_dir, "conversations")))
    return format_events(link(events), TURN_SCHEMAS)


ORACLE = r"""
with m as (select cast(conv_id as bigint) as conv_id, cast(turn as bigint) as turn, role, text,
                  case when role = 'user' then 'call' when role = 'assistant' and turn > 0 then 'result' else 'message' end as kind,
                  case when role = 'user' then 'turn-' || turn when role = 'assistant' and turn > 0 then 'turn-' || (turn - 1) end as call_id
           from conversations),
c as (select conv_id, call_id, min(turn) as call_turn from m where kind = 'call' group by all),
r as (select conv_id, call_id, min(turn) as result_turn from m where kind = 'result' group by all)
select m.conv_id, turn, role, cast(0 as integer) as part, kind, m.call_id,
       case kind when 'call' then result_turn when 'result' then call_turn end as linked_turn,
       case when kind = 'message' then 'plain' when kind = 'call' then case when turn <> call_turn then 'repeated' when result_turn is null then 'unanswered' else 'linked' end
            when turn <> result_turn then 'repeated' when call_turn is null then 'orphan' else 'linked' end as status,
       case when kind = 'message' then turn else greatest(turn, coalesce(call_turn, turn)) end as order_turn,
       cast(case when kind = 'result' and call_turn is not null then 1 else 0 end as integer) as level,
       case when kind = 'call' then coalesce(length(text) > 0, false) end as valid,
       case kind when 'call' then cast(json_object('arguments', json_object('prompt', text), 'call_id', m.call_id, 'conv_id', m.conv_id, 'name', 'respond', 'role', role, 'turn', turn) as varchar)
            when 'result' then cast(json_object('call_id', m.call_id, 'content', text, 'conv_id', m.conv_id, 'role', role, 'turn', turn) as varchar)
            else cast(json_object('content', text, 'conv_id', m.conv_id, 'role', role, 'turn', turn) as varchar) end as canonical
from m left join c on m.conv_id = c.conv_id and m.call_id = c.call_id left join r on m.conv_id = r.conv_id and m.call_id = r.call_id
"""
