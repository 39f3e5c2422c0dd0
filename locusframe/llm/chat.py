"""Tool-call linking: calls and results joined by identifier, ordered, validated, written as JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: object) -> str:
    """JSON with sorted keys, no blanks, and text left unescaped where JSON allows."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


class Refused(ValueError):
    """Why a text is not taken as the arguments of a call."""


def _finite(text: str) -> float:
    value = float(text)
    if value in (float("inf"), float("-inf")):
        raise Refused("$: not finite")
    return value


def _no_constant(text: str) -> None:
    raise Refused("$: not finite")


def _once(pairs: list[tuple[str, object]]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise Refused("$: repeated key")
    return found


def parsed(text: str) -> tuple[object, list[str]]:
    """The value of a JSON text, or the text itself with the fault that keeps it from being written as JSON.

    Refused are texts that are no JSON, NaN and numbers beyond a double, repeated keys, half of a
    surrogate pair, and nesting deeper than the reader goes.
    """
    try:
        value = json.loads(text, parse_float=_finite, parse_constant=_no_constant, object_pairs_hook=_once)
        canonical(value).encode("utf-8")
    except Refused as refused:
        return text, [str(refused)]
    except UnicodeEncodeError:
        return text, ["$: not text"]
    except RecursionError:
        return text, ["$: too deep"]
    except ValueError:
        return text, ["$: not JSON"]
    return value, []


def _same(a: object, b: object) -> bool:
    """Equality of JSON values: true is not 1, inside of lists and objects too."""
    return canonical(a) == canonical(b) or type(a) in (int, float) and type(b) in (int, float) and a == b


def faults(value: object, schema: dict, at: str = "$") -> list[str]:
    """Where a value breaks a JSON schema (type, enum, bounds, required, properties, items)."""
    kind = schema.get("type")
    if kind and (not isinstance(value, TYPES[kind]) or kind in ("integer", "number") and isinstance(value, bool)):
        return [f"{at}: not {kind}"]
    found = [f"{at}: not allowed"] if "enum" in schema and not any(_same(value, x) for x in schema["enum"]) else []
    if isinstance(value, str):
        found += [f"{at}: too short"] * (len(value) < schema.get("minLength", 0)) + [f"{at}: too long"] * (len(value) > schema.get("maxLength", len(value)))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{at}: too small"] * (value < schema.get("minimum", value)) + [f"{at}: too large"] * (value > schema.get("maximum", value))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                found += faults(v, known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        found += [x for i, v in enumerate(value) for x in faults(v, schema["items"], f"{at}[{i}]")]
    return found


def _checked(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            problems, lines = [], []
            for row in batch.to_pylist():
                arguments, own = parsed(row["arguments"]) if row["arguments"] is not None else (None, [])
                if row["name"] not in schemas:
                    own.append("unknown tool")
                elif not own:
                    own = faults(arguments, schemas[row["name"]])
                problems.append(own)
                lines.append(canonical({"arguments": arguments, "id": row["call_id"], "name": row["name"], "result": row["result"]}))
            names = [c for c in batch.schema.names if c not in ("arguments", "result", "name")]
            arrays = [*(batch.column(c) for c in names), pa.array(problems, pa.list_(pa.string())), pa.array(lines, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "faults", "json"])

    return run


def _spread(calls: DataFrame, pointer: str) -> DataFrame:
    """Add the join key of a pointer. Calls that point nowhere get their own id as key and ``start``, so
    they are dealt evenly and meet nothing."""
    return calls.withColumn("start", F.col(pointer).isNull()).withColumn("key", F.coalesce(pointer, "call_id"))


def depths(nodes: DataFrame) -> DataFrame:
    """Place of each call in its chain: call_id, depth (0 for a start; null on or behind a cycle).

    ``nodes`` has call_id (unique) and after (the call it builds on, or null; an unknown one counts as
    null). Pointers double each round, so a chain of n calls takes log n rounds; more rounds than the
    count of nodes allows mean a cycle.
    """
    known = nodes.select(F.col("call_id").alias("key"), F.lit(False).alias("start"), F.lit(True).alias("known"))
    joined = _spread(nodes, "after").join(known, ["start", "key"], "left")
    current = written(joined.select("call_id", F.when(F.col("known"), F.col("after")).alias("jump"), F.when(F.col("known"), 1).otherwise(0).cast("long").alias("depth")), "chain")
    rounds = current.count().bit_length() + 1
    for _ in range(rounds):
        if current.filter("jump is not null").isEmpty():
            break
        ahead = current.select(F.col("call_id").alias("key"), F.lit(False).alias("start"), F.col("jump").alias("far"), F.col("depth").alias("more"))
        joined = _spread(current, "jump").join(ahead, ["start", "key"], "left")
        current = written(joined.select("call_id", F.col("far").alias("jump"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "chain")
    return current.select("call_id", F.when(F.col("jump").isNull(), F.col("depth")).alias("depth"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call identifier, with its result, its order, its faults and its canonical JSON.

    ``calls`` has call_id, turn, name, arguments (JSON text) and after (the call it builds on, or null);
    ``results`` has call_id, turn and result. Repeated identifiers collapse to the first by turn, name and
    arguments (or turn and result) before the join, and are counted. Result: call_id, turn, result_turn,
    n_calls, n_results, depth (place in the chain of calls; sorting by it is a topological order; null on
    a cycle), faults (list; also "no result", "result before call", "repeated call" and "cycle") and json.
    Calls without identifier are dropped from the links and cannot have results; orphan results come back
    with a null turn and the fault "no call". Arguments that ``parsed`` refuses stay as text, with its fault.
    """
    first_call = calls.filter("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("call"), F.count(F.lit(1)).alias("n_calls"))
    first_result = results.filter("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "result")).alias("answer"), F.count(F.lit(1)).alias("n_results"))
    linked = first_call.join(first_result, "call_id", "full")
    order = depths(first_call.select("call_id", F.col("call.after").alias("after")))
    rows = linked.join(order, "call_id", "left").select(
        "call_id", F.col("call.turn").alias("turn"), F.col("answer.turn").alias("result_turn"), F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        "depth", F.col("call.name").alias("name"), F.col("call.arguments").alias("arguments"), F.col("answer.result").alias("result"),
    )
    out = rows.mapInArrow(_checked(schemas), "call_id string, turn long, result_turn long, n_calls long, n_results long, depth long, faults array<string>, json string")
    said = [
        F.when(F.col("n_calls") == 0, "no call"), F.when(F.col("n_calls") > 1, "repeated call"), F.when((F.col("n_calls") > 0) & (F.col("n_results") == 0), "no result"),
        F.when(F.col("result_turn") <= F.col("turn"), "result before call"), F.when((F.col("n_calls") > 0) & F.col("depth").isNull(), "cycle"),
    ]
    own = F.when(F.col("n_calls") == 0, F.array().cast("array<string>")).otherwise(F.col("faults"))
    return out.withColumn("faults", F.array_sort(F.concat(own, F.array_compact(F.array(*said)))))


#: What a user's turn asks of the assistant, as a call.
REPLY_SCHEMA = {"reply": {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False, "properties": {"prompt": {"type": "string", "minLength": 1, "maxLength": 400}, "turn": {"type": "integer", "minimum": 0}}}}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text).

    A user's turn calls the tool ``reply`` and builds on the user's turn two before it; an assistant's
    turn is the result of the call one turn before. Rows without conv_id or turn make neither.
    """
    rows = turns.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").filter("conv_id is not null and turn is not null")
    name = lambda back: F.concat_ws(":", "conv_id", (F.col("turn") - back).cast("string"))
    asked = F.to_json(F.struct(F.col("text").alias("prompt"), "turn"))
    calls = rows.filter("role = 'user'").select(name(0).alias("call_id"), "turn", F.lit("reply").alias("name"), asked.alias("arguments"), F.when(F.col("turn") >= 2, name(2)).alias("after"))
    results = rows.filter("role = 'assistant'").select(name(1).alias("call_id"), "turn", F.col("text").alias("result"))
    return calls, results
