"""Chat formatting by tool-call linking.

Messages are calls, results and plain messages. Results are hash-joined with calls by (conversation, call id). A
call may name an earlier call that it builds on; the messages of a conversation are put in a topological order (a call
after the calls it builds on, a result right after its call), found by pointer doubling over the whole table at once, so a
long chain takes a logarithmic number of rounds and a large conversation is never gathered. Arguments are
validated against the tool's schema and every message is serialised as canonical JSON (sorted keys,
no spaces, UTF-8).

Order: by the latest turn among a call and the calls it builds on, then by depth, then by turn and id; the result follows
its call. Calls on a cycle, or building on one, are flagged `cyclic` and stand at their own turn, as do results without a call.

Defined cases: several calls with one id: the first by turn takes the links, all are kept; repeated results each follow the call; null
text is empty content; null ids never link; arguments that aren't a JSON object are invalid, and so are NaN and infinities, numbers
beyond a double and nesting deeper than MAX_DEPTH; what can't be read is kept as a string; lone surrogates are written as escapes, so
every message is JSON that reads back; unknown tools are invalid; clashing and further columns of the messages are ignored; a call that builds on an unknown call is treated as building on none; empty tables give no row.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from .common import positions, ship, written

# messages: conv_id long, turn long, kind string (call, result, message), role string, call_id string, after string,
# name string, content string (arguments of a call as JSON, else text)
MESSAGE_COLUMNS = ("conv_id", "turn", "kind", "role", "call_id", "after", "name", "content")

MAX_DEPTH = 100  # levels of nesting in arguments, a parameter of what is valid

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list}


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """Rules of a JSON schema (type, enum, bounds, required, properties, items) that a value breaks."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        return [f"{at}: not {kind}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if isinstance(value, str):
        found += [f"{at}: too short"] * (len(value) < schema.get("minLength", 0))
        found += [f"{at}: too long"] * (len(value) > schema.get("maxLength", float("inf")))
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        found += [f"{at}: below minimum"] * (value < schema.get("minimum", float("-inf")))
        found += [f"{at}: above maximum"] * (value > schema.get("maximum", float("inf")))
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k}: missing" for k in sorted(schema.get("required", ())) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += violations(x, schema["items"], f"{at}[{i}]")
    return found


_LONE_SURROGATE = re.compile("[\ud800-\udfff]")


def _writable(text: str) -> str:
    """Lone surrogates, which UTF-8 can't hold, as JSON escapes."""
    return _LONE_SURROGATE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value) -> str:
    """Sorted keys, no spaces, UTF-8. Whole-number literals keep their digits; other numbers take the shortest form that reads
    back as the same double."""
    return _writable(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def _double(digits: str) -> float:
    value = float(digits)
    if math.isinf(value):
        raise OverflowError(f"{digits} is beyond a double")
    return value


def _depth(value, most: int = MAX_DEPTH + 1) -> int:
    """Levels of nesting, counted up to `most`, without recursion."""
    depth, level = 0, [value]
    while depth < most and (level := [x for x in level if isinstance(x, (dict, list))]):
        depth += 1
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x)]
    return depth


def read_arguments(text: str | None) -> tuple[object, str | None]:
    """The value of a JSON text, or the text itself and what is wrong with it."""
    try:
        value = json.loads(text or "", parse_constant=_no_constant, parse_float=_double)
    except RecursionError:
        return text, "$: nested too deep"
    except OverflowError:
        return text, "$: number out of range"
    except ValueError:
        return text, "$: not JSON"
    return (text, "$: nested too deep") if _depth(value) > MAX_DEPTH else (value, None)


def _format(schemas: dict[str, dict]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("kind", "role", "call_id", "name", "content")}
            messages, valid, errors = [], [], []
            for kind, role, call_id, name, content in zip(*columns.values()):
                if kind != "call":
                    body = {"content": content or "", "role": role}
                    messages.append(canonical(body | ({"tool_call_id": call_id} if kind == "result" else {})))
                    valid.append(None)
                    errors.append("")
                    continue
                arguments, problem = read_arguments(content)
                found = [problem] if problem else violations(arguments, {"type": "object"})
                if not found:
                    found = violations(arguments, schemas[name]) if name in schemas else [f"{name}: unknown tool"]
                messages.append(canonical({"role": role, "tool_call": {"arguments": arguments, "id": call_id, "name": name}}))
                valid.append(not found)
                errors.append(_writable("; ".join(found)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(messages, pa.string()), pa.array(valid, pa.bool_()), pa.array(errors, pa.string())],
                names=[*batch.schema.names, "message", "valid", "errors"])

    return run


def call_order(messages: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth, last_turn, cyclic) of each distinct call id, by pointer doubling."""
    calls = messages.where("kind = 'call' and call_id is not null and conv_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", "after")).alias("first")).select("conv_id", "call_id", "first.turn", F.col("first.after").alias("parent"))
    calls = written(calls, "calls")
    known = calls.select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("there"))
    state = calls.join(known, ["conv_id", "parent"], "left").select(
        "conv_id", "call_id", F.col("turn").alias("own_turn"), F.when(F.col("there"), F.col("parent")).alias("next"),
        F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"), F.col("turn").alias("last_turn"))
    # depth: links passed so far; last_turn: over the call and all nodes passed, `next` excluded
    open_before = None
    while True:
        state = written(state, "call-order")
        still_open = state.where("next is not null").count()
        if still_open in (0, open_before):
            return state.select("conv_id", "call_id", F.when(F.col("next").isNull(), F.col("depth")).otherwise(0).alias("depth"),
                                F.when(F.col("next").isNull(), F.col("last_turn")).otherwise(F.col("own_turn")).alias("last_turn"),
                                F.col("next").isNotNull().alias("cyclic"))
        open_before = still_open
        hop = state.select("conv_id", F.col("call_id").alias("next"), F.col("next").alias("next2"), F.col("depth").alias("depth2"),
                           F.col("last_turn").alias("last2"))
        state = state.join(hop, ["conv_id", "next"], "left").select(
            "conv_id", "call_id", "own_turn", F.col("next2").alias("next"),
            (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
            F.greatest("last_turn", "last2").alias("last_turn"))


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message: conv_id, position, turn, role, call_id, linked, cyclic, valid, errors, message.

    `linked`: a call with a result or a result with a call; null for plain messages. `valid`: of calls only.
    """
    ship(messages.sparkSession)
    rows = messages.select(*MESSAGE_COLUMNS)
    order = call_order(rows)
    first_turn = rows.where("kind = 'call'").groupBy("conv_id", "call_id").agg(F.min("turn").alias("call_turn"))
    answered = rows.where("kind = 'result' and call_id is not null").select("conv_id", "call_id").distinct().withColumn("answered", F.lit(True))
    calls = order.join(first_turn, ["conv_id", "call_id"]).join(answered, ["conv_id", "call_id"], "left")
    calls = calls.select("conv_id", "call_id", "depth", "last_turn", "cyclic", "call_turn", F.coalesce("answered", F.lit(False)).alias("answered"))
    joined = rows.join(calls, ["conv_id", "call_id"], "left")
    with_call = (F.col("kind") != "message") & F.col("call_turn").isNotNull()
    keyed = joined.select(
        *MESSAGE_COLUMNS,
        F.when(F.col("kind") == "call", F.coalesce("answered", F.lit(False))).when(
            F.col("kind") == "result", F.col("call_turn").isNotNull()).alias("linked"),
        F.coalesce(with_call & F.col("cyclic"), F.lit(False)).alias("cyclic"),
        F.when(with_call, F.col("last_turn")).otherwise(F.col("turn")).alias("_k1"),
        F.when(with_call, F.col("depth")).otherwise(0).alias("_k2"),
        F.when(with_call, F.col("call_turn")).otherwise(F.col("turn")).alias("_k3"),
        F.when(with_call, F.col("call_id")).otherwise("").alias("_k4"),
        F.when(with_call & (F.col("kind") == "result"), 1).otherwise(0).alias("_k5"))
    formatted = keyed.mapInArrow(_format(schemas), StructType([
        *keyed.schema.fields, StructField("message", StringType()), StructField("valid", BooleanType()), StructField("errors", StringType())]))
    placed = positions(formatted, "conv_id", ["_k1", "_k2", "_k3", "_k4", "_k5", "turn", "message"])
    return placed.select("conv_id", "position", "turn", "role", "call_id", "linked", "cyclic", "valid", "errors", "message")


# The registered query's tools; its messages are derived from the table `conversations`.
TOOLS = {
    "search": {"type": "object", "required": ["limit", "query"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}}},
    "summarize": {"type": "object", "required": ["max_lines", "text"], "additionalProperties": False,
                  "properties": {"text": {"type": "string"}, "max_lines": {"type": "integer", "minimum": 1, "maximum": 3}}},
    "translate": {"type": "object", "required": ["target", "text"], "additionalProperties": False,
                  "properties": {"text": {"type": "string"}, "target": {"type": "string", "enum": ["de", "en", "es", "fr"]}}},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """Turns as messages: a user turn is a call of one of TOOLS, an assistant turn the result of the turn before it.

    A call builds on the next user turn's call if its text's length is a multiple of 3, and on the one before if the rest is 1.
    """
    text = F.coalesce("text", F.lit(""))
    size = F.char_length(text)
    own = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    of = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    call, result = F.col("role") == "user", F.col("role") == "assistant"
    arguments = F.when(F.col("turn") % 3 == 0, F.to_json(F.struct(text.alias("query"), F.size(F.split(text, " ")).alias("limit")))).when(
        F.col("turn") % 3 == 1, F.to_json(F.struct(text.alias("text"), F.size(F.split(text, "\n")).alias("max_lines")))).otherwise(
        F.to_json(F.struct(text.alias("text"), F.element_at(F.array(*map(F.lit, ("de", "en", "es", "fr", "xx"))), size % 5 + 1).alias("target"))))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(call, "call").when(result, "result").otherwise("message").alias("kind"),
        F.when(call, "assistant").when(result, "tool").otherwise(F.col("role")).alias("role"),
        F.when(call, own).when(result, of(F.col("turn") - 1)).alias("call_id"),
        F.when(call & (size % 3 == 0), of(F.col("turn") + 2)).when(call & (size % 3 == 1), of(F.col("turn") - 2)).alias("after"),
        F.when(call, F.element_at(F.array(*map(F.lit, ("search", "summarize", "translate"))), (F.col("turn") % 3 + 1).cast("int"))).alias("name"),
        F.when(call, arguments).otherwise(text).alias("content"))


SQL = r"""
WITH RECURSIVE rows AS (
  SELECT conv_id, turn, role AS r, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         CASE role WHEN 'user' THEN conv_id || '-' || turn WHEN 'assistant' THEN conv_id || '-' || (turn - 1) END AS call_id
  FROM conversations),
calls AS (
  SELECT conv_id, call_id, turn, CASE n % 3 WHEN 0 THEN conv_id || '-' || (turn + 2) WHEN 1 THEN conv_id || '-' || (turn - 2) END AS parent
  FROM rows WHERE r = 'user'),
up AS (SELECT c.conv_id, c.call_id, p.call_id AS a, p.turn AS a_turn FROM calls c JOIN calls p ON c.conv_id = p.conv_id AND c.parent = p.call_id),
anc AS (SELECT conv_id, call_id, a, a_turn FROM up
        UNION SELECT anc.conv_id, anc.call_id, up.a, up.a_turn FROM anc JOIN up ON anc.conv_id = up.conv_id AND anc.a = up.call_id),
cyc AS (SELECT DISTINCT call_id FROM anc WHERE a IN (SELECT call_id FROM anc WHERE a = call_id)),
placed AS (
  SELECT c.conv_id, c.call_id, c.turn AS call_turn, max(y.call_id) IS NOT NULL AS cyclic,
         count(a.a) AS d, max(greatest(c.turn, coalesce(a.a_turn, c.turn))) AS l
  FROM calls c LEFT JOIN anc a ON c.call_id = a.call_id LEFT JOIN cyc y ON c.call_id = y.call_id GROUP BY c.conv_id, c.call_id, c.turn),
formatted AS (
  SELECT rows.conv_id, rows.turn, r, t, n, rows.call_id, call_turn IS NOT NULL AS has_call, coalesce(cyclic, false) AS cyclic,
    CASE WHEN call_turn IS NULL OR cyclic THEN coalesce(call_turn, rows.turn) ELSE l END AS k1,
    CASE WHEN call_turn IS NULL OR cyclic THEN 0 ELSE d END AS k2, coalesce(call_turn, rows.turn) AS k3,
    CASE WHEN call_turn IS NULL THEN '' ELSE rows.call_id END AS k4, (call_turn IS NOT NULL AND r = 'assistant')::INT AS k5,
    rows.turn % 3 AS tool, len(string_split(t, ' ')) AS words, len(string_split(t, chr(10))) AS lines,
    ['de', 'en', 'es', 'fr', 'xx'][n % 5 + 1] AS target
  FROM rows LEFT JOIN placed ON rows.conv_id = placed.conv_id AND rows.call_id = placed.call_id),
messages AS (
  SELECT *,
    CASE r WHEN 'user' THEN '{"role":"assistant","tool_call":{"arguments":' || CASE tool
        WHEN 0 THEN '{"limit":' || words || ',"query":' || to_json(t) || '}'
        WHEN 1 THEN '{"max_lines":' || lines || ',"text":' || to_json(t) || '}'
        ELSE '{"target":' || to_json(target) || ',"text":' || to_json(t) || '}' END
        || ',"id":' || to_json(call_id) || ',"name":"' || ['search', 'summarize', 'translate'][tool + 1] || '"}}'
      WHEN 'assistant' THEN '{"content":' || to_json(t) || ',"role":"tool","tool_call_id":' || to_json(call_id) || '}'
      ELSE '{"content":' || to_json(t) || ',"role":' || to_json(r) || '}' END AS message,
    CASE WHEN r <> 'user' THEN ''
      WHEN tool = 0 THEN concat_ws('; ', CASE WHEN words > 50 THEN '$.limit: above maximum' END, CASE WHEN n = 0 THEN '$.query: too short' END)
      WHEN tool = 1 THEN CASE WHEN lines > 3 THEN '$.max_lines: above maximum' ELSE '' END
      ELSE CASE WHEN target = 'xx' THEN '$.target: not in enum' ELSE '' END END AS errors
  FROM formatted)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY k1, k2, k3, k4, k5, turn, message) - 1 AS position, turn,
       CASE r WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'tool' ELSE r END AS role, call_id,
       CASE r WHEN 'user' THEN EXISTS (SELECT 1 FROM rows x WHERE x.r = 'assistant' AND x.call_id = messages.call_id)
              WHEN 'assistant' THEN has_call END AS linked,
       cyclic, CASE WHEN r = 'user' THEN errors = '' END AS valid, errors, message
FROM messages"""
