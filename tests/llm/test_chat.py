from __future__ import annotations

import json

from airshed.llm import chat as C

SCHEMA = "conv_id long, turn long, kind string, role string, call_id string, after string, name string, content string"
TOOLS = {"f": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 1}, "tags": {"type": "array", "items": {"type": "string"}}},
               "additionalProperties": False}}


def test_violations():
    assert C.violations({"x": 2, "tags": ["a"]}, TOOLS["f"]) == []
    assert C.violations({"x": 0, "tags": ["a", 1], "z": None}, TOOLS["f"]) == ["$.tags[1]: not string", "$.x: below minimum", "$.z: unknown"]
    assert C.violations({"x": True}, TOOLS["f"]) == ["$.x: not integer"] and C.violations({}, TOOLS["f"]) == ["$.x: missing"]
    assert C.violations([], TOOLS["f"]) == ["$: not object"]


def test_linking_order_and_canonical_json(spark):
    rows = [
        (1, 0, "message", "system", None, None, None, "be kind"),
        (1, 1, "call", "assistant", "b", "a", "f", '{"x": 2}'),  # builds on a later call
        (1, 2, "result", "tool", "b", None, None, "vé"), (1, 2, "result", "tool", "b", None, None, "vé"),
        (1, 3, "call", "assistant", "a", None, "f", '{ "tags": [], "x": 1 }'),
        (1, 4, "result", "tool", "a", None, None, None),
        (1, 5, "call", "assistant", "c", "d", "g", "{}"), (1, 6, "call", "assistant", "d", "c", "f", "not json"),  # a cycle
        (1, 7, "result", "tool", "nobody", None, None, "lost"),
        (1, 8, "call", "assistant", None, None, "f", "[1]"), (1, 8, "call", "assistant", "e", "unknown", "f", None),
        (None, 1, "call", "assistant", "a", None, "f", '{"x": 1}'),
    ]
    out = C.link(spark.createDataFrame(rows, SCHEMA), TOOLS).orderBy("conv_id", "position").collect()
    one = [r for r in out if r.conv_id == 1]
    assert [r.position for r in one] == list(range(11)) and out[0].conv_id is None
    assert [r.call_id for r in one][:6] == [None, "a", "a", "b", "b", "b"]  # a and its result before b and its results
    assert [r.call_id for r in one if r.cyclic] == ["c", "d"]
    by = {(r.call_id, r.turn): r for r in one}
    assert by["a", 3].message == '{"role":"assistant","tool_call":{"arguments":{"tags":[],"x":1},"id":"a","name":"f"}}' and by["a", 3].valid
    assert by["b", 2].message == '{"content":"vé","role":"tool","tool_call_id":"b"}'
    assert by["c", 5].errors == "g: unknown tool" and by["d", 6].errors == "$: not JSON"
    assert not by["nobody", 7].linked and not by["e", 8].linked and by[None, 8].errors == "$: not object"
    assert all(C.canonical(json.loads(r.message)) == r.message for r in out)


def test_long_chain_in_one_conversation(spark):
    """Each call builds on the next one: 600 deep, found in a few rounds; the order is turned round."""
    rows = [(5, t, "call", "assistant", str(t), str(t + 1), "f", '{"x": 1}') for t in range(600)]
    out = C.link(spark.createDataFrame(rows, SCHEMA), TOOLS).orderBy("position").collect()
    assert [r.turn for r in out] == list(range(599, -1, -1)) and not any(r.cyclic for r in out)


def test_empty_table(spark):
    assert C.link(spark.createDataFrame([], SCHEMA), TOOLS).count() == 0


ODD = ['{"x": "\\ud800"}', "[" * 100_000 + "]" * 100_000, '{"x": NaN}', '{"x": -Infinity}', '{"x": 1e400}', '{"x": 1.50e0}', '{"x": 1' + "0" * 30 + "}",
       '{"x": 1' + "0" * 5000 + "}", '{"\\udc00": 1}', "[" * 100 + "]" * 100, "[" * 101 + "]" * 101, '"' + "y" * 2_000_000 + '"', None, "", "null",
       '{"x": 1, "x": 2}', "\x00", '{"a": "\\u0000 \\ud83d\\ude00"}']


def test_odd_arguments_neither_crash_nor_make_bad_json(spark):
    rows = [(1, i, "call", "assistant", f"c{i}", None, "f", text, "clash", 5) for i, text in enumerate(ODD)]
    rows.append((1, 99, "result", "tool", "c0", None, None, "z" * 1_000_000, "clash", 5))
    out = C.link(spark.createDataFrame(rows, SCHEMA + ", message string, position int"), TOOLS).collect()
    assert len(out) == len(rows)
    strict = {"parse_constant": lambda name: 1 / 0}
    for r in out:
        assert C.canonical(json.loads(r.message, **strict)) == r.message
    errors = {r.turn: r.errors for r in out}
    assert errors[1] == errors[10] == "$: nested too deep" and errors[9] == "$: not object"
    assert errors[2] == errors[3] == errors[7] == "$: not JSON" and errors[4] == "$: number out of range"
    assert errors[8] == "$.x: missing; $.\\udc00: unknown" and errors[6] == "" and errors[5] == "$.x: not integer"
    messages = {r.turn: r.message for r in out}
    assert '"x":"\\ud800"' in messages[0] and '"x":1.5}' in messages[5]
