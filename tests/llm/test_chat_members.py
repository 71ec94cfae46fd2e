"""Members that the operator does not know, nested calls, numbers that no double holds, repeated keys, and odd elements."""

import json

import pytest

from catalume.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
SCHEMAS = {"t": {"v": ("double", True), "u": ("string", False)}, "none": {}}


def formatted(spark, *rows):
    return {(x.conv_id, x.turn): x for x in chat.formatted(spark.createDataFrame(rows, SCHEMA), SCHEMAS).collect()}


def test_all_members_stay(spark):
    call = {"id": "a", "type": "function", "index": 0, "name": "t", "arguments": '{"v": 1.5}', "x\"y": {"b": [1, None], "a": "é\n"}}
    message = {"role": "user", "refusal": None, "name": "bot", "content": [{"type": "text", "text": "hi"}], "tool_calls": [call], "metadata": {"z": 1, "a": {}}}
    result = {"tool_call_id": "a", "is_error": True, "name": "t", "content": {"k": 1}}
    out = formatted(spark, (1, 0, "assistant", json.dumps(message)), (1, 1, "tool", json.dumps(result)), (1, 2, "tool", '{"tool_call_id":"b"}'))
    want = message | {"role": "assistant", "tool_calls": [call | {"arguments": '{"v":1.5}'}]}
    dump = lambda x: json.dumps(x, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert out[1, 0].message == dump(want) and (out[1, 0].n_calls, out[1, 0].n_valid) == (1, 1)
    assert out[1, 1].message == dump(result | {"role": "tool"}) and out[1, 1].linked
    assert out[1, 2].message == '{"content":null,"role":"tool","tool_call_id":"b"}' and not out[1, 2].linked


def test_nested_calls(spark):
    calls = [{"id": "b", "type": "function", "function": {"name": "t", "arguments": '{"v":1}', "strict": True}}, {"id": "c", "function": {"name": "t", "arguments": {"u": 1, "v": 2}}}, {"function": {}}, {"id": "d", "function": "no object", "name": "none", "arguments": "{}"}]
    turns = [(1, 1, "assistant", json.dumps({"content": "x", "tool_calls": calls})), (1, 0, "tool", '{"tool_call_id":"c","content":""}')]
    out = formatted(spark, *turns)
    got = json.loads(out[1, 1].message)["tool_calls"]
    assert got[0] == calls[0] and got[1] == {"id": "c", "function": {"name": "t", "arguments": '{"u":1,"v":2}'}} and got[2] == {"id": None, "function": {"name": None, "arguments": None}} and got[3] == calls[3]
    assert (out[1, 1].n_calls, out[1, 1].n_valid) == (4, 2)
    assert (out[1, 0].linked, out[1, 0].order_turn, out[1, 0].order_step) == (True, 1, 2)
    found = {x.call_id: (x.name, x.arguments) for x in chat.links(spark.createDataFrame(turns, SCHEMA)).collect()}
    assert found == {"b": ("t", '{"v":1}'), "c": ("t", '{"u":1,"v":2}'), "d": ("none", "{}")}


@pytest.mark.parametrize(("arguments", "valid"), [('{"v":1e400}', 0), ('{"v":-1E+999}', 0), ('{"v":1,"v":2}', 0), ('{"v":' + "9" * 400 + "}", 0), ("{", 0), ("[1]", 0), ('{"v":1e-400}', 1), ('{"v":1e300}', 1), ('{"v":0e400}', 1), ('{"v":1,"u":"1e400 \\" 1e400"}', 1), ('{"u":"Infinity","v":2}', 1), ('{"v":"Infinity"}', 0)])
def test_arguments_that_are_refused_stay_as_they_are(spark, arguments, valid):
    out = formatted(spark, (1, 0, "assistant", json.dumps({"content": None, "tool_calls": [{"id": "a", "name": "t", "arguments": arguments}]})))[1, 0]
    got = json.loads(out.message)["tool_calls"][0]["arguments"]
    assert out.n_valid == valid and (json.loads(got) == json.loads(arguments) if valid else got == arguments)


def test_objects_that_are_refused_are_content(spark):
    texts = ['{"tool_calls":[],"a":1,"a":2}', '{"tool_calls":[],"n":1e400}', '{"tool_calls":"x"}', '{"content":"no calls"}', "{", '[{"tool_calls":[]}]']
    out = formatted(spark, *[(1, i, "assistant", x) for i, x in enumerate(texts)], (1, 9, "user", '{"tool_calls":[]}'))
    assert [json.loads(out[1, i].message) for i in range(len(texts))] == [{"content": x, "role": "assistant"} for x in texts]
    assert json.loads(out[1, 9].message)["content"] == '{"tool_calls":[]}'


def test_elements_that_are_no_calls(spark):
    out = formatted(spark, (1, 0, "assistant", '{"tool_calls":[null,"x",1,{"id":5,"name":"none","arguments":"{}"}]}'), (1, 1, "tool", '{"tool_call_id":5,"content":1}'))
    assert out[1, 0].message == '{"content":null,"role":"assistant","tool_calls":["x",1,{"arguments":"{}","id":5,"name":"none"}]}'
    assert (out[1, 0].n_calls, out[1, 0].n_valid, out[1, 1].linked) == (1, 1, True)


def test_no_python_in_the_plan(spark):
    df = chat.formatted(chat.with_tools(spark.createDataFrame([(1, 0, "assistant", "x")], SCHEMA)), chat.SCHEMAS)
    assert "Python" not in (plan := df._jdf.queryExecution().executedPlan().toString()) and "Arrow" not in plan
