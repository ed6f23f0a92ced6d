import json
import random

import pytest
from claimlens.llm import chat


def call(i, name, args):
    return {"id": i, "name": name, "arguments": args}


ADD = {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}, "s": {"type": "string", "pattern": "^x", "maxLength": 3}}, "additionalProperties": False}
SHAPE = "conv_id long, turn long, role string, text string, json string, row int"


@pytest.fixture(scope="module")
def chats(spark):
    rows = [
        (1, 0, "system", json.dumps({"tools": [{"name": "add", "parameters": ADD}]})),
        (1, 1, "user", "hi {not json"),
        (1, 2, "tool", json.dumps({"tool_call_id": "c1", "content": "3"})),
        (1, 3, "assistant", json.dumps({"content": "go", "tool_calls": [call("c1", "add", {"b": 1, "a": 2}), call("c1", "add", {"a": -1, "s": "yyyy"})]})),
        (1, 4, "tool", json.dumps({"tool_call_id": "zz", "content": "3"})),
        (1, 5, "tool", json.dumps({"tool_call_id": "c1", "content": "again"})),
        (2, 0, "assistant", json.dumps({"tool_calls": [call("x", "f", {"y": {"$result": "y"}})]})),
        (2, 1, "tool", json.dumps({"tool_call_id": "x", "content": None})),
        (2, 2, "assistant", json.dumps({"tool_calls": [call("y", "f", '{"k": 1.0, "é": [true, null]}')]})),
        (2, 3, "tool", json.dumps({"tool_call_id": "y", "content": "é"})),
        (3, 0, "assistant", json.dumps({"tool_calls": [call("p", "f", {"v": {"$result": "q"}})]})),
        (3, 1, "tool", json.dumps({"tool_call_id": "p", "content": "1"})),
        (3, 2, "assistant", json.dumps({"tool_calls": [call("q", "f", {"v": {"$result": "p"}})]})),
        (3, 3, "tool", json.dumps({"tool_call_id": "q", "content": "1"})),
        (None, 0, "user", None),
        (None, None, None, "x"),
        (4, 0, "user", "same"),
        (4, 0, "user", "same"),
    ]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SHAPE)


def test_linking_order_and_validation(chats):
    rows = chat.format_chats(chats, {"f": {"type": "object"}}).collect()
    assert len(rows) == 18
    at = {(r.conv_id, r.turn): r for r in rows}
    assert (at[1, 2].link, at[1, 4].link, at[1, 5].link) == ("linked", "orphan", "extra")
    assert (at[1, 2].order_turn, at[1, 2].order_depth) == (3, 1)
    calls = json.loads(at[1, 3].json)["tool_calls"]
    assert calls[0]["errors"] == ["$: b is not allowed"] and calls[1]["link"] == "duplicate" and len(calls[1]["errors"]) == 3
    assert at[1, 3].n_calls == 2 and at[1, 3].n_invalid == 2 and at[1, 3].n_open == 0
    order = [r.turn for r in sorted((r for r in rows if r.conv_id == 2), key=lambda r: (r.order_turn, r.order_depth, r.turn))]
    assert order == [2, 3, 0, 1]
    assert '"arguments":{"k":1.0,"é":[true,null]}' in at[2, 2].json
    assert all(at[3, t].cyclic for t in range(4)) and not any(r.cyclic for r in rows if r.conv_id != 3)
    assert at[None, 0].json == '{"content":null,"role":"user"}'


def test_json_is_canonical(chats):
    for r in chat.format_chats(chats).collect():
        assert chat.canonical(json.loads(r.json)) == r.json


def test_schema_rules():
    v = chat.violations
    assert v(True, {"type": "integer"}) and not v(1.0, {"type": "integer"}) and not v(None, {"type": ["null", "string"]})
    assert v(3, {"enum": [1, "3"]}) and v([1, "a"], {"items": {"type": "integer"}}) == ["$[1]: not of type \"integer\""]
    assert v({"k": 1}, False) and not v({"k": 1}, True) and v("abcd", {"maxLength": 3}) and v([], {"minItems": 1})
    with pytest.raises(ValueError):
        chat.strict('{"a":1,"a":2}')


def test_empty(chats):
    assert chat.format_chats(chats.where("false")).count() == 0


def test_query_formats_every_message(spark):
    sf = "/root/testdata/sf0.001"
    want = sorted(json.dumps({"role": r.role, "content": r.text}, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect())
    assert sorted(r.json for r in chat.op10_chat_formatting(spark, sf).collect()) == want


@pytest.mark.parametrize(
    ("schema", "good", "bad"),
    [
        ({"anyOf": [{"type": "integer"}, {"type": "null"}]}, [1, None], ["x"]),
        ({"oneOf": [{"minimum": 2}, {"maximum": 4}]}, [1, 5], [3]),
        ({"allOf": [{"minimum": 2}, {"maximum": 4}]}, [3], [1, 5]),
        ({"not": {"type": "string"}}, [1], ["x"]),
        ({"if": {"minimum": 5}, "then": {"multipleOf": 5}, "else": {"maximum": 2}}, [10, 1], [7, 3]),
        ({"$defs": {"t/": {"type": "object", "properties": {"n": {"$ref": "#/$defs/t~1"}}, "required": ["v"]}}, "$ref": "#/$defs/t~1"}, [{"v": 1, "n": {"v": 2}}], [{"v": 1, "n": {}}]),
        ({"exclusiveMinimum": 0, "exclusiveMaximum": 2}, [1], [0, 2]),
        ({"minimum": 0, "exclusiveMinimum": True, "maximum": 2, "exclusiveMaximum": False}, [1, 2], [0]),
        ({"multipleOf": 0.1}, [0.3, 1e300, 7], [0.35]),
        ({"uniqueItems": True}, [[1, True, "1"], "aa"], [[1, 1.0], [{"a": 1}, {"a": 1}]]),
        ({"patternProperties": {"^n": {"type": "number"}}, "additionalProperties": False}, [{"n1": 2}], [{"n1": "x"}, {"m": 2}]),
        ({"minProperties": 1, "maxProperties": 2}, [{"a": 1}], [{}, {"a": 1, "b": 1, "c": 1}]),
        ({"propertyNames": {"maxLength": 1}}, [{"a": 1}], [{"ab": 1}]),
        ({"dependentRequired": {"a": ["b"]}, "dependencies": {"c": {"required": ["d"]}}}, [{"a": 1, "b": 1}, {"c": 1, "d": 1}], [{"a": 1}, {"c": 1}]),
        ({"prefixItems": [{"type": "string"}], "items": {"type": "integer"}}, [["x", 1]], [[1], ["x", "y"]]),
        ({"items": [{"type": "string"}], "additionalItems": False}, [["x"]], [[1], ["x", "y"]]),
        ({"contains": {"type": "string"}, "maxContains": 1}, [["x", 1]], [[1], ["x", "y"]]),
    ],
)
def test_schema_keywords(schema, good, bad):
    assert [chat.violations(x, schema) for x in good] == [[]] * len(good)
    assert all(chat.violations(x, schema) for x in bad)


def test_what_cannot_be_checked_is_an_error():
    v = chat.violations
    assert v(1, {"unevaluatedItems": False}) == ["#: unsupported keyword unevaluatedItems"]
    assert v(1, {"not": {"odd": 1}, "type": "integer"})[0] == "#/not: unsupported keyword odd"
    assert v({}, {"properties": {"a": {"type": "file"}}}) == ['#/properties/a: unsupported type "file"']
    assert v(1, {"$ref": "http://x/y"}) == ['#: unsupported reference "http://x/y"']
    assert v(1, {"$ref": "#/$defs/none"}) == ['#: unsupported reference "#/$defs/none"']
    assert v({"odd": 1}, {"title": "t", "properties": {"odd": {"default": {"odd": 1}, "format": "date"}}}) == []
    assert chat._checked("1", '{"multipleOf": 0}')[1] and chat._checked("1", '{"minimum": "x"}')[1]


def test_unsupported_schemas_count_as_invalid(spark):
    tools = [{"name": n, "parameters": {"properties": {"a": p}}} for n, p in (("any", {"anyOf": [{"type": "integer"}, {"type": "null"}]}), ("odd", {"odd": 1}))]
    calls = [call("1", "any", {"a": 1}), call("2", "any", {"a": "x"}), call("3", "odd", {"a": 1})]
    rows = [(1, 0, "system", json.dumps({"tools": tools})), (1, 1, "assistant", json.dumps({"tool_calls": calls}))]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [r.n_invalid for r in out.orderBy("turn").collect()] == [0, 2]


def plain(rows):
    """Linking, order and validation of messages (conv, turn, role, text) in plain Python, one conversation at a time."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == conv]
        parsed = [json.loads(r[3]) if r[3].startswith("{") else {} for r in own]
        tools = {t["name"]: t["parameters"] for m in parsed for t in m.get("tools", [])}
        calls, results = {}, {}
        for k, m in enumerate(parsed):
            for n, c in enumerate(m.get("tool_calls", [])):
                calls.setdefault(c["id"], []).append((own[k][1], k, n))
            if "tool_call_id" in m:
                results.setdefault(m["tool_call_id"], []).append((own[k][1], k))
        needs = {k: set() for k in range(len(own))}
        for k, m in enumerate(parsed):
            if "tool_call_id" in m and m["tool_call_id"] in calls:
                needs[k].add(min(calls[m["tool_call_id"]])[1])
            for c in m.get("tool_calls", []):
                needs[k] |= {min(results[r])[1] for r in chat.references(c["arguments"]) if r in results}
            needs[k].discard(k)

        def place(k, seen=(), own=own, needs=needs):
            if k in seen:
                raise RecursionError
            return max([(own[k][1], 0), *((e, d + 1) for e, d in (place(p, (*seen, k)) for p in needs[k]))])

        for k, (m, r) in enumerate(zip(parsed, own, strict=True)):
            try:
                spot = (*place(k), False)
            except RecursionError:
                spot = (r[1], 0, True)
            mine = m.get("tool_calls", [])
            invalid = sum(bool(tools.get(c["name"]) and chat.violations(c["arguments"], tools[c["name"]])) for c in mine)
            is_open = sum(c["id"] not in results and min(calls[c["id"]])[1:] == (k, n) for n, c in enumerate(mine))
            link = None
            if "tool_call_id" in m:
                i = m["tool_call_id"]
                link = "orphan" if i not in calls else "linked" if min(results[i])[1] == k else "extra"
            out.append((conv, r[1], *spot, len(mine), is_open, invalid, link))
    return sorted(out, key=str)


@pytest.mark.parametrize("most", [200_000, 0])
def test_conversations_with_calls_equal_plain_python(spark, monkeypatch, most):
    rng, rows = random.Random(11), []
    for conv in range(60):
        ids, turn = [f"c{i}" for i in range(rng.randrange(1, 9))], 0
        rows.append((conv, turn, "system", json.dumps({"tools": [{"name": "add", "parameters": ADD}]})))
        spoken = []
        for i in ids:
            args = {"a": rng.randrange(-1, 3)} | ({"b": {"$result": rng.choice(ids)}} if rng.random() < 0.6 else {})
            spoken.append(("assistant", json.dumps({"tool_calls": [call(i, rng.choice(["add", "f"]), args)]})))
            if rng.random() < 0.85:
                spoken.append(("tool", json.dumps({"tool_call_id": rng.choice([i, i, i, "zz"]), "content": "1"})))
            spoken.append(("user", "plain"))
        rng.shuffle(spoken)
        rows += [(conv, turn := turn + 1, role, text) for role, text in spoken]
    monkeypatch.setattr(chat._order, "__defaults__", (most,))
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1))
    names = ["conv_id", "turn", "order_turn", "order_depth", "cyclic", "n_calls", "n_open", "n_invalid", "link"]
    assert sorted((tuple(r) for r in got.select(names).collect()), key=str) == plain(rows)


def test_long_chain_takes_no_round_a_link(spark):
    n = 3000
    rows = [(1, 2 * i + k, "x", t) for i in range(n) for k, t in enumerate((json.dumps({"tool_calls": [call(f"c{i}", "f", {"v": {"$result": f"c{i - 1}"}})]}), json.dumps({"tool_call_id": f"c{i}"})))]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert all((r.order_turn, r.order_depth, r.cyclic) == (r.turn, 0, False) for r in out) and len(out) == 2 * n


def test_malformed_schemas_and_odd_content(spark):
    odd = [{"type": 5}, {"required": 5}, {"enum": 7}, {"properties": 3}, {"minLength": "x"}, {"pattern": "("}, {"pattern": 3}, {"allOf": 1}, {"$ref": "#"}, {"dependencies": [1]}, {"items": 3}, {"pattern": "(a+)+$"}]
    calls = [call(f"{k}", f"t{k}", '{"s":"%s!","r":{"$result":"0"}}' % ("a" * 40)) for k in range(len(odd))]
    tools = [{"name": f"t{k}", "parameters": {"properties": {"s": s}} if "pattern" in s or "minLength" in s else s} for k, s in enumerate(odd)]
    rows = [
        (1, 0, "system", json.dumps({"tools": tools})),
        (1, 1, "assistant", json.dumps({"tool_calls": calls})),
        (1, None, "tool", '{"tool_call_id":"0","content":1e400}'),
        (1, 3, "tool", '{"tool_call_id":"1","content":"\\ud800 x"}'),
        (1, 4, "assistant", '{"tool_calls":[{"id":"s","name":"f","arguments":{"\\ud800":"\\udc00"}}]}'),
        (1, 5, "assistant", '{"content":' + "[" * 5000 + "]" * 5000 + "}"),
    ]
    got = {r.turn: r for r in chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert (got[1].n_calls, got[1].n_invalid) == (len(odd), len(odd))
    assert all(c["arguments"]["r"] == {"$result": "0"} for c in json.loads(got[1].json)["tool_calls"])
    assert json.loads(got[None].json)["content"] == '{"tool_call_id":"0","content":1e400}'
    assert '"content":"\\ud800 x"' in got[3].json and '{"\\ud800":"\\udc00"}' in got[4].json
    assert json.loads(got[5].json)["content"] == rows[5][3]  # no object that is read, so plain


def test_numbers_are_compared_as_numbers():
    assert not chat.violations(1.0, {"enum": [1]}) and not chat.violations(1, {"const": 1.0}) and not chat.violations([1.0, {"a": 2}], {"const": [1, {"a": 2.0}]})
    assert chat.violations(True, {"enum": [1]}) and chat.violations("1", {"const": 1}) and chat.violations(1.5, {"enum": [1, 2]})
