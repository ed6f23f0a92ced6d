"""Revision chains, schemas, aligned assertions and guards of overlap, against brute force."""

import json
import random
import re
from collections import Counter

import pytest
from claimlens.functions import schema
from claimlens.operators import align, chains, intervals
from claimlens.plans.staging import Staging
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------- chains


def placed_by_walking(log):
    before = {i: p for i, p in log}
    out = {}
    for i in before:
        at, depth = i, 0
        while at in before and before[at] is not None and depth <= len(log):
            at, depth = before[at], depth + 1
        if at in before and before[at] is None:
            out[i] = (at, depth)
    return out


def test_places_of_chains_trees_and_circles(spark):
    rng = random.Random(1)
    log = [(0, None), (500, None)] + [(i, i - 1) for i in range(1, 150)] + [(600 + i, rng.choice([500, 40, 600 + i - 1])) for i in range(1, 60)]
    log += [(900, 902), (901, 900), (902, 901), (903, 902), (904, 77777), (905, 904), (906, 906)]
    df = spark.createDataFrame(log, "id long, previous long")
    got = {r.id: (r.genesis, r.depth) for r in chains.place(df, Staging(spark, "t")).collect()}
    assert got == placed_by_walking(log) and 903 not in got and 905 not in got


def test_restore_at_every_head(spark, monkeypatch):
    monkeypatch.setattr(chains, "SLOT", 4)
    rng = random.Random(2)
    log = [(c * 1000 + i, c * 1000 + i - 1 if i else None) for c in range(3) for i in range(40)]
    changes = [(i, k, rng.choice([None, f"v{i}"])) for i, _ in log for k in "abcd" if rng.random() < 0.3]
    placed = chains.place(spark.createDataFrame(log, "id long, previous long"), Staging(spark, "t"))
    got = {(r.head, r.key): r.value for r in chains.restore(spark.createDataFrame(changes, "id long, key string, value string"), placed, placed.select("id")).collect()}
    want = {}
    for c in range(3):
        state = {}
        for i in range(c * 1000, c * 1000 + 40):
            state |= {k: v for j, k, v in changes if j == i}
            want |= {(i, k): v for k, v in state.items() if v is not None}
    assert got == want


def test_faults_are_refused(spark):
    rows = [("a", 1, None, 1, "d1", None), ("a", 2, 1, 2, "d2", "d1"), ("a", 3, 1, 3, "d3", "d1"), ("b", 4, None, 1, "d4", None), ("b", 5, 4, 1, "d5", "no"), ("b", 6, None, 3, "d6", None), ("c", 7, 99, 1, "d7", "x"), ("d", 8, None, 1, "d8", None), ("d", 9, 8, 2, "d9", "d8"), ("e", 10, 9, 3, "d10", "d9")]
    log = spark.createDataFrame(rows, "chain string, id long, previous long, clock long, digest string, previous_digest string")
    found = chains.faults(log, chains.place(log, Staging(spark, "t")))
    assert {(r.id, r.fault) for r in found.collect()} == {(2, "fork"), (3, "fork"), (4, "several_geneses"), (6, "several_geneses"), (5, "clock_not_advancing"), (5, "link_differs"), (7, "missing_predecessor"), (7, "no_genesis"), (10, "other_chain")}
    assert {r.chain for r in chains.sound(log, found).collect()} == {"d"}


# ---------------------------------------------------------------- schemas


def plain(v, s, at="$"):
    """The same errors in plain Python."""
    if isinstance(s, bool):
        return [] if s else [f"{at}: nothing is allowed"]
    number = isinstance(v, int | float) and not isinstance(v, bool)
    is_ = lambda k: {"object": isinstance(v, dict), "array": isinstance(v, list), "string": isinstance(v, str), "boolean": isinstance(v, bool), "null": v is None, "number": number, "integer": number and v == int(v)}[k]
    same = lambda a, b: a == b and isinstance(a, bool) == isinstance(b, bool)
    out = []
    say = lambda bad, text: out.append(f"{at}: {text}") if bad else None
    if "type" in s:
        kinds = [s["type"]] if isinstance(s["type"], str) else s["type"]
        say(not any(map(is_, kinds)), f"not of type {'|'.join(kinds)}")
    if "enum" in s:
        say(not any(same(v, x) for x in s["enum"]), "not in enum")
    if "const" in s:
        say(not same(v, s["const"]), "not the constant")
    for x in s.get("allOf", []):
        out += plain(v, x, at)
    for k in ("anyOf", "oneOf"):
        if k in s:
            n = sum(not plain(v, x, at) for x in s[k])
            say(n == 0 if k == "anyOf" else n != 1, f"matches {n} of {k}")
    if "not" in s:
        say(not plain(v, s["not"], at), "matches not")
    if isinstance(v, dict):
        for k in s.get("required", []):
            say(k not in v, f"{k} is missing")
        for k, x in s.get("properties", {}).items():
            out += plain(v[k], x, f"{at}.{k}") if k in v else []
        more = s.get("additionalProperties", True)
        for k in set(v) - set(s.get("properties", {})):
            out += [f"{at}: {k} is not allowed"] if more is False else plain(v[k], more, f"{at}.{k}")
        say(len(v) < s.get("minProperties", 0), "below minProperties")
    if isinstance(v, list):
        for i, x in enumerate(v):
            out += plain(x, s.get("items", True), f"{at}[{i}]")
        say(len(v) < s.get("minItems", 0), "below minItems")
        say(len(v) > s.get("maxItems", len(v)), "above maxItems")
        say(s.get("uniqueItems") and any(same(a, b) for i, a in enumerate(v) for b in v[:i]), "items repeat")
    if isinstance(v, str):
        say(len(v) < s.get("minLength", 0), "below minLength")
        say(len(v) > s.get("maxLength", len(v)), "above maxLength")
        say("pattern" in s and not re.search(s["pattern"], v), "pattern does not match")
    if number:
        say("minimum" in s and v < s["minimum"], "below minimum")
        say("maximum" in s and v > s["maximum"], "above maximum")
        say("exclusiveMinimum" in s and v <= s["exclusiveMinimum"], "not above exclusiveMinimum")
        say("exclusiveMaximum" in s and v >= s["exclusiveMaximum"], "not below exclusiveMaximum")
    return out


SCHEMAS = [
    {"type": "object", "required": ["a", "b"], "properties": {"a": {"type": "integer", "minimum": 2}, "b": {"type": ["string", "null"], "minLength": 2, "pattern": "^x"}, "c": {"type": "array", "items": {"type": "object", "properties": {"d": {"enum": [1, "x", None, True]}}, "additionalProperties": False}, "minItems": 1, "uniqueItems": True}}, "minProperties": 2},
    {"properties": {"a": {"anyOf": [{"const": 1}, {"type": "string"}]}, "b": {"oneOf": [{"type": "number"}, {"minimum": 3}, {"type": "string"}]}, "c": {"not": {"type": "null"}}}, "additionalProperties": {"type": "boolean"}},
    {"type": "array", "items": {"allOf": [{"exclusiveMinimum": 0}, {"exclusiveMaximum": 4}]}, "maxItems": 2},
    True,
    False,
]


def test_compiled_schemas_equal_plain_ones(spark):
    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(9 if depth else 6)
        if kind < 6:
            return [rng.randrange(5), rng.randrange(5) + rng.choice([0.0, 0.5]), rng.choice(["x", "xy", "abc", ""]), None, rng.random() < 0.5, 2**60][kind]
        if kind == 6:
            return [value(depth - 1) for _ in range(rng.randrange(4))]
        return {k: value(depth - 1) for k in rng.sample(["a", "b", "c", "d", "it's \"e\""], rng.randrange(5))}

    values = [value(3) for _ in range(250)] + [{"a": 2.0, "b": None, "c": [{"d": 1.0}, {"d": 1}]}, {"a": 1, "b": 3.0}]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i long, t string")
    for s in SCHEMAS:
        rows = df.select("i", schema.text_errors(F.col("t"), s).alias("e"))
        assert "Python" not in rows._jdf.queryExecution().toString()
        for r in rows.collect():
            assert Counter(r.e) == Counter(plain(values[r.i], s)), (values[r.i], s)


def test_what_cannot_be_checked_is_refused(spark):
    v = F.try_parse_json(F.lit("1"))
    for bad in ({"$ref": "#/a"}, {"enum": [[1]]}, {"type": "date"}, {"properties": {"a'b": {}}}):
        with pytest.raises(ValueError):
            schema.errors(v, bad)
    df = spark.createDataFrame([(None,), ("{",), ("1",)], "t string")
    assert [r.e for r in df.select(schema.text_errors(F.col("t"), {"type": "number"}).alias("e")).collect()] == [None, ["$: not JSON"], []]


def test_schemas_derived_from_types(spark):
    kind = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.ArrayType(T.StringType(), False)), T.StructField("m", T.MapType(T.StringType(), T.DoubleType())), T.StructField("d", T.DateType()), T.StructField("s", T.StructType([T.StructField("t", T.BooleanType(), False)]))])
    own = schema.derive(kind)
    assert own["required"] == ["a"] and own["properties"]["b"] == {"type": ["array", "null"], "items": {"type": "string"}}
    rows = spark.createDataFrame([(1, ["x"], {"k": 1.5}, None, (True,)), (2, None, None, None, None)], kind)
    assert all(r.e == [] for r in rows.select(schema.text_errors(F.to_json(F.struct("*")), own).alias("e")).collect())
    bad = '{"b":[1],"d":"x","s":{"t":null,"u":1}}'
    got = spark.range(1).select(schema.text_errors(F.lit(bad), own).alias("e")).first().e
    assert Counter(got) == Counter(["$: a is missing", "$.b[0]: not of type string", "$.d: pattern does not match", "$.s.t: not of type boolean", "$.s: u is not allowed"])


# ---------------------------------------------------------------- alignment


def longest(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_pairs_are_a_longest_alignment():
    rng = random.Random(6)
    for _ in range(300):
        a = [rng.choice("abcdefghijk") for _ in range(rng.randrange(12))]
        b = [rng.choice("abcdefghijk") for _ in range(rng.randrange(12))]
        got = align.paired(a, b)
        assert sorted(i for _, i, _ in got if i is not None) == list(range(len(a))) and sorted(j for _, _, j in got if j is not None) == list(range(len(b)))
        kept = sorted((i, j) for s, i, j in got if s == "in_order")
        assert all(a[i] == b[j] for i, j in kept) and [j for _, j in kept] == sorted(j for _, j in kept)
        once = {k for k in a if a.count(k) == b.count(k) == 1}
        anchors = [(i, j) for i, j in kept if a[i] in once]
        assert len(anchors) == longest([k for k in a if k in once], [k for k in b if k in once])
        edges = [(-1, -1), *anchors, (len(a), len(b))]
        want = sum(longest([k for k in a[p + 1 : q] if k not in once], [k for k in b[r + 1 : s] if k not in once]) for (p, r), (q, s) in zip(edges, edges[1:], strict=False))
        assert len(kept) - len(anchors) == want
        assert {a[i] for s, i, j in got if s == "moved"} <= once and not {a[i] for s, i, _ in got if s == "removed"} & once


def test_statuses_of_a_page(spark):
    before = [(1, n, k, v) for n, (k, v) in enumerate([("title", "A"), ("date", "May"), ("site", "X"), ("note", "1"), ("note", "2"), ("gone", "g")])] + [(2, 0, "only", "here")]
    after = [(1, n, k, v) for n, (k, v) in enumerate([("title", "A"), ("site", "X"), ("note", "1"), ("date", "June"), ("note", "3"), ("new", "n")])] + [(3, 0, "other", "there")]
    shape = "page long, at int, key string, literal string"
    got = {(r.page, r.key, r.status, r.before_at, r.after_at) for r in align.align(spark.createDataFrame(before, shape), spark.createDataFrame(after, shape)).collect()}
    assert got == {(1, "title", "kept", 0, 0), (1, "date", "moved", 1, 3), (1, "site", "kept", 2, 1), (1, "note", "kept", 3, 2), (1, "note", "changed", 4, 4), (1, "gone", "removed", 5, None), (1, "new", "added", None, 5), (2, "only", "removed", 0, None), (3, "other", "added", None, 0)}
    none = spark.createDataFrame([], shape)
    assert align.align(none, none).count() == 0


# ---------------------------------------------------------------- overlap


def test_clashes_equal_a_scan(spark):
    rng = random.Random(7)
    rows = [(rng.randrange(3), i, s := rng.randrange(200), rng.choice([None, s, s + rng.randrange(1, 9)]) if rng.random() < 0.1 else s + rng.randrange(1, 9)) for i in range(400)] + [(9, 1000 + i, i, None) for i in range(50)]
    want = set()
    for key in {r[0] for r in rows}:
        reach = -1
        for _, i, s, e in sorted((r for r in rows if r[0] == key and (r[3] is None or r[2] < r[3])), key=lambda r: (r[2], r[1])):
            if reach > s:
                want.add((key, i, None if reach == 10**9 else reach))
            reach = max(reach, 10**9 if e is None else e)
    got = intervals.clashes(spark.createDataFrame(rows, "key long, id long, start long, end long").repartition(5), Staging(spark, "t")).collect()
    assert {(r.key, r.id, r.reach) for r in got} == want and len(got) == len(want) > 100


def test_compiled_schemas_compute_a_value_once(spark):
    """However often rules name a value, its text is parsed once and each place is reached once."""
    own = {"type": "object", "required": ["a", "b"], "additionalProperties": False, "properties": {"a": {"type": ["integer", "null"], "minimum": 1, "maximum": 3, "enum": [1, 2]}, "b": {"anyOf": [{"const": 0}, {"type": "integer", "minimum": 30}]}}}
    rows = spark.createDataFrame([('{"a":5,"b":7,"c":1}',), ("[1]",), ("{",), (None,)], "t string").repartition(2)
    found = rows.select("t", F.array_sort(schema.text_errors(F.col("t"), own)).alias("e"))
    assert {r.t: r.e for r in found.collect()} == {'{"a":5,"b":7,"c":1}': ["$.a: above maximum", "$.a: not in enum", "$.b: matches 0 of anyOf", "$: c is not allowed"], "[1]": ["$: not of type object"], "{": ["$: not JSON"], None: None}
    said = schema.text_errors(F.col("t"), own)._jc.toString()
    assert said.count("parse_json") == 1 and said.count("schema_of_variant") == 3
