"""Chat formatting with tool-call linking.

A message's text is plain, or a JSON object that holds `tool_calls` (id, name, arguments), a result (`tool_call_id`,
`content`) or `tools` (name, parameters: a schema). Calls and results meet in a hash join on (conversation, id).
Messages are then ordered so that every result follows its call and every call follows the results that its arguments
name as {"$result": id}: the order is (effective turn, depth, turn, row), where a message takes the largest turn among
itself and what it depends on, and depth counts dependencies at that turn. Messages that depend on one another, over
any number of links, form a group; groups of ORDER_EDGES links at most are ordered one after another as a task streams
through them, larger ones level by level over the cluster. Arguments are checked against the schema
their conversation declares, else against the `schemas` parameter, and each message becomes one line of canonical
JSON: sorted keys, no spaces, numbers and strings as Python's json writes them, no escapes beyond JSON's own but for
lone surrogates.

The result has a row per message, never a conversation in one value, so a conversation of any size stays spread.

Defined results: of calls that share an id the first counts and the rest are `duplicate`; a result without call is
`orphan`, a second result for a call is `extra`; a call without result is counted in n_open; dependencies in a circle
keep their own turns and are flagged; null text is null content, null conv_id is a conversation of its own whose calls
link like any other; text that is no such object is plain; repeated rows are kept each; other columns are ignored; an
empty table gives an empty result. Schemas: all assertions of JSON Schema but the unevaluated and dynamic ones, with
references into the schema itself; format and other annotations assert nothing. Any other keyword, type name or
reference, a keyword's value of the wrong kind and a pattern that is none or takes over PATTERN_SECONDS are errors of
every call checked against that schema; its arguments and links stand. Content that canonical JSON cannot hold, as a
number beyond all bounds, is kept as the message's text. A null turn comes before all others.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from fractions import Fraction
from urllib.parse import unquote

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.ids import canonical
from claimlens.operators.graph import connected_components
from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

#: Links of a group that one task orders at once, and the time a schema's pattern may take on one string.
ORDER_EDGES, PATTERN_SECONDS = 200_000, 1.0
#: Stands for a null turn among longs.
_NO_TURN = -(2**63)

_SHAPE = "tool_calls array<struct<id:string,name:string,arguments:string>>, tool_call_id string, content string, tools array<struct<name:string,parameters:string>>"
_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
#: Where a schema holds schemas: as the value, in a list, by name.
_ONE = {"not", "if", "then", "else", "items", "additionalItems", "contains", "additionalProperties", "propertyNames"}
_LISTS = {"allOf", "anyOf", "oneOf", "prefixItems", "items"}
_NAMED = {"properties", "patternProperties", "dependentSchemas", "dependencies", "$defs", "definitions"}
_PLAIN = {"type", "enum", "const", "required", "dependentRequired", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "pattern", "uniqueItems", "$ref"}
_PLAIN |= {f"{side}{what}" for side in ("min", "max") for what in ("Length", "Items", "Properties", "Contains")}
#: Keywords that assert nothing about a value.
_NOTES = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "format", "$schema", "$comment", "contentEncoding", "contentMediaType", "contentSchema"}


def _matches(pattern: str, text: str) -> bool:
    try:
        return regex.search(pattern, text, timeout=PATTERN_SECONDS) is not None
    except TimeoutError as error:
        raise ValueError(f"pattern takes too long: {pattern}"[:200]) from error


def strict(text: str):
    """Parse JSON; repeated keys and NaN are errors."""

    def pairs(items):
        out = dict(items)
        if len(out) != len(items):
            raise ValueError("a key is repeated")
        return out

    def refuse(name):
        raise ValueError(f"{name} is no JSON number")

    return json.loads(text, object_pairs_hook=pairs, parse_constant=refuse)


def _is(value, kind: str) -> bool:
    if kind in ("integer", "number"):
        number = isinstance(value, int | float) and not isinstance(value, bool)
        return number and (kind == "number" or value == int(value))
    return isinstance(value, _TYPES.get(kind, object))


def _key(value) -> str:
    """Equal for equal JSON values: 1 and 1.0 are one number."""
    if isinstance(value, float) and value == int(value):
        value = int(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{canonical(k)}:{_key(value[k])}" for k in sorted(value)) + "}"
    return "[" + ",".join(map(_key, value)) + "]" if isinstance(value, list) else canonical(value)


def _target(root, ref: str):
    """What a reference into the schema itself names; KeyError if nothing."""
    if not isinstance(ref, str) or (ref != "#" and not ref.startswith("#/")):
        raise KeyError(ref)
    found = root
    for step in unquote(ref[2:]).split("/") if ref != "#" else []:
        step = step.replace("~1", "/").replace("~0", "~")
        if isinstance(found, list) and step.isdecimal() and int(step) < len(found):
            found = found[int(step)]
        elif isinstance(found, dict) and step in found:
            found = found[step]
        else:
            raise KeyError(ref)
    return found


def unsupported(schema, root=None, at: str = "#") -> list[str]:
    """What of a schema cannot be checked, wherever it stands: keywords, type names and references."""
    if isinstance(schema, bool):
        return []
    if not isinstance(schema, dict):
        return [f"{at}: unsupported schema"]
    root, out = schema if root is None else root, []
    for k in sorted(schema):
        own = schema[k]
        if k in _LISTS and isinstance(own, list):
            out += [e for i, x in enumerate(own) for e in unsupported(x, root, f"{at}/{k}/{i}")]
        elif k in _NAMED and isinstance(own, dict):
            names = sorted(n for n in own if k != "dependencies" or not isinstance(own[n], list))
            out += [e for n in names for e in unsupported(own[n], root, f"{at}/{k}/{n}")]
        elif k in _ONE:
            out += unsupported(own, root, f"{at}/{k}")
        elif k == "type":
            out += [f"{at}: unsupported type {canonical(x)}" for x in (own if isinstance(own, list) else [own]) if x not in (*_TYPES, "integer", "number")]
        elif k == "$ref":
            try:
                if not isinstance(_target(root, own), dict | bool):
                    out.append(f"{at}: unsupported reference {canonical(own)}")
            except KeyError:
                out.append(f"{at}: unsupported reference {canonical(own)}")
        elif k not in _PLAIN and k not in _NOTES and not (k == "$id" and schema is root):
            out.append(f"{at}: unsupported keyword {k}")
    return out


def violations(value, schema, at: str = "$", root=None) -> list[str]:
    """What a value breaks of a JSON schema; what of the schema cannot be checked is an error, not met."""
    out = []
    if root is None:
        root, out = schema, unsupported(schema)
    if schema is True or not isinstance(schema, dict):
        return out if schema is not False else [f"{at}: nothing is allowed"]

    def inner(x, own, where=at) -> list[str]:
        return violations(x, own, where, root)

    def fits(x, own) -> bool:
        return not inner(x, own)

    if "$ref" in schema:
        try:
            out += inner(value, _target(root, schema["$ref"]))
        except KeyError:
            pass  # unsupported() names it
    kinds = schema.get("type")
    if kinds is not None and not any(_is(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [*out, f"{at}: not of type {canonical(kinds)}"]
    if "enum" in schema and _key(value) not in {_key(x) for x in schema["enum"]}:
        out.append(f"{at}: not in enum")
    if "const" in schema and _key(value) != _key(schema["const"]):
        out.append(f"{at}: not the constant")
    for own in schema.get("allOf", []):
        out += inner(value, own)
    if "anyOf" in schema and not any(fits(value, own) for own in schema["anyOf"]):
        out.append(f"{at}: matches none of anyOf")
    if "oneOf" in schema and (n := sum(fits(value, own) for own in schema["oneOf"])) != 1:
        out.append(f"{at}: matches {n} of oneOf")
    if "not" in schema and fits(value, schema["not"]):
        out.append(f"{at}: matches not")
    if "if" in schema:
        out += inner(value, schema.get("then" if fits(value, schema["if"]) else "else", True))
    if isinstance(value, dict):
        known, patterns = schema.get("properties", {}), schema.get("patternProperties", {})
        out += [f"{at}: {k} is missing" for k in schema.get("required", []) if k not in value]
        needs = {**schema.get("dependencies", {}), **schema.get("dependentRequired", {})}
        out += [f"{at}: {k} is missing" for n in sorted(needs) if n in value and isinstance(needs[n], list) for k in needs[n] if k not in value]
        for own in (schema.get("dependencies", {}), schema.get("dependentSchemas", {})):
            out += [e for n in sorted(own) if n in value and not isinstance(own[n], list) for e in inner(value, own[n])]
        for k in sorted(value):
            matched = [patterns[p] for p in sorted(patterns) if _matches(p, k)]
            for own in ([known[k]] if k in known else []) + matched:
                out += inner(value[k], own, f"{at}.{k}")
            if k not in known and not matched and "additionalProperties" in schema:
                more = schema["additionalProperties"]
                out += [f"{at}: {k} is not allowed"] if more is False else inner(value[k], more, f"{at}.{k}")
            if "propertyNames" in schema and not fits(k, schema["propertyNames"]):
                out.append(f"{at}: {k} is no allowed name")
    if isinstance(value, list):
        first, rest = schema.get("prefixItems", []), schema.get("items", True)
        if isinstance(rest, list):  # the older form of prefixItems
            first, rest = rest, schema.get("additionalItems", True)
        for i, x in enumerate(value):
            out += inner(x, first[i] if i < len(first) else rest, f"{at}[{i}]")
        if schema.get("uniqueItems") is True and len({_key(x) for x in value}) < len(value):
            out.append(f"{at}: items repeat")
        if "contains" in schema:
            n = sum(fits(x, schema["contains"]) for x in value)
            out += [f"{at}: below minContains"] if n < schema.get("minContains", 1) else []
            out += [f"{at}: above maxContains"] if n > schema.get("maxContains", n) else []
    number = _is(value, "number")
    size = len(value) if isinstance(value, str | list | dict) else value if number else None
    if size is not None:
        low, high = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems"), dict: ("minProperties", "maxProperties")}.get(type(value), ("minimum", "maximum"))
        out += [f"{at}: below {low}"] if low in schema and size < schema[low] else []
        out += [f"{at}: above {high}"] if high in schema and size > schema[high] else []
    if number:
        # a boolean exclusive bound (draft 4) speaks of minimum or maximum
        low, high = (schema.get(x) if (e := schema.get(f"exclusive{x.capitalize()}")) is True else None if e is False else e for x in ("minimum", "maximum"))
        out += [f"{at}: not above exclusiveMinimum"] if low is not None and value <= low else []
        out += [f"{at}: not below exclusiveMaximum"] if high is not None and value >= high else []
        if "multipleOf" in schema and _exact(value) % _exact(schema["multipleOf"]):
            out.append(f"{at}: not a multiple")
    if isinstance(value, str) and "pattern" in schema and not _matches(schema["pattern"], value):
        out.append(f"{at}: pattern does not match")
    return out


def _exact(number) -> Fraction:
    """A number as its shortest decimal says it."""
    return Fraction(repr(number)) if isinstance(number, float) else Fraction(number)


def references(value) -> list[str]:
    """Ids named as {"$result": id} anywhere in arguments."""
    if isinstance(value, dict):
        if isinstance(own := value.get("$result"), str) and len(value) == 1:
            return [own]
        return [r for k in sorted(value) for r in references(value[k])]
    return [r for x in value for r in references(x)] if isinstance(value, list) else []


_MALFORMED = (ValueError, RecursionError, re.error, regex.error, TypeError, AttributeError, ArithmeticError, KeyError)


def _utf8(text: str) -> str:
    return text.encode("utf-8", "replace").decode("utf-8")


def _checked(arguments: str | None, schema: str | None) -> tuple[str | None, list[str], list[str]]:
    """Canonical arguments (null if unreadable), errors, references."""
    try:
        value = strict(arguments) if arguments else {}
        if isinstance(value, str):  # arguments sent as a string of JSON
            value = strict(value)
        text, refs = canonical(value), references(value)
    except (ValueError, RecursionError) as error:
        return None, [_utf8(f"$: {error}"[:200])], []
    try:
        errors = violations(value, strict(schema)) if schema else []
    except _MALFORMED as error:  # the schema, or what it asks of this value, is malformed
        errors = [f"#: {type(error).__name__}: {error}"[:200]]
    return text, list(map(_utf8, errors)), list(map(_utf8, refs))


def ordered(edges: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """(row, eff, depth, cyclic) of one group, by its links (before, its turn, after, its turn)."""
    turn, after, waits = {}, {}, {}
    for a, at, b, bt in edges:
        turn[a], turn[b] = at, bt
        after.setdefault(a, []).append(b)
        waits[b] = waits.get(b, 0) + 1
    place = {x: (t, 0) for x, t in turn.items()}
    ready, done = [x for x in turn if x not in waits], set()
    while ready:
        x = ready.pop()
        done.add(x)
        eff, depth = place[x]
        for y in after.get(x, ()):
            place[y] = max(place[y], (eff, depth + 1))
            waits[y] -= 1
            if not waits[y]:
                ready.append(y)
    return [(x, *place[x], False) if x in done else (x, turn[x], 0, True) for x in turn]


def _order(nodes: DataFrame, edges: DataFrame, staging: Staging, most: int = ORDER_EDGES) -> DataFrame:
    """(row, eff, depth, cyclic) for the nodes (row, turn) that edges (before, after) touch."""
    group = connected_components(edges, staging, "before", "after").select(F.col("node").alias("before"), F.col("component").alias("g"))
    turns = nodes.select("row", F.coalesce("turn", F.lit(_NO_TURN)).alias("turn"))
    ends = lambda name: turns.select(F.col("row").alias(name), F.col("turn").alias(f"{name}_turn"))
    linked = staging.table(edges.join(group, "before").join(ends("before"), "before").join(ends("after"), "after"), "groups")
    large = staging.table(linked.groupBy("g").agg(F.count("*").alias("n")).where(F.col("n") > most).select("g"), "large")
    small = linked.join(large, "g", "left_anti").select("g", "before", "before_turn", "after", "after_turn")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held, out = None, [], []
        for batch in batches:
            for g, *edge in batch.itertuples(index=False):
                if g != now and held:
                    out += ordered(held)
                    held = []
                now = g
                held.append(edge)
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=["row", "eff", "depth", "cyclic"])
                    out = []
        out += ordered(held) if held else []
        yield pd.DataFrame(out, columns=["row", "eff", "depth", "cyclic"])

    placed = small.repartition("g").sortWithinPartitions("g").mapInPandas(stream, "row long, eff long, depth int, cyclic boolean")
    placed = placed.withColumn("eff", F.nullif("eff", F.lit(_NO_TURN)))
    if large.isEmpty():
        return placed
    rest = linked.join(large, "g", "left_semi").select("before", "after")
    touched = nodes.join(rest.select(F.explode(F.array("before", "after")).alias("row")).distinct(), "row", "left_semi")
    return placed.unionByName(_peeled(touched, rest, staging).select("row", "eff", "depth", "cyclic"))


def _peeled(nodes: DataFrame, edges: DataFrame, staging: Staging) -> DataFrame:
    """The same of groups too large for one task, a level at a time over the cluster."""
    done, left, rest, rounds = None, nodes, edges, 0
    while not left.isEmpty():
        ready = left.join(rest.select(F.col("after").alias("row")).distinct(), "row", "left_anti") if rounds else left.join(edges.select(F.col("after").alias("row")).distinct(), "row", "left_anti")
        ready = staging.table(ready.select("row", "turn", *(["eff", "depth"] if rounds else [F.col("turn").alias("eff"), F.lit(0).alias("depth")]), F.lit(False).alias("cyclic")), "ready")
        if ready.isEmpty():
            stuck = left.select("row", "turn", F.col("turn").alias("eff"), F.lit(0).alias("depth"), F.lit(True).alias("cyclic"))
            return stuck if done is None else done.unionByName(stuck)
        done = ready if done is None else done.unionByName(ready)
        pushed = rest.join(ready.select(F.col("row").alias("before"), "eff", "depth"), "before")
        push = pushed.groupBy(F.col("after").alias("row")).agg(F.max(F.struct("eff", (F.col("depth") + 1).alias("depth"))).alias("p"))
        own = F.struct(F.col("eff"), F.col("depth")) if rounds else F.struct(F.col("turn").alias("eff"), F.lit(0).alias("depth"))
        left = left.join(ready.select("row"), "row", "left_anti").join(push, "row", "left").withColumn("q", F.greatest(own, F.coalesce("p", own)))
        left = staging.table(left.select("row", "turn", F.col("q.eff").alias("eff"), F.col("q.depth").alias("depth")), "left")
        rest = staging.table(rest.join(ready.select(F.col("row").alias("before")), "before", "left_anti"), "rest")
        rounds += 1
    return done if done is not None else nodes.select("row", "turn", F.col("turn").alias("eff"), F.lit(0).alias("depth"), F.lit(False).alias("cyclic"))


def format_chats(messages: DataFrame, schemas: dict[str, dict] | None = None, staging: Staging | None = None) -> DataFrame:
    """One row per message: conv_id, turn, role, order_turn, order_depth, n_calls, n_open, n_invalid, link, cyclic, json."""
    spark = small_batches(messages.sparkSession)
    staging = staging or Staging(spark, "chat")
    known = {k: json.dumps(v) for k, v in (schemas or {}).items()}

    checked = _check_udf(known)
    shape = F.when(F.col("text").rlike(r"^\s*\{"), F.from_json("text", _SHAPE))
    base = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text", shape.alias("m"), F.monotonically_increasing_id().alias("row"))
    base = staging.table(base, "messages")  # row numbers are drawn once
    talk = base.where("m.tool_calls is not null or m.tool_call_id is not null or m.tools is not null")
    # what links is a small part of the messages: written once, joined by identifier
    talk = staging.table(talk.select("conv_id", "turn", "role", "row", "m"), "linked")
    tools = talk.select("conv_id", F.inline("m.tools")).where("name is not null").groupBy("conv_id", "name").agg(F.min("parameters").alias("declared"))
    calls = talk.select("conv_id", "turn", "row", F.posexplode("m.tool_calls").alias("k", "c")).select("conv_id", "turn", "row", "k", F.col("c.id").alias("id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("raw"))
    calls = calls.join(tools.withColumnsRenamed({"conv_id": "tc", "name": "tn"}), F.col("conv_id").eqNullSafe(F.col("tc")) & (F.col("name") == F.col("tn")), "left")
    calls = staging.table(calls.select("conv_id", "turn", "row", "k", "id", "name", checked("raw", "name", "declared").alias("v")), "calls")
    heads = calls.where("id is not null").groupBy("conv_id", "id").agg(F.min(F.struct("turn", "row", "k")).alias("head")).withColumnsRenamed({"conv_id": "head_conv", "id": "head_id"})
    results = talk.where("m.tool_call_id is not null").select("conv_id", "turn", "row", F.col("m.tool_call_id").alias("id"))
    firsts = results.groupBy("conv_id", "id").agg(F.min(F.struct("turn", "row")).alias("first")).withColumnsRenamed({"conv_id": "first_conv", "id": "first_id"})

    call_of = F.col("conv_id").eqNullSafe(F.col("head_conv")) & (F.col("id") == F.col("head_id"))
    result_of = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("id") == F.col("first_id"))
    answer = F.when(F.col("head").isNull(), "orphan").when(F.col("first.row") == F.col("row"), "linked").otherwise("extra")
    answered = results.join(heads, call_of, "left").join(firsts, result_of).select("row", F.col("head.row").alias("call_row"), answer.alias("link"))
    answered = staging.table(answered, "answered")
    state = calls.join(heads, call_of, "left").join(firsts, result_of, "left")
    first_of = F.col("head").isNull() | ((F.col("head.row") == F.col("row")) & (F.col("head.k") == F.col("k")))
    call_link = F.when(~first_of, "duplicate").when(F.col("first").isNull(), "open").otherwise("linked")
    state = state.select("row", "k", "id", "name", "v.arguments", "v.errors", call_link.alias("link"))
    by_row = state.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("k", "id", "name", "arguments", "errors", "link"))).alias("calls"))  # one message's own calls

    refs = calls.select("conv_id", F.col("row").alias("after"), F.explode("v.refs").alias("id"))
    needs = refs.join(firsts, result_of).select(F.col("first.row").alias("before"), "after")
    edges = answered.where("call_row is not null").select(F.col("call_row").alias("before"), F.col("row").alias("after")).unionByName(needs).where("before <> after").distinct()
    edges = staging.table(edges, "edges")
    placed = _order(talk.select("row", "turn"), edges, staging)

    out = base.join(by_row, "row", "left").join(answered.select("row", F.col("link").alias("result_link")), "row", "left").join(placed, "row", "left")
    some = F.coalesce("calls", F.array().cast("array<struct<k:int,id:string,name:string,arguments:string,errors:array<string>,link:string>>"))
    return out.select(
        "conv_id",
        "turn",
        "role",
        F.coalesce("eff", "turn").alias("order_turn"),
        F.coalesce("depth", F.lit(0)).alias("order_depth"),
        F.size(some).alias("n_calls"),
        F.size(F.filter(some, lambda c: c["link"] == "open")).alias("n_open"),
        F.size(F.filter(some, lambda c: F.size(c["errors"]) > 0)).alias("n_invalid"),
        F.col("result_link").alias("link"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        _line_udf()("role", "text", F.to_json("calls"), "m.tool_call_id", "result_link").alias("json"),
    )


def _check_udf(known: dict[str, str]):
    shape = T.StructType([T.StructField("arguments", T.StringType()), T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("refs", T.ArrayType(T.StringType()))])

    @F.pandas_udf(shape)
    def check(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for raw, name, declared in batches:
            yield pd.DataFrame([_checked(a, d if d is not None else known.get(n)) for a, n, d in zip(raw, name, declared, strict=True)], columns=["arguments", "errors", "refs"])

    return check


def _content(text: str):
    """The content of a message that is a JSON object; the text itself where canonical JSON cannot hold it."""
    try:
        value = json.loads(text)
        value = value.get("content") if isinstance(value, dict) else None
        canonical(value)
        return value
    except (ValueError, RecursionError):
        return text


def line(role, text, calls, answers, link) -> str:
    """The canonical JSON of one message."""
    out = {"role": role, "content": _content(text) if calls or link else text}
    if calls:
        out["tool_calls"] = []
        for c in json.loads(calls):
            call = {"id": c.get("id"), "name": c.get("name"), "arguments": json.loads(c["arguments"]) if c.get("arguments") else None}
            if c.get("errors"):
                call["errors"] = c["errors"]
            if c["link"] != "linked":
                call["link"] = c["link"]
            out["tool_calls"].append(call)
    if link:
        out["tool_call_id"] = answers
        if link != "linked":
            out["link"] = link
    return canonical(out)


def _line_udf():
    @F.pandas_udf(T.StringType())
    def lines(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        none = lambda s: s.astype(object).where(s.notna(), None)
        for cols in batches:
            yield pd.Series([line(*x) for x in zip(*map(none, cols), strict=True)], dtype=object)

    return lines


def op10_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """Every message of every conversation, linked, ordered and serialised."""
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
