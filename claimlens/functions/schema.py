"""JSON schemas compiled to expressions over VARIANT values, and schemas derived from Spark types. No Python runs in a plan.

An error reads `path: rule`. Every keyword is either checked or refused when the schema is compiled; none is passed over.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NOTES = {"$schema", "$id", "title", "description", "default", "examples", "$comment"}
_NUMBERS = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)"
_KINDS = {"object": "^OBJECT", "array": "^ARRAY", "string": "^STRING", "boolean": "^BOOLEAN", "null": "^VOID", "number": _NUMBERS}
_CHECKED = {
    "type", "enum", "const", "properties", "required", "additionalProperties", "minProperties", "maxProperties", "items", "minItems", "maxItems", "uniqueItems",
    "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "allOf", "anyOf", "oneOf", "not",
}


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bound(value: Column) -> Column:
    """A VARIANT value (v) with the name of its type (t)."""
    return F.struct(value.alias("v"), F.schema_of_variant(value).alias("t"))


def _is(value: Column, kind: str) -> Column:
    """Whether a bound value is of a type."""
    if kind == "integer":
        return _is(value, "number") & (_number(value) % 1 == 0)
    if kind not in _KINDS:
        raise ValueError(f"unknown type {kind}")
    return value["t"].rlike(_KINDS[kind])


def _number(value: Column) -> Column:
    return F.try_variant_get(value["v"], "$", "double")


def _array(value: Column) -> Column:
    return F.try_variant_get(value["v"], "$", "array<variant>")


def _entries(value: Column) -> Column:
    return F.try_variant_get(value["v"], "$", "map<string,variant>")


def _keys(value: Column) -> Column:
    return F.map_keys(_entries(value))


def _equals(value: Column, constant) -> Column:
    """Whether a bound value is a scalar constant; 1 and 1.0 are one number."""
    if constant is None:
        return _is(value, "null")
    if isinstance(constant, bool):
        return _is(value, "boolean") & (F.try_variant_get(value["v"], "$", "boolean") == constant)
    if isinstance(constant, int | float):
        return _is(value, "number") & (_number(value) == float(constant))
    if isinstance(constant, str):
        return _is(value, "string") & (F.try_variant_get(value["v"], "$", "string") == constant)
    raise ValueError(f"a constant that is no scalar cannot be checked: {json.dumps(constant)}")


def _text(value: Column) -> Column:
    """Equal for equal scalars and for equal JSON: numbers as doubles."""
    return F.when(_is(value, "number"), _number(value).cast("string")).otherwise(F.to_json(value["v"]))


def errors(value: Column, schema: dict | bool, at: Column | str = "$") -> Column:
    """What a VARIANT value breaks of a schema: an array of texts, empty if nothing."""
    return _let(_bound(value), lambda one: _errors(one, schema, at))


def _errors(value: Column, schema: dict | bool, at: Column | str) -> Column:
    """The errors of a bound value."""
    at = F.lit(at) if isinstance(at, str) else at
    none = F.array().cast("array<string>")
    if schema is True:
        return none
    if schema is False:
        return F.array(F.concat(at, F.lit(": nothing is allowed")))
    if unknown := set(schema) - _CHECKED - _NOTES:
        raise ValueError(f"unsupported keyword {min(unknown)}")
    found: list[Column] = []

    def rule(broken: Column, text: Column | str) -> None:
        said = F.concat(at, F.lit(": "), F.lit(text) if isinstance(text, str) else text)
        found.append(F.when(F.coalesce(broken, F.lit(False)), F.array(said)).otherwise(none))

    def bound(kind: str, size: Column, keyword: str, below: bool, strict: bool = False) -> None:
        if keyword in schema:
            limit = F.lit(schema[keyword])
            out = (size <= limit if strict else size < limit) if below else (size >= limit if strict else size > limit)
            rule(_is(value, kind) & out, f"{'below' if below else 'above'} {keyword}" if not strict else f"not {'above' if below else 'below'} {keyword}")

    fits = lambda own: F.size(_errors(value, own, at)) == 0
    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        ok = _is(value, kinds[0])
        for kind in kinds[1:]:
            ok = ok | _is(value, kind)
        rule(~ok, f"not of type {'|'.join(kinds)}")
    if "enum" in schema:
        ok = F.lit(False)
        for constant in schema["enum"]:
            ok = ok | _equals(value, constant)
        rule(~ok, "not in enum")
    if "const" in schema:
        rule(~_equals(value, schema["const"]), "not the constant")
    for own in schema.get("allOf", []):
        found.append(_errors(value, own, at))
    if "anyOf" in schema or "oneOf" in schema:
        for keyword in ("anyOf", "oneOf"):
            if keyword in schema:
                n = sum((F.when(fits(own), 1).otherwise(0) for own in schema[keyword]), F.lit(0))
                said = lambda n: F.when(n != 1 if keyword == "oneOf" else n == 0, F.array(F.concat(at, F.lit(": matches "), n.cast("string"), F.lit(f" of {keyword}")))).otherwise(none)
                found.append(_let(n, said))
    if "not" in schema:
        rule(fits(schema["not"]), "matches not")
    named = schema.get("properties", {})
    if required := schema.get("required", []):
        lost = _let(_keys(value), lambda keys: F.filter(F.array(*[F.when(~F.array_contains(keys, name), F.concat(at, F.lit(f": {name} is missing"))) for name in required]), lambda e: e.isNotNull()))
        found.append(F.when(_is(value, "object"), F.coalesce(lost, none)).otherwise(none))
    for name, own in sorted(named.items()):
        if not re.fullmatch(r"[^'\\]+", name):
            raise ValueError(f"a name that cannot be reached by path: {name}")
        inner = _bound(F.try_variant_get(value["v"], f"$['{name}']", "variant"))
        below = _let(inner, lambda x: F.when(x["v"].isNotNull(), _errors(x, own, F.concat(at, F.lit(f".{name}")))).otherwise(none))
        found.append(F.when(_is(value, "object"), below).otherwise(none))
    more = schema.get("additionalProperties", True)
    if more is not True:
        extra = F.filter(F.map_entries(_entries(value)), lambda e: ~e["key"].isin(sorted(named)) if named else F.lit(True))
        told = F.transform(extra, lambda e: F.concat(at, F.lit(": "), e["key"], F.lit(" is not allowed"))) if more is False else F.flatten(F.transform(extra, lambda e: errors(e["value"], more, F.concat(at, F.lit("."), e["key"]))))
        found.append(F.when(_is(value, "object"), told).otherwise(none))
    bound("object", F.size(_keys(value)), "minProperties", True)
    bound("object", F.size(_keys(value)), "maxProperties", False)
    if schema.get("items", True) is not True:
        each = F.flatten(F.transform(_array(value), lambda x, i: errors(x, schema["items"], F.concat(at, F.lit("["), i.cast("string"), F.lit("]")))))
        found.append(F.when(_is(value, "array"), each).otherwise(none))
    bound("array", F.size(_array(value)), "minItems", True)
    bound("array", F.size(_array(value)), "maxItems", False)
    if schema.get("uniqueItems") is True:
        texts = F.transform(F.transform(_array(value), _bound), _text)
        rule(_is(value, "array") & _let(texts, lambda all: F.size(F.array_distinct(all)) < F.size(all)), "items repeat")
    text = F.try_variant_get(value["v"], "$", "string")
    bound("string", F.length(text), "minLength", True)
    bound("string", F.length(text), "maxLength", False)
    if "pattern" in schema:
        rule(_is(value, "string") & ~text.rlike(schema["pattern"]), "pattern does not match")
    for keyword, below, strict in (("minimum", True, False), ("maximum", False, False), ("exclusiveMinimum", True, True), ("exclusiveMaximum", False, True)):
        bound("number", _number(value), keyword, below, strict)
    return F.concat(*found) if found else none


def text_errors(text: Column, schema: dict) -> Column:
    """The errors of a JSON text; what is no JSON breaks every schema, and null has no errors to tell."""
    told = lambda value: F.when(value.isNull(), F.array(F.lit("$: not JSON"))).otherwise(errors(value, schema))
    return F.when(text.isNotNull(), _let(F.try_parse_json(text), told))


def derive(kind: T.DataType, nullable: bool = False) -> dict:
    """The schema of a Spark type's JSON: fields that may not be null are required, and no others are known."""
    own: dict
    if isinstance(kind, T.StructType):
        own = {"type": "object", "properties": {f.name: derive(f.dataType, f.nullable) for f in kind}, "required": [f.name for f in kind if not f.nullable], "additionalProperties": False}
    elif isinstance(kind, T.ArrayType):
        own = {"type": "array", "items": derive(kind.elementType, kind.containsNull)}
    elif isinstance(kind, T.MapType):
        own = {"type": "object", "additionalProperties": derive(kind.valueType, kind.valueContainsNull)}
    elif isinstance(kind, T.BooleanType):
        own = {"type": "boolean"}
    elif isinstance(kind, T.IntegralType):
        own = {"type": "integer"}
    elif isinstance(kind, T.NumericType):
        own = {"type": "number"}
    elif isinstance(kind, T.DateType):
        own = {"type": "string", "pattern": r"^\d{4}-\d{2}-\d{2}$"}
    else:
        own = {"type": "string"}
    return own | {"type": [own["type"], "null"]} if nullable else own
