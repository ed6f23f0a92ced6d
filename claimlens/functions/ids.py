"""Content-derived identifiers and canonical JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def uuid5(namespace: str, name: Column) -> Column:
    """Name-based identifier, version 5: SHA-1 of namespace and name with the version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def stable_id(namespace: str, *parts: Column) -> Column:
    """Identifier of an ordered list of text parts."""
    return uuid5(namespace, F.to_json(F.array(*parts)))


_LONE = re.compile("[\ud800-\udfff]")


def canonical(value) -> str:
    """Sorted keys, no spaces, no NaN; half of a surrogate pair, which UTF-8 cannot hold, stays an escape."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def _pairs(items):
    if len({k for k, _ in items}) != len(items):
        raise ValueError("a key is repeated")
    return dict(items)


def _refuse(name):
    raise ValueError(f"{name} is no JSON number")


def strict_decoder() -> json.JSONDecoder:
    """A decoder to which repeated keys and NaN are errors."""
    return json.JSONDecoder(object_pairs_hook=_pairs, parse_constant=_refuse)


def tree_digest(df: DataFrame, text: Column) -> DataFrame:
    """(rows, digest): SHA-256 over a tree of the rows' SHA-256 digests, whatever their order; repeats are counted.

    Digests are even, so a tree of two levels of three hexadecimal digits keeps every group small; equal rows are
    counted before that. One row comes out, whatever the size.
    """
    own = df.groupBy(F.sha2(text, 256).alias("h")).agg(F.count("*").alias("n"))
    held = lambda key, mark: F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", key, mark))), "\n"), 256)
    leaf = own.groupBy(F.substring("h", 1, 6).alias("p")).agg(held("h", F.col("n").cast("string")).alias("d"), F.sum("n").alias("n"))
    branch = leaf.groupBy(F.substring("p", 1, 3).alias("q")).agg(held("p", F.col("d")).alias("d"), F.sum("n").alias("n"))
    return branch.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), held("q", F.col("d")).alias("digest"))


def canonical_json():
    """Canonical form of JSON text; null where it is not JSON, repeats a key or holds NaN."""

    def one(text):
        try:
            return canonical(strict_decoder().decode(text)) if text is not None else None
        except (ValueError, RecursionError):
            return None

    @F.pandas_udf(T.StringType())
    def form(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(one)

    return form
