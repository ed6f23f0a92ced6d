"""Rows to records: evidence hydration, typed unions, entity pivots, picks, rollups, search and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hydrate(claims: DataFrame, evidence: DataFrame, documents: DataFrame) -> DataFrame:
    """Claims with their evidence: document, source, family and role; claims without evidence stay with nulls."""
    links = evidence.join(documents, "document_id")
    return claims.join(links, "claim_id", "left")


def unsupported(claims: DataFrame, evidence: DataFrame, dependencies: DataFrame) -> DataFrame:
    """Claims with neither evidence nor a parent."""
    return claims.join(evidence.select("claim_id").distinct(), "claim_id", "left_anti").join(dependencies.select(F.col("child").alias("claim_id")).distinct(), "claim_id", "left_anti")


def typed_value_errors(rows: DataFrame, kind: str, subtypes: dict[str, str]) -> DataFrame:
    """Rows whose number of non-null subtypes is not one, or whose one subtype is not the kind's (kind -> column)."""
    filled = [F.col(c).isNotNull().cast("int") for c in subtypes.values()]
    n = sum(filled[1:], filled[0])
    own = None
    for k, c in subtypes.items():
        test = F.col(c).isNotNull()
        own = F.when(F.col(kind) == k, test) if own is None else own.when(F.col(kind) == k, test)
    return rows.withColumn("subtypes", n).where((n != 1) | ~F.coalesce(own, F.lit(False)))


def pivot_entities(claims: DataFrame) -> DataFrame:
    """Each entity's predicates as a map to its values, sorted; one shuffle."""
    per = claims.groupBy("entity_id", "predicate").agg(F.array_sort(F.collect_list("value")).alias("values"))
    return per.groupBy("entity_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("predicate", "values")))).alias("fields"), F.count("*").alias("n_fields"))


def summary(claims: DataFrame) -> DataFrame:
    return claims.groupBy("claim_kind", "predicate").agg(F.count("*").alias("claims"), F.countDistinct("entity_id").alias("entities"))


def first_last(rows: DataFrame, key: str, clock: str, ident: str) -> DataFrame:
    """First and last row of each key by clock, ties by id; minima and maxima combine before the shuffle."""
    order = F.struct(clock, ident)
    return rows.groupBy(key).agg(F.min(order)[ident].alias("first_id"), F.min(clock).alias("first_us"), F.max(order)[ident].alias("last_id"), F.max(clock).alias("last_us"), F.count("*").alias("rows"))


def admission_us(parameters: Column, fallback: Column) -> Column:
    """`accepted_at` of JSON parameters where the key exists, even as null (then null); else the fallback."""
    v = F.try_parse_json(parameters)
    given = F.try_variant_get(v, "$.accepted_at", "variant")
    return F.when(given.isNull(), fallback).otherwise(F.try_variant_get(v, "$.accepted_at", "long"))


def pick_latest(rows: DataFrame, key: str, value: str, start: str, end: str, prefer: Column | None = None) -> DataFrame:
    """The value of the row with the largest (preferred, start, end, value) of each key."""
    order = F.struct((prefer if prefer is not None else F.lit(True)).cast("int").alias("p"), start, end, value)
    return rows.groupBy(key).agg(F.max(order)[value].alias("headline"), F.max(order)[start].alias("as_of"))


def unambiguous(rows: DataFrame, key: str, value: str, rank: str) -> DataFrame:
    """The value at the highest rank of each key, null where that rank has more than one value."""
    top = rows.withColumn("r", F.rank().over(Window.partitionBy(key).orderBy(F.col(rank).desc()))).where("r = 1")
    return top.groupBy(key).agg(F.when(F.countDistinct(value) == 1, F.max(value)).alias(value), F.max(rank).alias(rank))


def search(rows: DataFrame, needle: str | None, fields: list[str], fold, facets: dict | None = None) -> DataFrame:
    """Rows one of whose fields holds the needle, both folded; facets are exact. matched: the names of the fields that hit."""
    out = rows
    for k, v in (facets or {}).items():
        out = out.where(F.col(k) == v)
    if needle is None:
        return out.withColumn("matched", F.array().cast("array<string>"))
    hits = F.array_compact(F.array(*[F.when(fold(F.col(c)).contains(needle), F.lit(c)) for c in fields]))
    return out.withColumn("matched", F.array_sort(hits)).where(F.size("matched") > 0)


def facet_counts(rows: DataFrame, facets: list[str]) -> DataFrame:
    """(facet, label, n) of every facet, from one pass over exploded pairs."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("label")) for f in facets]))
    return rows.select(pairs.alias("p")).groupBy(F.col("p.facet").alias("facet"), F.col("p.label").alias("label")).agg(F.count("*").alias("n"))


def merge_statements(rows: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """Rows with equal keys become one with the sorted union of their lists."""
    return rows.groupBy(*keys).agg(*[F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c) for c in lists])


def drop_subsumed(rows: DataFrame, key: str, ident: str, text: str, same: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose text is not a whole-word part of a longer text under the same key and the same values of `same`,
    such as a qualifier and an amount.

    Longer texts are met by key and by the shorter one's first word, so rows of a key are not all compared.
    """
    padded = F.concat(F.lit(" "), F.col(text), F.lit(" "))
    words = F.array_distinct(F.split(F.col(text), " "))
    longer = rows.select(F.col(key).alias("__k"), padded.alias("__t"), F.length(text).alias("__n"), F.explode(words).alias("__w"), *[F.col(c).alias(f"__{c}") for c in same])
    inside = (F.col(key) == F.col("__k")) & (F.split(F.col(text), " ")[0] == F.col("__w")) & (F.col("__n") > F.length(text)) & F.col("__t").contains(padded)
    for c in same:
        inside = inside & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return rows.join(longer, inside, "left_anti")


def page(rows: DataFrame, order: list[str], limit: int, offset: int, most: int = 200) -> DataFrame:
    """A page of rows in a total order, each with the exact total of all rows and the offset of the next page (null at the end).

    Ordering stops at offset + limit rows; the total is one count.
    """
    if not 1 <= limit <= most or offset < 0:
        raise ValueError(f"limit must lie in 1..{most} and offset must not be negative")
    own = rows.orderBy(*order).offset(offset).limit(limit)
    total = rows.agg(F.count("*").alias("total"))
    nxt = F.when(F.lit(offset + limit) < F.col("total"), F.lit(offset + limit))
    return own.crossJoin(F.broadcast(total)).withColumn("next_offset", nxt)  # total is one row
