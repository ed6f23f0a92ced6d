"""Small shapes of rows: picks by priority, probes, comparisons of linked rows, flat fields, ordered lists, error sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions.clocks import is_calendar_quarter
from claimlens.functions.facilities import first_of


def preferred(rows: DataFrame, key: str, field: str, value: str, priorities: tuple[str, ...], order: list[str]) -> DataFrame:
    """(key, value): the value of the first field in a list of priorities that a key has; of several, the first in `order`."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priorities]), F.col(field))
    named = rows.withColumn("__rank", rank).where("__rank > 0")
    return named.groupBy(key).agg(F.min_by(value, F.struct("__rank", *order)).alias(value))


def typed_value(kind: str, subtypes: dict[str, str]) -> Column:
    """The value of a typed union as canonical-enough JSON: the column of the row's kind, null where it is empty."""
    return first_of(((F.col(kind) == k) & F.col(c).isNotNull(), F.to_json(F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")))) for k, c in subtypes.items())


def nullable_in(column: str, values: DataFrame, name: str):
    """A function of rows: those whose column is null or among the values."""

    def keep(rows: DataFrame) -> DataFrame:
        named = values.select(F.col(name).alias(column)).where(F.col(column).isNotNull()).distinct()
        return rows.where(F.col(column).isNull()).unionByName(rows.join(named, column, "left_semi").select(rows.columns))

    return keep


def probe(rows: DataFrame, table: DataFrame, value: str, *keys: tuple[str, str]) -> DataFrame:
    """rows with `value` from the first (own column, table column) pair under which the table has a single match."""
    out, found = rows, []
    for n, (own, other) in enumerate(keys):
        once = table.groupBy(F.col(other).alias(f"__k{n}")).agg(F.count("*").alias("__n"), F.min(value).alias(f"__v{n}")).where("__n = 1").drop("__n")
        out = out.join(once, F.col(own) == F.col(f"__k{n}"), "left").drop(f"__k{n}")
        found.append(F.col(f"__v{n}"))
    return out.withColumn(value, F.coalesce(*found)).drop(*[f"__v{n}" for n in range(len(keys))])


def compare_linked(links: DataFrame, left: DataFrame, right: DataFrame, fields: list[str]) -> DataFrame:
    """(left_id, right_id, differing, missing): reviewed pairs with the fields that differ and those that a side lacks."""
    a = left.select(F.col("id").alias("left_id"), F.struct(*fields).alias("a"))
    b = right.select(F.col("id").alias("right_id"), F.struct(*fields).alias("b"))
    both = links.join(a, "left_id", "left").join(b, "right_id", "left")
    lacks = lambda f: F.col(f"a.{f}").isNull() | F.col(f"b.{f}").isNull()
    named = lambda test: F.array_compact(F.array(*[F.when(test(f), F.lit(f)) for f in fields]))
    return both.select("left_id", "right_id", named(lambda f: ~lacks(f) & (F.col(f"a.{f}") != F.col(f"b.{f}"))).alias("differing"), named(lacks).alias("missing"))


def aligned(before: Column, after: Column) -> Column:
    """array of (place, before, after) where two parallel lists differ; the shorter one is padded with nulls."""
    both = F.transform(F.arrays_zip(before.alias("b"), after.alias("a")), lambda x, i: F.struct(i.alias("place"), x["b"].alias("before"), x["a"].alias("after")))
    return F.filter(both, lambda x: ~x["before"].eqNullSafe(x["after"]))


def flat(df: DataFrame) -> DataFrame:
    """Structs as columns with dotted names, at any depth; arrays and maps stay whole."""

    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield F.col(".".join(f"`{p}`" for p in here)).alias(".".join(here))

    return df.select(*leaves(df.schema, ()))


def in_order(rows: DataFrame, key: str, place: str, value: str) -> DataFrame:
    """(key, values): each key's distinct values in the order of their first places."""
    first = rows.groupBy(key, value).agg(F.min(place).alias("__p"))
    return first.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__p", value))), lambda x: x[value]).alias("values"))


def errors_by(rows: DataFrame, by: tuple[str, ...], error: str, exact: Column) -> DataFrame:
    """Cases, exact cases, mean absolute error and bias of each group, over those with an exact date alone."""
    own = F.when(exact, F.col(error))
    return rows.groupBy(*by).agg(F.count("*").alias("cases"), F.count(own).alias("exact_cases"), F.round(F.try_divide(F.sum(F.abs(own)), F.count(own)), 9).alias("mae"), F.round(F.try_divide(F.sum(own), F.count(own)), 9).alias("bias"))


def negative_bounds(rows: DataFrame) -> DataFrame:
    """Bounds of the share of quiet cases that are rightly quiet: unknown truths count against, then for. rows: truth, decision."""
    quiet, t = F.col("decision") == "quiet", F.col("truth")
    known = F.coalesce(t.isin("positive", "negative"), F.lit(False))
    n = rows.agg(F.count_if(quiet).alias("quiet"), F.count_if(quiet & (t == "negative")).alias("negatives"), F.count_if(quiet & ~known).alias("unknown"))
    return n.select("*", F.round(F.try_divide("negatives", "quiet"), 9).alias("lower"), F.round(F.try_divide(F.col("negatives") + F.col("unknown"), "quiet"), 9).alias("upper"))


def states(rows: DataFrame, key: str, category: str, flag: str, day: str) -> DataFrame:
    """(key, category, states): the distinct (flag, day) pairs of each category, sorted."""
    return rows.groupBy(key, category).agg(F.array_sort(F.collect_set(F.struct(flag, day))).alias("states"))


def state_at(events: DataFrame, versions: DataFrame, key: str, recorded: str = "recorded_us") -> DataFrame:
    """events (key, at_us, ...) with `version_id` of the version that stood at their instant; null where none did.

    Events and versions of a key are merged in one order and the last version is carried on, so no range is joined.
    """
    a = events.select(key, F.col("at_us").alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast("long").alias("__v"), F.struct(*events.columns).alias("__e"))
    b = versions.select(key, F.col(recorded).alias("__at"), F.lit(0).alias("__side"), F.col("version_id").cast("long").alias("__v"), F.lit(None).cast(a.schema["__e"].dataType).alias("__e"))
    line = Window.partitionBy(key).orderBy("__at", "__side", "__v").rowsBetween(Window.unboundedPreceding, 0)
    return a.unionByName(b).withColumn("version_id", F.last("__v", ignorenulls=True).over(line)).where("__side = 1").select("__e.*", "version_id")


def quarter_supply(semantics: Column, unit: Column, basis: Column, start: Column, end: Column) -> Column:
    """Why a capacity is not a supply of one quarter; null where it is."""
    lacks = lambda test: ~F.coalesce(test, F.lit(False))
    return first_of(
        [
            (lacks(semantics == "quarter_total"), "quantity_semantics_not_quarter_total"),
            (lacks(unit.isin("units/quarter", "wafers/quarter")), "unit_not_quarter_total"),
            (lacks(basis == "source_stated_quarter_total"), "input_output_basis_not_quarter_total"),
            (lacks(is_calendar_quarter(start, end)), "period_not_exact_calendar_quarter"),
        ]
    )
