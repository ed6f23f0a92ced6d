"""Bitemporal views: what was true on a day according to what was known at an instant.

World time is half-open [valid_from, valid_to); knowledge is half-open [recorded, superseded); a supersession after the
cutoff is masked to null. One version stands for a series: latest valid_from, then latest recorded, then largest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def known(at: int | Column, recorded: str = "recorded_us", superseded: str = "superseded_us") -> Column:
    at = at if isinstance(at, Column) else F.lit(at)
    return (F.col(recorded) <= at) & (F.col(superseded).isNull() | (at < F.col(superseded)))


def valid(on: str, start: str = "valid_from", end: str = "valid_to") -> Column:
    day = F.lit(on).cast("date")
    return (F.col(start) <= day) & (F.col(end).isNull() | (day < F.col(end)))


def masked(at: int, superseded: str = "superseded_us") -> Column:
    """A supersession that was known at the instant, else null."""
    return F.when(F.col(superseded) <= F.lit(at), F.col(superseded)).alias(superseded)


def current(claims: DataFrame, on: str, at: int, series: tuple[str, ...] = ("entity_id", "predicate"), entity: int | None = None, predicate: str | None = None) -> DataFrame:
    """The standing version of each series; optional filters reach the scan."""
    rows = claims
    if entity is not None:
        rows = rows.where(F.col("entity_id") == entity)
    if predicate is not None:
        rows = rows.where(F.col("predicate") == predicate)
    order = Window.partitionBy(*series).orderBy(F.col("valid_from").desc(), F.col("recorded_us").desc(), F.col("claim_id").desc())
    eligible = rows.where(valid(on) & known(at))
    return eligible.withColumn("temporal_rank", F.row_number().over(order)).where("temporal_rank = 1").withColumn("superseded_us", masked(at)).drop("temporal_rank")


def statements(claims: DataFrame, at: int) -> DataFrame:
    """Source statements that stood at the instant, by knowledge alone; all open versions, not one a series."""
    return claims.where((F.col("claim_kind") == "source_statement") & known(at)).withColumn("superseded_us", masked(at))


def history(claims: DataFrame, on: str, at: int, required: DataFrame | None = None) -> DataFrame:
    """Every version that had begun and was recorded, and every recorded statement; later supersession masked; required ids are kept whatever their dates."""
    begun = F.col("valid_from").isNull() | (F.col("valid_from") <= F.lit(on).cast("date")) | (F.col("claim_kind") == "source_statement")
    rows = claims.where(F.col("recorded_us") <= F.lit(at)).withColumn("superseded_us", masked(at))
    if required is None:
        return rows.where(begun)
    named = required.select("claim_id").distinct().withColumn("required", F.lit(True))
    return rows.join(named, "claim_id", "left").where(begun | F.col("required")).drop("required")


def assignments_as_of(assignments: DataFrame, on: str, at: int, observed: int | None = None) -> DataFrame:
    rows = assignments if observed is None else assignments.where(F.col("observed_id") == observed)
    return rows.where(valid(on) & (F.col("recorded_us") <= F.lit(at)))


def complete_view_equal(given: DataFrame, computed: DataFrame) -> DataFrame:
    """(missing, extra): rows that a copy lacks of a view and rows it has beyond it, repeats counted."""
    missing = computed.exceptAll(given).agg(F.count("*").alias("missing"))
    extra = given.exceptAll(computed).agg(F.count("*").alias("extra"))
    return missing.crossJoin(extra)  # one row each
