"""Entity resolution: candidates on unique identifiers, conflicts, and assignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.facilities import first_of


def unique_side(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key no other row has."""
    one = rows.groupBy(key).agg(F.count("*").alias("n")).where("n = 1").select(key)
    return rows.join(one, key, "left_semi")


def candidates(left: DataFrame, right: DataFrame, key: str, score: Column) -> DataFrame:
    """Pairs that agree on a key which is unique on the right, with a score; a left row has one pair at most, so none is ranked."""
    return left.join(unique_side(right, key), key).withColumn("score", score)


def ranked(pairs: DataFrame, left: str, right: str, most: int | None = None) -> DataFrame:
    """Pairs with rank 1, 2, ... for each left row by falling score, ties by the right id; `most` keeps that many."""
    rows = pairs.withColumn("rank", F.row_number().over(Window.partitionBy(left).orderBy(F.col("score").desc(), right)))
    return rows if most is None else rows.where(F.col("rank") <= most)


def single_values(rows: DataFrame, record: str, value: str) -> DataFrame:
    """Allowlist: values of records that hold exactly one distinct non-blank value; the others keep a reason."""
    got = rows.groupBy(record).agg(F.collect_set(F.when(F.trim(value) != "", F.trim(value))).alias("v"))
    reason = F.when(F.size("v") == 0, "blank").when(F.size("v") > 1, "conflict").otherwise("accepted")
    return got.select(record, F.when(F.size("v") == 1, F.col("v")[0]).alias(value), reason.alias("reason"))


def more_than_one(edges: DataFrame, entity: str, other: str) -> DataFrame:
    """Entities related to more than one distinct other."""
    return edges.groupBy(entity).agg(F.countDistinct(other).alias("n_others")).where("n_others > 1")


def twins(rows: DataFrame, ident: str, *keys: str) -> DataFrame:
    """Rows that share all keys with another row, with the smallest id of their group."""
    g = rows.groupBy(*keys).agg(F.min(ident).alias("anchor"), F.count("*").alias("members")).where("members > 1")
    return rows.join(g, list(keys)).select(ident, "anchor", "members")


def target_evidence(named: DataFrame, store: dict[str, DataFrame]) -> DataFrame:
    """(review_id, version_id, problem): claims that a review names for its target but that do not support it.

    named: review_id, target_id, version_id, reviewed_us. A claim must be about the target, rest on a source through a
    run that had succeeded before the review, and be current when reviewed.
    """
    runs = store["runs"].select("run_id", F.col("status").alias("r_status"), F.col("completed_us").alias("r_done"))
    about = store["series"].select("series_id", F.col("entity_id").alias("s_entity"))
    backed = store["evidence"].select("version_id", F.lit(True).alias("backed")).distinct()
    own = store["versions"].select("version_id", "series_id", "run_id", "recorded_us", "superseded_us").join(about, "series_id", "left").join(runs, "run_id", "left")
    rows = named.join(own, "version_id", "left").join(backed, "version_id", "left")
    lined = F.col("backed").isNotNull() & (F.col("r_status") == "succeeded") & F.col("r_done").isNotNull()
    current = (F.col("recorded_us") <= F.col("reviewed_us")) & (F.col("superseded_us").isNull() | (F.col("superseded_us") > F.col("reviewed_us")))
    problem = first_of(
        [
            (F.col("recorded_us").isNull(), "unknown_claim"),
            (~F.coalesce(F.col("s_entity") == F.col("target_id"), F.lit(False)), "other_entity"),
            (~F.coalesce(lined, F.lit(False)), "no_succeeded_source"),
            (F.col("r_done") > F.col("reviewed_us"), "produced_after_review"),
            (~F.coalesce(current, F.lit(False)), "not_current"),
        ]
    )
    return rows.select("review_id", "version_id", problem.alias("problem")).where("problem is not null")
