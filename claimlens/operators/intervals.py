"""Interval algebra: targets against outcomes, censoring, horizons, and overlap joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.plans.staging import Staging


def relation(low: Column, high: Column, vintage: Column, horizon: Column) -> Column:
    """Where an outcome lies: the vintage is tested before the horizon, so a span over both is vintage-straddling."""
    return F.when(high <= vintage, "pre_vintage").when(low <= vintage, "vintage_straddling").when(low > horizon, "after_horizon").when(high > horizon, "horizon_straddling").otherwise("within_horizon")


def diagnose(rows: DataFrame, vintage: str, horizon: str) -> DataFrame:
    """Classify predictions [p_low, p_high] (null: abstained) against outcomes (status, low, high, through).

    status: observed, cancelled, right_censored, unknown. A miss is true or false only where it is proven.
    """
    v, h = F.lit(vintage).cast("date"), F.lit(horizon).cast("date")
    status, low, high, through = F.col("status"), F.col("low"), F.col("high"), F.col("through")
    when = F.when(status.isin("observed", "cancelled"), relation(low, high, v, h)).when(status == "right_censored", relation(through, through, v, h))
    issued = F.col("p_low").isNotNull()
    scored = issued & (status == "observed") & (when == "within_horizon")
    contained = (F.col("p_low") <= low) & (high <= F.col("p_high"))
    overlap = (F.col("p_low") <= high) & (low <= F.col("p_high"))
    kind = (
        F.when(~issued, "abstained")
        .when(status == "unknown", "unknown")
        .when(status == "right_censored", F.when(when == "pre_vintage", "pre_vintage").when(through >= F.col("p_high"), "censored_window_miss").otherwise("right_censored"))
        .when(when != "within_horizon", when)
        .when(status == "cancelled", "cancelled")
        .when(contained, "contained")
        .when(overlap, "overlapping")
        .when(high < F.col("p_low"), "missed_early")
        .otherwise("missed_late")
    )
    miss = F.when(kind == "contained", False).when(kind.isin("censored_window_miss", "missed_early", "missed_late"), True)
    return rows.withColumns({"temporal": when, "classification": kind, "contained": F.when(scored, contained), "overlap": F.when(scored, overlap), "window_miss": miss})


def target_outcome(rows: DataFrame) -> DataFrame:
    """Targets (kind interval or deadline, t_low, t_high) against outcomes (status, low, high).

    observed has low and high; observed_by and explicit_nonoccurrence_through have high alone. met and possible are
    null where bounds do not settle them.
    """
    kind, status, tl, th, low, high = (F.col(c) for c in ("kind", "status", "t_low", "t_high", "low", "high"))
    deadline = kind == "deadline"
    result = (
        F.when(kind.isNull(), "no_target")
        .when(status.isin("cancelled", "unknown"), status)
        .when(status == "explicit_nonoccurrence_through", F.when(high >= th, F.concat(F.lit("censored_"), kind, F.lit("_miss"))).otherwise(status))
        .when((status == "observed_by") & deadline, F.when(high <= th, "deadline_met").otherwise("deadline_upper_bound_unresolved"))
        .when(status == "observed_by", F.when(high < tl, "interval_missed_early").otherwise("interval_upper_bound_unresolved"))
        .when(deadline, F.when(high <= th, "deadline_met").when(low > th, "deadline_missed_late").otherwise("deadline_straddling"))
        .when((tl <= low) & (high <= th), "interval_contained")
        .when((tl <= high) & (low <= th), "interval_overlapping")
        .when(high < tl, "interval_missed_early")
        .otherwise("interval_missed_late")
    )
    missed = result.rlike("_miss")
    met = F.when(result.isin("deadline_met", "interval_contained"), True).when(missed, False)
    possible = F.when(missed, False).when(result.rlike("^(deadline|interval)_"), True)
    return rows.withColumns({"classification": result, "target_met": met, "possible": possible})


def timing_error(low: Column, high: Column, target: Column) -> tuple[Column, Column]:
    """Signed error bounds in days of a target day against an outcome in [low, high]."""
    return F.datediff(target, high), F.datediff(target, low)


def overlapping_pairs(rows: DataFrame, key: str, ident: str, start: str, end: str, days: int = 64, recorded: str | None = None, superseded: str | None = None) -> DataFrame:
    """(key, left_id, right_id) of rows of one key whose half-open intervals overlap; an open end lasts for ever.

    With `recorded` and `superseded` two rows must also be known at one instant: knowledge [recorded, superseded).
    Closed intervals meet in day buckets of fixed width, so one busy key is spread over time; a pair is reported in the
    bucket where its later start lies. Open intervals meet only the buckets after their start through the rows that begin there.
    """
    far, always = F.lit("9999-12-31").cast("date"), F.lit(2**63 - 1)
    from_us = F.col(recorded).cast("long") if recorded else F.lit(0).cast("long")
    to_us = F.coalesce(F.col(superseded).cast("long"), always) if superseded else always
    base = rows.select(key, F.col(ident).alias("id"), F.col(start).alias("s"), F.coalesce(end, far).alias("e"), F.floor(F.unix_date(start) / days).alias("b"), from_us.alias("f"), to_us.alias("t"))
    last = F.floor(F.unix_date(F.date_sub(F.col("e"), 1)) / days)
    closed = base.where(F.col("e") < far).select(key, "id", "s", "e", "f", "t", F.explode(F.sequence("b", last)).alias("b"))
    left = closed.select(key, F.col("id").alias("l"), F.col("s").alias("ls"), F.col("e").alias("le"), F.col("f").alias("lf"), F.col("t").alias("lt"), "b")
    begin = base.select(key, F.col("id").alias("r"), F.col("s").alias("rs"), F.col("e").alias("re"), F.col("f").alias("rf"), F.col("t").alias("rt"), "b")
    known = (F.col("lf") < F.col("rt")) & (F.col("rf") < F.col("lt"))
    later = (F.col("rs") > F.col("ls")) | ((F.col("rs") == F.col("ls")) & (F.col("r") > F.col("l")))
    near = left.join(begin, [key, "b"]).where((F.col("rs") < F.col("le")) & later & known)
    opened = base.where(F.col("e") == far).select(key, F.col("id").alias("l"), F.col("s").alias("ls"), F.col("f").alias("lf"), F.col("t").alias("lt"))
    wide = opened.join(begin, key).where(later & known)
    pairs = near.select(key, "l", "r").unionByName(wide.select(key, "l", "r"))
    return pairs.select(key, F.least("l", "r").alias("left_id"), F.greatest("l", "r").alias("right_id"))


def document_order(guidance: Column, outcome: Column) -> Column:
    """Which of two document days came first; unknown where one is missing."""
    return F.when(guidance < outcome, "guidance_before_outcome_document").when(guidance == outcome, "same_reported_document_day").when(guidance > outcome, "outcome_document_before_guidance").otherwise("unknown")


def relative_to_day(status: Column, low: Column, high: Column, day: Column) -> Column:
    """Where an outcome (observed within [low, high], or by high alone) lies against a document's day."""
    seen = F.coalesce(status.isin("observed", "observed_by"), F.lit(False)) & day.isNotNull() & high.isNotNull()
    return (
        F.when(~seen, "unknown")
        .when(high < day, "before_reported_document_day")
        .when(low.isNull(), F.when(high == day, "on_or_before_reported_document_day").otherwise("unknown"))
        .when(low > day, "after_reported_document_day")
        .when((low == day) & (high == day), "on_reported_document_day")
        .otherwise("spans_reported_document_day")
    )


def clashes(rows: DataFrame, staging: Staging) -> DataFrame:
    """(key, id, start, end, reach): intervals (key, id, start, end) that begin before an earlier one of their key has ended.

    reach is the latest of those ends, null if one is open. Rows are linear in the input whatever clashes: a range sort
    deals them into parts, the latest ends of parts run on to the parts that follow, and inside a part the rows do. So a
    key with very many open intervals is spread over the cluster, and no pair is listed. Empty intervals clash with none.
    """
    real = rows.where("end is null or start < end").select("key", "id", "start", "end", F.struct(F.col("end").isNull().alias("open"), "end").alias("until"))
    dealt = real.repartitionByRange("key", "start", "id").sortWithinPartitions("key", "start", "id")
    dealt = staging.table(dealt.select("*", F.spark_partition_id().alias("part")), "sorted")
    ends = dealt.groupBy("key", "part").agg(F.max("until").alias("until"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("key", "part", F.max("until").over(before).alias("carried"))
    inside = Window.partitionBy("key", "part").orderBy("start", "id").rowsBetween(Window.unboundedPreceding, -1)
    reach = dealt.withColumn("own", F.max("until").over(inside)).join(carried, ["key", "part"]).withColumn("reach", F.greatest("own", "carried"))
    return reach.where("reach.open or reach.end > start").select("key", "id", "start", "end", F.col("reach.end").alias("reach"))
