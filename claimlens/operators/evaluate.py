"""Evaluation: metrics that keep unknown labels in their bounds, freshness, gaps and presence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


HOUR_US = 3_600_000_000


def ratio(a: Column, b: Column) -> Column:
    """a / b, null over zero."""
    return F.round(F.try_divide(a, b), 9)


def confusion_bounds(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Counts and ratio bounds. rows: truth (positive, negative, or anything else: unknown), decision (candidate, quiet, ...).

    With `by`, one row per group and one over all (nulls in `by`), from one pass.
    """
    t, d = F.col("truth"), F.col("decision")
    known = F.coalesce(t.isin("positive", "negative"), F.lit(False))
    candidate = F.coalesce(d == "candidate", F.lit(False))
    n = lambda c, name: F.count_if(c).alias(name)
    aggs = [
        F.count("*").alias("cases"),
        n((t == "positive") & candidate, "tp"),
        n((t == "negative") & candidate, "fp"),
        n((t == "negative") & (d == "quiet"), "tn"),
        n((t == "positive") & (d == "quiet"), "fn"),
        n(t == "positive", "positives"),
        n(candidate, "candidates"),
        n(candidate & ~known, "unknown_candidates"),
        n(known, "known"),
    ]
    got = (rows.groupingSets([[F.col(b) for b in by], []], *[F.col(b) for b in by]) if by else rows.groupBy()).agg(*aggs)
    return got.select(
        *by,
        *[c for c in got.columns if c not in by],
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("support"),
        ratio(F.col("tp"), F.col("candidates")).alias("support_lower"),
        ratio(F.col("tp") + F.col("unknown_candidates"), F.col("candidates")).alias("support_upper"),
        ratio(F.col("tp"), F.col("positives")).alias("sensitivity"),
        ratio(F.col("fp"), F.col("cases")).alias("burden"),
        ratio(F.col("known"), F.col("cases")).alias("label_coverage"),
    )


def alert_outcomes(truths: DataFrame, alerts: DataFrame, start: int, end: int) -> DataFrame:
    """Each truth (truth_id, key, available_us, deadline_us) against alerts (key, admitted_us, verdict).

    Before the window: prior; deadline not inside it: right-censored; then timely, unresolved or missed.
    """
    near = alerts.select(F.col("key").alias("k"), "admitted_us", "verdict")
    both = truths.join(near, (truths["key"] == near["k"]) & (F.col("available_us") <= F.col("admitted_us")) & (F.col("admitted_us") <= F.col("deadline_us")), "left")
    got = both.groupBy("truth_id", "available_us", "deadline_us").agg(F.count_if(F.col("verdict") == "supported").alias("timely"), F.count_if(F.col("verdict").isin("unresolved", "unlabelled")).alias("potential"))
    state = F.when(F.col("available_us") < start, "prior_window_event").when(F.col("deadline_us") >= end, "right_censored").when(F.col("timely") > 0, "timely_detected").when(F.col("potential") > 0, "unresolved_matching").otherwise("missed_deadline")
    return got.select("truth_id", "timely", "potential", state.alias("status"))


def largest_gap(clocks: DataFrame, start: int, end: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Largest difference between neighbouring clocks `us` of (start, end) with both edges as clocks, in seconds."""
    # neighbours inside hours first, so that one key with very many clocks is spread; then between hours
    hours = clocks.select(*by, "us").distinct().withColumn("hour", F.floor(F.col("us") / HOUR_US))
    near = Window.partitionBy(*by, "hour").orderBy("us")
    own = hours.withColumn("gap", F.col("us") - F.lag("us").over(near)).groupBy(*by, "hour").agg(F.min("us").alias("lo"), F.max("us").alias("hi"), F.max("gap").alias("gap"))
    order = Window.partitionBy(*by).orderBy("hour") if by else Window.orderBy("hour")
    between = own.withColumn("gap", F.greatest("gap", F.col("lo") - F.lag("hi", 1, start).over(order)))
    return between.groupBy(*by).agg(F.greatest(F.max("gap"), F.lit(end) - F.max("hi")).alias("g")).select(*by, (F.col("g") / 1e6).alias("largest_gap_seconds"))


def freshness(rows: DataFrame, key: str, now: int, seconds: int) -> DataFrame:
    """Latest clock of each key with the number of rows tied on it, its age, and whether it is stale (age at the limit counts)."""
    top = rows.groupBy(key).agg(F.max("us").alias("latest_us"))
    tied = rows.join(top, key).where("us = latest_us").groupBy(key, "latest_us").agg(F.count("*").alias("tied"))
    age = (F.lit(now) - F.col("latest_us")) / 1e6
    return tied.select(key, "latest_us", "tied", age.alias("age_seconds"), (age >= seconds).alias("stale"))


def presence(rows: DataFrame, key: str, kind: str, kinds: list[str]) -> DataFrame:
    """One row per key with `supported` or `unknown` for each kind."""
    cells = [F.when(F.max(F.when(F.col(kind) == k, 1)) == 1, "supported").otherwise("unknown").alias(k) for k in kinds]
    return rows.groupBy(key).agg(*cells)
