"""What changed: event feeds, revision pairs and alerts, release diffs and proposals."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.facilities import first_of
from claimlens.functions.ids import tree_digest
from claimlens.operators.views import valid


def feed(claims: DataFrame, since: int, until: int) -> DataFrame:
    """Admissions and supersessions in (since, until], one row an event; one scan, no union."""
    events = F.array(F.struct(F.lit("claim_admitted").alias("event_type"), F.col("recorded_us").alias("event_us")), F.struct(F.lit("claim_superseded").alias("event_type"), F.col("superseded_us").alias("event_us")))
    rows = claims.select("claim_id", "entity_id", "predicate", F.explode(F.filter(events, lambda e: (e["event_us"] > since) & (e["event_us"] <= until))).alias("e"))
    return rows.select("claim_id", "entity_id", "predicate", "e.event_type", "e.event_us")


def feed_counts(events: DataFrame, kinds: tuple[str, ...] = ("claim_admitted", "claim_superseded")) -> DataFrame:
    """Events, claims and entities by type; types without events are kept at zero."""
    names = events.sparkSession.createDataFrame([(k,) for k in kinds], "event_type string")
    got = events.groupBy("event_type").agg(F.count("*").alias("events"), F.countDistinct("claim_id").alias("claims"), F.countDistinct("entity_id").alias("entities"))
    return F.broadcast(names).join(got, "event_type", "left").na.fill(0, ["events", "claims", "entities"])


def feed_page(events: DataFrame, limit: int, offset: int) -> DataFrame:
    """A page in the order (event_us, event_type, claim_id); ordering stops at offset + limit rows."""
    if not 1 <= limit <= 200 or offset < 0:
        raise ValueError("limit must lie in 1..200 and offset must not be negative")
    return events.orderBy("event_us", "event_type", "claim_id").offset(offset).limit(limit)


def population_hash(events: DataFrame) -> DataFrame:
    """(n, digest): a token of the whole population, whatever its order; a page is stale when it differs."""
    text = F.concat_ws("|", F.col("event_us").cast("string"), "event_type", F.col("claim_id").cast("string"))
    return tree_digest(events, text).withColumnRenamed("rows", "n")


def revision_pairs(claims: DataFrame, on: str | None = None, at: int | None = None) -> DataFrame:
    """Each version with the one that superseded it: same series and valid_from, recorded at the supersession.

    Where claims carry a confidence, pairs hold both sides' as prior_confidence and current_confidence.
    """
    now = claims if on is None else claims.where(valid(on))
    now = now if at is None else now.where(F.col("recorded_us") <= at)
    prior = claims.where("superseded_us is not null").select("entity_id", "predicate", "valid_from", F.col("superseded_us").alias("recorded_us"), F.col("claim_id").alias("prior_id"), F.col("value").alias("prior_value"), *([F.col("confidence").alias("prior_confidence")] if "confidence" in claims.columns else []))
    sure = ["prior_confidence", F.col("confidence").alias("current_confidence")] if "confidence" in claims.columns else []
    return now.where("valid_from is not null").join(prior, ["entity_id", "predicate", "valid_from", "recorded_us"]).select("prior_id", F.col("claim_id").alias("current_id"), "entity_id", "predicate", "valid_from", "recorded_us", "prior_value", F.col("value").alias("current_value"), *sure)


def severity(size: Column, medium: float, high: float) -> Column:
    return F.when(size >= high, "high").when(size >= medium, "medium").otherwise("low")


def capacity_alerts(pairs: DataFrame, threshold: str = "0.15") -> DataFrame:
    """Relative changes of at least the threshold; a prior of zero is measured against the larger of the value and 1.

    Thresholds are multiplied across in decimals, never divided; relative_change is for reading only. A side of unknown
    confidence raises no alert.
    """
    p, c = F.col("prior_value").cast("decimal(20,6)"), F.col("current_value").cast("decimal(20,6)")
    base = F.when(p != 0, p).otherwise(F.greatest(c, F.lit(Decimal(1))))
    reaches = lambda times: F.abs(c - p) >= F.abs(base) * F.lit(Decimal(threshold) * times)
    rows = pairs.where("prior_confidence is not null and current_confidence is not null") if "prior_confidence" in pairs.columns else pairs
    rows = rows.where(reaches(1)).withColumn("relative_change", F.round((c - p).cast("double") / base.cast("double"), 9))
    kind = F.when((c > p) == (base > 0), "increase").otherwise("decrease")
    mark = F.sha2(F.to_json(F.array(F.lit("capacity_revision"), F.col("entity_id").cast("string"), F.col("prior_id").cast("string"), F.col("current_id").cast("string"))), 256)
    return rows.select("prior_id", "current_id", "entity_id", "predicate", "relative_change", kind.alias("direction"), first_of([(reaches(4), "high"), (reaches(2), "medium")], "low").alias("severity"), mark.alias("fingerprint"))


def milestone_alerts(pairs: DataFrame, days: int = 90) -> DataFrame:
    """Status transitions first, then shifts of at least `days`; a standing cancellation raises nothing.

    pairs: key, prior_status, current_status, prior_base, current_base.
    """
    shift = F.datediff("current_base", "prior_base")
    was, now = F.col("prior_status"), F.col("current_status")
    kind = (
        F.when((now == "cancelled") & (was != "cancelled"), "project_cancellation")
        .when((was == "cancelled") & (now != "cancelled"), "project_reactivation")
        .when((now == "delayed") & (was != "delayed"), "completion_delay")
        .when(now == "cancelled", None)
        .when(F.abs(shift) < days, None)
        .when(shift > 0, "completion_delay")
        .otherwise("completion_acceleration")
    )
    moved = ~((now == "cancelled") != (was == "cancelled")) & ~((now == "delayed") & (was != "delayed"))
    level = F.when(kind == "project_cancellation", "high").when(~moved, "medium").otherwise(severity(F.abs(shift), days * 2, days * 4))
    dated = pairs.where("prior_base is not null and current_base is not null")
    return dated.select("key", kind.alias("alert_type"), level.alias("severity"), shift.alias("shift_days")).where("alert_type is not null")


def scalar_alerts(pairs: DataFrame) -> DataFrame:
    """Alerts from words in a current text value: cancelled before redesigned before paused."""
    text = F.lower("current_text")
    kind = F.when(text.rlike("cancelled|canceled|redesigned|paused"), F.when(text.contains("cancel"), "project_cancellation").when(text.contains("redesign"), "project_redesign").otherwise("project_pause"))
    return pairs.withColumn("alert_type", kind).where("alert_type is not null").withColumn("severity", F.when(F.col("alert_type") == "project_cancellation", "high").otherwise("medium"))


def release_diff(prior: DataFrame, current: DataFrame, keys: tuple[str, ...] = ("entity_id", "predicate")) -> DataFrame:
    """Full outer comparison of two releases on the series key, with a status for each series."""
    a = prior.select(*keys, F.col("value").alias("prior_value"), F.lit(True).alias("in_prior"))
    b = current.select(*keys, F.col("value").alias("current_value"), F.lit(True).alias("in_current"))
    both = a.join(b, list(keys), "full_outer")
    status = F.when(F.col("in_prior").isNull(), "added").when(F.col("in_current").isNull(), "not_carried_forward").when(F.col("prior_value").eqNullSafe(F.col("current_value")), "reaffirmed").otherwise("revised")
    return both.select(*keys, "prior_value", "current_value", status.alias("status"))


def diff_summary(diff: DataFrame) -> DataFrame:
    """Series by status; every status is present."""
    names = diff.sparkSession.createDataFrame([(s,) for s in ("added", "not_carried_forward", "reaffirmed", "revised")], "status string")
    return F.broadcast(names).join(diff.groupBy("status").agg(F.count("*").alias("series")), "status", "left").na.fill(0, ["series"])


def capacity_proposals(diff: DataFrame, numerator: int = 15, denominator: int = 100) -> DataFrame:
    """Proposals where |current - prior| reaches numerator/denominator of the prior: multiplied across in decimals, never divided."""
    p, c = F.col("prior_value").cast("decimal(20,6)"), F.col("current_value").cast("decimal(20,6)")
    base = F.when(p != 0, p).otherwise(c)
    hit = (F.abs(c - p) * denominator >= F.abs(base) * numerator) & (c != p)
    rows = diff.where((F.col("status") == "revised") & hit)
    return rows.select("entity_id", "predicate", "prior_value", "current_value", F.when(c > p, "increase").otherwise("decrease").alias("direction"))


def stage_proposals(pairs: DataFrame, ranks: dict[str, int], side: tuple[str, ...]) -> DataFrame:
    """Lifecycle changes: to a side state, back from one, forward, or to an earlier stage. pairs: key, prior_stage, current_stage."""
    rank = lambda c: F.coalesce(*[F.when(F.col(c) == k, F.lit(v)) for k, v in ranks.items()])
    was, now = rank("prior_stage"), rank("current_stage")
    changed = F.col("prior_stage") != F.col("current_stage")
    rule = F.when(changed & F.col("current_stage").isin(*side), "lifecycle_side_state").when(changed & now.isNotNull(), "lifecycle_positive_stage_change")
    way = F.when(rule == "lifecycle_positive_stage_change", F.when(was.isNull(), "return_to_positive").when(now > was, "advanced").otherwise("earlier_stage"))
    return pairs.select("key", "prior_stage", "current_stage", rule.alias("rule"), way.alias("direction")).where("rule is not null")


def compare_periods(low1: Column, high1: Column, low2: Column, high2: Column) -> Column:
    return F.when((low1 == low2) & (high1 == high2), "reaffirmation").when(high2 < low1, "disjoint_earlier").when(low2 > high1, "disjoint_later").otherwise("overlapping_changed")


#: The rules of proposals, the order of positive stages, and the states beside them.
RULES = ("capability_readiness_change", "capacity_evidence_added", "capacity_revision_15_percent", "geography_point_change", "lifecycle_positive_stage_change", "lifecycle_side_state")
POSITIVE_STAGES = ("lead", "announced", "site_control", "permitting", "permitted", "site_preparation", "civil_works", "shell", "cleanroom_fitout", "utilities_ready", "tools_installing", "commissioning", "customer_qualification", "ramping", "complete")
SIDE_STATES = ("paused", "cancelled", "redesigned", "repurposed", "decommissioned")
#: Fields of a capacity of which any may cross the threshold.
FIGURES = ("low", "base", "high")


def series_id(subject: str, predicate: str, kind: str, dimensions: list[str]) -> Column:
    """Identity of a series by what it is about: subject, predicate, kind and dimensions, never by its claims' ids."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (subject, predicate, kind, *dimensions)]
    return F.sha2(F.to_json(F.array(*parts)), 256)


def series_changes(prior: DataFrame, current: DataFrame, key: str = "series_id") -> DataFrame:
    """(key, status, prior, current): both snapshots of every series as structs, with what became of it."""
    own = [c for c in prior.columns if c != key]
    a, b = (df.select(key, F.struct(*own).alias(name)) for df, name in ((prior, "prior"), (current, "current")))
    status = first_of([(F.col("prior").isNull(), "added"), (F.col("current").isNull(), "not_carried_forward"), (F.col("prior").eqNullSafe(F.col("current")), "reaffirmed")], "revised")
    return a.join(b, key, "full_outer").select(key, status.alias("status"), "prior", "current")


def crossed(numerator: int = 15, denominator: int = 100) -> Column:
    """The figures whose change reaches numerator/denominator of the prior one, or of the current where that is zero."""
    hits = []
    for f in FIGURES:
        p, c = F.col(f"prior.{f}").cast("decimal(20,6)"), F.col(f"current.{f}").cast("decimal(20,6)")
        base = F.when(p != 0, p).otherwise(c)
        hits.append(F.when((base != 0) & (F.abs(c - p) * denominator >= F.abs(base) * numerator), F.lit(f)))
    return F.array_compact(F.array(*hits))


def proposals(changes: DataFrame, manifests: tuple[str, str], version: str = "1") -> DataFrame:
    """Alert proposals of series_changes by six rules: series_id, rule, direction, fields, fingerprint.

    Snapshots hold subject_id, predicate, value_kind, stage, category, technology, readiness, low, base, high, point,
    valid_from, valid_to. A claim that was not carried forward proposes nothing. An added capability is compared with
    the only other observation of its subject, category and technology, where that is open and began earlier.
    """
    of = lambda c: F.coalesce(F.col(f"current.{c}"), F.col(f"prior.{c}"))
    rows = changes.select("*", *[of(c).alias(c) for c in ("subject_id", "predicate", "value_kind", "category", "technology")])
    seen = rows.where("value_kind = 'capability' and predicate = 'facility.capability'").groupBy("subject_id", "category", "technology")
    seen = seen.agg(F.count("prior").alias("priors"), F.count("current").alias("currents"), F.max("prior").alias("earlier")).where("priors = 1 and currents = 1")
    seen = seen.select(F.col("subject_id").alias("s"), F.col("category").alias("c"), F.col("technology").alias("t"), "earlier")
    rows = rows.join(seen, (F.col("subject_id") == F.col("s")) & (F.col("category") == F.col("c")) & (F.col("technology") == F.col("t")), "left")
    revised, added = F.col("status") == "revised", F.col("status") == "added"
    rank = lambda side: F.array_position(F.array(*[F.lit(x) for x in POSITIVE_STAGES]), F.col(f"{side}.stage"))
    moved = revised & (F.col("predicate") == "lifecycle.stage") & (F.col("prior.stage") != F.col("current.stage"))
    capability = F.col("predicate") == "facility.capability"
    later = (F.col("earlier.valid_to").isNull()) & (F.col("current.valid_from") > F.col("earlier.valid_from")) & ~F.col("earlier.readiness").eqNullSafe(F.col("current.readiness"))
    point = (F.col("predicate") == "geography.point") & (revised | added) & ~F.col("prior.point").eqNullSafe(F.col("current.point"))
    capacity, fields = F.col("value_kind") == "capacity", crossed()
    rule = first_of(
        [
            (moved & F.col("current.stage").isin(*SIDE_STATES), "lifecycle_side_state"),
            (moved & (rank("current") > 0), "lifecycle_positive_stage_change"),
            (capability & revised & ~F.col("prior.readiness").eqNullSafe(F.col("current.readiness")), "capability_readiness_change"),
            (capability & added & F.col("earlier").isNotNull() & later, "capability_readiness_change"),
            (capacity & added, "capacity_evidence_added"),
            (capacity & revised & (F.size(fields) > 0), "capacity_revision_15_percent"),
            (point, "geography_point_change"),
        ]
    )
    way = first_of([(rank("prior") == 0, "return_to_positive"), (rank("current") > rank("prior"), "advanced")], "earlier_stage")
    text = lambda side: F.sha2(F.coalesce(F.to_json(F.col(side)), F.lit("")), 256)
    mark = F.sha2(F.to_json(F.array(F.lit(version), F.col("rule"), F.lit(manifests[0]), F.lit(manifests[1]), F.col("series_id").cast("string"), text("prior"), text("current"))), 256)
    out = rows.withColumn("rule", rule).where("rule is not null")
    return out.select("series_id", "rule", F.when(F.col("rule") == "lifecycle_positive_stage_change", way).alias("direction"), F.when(F.col("rule") == "capacity_revision_15_percent", fields).alias("fields"), mark.alias("fingerprint"))
