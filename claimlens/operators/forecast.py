"""Capacity forecasts: value times basis factor times ramp, over 20 quarters and three quantiles."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.clocks import add_quarters, quarter_label, quarter_offset, quarter_start
from claimlens.functions.facilities import first_of, period_exclusion, relative_capacity
from claimlens.functions.ids import canonical

QUARTERS, DIGITS = 20, 9

#: Realisation factors (p10, p50, p90) by capacity basis.
BASIS = {
    "announced": (0.45, 0.70, 0.90),
    "physical_construction": (0.65, 0.82, 0.95),
    "tool_installed": (0.80, 0.92, 1.00),
    "qualified": (0.90, 0.97, 1.00),
    "economically_usable": (1.00, 1.00, 1.00),
}

#: Ramp fractions (p10, p50, p90) by quarters since production start; the last one holds.
RAMP = (
    (0.05, 0.15, 0.30),
    (0.15, 0.35, 0.60),
    (0.30, 0.60, 0.82),
    (0.50, 0.80, 0.95),
    (0.70, 0.92, 1.00),
    (0.85, 1.00, 1.00),
    (0.95, 1.00, 1.00),
    (1.00, 1.00, 1.00),
)


def basis_factor(basis: Column, quantile: int) -> Column:
    return F.element_at(F.create_map(*[x for k, v in BASIS.items() for x in (F.lit(k), F.lit(v[quantile]))]), basis)


def ramp(start: Column, target: Column, quantile: int) -> Column:
    """0 before the start, the held last fraction after the table, 1 without a start."""
    offset = quarter_offset(start, target)
    held = F.element_at(F.array(*[F.lit(r[quantile]) for r in RAMP]), F.least(F.greatest(offset, F.lit(0)), F.lit(len(RAMP) - 1)) + 1)
    return F.when(start.isNull(), 1.0).when(offset < 0, 0.0).otherwise(held)


def points(inputs: DataFrame, start: str, policy: str = "auto") -> DataFrame:
    """20 quarters a capacity. inputs: capacity_id, low, base, high, basis, start_low, start_base, start_high (dates or null).

    p10 pairs the low value with the latest start, p90 the high value with the earliest. Without a start, policy
    "auto" starts at the horizon unless the basis is economically usable, "horizon" always, "steady" never.
    """
    horizon = quarter_start(F.lit(start).cast("date"))
    fill = {"auto": F.when(F.col("basis") != "economically_usable", horizon), "horizon": horizon, "steady": F.lit(None).cast("date")}[policy]
    given = F.col("start_base").isNotNull()
    rows = inputs.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(QUARTERS - 1)))).withColumn("period_start", add_quarters(horizon, F.col("q")))
    out = []
    for k, (name, value, when) in enumerate((("p10", "low", "start_high"), ("p50", "base", "start_base"), ("p90", "high", "start_low"))):
        begin = F.when(given, F.col(when)).otherwise(fill)
        out.append(F.round(F.col(value) * basis_factor(F.col("basis"), k) * ramp(begin, F.col("period_start"), k), DIGITS).alias(name))
    keep = [c for c in inputs.columns if c not in ("low", "base", "high", "start_low", "start_base", "start_high")]
    return rows.select(*keep, quarter_label(F.col("period_start")).alias("quarter"), "period_start", *out)


def aggregate(forecasts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Sums by group, metric, unit and quarter; exact in decimals, so that order cannot change them."""
    total = lambda c: F.sum(F.col(c).cast("decimal(28,9)")).cast("double").alias(c)
    return forecasts.groupBy(*by, "quarter").agg(total("p10"), total("p50"), total("p90"), F.count("*").alias("members"))


def exclusion(rules: list[tuple[str, Column]]) -> Column:
    """The first reason whose rule holds; null where the row is eligible."""
    reason = None
    for name, rule in rules:
        reason = F.when(rule, name) if reason is None else reason.when(rule, name)
    return reason


def fingerprint(basis: dict[str, tuple[float, ...]] = BASIS, ramp_: tuple[tuple[float, ...], ...] = RAMP, policy: str = "auto") -> str:
    """SHA-256 of a model's parameters in canonical JSON, once they are sound.

    Factors and fractions lie in [0, 1] and rise from p10 to p90; fractions do not fall over the quarters and end at one.
    """
    if policy not in ("auto", "horizon", "steady"):
        raise ValueError(f"unknown policy {policy!r}")
    for name, row in [*basis.items(), *enumerate(ramp_)]:
        if len(row) != 3 or not 0 <= row[0] <= row[1] <= row[2] <= 1:
            raise ValueError(f"quantiles of {name!r} do not rise within [0, 1]")
    if not ramp_ or any(a > b for x, y in zip(ramp_, ramp_[1:], strict=False) for a, b in zip(x, y, strict=True)) or ramp_[-1] != (1.0, 1.0, 1.0):
        raise ValueError("a ramp must rise to one")
    return hashlib.sha256(canonical({"basis": basis, "ramp": ramp_, "policy": policy, "quarters": QUARTERS}).encode()).hexdigest()


#: Milestones that begin production, and statuses of those that stand.
PRODUCTION = ("mass_production", "production_start", "ramp_start", "volume_production")
STANDING = ("expected", "started", "completed", "delayed")


def selection(capacities: DataFrame, milestones: DataFrame, links: DataFrame, reviews: DataFrame, supported: DataFrame, start: str, by: str = "capacity_id") -> DataFrame:
    """Every capacity with the reason why it is not forecast (null: it is), the claims the reason names, and its milestone.

    capacities: capacity_id, entity_id, basis, unit, metric, confidence, valid_from, period_start, period_end;
    milestones: milestone_id, entity_id, milestone_type, status, confidence, valid_from, low, base; links: capacity_id,
    milestone_id (see release.linked), or, where many capacities have the same links, `by` and milestone_id once for all of
    them, `by` being a column of capacities too; reviews: capacity_id, milestone_id, decision; supported: claim ids `node` whose
    support reaches evidence. Economically usable capacity needs no milestone; any other needs exactly one that is
    linked, standing and fully known, and an accepted review of that very pair.
    """
    known = F.col("confidence").isNotNull() & F.col("valid_from").isNotNull()
    status = F.col("status")
    side = first_of([(status == "cancelled", "cancelled"), (status.isin(*STANDING), F.when(known & F.col("base").isNotNull(), "active").otherwise("unsupported"))])
    made = milestones.where(F.col("milestone_type").isin(*PRODUCTION)).select("milestone_id", "entity_id", "low", side.alias("side")).where("side is not null")
    gather = lambda name, *kinds: F.array_sort(F.collect_set(F.when(F.col("side").isin(*kinds), F.col("milestone_id")))).alias(name)
    linked = links.select(by, "milestone_id").distinct().join(made.drop("entity_id"), "milestone_id").groupBy(by).agg(
        gather("active", "active"), gather("cancelled", "cancelled"), gather("open", "active", "unsupported"), gather("unsupported", "unsupported"), F.min(F.when(F.col("side") == "active", F.col("low"))).alias("low")
    )
    # an entity's own milestones, of which reasons name all: bounded by one entity
    around = made.groupBy("entity_id").agg(gather("own_active", "active"), gather("own_cancelled", "cancelled"))
    # rules need the lists' lengths alone; the lists are met again by the rows that are asked for what a reason names
    length = lambda *names: [F.size(n).alias(f"n_{n}") for n in names]
    counted = linked.select(by, "low", F.when(F.size("active") == 1, F.element_at("active", 1)).alias("only"), *length("active", "cancelled", "open", "unsupported"))
    counted_around = around.select("entity_id", *length("own_active", "own_cancelled"))
    review = reviews.groupBy("capacity_id").agg(F.max_by(F.struct("milestone_id", "decision"), F.struct("milestone_id", "decision")).alias("r"))
    held = supported.select(F.col("node").alias("s")).distinct()
    rows = capacities.join(counted, by, "left").join(counted_around, "entity_id", "left").join(review, "capacity_id", "left")
    none = F.array().cast("array<long>")
    names = ("active", "cancelled", "open", "unsupported", "own_active", "own_cancelled")
    needs = F.col("basis") != "economically_usable"
    rows = rows.withColumns({f"n_{c}": F.coalesce(f"n_{c}", F.lit(0)) for c in names}).withColumn("milestone_id", F.when(needs, F.col("only")))
    rows = rows.join(held, F.col("capacity_id") == F.col("s"), "left").withColumn("sound", F.col("s").isNotNull()).drop("s")
    rows = rows.join(held, F.col("milestone_id") == F.col("s"), "left").withColumn("sound", F.col("sound") & (F.col("milestone_id").isNull() | F.col("s").isNotNull())).drop("s")
    begin = quarter_start(F.lit(start).cast("date"))
    low = F.when(F.col("milestone_id").isNotNull(), F.col("low"))
    period = period_exclusion(F.col("period_start"), F.col("period_end"), begin, add_quarters(begin, QUARTERS), low)
    pair, other = F.col("milestone_id").isNotNull(), F.col("r.milestone_id") != F.col("milestone_id")
    mine = F.array_compact(F.array("milestone_id"))
    some = lambda c: F.col(f"n_{c}") > 0
    rules = [
        (~known, "unknown_capacity_evidence_basis", None),
        (relative_capacity(F.col("unit"), F.col("metric")), "relative_capacity_not_forecastable", None),
        (needs & some("cancelled") & some("open"), "conflicting_production_milestone_statuses", "conflict"),
        (needs & some("cancelled"), "cancelled_production_milestone", "cancelled"),
        (needs & some("unsupported"), "unsupported_linked_production_milestone", "unsupported"),
        (needs & (F.col("n_active") > 1), "ambiguous_linked_production_milestones", "active"),
        (needs & ~pair & some("own_active"), "unlinked_production_milestone", "own_active"),
        (needs & ~pair & some("own_cancelled"), "cancelled_production_milestone", "own_cancelled"),
        (needs & ~pair, "missing_production_milestone", None),
        (period.isNotNull(), period, "mine"),
        (pair & F.col("r").isNull(), "capacity_event_scope_unreviewed", "mine"),
        (pair & (F.col("r.decision") != "accepted"), "capacity_event_scope_deferred", "mine"),
        (pair & other, "capacity_event_scope_mismatch", "both"),
        (~F.col("sound"), "forecast_input_support_unavailable_or_invalid", "mine"),
    ]
    why = first_of(((test, F.struct((reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit(named).cast("string").alias("named"))) for test, reason, named in rules))
    rows = rows.withColumn("why", why).withColumn("told", F.col("r.milestone_id"))
    rows = rows.select(*dict.fromkeys((by, "capacity_id", "entity_id")), "why", "milestone_id", "told").join(linked.drop("low"), by, "left").join(around, "entity_id", "left")
    lists = {c: F.col(c) for c in names if c != "open"} | {"conflict": F.array_sort(F.array_union("cancelled", "open")), "mine": mine, "both": F.array_sort(F.array("milestone_id", "told"))}
    related = first_of((F.col("why.named") == name, ids) for name, ids in lists.items())
    return rows.select("capacity_id", "entity_id", "why.reason", F.coalesce(related, none).alias("related"), F.when(F.col("why").isNull(), F.col("milestone_id")).alias("milestone_id"))
