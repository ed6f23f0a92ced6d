"""Polling as plans: what is due, what a crash left behind, whether a report changed, and episodes of repeated alerts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.facilities import first_of


def poll_plan(targets: DataFrame, runs: DataFrame, intents: DataFrame, now: int, interval_us: int) -> DataFrame:
    """(target_id, status, due_us, unresolved): recovery_blocked, review_expired, not_due or due.

    targets: target_id, expires_us, blocked; runs: target_id, finished_us; intents: target_id, started_us, complete. A
    target is due `interval_us` after the latest clock of its runs and intents. unresolved: it is not due, and an
    intent without a completed capture has no run that finished since.
    """
    last = runs.groupBy("target_id").agg(F.max("finished_us").alias("run_us"))
    tried = intents.groupBy("target_id").agg(F.max("started_us").alias("intent_us"), F.max(F.when(~F.col("complete"), F.col("started_us"))).alias("open_us"))
    rows = targets.join(last, "target_id", "left").join(tried, "target_id", "left")
    due = F.greatest("run_us", "intent_us") + F.lit(interval_us)
    status = first_of([(F.coalesce("blocked", F.lit(False)), "recovery_blocked"), (F.col("expires_us") <= F.lit(now), "review_expired"), (due > F.lit(now), "not_due")], "due")
    hanging = F.col("open_us").isNotNull() & (F.col("run_us").isNull() | (F.col("run_us") < F.col("open_us")))
    return rows.select("target_id", status.alias("status"), due.alias("due_us"), ((status == "not_due") & F.coalesce(hanging, F.lit(False))).alias("unresolved"))


def reconcile(intents: DataFrame) -> DataFrame:
    """(intent_id, action) for every intent that a crash may have cut: interrupted_capture, recovered_import, recovery_blocked.

    intents: intent_id, captured (a manifest stands), sound (it matches the intent), imported, outcome (one is recorded).
    A sound capture is imported once more or gets its missing outcome; an intent that needs nothing has no row.
    """
    action = first_of(
        [
            (~F.col("captured") & ~F.col("outcome"), "interrupted_capture"),
            (F.col("captured") & ~F.col("sound"), "recovery_blocked"),
            (F.col("captured") & (~F.col("imported") | ~F.col("outcome")), "recovered_import"),
        ]
    )
    return intents.select("intent_id", action.alias("action")).where("action is not null")


#: An observation of a series in a packet, in the order of its log.
OBSERVED = "series_id long, sequence long, release_us long, prior_release_us long, prior_manifest string, before string, after string, signature string, packet string"
EPISODES = "series_id long, sequence long, episode string, is_new boolean, floor_us long"


class Alert(NamedTuple):
    """The first telling of an episode: its transition, release, value and base, and the clock it reaches back to."""

    episode: str
    signature: str
    release_us: int
    value: str
    base: str
    floor_us: int


#: All that must hold for a proposal `o` to tell the alert `a` of the standing value once more.
REPEATS = {
    "the transition is the alert's": lambda a, o: o.signature == a.signature,
    "no release since the alert had left its value": lambda a, o: o.before is None or o.before == a.value or o.prior_release_us < a.release_us,
    "it is newer than what stands, or older evidence on the alert's own base": lambda a, o: o.release_us > o.stood_us or (a.base is not None and o.prior_manifest == a.base and o.release_us > a.floor_us),
}


def reach(o) -> int:
    """How far back a new episode reaches: to its prior release, or to a value that stood differently in between."""
    between = o.stood_value is not None and o.stood_value != o.after and o.prior_release_us < o.stood_us < o.release_us
    return o.stood_us if between else o.prior_release_us


def episodes(observations: DataFrame) -> DataFrame:
    """(series_id, sequence, episode, is_new, floor_us) of every proposal: a repeated transition stays in its episode.

    observations: OBSERVED, signature null where nothing is proposed. What stands before an observation is, of those logged
    before it that state a value, the one of the latest release, of equal ones the last logged; late releases are compared by
    their own clocks. An observation stands under the alert that it tells, or, proposing nothing, under the alert of the
    value that it reaffirms. A proposal tells the alert of what stands if all of REPEATS hold, and begins one otherwise.
    """
    before = Window.partitionBy("series_id").orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)
    stood = F.max(F.when(F.col("after").isNotNull(), F.struct("release_us", "sequence", "after"))).over(before)
    names = [c.split()[0] for c in OBSERVED.split(", ")]
    logged = observations.select(*names, stood.alias("stood")).select(*names, F.col("stood.release_us").alias("stood_us"), F.col("stood.sequence").alias("stood_at"), F.col("stood.after").alias("stood_value"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        under: dict[tuple, Alert | None] = {}  # the alert of what stands, and of the observation just read
        for batch in batches:
            out = []
            for o in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                stands = (o.series_id, o.stood_at)
                alert = under.get(stands)
                if o.signature is None:
                    told = alert if o.after == o.stood_value else None
                else:
                    repeats = alert is not None and all(holds(alert, o) for holds in REPEATS.values())
                    told = alert if repeats else Alert(hashlib.sha256(f"{o.packet}|{o.signature}".encode()).hexdigest(), o.signature, o.release_us, o.after, o.prior_manifest, reach(o))
                    out.append((o.series_id, o.sequence, told.episode, not repeats, told.floor_us))
                under = {stands: alert, (o.series_id, o.sequence): told}
            yield pd.DataFrame(out, columns=[c.split()[0] for c in EPISODES.split(", ")])

    return logged.mapInPandas(run, EPISODES)


def report_signals(parts: DataFrame, changed_only: bool = False) -> DataFrame:
    """(tick, signal, changed) of every report: whether what it would make a reader act on differs from the report before.

    parts: tick, part, text: the reportable state alone (plan states, freshness and health of documents with their sorted
    versions, open reviews, problems), a row a statement; clocks and paths of a tick are none of it. The signal is a digest
    of the statements' digests in order, so equal states have equal signals in whatever order they were found.
    """
    own = F.sha2(F.concat_ws("|", "part", F.coalesce("text", F.lit(""))), 256)
    each = parts.select("tick", own.alias("d")).distinct()
    signal = each.groupBy("tick").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("signal"))
    before = F.lag("signal").over(Window.orderBy("tick"))  # a row a tick
    out = signal.withColumn("changed", ~before.eqNullSafe(F.col("signal")))
    return out.where("changed") if changed_only else out


def due_times(attempts: DataFrame, interval_us: int, upto_us: int) -> DataFrame:
    """(target_id, due_us): every instant up to `upto_us` at which a target fell due, no attempt having come in between.

    attempts: target_id, us. An attempt at the very instant is in time.
    """
    known = attempts.where(F.col("us") <= upto_us).select("target_id", "us").distinct()
    after = F.lead("us").over(Window.partitionBy("target_id").orderBy("us"))
    gaps = known.select("target_id", (F.col("us") + interval_us).alias("due_us"), after.alias("next_us"))
    return gaps.where((F.col("due_us") <= upto_us) & (F.col("next_us").isNull() | (F.col("next_us") > F.col("due_us")))).select("target_id", "due_us")
