"""Logs of revisions that name their predecessors: places by pointer jumping, faults, and the state restored at any head."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.plans.staging import Staging

#: Revisions of a chain that share a slot when states are restored.
SLOT = 64


def place(revisions: DataFrame, staging: Staging) -> DataFrame:
    """(id, genesis, depth) of every revision (id, previous) that leads back to one without predecessor.

    Every round doubles the steps that a revision looks back, so a log of n revisions takes log n rounds. What stands on a
    circle, or above one or above a missing predecessor, has no place.
    """
    known = staging.table(revisions.where("previous is null").select("id", F.col("id").alias("genesis"), F.lit(0).cast("long").alias("depth")), "known")
    left = staging.table(revisions.where("previous is not null").select("id", F.col("previous").alias("to"), F.lit(1).cast("long").alias("hops")), "open")
    while True:
        reached = known.select(F.col("id").alias("to"), "genesis", "depth")
        found = staging.table(left.join(reached, "to").select("id", "genesis", (F.col("hops") + F.col("depth")).alias("depth")), "found")
        if found.isEmpty():  # who stands nearer to a genesis is found first, so nobody else will be
            return known
        rest = left.join(found, "id", "left_anti")
        ahead = left.select(F.col("id").alias("to"), F.col("to").alias("further"), F.col("hops").alias("more"))
        known, left = known.unionByName(found), staging.table(rest.join(ahead, "to").select("id", F.col("further").alias("to"), (F.col("hops") + F.col("more")).alias("hops")), "open")


def faults(revisions: DataFrame, placed: DataFrame) -> DataFrame:
    """(id, fault) of revisions (chain, id, previous, clock, digest, previous_digest) that no log may hold.

    several_geneses, fork (all successors of one revision), missing_predecessor, no_genesis, other_chain, clock_not_advancing
    and link_differs (the digest that it states of its predecessor).
    """
    one = lambda rows, fault: rows.select("id", F.lit(fault).alias("fault"))
    before = revisions.select(F.col("id").alias("previous"), F.col("chain").alias("was_chain"), F.col("clock").alias("was_clock"), F.col("digest").alias("was_digest"))
    linked = revisions.where("previous is not null").join(before, "previous", "left")
    many = lambda rows, by: rows.join(rows.groupBy(by).agg(F.count("*").alias("m")).where("m > 1"), by)
    present = linked.where("was_clock is not null")
    out = [
        one(many(revisions.where("previous is null"), "chain"), "several_geneses"),
        one(many(revisions.where("previous is not null").select("id", "previous"), "previous"), "fork"),
        one(linked.join(revisions.select(F.col("id").alias("previous")), "previous", "left_anti"), "missing_predecessor"),
        one(revisions.join(placed, "id", "left_anti"), "no_genesis"),
        one(present.where("chain <> was_chain"), "other_chain"),
        one(present.where("clock <= was_clock"), "clock_not_advancing"),
        one(present.where("not (previous_digest <=> was_digest)"), "link_differs"),
    ]
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found.distinct()


def sound(revisions: DataFrame, broken: DataFrame) -> DataFrame:
    """The revisions of chains none of whose revisions has a fault."""
    return revisions.join(revisions.join(broken, "id", "left_semi").select("chain").distinct(), "chain", "left_anti")


def restore(changes: DataFrame, placed: DataFrame, heads: DataFrame) -> DataFrame:
    """(head, key, value): what stood once each of the heads (id) had been appended.

    changes: id, key, value, null where the key is withdrawn; one a key and revision. placed: the places of a log without
    forks. A change stands from its depth to the next one of its key; heads meet it in slots of depths.
    """
    spans = changes.join(placed, "id").select("genesis", "key", "value", "depth")
    spans = spans.withColumn("until", F.lead("depth").over(Window.partitionBy("genesis", "key").orderBy("depth"))).where("value is not null")
    asked = heads.join(placed, "id").select(F.col("id").alias("head"), "genesis", F.col("depth").alias("at"), F.floor(F.col("depth") / SLOT).alias("slot"))
    last = asked.groupBy("genesis").agg(F.max("at").alias("last"))
    end = F.least(F.coalesce(F.col("until") - 1, F.col("last")), F.col("last"))
    held = spans.join(last, "genesis").where(end >= F.col("depth")).withColumn("slot", F.explode(F.sequence(F.floor(F.col("depth") / SLOT), F.floor(end / SLOT))))
    met = held.join(asked, ["genesis", "slot"]).where("at >= depth and (until is null or at < until)")
    return met.select("head", "key", "value")
