"""Guarded admission of claim versions, as a plan: what is inserted, what it supersedes, what is refused and why.

Incoming versions meet the store (see claimlens.operators.validate) in equi-joins. A version is refused for every rule
it breaks; one whose id is stored is a repeat if nothing differs, else a conflict that names the columns. Versions of
one batch that share (series, valid_from) follow each other by clock, as if they came one after another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.operators.validate import Store, later

#: Columns that an admitted version never changes.
IMMUTABLE = ("series_id", "value_kind", "value_sha256", "valid_from", "valid_to", "recorded_us")


def _reasons(rows: DataFrame, *tests: tuple) -> DataFrame:
    """(version_id, reason) of every test that holds."""
    broken = F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in tests]))
    return rows.select("version_id", F.explode(broken).alias("reason")).distinct()


def refusals(incoming: DataFrame, evidence: DataFrame, dependencies: DataFrame, store: Store) -> DataFrame:
    """(version_id, reason) of incoming versions: lineage, clocks, kinds and targets; one row a reason."""
    clock = incoming.select("version_id", "recorded_us")
    lined = evidence.select("version_id").unionByName(dependencies.select("version_id")).distinct()
    found = [incoming.join(lined, "version_id", "left_anti").select("version_id", F.lit("no_lineage").alias("reason"))]
    docs = evidence.join(clock, "version_id").join(store["documents"].select("document_id", "retrieved_us", F.lit(True).alias("has")), "document_id", "left")
    found.append(_reasons(docs, (F.col("has").isNull(), "unknown_document"), (F.col("has") & later("retrieved_us", "recorded_us"), "late_document")))
    kept = store["records"].join(store["runs"].select("run_id", "started_us"), "run_id").select("record_id", F.col("document_id").alias("of_document"), "observed_us", "started_us")
    recs = evidence.where("record_id is not null").join(clock, "version_id").join(kept, "record_id", "left")
    same = F.coalesce(F.col("of_document") == F.col("document_id"), F.lit(False))
    found.append(_reasons(recs, (~same, "unknown_record"), (same & later("observed_us", "recorded_us"), "late_record"), (same & later("started_us", "recorded_us"), "late_run")))
    parents = store["versions"].select(F.col("version_id").alias("parent_id"), F.col("recorded_us").alias("parent_us"), F.lit(True).alias("has"))
    deps = dependencies.join(clock, "version_id").join(parents, "parent_id", "left")
    own = F.col("parent_id") == F.col("version_id")
    found.append(_reasons(deps, (own, "self_dependency"), (~own & F.col("has").isNull(), "unknown_parent"), (~own & F.col("has") & later("parent_us", "recorded_us"), "late_parent")))
    series = store["series"].select("series_id", F.col("value_kind").alias("s_kind"), F.col("created_us").alias("s_us"), "entity_id")
    born = store["entities"].select("entity_id", F.col("created_us").alias("e_us"))
    subject = incoming.join(series.join(born, "entity_id", "left"), "series_id", "left")
    has = F.col("s_kind").isNotNull()
    found.append(_reasons(subject, (~has, "unknown_series"), (has & later("s_us", "recorded_us"), "late_series"), (has & later("e_us", "recorded_us"), "late_subject"), (has & (F.col("s_kind") != F.col("value_kind")), "other_kind")))
    target = incoming.where("target_id is not null").join(born.select(F.col("entity_id").alias("target_id"), "e_us", F.lit(True).alias("has")), "target_id", "left")
    found.append(_reasons(target, (F.col("has").isNull(), "unknown_target"), (F.col("has") & later("e_us", "recorded_us"), "late_target")))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.distinct()


def admit(incoming: DataFrame, evidence: DataFrame, dependencies: DataFrame, store: Store) -> DataFrame:
    """(version_id, action, detail, superseded_us) for incoming versions and the stored ones that they supersede.

    action: insert (superseded_us: by a later one of the batch), supersede (a stored version), repeat, conflict (detail:
    the columns that differ), refuse (detail: the reasons). A correction that is not later than an open version of its
    (series, valid_from) is out of order.
    """
    stored = store["versions"]
    old = stored.select("version_id", F.struct(*IMMUTABLE).alias("old"))
    both = incoming.join(old, "version_id", "left")
    differing = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"old.{c}")), F.lit(c)) for c in IMMUTABLE]))
    known = both.where("old is not null").select("version_id", F.when(F.size(differing) > 0, "conflict").otherwise("repeat").alias("action"), F.array_join(differing, ",").alias("detail"), F.lit(None).cast("long").alias("superseded_us"))
    fresh = both.where("old is null").drop("old")
    key = ["series_id", "valid_from"]
    opened = stored.where("superseded_us is null").groupBy(*key).agg(F.max("recorded_us").alias("open_us"))
    slot = lambda df: df.select(F.col("series_id").alias("k_series"), F.col("valid_from").alias("k_from"), *[c for c in df.columns if c not in key])
    meets = (F.col("series_id") == F.col("k_series")) & F.col("valid_from").eqNullSafe(F.col("k_from"))
    behind = fresh.join(slot(opened), meets).where("open_us >= recorded_us").select("version_id", F.lit("out_of_order").alias("reason"))
    first = refusals(fresh, evidence.join(fresh.select("version_id"), "version_id", "left_semi"), dependencies.join(fresh.select("version_id"), "version_id", "left_semi"), store).unionByName(behind)
    sound = fresh.join(first.select("version_id").distinct(), "version_id", "left_anti")
    line = Window.partitionBy(*key).orderBy("recorded_us", "version_id")
    chained = sound.withColumn("tied", F.coalesce(F.lag("recorded_us").over(line) == F.col("recorded_us"), F.lit(False)))
    tied = chained.where("tied").select("version_id", F.lit("out_of_order").alias("reason"))
    taken = chained.where("not tied").withColumn("superseded_us", F.lead("recorded_us").over(line))
    blank = F.lit("")
    inserts = taken.select("version_id", F.lit("insert").alias("action"), blank.alias("detail"), "superseded_us")
    heads = taken.groupBy(*key).agg(F.min("recorded_us").alias("next_us"))
    closed = stored.where("superseded_us is null").join(slot(heads), meets).where("recorded_us < next_us").select("version_id", F.lit("supersede").alias("action"), blank.alias("detail"), F.col("next_us").alias("superseded_us"))
    refused = first.unionByName(tied).groupBy("version_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("detail"))  # a version's own reasons
    refused = refused.select("version_id", F.lit("refuse").alias("action"), "detail", F.lit(None).cast("long").alias("superseded_us"))
    return known.unionByName(inserts).unionByName(closed).unionByName(refused)
