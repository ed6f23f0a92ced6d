"""Writes as plans: insert-or-verify, correction chains, refreshes of slowly changing rows, and violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def insert_or_verify(stored: DataFrame, incoming: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, conflicts): an incoming row is new, equal to what is stored, or names the columns that differ.

    The key is one column or several; each of them must have a value.
    """
    others = [c for c in incoming.columns if c not in key]
    old = stored.select(*key, F.struct(*others).alias("__old"))
    both = incoming.join(old, list(key), "left")
    differing = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__old.{c}")), F.lit(c)) for c in others]))
    fresh = both.where("__old is null").select(incoming.columns)
    clash = both.where("__old is not null").select(*key, differing.alias("columns")).where(F.size("columns") > 0)
    return fresh, clash


def supersede(versions: DataFrame) -> DataFrame:
    """Correction chain: each version of a (series, valid_from) is superseded when the next is recorded."""
    chain = Window.partitionBy("entity_id", "predicate", "valid_from").orderBy("recorded_us", "claim_id")
    return versions.withColumn("superseded_us", F.lead("recorded_us").over(chain))


def refresh_plan(prior: DataFrame, snapshot: DataFrame, keys: tuple[str, ...] = ("entity_id", "predicate"), complete: bool = True) -> DataFrame:
    """(keys, action): insert, reuse, replace, or close; keys absent from a snapshot close only if it is complete."""
    a = prior.select(*keys, F.struct("value").alias("old"))
    b = snapshot.select(*keys, F.struct("value").alias("new"))
    both = a.join(b, list(keys), "full_outer")
    gone = F.lit("close" if complete else "keep")
    action = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), gone).when(F.col("old.value").eqNullSafe(F.col("new.value")), "reuse").otherwise("replace")
    return both.select(*keys, action.alias("action"))


def duplicate_open(versions: DataFrame) -> DataFrame:
    """(series, valid_from) with more than one open version; nulls of valid_from compare as equal."""
    return versions.where("superseded_us is null").groupBy("entity_id", "predicate", "valid_from").agg(F.count("*").alias("open_versions")).where("open_versions > 1")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Foreign keys without a parent, classed as differing in white space, in case, or unresolved; nothing is repaired."""
    keys = parent.select(F.col(pk).alias("k")).distinct()
    lost = child.join(keys, child[fk] == keys["k"], "left_anti").groupBy(F.col(fk).alias("fk")).agg(F.count("*").alias("rows"))
    trimmed = keys.select(F.trim("k").alias("t")).distinct().withColumn("by_space", F.lit(True))
    folded = keys.groupBy(F.lower(F.trim("k")).alias("l")).agg(F.count("*").alias("same"))
    out = lost.join(trimmed, F.trim("fk") == F.col("t"), "left").join(folded, F.lower(F.trim("fk")) == F.col("l"), "left")
    kind = F.when(F.col("by_space"), "whitespace_only").when(F.col("same") == 1, "case_only").otherwise("unresolved")
    return out.select("fk", "rows", kind.alias("kind"))


def clock_violations(claims: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges whose parent was recorded after its child."""
    c = claims.select(F.col("claim_id").alias("child"), F.col("recorded_us").alias("child_us"))
    p = claims.select(F.col("claim_id").alias("parent"), F.col("recorded_us").alias("parent_us"))
    return edges.join(c, "child").join(p, "parent").where("parent_us > child_us").select("child", "parent")


def immutable_violations(before: DataFrame, after: DataFrame, key: str, once: str) -> DataFrame:
    """Rows that a later snapshot changed or lost, but for `once`, which may go from null to a value."""
    same = [c for c in before.columns if c not in (key, once)]
    a = before.select(key, F.struct(*same).alias("a"), F.col(once).alias("a_once"))
    b = after.select(key, F.struct(*same).alias("b"), F.col(once).alias("b_once"))
    kept = F.col("a").eqNullSafe(F.col("b")) & (F.col("a_once").isNull() | F.col("a_once").eqNullSafe(F.col("b_once")))
    return a.join(b, key, "left").where(F.col("b").isNull() | ~kept).select(key)


def effects_visible(runs: DataFrame, effects: DataFrame, at: int) -> DataFrame:
    """Runs all of whose effects are recorded by the instant; runs without effects are visible."""
    late = effects.where(F.col("recorded_us").isNull() | (F.col("recorded_us") > at)).select("run_id").distinct()
    return runs.join(late, "run_id", "left_anti")


def source_refresh(prior: DataFrame, snapshot: DataFrame, accepted_us: int, day: str, keys: tuple[str, ...] = ("entity_id", "predicate"), complete: bool = True) -> DataFrame:
    """(keys, action, closure, error) of a later snapshot of a source against its open claims.

    prior: keys, value, valid_from, recorded_us; snapshot: keys, value. Equal values are reused. A changed value, and an
    absent key of a complete snapshot, closes the prior claim at `day`: by a closing version of its valid time, or by
    supersession alone where it began that very day. A prior claim that was not recorded before the acceptance, or that
    begins after the day, is an error; no claim is negative evidence.
    """
    a = prior.select(*keys, F.struct("value", "valid_from", "recorded_us").alias("old"))
    b = snapshot.select(*keys, F.struct("value").alias("new"))
    both = a.join(b, list(keys), "full_outer")
    absent = F.lit("retire" if complete else "keep")
    action = F.when(F.col("old").isNull(), "insert").when(F.col("new").isNull(), absent).when(F.col("old.value").eqNullSafe(F.col("new.value")), "reuse").otherwise("replace")
    at = F.lit(day).cast("date")
    closes = F.col("action").isin("retire", "replace")
    error = F.when(closes & (F.col("old.recorded_us") >= F.lit(accepted_us)), "not_later").when(closes & (F.col("old.valid_from") > at), "predates")
    kind = F.when(closes & F.col("error").isNull(), F.when(F.col("old.valid_from") == at, "supersede").otherwise("close_valid_time"))
    rows = both.withColumn("action", action).withColumn("error", error)
    return rows.select(*keys, "action", kind.alias("closure"), "error")


def chronology(runs: DataFrame) -> DataFrame:
    """(run_id, problem): succeeded runs of a source whose clocks fall behind those of a run accepted before.

    runs: run_id, source_id, accepted_us, retrieved_us, updated_us. Acceptances must rise; retrievals and source updates
    must not fall.
    """
    line = Window.partitionBy("source_id").orderBy("accepted_us", "run_id")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    seen = runs.withColumns({f"top_{c}": F.max(f"{c}_us").over(before) for c in ("accepted", "retrieved", "updated")})
    problem = F.array_compact(
        F.array(
            F.when(F.col("top_accepted") >= F.col("accepted_us"), "acceptance_order"),
            F.when(F.col("top_retrieved") > F.col("retrieved_us"), "retrieval_order"),
            F.when(F.col("top_updated") > F.col("updated_us"), "update_order"),
        )
    )
    return seen.select("run_id", F.explode(problem).alias("problem"))
