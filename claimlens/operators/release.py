"""Release views: families with reassignments, resolution runs and assignments as of an instant, linkage, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.views import masked


def families(documents: DataFrame, runs: DataFrame, overrides: DataFrame, at: int) -> DataFrame:
    """Documents accepted by the instant, rolled up by family; an override moves a source to another family.

    documents: document_id, source, family, retrieved_us; runs: document_id, started_us; overrides: source, new_family.
    First and last are extremes of (clock, id), combined before the shuffle.
    """
    accepted = runs.where(F.col("started_us") <= at).groupBy("document_id").agg(F.min("started_us").alias("accepted_us"))
    moved = documents.join(accepted, "document_id").join(overrides, "source", "left").withColumn("family", F.coalesce("new_family", "family"))
    edge = lambda f, c: f(F.struct(c, "document_id"))[c]
    return moved.groupBy("family").agg(
        F.countDistinct("source").alias("sources"),
        F.count("*").alias("documents"),
        edge(F.min, "retrieved_us").alias("first_retrieved_us"),
        edge(F.max, "retrieved_us").alias("last_retrieved_us"),
        edge(F.min, "accepted_us").alias("first_accepted_us"),
        edge(F.max, "accepted_us").alias("last_accepted_us"),
    )


def current_family(assignments: DataFrame, at: int) -> DataFrame:
    """(source, new_family): the latest reviewed assignment of each source by the instant."""
    return assignments.where(F.col("recorded_us") <= at).groupBy("source").agg(F.max_by("new_family", F.struct("recorded_us", "new_family")).alias("new_family"))


def chain_breaks(assignments: DataFrame) -> DataFrame:
    """Assignments whose predecessor is not the one that stood: two heads, a fork, or an unknown predecessor."""
    prior = assignments.select(F.col("id").alias("supersedes_id"), F.col("source").alias("prior_source"), F.col("recorded_us").alias("prior_us"))
    both = assignments.join(prior, "supersedes_id", "left")
    uses = assignments.where("supersedes_id is not null").groupBy("supersedes_id").agg(F.count("*").alias("uses"))
    heads = assignments.where("supersedes_id is null").groupBy("source").agg(F.count("*").alias("heads"))
    out = both.join(uses, "supersedes_id", "left").join(heads, "source", "left")
    problem = F.when(F.col("supersedes_id").isNull(), F.when(F.col("heads") > 1, "two_heads")).when(F.col("prior_us").isNull(), "unknown").when(F.col("prior_source") != F.col("source"), "other_source").when(F.col("uses") > 1, "fork").when(F.col("prior_us") > F.col("recorded_us"), "clock")
    return out.select("id", problem.alias("problem")).where("problem is not null")


def runs_with_lists(runs: DataFrame, inputs: DataFrame, scopes: DataFrame, at: int) -> DataFrame:
    """Runs completed by the instant with two lists gathered apart, empty where there is none."""
    a = inputs.groupBy("run_id").agg(F.array_sort(F.collect_set("input")).alias("inputs"))
    b = scopes.groupBy("run_id").agg(F.array_sort(F.collect_set("scope")).alias("scopes"))
    none = F.array().cast("array<string>")
    out = runs.where(F.col("completed_us") <= at).join(a, "run_id", "left").join(b, "run_id", "left")
    return out.withColumns({"inputs": F.coalesce("inputs", none), "scopes": F.coalesce("scopes", none)})


def assignment_history(assignments: DataFrame, decisions: DataFrame, on: str, at: int) -> DataFrame:
    """Assignments that had begun and were recorded and decided; later supersession masked; ended ones stay."""
    known = decisions.where(F.col("decided_us") <= at).select("decision_id")
    rows = assignments.where((F.col("valid_from") <= F.lit(on).cast("date")) & (F.col("recorded_us") <= at))
    return rows.join(known, "decision_id", "left_semi").withColumn("superseded_us", masked(at))


def latest_run(runs: DataFrame, accepted: Column, order: list[str]) -> DataFrame:
    """The last run for which a predicate holds, by the given clocks and id."""
    return runs.where(accepted).agg(F.max_by(F.struct(*runs.columns), F.struct(*order)).alias("r")).where("r is not null").select("r.*")


def linked(capacities: DataFrame, milestones: DataFrame, edges: DataFrame, documents: DataFrame) -> DataFrame:
    """Pairs (capacity_id, milestone_id, link) of one entity: by lineage, else by a shared transitive document.

    capacities and milestones: id, entity_id; edges: child, parent; documents: id, document_id (transitive). Three
    equi-joins are united, instead of one join on alternatives; lineage outranks documents.
    """
    c, m = capacities.select(F.col("id").alias("capacity_id"), F.col("entity_id").alias("ce")), milestones.select(F.col("id").alias("milestone_id"), F.col("entity_id").alias("me"))
    e = edges.select("child", "parent").distinct()
    down = c.join(e, F.col("capacity_id") == F.col("child")).select("capacity_id", "ce", "parent")
    up = m.join(e, F.col("milestone_id") == F.col("child")).select("milestone_id", "me", "parent")
    direct = down.join(m, F.col("parent") == F.col("milestone_id")).select("capacity_id", "milestone_id", "ce", "me")
    reverse = up.join(c, F.col("parent") == F.col("capacity_id")).select("capacity_id", "milestone_id", "ce", "me")
    common = down.join(up, "parent").select("capacity_id", "milestone_id", "ce", "me")
    shared = c.join(documents.withColumnRenamed("id", "capacity_id"), "capacity_id").join(m.join(documents.withColumnRenamed("id", "milestone_id"), "milestone_id"), "document_id").where("ce = me").select("capacity_id", "milestone_id", "ce", "me")
    rank = lambda df, r: df.withColumn("rank", F.lit(r))
    every = rank(direct, 0).unionByName(rank(reverse, 0)).unionByName(rank(common, 0)).unionByName(rank(shared, 1)).where("ce = me")
    best = every.groupBy("capacity_id", "milestone_id").agg(F.min("rank").alias("rank"))
    return best.select("capacity_id", "milestone_id", F.when(F.col("rank") == 0, "claim_lineage").otherwise("shared_document").alias("link"))


def namespaces(rows: DataFrame, key: str, prefixes: dict[str, str]) -> DataFrame:
    """Counts and shares of keys by the namespace their prefix belongs to; the longest prefix wins."""
    name = None
    for p in sorted(prefixes, key=len, reverse=True):
        name = F.when(F.col(key).startswith(p), prefixes[p]) if name is None else name.when(F.col(key).startswith(p), prefixes[p])
    got = rows.groupBy(F.coalesce(name, F.lit("other")).alias("namespace")).agg(F.count("*").alias("n"))
    total = rows.agg(F.count("*").alias("total"))
    return got.join(F.broadcast(total)).select("namespace", "n", F.round(F.try_divide("n", "total"), 6).alias("share"))  # total is one row


def source_pivot(claims: DataFrame, predicates: list[str]) -> DataFrame:
    """One row an entity with a column a predicate; a predicate with two values is named in `conflicts`."""
    sets = [F.collect_set(F.when(F.col("predicate") == p, F.col("value"))).alias(p) for p in predicates]
    got = claims.groupBy("entity_id").agg(*sets)
    clash = F.array_compact(F.array(*[F.when(F.size(p) > 1, F.lit(p)) for p in predicates]))
    return got.select("entity_id", *[F.when(F.size(p) == 1, F.col(p)[0]).alias(p) for p in predicates], clash.alias("conflicts"))


def propagated(members: DataFrame, statements: DataFrame) -> DataFrame:
    """Statements of any member of a program, given to every member of it, with the member that made them."""
    own = statements.join(members, "entity_id").select("program", F.col("entity_id").alias("origin"), "statement").distinct()
    return members.join(own, "program").select("entity_id", "program", "origin", "statement")


def disjoint_twins(rows: DataFrame, name: str, number: str) -> DataFrame:
    """Rows that share a name without their numbers agreeing: (name, ids), ids sorted."""
    g = rows.groupBy(name).agg(F.countDistinct(number).alias("numbers"), F.array_sort(F.collect_set("id")).alias("ids"))
    return g.where((F.col("numbers") > 1) & (F.size("ids") > 1)).select(name, "ids")


def candidates_as_of(store: dict[str, DataFrame], at: int) -> DataFrame:
    """Resolution candidates of runs that had ended, made by the instant, with the kinds they join and the scope they decide."""
    ended = store["resolution_runs"].where(F.col("status").isin("succeeded", "failed") & (F.col("completed_us") <= at)).select("resolution_id", F.col("started_us").alias("run_started_us"))
    kind = lambda name, prefix: store["entities"].select(F.col("entity_id").alias(name), F.col("kind").alias(f"{prefix}_kind"))
    rows = store["candidates"].where(F.col("created_us") <= at).join(ended, "resolution_id").join(store["records"].select("record_id"), "record_id", "left_semi")
    rows = rows.join(kind("observed_id", "observed"), "observed_id").join(kind("proposed_id", "proposed"), "proposed_id")
    return rows.withColumn("identity_scope", F.concat("observed_kind", F.lit("_identity")))


def decisions_as_of(store: dict[str, DataFrame], at: int) -> DataFrame:
    """Decisions taken by the instant on candidates of runs that had succeeded."""
    good = store["resolution_runs"].where((F.col("status") == "succeeded") & (F.col("completed_us") <= at)).select("resolution_id")
    kind = store["entities"].select(F.col("entity_id").alias("observed_id"), F.col("kind").alias("observed_kind"))
    of = store["candidates"].select("candidate_id", "resolution_id", "observed_id").join(good, "resolution_id", "left_semi").join(kind, "observed_id")
    return store["decisions"].where(F.col("decided_us") <= at).join(of, "candidate_id").withColumn("identity_scope", F.concat("observed_kind", F.lit("_identity")))


def evidence_index(claims: DataFrame, evidence: DataFrame, per_row: int = 1000) -> DataFrame:
    """(document_id, part, claim_ids): the inverted index from documents to claims, in rows of `per_row` ids at most.

    A document that very many claims rest on has several rows, so none is gathered whole.
    """
    pairs = evidence.join(claims.select("claim_id"), "claim_id", "left_semi").select("document_id", "claim_id").distinct()
    sizes = pairs.groupBy("document_id").agg(F.count("*").alias("n"))
    dealt = pairs.join(sizes, "document_id").withColumn("part", F.pmod(F.xxhash64("claim_id"), F.ceil(F.col("n") / (per_row / 2))))
    return dealt.groupBy("document_id", "part").agg(F.array_sort(F.collect_list("claim_id")).alias("claim_ids"))


def dossiers(claims: DataFrame, reach: DataFrame, evidence: DataFrame) -> DataFrame:
    """One row an entity: its claims and kinds, the claims that they rest on (reach: root, node), and the documents behind."""
    own = claims.groupBy("entity_id").agg(F.count("*").alias("n_claims"), F.countDistinct("claim_kind").alias("n_kinds"), F.max("recorded_us").alias("last_us"))
    lined = claims.select("entity_id", "claim_id").join(reach, F.col("claim_id") == F.col("root")).select("entity_id", "node").distinct()
    behind = lined.join(evidence.select(F.col("claim_id").alias("node"), "document_id").distinct(), "node", "left")
    found = behind.groupBy("entity_id").agg(F.countDistinct("node").alias("n_lineage"), F.countDistinct("document_id").alias("n_documents"))
    return own.join(found, "entity_id")
