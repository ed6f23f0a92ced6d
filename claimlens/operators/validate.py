"""Checks of a stored claim graph: each gives (check, id, related), empty when sound.

A store is a dict of tables: documents (document_id, source_id, retrieved_us), runs (run_id, source_id,
input_document_id, status, started_us, completed_us, parameters), run_documents (run_id, document_id, role), records
(record_id, run_id, document_id, observed_us, payload, record_sha256), entities (entity_id, kind, created_us, run_id),
series (series_id, entity_id, value_kind, created_us), versions (version_id, series_id, value_kind, value, value_sha256,
target_id, recorded_us, run_id), evidence (version_id, document_id, record_id), name_metadata and identifier_metadata
(version_id), resolution_runs, candidates, decisions and assignments. Every check is equi-joins and filters; a clock
that is null breaks the rule it is needed for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.facilities import any_of
from claimlens.functions.ids import canonical_json
from claimlens.plans.session import spread

Store = dict[str, DataFrame]


def _found(rows: DataFrame, check: str, ident: str, related: Column | None = None) -> DataFrame:
    none = F.lit(None) if related is None else related
    return rows.select(F.lit(check).alias("check"), F.col(ident).cast("string").alias("id"), none.cast("string").alias("related"))


def _named(table: DataFrame, prefix: str, *columns: str) -> DataFrame:
    return table.select(*[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def _hashed(table: DataFrame) -> DataFrame:
    """The table as the hashed side of a join by parts, for chains of joins to tables that grow.

    Small files of ids hold millions of rows: broadcast by the files' size, the tables of a chain would stand in every task
    together. By parts a task holds its share of one, and the other side is neither held nor sorted, however hot its keys.
    """
    return table.hint("shuffle_hash")


def later(a: str, b: str) -> Column:
    """Clock a is after clock b, or one of them is unknown."""
    return F.col(a).isNull() | F.col(b).isNull() | (F.col(a) > F.col(b))


def payload_hashes(store: Store) -> DataFrame:
    """Records whose payload is no JSON, or whose canonical form has another digest than the one stored."""
    form = store["records"].withColumn("form", canonical_json()("payload"))
    return _found(form.where(F.col("form").isNull() | (F.sha2("form", 256) != F.col("record_sha256"))), "payload_hash", "record_id")


def value_hashes(store: Store) -> DataFrame:
    """Versions whose value (canonical text) has another digest than the one stored."""
    return _found(store["versions"].where(~F.sha2("value", 256).eqNullSafe(F.col("value_sha256"))), "value_hash", "version_id")


def value_kinds(store: Store) -> DataFrame:
    """Versions whose kind is not their series'."""
    both = store["versions"].join(_hashed(spread(_named(store["series"], "s", "series_id", "value_kind"), "s_series_id")), F.col("series_id") == F.col("s_series_id"))
    return _found(both.where(F.col("value_kind") != F.col("s_value_kind")), "value_kind", "version_id", F.col("series_id"))


def unfinished_runs(store: Store) -> DataFrame:
    """Records, entities and versions that come from a run that did not succeed."""
    runs = store["runs"].where("status <> 'succeeded'").select("run_id")
    parts = (("records", "record_id"), ("entities", "entity_id"), ("versions", "version_id"))
    found = [_found(store[t].join(runs, "run_id"), f"unfinished_run_{t}", ident, F.col("run_id")) for t, ident in parts]
    return found[0].unionByName(found[1]).unionByName(found[2])


def late_evidence(store: Store) -> DataFrame:
    """Versions recorded before a document was retrieved, a record observed, or its run started that they rest on."""
    links = spread(store["evidence"], "version_id").join(spread(store["versions"].select("version_id", "recorded_us"), "version_id"), "version_id")
    docs = links.join(store["documents"].select("document_id", "retrieved_us"), "document_id")
    recs = links.where("record_id is not null").join(store["records"].select("record_id", "run_id", "observed_us"), "record_id")
    runs = recs.join(store["runs"].select("run_id", "started_us"), "run_id")
    return (
        _found(docs.where(later("retrieved_us", "recorded_us")), "late_document", "version_id", F.col("document_id"))
        .unionByName(_found(recs.where(later("observed_us", "recorded_us")), "late_record", "version_id", F.col("record_id")))
        .unionByName(_found(runs.where(later("started_us", "recorded_us")), "late_run", "version_id", F.col("record_id")))
    )


def before_subjects(store: Store) -> DataFrame:
    """Versions recorded before their series, their subject or the entity they point to was created."""
    own = store["versions"].join(_hashed(spread(_named(store["series"], "s", "series_id", "entity_id", "created_us"), "s_series_id")), F.col("series_id") == F.col("s_series_id"))
    born = _hashed(spread(_named(store["entities"], "e", "entity_id", "created_us"), "e_entity_id"))
    subject = own.join(born, F.col("s_entity_id") == F.col("e_entity_id"))
    target = store["versions"].join(born, F.col("target_id") == F.col("e_entity_id"))
    return (
        _found(own.where(later("s_created_us", "recorded_us")), "before_series", "version_id", F.col("series_id"))
        .unionByName(_found(subject.where(later("e_created_us", "recorded_us")), "before_subject", "version_id", F.col("e_entity_id")))
        .unionByName(_found(target.where(later("e_created_us", "recorded_us")), "before_target", "version_id", F.col("e_entity_id")))
    )


def source_mismatches(store: Store) -> DataFrame:
    """Runs, records and run documents that join a run of one source to a document of another."""
    docs = _named(store["documents"], "d", "document_id", "source_id")
    runs = store["runs"]
    primary = runs.join(docs, F.col("input_document_id") == F.col("d_document_id"))
    sourced = runs.select("run_id", "source_id")
    held = [store[t].join(sourced, "run_id").join(docs, F.col("document_id") == F.col("d_document_id")).where("source_id <> d_source_id") for t in ("records", "run_documents")]
    return (
        _found(primary.where("source_id <> d_source_id"), "source_of_run", "run_id", F.col("input_document_id"))
        .unionByName(_found(held[0], "source_of_record", "record_id", F.col("document_id")))
        .unionByName(_found(held[1], "source_of_run_document", "run_id", F.col("document_id")))
    )


#: Lists of documents that a run's parameters may declare.
DECLARED = ("index_document_ids", "detail_document_ids")


def ledger_gaps(store: Store) -> DataFrame:
    """Runs and records without the document links that they must have: primary, source_record, and one per declared id."""
    links, runs, records = store["run_documents"], store["runs"], store["records"]
    role = lambda r: links.where(F.col("role") == r).select("run_id", F.col("document_id").cast("string").alias("document_id")).distinct()
    primary = runs.where("input_document_id is not null").select("run_id", F.col("input_document_id").cast("string").alias("document_id")).join(role("primary"), ["run_id", "document_id"], "left_anti")
    kept = records.select("record_id", "run_id", F.col("document_id").cast("string").alias("document_id")).join(role("source_record"), ["run_id", "document_id"], "left_anti")
    out = _found(primary, "ledger_primary", "run_id", F.col("document_id")).unionByName(_found(kept, "ledger_record", "record_id", F.col("document_id")))
    shaped = runs.select("run_id", F.try_parse_json("parameters").alias("v"))
    sound = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    out = out.unionByName(_found(shaped.where(F.col("v").isNull() | ~sound), "ledger_parameters", "run_id"))
    for name in DECLARED:
        given = shaped.where(sound).select("run_id", F.try_variant_get("v", f"$.{name}", "variant").alias("x"), F.try_variant_get("v", f"$.{name}", "array<string>").alias("ids"))
        given = given.where(F.col("x").isNotNull() & (F.schema_of_variant("x") != "VOID"))
        listed = F.schema_of_variant("x").isin("ARRAY<STRING>", "ARRAY<VOID>") & F.forall("ids", lambda i: i.isNotNull() & (i != ""))
        wrong = given.where(~F.coalesce(listed, F.lit(False)))
        lost = given.where(listed).select("run_id", F.explode("ids").alias("document_id")).join(role(f"parameter:{name}"), ["run_id", "document_id"], "left_anti")
        out = out.unionByName(_found(wrong, f"ledger_{name}_list", "run_id")).unionByName(_found(lost, f"ledger_{name}", "run_id", F.col("document_id")))
    return out


def metadata_types(store: Store) -> DataFrame:
    """Name and identifier metadata that do not annotate a text of an organization, or annotate one version twice."""
    subject = store["versions"].join(_named(store["series"], "s", "series_id", "entity_id"), F.col("series_id") == F.col("s_series_id"), "left").join(_named(store["entities"], "e", "entity_id", "kind"), F.col("s_entity_id") == F.col("e_entity_id"), "left")
    about = spread(subject.select("version_id", "value_kind", "e_kind"), "version_id")
    tables = {"name": "name_metadata", "identifier": "identifier_metadata"}
    out = None
    for (label, table), other in zip(tables.items(), reversed(tables.values()), strict=True):
        twice = spread(store[other].select("version_id", F.lit(True).alias("twice")), "version_id").distinct()
        rows = spread(store[table].select("version_id"), "version_id").join(about, "version_id", "left").join(twice, "version_id", "left")
        bad = ~F.col("value_kind").eqNullSafe(F.lit("text")) | ~F.col("e_kind").eqNullSafe(F.lit("organization")) | F.col("twice").isNotNull()
        found = _found(rows.where(bad), f"metadata_{label}", "version_id")
        out = found if out is None else out.unionByName(found)
    return out


def resolution_clocks(store: Store) -> DataFrame:
    """Resolution runs whose status, clocks and error do not go together, and their inputs that were not complete before."""
    status, done, error = F.col("status"), F.col("completed_us").isNotNull(), F.col("error")
    wrong = any_of(
        [
            F.col("started_us").isNull(),
            (status == "running") & (done | error.isNotNull()),
            (status == "succeeded") & (~done | error.isNotNull()),
            (status == "failed") & (~done | (F.trim(F.coalesce(error, F.lit(""))) == "")),
            done & (F.col("completed_us") <= F.col("started_us")),
        ]
    )
    found = _found(store["resolution_runs"].where(wrong), "resolution_run", "resolution_id")
    begun = _hashed(spread(store["resolution_runs"].select("resolution_id", "started_us"), "resolution_id"))
    used = spread(store["resolution_inputs"], "resolution_id").join(begun, "resolution_id").join(_named(store["runs"], "r", "run_id", "status", "completed_us"), F.col("run_id") == F.col("r_run_id"))
    early = used.where((F.col("r_status") != "succeeded") | later("r_completed_us", "started_us"))
    return found.unionByName(_found(early, "resolution_input", "resolution_id", F.col("run_id")))


KINDS = ("organization", "facility")


def resolution_lineage(store: Store) -> DataFrame:
    """Candidates, decisions and assignments whose kinds, ranks, ids or clocks break their lineage."""
    runs = _named(store["resolution_runs"], "r", "resolution_id", "status", "started_us", "completed_us")
    records = _named(store["records"], "x", "record_id", "observed_us", "run_id")
    seen, other = _named(store["entities"], "o", "entity_id", "kind", "created_us"), _named(store["entities"], "c", "entity_id", "kind", "created_us")
    inputs = store["resolution_inputs"].select(F.col("resolution_id").alias("i_resolution_id"), F.col("run_id").alias("i_run_id")).distinct()
    c = store["candidates"].join(_hashed(runs), F.col("resolution_id") == F.col("r_resolution_id")).join(_hashed(records), F.col("record_id") == F.col("x_record_id"))
    c = c.join(_hashed(seen), F.col("observed_id") == F.col("o_entity_id")).join(_hashed(other), F.col("proposed_id") == F.col("c_entity_id"))
    c = c.join(_hashed(inputs), (F.col("resolution_id") == F.col("i_resolution_id")) & (F.col("x_run_id") == F.col("i_run_id")), "left")
    bad = any_of(
        [
            ~F.col("o_kind").isin(*KINDS),
            F.col("o_kind") != F.col("c_kind"),
            F.col("observed_id") == F.col("proposed_id"),
            F.col("rank") < 1,
            later("r_started_us", "created_us"),
            F.coalesce(F.col("created_us") > F.col("r_completed_us"), F.lit(False)),
            later("x_observed_us", "created_us"),
            F.col("x_observed_us") > F.col("r_started_us"),
            later("o_created_us", "r_started_us"),
            later("c_created_us", "r_started_us"),
            F.col("i_run_id").isNull(),
        ]
    )
    found = _found(c.where(F.coalesce(bad, F.lit(True))), "candidate", "candidate_id")
    of = _named(store["candidates"], "k", "candidate_id", "resolution_id", "record_id", "observed_id", "proposed_id", "created_us")
    of = spread(of, "k_candidate_id")
    d = spread(store["decisions"], "candidate_id").join(of, F.col("candidate_id") == F.col("k_candidate_id")).join(runs, F.col("k_resolution_id") == F.col("r_resolution_id"))
    early = (F.col("r_status") != "succeeded") | later("k_created_us", "decided_us") | (F.col("decided_us") < F.col("r_completed_us"))
    found = found.unionByName(_found(d.where(F.coalesce(early, F.lit(True))), "decision", "decision_id"))
    made = spread(_named(store["decisions"], "d", "decision_id", "candidate_id", "outcome", "decided_us"), "d_decision_id")
    a = spread(store["assignments"], "decision_id").join(made, F.col("decision_id") == F.col("d_decision_id")).join(of, F.col("d_candidate_id") == F.col("k_candidate_id"))
    wrong = any_of(
        [
            F.col("d_outcome") != "match",
            F.col("k_record_id") != F.col("record_id"),
            F.col("k_observed_id") != F.col("observed_id"),
            F.col("k_proposed_id") != F.col("canonical_id"),
            F.col("valid_from").isNull(),
            F.coalesce(F.col("valid_to") <= F.col("valid_from"), F.lit(False)),
            later("d_decided_us", "recorded_us"),
            F.coalesce(F.col("superseded_us") <= F.col("recorded_us"), F.lit(False)),
        ]
    )
    return found.unionByName(_found(a.where(F.coalesce(wrong, F.lit(True))), "assignment", "assignment_id"))


CHECKS = {
    "payload_hashes": payload_hashes,
    "value_hashes": value_hashes,
    "value_kinds": value_kinds,
    "unfinished_runs": unfinished_runs,
    "late_evidence": late_evidence,
    "before_subjects": before_subjects,
    "source_mismatches": source_mismatches,
    "ledger_gaps": ledger_gaps,
    "metadata_types": metadata_types,
    "resolution_clocks": resolution_clocks,
    "resolution_lineage": resolution_lineage,
}


def summary(store: Store) -> DataFrame:
    """(check, violations) of every check that found any."""
    out = None
    for check in CHECKS.values():
        found = check(store)
        out = found if out is None else out.unionByName(found)
    return out.groupBy("check").agg(F.count("*").alias("violations"))
