"""The benchmark tables seen as a claim store: claims, edges, documents, capacities, milestones, releases and places."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.functions.clocks import micros
from claimlens.plans.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """claim_versions: one per event, each superseded by the next of its (entity, predicate, valid_from)."""
    e = table(spark, sf_dir, "events")
    stated = F.col("event_id") % 8 == 0
    day = F.when(~stated, F.to_date("ts"))
    rows = e.select(
        F.col("event_id").alias("claim_id"),
        F.col("user_id").alias("entity_id"),
        F.col("event_type").alias("predicate"),
        day.alias("valid_from"),
        F.when(~stated & (F.col("event_id") % 5 == 0), F.date_add(F.to_date("ts"), 7)).alias("valid_to"),
        micros(F.col("ts")).alias("recorded_us"),
        F.when(stated, "source_statement").when(F.col("event_id") % 3 == 0, "derived_estimate").otherwise("direct_observation").alias("claim_kind"),
        "value",
        "props",
    )
    chain = Window.partitionBy("entity_id", "predicate", "valid_from").orderBy("recorded_us", "claim_id")
    return rows.withColumn("superseded_us", F.lead("recorded_us").over(chain))


def dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """claim_dependencies: child to its half and its third, a graph with diamonds and no circle."""
    e = table(spark, sf_dir, "events").where("event_id > 0")
    return e.select(F.col("event_id").alias("child"), F.explode(F.array_distinct(F.array(F.expr("event_id div 2"), F.expr("event_id div 3")))).alias("parent"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("document_id"), F.sha2("text", 256).alias("content_sha256"), "source", F.col("lang").alias("family"))


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """claim_evidence: each claim to one document, in a role."""
    n = table(spark, sf_dir, "documents").agg(F.count("*").alias("n"))
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("claim_id")).join(F.broadcast(n))  # n is one row
    return e.select("claim_id", (F.col("claim_id") % F.col("n")).alias("document_id"), F.when(F.col("claim_id") % 3 < 2, "support").otherwise("context").alias("role"))


def capacities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """capacity_values: the range of quantities of each part; the basis goes by the part's size."""
    q = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.min("l_quantity").alias("low"), F.round(F.avg("l_quantity"), 6).alias("base"), F.max("l_quantity").alias("high"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("metric"), (F.col("p_size") % 5).alias("basis_rank"), "p_brand")
    return q.join(p, "l_partkey").withColumnRenamed("l_partkey", "capacity_id").withColumn("unit", F.lit("units/month"))


def milestones(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "expected").otherwise("delayed")
    return o.select(F.col("o_orderkey").alias("milestone_id"), F.col("o_custkey").alias("entity_id"), F.date_sub(day, 30).alias("low"), day.alias("base"), F.date_add(day, 60).alias("high"), status.alias("status"))


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    return o.select(F.col("o_orderkey").alias("assignment_id"), F.col("o_custkey").alias("observed_id"), day.alias("valid_from"), F.when(F.col("o_orderkey") % 4 != 0, F.date_add(day, 45)).alias("valid_to"), micros(F.col("o_orderdate")).alias("recorded_us"))


def releases(spark: SparkSession, sf_dir: str, cut: str) -> tuple[DataFrame, DataFrame]:
    """The latest value of every series before the cut, and overall."""
    e = table(spark, sf_dir, "events").withColumn("us", micros(F.col("ts")))
    latest = lambda df: df.groupBy(F.col("user_id").alias("entity_id"), F.col("event_type").alias("predicate")).agg(F.max_by("value", F.struct("us", "event_id")).alias("value"))
    return latest(e.where(F.col("ts") < F.lit(cut).cast("timestamp_ntz"))), latest(e)


def store(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A whole store with planted faults, by arithmetic on keys (see claimlens.operators.validate for its tables)."""
    t = lambda name: table(spark, sf_dir, name)
    e = F.expr
    rows = lambda name, **columns: t(name).select(*[e(x).alias(c) for c, x in columns.items()])
    runs = rows(
        "supplier",
        run_id="s_suppkey",
        source_id="(s_suppkey + if(s_suppkey % 11 = 0, 1, 0)) % 7",
        input_document_id="s_suppkey",
        status="if(s_suppkey % 13 = 4, 'failed', 'succeeded')",
        started_us="s_suppkey * 10 + 5",
        completed_us="s_suppkey * 10 + 8",
        parameters="""case when s_suppkey % 17 = 2 then '[1]' when s_suppkey % 19 = 3 then '{' when s_suppkey % 5 = 0 then concat('{"index_document_ids":["', s_suppkey, '"],"detail_document_ids":"x"}')
          when s_suppkey % 5 = 1 then concat('{"index_document_ids":["', s_suppkey, '","', s_suppkey + 1, '"],"detail_document_ids":null}') when s_suppkey % 5 = 2 then '{"detail_document_ids":["7",""]}' else '{}' end""",
    )
    records = rows(
        "customer",
        record_id="c_custkey",
        run_id="c_custkey % 10 + 1",
        document_id="c_custkey % 10 + 1 + if(c_custkey % 9 = 0, 1, 0)",
        observed_us="(c_custkey % 10 + 1) * 10 + 6",
        payload="""if(c_custkey % 41 = 0, '{"a":1,"a":2}', concat('{"b": ', c_custkey, ', "a":"x"}'))""",
        record_sha256="""sha2(concat('{"a":"x","b":', c_custkey + if(c_custkey % 31 = 0, 1, 0), '}'), 256)""",
    )
    links = runs.where("run_id % 7 <> 3").select("run_id", F.col("input_document_id").alias("document_id"), F.lit("primary").alias("role"))
    links = links.unionByName(runs.where("run_id % 5 < 2").select("run_id", F.col("input_document_id").alias("document_id"), F.lit("parameter:index_document_ids").alias("role")))
    links = links.unionByName(records.where("record_id % 10 <> 4").select("run_id", "document_id", F.lit("source_record").alias("role")).distinct())
    orders = t("orders").withColumn("k", F.col("o_orderkey"))
    versions = orders.select(
        F.col("k").alias("version_id"),
        e("k % 150 + 1").alias("series_id"),
        e("if(k % 37 = 0, 'number', element_at(array('number', 'text', 'relation'), cast((k % 150 + 1) % 3 + 1 as int)))").alias("value_kind"),
        e("""concat('{"kind":"', k % 3, '","value":', k, '}')""").alias("value"),
        e("""sha2(concat('{"kind":"', k % 3, '","value":', k + if(k % 43 = 0, 1, 0), '}'), 256)""").alias("value_sha256"),
        e("if((k % 150 + 1) % 3 = 2, k % 100 + 2, null)").alias("target_id"),
        e("60 + k % 100").alias("recorded_us"),
        e("if(k % 4 = 0, k % 10 + 1, null)").alias("run_id"),
    )
    evidence = orders.select(F.col("k").alias("version_id"), e("k % 10 + 1").alias("document_id"), e("if(k % 6 = 0, null, k % 100 + 1)").alias("record_id"))
    candidates = orders.select(F.col("k").alias("candidate_id"), F.col("o_custkey").alias("resolution_id"), e("k % 100 + 1").alias("record_id"), e("k % 90 + 1").alias("observed_id"), e("(k * 2 + k % 3) % 90 + 1").alias("proposed_id"), e("k % 5").alias("rank"), e("o_custkey + 90 + k % 15").alias("created_us"))
    decisions = candidates.select(F.col("candidate_id").alias("decision_id"), "candidate_id", e("if(candidate_id % 8 = 0, 'no_match', 'match')").alias("outcome"), e("created_us + candidate_id % 12 - 1").alias("decided_us"))
    assigned = candidates.where("candidate_id % 3 = 0")
    return {
        "documents": rows("documents", document_id="doc_id", source_id="doc_id % 7", retrieved_us="doc_id * 10"),
        "runs": runs,
        "records": records,
        "run_documents": links,
        "entities": rows("part", entity_id="p_partkey", kind="case p_partkey % 5 when 0 then 'region' when 1 then 'facility' else 'organization' end", created_us="p_partkey % 80", run_id="if(p_partkey % 3 = 0, p_partkey % 10 + 1, null)"),
        "series": rows("part", series_id="p_partkey", entity_id="p_partkey", value_kind="element_at(array('number', 'text', 'relation'), cast(p_partkey % 3 + 1 as int))", created_us="if(p_partkey % 29 = 0, 100, p_partkey % 50)"),
        "versions": versions,
        "evidence": evidence,
        "name_metadata": versions.where("version_id % 5 = 0").select("version_id"),
        "identifier_metadata": versions.where("version_id % 7 = 0").select("version_id"),
        "resolution_runs": rows("customer", resolution_id="c_custkey", status="element_at(array('running', 'succeeded', 'failed'), cast(c_custkey % 3 + 1 as int))", started_us="c_custkey + 90", completed_us="case when c_custkey % 5 = 0 then null when c_custkey % 7 = 0 then c_custkey + 90 else c_custkey + 100 end", error="case when c_custkey % 4 = 0 then 'e' when c_custkey % 11 = 0 then ' ' end"),
        "resolution_inputs": spread(rows("customer", resolution_id="c_custkey", run_id="c_custkey % 10 + 1").unionByName(rows("customer", resolution_id="c_custkey", run_id="c_custkey % 7 + 1")), "resolution_id").distinct(),
        "candidates": candidates,
        "decisions": decisions,
        "assignments": assigned.select(F.col("candidate_id").alias("assignment_id"), F.col("candidate_id").alias("decision_id"), "record_id", "observed_id", e("if(candidate_id % 10 = 0, 1, proposed_id)").alias("canonical_id"), e("date'2024-01-01'").alias("valid_from"), e("if(candidate_id % 4 = 0, date_add(date'2024-01-01', cast(candidate_id % 5 as int)), null)").alias("valid_to"), e("created_us + candidate_id % 14").alias("recorded_us"), e("if(candidate_id % 9 = 0, created_us + candidate_id % 14 + candidate_id % 2, null)").alias("superseded_us")),
    }
