"""Registered queries: each operator on the benchmark tables, beside the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.functions import clocks, facilities, geo, ids, text
from claimlens.operators import changes, curated, evaluate, forecast, graph, identity, intervals, records, refresh, release, views
from claimlens.plans.session import ensure
from claimlens.plans.staging import Staging
from claimlens.sources import exports, readers
from claimlens.sources import projection as P
from claimlens.streaming import queues

DAY = "2024-01-15"
AT = 1705320000000000  # 2024-01-15T12:00:00Z
START, END = 1704067200000000, 1706659200000000  # 2024-01-01 and 2024-01-31
SINCE = 1704672000000000  # 2024-01-08
BASES = list(forecast.BASIS)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(ensure(spark), sf_dir)

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return run

    return register


# ---------------------------------------------------------------- the projection in SQL

CLAIMS = """
raw AS (
  SELECT event_id AS claim_id, user_id AS entity_id, event_type AS predicate,
         CASE WHEN event_id % 8 <> 0 THEN CAST(ts AS DATE) END AS valid_from,
         CASE WHEN event_id % 8 <> 0 AND event_id % 5 = 0 THEN CAST(CAST(ts AS DATE) + INTERVAL 7 DAY AS DATE) END AS valid_to,
         epoch_us(ts) AS recorded_us,
         CASE WHEN event_id % 8 = 0 THEN 'source_statement' WHEN event_id % 3 = 0 THEN 'derived_estimate' ELSE 'direct_observation' END AS claim_kind,
         value, props
  FROM events),
claims AS (
  SELECT *, lead(recorded_us) OVER (PARTITION BY entity_id, predicate, valid_from ORDER BY recorded_us, claim_id) AS superseded_us FROM raw)"""
DEPS = """
deps AS (
  SELECT DISTINCT event_id AS child, unnest([event_id // 2, event_id // 3]) AS parent FROM events WHERE event_id > 0)"""
EVIDENCE = """
n AS (SELECT count(*) AS n FROM documents),
evidence AS (SELECT event_id AS claim_id, event_id % n.n AS document_id, CASE WHEN event_id % 3 < 2 THEN 'support' ELSE 'context' END AS role FROM events, n)"""
CURRENT = f"""
{CLAIMS.strip()},
eligible AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id, predicate ORDER BY valid_from DESC, recorded_us DESC, claim_id DESC) AS rk
  FROM claims
  WHERE valid_from <= DATE '{DAY}' AND (valid_to IS NULL OR DATE '{DAY}' < valid_to)
    AND recorded_us <= {AT} AND (superseded_us IS NULL OR {AT} < superseded_us)),
current_view AS (SELECT claim_id, entity_id, predicate, valid_from, valid_to, recorded_us, CASE WHEN superseded_us <= {AT} THEN superseded_us END AS superseded_us, claim_kind, value FROM eligible WHERE rk = 1)"""
VIEW = ("claim_id", "entity_id", "predicate", "valid_from", "valid_to", "recorded_us", "superseded_us", "claim_kind", "value")


def _current(spark, sf_dir):
    return views.current(P.claims(spark, sf_dir), DAY, AT).select(*VIEW)


# ---------------------------------------------------------------- views


@query(f"WITH {CURRENT} SELECT * FROM current_view")
def asof_current_claims(spark, sf_dir):
    return _current(spark, sf_dir)


@query(f"WITH {CLAIMS}, v AS (SELECT * FROM claims WHERE predicate = 'purchase') SELECT claim_id, entity_id, value FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, predicate ORDER BY valid_from DESC, recorded_us DESC, claim_id DESC) AS rk FROM v WHERE valid_from <= DATE '{DAY}' AND (valid_to IS NULL OR DATE '{DAY}' < valid_to) AND recorded_us <= {AT} AND (superseded_us IS NULL OR {AT} < superseded_us)) WHERE rk = 1")
def asof_filtered(spark, sf_dir):
    return views.current(P.claims(spark, sf_dir), DAY, AT, predicate="purchase").select("claim_id", "entity_id", "value")


@query(f"WITH {CLAIMS} SELECT claim_id, entity_id, predicate, recorded_us, CASE WHEN superseded_us <= {AT} THEN superseded_us END AS superseded_us FROM claims WHERE claim_kind = 'source_statement' AND recorded_us <= {AT} AND (superseded_us IS NULL OR {AT} < superseded_us)")
def known_statements(spark, sf_dir):
    return views.statements(P.claims(spark, sf_dir), AT).select("claim_id", "entity_id", "predicate", "recorded_us", "superseded_us")


@query(f"WITH {CLAIMS} SELECT claim_id, entity_id, predicate, CAST(valid_from AS VARCHAR) AS valid_from, recorded_us, CASE WHEN superseded_us <= {AT} THEN superseded_us END AS superseded_us FROM claims WHERE recorded_us <= {AT} AND (valid_from IS NULL OR valid_from <= DATE '{DAY}' OR claim_kind = 'source_statement')")
def claim_history(spark, sf_dir):
    return views.history(P.claims(spark, sf_dir), DAY, AT).select("claim_id", "entity_id", "predicate", F.col("valid_from").cast("string").alias("valid_from"), "recorded_us", "superseded_us")


ASSIGN = """
assign AS (
  SELECT o_orderkey AS assignment_id, o_custkey AS observed_id, CAST(o_orderdate AS DATE) AS valid_from,
         CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 45 DAY AS DATE) END AS valid_to, epoch_us(o_orderdate) AS recorded_us FROM orders)"""


@query(f"WITH {ASSIGN} SELECT assignment_id, observed_id, valid_from, valid_to FROM assign WHERE valid_from <= DATE '1998-06-01' AND (valid_to IS NULL OR DATE '1998-06-01' < valid_to) AND recorded_us <= 896659200000000")
def assignment_asof(spark, sf_dir):
    return views.assignments_as_of(P.assignments(spark, sf_dir), "1998-06-01", 896659200000000).select("assignment_id", "observed_id", "valid_from", "valid_to")


@query(f"WITH {CURRENT}, copy AS (SELECT * FROM current_view WHERE claim_id % 97 <> 0 UNION ALL SELECT * FROM current_view WHERE claim_id % 101 = 0) SELECT (SELECT count(*) FROM (SELECT * FROM current_view EXCEPT ALL SELECT * FROM copy)) AS missing, (SELECT count(*) FROM (SELECT * FROM copy EXCEPT ALL SELECT * FROM current_view)) AS extra")
def complete_view_equality(spark, sf_dir):
    """A stored copy of the current view, with rows lost and rows repeated, against the view computed again."""
    now = _current(spark, sf_dir)
    copy = Staging(spark, "view").table(now.where("claim_id % 97 <> 0").unionByName(now.where("claim_id % 101 = 0")), "copy")
    return views.complete_view_equal(copy, now)


# ---------------------------------------------------------------- graph


@query(f"WITH RECURSIVE {CURRENT}, {DEPS}, reach(root, node) AS (SELECT claim_id, claim_id FROM current_view UNION SELECT r.root, d.parent FROM reach r JOIN deps d ON d.child = r.node) SELECT root, node FROM reach")
def lineage_closure(spark, sf_dir):
    """Everything that each claim of the current view rests on."""
    seeds = _current(spark, sf_dir).select(F.col("claim_id").alias("root"))
    return graph.closure(seeds, P.dependencies(spark, sf_dir), Staging(spark, "closure"))


@query(f"WITH RECURSIVE {DEPS}, {EVIDENCE}, reach(root, node) AS (SELECT event_id, event_id FROM events UNION SELECT r.root, d.parent FROM reach r JOIN deps d ON d.child = r.node) SELECT root, count(DISTINCT document_id) AS n_documents, min(document_id) AS first_document FROM reach JOIN evidence ON claim_id = node GROUP BY root")
def lineage_documents(spark, sf_dir):
    """Documents that each claim rests on, directly or through parents."""
    claims = P.table(spark, sf_dir, "events").select(F.col("event_id").alias("node"))
    told = P.evidence(spark, sf_dir).select(F.col("claim_id").alias("node"), F.col("document_id").alias("value"))
    sets = graph.gathered(claims, told, P.dependencies(spark, sf_dir), Staging(spark, "lineage")).where(F.size("held") > 0)
    return sets.select(F.col("node").alias("root"), F.size("held").cast("long").alias("n_documents"), F.element_at("held", 1).alias("first_document"))


@query(
    f"""WITH RECURSIVE {DEPS}, edges AS (SELECT DISTINCT child, parent FROM (SELECT child, parent FROM deps WHERE child <> parent UNION ALL SELECT event_id // 2, event_id FROM events WHERE event_id % 400 = 399)),
ring(a, b) AS (SELECT event_id, event_id // 2 FROM events WHERE event_id % 400 = 399 UNION SELECT r.a, e.parent FROM ring r JOIN edges e ON e.child = r.b),
bad(node) AS (SELECT a FROM ring WHERE a = b UNION SELECT e.child FROM bad x JOIN edges e ON e.parent = x.node)
SELECT node FROM bad"""
)
def cycle_check(spark, sf_dir):
    """Claims on planted circles, and those that rest on one."""
    edges = P.dependencies(spark, sf_dir).where("child <> parent")
    back = P.table(spark, sf_dir, "events").where("event_id % 400 = 399").select(F.expr("event_id div 2").alias("child"), F.col("event_id").alias("parent"))
    return graph.cyclic_nodes(edges.unionByName(back), Staging(spark, "cycles"))


@query(
    f"""WITH RECURSIVE {DEPS}, direct AS (SELECT event_id AS node FROM events WHERE event_id % 2 = 1 OR event_id < 4),
bad(node) AS (
  SELECT e.event_id FROM events e WHERE e.event_id NOT IN (SELECT node FROM direct) AND NOT EXISTS (SELECT 1 FROM deps d WHERE d.child = e.event_id AND d.child <> d.parent)
  UNION SELECT d.child FROM bad b JOIN deps d ON d.parent = b.node WHERE d.child <> d.parent AND d.child NOT IN (SELECT node FROM direct))
SELECT event_id AS node FROM events WHERE event_id NOT IN (SELECT node FROM bad)"""
)
def supported_claims(spark, sf_dir):
    """Claims with evidence of their own, or all of whose parents are supported."""
    nodes = P.table(spark, sf_dir, "events").select(F.col("event_id").alias("node"))
    direct = nodes.where("node % 2 = 1 or node < 4")
    return graph.supported(nodes, direct, P.dependencies(spark, sf_dir).where("child <> parent"), Staging(spark, "support"))


@query(f"WITH {DEPS}, ev AS (SELECT event_id AS claim_id FROM events WHERE event_id % 3 = 1) SELECT event_id AS claim_id FROM events WHERE event_id NOT IN (SELECT claim_id FROM ev) AND event_id NOT IN (SELECT child FROM deps)")
def unsupported_claims(spark, sf_dir):
    claims = P.table(spark, sf_dir, "events").select(F.col("event_id").alias("claim_id"))
    return records.unsupported(claims, P.evidence(spark, sf_dir).where("claim_id % 3 = 1"), P.dependencies(spark, sf_dir))


EDGES = "edges AS (SELECT c_custkey AS a, c_custkey + 7 AS b FROM customer WHERE c_custkey % 3 = 0 UNION SELECT c_custkey, c_custkey * 2 FROM customer WHERE c_custkey % 5 = 0)"


@query(f"WITH RECURSIVE {EDGES}, both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), r(n, m) AS (SELECT a, a FROM both_ways UNION SELECT r.n, x.b FROM r JOIN both_ways x ON x.a = r.m WHERE x.b < r.n OR TRUE) SELECT n AS node, min(m) AS component FROM r GROUP BY n")
def connected_components(spark, sf_dir):
    """Components of customers that share an amount or a scope (two edge rules)."""
    c = P.table(spark, sf_dir, "customer")
    edges = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("src"), (F.col("c_custkey") + 7).alias("dst")).unionByName(c.where("c_custkey % 5 = 0").select(F.col("c_custkey").alias("src"), (F.col("c_custkey") * 2).alias("dst")))
    return graph.connected_components(edges, Staging(spark, "components"))


# ---------------------------------------------------------------- changes

FEED = f"""
feed AS (
  SELECT claim_id, entity_id, predicate, 'claim_admitted' AS event_type, recorded_us AS event_us FROM claims WHERE recorded_us > {SINCE} AND recorded_us <= {AT}
  UNION ALL SELECT claim_id, entity_id, predicate, 'claim_superseded', superseded_us FROM claims WHERE superseded_us > {SINCE} AND superseded_us <= {AT})"""
PAIRS = """
pairs AS (
  SELECT p.claim_id AS prior_id, c.claim_id AS current_id, c.entity_id, c.predicate, c.valid_from, c.recorded_us, p.value AS prior_value, c.value AS current_value
  FROM claims p JOIN claims c ON c.entity_id = p.entity_id AND c.predicate = p.predicate AND c.valid_from = p.valid_from AND c.recorded_us = p.superseded_us)"""


def _feed(spark, sf_dir):
    return changes.feed(P.claims(spark, sf_dir), SINCE, AT)


@query(f"WITH {CLAIMS}, {FEED} SELECT * FROM feed")
def change_feed(spark, sf_dir):
    return _feed(spark, sf_dir)


@query(f"WITH {CLAIMS}, {FEED} SELECT k.event_type, count(f.claim_id) AS events, count(DISTINCT f.claim_id) AS claims, count(DISTINCT f.entity_id) AS entities FROM (VALUES ('claim_admitted'), ('claim_superseded')) k(event_type) LEFT JOIN feed f USING (event_type) GROUP BY 1")
def change_feed_counts(spark, sf_dir):
    return changes.feed_counts(_feed(spark, sf_dir))


@query(f"WITH {CLAIMS}, {FEED} SELECT claim_id, event_type, event_us FROM feed ORDER BY event_us, event_type, claim_id LIMIT 50 OFFSET 100")
def change_feed_page(spark, sf_dir):
    """One page of the feed in its total order (a page is the feature)."""
    return changes.feed_page(_feed(spark, sf_dir), 50, 100).select("claim_id", "event_type", "event_us")


@query(
    f"""WITH {CLAIMS}, {FEED}, own AS (SELECT sha256(event_us || '|' || event_type || '|' || claim_id) AS h, count(*) AS n FROM feed GROUP BY 1),
leaf AS (SELECT substr(h, 1, 6) AS p, sha256(string_agg(h || ':' || n, chr(10) ORDER BY h || ':' || n)) AS d, sum(n) AS n FROM own GROUP BY 1),
branch AS (SELECT substr(p, 1, 3) AS q, sha256(string_agg(p || ':' || d, chr(10) ORDER BY p || ':' || d)) AS d, sum(n) AS n FROM leaf GROUP BY 1)
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n, sha256(coalesce(string_agg(q || ':' || d, chr(10) ORDER BY q || ':' || d), '')) AS digest FROM branch"""
)
def change_feed_token(spark, sf_dir):
    return changes.population_hash(_feed(spark, sf_dir))


@query(f"WITH {CLAIMS}, {PAIRS} SELECT prior_id, current_id, entity_id, predicate, valid_from, recorded_us, prior_value, current_value FROM pairs")
def revision_pairs(spark, sf_dir):
    return changes.revision_pairs(P.claims(spark, sf_dir))


@query(
    f"""WITH {CLAIMS}, {PAIRS}, c AS (SELECT *, CAST(prior_value AS DECIMAL(20,6)) AS p, CAST(current_value AS DECIMAL(20,6)) AS v FROM pairs WHERE prior_id % 11 <> 0 AND current_id % 11 <> 0),
d AS (SELECT *, CASE WHEN p <> 0 THEN p ELSE greatest(v, 1) END AS b FROM c)
SELECT prior_id, current_id, entity_id, predicate, round(CAST(v - p AS DOUBLE) / CAST(b AS DOUBLE), 9) AS relative_change, CASE WHEN (v > p) = (b > 0) THEN 'increase' ELSE 'decrease' END AS direction,
  CASE WHEN abs(v - p) * 100 >= abs(b) * 60 THEN 'high' WHEN abs(v - p) * 100 >= abs(b) * 30 THEN 'medium' ELSE 'low' END AS severity,
  sha256('["capacity_revision","' || entity_id || '","' || prior_id || '","' || current_id || '"]') AS fingerprint
FROM d WHERE abs(v - p) * 100 >= abs(b) * 15"""
)
def revision_alerts(spark, sf_dir):
    """Revisions of 15 % or more; claims whose id is divisible by 11 are of unknown confidence and raise none."""
    claims = P.claims(spark, sf_dir).withColumn("confidence", F.when(F.col("claim_id") % 11 != 0, 0.5))
    return changes.capacity_alerts(changes.revision_pairs(claims))


MILE = """
mile AS (SELECT o_orderkey AS milestone_id, o_custkey AS entity_id, CAST(o_orderdate AS DATE) - 30 AS low, CAST(o_orderdate AS DATE) AS base, CAST(o_orderdate AS DATE) + 60 AS high,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'expected' ELSE 'delayed' END AS status FROM orders)"""
MPAIRS = f"""{MILE},
mp AS (SELECT b.milestone_id AS key, a.status AS prior_status, CASE WHEN b.milestone_id % 7 = 0 THEN 'cancelled' ELSE b.status END AS current_status, a.base AS prior_base, b.base AS current_base
  FROM mile a JOIN mile b ON b.milestone_id = a.milestone_id + 1)"""


def _milestone_pairs(spark, sf_dir):
    m = P.milestones(spark, sf_dir)
    a = m.select((F.col("milestone_id") + 1).alias("key"), F.col("status").alias("prior_status"), F.col("base").alias("prior_base"))
    b = m.select(F.col("milestone_id").alias("key"), F.when(F.col("milestone_id") % 7 == 0, "cancelled").otherwise(F.col("status")).alias("current_status"), F.col("base").alias("current_base"))
    return a.join(b, "key")


@query(
    f"""WITH {MPAIRS}, k AS (SELECT key, current_base - prior_base AS shift_days, prior_status p, current_status c FROM mp),
a AS (SELECT *, CASE WHEN c = 'cancelled' AND p <> 'cancelled' THEN 'project_cancellation' WHEN p = 'cancelled' AND c <> 'cancelled' THEN 'project_reactivation' WHEN c = 'delayed' AND p <> 'delayed' THEN 'completion_delay'
  WHEN c = 'cancelled' OR abs(shift_days) < 90 THEN NULL WHEN shift_days > 0 THEN 'completion_delay' ELSE 'completion_acceleration' END AS alert_type FROM k)
SELECT key, alert_type, CASE WHEN alert_type = 'project_cancellation' THEN 'high' WHEN alert_type = 'project_reactivation' OR (c = 'delayed' AND p <> 'delayed') THEN 'medium'
  WHEN abs(shift_days) >= 360 THEN 'high' WHEN abs(shift_days) >= 180 THEN 'medium' ELSE 'low' END AS severity, CAST(shift_days AS INTEGER) AS shift_days FROM a WHERE alert_type IS NOT NULL"""
)
def milestone_alerts(spark, sf_dir):
    return changes.milestone_alerts(_milestone_pairs(spark, sf_dir))


@query("WITH r AS (SELECT doc_id, lower(text) AS t FROM documents) SELECT doc_id, CASE WHEN t LIKE '%cancel%' THEN 'project_cancellation' WHEN t LIKE '%redesign%' THEN 'project_redesign' ELSE 'project_pause' END AS alert_type, CASE WHEN t LIKE '%cancel%' THEN 'high' ELSE 'medium' END AS severity FROM r WHERE regexp_matches(t, 'cancelled|canceled|redesigned|paused')")
def scalar_alerts(spark, sf_dir):
    d = P.table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("current_text"))
    return changes.scalar_alerts(d).select("doc_id", "alert_type", "severity")


RELEASES = """
e AS (SELECT user_id AS entity_id, event_type AS predicate, value, epoch_us(ts) AS us, event_id, ts FROM events),
prior_release AS (SELECT entity_id, predicate, arg_max(value, us * 10000000000 + event_id) AS value FROM (SELECT entity_id, predicate, value, CAST(us AS HUGEINT) AS us, event_id FROM e WHERE ts < TIMESTAMP '2024-01-15') GROUP BY ALL),
next_release AS (SELECT entity_id, predicate, arg_max(value, us * 10000000000 + event_id) AS value FROM (SELECT entity_id, predicate, value, CAST(us AS HUGEINT) AS us, event_id FROM e) GROUP BY ALL),
diff AS (SELECT entity_id, predicate, p.value AS prior_value, c.value AS current_value,
  CASE WHEN p.entity_id IS NULL THEN 'added' WHEN c.entity_id IS NULL THEN 'not_carried_forward' WHEN p.value IS NOT DISTINCT FROM c.value THEN 'reaffirmed' ELSE 'revised' END AS status
  FROM prior_release p FULL JOIN next_release c USING (entity_id, predicate))"""
RELEASES = RELEASES.replace("GROUP BY ALL", "GROUP BY entity_id, predicate")


def _diff(spark, sf_dir):
    return changes.release_diff(*P.releases(spark, sf_dir, "2024-01-15 00:00:00"))


@query(f"WITH {RELEASES} SELECT entity_id, predicate, prior_value, current_value, status FROM diff")
def release_diff(spark, sf_dir):
    return _diff(spark, sf_dir)


@query(f"WITH {RELEASES} SELECT s.status, count(d.entity_id) AS series FROM (VALUES ('added'), ('not_carried_forward'), ('reaffirmed'), ('revised')) s(status) LEFT JOIN diff d USING (status) GROUP BY 1")
def diff_summary(spark, sf_dir):
    return changes.diff_summary(_diff(spark, sf_dir))


@query(
    f"""WITH {RELEASES}, x AS (SELECT *, CAST(prior_value AS DECIMAL(20,6)) AS p, CAST(current_value AS DECIMAL(20,6)) AS c FROM diff WHERE status = 'revised')
SELECT entity_id, predicate, prior_value, current_value, CASE WHEN c > p THEN 'increase' ELSE 'decrease' END AS direction FROM x WHERE c <> p AND abs(c - p) * 100 >= abs(CASE WHEN p <> 0 THEN p ELSE c END) * 15"""
)
def alert_proposals_capacity(spark, sf_dir):
    return changes.capacity_proposals(_diff(spark, sf_dir))


STAGES = {"completed": 3, "expected": 1}


@query(
    f"""WITH {MPAIRS}, r AS (SELECT *, CASE prior_status WHEN 'completed' THEN 3 WHEN 'expected' THEN 1 END AS was, CASE current_status WHEN 'completed' THEN 3 WHEN 'expected' THEN 1 END AS now FROM mp WHERE prior_status <> current_status)
SELECT key, prior_status AS prior_stage, current_status AS current_stage, CASE WHEN now IS NULL THEN 'lifecycle_side_state' ELSE 'lifecycle_positive_stage_change' END AS rule,
  CASE WHEN now IS NULL THEN NULL WHEN was IS NULL THEN 'return_to_positive' WHEN now > was THEN 'advanced' ELSE 'earlier_stage' END AS direction FROM r"""
)
def alert_proposals_lifecycle(spark, sf_dir):
    pairs = _milestone_pairs(spark, sf_dir).withColumnsRenamed({"prior_status": "prior_stage", "current_status": "current_stage"})
    return changes.stage_proposals(pairs, STAGES, ("delayed", "cancelled"))


# ---------------------------------------------------------------- forecasts

CAP = """
cap AS (SELECT l_partkey AS capacity_id, min(l_quantity) AS low, round(avg(l_quantity), 6) AS base, max(l_quantity) AS high FROM lineitem GROUP BY 1),
capacity AS (SELECT c.*, p_type AS metric, p_brand AS brand, ['announced','physical_construction','tool_installed','qualified','economically_usable'][p_size % 5 + 1] AS basis,
  CASE WHEN p_partkey % 3 = 0 THEN DATE '2023-11-10' + CAST(p_partkey % 700 AS INTEGER) END AS start_base FROM cap c JOIN part ON p_partkey = capacity_id)"""
POINTS = (
    f"""{CAP},
q AS (SELECT unnest(range(20)) AS q),
grid AS (SELECT capacity.*, q, CAST(DATE '2024-01-01' + to_months(CAST(3 * q AS INTEGER)) AS DATE) AS period_start FROM capacity, q),
ramp AS (SELECT unnest(range(8)) AS k, unnest([0.05,0.15,0.30,0.50,0.70,0.85,0.95,1.00]) AS r10, unnest([0.15,0.35,0.60,0.80,0.92,1.00,1.00,1.00]) AS r50, unnest([0.30,0.60,0.82,0.95,1.00,1.00,1.00,1.00]) AS r90),
fac AS (SELECT unnest(['announced','physical_construction','tool_installed','qualified','economically_usable']) AS basis, unnest([0.45,0.65,0.80,0.90,1.00]) AS f10, unnest([0.70,0.82,0.92,0.97,1.00]) AS f50, unnest([0.90,0.95,1.00,1.00,1.00]) AS f90),
st AS (SELECT *, CASE WHEN start_base IS NOT NULL THEN start_base + 90 WHEN basis <> 'economically_usable' THEN DATE '2024-01-01' END AS s10,
  CASE WHEN start_base IS NOT NULL THEN start_base WHEN basis <> 'economically_usable' THEN DATE '2024-01-01' END AS s50,
  CASE WHEN start_base IS NOT NULL THEN start_base - 60 WHEN basis <> 'economically_usable' THEN DATE '2024-01-01' END AS s90 FROM grid),
off AS (SELECT *, (year(period_start)-year(s10))*4+quarter(period_start)-quarter(s10) AS o10, (year(period_start)-year(s50))*4+quarter(period_start)-quarter(s50) AS o50, (year(period_start)-year(s90))*4+quarter(period_start)-quarter(s90) AS o90 FROM st),
pts AS (SELECT o.capacity_id, metric, brand, o.basis, year(period_start) || '-Q' || quarter(period_start) AS quarter,
  round(low * CAST(f10 AS DOUBLE) * CASE WHEN s10 IS NULL THEN 1.0 WHEN o10 < 0 THEN 0.0 ELSE CAST(a.r10 AS DOUBLE) END, 9) AS p10,
  round(base * CAST(f50 AS DOUBLE) * CASE WHEN s50 IS NULL THEN 1.0 WHEN o50 < 0 THEN 0.0 ELSE CAST(b.r50 AS DOUBLE) END, 9) AS p50,
  round(high * CAST(f90 AS DOUBLE) * CASE WHEN s90 IS NULL THEN 1.0 WHEN o90 < 0 THEN 0.0 ELSE CAST(c.r90 AS DOUBLE) END, 9) AS p90
  FROM off o JOIN fac ON fac.basis = o.basis LEFT JOIN ramp a ON a.k = least(greatest(o10, 0), 7) LEFT JOIN ramp b ON b.k = least(greatest(o50, 0), 7) LEFT JOIN ramp c ON c.k = least(greatest(o90, 0), 7))"""
)


def _capacity(spark, sf_dir):
    c = P.capacities(spark, sf_dir)
    basis = F.element_at(F.array(*[F.lit(b) for b in BASES]), (F.col("basis_rank") + 1).cast("int"))
    start = F.when(F.col("capacity_id") % 3 == 0, F.date_add(F.lit("2023-11-10").cast("date"), (F.col("capacity_id") % 700).cast("int")))
    return c.select("capacity_id", "metric", F.col("p_brand").alias("brand"), basis.alias("basis"), "low", "base", "high", start.alias("start_base"), F.date_add(start, 90).alias("start_high"), F.date_sub(start, 60).alias("start_low"))


@query(f"WITH {POINTS} SELECT capacity_id, basis, quarter, round(p10 + 1.23456e-9, 6) AS p10, round(p50 + 1.23456e-9, 6) AS p50, round(p90 + 1.23456e-9, 6) AS p90 FROM pts")
def forecast_points(spark, sf_dir):
    r = lambda c: F.round(F.col(c) + 1.23456e-9, 6).alias(c)  # noqa: E731 engines round ties apart, so none is left
    return forecast.points(_capacity(spark, sf_dir), "2024-02-10").select("capacity_id", "basis", "quarter", r("p10"), r("p50"), r("p90"))


@query(f"WITH {POINTS} SELECT brand, metric, quarter, round(sum(CAST(p10 AS DECIMAL(28,9))), 3)::DOUBLE AS p10, round(sum(CAST(p50 AS DECIMAL(28,9))), 3)::DOUBLE AS p50, round(sum(CAST(p90 AS DECIMAL(28,9))), 3)::DOUBLE AS p90, count(*) AS members FROM pts GROUP BY ALL".replace("GROUP BY ALL", "GROUP BY brand, metric, quarter"))
def forecast_by_region(spark, sf_dir):
    """Summed forecasts of a group: here brand and metric."""
    r = lambda c: F.round(c, 3).alias(c)
    pts = forecast.points(_capacity(spark, sf_dir), "2024-02-10")
    return forecast.aggregate(pts, ("brand", "metric")).select("brand", "metric", "quarter", r("p10"), r("p50"), r("p90"), "members")


# ---------------------------------------------------------------- records


@query(f"WITH {CURRENT} SELECT entity_id, count(DISTINCT predicate) AS n_fields, string_agg(predicate, ',' ORDER BY predicate) AS fields FROM current_view GROUP BY 1")
def entity_pivot(spark, sf_dir):
    p = records.pivot_entities(_current(spark, sf_dir))
    return p.select("entity_id", "n_fields", F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("fields"))


@query(f"WITH {CURRENT} SELECT claim_kind, predicate, count(*) AS claims, count(DISTINCT entity_id) AS entities FROM current_view GROUP BY 1, 2")
def summary_by_kind(spark, sf_dir):
    return records.summary(_current(spark, sf_dir))


@query(f"WITH {CLAIMS} SELECT predicate, min(recorded_us) AS first_us, max(recorded_us) AS last_us, arg_min(claim_id, recorded_us) AS first_id, arg_max(claim_id, recorded_us) AS last_id, count(*) AS rows FROM claims GROUP BY 1")
def family_first_last(spark, sf_dir):
    return records.first_last(P.claims(spark, sf_dir), "predicate", "recorded_us", "claim_id")


@query(f"WITH {CURRENT}, {EVIDENCE} SELECT c.claim_id, role, sha256(d.text) AS content_sha256, d.source, d.lang AS family FROM current_view c LEFT JOIN evidence e USING (claim_id) LEFT JOIN documents d ON d.doc_id = e.document_id")
def evidence_hydration(spark, sf_dir):
    return records.hydrate(_current(spark, sf_dir).select("claim_id"), P.evidence(spark, sf_dir), P.documents(spark, sf_dir)).select("claim_id", "role", "content_sha256", "source", "family")


@query("WITH s AS (SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey), m AS (SELECT * FROM s WHERE lower(s_name) LIKE '%1%' OR lower(n_name) LIKE '%1%') SELECT 'n_name' AS facet, n_name AS label, count(*) AS n FROM m GROUP BY 2 UNION ALL SELECT 'r_name', r_name, count(*) FROM m GROUP BY 2")
def search_facets(spark, sf_dir):
    return records.facet_counts(_search(spark, sf_dir, "1"), ["n_name", "r_name"])


def _search(spark, sf_dir, needle):
    n = F.broadcast(P.table(spark, sf_dir, "nation").join(P.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")))  # nations: a fixed table
    s = P.table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    return records.search(s, text.fold(needle), ["s_name", "n_name"], text.folded())


@query("WITH s AS (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE lower(s_name) LIKE '%1%' OR lower(n_name) LIKE '%1%') SELECT s_suppkey, s_name FROM s ORDER BY s_name, s_suppkey LIMIT 20 OFFSET 5")
def search_page(spark, sf_dir):
    """A page of hits in their total order (a page is the feature)."""
    return _search(spark, sf_dir, "1").orderBy("s_name", "s_suppkey").offset(5).limit(20).select("s_suppkey", "s_name")


@query(f"WITH {MILE}, t AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY status <> 'delayed' DESC, base DESC, high DESC, status DESC) AS r FROM mile) SELECT entity_id, status AS headline, base AS as_of FROM t WHERE r = 1")
def headline_pick(spark, sf_dir):
    """The latest status of each entity, other than delayed where there is one."""
    return records.pick_latest(P.milestones(spark, sf_dir), "entity_id", "status", "base", "high", F.col("status") != "delayed")


@query(f"WITH {MILE}, t AS (SELECT *, rank() OVER (PARTITION BY entity_id ORDER BY base DESC) AS r FROM mile) SELECT entity_id, CASE WHEN count(DISTINCT status) = 1 THEN max(status) END AS status, max(base) AS base FROM t WHERE r = 1 GROUP BY 1")
def headline_unambiguous(spark, sf_dir):
    return records.unambiguous(P.milestones(spark, sf_dir), "entity_id", "status", "base")


@query(f"WITH {MILE} SELECT entity_id, status, min(low) AS earliest, max(high) AS latest FROM mile GROUP BY 1, 2")
def earliest_latest_milestone(spark, sf_dir):
    return P.milestones(spark, sf_dir).groupBy("entity_id", "status").agg(F.min("low").alias("earliest"), F.max("high").alias("latest"))


@query("WITH c AS (SELECT event_id, event_type AS kind, CASE WHEN event_type = 'click' OR event_id % 50 = 0 THEN value END AS number_value, CASE WHEN event_type <> 'click' AND event_id % 77 <> 0 THEN event_type END AS text_value FROM events) SELECT event_id FROM c WHERE (number_value IS NOT NULL)::INT + (text_value IS NOT NULL)::INT <> 1 OR (kind = 'click' AND number_value IS NULL) OR (kind <> 'click' AND text_value IS NULL)")
def typed_value_xor(spark, sf_dir):
    e = P.table(spark, sf_dir, "events")
    number = F.when((F.col("event_type") == "click") | (F.col("event_id") % 50 == 0), F.col("value"))
    word = F.when((F.col("event_type") != "click") & (F.col("event_id") % 77 != 0), F.col("event_type"))
    rows = e.select("event_id", F.when(F.col("event_type") == "click", "number").otherwise("text").alias("kind"), number.alias("number_value"), word.alias("text_value"))
    return records.typed_value_errors(rows, "kind", {"number": "number_value", "text": "text_value"}).select("event_id")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN epoch_us(ts) ELSE event_id * 10 END AS admission_us FROM events")
def json_missing_vs_null(spark, sf_dir):
    """The admission clock: a key that is null gives null, a key that is missing gives the start."""
    e = P.table(spark, sf_dir, "events")
    n = F.col("event_id")
    params = F.when(n % 4 == 0, '{"accepted_at":null}').when(n % 4 == 1, "{}").otherwise(F.concat(F.lit('{"accepted_at":'), (n * 10).cast("string"), F.lit("}")))
    return e.select("event_id", records.admission_us(params, clocks.micros(F.col("ts"))).alias("admission_us"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL")
def json_scalar(spark, sf_dir):
    return P.table(spark, sf_dir, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "long").alias("k")).where("k is not null")


@query("SELECT DISTINCT o_custkey AS id, 'order' AS role FROM orders UNION SELECT c_custkey, 'customer' FROM customer UNION SELECT o_custkey, 'open' FROM orders WHERE o_orderstatus = 'O'")
def union_ledger(spark, sf_dir):
    """Accepted inputs from several branches, each once."""
    o, c = P.table(spark, sf_dir, "orders"), P.table(spark, sf_dir, "customer")
    parts = [o.select(F.col("o_custkey").alias("id"), F.lit("order").alias("role")), c.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("role")), o.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("id"), F.lit("open").alias("role"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


@query("SELECT c_custkey AS id, c_name AS name, CAST(NULL AS DOUBLE) AS price FROM customer UNION ALL SELECT p_partkey, NULL, p_retailprice FROM part")
def metadata_union_all(spark, sf_dir):
    a = P.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = P.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("price"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT c_nationkey, c_mktsegment, string_agg(DISTINCT CAST(c_custkey % 10 AS VARCHAR), ',' ORDER BY CAST(c_custkey % 10 AS VARCHAR)) AS marks FROM customer GROUP BY 1, 2")
def merged_statements(spark, sf_dir):
    c = P.table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment", F.array((F.col("c_custkey") % 10).cast("string")).alias("marks"))
    return records.merge_statements(c, ["c_nationkey", "c_mktsegment"], ["marks"]).withColumn("marks", F.array_join("marks", ","))


# ---------------------------------------------------------------- refresh and violations


@query(f"WITH {RELEASES} SELECT entity_id, predicate, CASE status WHEN 'added' THEN 'insert' WHEN 'not_carried_forward' THEN 'close' WHEN 'reaffirmed' THEN 'reuse' ELSE 'replace' END AS action FROM diff")
def scd2_refresh_plan(spark, sf_dir):
    return refresh.refresh_plan(*P.releases(spark, sf_dir, "2024-01-15 00:00:00"))


@query("SELECT p_partkey, 'p_size' AS columns FROM part WHERE p_partkey % 10 = 0 AND p_partkey % 4 <> 0")
def insert_or_verify_conflicts(spark, sf_dir):
    """A re-import where some rows are new and some differ in one column."""
    p = P.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    again = p.withColumn("p_size", F.when(F.col("p_partkey") % 10 == 0, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return refresh.insert_or_verify(p.where("p_partkey % 4 <> 0"), again, "p_partkey")[1].withColumn("columns", F.array_join("columns", ","))


@query("SELECT p_partkey FROM part WHERE p_partkey % 4 = 0")
def insert_or_verify_inserts(spark, sf_dir):
    p = P.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return refresh.insert_or_verify(p.where("p_partkey % 4 <> 0"), p, "p_partkey")[0].select("p_partkey")


@query(f"WITH {CLAIMS} SELECT entity_id, predicate, valid_from, count(*) AS open_versions FROM (SELECT *, CASE WHEN claim_id % 11 = 0 THEN NULL ELSE superseded_us END AS s FROM claims) WHERE s IS NULL GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_open_versions(spark, sf_dir):
    """A store where some supersessions were lost."""
    c = P.claims(spark, sf_dir).withColumn("superseded_us", F.when(F.col("claim_id") % 11 != 0, F.col("superseded_us")))
    return refresh.duplicate_open(c)


@query(f"WITH {ASSIGN} SELECT observed_id, least(a.assignment_id, b.assignment_id) AS left_id, greatest(a.assignment_id, b.assignment_id) AS right_id FROM assign a JOIN assign b USING (observed_id) WHERE b.assignment_id > a.assignment_id AND a.valid_from < coalesce(b.valid_to, DATE '9999-12-31') AND b.valid_from < coalesce(a.valid_to, DATE '9999-12-31')")
def overlapping_assignments(spark, sf_dir):
    return intervals.overlapping_pairs(P.assignments(spark, sf_dir), "observed_id", "assignment_id", "valid_from", "valid_to")


@query(
    f"""WITH {ASSIGN}, known AS (SELECT *, CASE WHEN assignment_id % 3 <> 0 THEN recorded_us + 86400000000 * (assignment_id % 900) + 1 ELSE 9223372036854775807 END AS superseded_us FROM assign)
SELECT observed_id, least(a.assignment_id, b.assignment_id) AS left_id, greatest(a.assignment_id, b.assignment_id) AS right_id FROM known a JOIN known b USING (observed_id)
WHERE b.assignment_id > a.assignment_id AND a.valid_from < coalesce(b.valid_to, DATE '9999-12-31') AND b.valid_from < coalesce(a.valid_to, DATE '9999-12-31') AND a.recorded_us < b.superseded_us AND b.recorded_us < a.superseded_us"""
)
def bitemporal_overlaps(spark, sf_dir):
    """Assignments of one entity that overlap in world time and were known at one instant."""
    ends = F.when(F.col("assignment_id") % 3 != 0, F.col("recorded_us") + (F.col("assignment_id") % 900) * 86_400_000_000 + 1)
    rows = P.assignments(spark, sf_dir).withColumn("superseded_us", ends)
    return intervals.overlapping_pairs(rows, "observed_id", "assignment_id", "valid_from", "valid_to", recorded="recorded_us", superseded="superseded_us")


@query("WITH c AS (SELECT CASE WHEN c_custkey % 5 = 0 THEN c_name || ' ' WHEN c_custkey % 5 = 1 THEN lower(c_name) WHEN c_custkey % 5 = 2 THEN c_name || '?' ELSE c_name END AS fk FROM customer) SELECT fk, count(*) AS rows, CASE WHEN trim(fk) IN (SELECT c_name FROM customer) THEN 'whitespace_only' WHEN lower(trim(fk)) IN (SELECT lower(c_name) FROM customer) THEN 'case_only' ELSE 'unresolved' END AS kind FROM c WHERE fk NOT IN (SELECT c_name FROM customer) GROUP BY 1")
def orphan_fk_classes(spark, sf_dir):
    c = P.table(spark, sf_dir, "customer")
    k, n = F.col("c_custkey") % 5, F.col("c_name")
    fk = F.when(k == 0, F.concat(n, F.lit(" "))).when(k == 1, F.lower(n)).when(k == 2, F.concat(n, F.lit("?"))).otherwise(n)
    return refresh.orphans(c.select(fk.alias("ref")), "ref", c.select("c_name"), "c_name")


@query(f"WITH {CLAIMS}, {DEPS} SELECT child, parent FROM deps JOIN claims c ON c.claim_id = child JOIN claims p ON p.claim_id = parent WHERE p.recorded_us > c.recorded_us")
def clock_violations(spark, sf_dir):
    return refresh.clock_violations(P.claims(spark, sf_dir), P.dependencies(spark, sf_dir))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 9 = 0 OR o_orderkey % 13 = 0")
def immutable_violations(spark, sf_dir):
    """A later snapshot that changed some totals and lost some rows."""
    before = P.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lit(None).cast("long").alias("closed_us"))
    after = before.where("o_orderkey % 13 <> 0").withColumns({"o_totalprice": F.when(F.col("o_orderkey") % 9 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")), "closed_us": F.when(F.col("o_orderkey") % 2 == 0, 1).cast("long")})
    return refresh.immutable_violations(before, after, "o_orderkey", "closed_us")


@query(f"WITH runs AS (SELECT DISTINCT user_id AS run_id FROM events) SELECT run_id FROM runs WHERE run_id NOT IN (SELECT user_id FROM events WHERE epoch_us(ts) > {AT})")
def review_visibility(spark, sf_dir):
    e = P.table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), clocks.micros(F.col("ts")).alias("recorded_us"))
    return refresh.effects_visible(e.select("run_id").distinct(), e, AT)


# ---------------------------------------------------------------- identity


@query("WITH u AS (SELECT c_name FROM customer GROUP BY 1 HAVING count(*) = 1), s AS (SELECT s_suppkey, 'Customer#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS key, s_nationkey FROM supplier) SELECT s_suppkey, c_custkey, CASE WHEN s_nationkey = c_nationkey THEN 1.0 ELSE 0.5 END::DOUBLE AS score FROM s JOIN customer c ON c.c_name = s.key WHERE c_name IN (SELECT c_name FROM u)")
def identity_candidates(spark, sf_dir):
    s = P.table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Customer#"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("key"), "s_nationkey")
    c = P.table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("key"), "c_nationkey")
    score = F.when(F.col("s_nationkey") == F.col("c_nationkey"), 1.0).otherwise(0.5)
    return identity.candidates(s, c, "key", score).select("s_suppkey", "c_custkey", "score")


@query("WITH g AS (SELECT o_custkey AS record, list_distinct(list(o_orderpriority)) AS v FROM orders GROUP BY 1) SELECT record, CASE WHEN len(v) = 1 THEN v[1] END AS priority, CASE WHEN len(v) > 1 THEN 'conflict' ELSE 'accepted' END AS reason FROM g")
def allowlist_single_values(spark, sf_dir):
    o = P.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("record"), F.col("o_orderpriority").alias("priority"))
    return identity.single_values(o, "record", "priority")


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_others FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def multiple_relations(spark, sf_dir):
    return identity.more_than_one(P.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"), "l_partkey", "l_suppkey")


@query("SELECT p_brand AS key, count(DISTINCT p_type || '|' || p_size) AS n_variants, count(*) AS n_rows FROM part GROUP BY 1")
def variant_dedup(spark, sf_dir):
    """Distinct variants of each registry key, repeats dropped, beside the number of rows."""
    p = P.table(spark, sf_dir, "part").select(F.col("p_brand").alias("key"), "p_type", "p_size")
    found = readers.variants(p, "key").select("key", F.size("variants").cast("long").alias("n_variants"))
    return found.join(p.groupBy("key").agg(F.count("*").alias("n_rows")), "key")


@query("WITH g AS (SELECT p_brand, p_type, p_size, min(p_partkey) AS anchor, count(*) AS members FROM part GROUP BY 1, 2, 3 HAVING count(*) > 1) SELECT p_partkey, anchor, members FROM part JOIN g USING (p_brand, p_type, p_size)")
def twin_rows(spark, sf_dir):
    p = P.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return identity.twins(p, "p_partkey", "p_brand", "p_type", "p_size")


# ---------------------------------------------------------------- intervals and evaluation

DIAG = f"""{MILE},
d AS (SELECT milestone_id, CASE WHEN milestone_id % 6 <> 0 THEN DATE '1998-03-01' END AS p_low, CASE WHEN milestone_id % 6 <> 0 THEN DATE '1998-09-01' END AS p_high,
  CASE WHEN milestone_id % 5 = 0 THEN 'right_censored' WHEN milestone_id % 5 = 1 THEN 'cancelled' WHEN milestone_id % 5 = 2 THEN 'unknown' ELSE 'observed' END AS status,
  low, base AS high, base AS through FROM mile),
r AS (SELECT *, CASE WHEN status IN ('observed','cancelled') THEN low WHEN status = 'right_censored' THEN through END AS a, CASE WHEN status IN ('observed','cancelled') THEN high WHEN status = 'right_censored' THEN through END AS b FROM d),
t AS (SELECT *, CASE WHEN a IS NULL THEN NULL WHEN b <= DATE '1998-01-01' THEN 'pre_vintage' WHEN a <= DATE '1998-01-01' THEN 'vintage_straddling' WHEN a > DATE '1999-01-01' THEN 'after_horizon' WHEN b > DATE '1999-01-01' THEN 'horizon_straddling' ELSE 'within_horizon' END AS temporal FROM r),
k AS (SELECT *, CASE WHEN p_low IS NULL THEN 'abstained' WHEN status = 'unknown' THEN 'unknown' WHEN status = 'right_censored' THEN CASE WHEN temporal = 'pre_vintage' THEN temporal WHEN through >= p_high THEN 'censored_window_miss' ELSE 'right_censored' END
  WHEN temporal <> 'within_horizon' THEN temporal WHEN status = 'cancelled' THEN 'cancelled' WHEN p_low <= low AND high <= p_high THEN 'contained' WHEN p_low <= high AND low <= p_high THEN 'overlapping' WHEN high < p_low THEN 'missed_early' ELSE 'missed_late' END AS classification FROM t)"""


@query(f"WITH {DIAG} SELECT milestone_id, temporal, classification, CASE WHEN classification = 'contained' THEN FALSE WHEN classification IN ('censored_window_miss','missed_early','missed_late') THEN TRUE END AS window_miss FROM k")
def interval_relation(spark, sf_dir):
    n = F.col("milestone_id")
    m = P.milestones(spark, sf_dir)
    day = lambda s: F.when(n % 6 != 0, F.lit(s).cast("date"))
    status = F.when(n % 5 == 0, "right_censored").when(n % 5 == 1, "cancelled").when(n % 5 == 2, "unknown").otherwise("observed")
    rows = m.select("milestone_id", day("1998-03-01").alias("p_low"), day("1998-09-01").alias("p_high"), status.alias("status"), "low", F.col("base").alias("high"), F.col("base").alias("through"))
    return intervals.diagnose(rows, "1998-01-01", "1999-01-01").select("milestone_id", "temporal", "classification", "window_miss")


@query(
    f"""WITH {MILE}, d AS (SELECT milestone_id, CASE milestone_id % 3 WHEN 0 THEN 'deadline' WHEN 1 THEN 'interval' END AS kind, CASE milestone_id % 3 WHEN 1 THEN DATE '1998-01-01' END AS t_low, CASE WHEN milestone_id % 3 < 2 THEN DATE '1999-01-01' END AS t_high,
  CASE milestone_id % 5 WHEN 0 THEN 'observed_by' WHEN 1 THEN 'explicit_nonoccurrence_through' WHEN 2 THEN 'unknown' ELSE 'observed' END AS status, low, high FROM mile),
c AS (SELECT *, CASE WHEN kind IS NULL THEN 'no_target' WHEN status = 'unknown' THEN status WHEN status = 'explicit_nonoccurrence_through' THEN CASE WHEN high >= t_high THEN 'censored_' || kind || '_miss' ELSE status END
  WHEN status = 'observed_by' AND kind = 'deadline' THEN CASE WHEN high <= t_high THEN 'deadline_met' ELSE 'deadline_upper_bound_unresolved' END
  WHEN status = 'observed_by' THEN CASE WHEN high < t_low THEN 'interval_missed_early' ELSE 'interval_upper_bound_unresolved' END
  WHEN kind = 'deadline' THEN CASE WHEN high <= t_high THEN 'deadline_met' WHEN low > t_high THEN 'deadline_missed_late' ELSE 'deadline_straddling' END
  WHEN t_low <= low AND high <= t_high THEN 'interval_contained' WHEN t_low <= high AND low <= t_high THEN 'interval_overlapping' WHEN high < t_low THEN 'interval_missed_early' ELSE 'interval_missed_late' END AS classification FROM d)
SELECT milestone_id, classification, CASE WHEN classification IN ('deadline_met','interval_contained') THEN TRUE WHEN classification LIKE '%\\_miss%' ESCAPE '\\' THEN FALSE END AS target_met FROM c"""
)
def deadline_outcomes(spark, sf_dir):
    n = F.col("milestone_id")
    kind = F.when(n % 3 == 0, "deadline").when(n % 3 == 1, "interval")
    status = F.when(n % 5 == 0, "observed_by").when(n % 5 == 1, "explicit_nonoccurrence_through").when(n % 5 == 2, "unknown").otherwise("observed")
    rows = P.milestones(spark, sf_dir).select("milestone_id", kind.alias("kind"), F.when(n % 3 == 1, F.lit("1998-01-01").cast("date")).alias("t_low"), F.when(n % 3 < 2, F.lit("1999-01-01").cast("date")).alias("t_high"), status.alias("status"), "low", "high")
    return intervals.target_outcome(rows).select("milestone_id", "classification", "target_met")


@query(f"WITH {MILE} SELECT status, CAST(min(base - high) AS INTEGER) AS error_low, CAST(max(base - low) AS INTEGER) AS error_high, count(*) AS cases FROM mile GROUP BY 1")
def timing_error_bounds(spark, sf_dir):
    m = P.milestones(spark, sf_dir)
    lo, hi = intervals.timing_error(F.col("low"), F.col("high"), F.col("base"))
    return m.groupBy("status").agg(F.min(lo).alias("error_low"), F.max(hi).alias("error_high"), F.count("*").alias("cases"))


@query(
    """WITH r AS (SELECT d.lang, CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' ELSE 'unlabelled' END AS truth, CASE WHEN n_chars > 1500 THEN 'candidate' WHEN n_chars > 300 THEN 'quiet' ELSE 'abstain' END AS decision FROM documents d LEFT JOIN labels l USING (doc_id)),
c AS (SELECT lang, count(*) AS cases, count(*) FILTER (truth = 'positive' AND decision = 'candidate') AS tp, count(*) FILTER (truth = 'negative' AND decision = 'candidate') AS fp, count(*) FILTER (truth = 'negative' AND decision = 'quiet') AS tn, count(*) FILTER (truth = 'positive' AND decision = 'quiet') AS fn,
  count(*) FILTER (truth = 'positive') AS positives, count(*) FILTER (decision = 'candidate') AS candidates, count(*) FILTER (decision = 'candidate' AND truth = 'unlabelled') AS unknown_candidates, count(*) FILTER (truth <> 'unlabelled') AS known FROM r GROUP BY GROUPING SETS ((lang), ()))
SELECT *, round(tp / nullif(tp + fp, 0)::DOUBLE, 9) AS support, round(tp / nullif(candidates, 0)::DOUBLE, 9) AS support_lower, round((tp + unknown_candidates) / nullif(candidates, 0)::DOUBLE, 9) AS support_upper, round(tp / nullif(positives, 0)::DOUBLE, 9) AS sensitivity, round(fp / nullif(cases, 0)::DOUBLE, 9) AS burden, round(known / nullif(cases, 0)::DOUBLE, 9) AS label_coverage FROM c"""
)
def confusion_bounds(spark, sf_dir):
    """Long documents as candidates for quality, by language and over all; unlabelled ones stay in the bounds."""
    d = P.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(P.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    truth = F.when(F.col("quality") == 1, "positive").when(F.col("quality") == 0, "negative").otherwise("unlabelled")
    decision = F.when(F.col("n_chars") > 1500, "candidate").when(F.col("n_chars") > 300, "quiet").otherwise("abstain")
    return evaluate.confusion_bounds(d.select("lang", truth.alias("truth"), decision.alias("decision")), ("lang",))


@query(
    f"""WITH t AS (SELECT event_id AS truth_id, user_id AS key, epoch_us(ts) AS a, epoch_us(ts) + 172800000000 AS dl FROM events WHERE event_type = 'error'), al AS (SELECT user_id AS key, epoch_us(ts) AS us, CASE WHEN event_id % 3 = 0 THEN 'supported' WHEN event_id % 3 = 1 THEN 'unresolved' ELSE 'false_positive' END AS verdict FROM events WHERE event_type = 'view'),
g AS (SELECT truth_id, a, dl, count(*) FILTER (verdict = 'supported') AS timely, count(*) FILTER (verdict = 'unresolved') AS potential FROM t LEFT JOIN al ON al.key = t.key AND a <= us AND us <= dl GROUP BY 1, 2, 3)
SELECT truth_id, timely, potential, CASE WHEN a < {SINCE} THEN 'prior_window_event' WHEN dl >= {END} THEN 'right_censored' WHEN timely > 0 THEN 'timely_detected' WHEN potential > 0 THEN 'unresolved_matching' ELSE 'missed_deadline' END AS status FROM g"""
)
def alert_outcomes(spark, sf_dir):
    e = P.table(spark, sf_dir, "events").withColumn("us", clocks.micros(F.col("ts")))
    truths = e.where("event_type = 'error'").select(F.col("event_id").alias("truth_id"), F.col("user_id").alias("key"), F.col("us").alias("available_us"), (F.col("us") + 172800000000).alias("deadline_us"))
    n = F.col("event_id") % 3
    alerts = e.where("event_type = 'view'").select(F.col("user_id").alias("key"), F.col("us").alias("admitted_us"), F.when(n == 0, "supported").when(n == 1, "unresolved").otherwise("false_positive").alias("verdict"))
    return evaluate.alert_outcomes(truths, alerts, SINCE, END)


@query(f"SELECT user_id, max(epoch_us(ts)) AS latest_us, CAST(1 AS BIGINT) AS tied, ({END} - max(epoch_us(ts))) / 1000000.0::DOUBLE AS age_seconds, ({END} - max(epoch_us(ts))) / 1000000.0::DOUBLE >= 1209600 AS stale FROM events GROUP BY 1")
def coverage_freshness(spark, sf_dir):
    rows = P.table(spark, sf_dir, "events").select("user_id", clocks.micros(F.col("ts")).alias("us"))
    return evaluate.freshness(rows, "user_id", END, 1209600)


@query(f"WITH u AS (SELECT DISTINCT user_id, epoch_us(ts) AS us FROM events), g AS (SELECT user_id, us, us - lag(us, 1, {START}) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM u) SELECT user_id, greatest(max(gap), {END} - max(us)) / 1000000.0::DOUBLE AS largest_gap_seconds FROM g GROUP BY 1")
def largest_gap(spark, sf_dir):
    rows = P.table(spark, sf_dir, "events").select("user_id", clocks.micros(F.col("ts")).alias("us"))
    return evaluate.largest_gap(rows, START, END, ("user_id",))


@query("SELECT user_id, " + ", ".join(f"CASE WHEN bool_or(event_type = '{k}') THEN 'supported' ELSE 'unknown' END AS {k}" for k in ("signup", "error", "click", "view", "purchase")) + " FROM events GROUP BY 1")
def presence_matrix(spark, sf_dir):
    return evaluate.presence(P.table(spark, sf_dir, "events"), "user_id", "event_type", ["signup", "error", "click", "view", "purchase"])


# ---------------------------------------------------------------- expressions

PARTIAL = "WITH p AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 3 THEN year(o_orderdate) || '-Q' || quarter(o_orderdate) WHEN 4 THEN year(o_orderdate) || '-H' || ((month(o_orderdate) - 1) // 6 + 1) ELSE 'soon' END AS v, CAST(o_orderdate AS DATE) AS d FROM orders)"


@query(
    f"""{PARTIAL} SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN CAST(date_trunc('year', d) AS DATE) WHEN 1 THEN CAST(date_trunc('month', d) AS DATE) WHEN 2 THEN d WHEN 3 THEN CAST(date_trunc('quarter', d) AS DATE) WHEN 4 THEN make_date(year(d), (month(d) - 1) // 6 * 6 + 1, 1) END AS first_day,
CASE o_orderkey % 6 WHEN 0 THEN make_date(year(d), 12, 31) WHEN 1 THEN last_day(d) WHEN 2 THEN d WHEN 3 THEN CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) WHEN 4 THEN last_day(make_date(year(d), (month(d) - 1) // 6 * 6 + 6, 1)) END AS last_day,
['year','month','day','quarter','half',NULL][o_orderkey % 6 + 1] AS date_precision FROM p"""
)
def partial_date_bounds(spark, sf_dir):
    o, d, n = P.table(spark, sf_dir, "orders"), F.col("o_orderdate"), F.col("o_orderkey") % 6
    y = F.year(d).cast("string")
    v = F.when(n == 0, y).when(n == 1, F.date_format(d, "yyyy-MM")).when(n == 2, F.date_format(d, "yyyy-MM-dd")).when(n == 3, F.concat(y, F.lit("-Q"), F.quarter(d).cast("string"))).when(n == 4, F.concat(y, F.lit("-H"), (F.floor((F.month(d) - 1) / 6) + 1).cast("string"))).otherwise("soon")
    a, b, k = clocks.partial_date(F.col("v"))
    return o.select("o_orderkey", v.alias("v")).select("o_orderkey", a.alias("first_day"), b.alias("last_day"), k.alias("date_precision"))


@query("SELECT doc_id, CASE WHEN regexp_matches(ltrim(cell), '^[=+\\-@]') OR regexp_matches(cell, '^[\\t\\r\\n]') THEN '''' || cell ELSE cell END AS cell FROM (SELECT doc_id, ['=', '+', '-', '@', ' =', 'x', chr(9), ''][doc_id % 8 + 1] || source AS cell FROM documents)")
def csv_escape(spark, sf_dir):
    d = P.table(spark, sf_dir, "documents")
    head = F.element_at(F.array(*[F.lit(x) for x in ("=", "+", "-", "@", " =", "x", "\t", "")]), (F.col("doc_id") % 8 + 1).cast("int"))
    return d.select("doc_id", F.concat(head, "source").alias("cell")).select("doc_id", text.safe_cell(F.col("cell")).alias("cell"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split(p_type, ' '), lambda x: x <> ''))), '|') AS tokens FROM part WHERE len(list_intersect(string_split(p_name, ' '), ['part', 'red', 'blue', 'steel'])) >= 0")
def token_filter(spark, sf_dir):
    return P.table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.tokens(F.col("p_type")), "|").alias("tokens"))


@query("SELECT doc_id, len(m) AS n, round(list_sum(list_transform(m, lambda x: CAST(regexp_extract(x, '([0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE))), 2) AS total FROM (SELECT doc_id, regexp_extract_all('cost $' || doc_id || '.25 and $' || (doc_id % 7) || '; ' || source, '\\$[0-9]+(\\.[0-9]+)?') AS m FROM documents)")
def money_extract(spark, sf_dir):
    d = P.table(spark, sf_dir, "documents")
    s = F.concat(F.lit("cost $"), F.col("doc_id").cast("string"), F.lit(".25 and $"), (F.col("doc_id") % 7).cast("string"), F.lit("; "), "source")
    m = text.amounts(s)
    return d.select("doc_id", F.size(m).cast("long").alias("n"), F.round(F.aggregate(m, F.lit(0.0), lambda a, x: a + x), 2).alias("total"))


@query("SELECT p_partkey, array_to_string(list_transform(list_sort(list_distinct(list_transform(regexp_extract_all('made on ' || p_size || ' mm and ' || (p_size + 1) || 'mm, ' || p_size || ' nm', '([0-9]+) ?mm', 1), lambda x: CAST(x AS INTEGER)))), lambda x: CAST(x AS VARCHAR)), ',') AS mm FROM part")
def text_capabilities(spark, sf_dir):
    size = F.col("p_size")
    s = F.concat(F.lit("made on "), size.cast("string"), F.lit(" mm and "), (size + 1).cast("string"), F.lit("mm, "), size.cast("string"), F.lit(" nm"))
    return P.table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(text.measures(s, "mm"), lambda x: x.cast("string")), ",").alias("mm"))


@query()
def visible_html_text(spark, sf_dir):
    """Visible text of every page, as its digest and length."""
    p = P.table(spark, sf_dir, "pages").select("page_id", "url", text.visible_text()("html").alias("t"))
    return p.select("page_id", "url", F.length("t").alias("n_chars"), F.sha2("t", 256).alias("sha256"))


@query("SELECT doc_id AS document_id, sha256(text) AS content_sha256 FROM documents")
def document_hash(spark, sf_dir):
    return P.documents(spark, sf_dir).select("document_id", "content_sha256")


@query("""WITH h AS (SELECT c_custkey, sha1(from_hex('6ba7b8119dad11d180b400c04fd430c8') || encode('["customer","' || c_name || '"]')) AS h FROM customer)
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || ['8','9','a','b'][(strpos('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1] || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS entity_uuid FROM h""")
def stable_ids(spark, sf_dir):
    """Name-based identifiers of entities from their kind and key."""
    ns = "6ba7b811-9dad-11d1-80b4-00c04fd430c8"
    return P.table(spark, sf_dir, "customer").select("c_custkey", ids.stable_id(ns, F.lit("customer"), F.col("c_name")).alias("entity_uuid"))


BOXES = [
    ("A", [[[-10.0, -10.0], [50.0, -10.0], [50.0, 40.0], [-10.0, 40.0], [-10.0, -10.0]], [[0.0, 0.0], [20.0, 0.0], [20.0, 20.0], [0.0, 20.0], [0.0, 0.0]]]),
    ("B", [[[-120.0, -60.0], [-60.0, -60.0], [-60.0, 10.0], [-120.0, 10.0], [-120.0, -60.0]]]),
    ("C", [[[100.0, 20.0], [170.0, 20.0], [135.0, 80.0], [100.0, 20.0]]]),
]


def _axis(i):
    return F.transform(F.col("rings")[0], lambda v: v[i])


@query(
    """WITH p AS (SELECT c_custkey, (c_custkey * 37 % 360) - 180.0::DOUBLE AS x, (c_custkey * 17 % 180) - 90.0::DOUBLE AS y FROM customer)
SELECT c_custkey, 'A' AS area FROM p WHERE x >= -10 AND x < 50 AND y >= -10 AND y < 40 AND NOT (x >= 0 AND x < 20 AND y >= 0 AND y < 20)
UNION ALL SELECT c_custkey, 'B' FROM p WHERE x >= -120 AND x < -60 AND y >= -60 AND y < 10
UNION ALL SELECT c_custkey, 'C' FROM p WHERE y >= 20 AND y < 80 AND x >= 35.0 * (y - 20) / 60.0 + 100 AND x < -35.0 * (y - 20) / 60.0 + 170"""
)
def point_in_polygon(spark, sf_dir):
    """Customers' points against five rings with a hole; the polygons are fixed and broadcast."""
    areas = spark.createDataFrame(BOXES, "area string, rings array<array<array<double>>>")
    box = areas.select("area", "rings", *[f(_axis(i)).alias(n) for n, f, i in (("x0", F.array_min, 0), ("x1", F.array_max, 0), ("y0", F.array_min, 1), ("y1", F.array_max, 1))])
    k = F.col("c_custkey")
    p = P.table(spark, sf_dir, "customer").select("c_custkey", (k * 37 % 360 - 180).cast("double").alias("x"), (k * 17 % 180 - 90).cast("double").alias("y"))
    near = p.join(F.broadcast(box), F.col("x").between(F.col("x0"), F.col("x1")) & F.col("y").between(F.col("y0"), F.col("y1")))
    return near.where(geo.in_polygon(F.col("x"), F.col("y"), F.col("rings"))).select("c_custkey", "area")


@query("SELECT n_name AS country, count(*) AS n, round(sum(c_acctbal), 2) AS total FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def grouped_counts(spark, sf_dir):
    """The published example for consumers: counts and sums by country."""
    n = F.broadcast(P.table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))  # a fixed table
    c = P.table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy(F.col("n_name").alias("country")).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"))


# ---------------------------------------------------------------- queues


def _queue(spark, sf_dir):
    """Conversations as queues: a user's turn observes a version, an assistant's decides it."""
    c = P.table(spark, sf_dir, "conversations")
    version = (F.length("text") % 3).cast("string")
    payload = F.to_json(F.struct(version.alias("version"), F.when(F.col("role") == "assistant", "resolved").alias("action")))
    kind = F.when(F.col("role") == "assistant", "decided").otherwise("observed")
    return c.select(F.col("conv_id").alias("queue"), F.col("turn").alias("sequence"), (F.col("turn") * 1000).alias("recorded_us"), kind.alias("kind"), payload.alias("payload"))


QUEUE = """q AS (SELECT conv_id AS queue, turn AS sequence, CAST(length(text) % 3 AS VARCHAR) AS version, role = 'assistant' AS decides,
  CASE WHEN role = 'assistant' THEN '{"version":"' || (length(text) % 3) || '","action":"resolved"}' ELSE '{"version":"' || (length(text) % 3) || '"}' END AS payload FROM conversations)"""


@query(
    f"""WITH RECURSIVE {QUEUE}, o AS (SELECT *, row_number() OVER (PARTITION BY queue ORDER BY sequence) AS k FROM q),
c(queue, k, sequence, previous_event_id, event_id) AS (
  SELECT queue, k, sequence, CAST(NULL AS VARCHAR), sha256('|' || sequence || '|' || payload) FROM o WHERE k = 1
  UNION ALL SELECT o.queue, o.k, o.sequence, c.event_id, sha256(c.event_id || '|' || o.sequence || '|' || o.payload) FROM c JOIN o ON o.queue = c.queue AND o.k = c.k + 1)
SELECT queue, sequence, previous_event_id, event_id FROM c"""
)
def event_chain(spark, sf_dir):
    return queues.chain(_queue(spark, sf_dir)).select("queue", "sequence", "previous_event_id", "event_id")


@query("SELECT conv_id AS queue, turn AS sequence, CASE WHEN turn = 2 THEN 'id' ELSE 'predecessor' END AS problem FROM conversations WHERE (turn = 2 AND conv_id % 5 = 0) OR (turn = 4 AND conv_id % 5 = 1)")
def event_chain_violations(spark, sf_dir):
    """A log in which some payloads were edited and some links were cut."""
    c, q = queues.chain(_queue(spark, sf_dir)), F.col("queue") % 5
    edited = c.withColumn("payload", F.when((F.col("sequence") == 2) & (q == 0), "{}").otherwise(F.col("payload")))
    cut = edited.withColumn("previous_event_id", F.when((F.col("sequence") == 4) & (q == 1), "x").otherwise(F.col("previous_event_id")))
    return queues.violations(cut)


@query(
    f"""WITH {QUEUE}, obs AS (SELECT queue, version, min(sequence) AS a, max(sequence) AS b, count(*) AS seen FROM q WHERE NOT decides GROUP BY 1, 2),
dec AS (SELECT q.queue, q.version, max(q.sequence) AS d FROM q JOIN obs ON obs.queue = q.queue AND obs.version = q.version WHERE decides AND q.sequence > a GROUP BY 1, 2)
SELECT o.queue, o.version, CASE WHEN d IS NULL THEN 'pending' ELSE 'resolved' END AS status, a * 1000 AS first_us, b * 1000 AS last_us, seen, coalesce(b > d, FALSE) AS reopen FROM obs o LEFT JOIN dec USING (queue, version)"""
)
def event_chain_fold(spark, sf_dir):
    return queues.fold(_queue(spark, sf_dir))


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS day_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def windowed_counts(spark, sf_dir):
    """Our extension: tumbling windows under a watermark (here over the whole table)."""
    e = P.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = queues.windowed_counts(e)
    return w.select(F.col("start").cast("timestamp_ntz").alias("day_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    """WITH v AS (SELECT DISTINCT user_id AS key, event_type AS version, epoch_us(date_trunc('day', ts)::TIMESTAMP) AS us FROM events),
d AS (SELECT DISTINCT key, us FROM v), p AS (SELECT key, us, lag(us) OVER (PARTITION BY key ORDER BY us) AS prev FROM d)
SELECT v.key, v.version, v.us FROM v JOIN p USING (key, us) WHERE EXISTS (SELECT 1 FROM v w WHERE w.key = v.key AND w.us = p.prev AND w.version <> v.version)"""
)
def version_recurrences(spark, sf_dir):
    e = P.table(spark, sf_dir, "events")
    return queues.recurrences(e.select(F.col("user_id").alias("key"), F.col("event_type").alias("version"), clocks.micros(F.date_trunc("day", F.col("ts").cast("timestamp"))).alias("us")))


# ---------------------------------------------------------------- facility rules

def _text(*parts):
    """A text put together from words and columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _if(test, words):
    return F.when(test, words).otherwise("")


@query(
    """WITH z AS (SELECT p_partkey, p_size AS z, [100, 150, 200, 300, 450][p_size % 5 + 1] AS mm FROM part)
SELECT p_partkey, array_to_string(list_sort(list_filter([CASE WHEN z % 2 = 0 THEN 'wafer_fabrication' END, CASE WHEN z % 3 = 0 THEN 'photomask' END, CASE WHEN z % 5 = 0 THEN 'assembly' END, CASE WHEN z % 7 = 0 THEN 'power_semiconductor' END], lambda x: x IS NOT NULL)), ',') AS activities,
  array_to_string(list_sort(list_distinct(list_filter([CAST(mm AS INTEGER), CASE WHEN z % 4 = 0 THEN 300 END], lambda x: x IS NOT NULL))), ',') AS wafers, array_to_string(list_sort(list_distinct([z % 60 + 1, z + 7])), ',') AS nodes,
  CASE WHEN z % 6 = 0 THEN z * 1000 + 500 END AS sqft FROM z"""
)
def facility_text(spark, sf_dir):
    z, t = F.col("p_size"), F.col("t")
    mm = F.element_at(F.array(*[F.lit(x) for x in (100, 150, 200, 300, 450)]), z % 5 + 1)
    words = _text("Fabulous", _if(z % 2 == 0, " Foundry"), _if(z % 3 == 0, " mask blank"), _if(z % 5 == 0, " ASSEMBLY"), _if(z % 7 == 0, " GaN"), " lines of ", mm, "-mm", _if(z % 4 == 0, " and 300 MM"), " and 1", z % 10, "1 mm at ", z % 60 + 1, " nm, ", z + 7, "nm", _if(z % 6 == 0, F.concat(F.lit(" in "), z.cast("string"), F.lit(",500 square feet of cleanroom"))))
    p = P.table(spark, sf_dir, "part").select("p_partkey", words.alias("t"))
    join = lambda c: F.array_join(c.cast("array<int>").cast("array<string>"), ",")
    return p.select("p_partkey", F.array_join(facilities.activities(t), ",").alias("activities"), join(facilities.wafer_sizes(t)).alias("wafers"), join(facilities.nodes(t)).alias("nodes"), facilities.cleanroom_sqft(t).alias("sqft"))


@query(
    """SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN CAST(p_size * 1000 + 250 AS BIGINT) * CASE WHEN p_size % 2 = 0 THEN 1000000 ELSE 1000000000 END END AS amount,
CASE WHEN p_size % 7 <> 0 THEN CASE WHEN p_size % 3 = 0 AND p_size % 5 = 0 THEN 'proposed_up_to' WHEN p_size % 5 = 0 THEN 'proposed' WHEN p_size % 3 = 0 THEN 'up_to' ELSE 'reported_amount' END END AS qualifier,
CASE WHEN p_size % 7 <> 0 THEN CASE WHEN p_size % 4 = 0 THEN 'multi_site_shared' ELSE 'site' END END AS award_scope FROM part"""
)
def award_amounts(spark, sf_dir):
    z = F.col("p_size")
    a, q, s = facilities.award_amount(F.col("t"))
    line = _text("Award Amount", _if(z % 7 != 0, ":"), " ", _if(z % 3 == 0, "Up to "), "$", z, ",250 ", F.when(z % 2 == 0, "Million").otherwise("billion"), " in ", _if(z % 5 == 0, "PROPOSED "), "direct funding", _if(z % 4 == 0, " (split across three sites)"))
    return P.table(spark, sf_dir, "part").select("p_partkey", line.alias("t")).select("p_partkey", a.alias("amount"), q.alias("qualifier"), s.alias("award_scope"))


@query(
    """WITH t AS (SELECT p_partkey, p_size % 4 = 0 AS has_p, p_size % 3 = 0 AS no_p, p_size % 5 < 2 AS has_c, p_partkey % 3 = 0 AS no_c, p_partkey % 2 = 0 AS b FROM part)
SELECT p_partkey, CASE WHEN has_p AND NOT no_p THEN 'announced' WHEN has_c AND NOT no_c THEN 'under_construction' WHEN b THEN 'under_construction' ELSE 'unknown' END AS stage,
  CASE WHEN has_p AND NOT no_p THEN 0.65 WHEN has_c AND NOT no_c THEN 0.72 WHEN b THEN 0.65 ELSE 0.35 END::DOUBLE AS confidence FROM t"""
)
def map_lifecycle(spark, sf_dir):
    """Stages from tags that contradict and deny one another."""
    z, k = F.col("p_size"), F.col("p_partkey")
    pair = lambda test, key, value: F.when(test, F.struct(F.lit(key).alias("key"), value.alias("value")))
    tags = F.map_from_entries(F.array_compact(F.array(pair(z % 4 == 0, "Proposed:industrial", F.when(z % 3 == 0, "Not Proposed").otherwise("works")), pair(z % 5 < 2, " construction", F.when(k % 3 == 0, "NO").otherwise("Factory")), pair(k % 2 == 0, "building", F.lit("Construction")), pair(F.lit(True), "name", F.lit("x")))))
    return P.table(spark, sf_dir, "part").select("p_partkey", facilities.lifecycle(tags).alias("l")).select("p_partkey", "l.stage", F.col("l.confidence").cast("double").alias("confidence"))


@query(
    """SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size % 3 = 0 OR p_size % 7 = 0 THEN 'materials' END, CASE WHEN p_size % 2 = 0 THEN 'photomask' END, CASE WHEN p_size % 5 = 0 THEN 'semiconductor_manufacturing_candidate' END], lambda x: x IS NOT NULL), ',') AS activities FROM part"""
)
def map_activities(spark, sf_dir):
    """Activities from the products that map tags list."""
    z = F.col("p_size")
    tags = F.create_map(F.lit("product"), _text("x", _if(z % 3 == 0, "; Silicon Wafers"), _if(z % 2 == 0, ";photomask")), F.lit("construction:industrial"), _text(_if(z % 5 == 0, "micro-chip;Microchip"), _if(z % 7 == 0, ";semiconductor-wafer")), F.lit("note"), F.lit("photomasks"))
    return P.table(spark, sf_dir, "part").select("p_partkey", F.array_join(facilities.map_activities(tags), ",").alias("activities"))


@query(
    """WITH r AS (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN lpad(c_custkey || '', 8, 'a') WHEN 1 THEN lpad(c_custkey || '', 10, '7') WHEN 2 THEN '12-' || lpad(c_custkey || '', 6, '0') || '-34' WHEN 3 THEN '99-b' || lpad(c_custkey || '', 5, '0') || '-01' WHEN 4 THEN '31-' || lpad(c_custkey || '', 8, '0')
  WHEN 5 THEN lpad(c_custkey || '', 8, 'z') || chr(10) ELSE '1-' || c_custkey END AS raw FROM customer)
SELECT c_custkey, CASE WHEN regexp_full_match(upper(raw), '[A-Z0-9]{8}') THEN upper(raw) WHEN regexp_full_match(raw, '[0-9]{10}|[0-9]{2}-[0-9]{6}-[0-9]{2}|[0-9]{2}-[A-Za-z][0-9]{5}-[0-9]{2}|[0-9]{2}-[0-9]{8}') THEN upper(replace(raw, '-', ''))[:8] END AS number FROM r"""
)
def registration_numbers(spark, sf_dir):
    """Current and legacy shapes; other shapes, and one with a line feed at its end, are none."""
    k = F.col("c_custkey")
    pad = lambda n, c: F.lpad(k.cast("string"), n, c)
    raw = F.when(k % 7 == 0, pad(8, "a")).when(k % 7 == 1, pad(10, "7")).when(k % 7 == 2, _text("12-", pad(6, "0"), "-34")).when(k % 7 == 3, _text("99-b", pad(5, "0"), "-01")).when(k % 7 == 4, _text("31-", pad(8, "0"))).when(k % 7 == 5, _text(pad(8, "z"), "\n")).otherwise(_text("1-", k))
    return P.table(spark, sf_dir, "customer").select("c_custkey", facilities.registration_number(raw).alias("number"))


@query("WITH p AS (SELECT c_custkey, (c_custkey * 37 % 1600) / 100.0 + 112 AS x, (c_custkey * 17 % 1200) / 100.0 + 18 AS y FROM customer) SELECT c_custkey, c_custkey % 9 <> 4 AND c_custkey % 11 <> 5 AND x BETWEEN 118 AND 123 AND y BETWEEN 21 AND 27 AS sound FROM p")
def valid_points(spark, sf_dir):
    """Points inside a box, from decimal text; an exponent or a line feed is not decimal."""
    k = F.col("c_custkey")
    coordinate = lambda n, whole, mark: _text(F.floor(n / 100) + whole, ".", F.lpad((n % 100).cast("string"), 2, "0"), mark)
    lon = coordinate(k * 37 % 1600, 112, _if(k % 9 == 4, "e0"))
    lat = coordinate(k * 17 % 1200, 18, _if(k % 11 == 5, "\n"))
    return P.table(spark, sf_dir, "customer").select("c_custkey", facilities.point_in_box(lon, lat, (118, 21, 123, 27)).alias("sound"))


@query("SELECT p_partkey FROM part WHERE p_size IN (7, 11)")
def exact_code_filter(spark, sf_dir):
    """Registry rows one of whose separated codes is exactly one of the wanted ones."""
    p = P.table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("x7, "), F.col("p_size").cast("string"), F.lit(" ,110")).alias("codes"))
    return p.where(readers.has_code(F.col("codes"), ["7", "11"])).select("p_partkey")


@query("SELECT s_nationkey AS key, count(DISTINCT s_acctbal > 0) AS n_variants FROM supplier GROUP BY 1")
def registry_variants(spark, sf_dir):
    s = P.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("key"), (F.col("s_acctbal") > 0).alias("flag"))
    return readers.variants(s, "key").select("key", F.size("variants").cast("long").alias("n_variants"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INTEGER) END AS starts, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS ends FROM orders")
def interval_intersections(spark, sf_dir):
    d, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    starts = F.array(d, F.when(k % 3 == 0, F.date_add(d, 40)).otherwise(F.date_add(d, (k % 20).cast("int"))))
    a, b = facilities.interval_intersection(starts, F.array(F.lit(None).cast("date"), F.date_add(d, 30)))
    return P.table(spark, sf_dir, "orders").select("o_orderkey", a.alias("starts"), b.alias("ends"))


@query(
    """WITH t AS (SELECT p_partkey, DATE '2024-06-01' AS a, DATE '2024-06-01' + 30 AS b, DATE '2024-06-01' + CAST((p_size % 13 - 6) * 8 AS INTEGER) AS c, DATE '2024-06-01' + CAST((p_size % 13 - 6) * 8 + p_size % 3 * 15 AS INTEGER) AS d FROM part)
SELECT p_partkey, CASE WHEN a = c AND b = d THEN 'reaffirmation' WHEN d < a THEN 'disjoint_earlier' WHEN c > b THEN 'disjoint_later' ELSE 'overlapping_changed' END AS comparison FROM t"""
)
def period_comparison(spark, sf_dir):
    z, d = F.col("p_size"), F.lit("2024-06-01").cast("date")
    low = F.date_add(d, (z % 13 - 6) * 8)
    return P.table(spark, sf_dir, "part").select("p_partkey", changes.compare_periods(d, F.date_add(d, 30), low, F.date_add(low, z % 3 * 15)).alias("comparison"))


@query("""SELECT '{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","note":null}' AS value FROM customer""")
def canonical_json_lines(spark, sf_dir):
    return exports.json_lines(P.table(spark, sf_dir, "customer").select("c_name", "c_mktsegment", F.lit(None).cast("string").alias("note")))


@query("""SELECT '{"type":"Feature","id":' || c_custkey || ',"geometry":{"type":"Point","coordinates":[' || ((c_custkey * 37 % 360) - 180) || '.0,' || ((c_custkey * 17 % 180) - 90) || '.0]},"properties":{"c_custkey":' || c_custkey || '}}' AS value FROM customer""")
def geojson_features(spark, sf_dir):
    k = F.col("c_custkey")
    p = P.table(spark, sf_dir, "customer").select("c_custkey", (k * 37 % 360 - 180).cast("double").alias("lon"), (k * 17 % 180 - 90).cast("double").alias("lat"))
    return exports.features(p, "c_custkey", "lon", "lat")


# ---------------------------------------------------------------- releases and ledgers

DOCS = "d AS (SELECT doc_id AS document_id, source, lang AS family, doc_id * 1000 AS retrieved_us FROM documents), runs AS (SELECT event_id % (SELECT count(*) FROM documents) AS document_id, epoch_us(ts) AS started_us FROM events)"


@query(
    f"""WITH {DOCS}, acc AS (SELECT document_id, min(started_us) AS accepted_us FROM runs WHERE started_us <= {AT} GROUP BY 1),
m AS (SELECT d.document_id, source, CASE WHEN source IN ('src1', 'src2') THEN 'moved' ELSE family END AS family, retrieved_us, accepted_us FROM d JOIN acc USING (document_id))
SELECT family, count(DISTINCT source) AS sources, count(*) AS documents, min(retrieved_us) AS first_retrieved_us, max(retrieved_us) AS last_retrieved_us, min(accepted_us) AS first_accepted_us, max(accepted_us) AS last_accepted_us FROM m GROUP BY 1"""
)
def source_families(spark, sf_dir):
    """Accepted documents by family, where reviewed assignments moved two sources (and a later one is not yet known)."""
    d = P.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), "source", F.col("lang").alias("family"), (F.col("doc_id") * 1000).alias("retrieved_us"))
    n = F.broadcast(P.table(spark, sf_dir, "documents").agg(F.count("*").alias("n")))  # one row
    runs = P.table(spark, sf_dir, "events").join(n).select((F.col("event_id") % F.col("n")).alias("document_id"), clocks.micros(F.col("ts")).alias("started_us"))
    moves = spark.createDataFrame([("src1", "moved", 1), ("src2", "other", 1), ("src2", "moved", 2), ("src3", "late", AT + 1)], "source string, new_family string, recorded_us long")
    return release.families(d, runs, release.current_family(moves, AT), AT)


@query(f"WITH r AS (SELECT user_id AS run_id, max(epoch_us(ts)) AS completed_us FROM events GROUP BY 1), i AS (SELECT user_id AS run_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS inputs FROM events WHERE value > 50 GROUP BY 1), s AS (SELECT user_id AS run_id, string_agg(DISTINCT CAST(event_id % 3 AS VARCHAR), ',' ORDER BY CAST(event_id % 3 AS VARCHAR)) AS scopes FROM events WHERE event_id % 10 = 0 GROUP BY 1) SELECT run_id, coalesce(inputs, '') AS inputs, coalesce(scopes, '') AS scopes FROM r LEFT JOIN i USING (run_id) LEFT JOIN s USING (run_id) WHERE completed_us <= {END}")
def resolution_runs(spark, sf_dir):
    e = P.table(spark, sf_dir, "events").withColumn("run_id", F.col("user_id"))
    runs = e.groupBy("run_id").agg(F.max(clocks.micros(F.col("ts"))).alias("completed_us"))
    inputs = e.where("value > 50").select("run_id", F.col("event_type").alias("input"))
    scopes = e.where("event_id % 10 = 0").select("run_id", (F.col("event_id") % 3).cast("string").alias("scope"))
    out = release.runs_with_lists(runs, inputs, scopes, END)
    return out.select("run_id", F.array_join("inputs", ",").alias("inputs"), F.array_join("scopes", ",").alias("scopes"))


@query(f"WITH {ASSIGN} SELECT assignment_id, observed_id, CASE WHEN recorded_us + 864000000000 <= 896659200000000 THEN recorded_us + 864000000000 END AS superseded_us FROM assign WHERE valid_from <= DATE '1998-06-01' AND recorded_us <= 896659200000000 AND assignment_id % 11 <> 0")
def assignment_history(spark, sf_dir):
    """Assignments known at an instant whose decisions were known too, ended ones included."""
    a = P.assignments(spark, sf_dir).withColumns({"superseded_us": F.col("recorded_us") + 864000000000, "decision_id": F.col("assignment_id")})
    decisions = a.select("decision_id", F.when(F.col("assignment_id") % 11 != 0, F.col("recorded_us")).alias("decided_us"))
    return release.assignment_history(a, decisions, "1998-06-01", 896659200000000).select("assignment_id", "observed_id", "superseded_us")


@query(
    f"""WITH {DEPS}, {EVIDENCE}, c AS (SELECT event_id AS id, user_id FROM events WHERE event_type = 'purchase'), m AS (SELECT event_id AS id, user_id FROM events WHERE event_type = 'view'),
lineage AS (SELECT c.id AS c, m.id AS m FROM c JOIN deps d ON d.child = c.id JOIN m ON m.id = d.parent WHERE c.user_id = m.user_id
  UNION SELECT c.id, m.id FROM m JOIN deps d ON d.child = m.id JOIN c ON c.id = d.parent WHERE c.user_id = m.user_id
  UNION SELECT c.id, m.id FROM c JOIN deps d ON d.child = c.id JOIN deps e ON e.parent = d.parent JOIN m ON m.id = e.child WHERE c.user_id = m.user_id),
shared AS (SELECT c.id AS c, m.id AS m FROM c JOIN evidence a ON a.claim_id = c.id JOIN evidence b ON b.document_id = a.document_id JOIN m ON m.id = b.claim_id WHERE c.user_id = m.user_id)
SELECT c AS capacity_id, m AS milestone_id, CASE WHEN min(k) = 0 THEN 'claim_lineage' ELSE 'shared_document' END AS link FROM (SELECT c, m, 0 AS k FROM lineage UNION ALL SELECT c, m, 1 FROM shared) GROUP BY 1, 2"""
)
def capacity_milestone_links(spark, sf_dir):
    e = P.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("entity_id"), "event_type")
    docs = P.evidence(spark, sf_dir).select(F.col("claim_id").alias("id"), "document_id")
    return release.linked(e.where("event_type = 'purchase'"), e.where("event_type = 'view'"), P.dependencies(spark, sf_dir), docs)


@query("SELECT CASE WHEN p_type LIKE 'PROMO%' THEN 'promotion' WHEN p_type LIKE 'STANDARD%' THEN 'standard' ELSE 'other' END AS namespace, count(*) AS n, round(count(*) / (SELECT count(*) FROM part)::DOUBLE, 6) AS share FROM part GROUP BY 1")
def coverage_namespaces(spark, sf_dir):
    return release.namespaces(P.table(spark, sf_dir, "part"), "p_type", {"PROMO": "promotion", "STANDARD": "standard"})


@query("SELECT o_custkey AS entity_id, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) END AS status, CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) END AS priority, CASE WHEN count(DISTINCT o_orderstatus) > 1 AND count(DISTINCT o_orderpriority) > 1 THEN 'status,priority' WHEN count(DISTINCT o_orderstatus) > 1 THEN 'status' WHEN count(DISTINCT o_orderpriority) > 1 THEN 'priority' ELSE '' END AS conflicts FROM orders GROUP BY 1")
def registry_pivot(spark, sf_dir):
    o = P.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("entity_id"), F.inline(F.array(F.struct(F.lit("status").alias("predicate"), F.col("o_orderstatus").alias("value")), F.struct(F.lit("priority").alias("predicate"), F.col("o_orderpriority").alias("value")))))
    return release.source_pivot(o, ["status", "priority"]).withColumn("conflicts", F.array_join("conflicts", ","))


@query("WITH m AS (SELECT s_suppkey AS entity_id, s_nationkey AS program FROM supplier), s AS (SELECT DISTINCT program, entity_id AS origin, 'says ' || entity_id AS statement FROM m WHERE entity_id % 3 = 0) SELECT m.entity_id, program, origin, statement FROM m JOIN s USING (program)")
def shared_statements(spark, sf_dir):
    m = P.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity_id"), F.col("s_nationkey").alias("program"))
    s = m.where("entity_id % 3 = 0").select("entity_id", F.concat(F.lit("says "), F.col("entity_id").cast("string")).alias("statement"))
    return release.propagated(m, s)


@query("WITH m AS (SELECT c_custkey AS record_id, ['2023','2024-05','2024-05-01'][c_custkey % 3 + 1] AS as_of, CASE WHEN c_custkey % 2 = 0 THEN 'USD' ELSE 'EUR' END AS unit FROM customer) SELECT record_id, CASE WHEN record_id % 3 = 0 OR record_id % 2 = 0 THEN 'USD' ELSE 'EUR' END AS unit, CASE WHEN record_id % 3 = 0 THEN 7.0 WHEN record_id % 2 = 0 THEN 5.0 ELSE 5.0 END::DOUBLE AS value FROM m")
def headline_investments(spark, sf_dir):
    """Two figures a record: the later one leads; equal dates prefer dollars."""
    k = F.col("c_custkey")
    as_of = F.element_at(F.array(F.lit("2023"), F.lit("2024-05"), F.lit("2024-05-01")), (k % 3 + 1).cast("int"))
    figure = lambda scope, when, unit, value: F.struct(F.lit("investment").alias("metric"), F.lit(scope).alias("applies_to"), when.alias("as_of"), unit.alias("unit"), F.lit(value).alias("value"), F.lit(None).cast("double").alias("value_max"), F.lit("exact").alias("qualifier"))
    first = figure("project", as_of, F.when(k % 2 == 0, "USD").otherwise("EUR"), 5.0)
    later, phase = figure("facility", F.lit("2024-Q1"), F.lit("USD"), 7.0), figure("phase", F.lit("2025"), F.lit("USD"), 9.0)
    rows = P.table(spark, sf_dir, "customer").select(k.alias("id"), F.array(first, later, phase).alias("metrics"))
    return curated.headline_investment(curated.child(rows, "metrics")).select("record_id", "unit", "value")


@query(
    """WITH t AS (SELECT o_orderkey, o_custkey % 3 AS v, o_custkey % 3 || '/' || o_orderkey % 2 AS raw FROM orders), u AS (SELECT *, lag(v) OVER w AS pv, lag(raw) OVER w AS praw FROM t WINDOW w AS (ORDER BY o_orderkey))
SELECT o_orderkey, CASE WHEN praw IS NULL THEN 'first' WHEN raw = praw THEN 'unchanged' WHEN v = pv THEN 'raw_bytes_only' ELSE 'visible_text_changed' END AS change FROM u WHERE o_orderkey % 4 <> 0"""
)
def document_changes(spark, sf_dir):
    """Each capture against the one before it: here the order with the next smaller key."""
    o = P.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 3).cast("string").alias("v"), (F.col("o_orderkey") % 2).cast("string").alias("w"))
    h = lambda *c: F.sha2(F.concat_ws("/", *c), 256)
    rows = o.select("o_orderkey", h("v", "w").alias("raw"), h("v").alias("visible"))
    # neighbours by key: the keys before are met within runs of 1,000 keys and at their edges
    run = rows.withColumn("run", F.floor(F.col("o_orderkey") / 1000))
    inner = Window.partitionBy("run").orderBy("o_orderkey")
    own = run.withColumns({"p_raw": F.lag("raw").over(inner), "p_visible": F.lag("visible").over(inner), "first": F.row_number().over(inner) == 1})
    edge = run.groupBy("run").agg(F.max_by(F.struct("raw", "visible"), "o_orderkey").alias("last"))
    before = edge.select("run", F.lag("last").over(Window.orderBy("run")).alias("last"))  # one row a run
    both = own.join(before, "run").withColumns({"p_raw": F.when(F.col("first"), F.col("last.raw")).otherwise(F.col("p_raw")), "p_visible": F.when(F.col("first"), F.col("last.visible")).otherwise(F.col("p_visible"))})
    return both.where("o_orderkey % 4 <> 0").select("o_orderkey", curated.document_change(F.col("raw"), F.col("p_raw"), F.col("visible"), F.col("p_visible")).alias("change"))


@query(
    f"""WITH o AS (SELECT user_id AS document_id, epoch_us(date_trunc('day', ts)::TIMESTAMP) AS us, event_type AS status, event_type AS v FROM events),
l AS (SELECT document_id, max(us) AS last_us, max(us) FILTER (status IN ('click', 'view')) AS good_us, count(*) AS checks FROM o GROUP BY 1),
g AS (SELECT l.document_id, good_us, checks, count(*) FILTER (us = last_us AND status NOT IN ('click', 'view')) AS bad, count(DISTINCT CASE WHEN us = good_us AND status IN ('click', 'view') THEN v END) AS versions FROM o JOIN l USING (document_id) GROUP BY 1, 2, 3)
SELECT document_id, checks, CASE WHEN good_us IS NULL THEN 'never_observed' WHEN ({END} - good_us) / 1000000.0 >= 432000 THEN 'stale' ELSE 'fresh' END AS freshness, CASE WHEN bad > 0 THEN 'requires_attention' WHEN versions > 1 THEN 'conflicting_observations' ELSE 'ok' END AS health FROM g"""
)
def check_health(spark, sf_dir):
    e = P.table(spark, sf_dir, "events")
    day = clocks.micros(F.date_trunc("day", F.col("ts").cast("timestamp")))
    rows = e.select(F.col("user_id").alias("document_id"), day.alias("us"), F.col("event_type").alias("status"), F.col("event_type").alias("text_sha256"))
    return curated.check_health(rows, ["click", "view"], END, 432000)


@query("SELECT url, min(page_id) AS first_us, max(page_id) AS last_us, string_agg(DISTINCT CAST(page_id % 4 AS VARCHAR), ',' ORDER BY CAST(page_id % 4 AS VARCHAR)) AS matches FROM pages GROUP BY 1")
def discovery_inventory(spark, sf_dir):
    p = P.table(spark, sf_dir, "pages").select("url", F.col("page_id").alias("us"), F.array((F.col("page_id") % 4).cast("string")).alias("matches"))
    return curated.inventory(p).withColumn("matches", F.array_join("matches", ","))


@query("SELECT c_custkey AS case_id, CASE WHEN d IS NULL THEN 'missing' WHEN d <= DATE '1997-01-01' THEN 'on_time' ELSE 'late' END AS recording FROM customer LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS d FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def recording_journal(spark, sf_dir):
    due = P.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("case_id"), F.lit(852076800000000).alias("due_us"))
    got = P.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("case_id"), clocks.micros(F.col("o_orderdate")).alias("recorded_us"))
    return curated.journal(due, got).select("case_id", "recording")


@query("SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderpriority) AS \"distinct\", count(*) - count(DISTINCT o_orderpriority) AS repeated FROM orders GROUP BY 1")
def statement_repeats(spark, sf_dir):
    return curated.repeats(P.table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query("WITH a AS (SELECT DISTINCT o_custkey AS url FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'), b AS (SELECT DISTINCT o_custkey AS url FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') SELECT coalesce(a.url, b.url) AS url, CASE WHEN a.url IS NULL THEN 'only_after' WHEN b.url IS NULL THEN 'only_before' ELSE 'both' END AS presence FROM a FULL JOIN b ON a.url = b.url")
def vintage_presence(spark, sf_dir):
    o = P.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("url"), "o_orderdate")
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    return curated.vintages(o.where(F.col("o_orderdate") < stamp("1996-01-01")), o.where(F.col("o_orderdate") >= stamp("2001-01-01")))


@query(
    f"""WITH {CAP}, p AS (SELECT capacity_id, CASE WHEN capacity_id % 5 = 0 THEN DATE '2024-01-01' + CAST(capacity_id % 3000 AS INTEGER) END AS s, CASE WHEN capacity_id % 7 = 0 THEN DATE '2023-06-01' + CAST(capacity_id % 3500 AS INTEGER) END AS e, start_base FROM capacity)
SELECT capacity_id, CASE WHEN e <= DATE '2024-01-01' THEN 'expired_capacity_period' WHEN s >= DATE '2029-01-01' THEN 'capacity_period_outside_horizon' WHEN e < DATE '2029-01-01' THEN 'capacity_period_ends_within_horizon' WHEN s > DATE '2024-01-01' AND start_base IS NULL THEN 'future_capacity_period_without_linked_milestone' WHEN s > DATE '2024-01-01' AND start_base < s THEN 'capacity_period_milestone_mismatch' END AS reason FROM p"""
)
def period_exclusions(spark, sf_dir):
    k, d = F.col("capacity_id"), lambda s: F.lit(s).cast("date")
    s = F.when(k % 5 == 0, F.date_add(d("2024-01-01"), (k % 3000).cast("int")))
    e = F.when(k % 7 == 0, F.date_add(d("2023-06-01"), (k % 3500).cast("int")))
    return _capacity(spark, sf_dir).select("capacity_id", facilities.period_exclusion(s, e, d("2024-01-01"), d("2029-01-01"), F.col("start_base")).alias("reason"))


@query(
    """WITH z AS (SELECT p_partkey, p_size AS z, 2025 + p_size % 6 AS y, p_size % 2 = 0 AS mass, p_size % 7 <> 0 AS ahead, p_size % 3 <> 0 AS told FROM part),
w AS (SELECT *, CASE z % 5 WHEN 0 THEN y || '-01-01 ' || y || '-04-01 ' || y || '-06-30' WHEN 1 THEN y || '-07-01 ' || y || '-10-01 ' || y || '-12-31' WHEN 2 THEN y || '-06-01 ' || y || '-07-15 ' || y || '-08-31' WHEN 3 THEN y || '-10-01 ' || y || '-12-01 ' || y || '-12-31' ELSE y || '-01-01 ' || y || '-07-01 ' || y || '-12-31' END AS days FROM z)
SELECT p_partkey, CASE WHEN ahead THEN CASE WHEN mass THEN 'mass_production ' ELSE 'production_start ' END || days ELSE '' END AS windows,
  array_to_string(list_filter([CASE WHEN told THEN (z * 1000 + 500) || '.0 wafers month' END, CASE WHEN z % 4 = 0 THEN (z * 1000000) || '.0 chips year' END], lambda x: x IS NOT NULL), ';') AS rates FROM w"""
)
def production_text(spark, sf_dir):
    """Production windows and forward-looking rates; rates of the past, and items or periods of other kinds, are none."""
    z, t = F.col("p_size"), F.col("t")
    when = F.element_at(F.array(*[F.lit(x) for x in ("the first half of ", "the second half of ", "Summer ", "the end of ", "")]), z % 5 + 1)
    words = _text(
        F.when(z % 2 == 0, "Mass production ").otherwise("Production "), F.when(z % 7 != 0, "is expected to begin in ").otherwise("began in "), when, z % 6 + 2025, ". Nothing else in 2030.\nThe fab ",
        F.when(z % 3 != 0, "is planned to produce about ").otherwise("made "), z, ",500 wafers per month and 7 panels per month. It made 9 wafers per day",
        _if(z % 4 == 0, F.concat(F.lit(". It will have a capacity of "), z.cast("string"), F.lit(" million chips each year and 3 units a week"))), ".",
    )
    windows = F.transform(facilities.timeline(t), lambda w: F.concat_ws(" ", w["milestone"], w["low"], w["base"], w["high"]))
    sorted_ = F.array_sort(F.transform(facilities.throughput(t), lambda r: F.struct(r["item"].alias("i"), F.format_string("%.1f", r["value"]).alias("v"), r["period"].alias("p"))))
    rates = F.transform(F.reverse(sorted_), lambda r: F.concat_ws(" ", r["v"], r["i"], r["p"]))
    return P.table(spark, sf_dir, "part").select("p_partkey", words.alias("t")).select("p_partkey", F.array_join(windows, ";").alias("windows"), F.array_join(rates, ";").alias("rates"))


@query("WITH r AS (SELECT o_custkey AS project, o_orderstatus AS disposition, CASE WHEN o_orderkey % 3 = 0 THEN TRUE WHEN o_orderkey % 3 = 1 THEN FALSE END AS met FROM orders) SELECT disposition, count(*) AS cases, count(DISTINCT project) AS projects, count(*) FILTER (met) AS met, count(*) FILTER (NOT met) AS missed, count(*) FILTER (met IS NULL) AS unresolved FROM r GROUP BY 1")
def roster_score(spark, sf_dir):
    k = F.col("o_orderkey") % 3
    rows = P.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("project"), F.col("o_orderstatus").alias("disposition"), F.when(k == 0, True).when(k == 1, False).alias("target_met"))
    return curated.roster_score(rows)


@query("SELECT p_partkey, CASE WHEN p_size > 45 AND p_retailprice < 1000 THEN 'price,size' WHEN p_size > 45 THEN 'size' ELSE 'price' END AS errors FROM part WHERE p_size > 45 OR p_retailprice < 1000")
def contract_errors(spark, sf_dir):
    p = P.table(spark, sf_dir, "part")
    return curated.contract_errors(p, {"price": F.col("p_retailprice") >= 1000, "size": F.col("p_size") <= 45}).select("p_partkey", F.array_join("errors", ",").alias("errors"))
