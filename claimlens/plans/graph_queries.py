"""Registered queries over typed graphs and places: provenance, circles at admission, property paths, areas."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens.operators import provenance, spatial, traced
from claimlens.operators.provenance import Relation, step
from claimlens.plans.queries import CURRENT, DEPS, EVIDENCE, _current, query
from claimlens.plans.staging import Staging
from claimlens.sources import projection as P

# ---------------------------------------------------------------- provenance

#: Nodes below a claim; a claim that rests on more is an error.
BUDGET = 5_000

_EDGES = """
e AS (SELECT DISTINCT * FROM (
  SELECT 'depends' AS relation, 'claim' AS kind, child::VARCHAR AS id, 'claim' AS next_kind, parent::VARCHAR AS next_id FROM deps
  UNION ALL SELECT 'states', 'claim', event_id::VARCHAR, 'series', user_id || ':' || event_type FROM events
  UNION ALL SELECT 'about', 'series', user_id || ':' || event_type, 'entity', user_id::VARCHAR FROM events
  UNION ALL SELECT 'evidence', 'claim', claim_id::VARCHAR, 'document', document_id::VARCHAR FROM evidence
  UNION ALL SELECT 'reads', 'claim', event_id::VARCHAR, 'record', c_custkey::VARCHAR FROM events JOIN customer ON c_custkey = user_id
  UNION ALL SELECT 'written', 'record', c_custkey::VARCHAR, 'run', (c_custkey % 10 + 1)::VARCHAR FROM customer
  UNION ALL SELECT 'created', 'claim', event_id::VARCHAR, 'run', (event_id % 7 + 1)::VARCHAR FROM events
  UNION ALL SELECT 'input', 'run', s_suppkey::VARCHAR, 'document', s_suppkey::VARCHAR FROM supplier
  UNION ALL SELECT 'published', 'document', doc_id::VARCHAR, 'source', source FROM documents
  UNION ALL SELECT 'belongs', 'source', source, 'family', min(lang) FROM documents GROUP BY source) u WHERE id IS NOT NULL AND next_id IS NOT NULL),
reach(root, kind, id) AS (SELECT claim_id, 'claim', claim_id::VARCHAR FROM current_view UNION SELECT r.root, e.next_kind, e.next_id FROM reach r JOIN e ON e.kind = r.kind AND e.id = r.id)"""


def _relations(spark, sf_dir):
    t = lambda name: P.table(spark, sf_dir, name)
    events = t("events").withColumn("series", F.concat_ws(":", F.col("user_id").cast("string"), "event_type"))
    records = t("customer").select("c_custkey", (F.col("c_custkey") % 10 + 1).alias("run"))
    return [
        Relation("depends", "claim", "child", "claim", "parent", P.dependencies(spark, sf_dir)),
        Relation("states", "claim", "event_id", "series", "series", events),
        Relation("about", "series", "series", "entity", "user_id", events.select("series", "user_id").distinct()),
        Relation("evidence", "claim", "claim_id", "document", "document_id", P.evidence(spark, sf_dir)),
        Relation("reads", "claim", "event_id", "record", "c_custkey", events.join(records, F.col("c_custkey") == F.col("user_id"))),
        Relation("written", "record", "c_custkey", "run", "run", records),
        Relation("created", "claim", "event_id", "run", "run", events.withColumn("run", F.col("event_id") % 7 + 1)),
        Relation("input", "run", "s_suppkey", "document", "s_suppkey", t("supplier")),
        Relation("published", "document", "doc_id", "source", "source", t("documents")),
        Relation("belongs", "source", "source", "family", "lang", t("documents").groupBy("source").agg(F.min("lang").alias("lang"))),
    ]


def _seeds(spark, sf_dir):
    return _current(spark, sf_dir).select(F.lit("claim").alias("kind"), F.col("claim_id").alias("id"))


@query(f"WITH RECURSIVE {CURRENT}, {DEPS}, {EVIDENCE}, {_EDGES} SELECT root::VARCHAR AS root, kind, count(*) AS n, min(id) AS first_id FROM reach GROUP BY ALL")
def provenance_nodes(spark, sf_dir):
    """What every claim of the current view rests on: nodes of eight kinds, over ten relations."""
    return traced.counts(_seeds(spark, sf_dir), _relations(spark, sf_dir), Staging(spark, "provenance"), BUDGET).select("root", "kind", "n", "first_id")


@query(f"WITH RECURSIVE {CURRENT}, {DEPS}, {EVIDENCE}, {_EDGES} SELECT relation, e.kind, next_kind, count(*) AS n, count(DISTINCT root) AS n_roots, count(DISTINCT e.id || '>' || next_id) AS n_edges FROM reach r JOIN e ON e.kind = r.kind AND e.id = r.id GROUP BY ALL")
def provenance_edges(spark, sf_dir):
    """The edges of the same graphs, by relation."""
    return traced.by_relation(_seeds(spark, sf_dir), _relations(spark, sf_dir), Staging(spark, "provenance"), BUDGET)


@query(f"""WITH RECURSIVE {CURRENT}, {DEPS}, {EVIDENCE}, {_EDGES}, faults AS (
  SELECT 'run' AS kind, s_suppkey::VARCHAR AS id, 'run not succeeded' AS fault FROM supplier WHERE s_suppkey % 13 = 4
  UNION ALL SELECT 'claim', claim_id::VARCHAR, 'no support' FROM claims WHERE claim_id = 0 AND NOT EXISTS (SELECT 1 FROM evidence v WHERE v.claim_id = 0 AND role = 'support')
  UNION ALL SELECT 'claim', claim_id::VARCHAR, 'recorded after the cutoff' FROM claims WHERE recorded_us > 1705320000000000
  UNION ALL SELECT 'document', doc_id::VARCHAR, 'without a source' FROM documents WHERE source IS NULL OR lang IS NULL)
SELECT root::VARCHAR AS root, kind, id, fault FROM reach JOIN faults USING (kind, id)""")
def provenance_faults(spark, sf_dir):
    """Rows below current claims that a frozen study could not rest on: failed runs, late or unsupported claims, documents without origin."""
    t = lambda name: P.table(spark, sf_dir, name)
    of = lambda rows, key, fault: rows.select(F.col(key).alias("id"), F.lit(fault).alias("fault"))
    claims = P.claims(spark, sf_dir)
    held = P.evidence(spark, sf_dir).where("role = 'support'").select("claim_id").unionByName(P.dependencies(spark, sf_dir).select(F.col("child").alias("claim_id")))
    rules = {
        "run": of(P.store(spark, sf_dir)["runs"].where("status <> 'succeeded'"), "run_id", "run not succeeded"),
        "claim": of(claims.join(held, "claim_id", "left_anti"), "claim_id", "no support").unionByName(of(claims.where(F.col("recorded_us") > 1705320000000000), "claim_id", "recorded after the cutoff")),
        "document": of(t("documents").where("source is null or lang is null"), "doc_id", "without a source"),
    }
    return traced.faults(_seeds(spark, sf_dir), _relations(spark, sf_dir), rules, Staging(spark, "provenance"), BUDGET).select("root", "kind", "id", "fault")


@query(f"""WITH RECURSIVE {DEPS}, n AS (SELECT count(*) AS n FROM events),
p AS (SELECT event_id AS seq, CASE event_id % 3 WHEN 0 THEN event_id // 6 ELSE event_id END AS child, CASE WHEN event_id % 3 = 0 THEN event_id WHEN event_id % 3 = 1 AND event_id * 2 < n THEN event_id * 2 ELSE event_id // 5 END AS parent FROM events, n WHERE event_type IN ('purchase', 'signup')),
r(seq, node, d) AS (SELECT seq, parent, 0 FROM p UNION SELECT r.seq, deps.parent, d + 1 FROM r JOIN deps ON deps.child = r.node)
SELECT seq, p.child, p.parent, d IS NOT NULL AS refused, d AS steps FROM p LEFT JOIN (SELECT p.seq, min(d) AS d FROM p JOIN r ON r.seq = p.seq AND r.node = p.child GROUP BY 1) USING (seq)""")
def circle_guard(spark, sf_dir):
    """Proposed dependencies of purchases and signups, one after another: those that would close a circle are refused."""
    e = P.table(spark, sf_dir, "events")
    n = F.broadcast(e.agg(F.count("*").alias("n")))  # one row
    k = F.col("event_id")
    some = e.where(F.col("event_type").isin("purchase", "signup")).join(n)
    parent = F.when(k % 3 == 0, k).when((k % 3 == 1) & (k * 2 < F.col("n")), k * 2).otherwise(F.expr("event_id div 5"))
    proposed = some.select(k.alias("seq"), F.when(k % 3 == 0, F.expr("event_id div 6")).otherwise(k).alias("child"), parent.alias("parent"))
    out = provenance.guard(proposed, P.dependencies(spark, sf_dir), Staging(spark, "guard"))
    return out.select("seq", "child", "parent", "refused", (F.size("path") - 1).alias("steps"))


# ---------------------------------------------------------------- property paths

_TRIPLES = "deps2 AS (SELECT event_id AS s, event_id // 2 AS half, event_id // 3 AS third FROM events WHERE event_id > 0)"


def _triples(spark, sf_dir):
    e = P.table(spark, sf_dir, "events")
    one = lambda name, value, rows: rows.select(F.col("event_id").alias("subject"), F.lit(name).alias("predicate"), F.expr(value).alias("object"))
    return one("half", "event_id div 2", e.where("event_id > 0")).unionByName(one("third", "event_id div 3", e.where("event_id > 0"))).unionByName(one("user", "user_id", e))


@query(f"""WITH RECURSIVE {CURRENT}, {_TRIPLES},
hop AS (SELECT a.s, b.half AS o FROM deps2 a JOIN deps2 b ON b.s = a.half UNION SELECT s, third FROM deps2),
r(start, node) AS (SELECT claim_id, claim_id FROM current_view UNION SELECT r.start, o FROM r JOIN hop ON s = node)
SELECT start, count(DISTINCT user_id) AS n, min(user_id) AS sample, array_to_string(list_sort(list(DISTINCT user_id::VARCHAR)), '; ') AS users FROM r JOIN events ON event_id = node GROUP BY 1""")
def property_paths(spark, sf_dir):
    """The users behind ((half / half) | third)* / user of every current claim, listed and sampled."""
    path = ((step("half") / step("half")) | step("third")).star() / step("user")
    starts = _current(spark, sf_dir).select(F.col("claim_id").alias("node"))
    ends = provenance.follow(starts, _triples(spark, sf_dir), path, Staging(spark, "paths"))
    return ends.groupBy("start").agg(F.count("*").alias("n"), F.min("end").alias("sample"), provenance.listed(F.col("end").cast("string")).alias("users"))


@query(f"""WITH RECURSIVE {CURRENT}, {_TRIPLES},
r(start, node, k) AS (SELECT claim_id, claim_id, 0 FROM current_view UNION SELECT r.start, d.s, 1 FROM r JOIN deps2 d ON d.half = r.node)
SELECT start, count(DISTINCT o) AS n, min(o) AS least, max(o) AS most FROM (SELECT start, third AS o FROM r JOIN deps2 ON s = node WHERE k = 1 UNION ALL SELECT start, start FROM r) GROUP BY 1""")
def property_paths_inverse(spark, sf_dir):
    """Where (^half+ / third)? leads from every current claim: up against half, then down by third, or nowhere."""
    path = (step("^half").plus() / step("third")).maybe()
    starts = _current(spark, sf_dir).select(F.col("claim_id").alias("node"))
    ends = provenance.follow(starts, _triples(spark, sf_dir), path, Staging(spark, "paths"))
    return ends.groupBy("start").agg(F.count("*").alias("n"), F.min("end").alias("least"), F.max("end").alias("most"))


# ---------------------------------------------------------------- areas

#: Corners of a star, as shares of its radius.
STAR = ((1.0, 0.0), (0.35, 0.35), (0.0, 1.0), (-0.35, 0.35), (-1.0, 0.0), (-0.35, -0.35), (0.0, -1.0), (0.35, -0.35), (1.0, 0.0))
HOLE = ((0.1, 0.1), (-0.1, 0.1), (-0.1, -0.1), (0.1, -0.1), (0.1, 0.1))
STEP = 1.0
_POINT = ("cast(c_custkey * 7919 % 36000 as double) / 100 - 180", "cast(c_custkey * 104729 % 17000 as double) / 100 - 85")
_CENTRE = ("cast(s_suppkey * 37 % 360 as double) - 180", "cast(s_suppkey * 53 % 170 as double) - 85", "cast(s_suppkey % 7 as double) * 2.5 + 3")
_CODE = "chr(cast(65 + s_suppkey % 26 as int)) || chr(cast(65 + s_suppkey % 17 as int))"


def _sql_edges() -> str:
    out = []
    for ring, corners in ((0, STAR), (1, HOLE)):
        for (a, b), (c, d) in zip(corners, corners[1:], strict=False):
            out.append(f"SELECT area, code, {ring} AS ring, mx + r * {a}::DOUBLE AS x1, my + r * {b}::DOUBLE AS y1, mx + r * {c}::DOUBLE AS x2, my + r * {d}::DOUBLE AS y2 FROM m{' WHERE area % 3 = 0' if ring else ''}")
    return " UNION ALL ".join(out)


_AREAS = f"""m AS (SELECT s_suppkey AS area, {_CODE} AS code, {_CENTRE[0]} AS mx, {_CENTRE[1]} AS my, {_CENTRE[2]} AS r FROM supplier), edges AS ({_sql_edges()}),
points AS (SELECT c_custkey AS id, {_POINT[0]} AS x, {_POINT[1]} AS y, CASE c_custkey % 10 WHEN 0 THEN ' de ' WHEN 1 THEN 'XYZ' END AS own FROM customer),
probes(probe, dx, dy) AS (VALUES (0, 0::DOUBLE, 0::DOUBLE), {", ".join(f"({n}, {dx}::DOUBLE, {dy}::DOUBLE)" for n, (dx, dy) in enumerate(spatial.PROBES, 1))}),
rings AS (SELECT id, probe, area, code, ring, count(*) FILTER ((y1 > y + dy) <> (y2 > y + dy) AND x + dx < (x2 - x1) * (y + dy - y1) / nullif(y2 - y1, 0) + x1) % 2 AS odd FROM points, probes, edges GROUP BY ALL),
hits AS (SELECT id, probe, area, code FROM rings GROUP BY ALL HAVING max(CASE WHEN ring = 0 THEN odd END) = 1 AND coalesce(max(CASE WHEN ring = 1 THEN odd END), 0) = 0)"""


def _areas(spark, sf_dir):
    s = P.table(spark, sf_dir, "supplier")
    m = s.select(F.col("s_suppkey").alias("area"), F.expr(_CODE).alias("code"), *[F.expr(c).alias(n) for c, n in zip(_CENTRE, ("mx", "my", "r"), strict=True)])
    ring = lambda corners: F.array(*[F.array(F.col("mx") + F.col("r") * a, F.col("my") + F.col("r") * b) for a, b in corners])
    rings = F.when(F.col("area") % 3 == 0, F.array(ring(STAR), ring(HOLE))).otherwise(F.array(ring(STAR)))
    return m.select("area", "code", F.col("area").alias("rank"), rings.alias("rings"))


def _points(spark, sf_dir):
    own = F.when(F.col("c_custkey") % 10 == 0, " de ").when(F.col("c_custkey") % 10 == 1, "XYZ")
    return P.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr(_POINT[0]).alias("x"), F.expr(_POINT[1]).alias("y"), own.alias("own"))


@query(f"WITH {_AREAS} SELECT id, area FROM hits WHERE probe = 0")
def points_in_areas(spark, sf_dir):
    """Customers' points in suppliers' areas, stars with holes that overlap: all areas of each point, over grid cells."""
    areas = _areas(spark, sf_dir)
    return spatial.within(_points(spark, sf_dir), areas, spatial.cover(areas, STEP), STEP)


@query(f"""WITH {_AREAS}, best AS (SELECT id, arg_min(code, probe * 1000000 + area) AS found FROM hits GROUP BY 1)
SELECT id, CASE WHEN own = ' de ' THEN 'DE' ELSE found END AS code, CASE WHEN own = ' de ' THEN 'tag' WHEN found IS NOT NULL THEN 'boundary lookup' END AS basis FROM points LEFT JOIN best USING (id)""")
def country_fill(spark, sf_dir):
    """A code for every point: its own tag, else the first area that holds it, else one a few kilometres away."""
    areas = _areas(spark, sf_dir)
    return spatial.fill(_points(spark, sf_dir), areas, spatial.cover(areas, STEP), STEP)
