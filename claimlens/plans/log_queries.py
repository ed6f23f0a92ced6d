"""Registered queries over logs and versions: revision chains, schemas, aligned assertions, guards of overlap."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from claimlens.functions import clocks, schema
from claimlens.operators import align, chains, intervals, polling
from claimlens.plans.queries import query
from claimlens.plans.staging import Staging
from claimlens.sources import projection as P

# ---------------------------------------------------------------- revisions

_LOG = """
numbered AS (SELECT o_custkey AS chain, o_orderkey AS id, row_number() OVER w AS rn, lag(o_orderkey) OVER w AS one, lag(o_orderkey, 2) OVER w AS two, max(o_orderkey) OVER (PARTITION BY o_custkey) AS newest,
  o_orderkey - CASE WHEN o_orderkey % 53 = 0 THEN 500 ELSE 0 END AS clock, sha256(o_custkey || '/' || o_orderkey) AS digest FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
log AS (SELECT chain, id, clock, digest, CASE WHEN id % 61 = 0 THEN 'x' ELSE lag(digest) OVER (PARTITION BY chain ORDER BY id) END AS previous_digest,
  CASE WHEN chain % 11 = 4 AND rn = 1 THEN 1000000000 + id WHEN chain % 13 = 5 AND rn = 1 THEN newest WHEN chain % 7 = 3 AND rn % 5 = 0 THEN two ELSE one END AS previous FROM numbered),
placed(id, genesis, depth) AS (SELECT id, id, 0 FROM log WHERE previous IS NULL UNION ALL SELECT l.id, p.genesis, p.depth + 1 FROM placed p JOIN log l ON l.previous = p.id),
faults AS (SELECT id, 'fork' AS fault FROM log WHERE previous IN (SELECT previous FROM log GROUP BY 1 HAVING count(*) > 1)
  UNION SELECT id, 'several_geneses' FROM log WHERE previous IS NULL AND chain IN (SELECT chain FROM log WHERE previous IS NULL GROUP BY 1 HAVING count(*) > 1)
  UNION SELECT id, 'missing_predecessor' FROM log WHERE previous NOT IN (SELECT id FROM log)
  UNION SELECT id, 'no_genesis' FROM log WHERE id NOT IN (SELECT id FROM placed)
  UNION SELECT l.id, 'clock_not_advancing' FROM log l JOIN log p ON p.id = l.previous WHERE l.clock <= p.clock
  UNION SELECT l.id, 'link_differs' FROM log l JOIN log p ON p.id = l.previous WHERE l.previous_digest IS DISTINCT FROM p.digest)"""


def _log(spark, sf_dir):
    w = Window.partitionBy("chain").orderBy("id")
    o = P.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("chain"), F.col("o_orderkey").alias("id"), F.expr("o_orderkey - if(o_orderkey % 53 = 0, 500, 0)").alias("clock"), F.sha2(F.concat_ws("/", "o_custkey", "o_orderkey"), 256).alias("digest"))
    o = o.withColumns({"rn": F.row_number().over(w), "one": F.lag("id").over(w), "two": F.lag("id", 2).over(w), "newest": F.max("id").over(Window.partitionBy("chain")), "before": F.lag("digest").over(w)})
    previous = F.expr("case when chain % 11 = 4 and rn = 1 then 1000000000 + id when chain % 13 = 5 and rn = 1 then newest when chain % 7 = 3 and rn % 5 = 0 then two else one end")
    return Staging(spark, "log").table(o.select("chain", "id", "clock", "digest", F.when(F.col("id") % 61 == 0, "x").otherwise(F.col("before")).alias("previous_digest"), previous.alias("previous")), "log")


@query(f"WITH RECURSIVE {_LOG} SELECT id, genesis, depth FROM placed")
def revision_places(spark, sf_dir):
    """Where every order stands in its customer's log of revisions; what leads to no first revision has no place."""
    return chains.place(_log(spark, sf_dir), Staging(spark, "places"))


@query(f"WITH RECURSIVE {_LOG} SELECT id, fault FROM faults")
def revision_faults(spark, sf_dir):
    """Forks, lost predecessors, circles, clocks and links that no log may hold."""
    log = _log(spark, sf_dir)
    return chains.faults(log, chains.place(log, Staging(spark, "places")))


@query(
    f"""WITH RECURSIVE {_LOG}, sound AS (SELECT id, previous FROM log WHERE chain NOT IN (SELECT chain FROM log WHERE id IN (SELECT id FROM faults))),
changes AS (SELECT l_orderkey AS id, l_returnflag AS key, CASE WHEN sum(l_quantity) % 7 <> 0 THEN sum(l_quantity) END AS value FROM lineitem GROUP BY 1, 2),
back(head, spot, steps) AS (SELECT id, id, 0 FROM sound UNION ALL SELECT b.head, s.previous, steps + 1 FROM back b JOIN sound s ON s.id = b.spot WHERE s.previous IS NOT NULL),
last AS (SELECT head, key, value, row_number() OVER (PARTITION BY head, key ORDER BY steps) AS k FROM back JOIN changes c ON c.id = back.spot)
SELECT head, key, value FROM last WHERE k = 1 AND value IS NOT NULL"""
)
def revision_restore(spark, sf_dir):
    """What every order of a sound log leaves standing: the latest quantity by mode, withdrawn ones left out."""
    staging = Staging(spark, "restore")
    log = _log(spark, sf_dir)
    placed = chains.place(log, staging)
    good = staging.table(chains.sound(log, chains.faults(log, placed)).select("id"), "sound")
    total = F.sum("l_quantity")
    lines = P.table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("key")).agg(F.when(total % 7 != 0, total).alias("value"))
    return chains.restore(lines.join(good, "id", "left_semi"), placed, good)


# ---------------------------------------------------------------- schemas

#: What the orders' JSON is held against.
ORDER = {
    "type": "object",
    "required": ["id", "status", "total"],
    "additionalProperties": False,
    "properties": {
        "id": {"type": "integer", "minimum": 1},
        "status": {"enum": ["F", "O"]},
        "total": {"type": "number", "exclusiveMaximum": 300000},
        "priority": {"type": ["string", "null"], "pattern": "^[1-3]-"},
        "tags": {"type": "array", "maxItems": 2, "uniqueItems": True, "items": {"type": "integer", "maximum": 4}},
        "ship": {"type": "object", "required": ["days"], "properties": {"days": {"anyOf": [{"const": 0}, {"type": "integer", "minimum": 30}]}}},
    },
}


@query(
    """WITH t AS (SELECT o_orderkey AS k, CASE o_orderkey % 29 WHEN 0 THEN '{' || o_orderkey WHEN 1 THEN '{"id":"' || o_orderkey || '","ship":{}}' WHEN 2 THEN '[' || o_orderkey || ']' ELSE
  '{"id":' || o_orderkey || CASE WHEN o_custkey % 5 = 0 THEN '.5' WHEN o_custkey % 5 = 1 THEN '.0' ELSE '' END || ',"status":"' || o_orderstatus || '","total":' || o_custkey * 300 || '.25,"priority":' || CASE WHEN o_custkey % 7 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END
  || ',"tags":[' || o_orderkey % 6 || ',' || o_custkey % 6 || CASE WHEN o_custkey % 3 = 0 THEN ',9' ELSE '' END || '],"ship":{"days":' || o_custkey % 60 || '}' || CASE WHEN o_orderkey % 13 = 0 THEN ',"extra":1' ELSE '' END || '}' END AS text FROM orders),
j AS (SELECT k, CASE WHEN json_valid(text) THEN text::JSON END AS v FROM t),
e AS (SELECT k, '$: not JSON' AS e FROM j WHERE v IS NULL
  UNION ALL SELECT k, '$: not of type object' FROM j WHERE json_type(v) <> 'OBJECT'
  UNION ALL SELECT k, '$: ' || n || ' is missing' FROM j, (VALUES ('id'), ('status'), ('total')) r(n) WHERE json_type(v) = 'OBJECT' AND NOT list_contains(json_keys(v), n)
  UNION ALL SELECT k, '$: ' || unnest(list_filter(json_keys(v), lambda x: x NOT IN ('id', 'status', 'total', 'priority', 'tags', 'ship'))) || ' is not allowed' FROM j WHERE json_type(v) = 'OBJECT'
  UNION ALL SELECT k, '$.id: not of type integer' FROM j WHERE json_type(v, '$.id') = 'VARCHAR' OR (json_type(v, '$.id') = 'DOUBLE' AND CAST(v->>'$.id' AS DOUBLE) % 1 <> 0)
  UNION ALL SELECT k, '$.status: not in enum' FROM j WHERE v->>'$.status' NOT IN ('F', 'O')
  UNION ALL SELECT k, '$.total: not below exclusiveMaximum' FROM j WHERE CAST(v->>'$.total' AS DOUBLE) >= 300000
  UNION ALL SELECT k, '$.priority: pattern does not match' FROM j WHERE json_type(v, '$.priority') = 'VARCHAR' AND NOT regexp_matches(v->>'$.priority', '^[1-3]-')
  UNION ALL SELECT k, '$.tags: above maxItems' FROM j WHERE json_array_length(v, '$.tags') > 2
  UNION ALL SELECT k, '$.tags: items repeat' FROM j WHERE len(list_distinct(json_extract_string(v, '$.tags[*]'))) < json_array_length(v, '$.tags')
  UNION ALL SELECT k, '$.tags[' || (i - 1) || ']: above maximum' FROM (SELECT k, generate_subscripts(a, 1) AS i, unnest(a) AS x FROM (SELECT k, json_extract_string(v, '$.tags[*]') AS a FROM j WHERE json_type(v) = 'OBJECT') u) u WHERE CAST(x AS INTEGER) > 4
  UNION ALL SELECT k, '$.ship: days is missing' FROM j WHERE json_type(v, '$.ship') = 'OBJECT' AND NOT list_contains(json_keys(v, '$.ship'), 'days')
  UNION ALL SELECT k, '$.ship.days: matches 0 of anyOf' FROM j WHERE CAST(v->>'$.ship.days' AS INTEGER) <> 0 AND CAST(v->>'$.ship.days' AS INTEGER) < 30)
SELECT k, count(e) AS n, coalesce(string_agg(e, '; ' ORDER BY e), '') AS errors FROM t LEFT JOIN e USING (k) GROUP BY 1"""
)
def schema_errors(spark, sf_dir):
    """What every order's JSON breaks of a schema, compiled to expressions."""
    text = """case o_orderkey % 29 when 0 then concat('{', o_orderkey) when 1 then concat('{"id":"', o_orderkey, '","ship":{}}') when 2 then concat('[', o_orderkey, ']') else
      concat('{"id":', o_orderkey, case o_custkey % 5 when 0 then '.5' when 1 then '.0' else '' end, ',"status":"', o_orderstatus, '","total":', o_custkey * 300, '.25,"priority":', if(o_custkey % 7 = 0, 'null', concat('"', o_orderpriority, '"')),
      ',"tags":[', o_orderkey % 6, ',', o_custkey % 6, if(o_custkey % 3 = 0, ',9', ''), '],"ship":{"days":', o_custkey % 60, '}', if(o_orderkey % 13 = 0, ',"extra":1', ''), '}') end"""
    # a file of few bytes holds many orders: dealt by number, so that all tasks have a share of the checks
    orders = P.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")
    rows = orders.select(F.col("o_orderkey").alias("k"), F.expr(text).alias("text"))
    found = rows.select("k", F.array_sort(schema.text_errors(F.col("text"), ORDER)).alias("e"))
    return found.select("k", F.size("e").cast("long").alias("n"), F.array_join("e", "; ").alias("errors"))


# ---------------------------------------------------------------- versions of pages


@query()
def assertion_alignment(spark, sf_dir):
    """Sentences of every document against an edited version of it: kept, changed, moved, added, removed, ambiguous.

    An assertion speaks of the first two words of its sentence. Some sentences leave, some change an end, some move down.
    """
    d = P.table(spark, sf_dir, "documents").where("text is not null").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", r"\.\s+")).alias("at", "literal"))
    key = F.lower(F.array_join(F.slice(F.split("literal", " "), 1, 2), " "))
    before = d.select("page", "at", key.alias("key"), "literal")
    size = F.length("literal")
    moved = F.when(size % 11 == 0, F.col("at") + 5).otherwise(F.col("at"))
    after = before.where(size % 7 != 3).select("page", moved.alias("at"), "key", F.when(size % 5 == 0, F.concat("literal", F.lit(" anew"))).otherwise(F.col("literal")).alias("literal"))
    return align.align(before, after)


@query(
    """WITH a AS (SELECT o_custkey AS key, o_orderkey AS id, CAST(o_orderdate AS DATE) AS start, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(CAST(o_orderdate AS DATE) + INTERVAL 45 DAY AS DATE) END AS "end" FROM orders),
r AS (SELECT *, max(coalesce("end", DATE '9999-12-31')) OVER (PARTITION BY key ORDER BY start, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM a)
SELECT key, id, start, "end", nullif(reach, DATE '9999-12-31') AS reach FROM r WHERE reach > start"""
)
def overlap_guard(spark, sf_dir):
    """Assignments that begin before an earlier one of their customer has ended, and until when that one reaches."""
    rows = P.assignments(spark, sf_dir).select(F.col("observed_id").alias("key"), F.col("assignment_id").alias("id"), F.col("valid_from").alias("start"), F.col("valid_to").alias("end"))
    return intervals.clashes(rows, Staging(spark, "guard"))


# ---------------------------------------------------------------- polling


@query(
    """WITH t AS (SELECT user_id AS target_id, epoch_us(ts) AS us FROM events GROUP BY ALL), g AS (SELECT target_id, us + 21600000000 AS due_us, lead(us) OVER (PARTITION BY target_id ORDER BY us) AS next_us FROM t WHERE us <= 1706313600000000)
SELECT target_id, due_us FROM g WHERE due_us <= 1706313600000000 AND (next_us IS NULL OR next_us > due_us)"""
)
def poll_due_times(spark, sf_dir):
    """Every instant at which a user, seen as a target, had not been polled for six hours."""
    e = P.table(spark, sf_dir, "events").select(F.col("user_id").alias("target_id"), clocks.micros(F.col("ts")).alias("us"))
    return polling.due_times(e, 6 * 3_600_000_000, 1_706_313_600_000_000)


@query(
    """WITH p AS (SELECT CAST(ts AS DATE) AS tick, event_type AS part, max(CAST(floor(value / 40) AS BIGINT))::VARCHAR AS text FROM events GROUP BY ALL), s AS (SELECT tick, sha256(string_agg(d, '' ORDER BY d)) AS signal FROM (SELECT DISTINCT tick, sha256(part || '|' || text) AS d FROM p) u GROUP BY 1)
SELECT tick, signal, lag(signal) OVER (ORDER BY tick) IS DISTINCT FROM signal AS changed FROM s"""
)
def report_signals(spark, sf_dir):
    """Whether each day's report, the highest level of every event type, says anything new."""
    e = P.table(spark, sf_dir, "events").select(F.to_date("ts").alias("tick"), F.col("event_type").alias("part"), F.floor(F.col("value") / 40).alias("v"))
    return polling.report_signals(e.groupBy("tick", "part").agg(F.max("v").cast("string").alias("text")))
