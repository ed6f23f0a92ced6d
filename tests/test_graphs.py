"""Typed graphs, circles at admission, paths and places, against brute force."""

import random

import pytest
from claimlens.operators import provenance, spatial
from claimlens.operators.provenance import Relation, step
from claimlens.plans.staging import Staging
from pyspark.sql import functions as F


def staging(spark):
    return Staging(spark, "test")


def test_trace_expands_all_kinds_and_checks_its_budget(spark):
    claims = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, None), (5, 5)], "child long, parent long")
    told = spark.createDataFrame([(1, "d1"), (3, "d2"), (3, "d2"), (9, "d9")], "claim long, doc string")
    published = spark.createDataFrame([("d1", "s"), ("d2", "s")], "doc string, source string")
    graph = provenance.edges([Relation("depends", "claim", "child", "claim", "parent", claims), Relation("told", "claim", "claim", "doc", "doc", told), Relation("published", "doc", "doc", "source", "source", published)])
    seeds = spark.createDataFrame([("claim", 1), ("claim", 4), ("claim", 5)], "kind string, id long")
    got = {(r.root, r.kind, r.id) for r in provenance.trace(seeds, graph, staging(spark), budget=6).collect()}
    assert got == {("1", "claim", "1"), ("1", "claim", "2"), ("1", "claim", "3"), ("1", "doc", "d1"), ("1", "doc", "d2"), ("1", "source", "s"), ("4", "claim", "4"), ("5", "claim", "5")}
    with pytest.raises(ValueError, match="claim 1 rests on more than 5 nodes"):
        provenance.trace(seeds, graph, staging(spark), budget=5)
    assert provenance.trace(seeds.where("id > 9"), graph, staging(spark), budget=5).count() == 0
    below = provenance.traced_edges(provenance.trace(seeds, graph, staging(spark)), graph)
    assert {r.relation: r.n for r in below.where("root = 1").groupBy("relation").agg(F.count("*").alias("n")).collect()} == {"depends": 3, "told": 2, "published": 2}


def shortest(edges, start, end):
    """The least of the shortest paths."""
    layer, seen = [[start]], {start}
    while layer:
        ends = sorted(p for p in layer if p[-1] == end)
        if ends:
            return ends[0]
        nxt = [p + [b] for p in layer for a, b in edges if a == p[-1] and b not in seen]
        seen |= {p[-1] for p in nxt}
        layer = nxt
    return None


@pytest.mark.parametrize("seed", range(2))
def test_guard_admits_as_one_after_another(spark, seed):
    rng = random.Random(seed)
    standing = {(a, b) for a in range(14) for b in range(a) if rng.random() < 0.12}
    proposed = [(i, rng.randrange(14), rng.randrange(14)) for i in range(25)]
    held, want = set(standing), {}
    for i, c, p in proposed:
        path = shortest(held, p, c)
        want[i] = (path is not None, path)
        if path is None:
            held.add((c, p))
    rows = spark.createDataFrame(proposed, "seq long, child long, parent long")
    got = provenance.guard(rows, spark.createDataFrame(sorted(standing), "child long, parent long"), staging(spark)).collect()
    assert len(got) == 25
    for r in got:
        assert (r.refused, r.path) == want[r.seq]


def test_guard_of_nothing(spark):
    none = spark.createDataFrame([], "seq long, child long, parent long")
    assert provenance.guard(none, none.select("child", "parent"), staging(spark)).count() == 0


def walk(triples, start, path):
    """All ends of a path by regular expressions over all walks, as sets of (node, rest of the expression)."""

    def ends(node, expr):
        kind = expr[0]
        if kind == "step":
            p = expr[1]
            return {o for s, q, o in triples if q == p and s == node} if p[0] != "^" else {s for s, q, o in triples if q == p[1:] and o == node}
        if kind == "seq":
            return {z for y in ends(node, expr[1]) for z in ends(y, expr[2])}
        if kind == "alt":
            return ends(node, expr[1]) | ends(node, expr[2])
        if kind == "maybe":
            return {node} | ends(node, expr[1])
        seen, todo = set(), list(ends(node, expr[1]))
        while todo:
            y = todo.pop()
            if y not in seen:
                seen.add(y)
                todo += ends(y, expr[1])
        return seen | ({node} if kind == "star" else set())

    return ends(start, path)


@pytest.mark.parametrize("seed", range(2))
def test_paths_equal_sets_of_walks(spark, seed):
    rng = random.Random(seed)
    triples = [(rng.randrange(12), rng.choice("abc"), rng.randrange(12)) for _ in range(30)]

    def make(depth):
        kind = rng.choice(["step", "seq", "alt", "maybe", "star", "plus"]) if depth else "step"
        if kind == "step":
            p = rng.choice(["a", "b", "c", "^a", "^b"])
            return ("step", p), step(p)
        x, px = make(depth - 1)
        if kind in ("seq", "alt"):
            y, py = make(depth - 1)
            return (kind, x, y), px / py if kind == "seq" else px | py
        return (kind, x), getattr(px, kind)()

    rows = spark.createDataFrame(triples, "subject long, predicate string, object long")
    starts = spark.createDataFrame([(i,) for i in range(12)] + [(99,)], "node long")
    for _ in range(3):
        expr, path = make(3)
        got = {(r.start, r.end) for r in provenance.follow(starts, rows, path, staging(spark)).collect()}
        assert got == {(s, e) for s in [*range(12), 99] for e in walk(triples, s, expr)}


def in_ring(x, y, ring):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


@pytest.mark.parametrize("grid", [0.7, 2.0, 50.0])
def test_cells_lose_no_point(spark, grid):
    rng = random.Random(5)

    def ring(cx, cy, n, r):
        import math

        pts = [[cx + rng.uniform(0.3, 1) * r * math.cos(6.283 * i / n), cy + rng.uniform(0.3, 1) * r * math.sin(6.283 * i / n)] for i in range(n)]
        return [*pts, pts[0]]

    areas = [(i, [ring(rng.uniform(-9, 9), rng.uniform(-9, 9), rng.randrange(3, 12), rng.uniform(0.2, 6))] + ([ring(0, 0, 5, 1.0)] if i % 3 == 0 else [])) for i in range(15)]
    areas.append((99, [[[-3.0, -3.0], [3.0, -3.0], [3.0, 3.0], [-3.0, 3.0], [-3.0, -3.0]]]))  # along the cells' own lines
    points = [(i, rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(600)] + [(1000 + i, float(i % 7 - 3), float(i // 7 - 3)) for i in range(49)] + [(5000, None, 1.0)]
    df = spark.createDataFrame(areas, "area long, rings array<array<array<double>>>")
    covered = spatial.cover(df, grid)
    assert covered.count() == covered.select("area", "cx", "cy").distinct().count()
    got = sorted(tuple(r) for r in spatial.within(spark.createDataFrame(points, "id long, x double, y double"), df, covered, grid).select("id", "area").collect())
    want = sorted((i, a) for i, x, y in points if x is not None for a, rings in areas if in_ring(x, y, rings[0]) and not any(in_ring(x, y, h) for h in rings[1:]))
    assert got == want
    if grid < 1:
        assert covered.where("not border").count() > 10


def test_fill_prefers_tags_then_areas_then_probes(spark):
    box = lambda x0, y0, x1, y1: [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]
    areas = spark.createDataFrame([(1, "AA", 2, box(0.0, 0.0, 2.0, 2.0)), (2, "BB", 1, box(1.0, 1.0, 3.0, 3.0))], "area long, code string, rank long, rings array<array<array<double>>>")
    points = spark.createDataFrame([(1, 0.5, 0.5, None), (2, 1.5, 1.5, None), (3, 1.5, 1.5, " cc"), (4, 3.04, 2.0, "C1"), (5, 9.0, 9.0, ""), (6, None, None, None)], "id long, x double, y double, own string")
    got = {r.id: (r.code, r.basis) for r in spatial.fill(points, areas, spatial.cover(areas, 0.5), 0.5).collect()}
    assert got == {1: ("AA", "boundary lookup"), 2: ("BB", "boundary lookup"), 3: ("CC", "tag"), 4: ("BB", "boundary lookup"), 5: (None, None), 6: (None, None)}


def test_points_meet_cells_by_equality(spark):
    from claimlens.plans import graph_queries as q

    text = q.points_in_areas(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_fill_keeps_few_areas_a_cell(spark):
    rng = random.Random(8)
    box = lambda x, y, r: [[[x - r, y - r], [x + r, y - r], [x + r, y + r], [x - r, y + r], [x - r, y - r]]]
    areas = [(i, f"{chr(65 + i % 26)}A", rng.randrange(40), box(rng.uniform(-1, 1), rng.uniform(-1, 1), rng.uniform(0.3, 3))) for i in range(120)]
    points = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5), None) for i in range(300)]
    df = spark.createDataFrame(areas, "area long, code string, rank long, rings array<array<array<double>>>")
    covered = spatial.cover(df, 0.5)
    asked = spark.createDataFrame(points, "id long, x double, y double, own string")
    filled = spatial.fill(asked, df, covered, 0.5)
    want = {}
    for i, x, y, _ in points:
        hits = [(n, rank, a, code) for n, (dx, dy) in enumerate(((0.0, 0.0), *spatial.PROBES)) for a, code, rank, rings in areas if in_ring(x + dx, y + dy, rings[0])]
        want[i] = min(hits)[3] if hits else None
    assert {r.id: r.code for r in filled.collect()} == want
    kept = spatial.firsts(df, covered)
    assert kept.count() * 4 < covered.count()
    assert kept.where("not border").groupBy("cx", "cy").count().where("count > 1").isEmpty()
    plan = spatial.fill(asked, df, covered, 0.5)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan  # before sizes are known; what adaptive execution has measured it may send


def test_trace_walks_a_graph_that_shrinks(spark, monkeypatch):
    """Known nodes are read in few rounds, and rounds join ever fewer edges; circles beside a chain still end."""
    rows = spark.createDataFrame([("n", str(i), "n", str(i + 1)) for i in range(8)] + [("n", "20", "m", "21"), ("m", "21", "n", "20"), ("n", "3", "n", "20")], "kind string, id string, next_kind string, next_id string")
    sizes, table = [], Staging.table

    def counted(self, df, name):
        out = table(self, df, name)
        if name == "graph":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(Staging, "table", counted)
    got = {(r.kind, r.id) for r in provenance.trace(spark.createDataFrame([("n", "0")], "kind string, id string"), rows, staging(spark), budget=11).collect()}
    assert got == {("n", str(i)) for i in range(9)} | {("n", "20"), ("m", "21")}
    assert sizes and sizes == sorted(sizes, reverse=True) and sizes[0] < 11


def test_guard_tells_the_way_over_edges_that_came_in_late(spark):
    """Edge 0 is refused, so edge 1 is admitted after all, and the way that refuses edge 2 is the short one over edge 1."""
    standing = [(9, 1), (1, 2), (2, 3), (3, 4), (4, 0)]
    rows = spark.createDataFrame([(0, 0, 9), (1, 1, 4), (2, 4, 1), (3, 7, 7), (4, 8, 9)], "seq long, child long, parent long")
    got = {r.seq: (r.refused, r.path) for r in provenance.guard(rows, spark.createDataFrame(standing, "child long, parent long"), staging(spark)).collect()}
    assert got == {0: (True, [9, 1, 2, 3, 4, 0]), 1: (False, None), 2: (True, [1, 4]), 3: (True, [7]), 4: (False, None)}


def test_guard_decides_circles_of_new_edges_alone(spark):
    """Without standing edges nothing is ranked, and what is refused hangs on what came in before."""
    rng = random.Random(100)
    proposed = [(i, rng.randrange(7), rng.randrange(7)) for i in range(18)]
    held, want = set(), {}
    for i, c, p in proposed:
        path = shortest(held, p, c)
        want[i] = (path is not None, path)
        if path is None:
            held.add((c, p))
    rows = spark.createDataFrame(proposed, "seq long, child long, parent long")
    got = provenance.guard(rows, spark.createDataFrame([], "child long, parent long"), staging(spark)).collect()
    assert {r.seq: (r.refused, r.path) for r in got} == want


def test_guard_searches_only_against_the_ranks(spark, monkeypatch):
    """On a graph of halves and thirds few rows are searched, though most nodes reach each other over new edges."""
    n, rows, table = 600, [], Staging.table

    def counted(self, df, name):
        out = table(self, df, name)
        if name in ("front", "ahead", "back"):
            rows.append(out.count())
        return out

    monkeypatch.setattr(Staging, "table", counted)
    standing = sorted({(i, i // k) for i in range(1, n) for k in (2, 3)})
    proposed = [(i, i // 6, i) if i % 3 == 0 else (i, i, i // 5) for i in range(1, n)]
    frame = spark.createDataFrame(proposed, "seq long, child long, parent long")
    got = provenance.guard(frame, spark.createDataFrame(standing, "child long, parent long"), staging(spark)).collect()
    assert {r.seq for r in got if r.refused} == {i for i in range(1, n) if i % 3 == 0}
    assert sum(rows) < 8 * n


def test_crowded_cells_are_dealt_over_tasks(spark):
    """All points and areas in one cell: no task has all the points, and all pairs are found, by their number of tasks and not by bytes."""
    box = lambda r: [[-r, -r], [r, -r], [r, r], [-r, r], [-r, -r]]
    areas = [(i, [box(1 + i / 10)] + ([box(0.5), box(0.6)] if i % 2 else [])) for i in range(20)]
    points = [(i, (i * 37 % 101) / 20 - 2.5, (i * 53 % 97) / 20 - 2.4) for i in range(1200)]
    df = spark.createDataFrame(areas, "area long, rings array<array<array<double>>>")
    found = spatial.within(spark.createDataFrame(points, "id long, x double, y double"), df, spatial.cover(df, 100.0), 100.0)
    rows = found.withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.id, r.area) for r in rows) == sorted((i, a) for i, x, y in points for a, rings in areas if in_ring(x, y, rings[0]) and not any(in_ring(x, y, h) for h in rings[1:]))
    assert len({r.task for r in rows}) > 1
