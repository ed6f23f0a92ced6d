"""Answers over whole traces by groups of roots, against walks in plain Python."""

import random
from collections import defaultdict

import pytest
from claimlens.operators import traced
from claimlens.operators.provenance import Relation
from claimlens.plans.staging import Staging
from pyspark.sql import functions as F

#: Kinds a and b lead back to each other, c to itself; d and e end every walk.
FORMS = [("aa", "a", "a"), ("ab", "a", "b"), ("ba", "b", "a"), ("ac", "a", "c"), ("cc", "c", "c"), ("cd", "c", "d"), ("ad", "a", "d"), ("de", "d", "e"), ("dd2", "a", "d")]


def made(seed, n=24, share=1.2):
    rng = random.Random(seed)
    return [(name, k, str(rng.randrange(n)), m, str(rng.randrange(n))) for name, k, m in FORMS for _ in range(int(n * share))]


def relations(spark, edges):
    out = []
    for name, k, m in FORMS:
        rows = [(a, b) for r, x, a, y, b in edges if (r, x, y) == (name, k, m)] + [(None, "1"), ("1", None)]
        out.append(Relation(name, k, "of", m, "on", spark.createDataFrame(rows, "of string, on string")))
    return out


def reach(edges, root):
    after = defaultdict(set)
    for _, k, a, m, b in edges:
        after[k, a].add((m, b))
    seen, todo = {root}, [root]
    while todo:
        new = after[todo.pop()] - seen
        seen |= new
        todo += new
    return seen


def expected(edges, seeds):
    by_kind, form = {}, defaultdict(lambda: [0, set(), set()])
    for root in seeds:
        below = reach(edges, root)
        for k in {k for k, _ in below}:
            own = [i for x, i in below if x == k]
            by_kind[(*root, k)] = (len(own), min(own))
        for r, k, a, m, b in set(edges):
            if (k, a) in below:
                form[r, k, m][0] += 1
                form[r, k, m][1].add(root)
                form[r, k, m][2].add((a, b))
    return by_kind, {f: (n, len(x), len(y)) for f, (n, x, y) in form.items()}


def asked(spark, edges, seeds, budget=None):
    staging = lambda: Staging(spark, "test")
    rows, rel = spark.createDataFrame(seeds, "kind string, id string"), relations(spark, edges)
    by_kind = {(r.root_kind, r.root, r.kind): (r.n, r.first_id) for r in traced.counts(rows, rel, staging(), budget).collect()}
    form = {(r.relation, r.kind, r.next_kind): (r.n, r.n_roots, r.n_edges) for r in traced.by_relation(rows, rel, staging(), budget).collect()}
    return by_kind, form


@pytest.mark.parametrize(("held", "heavy"), [(10**6, 10**6), (20, 10**6), (0, 150)])
def test_groups_answer_as_single_walks(spark, monkeypatch, held, heavy):
    """Whether the graph is settled in one go, after some rounds, by rounds alone, or groups are too large for a task."""
    monkeypatch.setattr(traced, "HELD", held)
    monkeypatch.setattr(traced, "HEAVY", heavy)
    monkeypatch.setattr(traced, "BITS", 3)
    edges = made(held % 7)
    seeds = [(k, str(i)) for k in "abcd" for i in range(0, 24, 3)] + [("a", "900"), ("z", "1")]
    assert asked(spark, edges, seeds) == expected(edges, seeds)


def test_more_roots_than_a_word_has_bits(spark, monkeypatch):
    monkeypatch.setattr(traced, "UNPACKED", 1)
    edges = [("aa", "a", str(i), "a", str(i // 2)) for i in range(1, 300)] + [("ac", "a", str(i), "c", str(i % 3)) for i in range(300)]
    seeds = [("a", str(i)) for i in range(300)]
    assert asked(spark, edges, seeds) == expected(edges, seeds)


def test_a_budget_is_checked_and_never_cuts(spark):
    edges = [("aa", "a", str(i), "a", str(i + 1)) for i in range(1, 9)] + [("ad", "a", "3", "d", "x")]
    seeds = [("a", "1"), ("a", "5")]
    most = len(reach(edges, seeds[0]))
    assert asked(spark, edges, seeds, budget=most) == expected(edges, seeds)
    for ask in (traced.counts, traced.by_relation, lambda *a: traced.faults(*a[:2], {"a": spark.createDataFrame([("1", "f")], "id string, fault string")}, *a[2:])):
        with pytest.raises(ValueError, match=f"a 1 rests on more than {most - 1} nodes"):
            ask(spark.createDataFrame(seeds, "kind string, id string"), relations(spark, edges), Staging(spark, "test"), most - 1)


@pytest.mark.parametrize("heavy", [10**6, 150])
def test_faults_of_single_walks(spark, monkeypatch, heavy):
    monkeypatch.setattr(traced, "HEAVY", heavy)
    monkeypatch.setattr(traced, "HELD", 20)
    edges = made(5)
    seeds = [(k, str(i)) for k in "ac" for i in range(0, 24, 2)] + [("z", "1")]
    bad = {"a": [(str(i), "late") for i in range(0, 24, 7)] + [("7", "lone"), ("7", "lone")], "e": [(str(i), "late") for i in range(20)], "z": [("1", "odd"), (None, "odd")], "c": [("0", None)]}
    rules = {k: spark.createDataFrame(v, "id string, fault string") for k, v in bad.items()}
    got = sorted(map(str, traced.faults(spark.createDataFrame(seeds, "kind string, id string"), relations(spark, edges), rules, Staging(spark, "test")).select("root_kind", "root", "kind", "id", "fault").collect()))
    want = {(*s, k, i, f) for s in seeds for k, i in reach(edges, s) for x, f in set(bad.get(k, [])) if x == i}
    row = spark.createDataFrame(sorted(want, key=str), "root_kind string, root string, kind string, id string, fault string")
    assert len(want) > 50 and got == sorted(map(str, row.collect()))


def test_a_walk_is_one_for_all_roots_of_a_group(spark, monkeypatch):
    """Nodes that many roots share are walked once a group: far fewer rows are staged than there are pairs of root and node."""
    rows, table = [], Staging.table

    def counted(self, df, name):
        out = table(self, df, name)
        if name in ("closed", "below", "frontier", "begin"):
            rows.append(out.count())
        return out

    monkeypatch.setattr(Staging, "table", counted)
    edges = [("aa", "a", str(i), "a", str(i // k)) for i in range(1, 800) for k in (2, 3)] + [("ac", "a", str(i), "c", str(i % 5)) for i in range(800)]
    seeds = [("a", str(i)) for i in range(400, 800)]
    got = traced.counts(spark.createDataFrame(seeds, "kind string, id string"), relations(spark, edges), Staging(spark, "test"))
    pairs = got.agg(F.sum("n")).first()[0]
    assert sum(rows) * 2 < pairs
