"""Boundaries of the bitemporal views and of the write plans."""

import functools
import random
from datetime import date
from types import SimpleNamespace

import pytest
from claimlens.functions.ids import tree_digest
from claimlens.operators import changes, forecast, graph, identity, intervals, polling, records, refresh, views
from claimlens.plans import staging
from claimlens.plans.staging import Staging
from pyspark.sql import functions as F

SHAPE = "claim_id long, entity_id long, predicate string, valid_from date, valid_to date, recorded_us long, superseded_us long, claim_kind string, value double"


def claim(i, start, end, rec, sup=None, kind="direct_observation", series=1, value=1.0):
    d = lambda x: date.fromisoformat(x) if x else None
    return (i, series, "p", d(start), d(end), rec, sup, kind, value)


def ids(df, col="claim_id"):
    return sorted(r[0] for r in df.select(col).collect())


def test_half_open_bounds(spark):
    c = spark.createDataFrame([claim(1, "2024-01-10", "2024-01-20", 100)], SHAPE)
    seen = lambda day, at: ids(views.current(c, day, at))
    assert seen("2024-01-10", 100) == [1] and seen("2024-01-19", 100) == [1]
    assert seen("2024-01-20", 100) == [] and seen("2024-01-09", 100) == [] and seen("2024-01-10", 99) == []


def test_supersession_is_masked_and_exclusive(spark):
    c = spark.createDataFrame([claim(1, "2024-01-10", None, 100, 200)], SHAPE)
    assert views.current(c, "2024-02-01", 199).collect()[0].superseded_us is None
    assert ids(views.current(c, "2024-02-01", 200)) == []
    assert [r.superseded_us for r in views.history(c, "2024-02-01", 200).collect()] == [200]
    assert [r.superseded_us for r in views.history(c, "2024-02-01", 199).collect()] == [None]


def test_ties_and_statements(spark):
    c = spark.createDataFrame([claim(1, "2024-01-10", None, 100), claim(2, "2024-01-10", None, 100), claim(3, "2024-01-11", None, 50), claim(4, None, None, 10, None, "source_statement"), claim(5, "2030-01-01", None, 10, None, "source_statement", 2)], SHAPE)
    assert ids(views.current(c, "2024-01-10", 100)) == [2] and ids(views.current(c, "2024-01-11", 100)) == [3]
    assert ids(views.statements(c, 10)) == [4, 5] and ids(views.statements(c, 9)) == []
    assert ids(views.history(c, "2024-01-01", 100)) == [4, 5]
    assert ids(views.history(c, "2024-01-01", 100, spark.createDataFrame([(3,)], "claim_id long"))) == [3, 4, 5]


def test_graphs(spark):
    st = Staging(spark, "t")
    e = spark.createDataFrame([(4, 2), (4, 3), (2, 1), (3, 1), (1, 0)], "child long, parent long")
    seeds = spark.createDataFrame([(4,), (9,)], "root long")
    assert sorted(map(tuple, graph.closure(seeds, e, st).collect())) == [(4, 0), (4, 1), (4, 2), (4, 3), (4, 4), (9, 9)]
    assert graph.cyclic_nodes(e, st).count() == 0
    ring = e.unionByName(spark.createDataFrame([(0, 1)], "child long, parent long"))
    assert set(ids(graph.cyclic_nodes(ring, st), "node")) == {0, 1, 2, 3, 4}
    assert sorted(map(tuple, graph.closure(seeds.where("root = 4"), ring, st).collect()))[0] == (4, 0)
    nodes = spark.createDataFrame([(i,) for i in range(5)], "node long")
    direct = spark.createDataFrame([(0,), (2,)], "node long")
    assert ids(graph.supported(nodes, direct, e, st), "node") == [0, 1, 2, 3, 4]
    assert ids(graph.supported(nodes, direct.where("node = 2"), e, st), "node") == [2]


@pytest.mark.parametrize("n", [1, 40])
def test_components_of_paths_and_stars(spark, n):
    path = [(i, i + 1) for i in range(100, 100 + n)]
    star = [(5, i) for i in range(1000, 1000 + n)]
    e = spark.createDataFrame(path + star + [(7, 7), (None, 3)], "src long, dst long")
    got = {r.node: r.component for r in graph.connected_components(e, Staging(spark, "t")).collect()}
    assert got == {i: 100 for i in range(100, 101 + n)} | {5: 5} | {i: 5 for i in range(1000, 1000 + n)}
    assert graph.connected_components(e.where("false"), Staging(spark, "t")).count() == 0


def components_by_hand(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("held", [500_000, 20])
def test_components_in_one_task_and_by_rounds(spark, monkeypatch, held):
    """Graphs of more than HELD edges go by rounds, with the same result."""
    monkeypatch.setattr(graph, "HELD", held, raising=False)
    rng = random.Random(4)
    edges = [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(180)] + [(1000, i) for i in range(1001, 1060)] + [(i, i + 1) for i in range(2000, 2050)]
    edges = [e for e in edges if e[0] != e[1]]
    e = spark.createDataFrame(edges, "src long, dst long").repartition(3)
    got = [tuple(r) for r in graph.connected_components(e, Staging(spark, "t")).collect()]
    assert len(got) == len(set(got)) and dict(got) == components_by_hand(edges)


def test_components_of_few_edges_take_few_tasks(spark):
    """A small graph pays for no rounds over all shuffle partitions, whose tasks the driver would have to keep."""
    spark.sparkContext.setJobGroup("few edges", "few edges")
    try:
        e = spark.createDataFrame([(i, i + 1) for i in range(300)], "src long, dst long")
        out = graph.connected_components(e, Staging(spark, "t"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    told = spark.sparkContext.statusTracker()
    stages = [told.getStageInfo(s) for j in told.getJobIdsForGroup("few edges") for s in told.getJobInfo(j).stageIds]
    assert 0 < sum(s.numTasks for s in stages if s) <= 20 and out.count() == 301


def test_alert_thresholds(spark):
    pairs = spark.createDataFrame([(1, 2, 1, "p", 100.0, 115.0), (3, 4, 1, "p", 100.0, 114.9), (5, 6, 1, "p", 0.0, 0.5), (7, 8, 1, "p", 0.0, 8.0)], "prior_id long, current_id long, entity_id long, predicate string, prior_value double, current_value double")
    got = {r.prior_id: (r.relative_change, r.severity) for r in changes.capacity_alerts(pairs).collect()}
    assert got == {1: (0.15, "low"), 5: (0.5, "medium"), 7: (1.0, "high")}
    days = [(1, "expected", "expected", 90), (2, "expected", "expected", 89), (3, "expected", "delayed", 1), (4, "cancelled", "cancelled", 500), (5, "cancelled", "expected", 0), (6, "expected", "cancelled", 0), (7, "expected", "expected", -360)]
    base = F.lit("2024-01-01").cast("date")
    m = spark.createDataFrame(days, "key int, prior_status string, current_status string, d int").select("*", base.alias("prior_base"), F.date_add(base, F.col("d")).alias("current_base"))
    assert {r.key: (r.alert_type, r.severity) for r in changes.milestone_alerts(m).collect()} == {1: ("completion_delay", "low"), 3: ("completion_delay", "medium"), 5: ("project_reactivation", "medium"), 6: ("project_cancellation", "high"), 7: ("completion_acceleration", "high")}


def test_overlaps_equal_brute_force(spark):
    rows = [(1 + i % 2, i, date.fromordinal(738000 + (i * 37) % 300), date.fromordinal(738001 + (i * 37) % 300 + i * 13 % 200) if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, id int, s date, e date")
    far = date(9999, 12, 31)
    want = sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and a[2] < (b[3] or far) and b[2] < (a[3] or far))
    assert sorted(map(tuple, intervals.overlapping_pairs(df, "k", "id", "s", "e", 16).collect())) == want


def test_straddling_both_is_vintage_first(spark):
    d = lambda s: F.lit(s).cast("date")
    r = spark.range(1).select(intervals.relation(d("2023-01-01"), d("2030-01-01"), d("2024-01-01"), d("2025-01-01")).alias("a"), intervals.relation(d("2024-01-02"), d("2025-01-01"), d("2024-01-01"), d("2025-01-01")).alias("b"), intervals.relation(d("2023-01-02"), d("2024-01-01"), d("2024-01-01"), d("2025-01-01")).alias("c")).first()
    assert tuple(r) == ("vintage_straddling", "within_horizon", "pre_vintage")


def test_write_plans(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1.0)], "k int, s string, v double")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 2.0), (3, "c", None)], "k int, s string, v double")
    fresh, clash = refresh.insert_or_verify(old, new, "k")
    assert [r.k for r in fresh.collect()] == [3] and [(r.k, r["columns"]) for r in clash.collect()] == [(2, ["v"])]
    a = spark.createDataFrame([(1, "p", 1.0), (2, "p", None), (3, "p", 1.0)], "entity_id int, predicate string, value double")
    b = spark.createDataFrame([(1, "p", 1.0), (2, "p", 5.0), (4, "p", 1.0)], "entity_id int, predicate string, value double")
    plan = lambda full: {r.entity_id: r.action for r in refresh.refresh_plan(a, b, complete=full).collect()}
    assert plan(True) == {1: "reuse", 2: "replace", 3: "close", 4: "insert"} and plan(False)[3] == "keep"


def test_records(spark):
    rows = spark.createDataFrame([(1, "plan in Ohio", 1), (1, "big plan in Ohio now", 2), (1, "plans in Ohio", 3), (2, "plan in Ohio", 4)], "k int, t string, id int")
    assert ids(records.drop_subsumed(rows, "k", "id", "t"), "id") == [2, 3, 4]
    got = identity.single_values(spark.createDataFrame([(1, "x"), (1, "x "), (2, "x"), (2, "y"), (3, " ")], "r int, v string"), "r", "v")
    assert {r.r: (r.v, r.reason) for r in got.collect()} == {1: ("x", "accepted"), 2: (None, "conflict"), 3: (None, "blank")}


def test_largest_gap_with_edges(spark):
    from claimlens.operators import evaluate

    h = evaluate.HOUR_US
    rows = spark.createDataFrame([(1, 5 * h), (1, 5 * h + 10), (1, 9 * h), (2, h)], "k int, us long")
    got = {r.k: r.largest_gap_seconds for r in evaluate.largest_gap(rows, 4 * h, 10 * h, ("k",)).collect()}
    assert got == {1: (4 * h - 10) / 1e6, 2: 9 * h / 1e6}
    assert evaluate.largest_gap(rows, 0, 10 * h).first()[0] == 4 * h / 1e6


def test_alert_thresholds_are_exact(spark):
    rows = [(1, 100.0, 115.0, 0.5, 0.5), (2, 100.0, 114.9999999, 0.5, 0.5), (3, 1.0, 1.149999, 0.5, 0.5), (4, 100.0, 130.0, None, 0.5), (5, 0.0, 0.2, 0.5, 0.5), (6, -100.0, -115.0, 0.5, 0.5)]
    pairs = spark.createDataFrame(rows, "current_id long, prior_value double, current_value double, prior_confidence double, current_confidence double").selectExpr("*", "0L as prior_id", "1L as entity_id", "'p' as predicate")
    got = {r.current_id: (r.direction, r.severity) for r in changes.capacity_alerts(pairs).collect()}
    assert got == {1: ("increase", "low"), 2: ("increase", "low"), 5: ("increase", "low"), 6: ("increase", "low")}  # 114.9999999 is 115.000000 in millionths


def test_candidates_are_ranked(spark):
    pairs = spark.createDataFrame([(1, 9, 0.5), (1, 7, 0.5), (1, 8, 0.9), (2, 7, 0.1)], "l int, r int, score double")
    assert sorted((x.l, x["rank"], x.r) for x in identity.ranked(pairs, "l", "r", 2).collect()) == [(1, 1, 8), (1, 2, 7), (2, 1, 7)]


def test_subsumed_only_with_the_same_amount(spark):
    rows = spark.createDataFrame([(1, "fab", "new fab", 5), (2, "fab", "a new fab site", 5), (3, "fab", "new fab", 6)], "id int, k string, t string, amount int")
    assert sorted(r.id for r in records.drop_subsumed(rows, "k", "id", "t", ("amount",)).collect()) == [2, 3]
    assert sorted(r.id for r in records.drop_subsumed(rows, "k", "id", "t").collect()) == [2]


def test_model_parameters_have_a_fingerprint():
    assert len(forecast.fingerprint()) == 64 and forecast.fingerprint() != forecast.fingerprint(policy="steady")
    for bad in ({"basis": {"x": (0.5, 0.4, 1.0)}}, {"ramp_": ((0.5, 0.5, 0.5),)}, {"policy": "none"}):
        with pytest.raises(ValueError):
            forecast.fingerprint(**bad)


def test_tree_digest_counts_repeats_and_forgets_order(spark):
    one = lambda *v: tuple(tree_digest(spark.createDataFrame([(x,) for x in v], "v string"), F.col("v")).first())
    assert one("a", "b", "b") == one("b", "a", "b") != one("a", "b") and one("a")[0] == 1
    assert tree_digest(spark.createDataFrame([], "v string"), F.col("v")).first()["rows"] == 0


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]"])
def test_shared_folder_is_required_on_a_cluster(master):
    context = SimpleNamespace(getCheckpointDir=lambda: None, master=master)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context))


def observed(*rows):
    """Observations of one series: (release, prior release, before, after, proposed)."""
    return [(1, n, r, p, f"m{p}", b, a, f"{b}>{a}" if s else None, f"p{n}") for n, (r, p, b, a, s) in enumerate(rows)]


@pytest.mark.parametrize(
    ("rows", "new"),
    [
        ([(10, 5, "a", "b", True), (20, 5, "a", "b", True)], [True, False]),  # seen again in a later release
        ([(10, 5, "a", "b", True), (20, 15, "a", "b", True)], [True, True]),  # the prior release shows that it had returned
        ([(10, 5, "a", "b", True), (20, 5, "a", "c", True), (30, 5, "a", "b", True)], [True, True, True]),  # another transition between
        ([(20, 5, "a", "b", True), (10, 5, "a", "b", True)], [True, False]),  # a late release on the same prior is a backfill
        ([(20, 5, "a", "b", True), (10, 3, "a", "b", True)], [True, True]),  # a late release on another prior is not
        ([(10, 5, "a", "b", True), (15, 10, "b", None, False), (20, 5, "a", "b", True)], [True, False]),  # an omission withdraws nothing
        ([(10, 5, "a", "b", True), (15, 10, "b", "b", False), (20, 5, "a", "b", True)], [True, False]),  # carried on
        ([(10, 5, "a", "b", True), (15, 10, "b", "a", False), (20, 5, "a", "b", True)], [True, True]),  # its value went back
    ],
)
def test_episodes(spark, rows, new):
    got = polling.episodes(spark.createDataFrame(observed(*rows), polling.OBSERVED)).orderBy("sequence").collect()
    assert [r.is_new for r in got] == new
    assert len({r.episode for r in got}) == sum(new)


def told_by_definition(log):
    """{sequence: (first sequence of its episode, floor)} of one series' proposals, each from all that was logged before it."""

    def stood(i):
        return max((j for j in range(i) if log[j].after is not None), key=lambda j: (log[j].release_us, j), default=None)

    @functools.cache
    def alert(i):
        """Where the alert that observation i stands under began."""
        o, s = log[i], stood(i)
        held = None if s is None else alert(s)
        if o.signature is None:
            return held if s is not None and log[s].after == o.after else None
        if held is None or log[held].signature != o.signature:
            return i
        if o.before is not None and o.prior_release_us >= log[held].release_us and o.before != log[held].after:
            return i
        newer = o.release_us > log[s].release_us
        backfill = o.prior_manifest is not None and o.prior_manifest == log[held].prior_manifest and o.release_us > floor(held)
        return held if newer or backfill else i

    @functools.cache
    def floor(i):
        o, s = log[i], stood(i)
        if s is not None and log[s].after != o.after and o.prior_release_us < log[s].release_us < o.release_us:
            return log[s].release_us
        return o.prior_release_us

    return {o.sequence: (log[alert(i)].sequence, floor(alert(i))) for i, o in enumerate(log) if o.signature is not None}


def test_episodes_of_many_series_equal_the_definition(spark):
    rng = random.Random(8)
    names = [c.split()[0] for c in polling.OBSERVED.split(", ")]
    log = [
        SimpleNamespace(series_id=s, sequence=n * 3, release_us=(r := rng.randrange(4, 30)), prior_release_us=r - rng.randrange(1, 9), prior_manifest=rng.choice(["m", "n", None]), before=rng.choice(["a", "b", None]), after=rng.choice(["a", "b", "c", None]), signature=rng.choice(["x", "y", None]), packet=f"p{n}")
        for s in range(60)
        for n in range(25)
    ]
    rows = [tuple(getattr(o, c) for c in names) for o in log]
    rng.shuffle(rows)
    got = polling.episodes(spark.createDataFrame(rows, polling.OBSERVED)).collect()
    repeats = 0
    for s in range(60):
        want = told_by_definition([o for o in log if o.series_id == s])
        own = {r.sequence: r for r in got if r.series_id == s}
        first = {r.episode: q for q, r in own.items() if r.is_new}
        assert {q: (first[r.episode], r.floor_us) for q, r in own.items()} == want
        repeats += sum(not r.is_new for r in own.values())
    assert repeats > 30


def test_capacities_share_links_by_group(spark):
    caps = "capacity_id long, entity_id long, basis string, unit string, metric string, confidence double, valid_from date, period_start date, period_end date, peers long"
    day = date(2023, 1, 1)
    capacities = spark.createDataFrame([(i, i % 3, "announced", "wafers", "output", 0.5, day, None, None, i % 6) for i in range(24)], caps)
    sides = ["expected", "cancelled", "started", "unknown", "expected"]
    milestones = spark.createDataFrame([(m, m % 3, "mass_production", sides[m % 5], 0.5 if m % 4 else None, day, date(2024, 6, m), date(2024, 6, m)) for m in range(1, 13)], "milestone_id long, entity_id long, milestone_type string, status string, confidence double, valid_from date, low date, base date")
    pairs = [(p, m) for p in range(6) for m in range(1, 13) if p % 3 == m % 3 and (p * 5 + m) % 4 < 2 and p != 5]
    shared = spark.createDataFrame(pairs, "peers long, milestone_id long")
    each = capacities.select("capacity_id", "peers").join(shared, "peers").select("capacity_id", "milestone_id")
    reviews = each.groupBy("capacity_id").agg(F.min("milestone_id").alias("milestone_id")).withColumn("decision", F.lit("accepted"))
    supported = spark.range(30).select(F.col("id").alias("node"))
    by_pair = forecast.selection(capacities, milestones, each, reviews, supported, "2024-02-10")
    by_group = forecast.selection(capacities, milestones, shared, reviews, supported, "2024-02-10", by="peers")
    got = sorted(map(str, by_group.collect()))
    assert got == sorted(map(str, by_pair.collect())) and len(got) == 24
    assert len({r.reason for r in by_group.collect()}) > 2 and any(r.related for r in by_group.collect())
    # what is not asked is not joined: reasons alone need no list of milestones beside a capacity
    plan = by_group.select("capacity_id", "reason")._jdf.queryExecution().optimizedPlan().toString()
    full = by_group._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == full.count("Join LeftOuter") - 2


@pytest.mark.parametrize("circles", [False, True])
def test_sets_rise_and_closures_go_on_by_doubling(spark, circles):
    rng = random.Random(circles)
    edges = {(a, rng.randrange(a)) for a in range(1, 12) for _ in range(2)} | {(i + 1, i) for i in range(12, 22)}
    edges |= {(3, 7), (11, 11), (12, 14)} if circles else {(11, 11)}
    after = {n: [b for a, b in edges if a == n] for n in range(23)}

    def reach(n):
        seen, todo = {n}, [n]
        while todo:
            new = [b for b in after[todo.pop()] if b not in seen]
            seen.update(new)
            todo += new
        return seen

    rows = spark.createDataFrame([*edges, (None, 1), (5, None)], "child long, parent long")
    told = spark.createDataFrame([(n, n % 11) for n in range(0, 23, 3)] + [(7, None), (9, 50)], "node long, value long")
    of = {n: ({n % 11} if n % 3 == 0 else set()) | ({50} if n == 9 else set()) for n in range(23)}
    nodes = spark.createDataFrame([(n,) for n in range(0, 23, 2)] + [(999,)], "node long")
    st = Staging(spark, "sets")
    got = {r.node: r.held for r in graph.gathered(nodes, told, rows, st).collect()}
    assert got == {n: sorted(set().union(*(of[m] for m in reach(n)))) for n in range(0, 23, 2)} | {999: []}
    seeds = spark.createDataFrame([(22,), (10,), (4,), (11,)], "root long")
    want = sorted((s, n) for s in (22, 10, 4, 11) for n in reach(s))
    for rounds in (1, 32):  # ten links: by doubling after one round, or by single steps
        assert sorted(map(tuple, graph.closure(seeds, rows, st, rounds).collect())) == want


def test_support_looks_at_edges_that_are_left(spark, monkeypatch):
    """Rounds of support write ever fewer edges, not all of them again."""
    n = 12
    nodes = spark.range(2 * n).select(F.col("id").alias("node"))
    edges = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(i, n + 3) for i in range(1, n)] + [(20, 99), (22, 22)], "child long, parent long")
    sizes, table = [], Staging.table

    def counted(self, df, name):
        out = table(self, df, name)
        if name == "edges":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(Staging, "table", counted)
    direct = spark.createDataFrame([(0,), (n + 3,), (77,)], "node long")
    assert sorted(r.node for r in graph.supported(nodes, direct, edges, Staging(spark, "s")).collect()) == [*range(n + 1), n + 3]
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[2] and sizes[-1] == 2
