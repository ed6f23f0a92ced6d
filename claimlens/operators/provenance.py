"""Provenance as a typed graph: what seeds rest on, over many relations at once, and circles kept out at admission.

Nodes are (kind, id); a relation leads from nodes of one kind to nodes of another. All relations are one edge table, so a
round expands the frontier of every kind together, and only what the seeds reach is ever read again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.graph import expand
from claimlens.plans.staging import Staging


class Relation(NamedTuple):
    """rows with a column of each end: `of` nodes of kind `child` rest on `on` nodes of kind `parent`."""

    name: str
    child: str
    of: str
    parent: str
    on: str
    rows: DataFrame


def edges(relations: list[Relation]) -> DataFrame:
    """(relation, kind, id, next_kind, next_id) of all relations; ids as text; rows without one of their ends are none."""
    out = None
    for r in relations:
        ends = r.rows.select(F.col(r.of).cast("string").alias("id"), F.col(r.on).cast("string").alias("next_id")).where("id is not null and next_id is not null")
        one = ends.select(F.lit(r.name).alias("relation"), F.lit(r.child).alias("kind"), "id", F.lit(r.parent).alias("next_kind"), "next_id")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def trace(seeds: DataFrame, graph: DataFrame, staging: Staging, budget: int | None = None) -> DataFrame:
    """(root_kind, root, kind, id): every node that a seed (kind, id) reaches over (kind, id, next_kind, next_id), itself included.

    One round a step away from the seeds, of the new nodes alone; circles end, as what is reached is not new. With a budget,
    a seed that reaches more nodes is an error that names it: nothing is cut.
    """
    seeds = seeds.select("kind", F.col("id").cast("string").alias("id")).distinct()
    ends = graph.select("kind", "id").unionByName(graph.select(F.col("next_kind").alias("kind"), F.col("next_id").alias("id"))).unionByName(seeds)
    # rounds walk on numbers; names come back once, at the end
    named = staging.table(ends.distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    after = named.select(F.col("kind").alias("next_kind"), F.col("id").alias("next_id"), F.col("node").alias("next"))
    steps = staging.table(graph.join(named, ["kind", "id"]).join(after, ["next_kind", "next_id"]).select("node", "next").distinct(), "edges")
    roots = staging.table(seeds.join(named, ["kind", "id"]).select(F.col("node").alias("root_"), F.col("kind").alias("root_kind"), F.col("id").alias("root")), "roots")
    begin = staging.table(roots.select(F.col("root_").alias("root"), F.col("root_").alias("node")), "frontier")

    def check(held: DataFrame) -> None:
        most = held.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > budget).select("root")  # with repeats
        over = held.join(most, "root", "left_semi").groupBy("root").agg(F.countDistinct("node").alias("n")).where(F.col("n") > budget)
        over = over.join(named.withColumnRenamed("node", "root"), "root").orderBy(F.desc("n"), "kind", "id").first()
        if over:
            raise ValueError(f"{over.kind} {over.id} rests on more than {budget} nodes")

    one = lambda rows, edges: rows.join(edges, "node").select("root", F.col("next").alias("node"))
    held, _, _ = expand(begin, steps, one, staging, check=None if budget is None else check)
    pairs = held.distinct().select(F.col("root").alias("root_"), "node")
    return pairs.join(named, "node").join(roots, "root_").select("root_kind", "root", "kind", "id")


def traced_edges(nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """(root_kind, root, relation, kind, id, next_kind, next_id): the edges below the nodes of each root."""
    return nodes.join(graph, ["kind", "id"]).select("root_kind", "root", "relation", "kind", "id", "next_kind", "next_id")


def broken(rules: dict[str, DataFrame]) -> DataFrame:
    """(kind, id, fault), each once. rules: by kind, (id, fault) of that kind's rows that break a rule."""
    found = None
    for kind, rows in sorted(rules.items()):
        one = rows.select(F.lit(kind).alias("kind"), F.col("id").cast("string").alias("id"), "fault")
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def faults(nodes: DataFrame, rules: dict[str, DataFrame]) -> DataFrame:
    """(root_kind, root, kind, id, fault) of the nodes of a trace; rules as in `broken`."""
    return nodes.join(broken(rules), ["kind", "id"]).select("root_kind", "root", "kind", "id", "fault")


# ---------------------------------------------------------------- circles


def _meet(asked: DataFrame, graph: DataFrame, staging: Staging) -> DataFrame:
    """(seq, path): for each asked (seq, start, end; these differ) that has one, its shortest path over (child, parent, seq of an edge).

    An edge counts for what comes after it. Two searches go towards each other from the ends, one step in turn, and a
    question leaves as soon as they meet; of paths of one length the least is told. The graph is staged.
    """
    ahead = staging.table(asked.select("seq", F.col("start").alias("node"), F.array("start").alias("path")), "ahead")
    back = staging.table(asked.select("seq", F.col("end").alias("node"), F.array("end").alias("path")), "back")
    fronts, seen, found = [ahead, back], [ahead, back], None
    usable = graph.select("child", "parent", F.col("seq").alias("since"))
    step = 0
    while not (fronts[0].isEmpty() or fronts[1].isEmpty()):
        side = step % 2
        near, far = ("child", "parent") if side == 0 else ("parent", "child")
        longer = F.concat("path", F.array(far)) if side == 0 else F.concat(F.array(far), F.col("path"))
        out = fronts[side].join(usable, F.col("node") == F.col(near)).where("since < seq").select("seq", F.col(far).alias("node"), longer.alias("path")).groupBy("seq", "node").agg(F.min("path").alias("path"))
        fresh = staging.table(out.join(seen[side].select("seq", "node"), ["seq", "node"], "left_anti"), "front")
        both = [fresh, fronts[1]] if side == 0 else [fronts[0], fresh]
        joint = both[0].select("seq", "node", F.col("path").alias("head")).join(both[1].select("seq", "node", F.col("path").alias("tail")), ["seq", "node"])
        met = staging.table(joint.groupBy("seq").agg(F.min(F.concat("head", F.slice("tail", 2, F.size("tail")))).alias("path")), "met")
        found = met if found is None else found.unionByName(met)
        seen[side] = seen[side].unionByName(fresh)
        fronts[side] = staging.table(fresh.join(met, "seq", "left_anti"), "front")
        fronts[1 - side] = staging.table(fronts[1 - side].join(fronts[side].select("seq").distinct(), "seq", "left_semi"), "front")
        step += 1
    return found if found is not None else asked.select("seq", F.array("start").alias("path")).limit(0)


def _peeled(edges: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(node, rank) with the rank of no child above its parent's, and the edges (child, parent) between equal ranks.

    Nodes that nobody rests on are taken off from above, nodes that rest on nobody from below, round by round, as long as that
    takes a fifth of the edges away; nodes without a rank have rank zero, below those taken off from above and above the others.
    Circles are never taken off.
    """
    left, size, n, ranks = staging.table(edges.where("child is not null and parent is not null").distinct(), "edges"), None, 0, None
    while size is None or size:
        n += 1
        led = left.select(F.col("parent").alias("child")).distinct().withColumn("led", F.lit(True))
        leads = left.select(F.col("child").alias("parent")).distinct().withColumn("leads", F.lit(True))
        marked = staging.table(left.select("child", "parent").join(led, "child", "left").join(leads, "parent", "left").select("child", "parent", F.col("led").isNull().alias("top"), F.col("leads").isNull().alias("low")), "marked")
        ends = F.explode(F.array(F.when(F.col("top"), F.struct(F.col("child").alias("node"), F.lit(n - (1 << 40)).alias("rank"))), F.when(F.col("low"), F.struct(F.col("parent").alias("node"), F.lit((1 << 40) - n).alias("rank")))))
        taken = marked.where("top or low").select(ends.alias("e")).where("e is not null").select("e.*")
        ranks = taken if ranks is None else ranks.unionByName(taken)
        before = marked.count() if size is None else size
        left = marked.where("not top and not low")
        size = left.count()
        if size * 5 > before * 4:
            break
    return ranks.distinct(), left.select("child", "parent")


def guard(proposed: DataFrame, standing: DataFrame, staging: Staging) -> DataFrame:
    """(seq, child, parent, refused, path): proposed edges as they would be admitted one after another, in the order of seq.

    An edge is refused if its parent already rests on its child, over standing edges or those admitted before it; path is
    the way from the parent to the child. standing: child, parent, without circles.

    Standing edges are ranked. New ones that go up by rank close no circle, alone or together, so only the others are searched,
    from both their ends, over what stands and what goes up. If all of them close a circle there, they are refused, the rest is
    admitted and all is said. Else edges are decided in rounds: refused where edges that are in close the circle, admitted
    where not even undecided ones could; each round decides the first that is left.
    """
    left = staging.table(proposed.select("seq", "child", "parent"), "proposed")
    none = F.lit(None).cast("array<bigint>")
    loops = left.where("child = parent").select("seq", "child", "parent", F.lit(True).alias("refused"), F.array("child").alias("path"))
    left = left.where("not coalesce(child = parent, false)")
    inside = staging.table(standing.select("child", "parent", F.lit(-1).cast("long").alias("seq")), "inside")
    ask = lambda rows: rows.select("seq", F.col("parent").alias("start"), F.col("child").alias("end"))
    ranks, _ = _peeled(inside.select("child", "parent"), staging)
    rank = lambda end: ranks.select(F.col("node").alias(end), F.col("rank").alias(f"{end}_rank"))
    ranked = left.join(rank("child"), "child", "left").join(rank("parent"), "parent", "left")
    up = F.coalesce("child_rank", F.lit(0)) < F.coalesce("parent_rank", F.lit(0))
    ranked = staging.table(ranked.select("seq", "child", "parent", (up | F.col("child").isNull() | F.col("parent").isNull()).alias("up")), "ranked")
    against = ranked.where("not up").select("seq", "child", "parent")
    certain = staging.table(inside.unionByName(ranked.where("up").select("child", "parent", "seq")), "usable")
    closed = staging.table(_meet(ask(against), certain, staging), "closed")
    if against.join(closed, "seq", "left_anti").isEmpty():
        out = ranked.join(closed, "seq", "left").select("seq", "child", "parent", (~F.col("up")).alias("refused"), "path")
        return staging.table(loops.unionByName(out), "decided")
    left, decided = ranked.select("seq", "child", "parent"), None
    while not left.isEmpty():
        firm = staging.table(_meet(ask(left), inside, staging).select("seq"), "firm")
        said = staging.table(left.join(firm, "seq", "left_semi").withColumn("refused", F.lit(True)), "said")
        left = staging.table(left.join(firm, "seq", "left_anti"), "left")
        _, core = _peeled(inside.select("child", "parent").unionByName(left.select("child", "parent")), staging)
        core = staging.table(core, "core")
        usable = staging.table(inside.unionByName(left.select("child", "parent", "seq")).join(core, ["child", "parent"], "left_semi"), "usable")
        unsure = staging.table(_meet(ask(left.join(core, ["child", "parent"], "left_semi")), usable, staging).select("seq"), "unsure")
        free = left.join(unsure, "seq", "left_anti")
        decided = said if decided is None else decided.unionByName(said)
        decided = decided.unionByName(staging.table(free.withColumn("refused", F.lit(False)), "said"))
        inside = staging.table(inside.unionByName(free.select("child", "parent", "seq")), "inside")
        left = staging.table(left.join(unsure, "seq", "left_semi"), "left")
    # edges admitted late may shorten the way of one refused early
    ways = _meet(ask(decided.where("refused")), inside, staging)
    return staging.table(loops.unionByName(decided.join(ways, "seq", "left").select("seq", "child", "parent", "refused", F.coalesce("path", none).alias("path"))), "decided")


# ---------------------------------------------------------------- paths


class Path(NamedTuple):
    """A path expression as a small automaton without empty moves: which moves begin it, follow each other, and end it.

    moves: predicates, with a caret before those walked backwards; first, last: positions in moves; follows: pairs of them.
    """

    moves: tuple[str, ...]
    first: frozenset[int]
    last: frozenset[int]
    follows: frozenset[tuple[int, int]]
    empty: bool

    def _after(self, n: int) -> Path:
        up = lambda s: frozenset(x + n for x in s)
        return Path(self.moves, up(self.first), up(self.last), frozenset((a + n, b + n) for a, b in self.follows), self.empty)

    def __truediv__(self, other: Path) -> Path:
        """This path, then the other one."""
        own, other = self, other._after(len(self.moves))
        joint = frozenset((a, b) for a in own.last for b in other.first)
        return Path(own.moves + other.moves, own.first | other.first if own.empty else own.first, own.last | other.last if other.empty else other.last, own.follows | other.follows | joint, own.empty and other.empty)

    def __or__(self, other: Path) -> Path:
        """Either path."""
        other = other._after(len(self.moves))
        return Path(self.moves + other.moves, self.first | other.first, self.last | other.last, self.follows | other.follows, self.empty or other.empty)

    def plus(self) -> Path:
        """This path, once or more."""
        return self._replace(follows=self.follows | frozenset((a, b) for a in self.last for b in self.first))

    def star(self) -> Path:
        """This path, any number of times."""
        return self.plus()._replace(empty=True)

    def maybe(self) -> Path:
        return self._replace(empty=True)


def step(predicate: str) -> Path:
    """One triple, from subject to object; `^predicate` from object to subject."""
    one = frozenset([0])
    return Path((predicate,), one, one, frozenset(), False)


def follow(starts: DataFrame, triples: DataFrame, path: Path, staging: Staging) -> DataFrame:
    """(start, end): all pairs that a path connects, once each, as sets of pairs are closed to a fixpoint.

    starts: one column node; triples: subject, predicate, object. The states of the search are (start, position, node): the
    product of the triples with the path's automaton, restricted to what the starts reach.
    """
    spark = starts.sparkSession
    used = sorted({m.lstrip("^") for m in path.moves})
    both = triples.where(F.col("predicate").isin(used))
    walk = both.select("predicate", F.col("subject").alias("node"), F.col("object").alias("to"))
    back = both.select(F.concat(F.lit("^"), "predicate").alias("predicate"), F.col("object").alias("node"), F.col("subject").alias("to"))
    walk = staging.table(walk.unionByName(back).where(F.col("predicate").isin(sorted(set(path.moves)))).where("node is not null and to is not null").distinct(), "walk")
    moves = [(-1, path.moves[b], b) for b in sorted(path.first)] + [(a, path.moves[b], b) for a, b in sorted(path.follows)]
    table = spark.createDataFrame(moves, "at int, predicate string, next int")  # as small as the expression
    begin = staging.table(starts.select(F.col("node").alias("start"), F.lit(-1).alias("at"), "node").where("node is not null").distinct(), "states")
    one = lambda rows, walk: rows.join(F.broadcast(table), "at").join(walk, ["predicate", "node"]).select("start", F.col("next").alias("at"), F.col("to").alias("node"))
    seen, _, _ = expand(begin, walk, one, staging, to="to")
    ends = seen.where(F.col("at").isin(sorted(path.last)) | ((F.col("at") == -1) & F.lit(path.empty)))
    return ends.select("start", F.col("node").alias("end")).distinct()


def listed(values: Column, separator: str = "; ") -> Column:
    """Distinct values of a group in order, joined."""
    return F.array_join(F.array_sort(F.collect_set(values)), separator)
