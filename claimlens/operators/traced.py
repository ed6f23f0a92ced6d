"""Answers over whole traces of a typed graph, for many roots at once, without listing their pairs of root and node.

Roots that lie beside each other go in groups. The cluster walks (group, node): once for all roots of a group, so what they
share is read and shuffled once. The edges below a group then meet in one task, where a node holds the set of its roots as
bits, and sets rise along the edges until nothing changes. Kinds that lead back to themselves are walked by steps; the
others follow in their order, one join a kind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators import provenance
from claimlens.operators.graph import HELD, expand
from claimlens.operators.provenance import Relation
from claimlens.plans.session import spread
from claimlens.plans.staging import Staging

#: Roots of a group are two to this power: the bits that a node holds.
BITS = 8
#: Rows of a group that one task holds; the roots of larger groups are traced pair by pair.
HEAVY = 1_000_000
#: Bits unpacked at once.
UNPACKED = 1 << 24
_NODE = ["kind", "id"]
_NEXT = ["next_kind", "next_id"]
#: Joins sort by ids first: their first bytes differ, those of kinds hardly.
_BY = ["id", "kind"]
_ROWS = ["group", "relation", *_NODE, *_NEXT]


# ---------------------------------------------------------------- the walk by groups


def _ordered(relations: list[Relation]) -> list[tuple[set[str], bool]]:
    """Sets of kinds that lead to each other, each before those it leads to, and whether a walk can stay inside."""
    kinds = sorted({r.child for r in relations} | {r.parent for r in relations})
    after = {k: {r.parent for r in relations if r.child == k} for k in kinds}
    reach = {k: set(after[k]) for k in kinds}
    for mid in kinds:
        for k in kinds:
            if mid in reach[k]:
                reach[k] |= reach[mid]
    sets = {k: {k} | {x for x in reach[k] if k in reach[x]} for k in kinds}
    out: list[tuple[set[str], bool]] = []
    for k in sorted(kinds, key=lambda k: -len(reach[k] | {k})):  # what reaches another set reaches more than it
        if all(k not in own for own, _ in out):
            out.append((sets[k], k in reach[k]))
    return out


def _ends(relations: list[Relation]) -> DataFrame:
    """The edges of relations as they are in their rows, repeats and all."""
    out = None
    for r in relations:
        one = r.rows.select(F.lit(r.name).alias("relation"), F.lit(r.child).alias("kind"), F.col(r.of).cast("string").alias("id"), F.lit(r.parent).alias("next_kind"), F.col(r.on).cast("string").alias("next_id")).where("id is not null and next_id is not null")
        out = one if out is None else out.unionByName(one)
    return out


def _codes(values: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of texts in the order of their bytes, and the texts by number."""
    whole = values.cast(pa.large_string())
    coded = (whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole).dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[coded.indices.to_numpy()], coded.dictionary.take(pa.array(order))


def _starts(sources: np.ndarray, n: int) -> np.ndarray:
    """Where the edges of each of n nodes begin, in edges sorted by their source."""
    return np.searchsorted(sources, np.arange(n + 1))


def _leaving(nodes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The places of all edges that leave nodes."""
    many = starts[nodes + 1] - starts[nodes]
    return np.repeat(starts[nodes] - np.cumsum(many) + many, many) + np.arange(many.sum())


class _Core(NamedTuple):
    """A bounded graph: its nodes by number, its edges sorted by source."""

    kinds: pa.Array
    ids: pa.Array
    keys: np.ndarray
    starts: np.ndarray
    ahead: np.ndarray


def _core(table: pa.Table) -> _Core:
    pairs = [pa.chunked_array(table.column(a).chunks + table.column(b).chunks, pa.string()) for a, b in zip(_NODE, _NEXT, strict=True)]
    (kind, kinds), (ident, ids) = map(_codes, pairs)
    keys, at = np.unique(kind * len(ids) + ident, return_inverse=True)
    a, b = at.reshape(2, -1)
    order = np.argsort(a, kind="stable")
    return _Core(kinds, ids, keys, _starts(a[order], len(keys)), b[order])


def _inside(batches: Iterator[pa.RecordBatch], c: _Core) -> Iterator[pa.RecordBatch]:
    """(group, kind, id) of all that nodes of groups reach in the core, group by group."""
    seen = np.zeros(len(c.keys), bool)
    for batch in batches:
        kind, ident = (pc.index_in(batch.column(x).cast(pa.large_string()), value_set=v) for x, v in (("kind", c.kinds), ("id", c.ids)))
        known = pc.and_(kind.is_valid(), ident.is_valid())
        key = kind.filter(known).to_numpy().astype(np.int64) * len(c.ids) + ident.filter(known).to_numpy()
        group = batch.column("group").filter(known).to_numpy()
        at = np.searchsorted(c.keys, key)
        found = np.flatnonzero(c.keys[np.minimum(at, len(c.keys) - 1)] == key)
        found = found[np.argsort(group[found], kind="stable")]
        for g, own in zip(*_parts(group[found], at[found])):
            front, held = np.unique(own), []
            while len(front):
                seen[front] = True
                held.append(front)
                front = np.unique(c.ahead[_leaving(front, c.starts)])
                front = front[~seen[front]]
            nodes = np.concatenate(held)
            seen[nodes] = False
            names = [v.take(pa.array(x)).cast(pa.string()) for v, x in ((c.kinds, c.keys[nodes] // len(c.ids)), (c.ids, c.keys[nodes] % len(c.ids)))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), g)), *names], ["group", *_NODE])


def _parts(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct keys, sorted as they are, and the values of each."""
    firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[firsts], np.split(values, firsts[1:]) if len(keys) else []


def _closed(begin: DataFrame, edges: DataFrame, staging: Staging) -> DataFrame:
    """(group, kind, id): all that nodes of groups reach over edges, by rounds until a bounded graph is left, then in one go."""
    graph = staging.table(edges.select(*_NODE, *_NEXT), "steps")
    one = lambda rows, graph: rows.join(graph, _BY).select("group", *[F.col(t).alias(n) for n, t in zip(_NODE, _NEXT, strict=True)])
    held, fresh, left = expand(begin, graph, one, staging, node=_BY, to=["next_id", "next_kind"], small=HELD)
    if left.isEmpty() or fresh.isEmpty():
        return held.distinct()
    core = _core(left.toArrow())  # HELD edges at most
    sent = begin.sparkSession.sparkContext.broadcast(core)

    def inside(batches):
        return _inside(batches, sent.value)

    more = fresh.repartition("group").mapInArrow(inside, "group long, kind string, id string")
    return staging.table(held.unionByName(more).distinct(), "closed")


class _Walk(NamedTuple):
    members: DataFrame  # group, kind, id: the roots
    edges: DataFrame  # _ROWS, may repeat
    nodes: list[tuple[set[str], DataFrame]]  # group, kind, id of what is reached, by kinds


def _walk(seeds: DataFrame, relations: list[Relation], staging: Staging) -> _Walk:
    roots = staging.table(seeds.select("kind", F.col("id").cast("string").alias("id")).where("kind is not null and id is not null").distinct(), "roots")
    near = roots.orderBy("kind", F.length("id"), "id")  # ids that count up lie beside each other
    members = staging.table(near.select(F.shiftright(F.monotonically_increasing_id(), BITS).alias("group"), *_NODE), "members")
    arrived: dict[str, list[DataFrame]] = {}
    edges, nodes = None, []
    for kinds, again in _ordered(relations):
        begin = members.where(F.col("kind").isin(sorted(kinds)))
        for k in sorted(kinds):
            for one in arrived.get(k, []):
                begin = begin.unionByName(one)
        leaving = [r for r in relations if r.child in kinds]
        begin = begin.distinct()
        if again:
            reached = _closed(staging.table(begin, "begin"), _ends([r for r in leaving if r.parent in kinds]), staging)
        else:
            reached = begin
        nodes.append((kinds, reached))
        if not leaving:
            continue
        below = staging.table(spread(reached, *_BY).join(spread(_ends(leaving), *_BY), _BY).select(_ROWS), "below")
        edges = below if edges is None else edges.unionByName(below)
        for k in {r.parent for r in leaving} - kinds:
            arrived.setdefault(k, []).append(below.where(F.col("next_kind") == k).select("group", *[F.col(t).alias(n) for n, t in zip(_NODE, _NEXT, strict=True)]))
    return _Walk(members, edges, nodes)


# ---------------------------------------------------------------- a group in one task


class _Group(NamedTuple):
    """A group's graph: nodes sorted by kind and id; masks: the bits of the roots that reach each node."""

    kinds: pa.Array
    ids: pa.Array
    keys: np.ndarray
    masks: np.ndarray
    roots: np.ndarray
    edges: pa.Table
    ends: np.ndarray
    marks: pa.Table
    marked: np.ndarray

    def kind(self, nodes: np.ndarray) -> pa.Array:
        return self.kinds.take(pa.array(self.keys[nodes] // len(self.ids))).cast(pa.string())

    def id(self, nodes: np.ndarray) -> pa.Array:
        return self.ids.take(pa.array(self.keys[nodes] % len(self.ids))).cast(pa.string())

    def bits(self, nodes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Some nodes after some others, with a row of bits for each: which roots reach it."""
        step = max(1, UNPACKED // (64 * self.masks.shape[1]))
        for i in range(0, len(nodes), step):
            some = nodes[i : i + step]
            yield some, np.unpackbits(self.masks[some].view(np.uint8), axis=1, bitorder="little")[:, : len(self.roots)]


def _gathered(table: pa.Table) -> _Group:
    """Sets of roots rise along the edges; a node passes on only what is new to it, so circles end."""
    edges, rest = table.filter(pc.is_valid(table["relation"])), table.filter(pc.is_null(table["relation"]))
    members, marks = rest.filter(pc.is_null(rest["next_kind"])), rest.filter(pc.is_valid(rest["next_kind"]))
    parts = [(edges, *_NODE), (edges, *_NEXT), (members, *_NODE), (marks, *_NODE)]
    kind, kinds = _codes(pa.chunked_array([c for t, k, _ in parts for c in t[k].chunks], pa.string()))
    ident, ids = _codes(pa.chunked_array([c for t, _, i in parts for c in t[i].chunks], pa.string()))
    keys, at = np.unique(kind * len(ids) + ident, return_inverse=True)
    e, r = edges.num_rows, members.num_rows
    src, dst, roots, marked = np.split(at, [e, 2 * e, 2 * e + r])
    masks = np.zeros((len(keys), (r + 63) // 64), "<u8")
    masks[roots, np.arange(r) // 64] |= np.uint64(1) << (np.arange(r) % 64).astype(np.uint64)
    pair = np.unique(src * len(keys) + dst)
    a, ahead = np.divmod(pair, len(keys))
    starts = _starts(a, len(keys))
    new = masks.copy()
    front = np.unique(roots)
    while len(front):
        took = _leaving(front, starts)
        order = np.argsort(ahead[took], kind="stable")
        to, source = ahead[took][order], np.repeat(front, starts[front + 1] - starts[front])[order]
        firsts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]][: len(to)])
        come = np.bitwise_or.reduceat(new[source], firsts, axis=0) if len(to) else new[:0]
        to = to[firsts]
        come &= ~masks[to]
        fresh = come.any(axis=1)
        front, come = to[fresh], come[fresh]
        masks[front] |= come
        new[front] = come
    return _Group(kinds, ids, keys, masks, roots, edges, np.stack([src, dst]), marks, marked)


def _met(g: _Group) -> tuple[np.ndarray, np.ndarray]:
    """How many nodes each root reaches, and how many roots reach each node."""
    nodes, roots = np.zeros(len(g.roots), np.int64), np.zeros(len(g.keys), np.int64)
    for some, bits in g.bits(np.arange(len(g.keys))):
        nodes += bits.sum(axis=0, dtype=np.int64)
        roots[some] = bits.sum(axis=1, dtype=np.int64)
    return nodes, roots


def _counted(g: _Group) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """How many nodes each root reaches; by kind, how many of it, and the first of these."""
    of = g.keys // len(g.ids)
    many, first = [], []
    for k in range(len(g.kinds)):
        n, least = np.zeros(len(g.roots), np.int64), np.full(len(g.roots), -1)
        for some, bits in g.bits(np.flatnonzero(of == k)):
            n += bits.sum(axis=0, dtype=np.int64)
            least = np.where((least < 0) & bits.any(axis=0), some[bits.argmax(axis=0)], least)
        many.append(n)
        first.append(least)
    return np.sum(many, axis=0), many, first


def _over(g: _Group, total: np.ndarray, budget: int | None, names: list[str]) -> pa.Table:
    """Roots that rest on more nodes than the budget, as rows with `over` alone."""
    bad = np.flatnonzero(total > budget) if budget is not None else np.zeros(0, int)
    own = {"root_kind": g.kind(g.roots[bad]), "root": g.id(g.roots[bad]), "over": pa.array(total[bad])}
    return pa.table({n: own.get(n, pa.nulls(len(bad), _ARROW[n])) for n in names})


_ARROW = {"root_kind": pa.string(), "root": pa.string(), "kind": pa.string(), "id": pa.string(), "n": pa.int64(), "first_id": pa.string(), "relation": pa.string(), "next_kind": pa.string(), "n_roots": pa.int64(), "fault": pa.string(), "over": pa.int64()}


def _counts_of(table: pa.Table, budget: int | None, names: list[str]) -> pa.Table:
    g = _gathered(table)
    total, many, first = _counted(g)
    out = [_over(g, total, budget, names)]
    for n, least in zip(many, first, strict=True):
        own = np.flatnonzero(n)
        out.append(pa.table({"root_kind": g.kind(g.roots[own]), "root": g.id(g.roots[own]), "kind": g.kind(least[own]), "n": pa.array(n[own]), "first_id": g.id(least[own]), "over": pa.nulls(len(own), pa.int64())}).select(names))
    return pa.concat_tables(out)


def _relations_of(table: pa.Table, budget: int | None, names: list[str]) -> pa.Table:
    g = _gathered(table)
    total, held = _met(g)
    out = [_over(g, total, budget, names)]
    relation, named = _codes(g.edges["relation"])
    of = g.keys // len(g.ids)
    form = (relation * len(g.kinds) + of[g.ends[0]]) * len(g.kinds) + of[g.ends[1]]
    forms, form = np.unique(form, return_inverse=True)
    every, source = np.divmod(np.unique((form * len(g.keys) + g.ends[0]) * len(g.keys) + g.ends[1]) // len(g.keys), len(g.keys))  # an edge counts once
    n, roots = np.zeros(len(forms), np.int64), np.zeros(len(forms), np.int64)
    for i in range(len(forms)):
        sources = source[every == i]
        n[i] = held[sources].sum()
        any_of = np.bitwise_or.reduce(g.masks[sources], axis=0)
        roots[i] = np.unpackbits(any_of.view(np.uint8)).sum()
    rest, last = np.divmod(forms, len(g.kinds))
    rel, first = np.divmod(rest, len(g.kinds))
    text = lambda values, at: values.take(pa.array(at)).cast(pa.string())
    rows = {"relation": text(named, rel), "kind": text(g.kinds, first), "next_kind": text(g.kinds, last), "n": pa.array(n), "n_roots": pa.array(roots), "root_kind": pa.nulls(len(n), pa.string()), "root": pa.nulls(len(n), pa.string()), "over": pa.nulls(len(n), pa.int64())}
    return pa.concat_tables([*out, pa.table(rows).select(names)])


def _faults_of(table: pa.Table, budget: int | None, names: list[str]) -> pa.Table:
    g = _gathered(table)
    out = [_over(g, _met(g)[0], budget, names)]
    fault = g.marks["next_id"].combine_chunks() if g.marks.num_rows else pa.array([], pa.string())
    nodes = np.arange(len(g.marked))
    step = max(1, UNPACKED // (64 * g.masks.shape[1]))
    for i in range(0, len(nodes), step):
        some = nodes[i : i + step]
        for _, bits in g.bits(g.marked[some]):
            at, root = np.nonzero(bits)
            node, root = g.marked[some][at], g.roots[root]
            out.append(pa.table({"root_kind": g.kind(root), "root": g.id(root), "kind": g.kind(node), "id": g.id(node), "fault": fault.take(pa.array(some[at])), "over": pa.nulls(len(at), pa.int64())}).select(names))
    return pa.concat_tables(out)


# ---------------------------------------------------------------- what is asked


def _answers(walk: _Walk, of: Callable, names: list[str], staging: Staging, budget: int | None, marks: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The rows that `of` makes of every group, staged; the roots (kind, id) of groups that no task could hold, if there are any."""
    none = F.lit(None).cast("string")
    rows = walk.edges.select(_ROWS).unionByName(walk.members.select("group", none.alias("relation"), *_NODE, none.alias("next_kind"), none.alias("next_id")))
    if marks is not None:
        rows = rows.unionByName(marks)
    heavy = staging.table(rows.groupBy("group").count().where(F.col("count") > HEAVY).select("group"), "heavy")
    alone = None if heavy.isEmpty() else walk.members.join(heavy, "group", "left_semi").select(_NODE)
    if alone is not None:
        rows = rows.join(heavy, "group", "left_anti")
    kinds = {pa.string(): "string", pa.int64(): "long"}

    def one(table):
        return of(table, budget, names)

    out = staging.table(spread(rows, "group").groupBy("group").applyInArrow(one, ", ".join(f"{n} {kinds[_ARROW[n]]}" for n in names)), "answers")
    if budget is not None:
        over = out.where("over is not null").orderBy(F.desc("over"), "root_kind", "root").first()
        if over:
            raise ValueError(f"{over.root_kind} {over.root} rests on more than {budget} nodes")
    return out.where("over is null").drop("over"), alone


def counts(seeds: DataFrame, relations: list[Relation], staging: Staging, budget: int | None = None) -> DataFrame:
    """(root_kind, root, kind, n, first_id): how many nodes of each kind every seed (kind, id) reaches, itself included, and the least id.

    With a budget, a seed that reaches more nodes is an error that names it: nothing is cut.
    """
    out, alone = _answers(_walk(seeds, relations, staging), _counts_of, ["root_kind", "root", "kind", "n", "first_id", "over"], staging, budget)
    if alone is not None:
        pairs = provenance.trace(alone, provenance.edges(relations), staging, budget)
        out = out.unionByName(pairs.groupBy("root_kind", "root", "kind").agg(F.count("*").alias("n"), F.min("id").alias("first_id")))
    return out


def by_relation(seeds: DataFrame, relations: list[Relation], staging: Staging, budget: int | None = None) -> DataFrame:
    """(relation, kind, next_kind, n, n_roots, n_edges): pairs of a seed and an edge below it, seeds that have such edges, edges that some seed has."""
    walk = _walk(seeds, relations, staging)
    form = ["relation", "kind", "next_kind"]
    out, alone = _answers(walk, _relations_of, ["root_kind", "root", *form, "n", "n_roots", "over"], staging, budget)
    out = out.select(*form, "n", "n_roots")
    if alone is not None:
        graph = staging.table(provenance.edges(relations), "graph")
        below = provenance.traced_edges(provenance.trace(alone, graph, staging, budget), graph)
        out = out.unionByName(below.groupBy(form).agg(F.count("*").alias("n"), F.countDistinct("root_kind", "root").alias("n_roots")))
    edges = walk.edges.select(*form, "id", "next_id").distinct().groupBy(form).agg(F.count("*").alias("n_edges"))
    return out.groupBy(form).agg(F.sum("n").alias("n"), F.sum("n_roots").alias("n_roots")).join(edges, form)


def faults(seeds: DataFrame, relations: list[Relation], rules: dict[str, DataFrame], staging: Staging, budget: int | None = None) -> DataFrame:
    """(root_kind, root, kind, id, fault) of what seeds reach. rules: by kind, (id, fault) of that kind's rows that break a rule."""
    walk = _walk(seeds, relations, staging)
    found = staging.table(provenance.broken(rules), "broken")
    nodes = walk.members.where(~F.col("kind").isin([k for kinds, _ in walk.nodes for k in kinds]))
    for kinds, reached in walk.nodes:
        if kinds & set(rules):
            nodes = nodes.unionByName(reached)
    marks = nodes.join(found, _BY).select("group", F.lit(None).cast("string").alias("relation"), *_NODE, F.lit("fault").alias("next_kind"), F.col("fault").alias("next_id"))
    marks = staging.table(marks.distinct(), "marks")
    out, alone = _answers(walk, _faults_of, ["root_kind", "root", *_NODE, "fault", "over"], staging, budget, marks)
    if alone is not None:
        out = out.unionByName(provenance.faults(provenance.trace(alone, provenance.edges(relations), staging, budget), rules))
    return out
