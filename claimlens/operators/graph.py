"""Graph operators over edge tables: components, reachability, cycles and the all-parents fixpoint.

Every loop writes its frontier to the shared folder, so a round's plan never contains the rounds before it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.plans.staging import Staging

#: Edges that a task holds at once, 8 MB: the bound of a batch that is replaced by stars, and of a graph that one task settles.
HELD = 500_000


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the edges of each bounded batch by a spanning star per local component."""

    def flush(frames: list[pd.DataFrame]) -> pd.DataFrame:
        edges = pd.concat(frames, ignore_index=True)
        nodes, flat = np.unique(edges[["u", "v"]].to_numpy(), return_inverse=True)
        a, b = flat.reshape(-1, 2).T
        label = np.arange(len(nodes))
        while True:  # min-label hooking with pointer jumping
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            while not np.array_equal(jump := new[new], new):
                new = jump
            if np.array_equal(new, label):
                break
            label = new
        keep = label != np.arange(len(nodes))
        return pd.DataFrame({"u": nodes[keep], "v": nodes[label[keep]]})

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= HELD:
            yield flush(held)
            held, rows = [], 0
    if rows:
        yield flush(held)


def connected_components(edges: DataFrame, staging: Staging, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Return (node, component) for every node of an undirected edge table of longs; component is the smallest node.

    Every task first replaces its edges by stars. Where HELD edges at most are left, a bound that does not grow with the
    input, one more task replaces these: their stars are the components, and no round with its shuffles over all
    partitions is run for a few rows. More edges go by alternating star contraction: each round hangs larger neighbours,
    then smaller ones, on the smallest node seen. Minima combine before the shuffle and the joins split, so one node with
    very many edges stays spread. Null ends and loops are ignored; an empty edge table gives an empty result.
    """
    pairs = edges.select(F.greatest(src, dst).cast("long").alias("u"), F.least(src, dst).cast("long").alias("v")).where("u <> v")
    now = staging.table(pairs.mapInPandas(_forest, "u long, v long"), "edges")
    if now.count() <= HELD:
        whole = staging.table(now.coalesce(1).mapInPandas(_forest, "u long, v long"), "edges")
        staging.drop(now)
        return _membership(whole)
    print_of = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        nxt = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        nxt = staging.table(nxt, "edges")
        seen = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        staging.drop(now)
        now = nxt
        if print_of == (seen.n, seen.h):
            break
        print_of = (seen.n, seen.h)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return _membership(now)


def _membership(stars: DataFrame) -> DataFrame:
    """(node, component) of stars (u, v): their leaves, and each centre once."""
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _led_to(graph: DataFrame, node: str | list[str], to: str | list[str], staging: Staging) -> DataFrame:
    """The rows of a graph that leave a node to which another row of it leads: what a walk can take one step later."""
    node, to = ([x] if isinstance(x, str) else x for x in (node, to))
    ends = graph.select(*[F.col(t).alias(n) for n, t in zip(node, to, strict=True)]).distinct()
    return staging.table(graph.join(ends, node, "left_semi").select(graph.columns), "graph")


def expand(begin: DataFrame, graph: DataFrame, ahead: Callable[[DataFrame, DataFrame], DataFrame], staging: Staging, node: str | list[str] = "node", to: str | list[str] = "next", rounds: int | None = None, check: Callable[[DataFrame], None] | None = None, small: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows reached from `begin`, with repeats; the rows of the last round, empty unless `rounds` or `small` ended it; the graph left then.

    ahead(rows, graph) gives the rows one step on; begin and graph are staged. Rows of a round are distinct, but only after
    1, 2, 4, 8... rounds are those known before taken out, so all that is held is read a few times and not once a round;
    circles end within twice their rounds. `check` sees what is held at the same times and at the end. The graph is cut
    each round to what a walk of that length can still take, as long as that takes a fifth of it away. Rounds end where
    `small` rows of it are left at most: the rows of the last round have not walked these.
    """
    held, fresh, n, size = begin, begin, 0, None
    if small is not None:
        size = graph.count()
        if size <= small:
            return held, fresh, graph
    while rounds is None or n < rounds:
        n += 1
        told = n & (n - 1) == 0
        new = ahead(fresh, graph).distinct()
        fresh = staging.table(new.join(held, begin.columns, "left_anti").select(begin.columns) if told else new, "frontier")
        last = fresh.isEmpty()
        held = held if last else held.unionByName(fresh)
        if check and (told or last):
            check(held)
        if last:
            break
        if size != 0:
            before = graph.count() if size is None else size
            old, graph = graph, _led_to(graph, node, to, staging)
            now = graph.count()
            staging.drop(old)
            if small is not None and now <= small:
                break
            size = now if now * 5 <= before * 4 else 0  # 0: it shrinks no more
    return held, fresh, graph


def closure(seeds: DataFrame, edges: DataFrame, staging: Staging, rounds: int = 32) -> DataFrame:
    """(root, node): everything reachable from each seed (one column `root`) over (child, parent) edges, itself included.

    After some rounds of single steps, which list each pair about once an edge, long chains go on by path doubling: round
    i knows all paths shorter than 2^i and adds those that go on by exactly 2^i steps, so a chain of n links takes log n
    rounds. Works on graphs with diamonds and with circles: what adds nothing in a round adds nothing later.
    """
    leap = staging.table(edges.select(F.col("child").alias("node"), F.col("parent").alias("next")).where("node is not null and next is not null").distinct(), "leap")
    begin = staging.table(seeds.select("root", F.col("root").alias("node")).distinct(), "reach")
    one = lambda rows, graph: rows.join(graph, "node").select("root", F.col("next").alias("node"))
    held, fresh, leap = expand(begin, leap, one, staging, rounds=rounds)
    if fresh.isEmpty():
        return held.distinct()
    seen, size = fresh, fresh.count()
    while True:
        now = staging.table(seen.unionByName(one(seen, leap)).distinct(), "reach")
        grown = now.count()
        if grown == size:
            return held.unionByName(now).distinct()
        far = staging.table(leap.join(leap.select(F.col("node").alias("next"), F.col("next").alias("end")), "next").select("node", F.col("end").alias("next")).distinct(), "leap")
        seen, size, leap = now, grown, far


def gathered(nodes: DataFrame, values: DataFrame, edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, held): for each node the sorted distinct values of all that it reaches over (child, parent) edges, itself included.

    nodes: node; values: node, value. Sets rise through the graph, each built once from those of a node's parents, and no
    pair of nodes is listed: layers are taken off from above (edges of children that nobody rests on), then filled from
    below. What lies on circles or below them goes by its closure.
    """
    own = staging.table(values.where("value is not null").groupBy("node").agg(F.collect_set("value").alias("held")), "own")
    left = staging.table(edges.where("child <> parent").select("child", "parent").distinct(), "edges")
    none = F.array().cast(own.schema["held"].dataType)
    inner = left.select(F.col("child").alias("node")).distinct()
    every = nodes.select("node").unionByName(left.select(F.col("parent").alias("node"))).distinct()
    ends = every.join(inner, "node", "left_anti").join(own, "node", "left").select("node", F.coalesce("held", none).alias("held"))
    filled = staging.table(ends, "sets")
    layers, size = [], left.count()
    while size:
        rest = _led_to(left, "child", "parent", staging)
        now = rest.count()
        if now == size:
            break
        layers.append(left.join(left.select(F.col("parent").alias("child")).distinct(), "child", "left_anti").select("child", "parent"))
        left, size = rest, now
    if size:  # circles
        reach = closure(left.select(F.col("child").alias("root")).distinct(), left, staging)
        sets = reach.join(own.withColumn("value", F.explode("held")).select("node", "value"), "node", "left").groupBy(F.col("root").alias("node")).agg(F.collect_set("value").alias("held"))
        filled = filled.unionByName(staging.table(sets, "sets"))
    for i, layer in enumerate(reversed(layers)):
        below = layer.join(filled.select(F.col("node").alias("parent"), "held"), "parent").select(F.col("child").alias("node"), "held")
        mine = layer.select(F.col("child").alias("node")).distinct().join(own, "node").select("node", "held")
        sets = below.unionByName(mine).groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("held"))).alias("held"))
        filled = filled.unionByName(sets if i + 1 == len(layers) else staging.table(sets, "sets"))  # nobody rests on the last
    return filled.join(nodes.select("node").distinct(), "node", "left_semi").select("node", F.array_sort("held").alias("held"))


def cyclic_nodes(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node): nodes on a circle or above one, by peeling edges whose parent is a leaf; empty for a DAG.

    One round a level; every round but the last takes edges away, so it ends on any graph.
    """
    left = staging.table(edges.select("child", "parent").distinct(), "edges")
    size = left.count()
    while True:
        inner = left.select(F.col("child").alias("parent")).distinct()
        left = staging.table(left.join(inner, "parent", "left_semi").select("child", "parent"), "edges")
        now = left.count()
        if now == size or not now:
            return left.select(F.col("child").alias("node")).distinct()
        size = now


def supported(nodes: DataFrame, direct: DataFrame, edges: DataFrame, staging: Staging) -> DataFrame:
    """(node): supported directly, or with parents all of whom are supported; the least fixpoint.

    nodes and direct have one column `node`; edges are (child, parent). A parent outside nodes supports nothing.
    """
    nodes = nodes.select("node").distinct()
    fresh = staging.table(direct.select("node").distinct().join(nodes, "node", "left_semi"), "good")
    children = nodes.join(fresh, "node", "left_anti").select(F.col("node").alias("child"))
    left = staging.table(edges.select("child", "parent").distinct().join(children, "child", "left_semi"), "edges")
    good = fresh
    while not fresh.isEmpty():  # edges go as their parents prove supported, and nodes without any left are supported
        rest = staging.table(left.join(fresh.select(F.col("node").alias("parent")), "parent", "left_anti").select("child", "parent"), "edges")
        more = left.select("child").distinct().join(rest.select("child").distinct(), "child", "left_anti")
        fresh = staging.table(more.select(F.col("child").alias("node")), "good")
        left, good = rest, good.unionByName(fresh)
    return good


def carry_identity(components: DataFrame, prior: DataFrame) -> DataFrame:
    """(component, identity, problem): a component keeps the identity that its nodes had; new ones take their own name.

    components: node, component; prior: node, identity. Nodes of several identities merge, and an identity over several
    components splits: both are problems, and no identity is chosen.
    """
    met = components.join(prior, "node", "left").groupBy("component").agg(F.countDistinct("identity").alias("n"), F.min("identity").alias("identity"))
    spread = components.join(prior, "node").groupBy("identity").agg(F.countDistinct("component").alias("parts"))
    both = met.join(spread, "identity", "left")
    problem = F.when(F.col("n") > 1, "merged").when(F.col("parts") > 1, "split")
    return both.select("component", F.when(problem.isNull(), F.coalesce("identity", "component")).alias("identity"), problem.alias("problem"))
