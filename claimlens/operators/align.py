"""Alignment of two versions of a page's assertions: kept, changed, moved, added, removed or ambiguous.

Keys that stand once on either side anchor the page: of them a longest sequence in the order of both sides is kept in
place, and those outside of it have moved. Between two anchors the keys that repeat are aligned by a longest common
subsequence of their own; what is left of a key that stands on both sides there is ambiguous.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALIGNED = "page long, key string, status string, before_at int, after_at int, before string, after string"


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest chain of (a, b) pairs that rises on both sides; of several the one that patience finds first."""
    ends: list[int] = []
    last: list[int] = []
    came: list[int | None] = []
    for n, (_, b) in enumerate(pairs := sorted(pairs, key=lambda p: (p[0], -p[1]))):
        at = bisect_left(ends, b)
        came.append(last[at - 1] if at else None)
        ends[at : at + 1], last[at : at + 1] = [b], [n]
    out, n = [], last[-1] if last else None
    while n is not None:
        out.append(pairs[n])
        n = came[n]
    return out[::-1]


def paired(before: list[str], after: list[str]) -> list[tuple[str, int | None, int | None]]:
    """(status, place before, place after) of every key: in_order, moved, ambiguous, removed or added."""
    left, right = Counter(before), Counter(after)
    single = {k for k in left if left[k] == right[k] == 1}
    where = {k: j for j, k in enumerate(after) if k in single}
    every = [(i, where[k]) for i, k in enumerate(before) if k in single]
    chain = rising(every)
    out = [("in_order", *p) for p in chain] + [("moved", *p) for p in set(every) - set(chain)]
    for (a, b), (c, d) in zip([(-1, -1), *chain], [*chain, (len(before), len(after))], strict=True):
        some = [i for i in range(a + 1, c) if before[i] not in single]
        others = [j for j in range(b + 1, d) if after[j] not in single]
        places: dict[str, list[int]] = {}
        for j in others:
            places.setdefault(after[j], []).append(j)
        met = rising([(i, j) for i in some for j in places.get(before[i], ())])
        out += [("in_order", *p) for p in met]
        lone, more = [i for i in some if i not in dict(met)], [j for j in others if j not in {j for _, j in met}]
        both = {before[i] for i in lone} & {after[j] for j in more}
        out += [("ambiguous" if before[i] in both else "removed", i, None) for i in lone]
        out += [("ambiguous" if after[j] in both else "added", None, j) for j in more]
    return out


def align(before: DataFrame, after: DataFrame) -> DataFrame:
    """ALIGNED rows of two sides (page, at, key, literal): at orders a page's assertions, key names what one speaks of.

    In order with an equal literal is kept, with another one changed. A task holds one page at a time, in sorted partitions.
    """
    side = lambda df, second: df.select("page", F.lit(second).alias("second"), "at", "key", "literal")
    rows = side(before, False).unionByName(side(after, True)).repartition("page").sortWithinPartitions("page", "second", "at", "key", "literal")
    names = [c.split()[0] for c in ALIGNED.split(", ")]

    def told(page: int, sides: tuple[list, list]) -> list[tuple]:
        out = []
        for status, i, j in paired([k for _, k, _ in sides[0]], [k for _, k, _ in sides[1]]):
            a, b = (None, None, None) if i is None else sides[0][i], (None, None, None) if j is None else sides[1][j]
            status = status if status != "in_order" else "kept" if a[2] == b[2] else "changed"
            out.append((page, a[1] if b[1] is None else b[1], status, a[0], b[0], a[2], b[2]))
        return out

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({"before_at": "Int32", "after_at": "Int32"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        page, sides = None, ([], [])
        for batch in batches:
            out = []
            for p, second, at, key, literal in batch.itertuples(index=False):
                if p != page:
                    out += told(page, sides)
                    page, sides = p, ([], [])
                sides[bool(second)].append((at, key, literal))
            yield frame(out)
        yield frame(told(page, sides))

    return rows.mapInPandas(run, ALIGNED)
