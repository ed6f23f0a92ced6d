"""Exact top-k inner products by no-random-access aggregation.

Candidates lie in blocks, ordered by falling length of their vectors; a block holds one sorted list per dimension,
written once, and nothing else: vectors are not stored beside them. Lists are read in order from both ends, to one
depth. A value that has turned up is known; one that has not lies between the frontiers of its list. So a query's score
with a candidate is at most the sum of its products with the known values and with the frontier that suits it, and at
least the same with the other frontier. Depths double until, for every query, those candidates whose upper bound
reaches the k-th best lower bound are few, at most FEW times k. Nobody else can qualify then, and these few alone are
looked up in the lists for their final scores.

Queries travel as packs of PACK rows at most, as do the lists. Every pack first meets the block of the longest vectors,
whose k-th best score is a floor that goes with the query into every other block: there a query stops as soon as no
candidate's upper bound reaches the floor, at the first entries of the lists if need be. Nothing is held by the driver.
Where vectors have no structure, frontiers stay apart and lists are read to their ends; the result is exact either way.

Defined results: rows without vec_id and vectors that are null or hold null or non-finite components take no part,
neither as query nor as candidate; scores are exact integers (an inner product beyond 64 bits is an error); ties go to
the smaller vec_id; fewer than k candidates give all of them; vectors of different lengths are never compared (a query
meets those of its own length); rows that repeat a vec_id are one candidate each, and every query row's own vec_id is
left out; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.plans.session import small_batches
from claimlens.plans.staging import Staging

SCALE, K = 256, 5
#: Rows of a pack of queries and of a block of candidates, and the components that either holds at most.
PACK, BLOCK, CELLS = 1024, 8192, 1 << 19
#: Queries bounded together; queries whose bounds are formed first, to see whether a depth can close anything.
STEP, PROBE = 256, 8
#: Candidates a query may leave open when reading stops, times k.
FEW = 4
#: Bytes of stored vectors that one task puts into lists.
TASK_BYTES = 8 << 20


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, q): vectors that take part, each component x as floor(256 x), kept as doubles."""
    e = F.col("embedding").cast("array<double>")
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(sound).select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), F.transform(e, lambda x: F.floor(x * SCALE).cast("double")).alias("q"))


# ---------------------------------------------------------------- lists and bounds


class Lists:
    """The sorted lists of one block, read from both ends to a common depth."""

    def __init__(self, values: np.ndarray, order: np.ndarray):
        self.n, self.dim = values.shape
        self.values, self.order = values, order
        self.known, self.depth = np.full(values.shape, np.nan, values.dtype), 0
        self._cols, self._rank, self.resolved = np.arange(self.dim), None, 0

    @staticmethod
    def of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each dimension's values in rising order, and whose they are."""
        order = np.argsort(rows, axis=0, kind="stable")
        return np.take_along_axis(rows, order, axis=0), order.astype(np.int32)

    @property
    def ends(self) -> int:
        """The depth at which the two ends have met."""
        return -(-self.n // 2)

    def read_to(self, depth: int) -> None:
        """Go on to `depth` from both ends of every list."""
        for part in (slice(self.depth, depth), slice(max(depth, self.n - depth), self.n - self.depth)):
            self.known[self.order[part], self._cols] = self.values[part]
        self.depth = depth

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """What each value is at least and at most: itself where known, else the frontiers."""
        blank = np.isnan(self.known)
        return np.where(blank, self.values[self.depth - 1], self.known), np.where(blank, self.values[self.n - self.depth], self.known)

    def resolve(self, at: np.ndarray) -> np.ndarray:
        """All values of a few candidates, by their places in the lists."""
        if self._rank is None:
            self._rank = np.empty_like(self.order)
            self._rank[self.order, self._cols] = np.arange(self.n, dtype=np.int32)[:, None]
        self.resolved += len(at)
        return self.values[self._rank[at], self._cols]


def _exact_type(queries: np.ndarray, values: np.ndarray) -> type:
    """The narrowest float in which every partial sum is an exact integer; object where none is."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(values).max(initial=0)) * max(1, values.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (score, vec_id), ties to the smaller id; ties of any number are parted, never sorted whole."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, level = np.nonzero(scores > bar)[0], np.nonzero(scores == bar)[0]
        need = k - len(above)
        if len(level) > need:
            level = level[np.argpartition(ids[level], need - 1)[:need]]
        at = np.concatenate((above, level))
        scores, ids = scores[at], ids[at]
    return sorted(((int(s), int(i)) for s, i in zip(scores, ids, strict=True)), key=lambda x: (-x[0], x[1]))


def scan(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, lists: Lists, ids: np.ndarray, k: int) -> tuple[list[list[tuple[int, int]]], int]:
    """Each query's best k candidates of one block that reach its floor, and the depth to which its lists were read."""
    n, found = lists.n, [[] for _ in range(len(q))]
    kind = _exact_type(q, lists.values)
    if kind is object or not lists.dim:
        lists.read_to(lists.ends)
        rows = [[int(x) for x in row] for row in lists.known]
        for j in range(len(q)):
            own = [int(x) for x in q[j]]
            mine = [(sum(a * b for a, b in zip(own, row, strict=True)), int(i)) for row, i in zip(rows, ids, strict=True) if i != q_ids[j]]
            if any(not -(2**63) <= s < 2**63 for s, _ in mine):
                raise OverflowError("an inner product exceeds 64 bits")
            found[j] = sorted((x for x in mine if x[0] >= floor[j]), key=lambda x: (-x[0], x[1]))[:k]
        return found, lists.depth
    lists.values, lists.known, q = lists.values.astype(kind), lists.known.astype(kind), q.astype(kind)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    alive, depth = np.arange(len(q)), 1

    def upper_of(now, low, high):
        return plus[now] @ high.T + minus[now] @ low.T

    def bar_of(now, lower):
        return np.maximum(floor[now], np.partition(lower, n - k, axis=1)[:, n - k]) if n > k else floor[now]

    while True:
        lists.read_to(depth)
        ends = depth == lists.ends
        low, high = (lists.known, lists.known) if ends else lists.bounds()
        deeper = min(lists.ends, max(64, depth * 2))
        if not ends and len(alive) > 2 * PROBE:
            # where a few of the queries stay open, reading on is cheaper than bounding all of them
            few = alive[:: len(alive) // PROBE]
            lower = plus[few] @ low.T + minus[few] @ high.T
            lower[ids[None, :] == q_ids[few][:, None]] = -np.inf
            if (upper_of(few, low, high) >= bar_of(few, lower)[:, None]).mean() > 1 / 16:
                depth = deeper
                continue
        left = []
        for lo in range(0, len(alive), STEP):
            now = alive[lo : lo + STEP]
            own = ids[None, :] == q_ids[now][:, None]
            upper = q[now] @ high.T if ends else upper_of(now, low, high)
            upper[own] = -np.inf
            lower = upper
            if not ends:
                lower = plus[now] @ low.T + minus[now] @ high.T
                lower[own] = -np.inf
            open_ = (upper >= bar_of(now, lower)[:, None]) & np.isfinite(upper)
            done = ends | (open_.sum(axis=1) <= FEW * k)
            for j in np.nonzero(done)[0]:
                at = np.nonzero(open_[j])[0]
                score = upper[j, at] if ends else lists.resolve(at) @ q[now[j]]
                fits = score >= floor[now[j]]
                found[now[j]] = best_of(score[fits], ids[at][fits], k)
            left.append(now[~done])
        alive = np.concatenate(left)
        if not len(alive):
            return found, lists.depth
        depth = deeper


# ---------------------------------------------------------------- packs and blocks


def _capacity(dim: int, rows: int) -> int:
    return max(1, min(rows, CELLS // max(1, dim)))


def _runs(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, ids, rows) of successive vectors of one length, _capacity at most."""
    held, dim = [], None
    for batch in batches:
        for i, d, x in zip(batch.vec_id.tolist(), batch.dim.tolist(), batch.q, strict=True):
            if held and (d != dim or len(held) >= _capacity(dim, rows)):
                yield dim, np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.float64).reshape(len(held), dim)
                held = []
            dim = d
            held.append((i, x))
    if held:
        yield dim, np.array([h[0] for h in held], np.int64), np.array([h[1] for h in held], np.float64).reshape(len(held), dim)


_LISTS = "dim int, block long, n int, ids binary, list_values binary, list_order binary"


def list_blocks(rows: DataFrame) -> DataFrame:
    """One row a block: its candidates' ids and, per dimension, the sorted list; block 0 of a dim has the longest vectors."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, ids, x in _runs(batches, BLOCK):
            values, order = Lists.of(x)
            yield pd.DataFrame({"dim": [dim], "block": [0], "n": [len(ids)], "ids": [ids.tobytes()], "list_values": [values.tobytes()], "list_order": [order.tobytes()]})

    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    length = F.aggregate("q", F.lit(0.0), lambda a, x: a + x * x)
    dealt = rows.withColumn("length", -length).repartitionByRange(max(1, min(200_000, size // TASK_BYTES + 1)), "dim", "length", "vec_id")
    blocks = dealt.sortWithinPartitions("dim", "length", "vec_id").select("vec_id", "dim", "q").mapInPandas(put, _LISTS)
    return blocks.withColumn("block", F.monotonically_increasing_id())


_PACK = "dim int, pack long, ids binary, q binary, floor binary"


def query_packs(rows: DataFrame) -> DataFrame:
    """One row a pack of queries, without a floor yet."""

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for dim, ids, x in _runs(batches, PACK):
            yield pd.DataFrame({"dim": [dim], "pack": [0], "ids": [ids.tobytes()], "q": [x.tobytes()], "floor": [np.full(len(ids), -np.inf).tobytes()]})

    packs = rows.repartitionByRange("dim", "vec_id").sortWithinPartitions("dim", "vec_id").select("vec_id", "dim", "q").mapInPandas(put, _PACK)
    return packs.withColumn("pack", F.monotonically_increasing_id())


def _meet(pairs: DataFrame, k: int, reads=None) -> DataFrame:
    """Each (pack, block) pair's results as columns of arrays, and the floors that follow from them.

    reads: an accumulator pair that is told the list entries read and those there are.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids, q_ids = np.frombuffer(r.ids, np.int64), np.frombuffer(r.q_ids, np.int64)
                lists = Lists(np.frombuffer(r.list_values).reshape(r.n, r.dim), np.frombuffer(r.list_order, np.int32).reshape(r.n, r.dim))
                floor = np.frombuffer(r.floor).copy()
                found, depth = scan(np.frombuffer(r.q).reshape(len(q_ids), r.dim), q_ids, floor, lists, ids, k)
                if reads:
                    reads[0].add((min(r.n, 2 * depth) + lists.resolved) * r.dim)
                    reads[1].add(r.n * r.dim)
                for j, own in enumerate(found):
                    if len(own) == k:
                        floor[j] = max(floor[j], float(own[-1][0]) if abs(own[-1][0]) <= 2**53 else -np.inf)
                out = [(j, i, s) for j, own in enumerate(found) for s, i in own]
                at, vec, score = (np.array([x[c] for x in out], np.int64) for c in range(3))
                yield pd.DataFrame({"pack": [r.pack], "floor": [floor.tobytes()], "at": [at], "query_id": [q_ids[at]], "vec_id": [vec], "score": [score]})

    return pairs.mapInPandas(run, "pack long, floor binary, at array<long>, query_id array<long>, vec_id array<long>, score array<long>")


def search(vectors: DataFrame, queries: DataFrame, k: int = K, staging: Staging | None = None, reads=None) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows of `vectors` for each row of `queries`.

    A pack of queries meets every block of its dim; a meeting returns k rows a query at most, and these are ranked.
    """
    spark = small_batches(vectors.sparkSession)
    staging = staging or Staging(spark, "topk")
    blocks = staging.table(list_blocks(staging.table(quantised(vectors), "rows")), "lists")
    packs = staging.table(query_packs(staging.table(quantised(queries), "asked")), "packs")
    own = blocks.withColumnsRenamed({"dim": "block_dim"})
    ids = packs.withColumnsRenamed({"ids": "q_ids"})
    firsts = blocks.groupBy("dim").agg(F.min("block").alias("first"))

    def meet(keyed: DataFrame) -> DataFrame:
        # merged by block, never broadcast: pairs are what there is to share out
        return _meet(keyed.join(own.hint("merge"), (F.col("at_block") == F.col("block")) & (F.col("dim") == F.col("block_dim"))).drop("block_dim", "at_block"), k, reads)

    opened = staging.table(meet(ids.join(firsts, "dim").withColumnRenamed("first", "at_block")), "opened")
    others = blocks.select("dim", F.col("block").alias("at_block")).join(firsts, "dim").where("at_block <> first").select("dim", "at_block")
    floors = ids.drop("floor").join(opened.select("pack", "floor"), "pack")
    rest = staging.table(meet(floors.join(others, "dim")), "rest")
    found = opened.drop("floor").unionByName(rest.drop("floor"))
    flat = found.select("pack", F.inline(F.arrays_zip("at", "query_id", "vec_id", "score")))
    best = Window.partitionBy("pack", "at", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return flat.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """The 5 best other rows of every row whose vec_id is divisible by 50."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return search(vectors, vectors.where("vec_id % 50 = 0"))


OP8_SQL = """
WITH q AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""
