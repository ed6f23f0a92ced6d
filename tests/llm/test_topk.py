import numpy as np
import pytest
from claimlens.llm import topk


def brute(rows, queries, k=5):
    out = []
    for qi, q in queries:
        own = sorted(((-int(np.dot(q.astype(object), x.astype(object))), i) for i, x in rows if i != qi and len(x) == len(q)))[:k]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(own)]
    return sorted(out)


def as_rows(v):
    return [(int(i), np.floor(np.array(x, float) * 256).astype(np.int64)) for i, x in v]


def test_search_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    v = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 8]) for i in range(400)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.search(df, df.where("vec_id % 50 = 0")).collect())
    rows = as_rows(v)
    assert got == brute(rows, [r for r in rows if r[0] % 50 == 0])


def scan(q, q_ids, rows, ids, k=5, floor=None):
    floor = np.full(len(q), -np.inf) if floor is None else floor
    return topk.scan(q, np.array(q_ids), floor, topk.Lists(*topk.Lists.of(rows)), np.array(ids), k)


def test_reading_stops_early_where_lists_are_skewed():
    rng = np.random.default_rng(0)
    rows = np.zeros((4000, 4))
    rows[:, 0] = np.floor(rng.pareto(1.0, 4000) * 50)
    rows[:, 1:] = rng.integers(0, 3, (4000, 3))
    q, ids = np.array([[9.0, 1, 1, 0]]), np.arange(4000)
    found, depth = scan(q, [-1], rows, ids)
    score = rows @ q[0]
    assert depth < 2000 and found[0] == [(int(score[i]), int(i)) for i in np.lexsort((ids, -score))[:5]]
    found, depth = scan(q, [-1], rows, ids, floor=np.array([score.max() + 1e9]))
    assert depth == 1 and found == [[]]  # the first entries of the lists rule all candidates out


def test_search_leaves_lists_unread(spark):
    """Vectors whose lengths fall off: later blocks stop at the floor that the first one sets."""
    rng = np.random.default_rng(3)
    length = 4000.0 / (1 + np.arange(20_000))
    rows = rng.normal(size=(20_000, 8)) * length[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>").repartition(4)
    reads = [spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)]
    got = sorted(tuple(r) for r in topk.search(df, df.where("vec_id % 1000 = 999"), reads=reads).collect())
    whole = as_rows(enumerate(rows))
    assert got == brute(whole, [r for r in whole if r[0] % 1000 == 999])
    assert 0 < reads[0].value < reads[1].value / 3


@pytest.mark.parametrize("seed", range(12))
def test_scan_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    n, dim, k = int(rng.integers(1, 400)), int(rng.integers(1, 9)), int(rng.integers(1, 9))
    rows = np.floor(rng.standard_cauchy((n, dim)) * 5) if seed % 2 else rng.integers(-2, 3, (n, dim)).astype(float)
    ids, q = rng.permutation(n), rng.integers(-4, 5, (40, dim)).astype(float)
    q_ids = rng.integers(0, n, 40)
    found, _ = scan(q, q_ids, rows, ids, k)
    for j in range(40):
        score = [(-int(rows[i] @ q[j]), int(ids[i])) for i in range(n) if ids[i] != q_ids[j]]
        assert found[j] == [(-s, i) for s, i in sorted(score)[:k]]


def test_odd_vectors(spark):
    nan = float("nan")
    v = [(0, [0.5, 0.25]), (50, [0.5, 0.25]), (50, [0.5, 0.25]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [float("inf"), 0.0]), (100, [1.0]), (5, [0.1, 0.1]), (None, [3e6, 3e6]), (150, [1e6, 1e6]), (2**53 + 1, [2e6, 2e6]), (200, []), (7, [])]
    df = spark.createDataFrame([(*r, 7) for r in v], "vec_id long, embedding array<float>, score int")
    got = sorted((r.query_id, r.rank, r.vec_id if r.vec_id is not None else -1, r.score) for r in topk.search(df, df.where("vec_id % 50 = 0")).collect())
    assert {g[0] for g in got} == {0, 50, 150, 200} and (200, 1, 7, 0) in got and all(g[2] not in (-1, 1, 2, 3, 4, 100) for g in got)
    assert (0, 1, 2**53 + 1, 192 * 512_000_000) in got and (0, 2, 150, 192 * 256_000_000) in got
    empty = df.where("vec_id = 999")
    assert topk.search(empty, empty).count() == 0
    with pytest.raises(OverflowError):
        scan(np.full((1, 2), 2.0**40), [1], np.full((1, 2), 2.0**40), [2])


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = as_rows([(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()])
    assert sorted(tuple(r) for r in topk.op8_exact_top_k(spark, sf).collect()) == brute(rows, [r for r in rows if r[0] % 50 == 0])
