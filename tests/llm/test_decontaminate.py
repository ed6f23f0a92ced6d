import random
import time

from claimlens.llm import decontaminate as d

WORDS = [f"w{i}" for i in range(40)]


def slow_cover(item, doc, seed):
    """Greedy string tiling by full comparison."""
    used_i, used_d, total = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in used_i and j + n not in used_d:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < seed:
            return total
        used_i |= set(range(i, i + n))
        used_d |= set(range(j, j + n))
        total += n


def test_tiling_equals_full_comparison():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.choice(WORDS[:6]) for _ in range(rng.randrange(1, 25))]
        doc = [rng.choice(WORDS[:8]) for _ in range(30)] + item[len(item) // 2 :] + [rng.choice(WORDS) for _ in range(3)] + item[: len(item) // 2]
        width = min(3, len(item))
        got = {x[0]: x[2] for x in d.Index([(7, " ".join(item))], 3).leaks(" ".join(doc))}
        assert got.get(7, 0) == slow_cover(item, doc, width)


def test_repetitive_texts_are_not_paired():
    """An item of few distinct words against a long text of the same: tiled exactly, in time that follows the lengths."""
    rng = random.Random(5)
    for _ in range(40):
        item, doc = [rng.choice("ab") for _ in range(24)], [rng.choice("ab") for _ in range(60)]
        got = {x[0]: x[2] for x in d.Index([(7, " ".join(item))], 3).leaks(" ".join(doc))}
        assert got.get(7, 0) == slow_cover(item, doc, 3)
    began = time.process_time()
    item = "la " * 30 + "x " + "la " * 19
    assert [r[:4] for r in d.Index([(1, item)], 5).leaks("la " * 60_000)] == [(1, 50, 49, 2)]
    assert time.process_time() - began < 3


def test_longer_item_bounds_nothing_but_itself():
    rng = random.Random(8)
    item = [f"w{rng.randrange(3000)}" for _ in range(3000)]
    doc = item[1500:] + ["between"] + item[:1500]
    assert [r[:4] for r in d.Index([(1, " ".join(item)), (2, " ".join(item[:3]))], 5).leaks(" ".join(doc), 0.6)] == [(1, 3000, 3000, 2), (2, 3, 3, 1)]


def test_doc_ids_beside_null_stay_longs(spark, prose):
    rows = [(2**53 + 1, prose(1)), (None, prose(1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, prose(1))], "item_id long, text string")
    assert {r.doc_id for r in d.leaks(docs, items).collect()} == {2**53 + 1, None}


def test_reordered_passages_are_caught(spark, prose):
    item = prose(1, 40).split()
    moved = item[20:] + ["between", "these"] + item[:20]
    rows = [(1, "start " + " ".join(moved).upper() + " end"), (2, " ".join(item[:10]) + " " + prose(3)), (3, prose(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item)), (10, None), (11, ""), (12, "...")], "item_id long, text string")
    got = d.leaks(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.tiles, r.covered) for r in got] == [(1, 9, 2, 40)]
    assert [r.doc_id for r in d.clean(docs, items).orderBy("doc_id").collect()] == [2, 3]


def test_blocks_give_the_same_rows(spark, prose, monkeypatch):
    items = spark.createDataFrame([(i, prose(i, 30)) for i in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(50 + i) + " " + prose(i, 30)) for i in range(12)], "doc_id long, text string")
    whole = sorted(tuple(r) for r in d.leaks(docs, items).collect())
    assert len(list(d._blocks(items.repartition(12)))) == 1  # however many files
    monkeypatch.setattr(d, "ITEM_BLOCK", 40)
    assert len(list(d._blocks(items))) > 4
    assert sorted(tuple(r) for r in d.leaks(docs, items).collect()) == whole and len(whole) == 12


def test_odd_rows(spark, odd_docs, no_docs, prose):
    items = spark.createDataFrame([(1, prose(1), "x"), (1, prose(1), "x"), (None, "la la la la la la", None), (3, "short", None)], "item_id long, text string, doc_id string")
    got = d.leaks(odd_docs, items).collect()
    assert sorted((r.doc_id or -1, r.item_id or -1) for r in got) == [(-1, 1), (-1, 1), (1, 1), (1, 1), (1, 1), (1, 1), (2, 1), (2, 1), (7, -1)]
    kept = d.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 4, 5, 6, 8]
    assert d.leaks(no_docs, items).count() == 0 and d.leaks(odd_docs, items.where("false")).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, d.words(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        doc = d.words(r.text)
        grams = {tuple(doc[j : j + 5]) for j in range(len(doc))}
        for item_id, w in items:
            if any(tuple(w[i : i + 5]) in grams for i in range(len(w) - 4)) and slow_cover(w, doc, 5) >= d.THRESHOLD * len(w):
                want.add((r.doc_id, item_id))
    assert {(r.doc_id, r.item_id) for r in d.op2_benchmark_decontamination(spark, sf).collect()} == want and want
