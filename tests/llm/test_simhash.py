import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from claimlens.llm import simhash
from pyspark.sql import functions as F


def slow(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(v >> b & 1 for v in h) * 2 > len(h))


def brute(fps):
    parent = list(range(len(fps)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_definition(prose):
    for t in [None, "", " \n", "One", "one two", "One TWO three É", prose(3), "a b c " * 50, "É É b\x0bc d"]:
        assert simhash.fingerprint(t) == slow(t)


def test_masks_cover_radius_two():
    masks = simhash.masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(i):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


@pytest.mark.parametrize("group", [64, 2])
def test_links_equal_brute_force(spark, group):
    """Every pair within the radius and no other; with buckets of two, by the second and third families of masks."""
    rng = random.Random(4)
    fps = []
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.append(x)
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
    signed = sorted({simhash._as_signed(f) for f in fps})
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), simhash.Staging(spark, "t"), group).collect()
    near = lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2
    assert {(r.src, r.dst) for r in got} == {(a, b) for i, b in enumerate(signed) for a in signed[:i] if near(a, b)}
    assert len(got) == len({(r.src, r.dst) for r in got})


def test_families_of_masks_cover_and_end_small():
    family = simhash.masks()
    for _ in range(simhash.FAMILIES - 1):
        below = simhash.narrower(family)
        for m, own in zip(family, below, strict=True):
            dropped = [i for i in range(64) if not m >> i & 1]
            assert all(any(not x >> i & 1 and not x >> j & 1 for x in own) for i in dropped for j in dropped)
        family = [m for own in below for m in own]
    assert max(64 - m.bit_count() for m in family) <= 6  # 2^6 fingerprints are GROUP


def test_large_bucket_is_not_listed_in_pairs(spark):
    """4,096 fingerprints that share a mask's bits: linked as by brute force, by buckets of GROUP at most."""
    places = [i for i in range(64) if not simhash.masks()[0] >> i & 1][::2][:12]
    fps = [sum(1 << p for k, p in enumerate(places) if n >> k & 1) for n in range(4096)]
    rows = spark.createDataFrame([(simhash._as_signed(f),) for f in fps], "fp long")
    got = simhash.links(rows, simhash.Staging(spark, "t"))
    assert got.count() == 4096 * (12 + 66) // 2


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    comp = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert comp[1] == 1 and comp[3] == comp[4] == comp[5] == 3
    assert sorted(r.component_id for r in rows if r.doc_id is None) == [1, 3]
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 4 not in ids and 3 in ids and ids.count(None) == 2


def test_query_equals_brute_force(spark):
    rows = simhash.op5_simhash_near_dedup(spark, "/root/testdata/sf0.001").collect()
    fps = [int(r.fingerprint, 16) for r in rows]
    root = brute(fps)
    least = {}
    for k, r in zip(root, rows, strict=True):
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    assert [r.component_id for r in rows] == [least[k] for k in root]
    text = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(int(r.fingerprint, 16) == slow(text[r.doc_id]) for r in rows[:40])
    assert np.all([len(r.fingerprint) == 16 for r in rows])


def test_near_copies_of_similarity_are_linked(spark, prose):
    rows = []
    for i in range(60):
        w = prose(i, 150).split()
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:70], f"new{i}", *w[71:], f"end{i}"]))]
        assert simhash.jaccard(rows[-1][1], rows[-2][1]) >= 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs).collect()) == list(range(0, 120, 2))
    assert len({r.component_id for r in simhash.near_duplicates(docs, similarity=None).collect()}) > 60


def test_rows_are_kept_by_row(spark, prose):
    """A repeated doc_id with different texts keeps each text; rows without doc_id keep one of each."""
    rows = [(1, prose(1)), (2, prose(2)), (2, prose(3)), (2, prose(1)), (None, prose(4)), (None, prose(4)), (None, prose(5))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in kept) == sorted(map(prose, (1, 2, 3, 4, 5)))


@pytest.mark.parametrize("rounds, listed, block", [(2, 16, 512), (0, 0, 7), (1, 4, 3), (0, 10**6, 512)])
def test_similarity_components_equal_brute_force(spark, prose, monkeypatch, rounds, listed, block):
    """Chains whose ends are unlike, beside groups of copies: no component is lost where a key holds several."""
    for name, value in (("ROUNDS", rounds), ("LISTED", listed), ("BLOCK", block)):
        monkeypatch.setattr(simhash, name, value)
    rng, texts = random.Random(9), []
    for i in range(12):
        w = prose(i, 70).split()
        for step in range(12):
            texts.append(" ".join(w))
            w[rng.randrange(len(w))] = f"n{i}x{step}"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(texts)):
        for j in range(i):
            if simhash.jaccard(texts[i], texts[j]) >= simhash.SIMILARITY:
                parent[find(i)] = find(j)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    groups = lambda f: {tuple(j for j in range(len(texts)) if f(j) == k) for k in map(f, range(len(texts)))}
    assert groups(got.get) == groups(find)


def test_alike_texts_below_the_similarity_hide_no_link(spark):
    """300 texts of 1,001 words and one core: 150 pairs at 0.814, all others at 0.790."""
    core = [f"core{i}" for i in range(884)]
    texts = [" ".join([*core, *[f"p{n // 2}x{i}" for i in range(15)], *[f"u{n}x{i}" for i in range(102)]]) for n in range(300)]
    assert simhash.jaccard(texts[0], texts[1]) > 0.8 > simhash.jaccard(texts[0], texts[2]) > 0.78
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = simhash.fingerprints(docs, True)
    fp = {r.doc_id: r.fp for r in own.collect()}
    links = {frozenset((r.src, r.dst)) for r in simhash.similar_links(docs, own, simhash.Staging(spark, "t"), 0.8).collect()}
    planted = {frozenset((fp[n], fp[n + 1])) for n in range(0, 300, 2)}
    assert links == {p for p in planted if len(p) == 2}  # two of one fingerprint need no link


def test_overlaps_of_sets():
    rng = np.random.default_rng(2)
    few = [np.unique(rng.integers(0, 300, rng.integers(1, 90))) for _ in range(40)]
    many = [np.unique(rng.integers(0, 3000, rng.integers(1, 400))) for _ in range(25)]
    want = [[len(np.intersect1d(a, b)) for b in many] for a in few]
    for dense in (0, 30, 10**9):
        assert simhash.overlaps(pd.Series(few), pd.Series(many), dense, 1000).tolist() == want


def test_a_column_of_maps_travels(spark, prose):
    docs = spark.createDataFrame([(1, prose(1)), (2, prose(1)), (3, prose(2))], "doc_id long, text string").withColumn("m", F.create_map(F.lit("a"), F.col("doc_id")))
    assert sorted((r.doc_id, r.m["a"]) for r in simhash.keep_one(docs).collect()) == [(1, 1), (3, 3)]
