import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from claimlens.llm import variants
from claimlens.plans.staging import Staging
from pyspark.sql import functions as F


def near(a, b):
    """By all single edits of a, without the library's test."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            x = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if x % 199 == 0:
                at = x % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    by = defaultdict(list)
    for w in n:
        by[len(w)].append(w)
    form, close = {}, {}
    for w in n:
        close[w] = [x for d in (-1, 0, 1) for x in by[len(w) + d] if near(w, x)]
        best = min(close[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n[w], len(close[w]), n[form[w]] if form[w] else None))
    return out


def answer(spark, rows, tmp_path, extra=None):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in (extra or {}).items():
        df = df.withColumn(name, value)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in variants.op11_spelling_variants(spark, str(tmp_path)).collect()]


def corpus(seed, docs=120):
    """Few stems, misspelt in chains, so that near words and forms of forms abound."""
    rng = random.Random(seed)
    letters = "abdeeiorstlnzéàÀß÷"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(15)]

    def slip(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + w[i : i + 2][::-1] + w[i + 2 :]])

    once = [slip(w) for w in stems for _ in range(4)]
    twice = [slip(w) for w in once for _ in range(2)]
    pool = stems * 100 + once * 12 + twice
    return [(i, " ".join(rng.choice([str.upper, str.lower, str])(rng.choice(pool)) if rng.random() < 0.1 else rng.choice(pool) for _ in range(150))) for i in range(docs)]


def test_against_all_pairs(spark, tmp_path):
    for seed in range(2):
        rows = corpus(seed)
        want = brute(rows)
        got = answer(spark, rows, tmp_path / str(seed))
        assert set(got) == want and len(got) == len(want)
        assert any(r[1] for r in want) and any(r[1] != r[2] for r in want if r[1])


def test_hot_subtrees_are_split_and_lose_nothing(spark):
    rng = random.Random(3)
    words = list({"".join(rng.choice("aeioaeiost") for _ in range(rng.randrange(6, 9))) for _ in range(1500)}) + ["banana", "nabana", "abanan"]
    df = spark.createDataFrame([(w, i + 5) for i, w in enumerate(words)], "word string, n long")
    want = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if near(a, b)}
    for members in (2, 40, 100_000):
        got = variants.near_words(df, Staging(spark, "test"), members).collect()
        assert len(got) == len(want) and {frozenset((r.a, r.b)) for r in got} == want
        n = {w: i + 5 for i, w in enumerate(words)}
        assert all(r.a_n == n[r.a] and r.b_n == n[r.b] for r in got)


def test_paths(spark):
    words = ["eaionr", "zebras", "éèßÿÀx", "cmhgpb"]
    got = spark.createDataFrame([(w,) for w in words], "word string").select("word", variants.counts(F.col("word")).alias("p")).collect()
    for r in got:
        assert sum(r.p) == len(r.word)
        for g, c in zip(variants.GROUPS, r.p, strict=True):
            assert c == sum((x in g) if g else not x.isascii() for x in r.word)


def test_leaves_of_one_path():
    """Words that no count tells apart are still compared, in stretches of a leaf's size."""
    words = np.array(["".join(x) for x in itertools.permutations("abcdef")] + ["abcdeg", "abcdefg", "y" * 40, "y" * 41], dtype=object)
    flat = np.zeros((len(words), 3), np.int32)
    trie = variants.Trie(words, np.ones(len(words)), flat)
    got = [(words[i], trie.held.words[w]) for q, found in trie.near(variants.Words(words, flat)) for i, w in zip(q, found, strict=True)]
    want = {frozenset((a, b)) for k, a in enumerate(words) for b in words[:k] if near(a, b)}
    assert {frozenset(p) for p in got} == want and len(got) == len(want)


def test_odd_rows(spark, tmp_path):
    base = "lantern lantern lantern lantern lantern lantrn lantrn lantrn lantrn lantrn Lanterns"
    rows = [(1, base)] * 30 + [(2, None), (3, ""), (4, " \n12 :"), (None, base), (None, "lantern"), (5, "x" * 200_000), (6, ("y" * 30_000 + " ") * 6), (7, "été÷×ñandú " * 7)]
    got = answer(spark, rows, tmp_path, {"word": F.lit("w"), "n": F.lit(1), "run": F.lit(2), "path": F.lit(None).cast("string")})
    assert set(got) == brute(rows)


def test_no_rows(spark, tmp_path):
    assert answer(spark, [], tmp_path) == []
