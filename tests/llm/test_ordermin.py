import hashlib
import random
import re
import struct
from collections import Counter

import pytest
import xxhash
from claimlens.llm import ordermin
from pyspark.sql import functions as F


def long_hash(x, seed=42):
    return xxhash.xxh64_intdigest(struct.pack("<q", x), seed)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute(text):
    """Order MinHash in plain Python: of each turn of the circle of hashes the two least numbered k-mers, in the text's order."""
    high, words = -(1 << 28), re.findall(r"\S{1,8}", text or "", re.ASCII)
    seen, numbered = Counter(), []
    for i in range(max(len(words) - 3, 0) + 1):
        h = 42
        for w in words[i : i + 3]:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        h = signed(h) & high
        numbered.append((signed(xxhash.xxh64_intdigest(struct.pack("<I", seen[h]), long_hash(h))) & high, i))
        seen[h] += 1
    out = []
    for j in range(64):
        start = -(1 << 63) + j * (1 << 58)
        least = sorted(numbered, key=lambda x: ((x[0] - start) % (1 << 64), x[1]))[:2]
        h = 42
        for x, _ in sorted(least, key=lambda x: x[1]):
            h = long_hash((x & ((1 << 64) - 1)) >> 28, h)
        out.append(f"{h >> 32:08x}")
    return "".join(out)


def like(a, b):
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, 512, 8)) / 64


def expected(rows):
    texts = [(i, t or "") for i, t in sorted(rows)]
    for k, (i, t) in enumerate(texts):
        other = texts[(k + 1) % len(texts)][1]
        half = len(t) // 2
        edit = t[: len(t) - half] + other[:half]
        a, b, c = brute(t), brute(edit), brute(other)
        yield (i, len(t), hashlib.sha256(edit.encode()).hexdigest(), a, b, like(a, b), like(a, c))


def answer(spark, rows, tmp_path, parts=3, extra=None):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for name, value in (extra or {}).items():
        df = df.withColumn(name, value)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in ordermin.op12_document_fingerprints(spark, str(tmp_path)).collect()]


def test_against_plain_python(spark, tmp_path, prose):
    rng = random.Random(1)
    rows = [(i * 3 % 101, prose(i, rng.randrange(1, 150))) for i in range(60)]
    rows += [(200, "la " * 500), (201, None), (202, ""), (203, " \n\t"), (204, "one"), (205, "one two"), (206, "Ünïcödé \U0001f600 中文" * 40), (207, "x" * 5000), (208, "a b c")]
    assert sorted(answer(spark, rows, tmp_path)) == sorted(expected(rows))


def test_odd_rows(spark, tmp_path, prose):
    rows = [(5, prose(1))] * 30 + [(5, "other"), (None, prose(2)), (None, None), (None, prose(2)), (9, "tail " * 30)]
    got = answer(spark, rows, tmp_path, 8, {"h": F.lit(1), "part": F.lit(2), "at": F.lit(0), "components": F.lit("c"), "next": F.lit(1)})
    assert len(got) == len(rows) and Counter(r[0] for r in got) == Counter(r[0] for r in rows)
    assert sum(r[0] == 5 and r[6] == 1.0 for r in got) >= 29  # a copy is followed by a copy
    assert {r[3] for r in got if r[0] == 5 and r[1] == len(prose(1))} == {brute(prose(1))}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, tmp_path, n):
    rows = [(i, f"text number {i} of few rows") for i in range(n)]
    assert sorted(answer(spark, rows, tmp_path)) == sorted(expected(rows))


def test_order_and_edits_tell(spark, prose):
    words = prose(7, 400).split()
    one = words.copy()
    one[200] = "changed"
    swapped = words[200:] + words[:200]
    shuffled = words.copy()
    random.Random(0).shuffle(shuffled)
    texts = [" ".join(x) for x in (words, one, swapped, shuffled, words[:300])]
    sig = [brute(t) for t in texts]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(ordermin.written(ordermin.signature(F.col("text"))).alias("s"))
    assert [r.s for r in df.collect()] == sig
    close, moved, mixed, cut = [like(sig[0], s) for s in sig[1:]]
    assert close > 0.9 and 0.2 < moved < 0.8 and mixed < 0.1 and 0.3 < cut < 0.9


def test_no_python_on_the_main_path(spark, tmp_path):
    spark.createDataFrame([(1, "a b c d")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    plan = ordermin.op12_document_fingerprints(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
