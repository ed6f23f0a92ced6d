import math
import re
from collections import Counter

import pytest
from claimlens.llm import mixing
from pyspark.sql import functions as F


def test_exponent_meets_limits():
    tokens = [1_000_000, 50_000, 40_000, 10_000, 0]
    top = math.log(4)
    a = mixing.bisect_exponent(tokens, 0.9, None)
    assert mixing.entropy(mixing.weights(tokens, a)) == pytest.approx(0.9 * top, rel=1e-6)
    a = mixing.bisect_exponent(tokens, 0.99, 3.0)
    p = mixing.passes(tokens, mixing.weights(tokens, a), None)
    assert max(p) == pytest.approx(3.0, rel=1e-6) and min(x for x in p if x) == pytest.approx(1.0)
    assert mixing.bisect_exponent([5, 5], 0.98, 2.0) == 1.0
    assert mixing.bisect_exponent([10], 0.98, 2.0) == 1.0


def frame(spark, prose):
    sizes = {"big": 400, "mid": 60, "small": 30}
    rows = [(k * 1000 + i, prose(i, 40), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), sizes


def test_every_document_is_read_and_weights_are_met(spark, prose):
    docs, sizes = frame(spark, prose)
    rows = mixing.mix(docs, block_tokens=400).collect()
    got = Counter(r.source for r in rows)
    want = mixing.passes([n * 40 for n in sizes.values()], mixing.weights([n * 40 for n in sizes.values()], mixing.bisect_exponent([n * 40 for n in sizes.values()], mixing.ENTROPY, mixing.MAX_REPEAT)), None)
    for (source, n), times in zip(sizes.items(), want, strict=True):
        assert got[source] == pytest.approx(n * times, abs=12)
        copies = Counter(r.doc_id for r in rows if r.source == source)
        assert len(copies) == n and max(copies.values()) <= math.ceil(times + 1e-9) and min(copies.values()) >= math.floor(times + 1e-9)
    again = mixing.mix(docs, block_tokens=400).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_budget_takes_blocks_up_to_the_edge(spark, prose):
    docs, sizes = frame(spark, prose)
    rows = mixing.mix(docs, budget=9000, block_tokens=400).collect()
    assert 9000 - 3 * 40 <= sum(r.mix_tokens for r in rows) <= 9000
    # whole blocks but for one a source
    blocks = Counter((r.source, r.mix_block) for r in rows if r.source == "big")
    full = Counter(r.mix_block for r in mixing.mix(docs, block_tokens=400).collect() if r.source == "big" and r.mix_epoch == 0)
    assert sum(n != full[b] for (_, b), n in blocks.items()) <= 1


def test_odd_rows(odd_docs, no_docs, spark):
    out = mixing.mix(odd_docs)
    assert set(odd_docs.columns) < set(out.columns)
    ids = [r.doc_id for r in out.collect()]
    assert set(ids) >= {1, 2, 6, 7, 8} and ids.count(1) >= 2
    assert mixing.mix(no_docs).count() == 0
    blank = odd_docs.where("text is null or trim(text) = ''")
    assert mixing.mix(blank).count() == blank.count()
    clash = odd_docs.withColumnsRenamed({"digest": "mix_order", "row": "copies", "lang": "block"})
    assert {"mix_order", "mix_order_"} <= set(mixing.mix(clash).columns)


def slow_mix(spark, docs, target, max_repeat, budget, block_tokens, seed):
    """The mixture in plain Python: shares, exponent, passes, and each source's blocks in the order of their hashes."""
    h = lambda *c: F.xxhash64(*c)
    key = F.struct("doc_id", "source")
    rows = docs.select("doc_id", "source", "text", h(F.lit(seed), key).alias("deal"), h(F.lit(seed + 1), key).alias("h"), F.to_json(F.struct("source")).alias("label")).collect()
    tokens = lambda r: len(re.findall(r"[^ \t\n\x0b\f\r]+", r.text or ""))
    totals = Counter()
    for r in rows:
        totals[r.label] += tokens(r)
    labels = sorted(totals)
    sizes = [totals[x] for x in labels]
    shares = lambda a: [(t / sum(sizes)) ** a if t else 0.0 for t in sizes]
    fits = []
    for a in (k / 20_000 for k in range(20_001)):
        w = [x / sum(shares(a)) for x in shares(a)]
        per = [x / t for x, t in zip(w, sizes, strict=True) if t]
        fits.append((a, -sum(x * math.log(x) for x in w if x) >= target * math.log(sum(t > 0 for t in sizes)), max(per) * (budget or 1 / min(per)) <= max_repeat))
    near = max([max((a for a, even, _ in fits if even), default=0.0), min((a for a, _, seldom in fits if seldom), default=1.0)])
    a = mixing.bisect_exponent(sizes, target, max_repeat, budget)
    assert a == pytest.approx(near, abs=1e-4)
    w = [x / sum(shares(a)) for x in shares(a)]
    per = [x / t if t else 0.0 for x, t in zip(w, sizes, strict=True)]
    out = Counter()
    for label, size, p in zip(labels, sizes, per, strict=True):
        times = p * (budget or 1 / min(x for x in per if x))
        whole, own = int(times + 1e-9) if size else 1, [r for r in rows if r.label == label]
        n = max(1, math.ceil(size / block_tokens))
        room, taken = max(0.0, times - whole) * size, set()
        blocks = sorted({r.deal % n for r in own})
        order = {r.b: r.o for r in spark.createDataFrame([(b,) for b in blocks], "b long").select("b", h(F.lit(seed + 2), F.lit(label), F.col("b")).alias("o")).collect()}
        for b in sorted(blocks, key=lambda b: (order[b], b)) if room > 0 else []:
            inside = sorted((r for r in own if r.deal % n == b), key=lambda r: r.h)
            held = sum(map(tokens, inside))
            if held <= room:
                taken |= {id(r) for r in inside}
            elif room > 0:
                run = 0
                for r in inside:
                    run += tokens(r)
                    if run > room:
                        break
                    taken.add(id(r))
            room -= held
        for r in own:
            out[r.doc_id, r.source] += whole + (id(r) in taken)
    return +out


def test_query_equals_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "text")
    got = mixing.op3_source_mixing(spark, "/root/testdata/sf0.001").collect()
    want = slow_mix(spark, docs, mixing.ENTROPY, mixing.MAX_REPEAT, None, mixing.BLOCK_TOKENS, mixing.SEED)
    assert Counter((r.doc_id, r.source) for r in got) == want
    epochs = Counter((r.doc_id, r.source, r.mix_epoch) for r in got)
    assert set(epochs.values()) == {1} and len({r.mix_order for r in got}) == len(got)


@pytest.mark.parametrize("budget", [None, 20_000, 400_000])
def test_small_blocks_equal_plain_python(spark, prose, budget):
    docs, _ = frame(spark, prose)
    got = Counter((r.doc_id, r.source) for r in mixing.mix(docs, 0.9, 3.0, budget, 300, 5).collect())
    assert got == slow_mix(spark, docs, 0.9, 3.0, budget, 300, 5)
