import hashlib
import zlib

import pytest
from claimlens.llm import merkle
from claimlens.plans.staging import Staging
from pyspark.sql import functions as F

COLUMNS = merkle.COLUMNS


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(nodes, arity):
    return [h(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append(up(out[-1], arity))
    return out


def siblings(tree, at, arity):
    out = []
    for level in tree[:-1]:
        run = level[at // arity * arity : at // arity * arity + arity]
        out += run[: at % arity] + run[at % arity + 1 :]
        at //= arity
    return out


def brute(rows, arity=16):
    """Per row (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified); rows hold COLUMNS."""
    groups = {}
    for r in rows:
        groups.setdefault("" if r[1] is None else "=" + r[1], []).append(r)
    names = sorted(groups, key=lambda x: x.encode())
    for k in names:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {k: levels([leaf(r) for r in groups[k]], arity) for k in names}
    top = levels([trees[k][-1][0] for k in names], arity)
    root = top[-1][0] if names else None
    out = []
    for g, k in enumerate(names):
        for i, r in enumerate(groups[k]):
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            bent = [leaf(x) for x in groups[k]]
            bent[i] = leaf((*r[:4], text))
            tops = [trees[x][-1][0] for x in names]
            tops[g] = levels(bent, arity)[-1][0]
            folded = levels(tops, arity)[-1][0]
            proof = siblings(trees[k], i, arity) + siblings(top, g, arity)
            out.append((r[0], leaf(r), trees[k][-1][0], root, h(*proof), folded, folded == root))
    return out


def answer(spark, rows, tmp_path, extra=None):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for name, value in (extra or {}).items():
        df = df.withColumn(name, value)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in merkle.op13_merkle_manifest(spark, str(tmp_path)).collect()]


def order(rows):
    return sorted(rows, key=lambda r: [str(x) for x in r])


def test_trees_of_many_sizes(spark, tmp_path):
    sizes = {"a": 300, "b": 1, "é": 16, "c": 17, "": 2, None: 5} | {f"s{i:02}": 1 + i % 3 for i in range(20)}
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            n += 1
            rows.append((n * 7919 % 1000, source, None if n % 4 == 0 else "en", n, None if n % 9 == 0 else f"Text Ünï {n}"))
    got = answer(spark, rows, tmp_path)
    assert order(got) == order(brute(rows))
    assert {True, False} == {r[-1] for r in got}


def test_odd_rows(spark, tmp_path):
    rows = [(None, None, None, None, None)] * 3 + [(5, "s", "en", 3, "ABC")] * 40 + [(5, "s", "en", 3, "other"), (None, "s", None, None, ""), (6, "s", "en", 0, "B" * 200_000)]
    clashing = {"leaf": F.lit("x"), "tree": F.lit(1), "digest": F.lit(None).cast("string"), "part": F.lit(0), "at": F.lit(9)}
    assert order(answer(spark, rows, tmp_path, clashing)) == order(brute(rows))


def test_no_rows(spark, tmp_path):
    assert answer(spark, [], tmp_path) == []


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_any_arity_proofs_and_files(spark, tmp_path, arity):
    rows = [(i, "abc"[i % 3] if i % 7 else "d", "en", i, f"t{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    leaves = df.select("doc_id", "source", merkle.leaf(*COLUMNS).alias("leaf"))
    tree = merkle.build(leaves, "source", "doc_id", Staging(spark, "test"), arity)
    want = {(r[0], r[4]) for r in brute(rows, arity)}
    got = tree.leaves.join(tree.proofs(), ["tree", "idx"]).collect()
    assert {(r.doc_id, h(r.proof)) for r in got} == want and tree.root == brute(rows, arity)[0][3]
    assert {r.folded for r in tree.fold(tree.leaves, "leaf").collect()} == {tree.root}
    tree.write(f"{tmp_path}/m")
    assert spark.read.parquet(f"{tmp_path}/m/leaves").count() == 60
    run = spark.read.parquet(f"{tmp_path}/m/runs-0").first()
    assert len(run.run) <= arity


def test_a_changed_leaf_leads_elsewhere(spark):
    df = spark.createDataFrame([(i, "s", h(str(i))) for i in range(40)], "doc_id long, source string, leaf string")
    tree = merkle.build(df, "source", "doc_id", Staging(spark, "test"))
    bad = tree.leaves.withColumn("leaf", F.when(F.col("doc_id") == 17, F.lit(h("x"))).otherwise(F.col("leaf")))
    wrong = tree.fold(bad, "leaf").where(F.col("folded") != tree.root).collect()
    assert [r.idx for r in wrong] == [17]
