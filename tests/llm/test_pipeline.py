import __spark_entry__
import corpus_pipeline as cp
from claimlens.llm import dac, decontaminate, mixing, simhash, toxicity
from claimlens.plans.staging import Staging


def test_stages_equal_their_definitions(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, items = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    staging, kept = Staging(spark, "test"), [docs]
    for name, stage in cp.STAGES:
        kept.append(staging.table(stage(spark, kept[-1], sf), name))
        if name != cp.STAGES[-1][0]:
            assert kept[-1].columns == docs.columns
    ids = [[r[0] for r in k.select("doc_id").collect()] for k in kept]
    score = {r.doc_id: r.predicted for r in toxicity.score(docs, labels).collect()}
    assert sorted(ids[1]) == sorted(i for i in ids[0] if not score[i])
    comp = {r.doc_id: r.component_id for r in simhash.near_duplicates(kept[1]).collect()}
    assert sorted(ids[2]) == sorted(i for i in ids[1] if comp[i] == i)
    bad = {r.doc_id for r in decontaminate.leaks(kept[2], items).collect()}
    assert sorted(ids[3]) == sorted(i for i in ids[2] if i not in bad)
    assert set(ids[4]) == set(ids[3]) and sorted(ids[4]) == sorted(r.doc_id for r in mixing.mix(kept[3]).collect())
    assert sorted(ids[5]) == sorted(ids[4])
    run = sorted(map(tuple, cp.run(spark, sf).collect()))
    assert run == sorted(map(tuple, kept[5].collect())) and run[0][1] == 0
    assert sum(r[2] for r in run) == run[-1][1] + run[-1][2]
    assert dac.MAGIC == b"DAC1"


def test_everything_is_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{i}" for i in range(1, 11)} <= {n.split("_")[0] for n in names}
    assert set(__spark_entry__.oracle_sql()) <= names


def tables(spark, root, docs, items, labels):
    docs.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_odd_rows_pass_through_all_stages(spark, odd_docs, prose, tmp_path):
    """Nulls, empty and very long texts, repeated rows and clashing columns, stage after stage."""
    sf = tables(spark, tmp_path, odd_docs, [(1, prose(1)), (2, None), (None, "")], [(1, 1, None), (None, 1, 1), (7, 0, 0)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = []
    for name, stage in cp.STAGES[:-1]:
        docs = Staging(spark, "odd").table(stage(spark, docs, sf), name)
        assert docs.columns == odd_docs.columns, name
        kept.append(sorted((r.doc_id if r.doc_id is not None else -1) for r in docs.collect()))
    assert kept[0] == sorted((r.doc_id if r.doc_id is not None else -1) for r in odd_docs.collect())  # labels of one class judge nothing
    assert kept[1] == [-1, -1, 1, 3, 6, 7, 8]  # one row of each group, and one without doc_id beside it
    assert kept[2] == [-1, 3, 6, 7, 8]  # the item's text goes, with and without doc_id
    assert set(kept[3]) == set(kept[2]) and len(kept[3]) >= len(kept[2])
    last = cp.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in last) == kept[3]
    whole = cp.run(spark, sf).collect()
    assert sorted(map(str, whole)) == sorted(map(str, last))


def test_empty_tables(spark, no_docs, tmp_path):
    sf = tables(spark, tmp_path, no_docs, [(1, "a b c d e f")], [(1, 1, 1), (2, 1, 0)])
    assert cp.run(spark, sf).count() == 0
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
        assert out.columns == no_docs.columns and out.count() == 0, name
