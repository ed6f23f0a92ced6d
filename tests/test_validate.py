"""Checks of a store: joins of tables that grow stay small in every task."""

from claimlens.operators import validate
from claimlens.sources import projection as P
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def test_tables_that_grow_together_meet_in_every_partition(spark):
    store = P.store(spark, SF)
    store |= {name: F.broadcast(store[name]) for name in ("documents", "records", "runs", "series", "entities", "resolution_runs")}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = lambda found, check: found.where(F.col("check") == check).select(F.spark_partition_id()).distinct().count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables above it
    try:
        for check in ("late_document", "late_record", "late_run"):
            assert tasks(validate.late_evidence(store), check) == parts
        for check in ("decision", "assignment"):
            assert tasks(validate.resolution_lineage(store), check) == parts
        assert tasks(validate.resolution_clocks(store | {"resolution_runs": P.store(spark, SF)["resolution_runs"]}), "resolution_input") == parts
        for check in ("metadata_name", "metadata_identifier"):
            assert tasks(validate.metadata_types(store), check) == parts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_candidates_hold_no_table_whole(spark):
    found = validate.resolution_lineage(P.store(spark, SF)).where("check = 'candidate'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("ShuffledHashJoin") == 5
    assert found.count() > 0


def test_versions_of_hot_series_are_not_sorted(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables above it
    try:
        for check, joins in ((validate.value_kinds, 1), (validate.before_subjects, 4)):
            plan = check(P.store(spark, SF))._jdf.queryExecution().executedPlan().toString()
            assert "Sort" not in plan and plan.count("ShuffledHashJoin") == joins
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
