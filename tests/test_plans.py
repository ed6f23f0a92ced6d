"""Plans: filters and column choices reach the scan, no product of tables, Python only where it must be."""

import re

import pytest
from claimlens.operators import views
from claimlens.plans import queries as core
from claimlens.plans import graph_queries, log_queries, page_queries, store_queries  # noqa: F401 they register their queries
from claimlens.sources import projection as P

SF = "/root/testdata/sf0.001"
#: Joins with a table of one row, or with a handful of fixed polygons.
ONE_ROW = {"evidence_hydration", "source_families", "coverage_namespaces", "capacity_milestone_links", "lineage_documents", "entity_dossiers", "provenance_faults", "complete_view_equality", "page_with_totals", "search_results", "change_page_hydrated", "point_in_polygon", "unsupported_claims"}
#: Case folding, HTML parsing, canonical JSON and hash chains have no native form.
PYTHON = {"alert_episodes", "assertion_alignment", "search_results", "store_payload_hashes", "store_validation", "search_facets", "search_page", "visible_html_text", "canonical_json_lines", "event_chain", "event_chain_violations", "event_chain_fold"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(core.QUERIES))
def test_no_products_and_no_stray_python(spark, name):
    text = plan(core.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text or name in ONE_ROW
    assert not re.search("Python|Pandas|Arrow", text) or name in PYTHON


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(views.current(P.claims(spark, SF).select("claim_id", "entity_id", "predicate", "valid_from", "valid_to", "recorded_us", "superseded_us"), "2024-01-15", 1, predicate="purchase").select("claim_id"))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text)[1]
    assert "EqualTo(event_type,purchase)" in text and "props" not in read and "value" not in read
    text = plan(core.QUERIES["partial_date_bounds"](spark, SF))
    assert re.search(r"ReadSchema: struct<([^>]*)>", text)[1].count(":") == 2


def test_one_shuffle_where_one_is_enough(spark):
    assert plan(core.QUERIES["summary_by_kind"](spark, SF)).count("Exchange hashpartitioning") <= 4
    assert plan(core.QUERIES["earliest_latest_milestone"](spark, SF)).count("Exchange") == 1
    assert plan(core.QUERIES["forecast_points"](spark, SF)).count("Exchange SinglePartition") == 0
