"""Queries against their SQL on the smallest tables (all of them: tests/compare.py)."""

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from policyscan.plans.catalog import QUERIES
from policyscan.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
CHECKED = [
    "mappings_first_wins",
    "extract_ids",
    "extract_ids_builtin",
    "process_document",
    "process_batch",
    "pair_nearest",
    "conflict_join",
    "dq_result",
    "dq_duplicates",
    "dq_quality_report",
    "result_statistics",
    "statistics_report",
    "sink_results_document",
    "sink_results_json",
    "sink_summary_json",
    "read_with_encoding",
    "text_preprocess",
    "incremental_refresh",
    "custom_matcher",
    "custom_patterns",
    "custom_validator",
    "db_read_pieces",
    "dq_db_confidence",
    "dq_db_validate",
    "extraction_summary",
    "incremental_changed",
    "incremental_listing",
    "limit_first_10",
    "read_report",
    "throughput",
    "topk_providers",
]


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_sql_names_are_queries():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry_keeps_one_row_per_identifier(spark):
    rows = entry(spark).collect()
    assert rows and len({r.checkov_id for r in rows}) == len(rows)


@pytest.mark.parametrize("name", CHECKED)
def test_query_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, name, SF) is None
