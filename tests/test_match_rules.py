"""All rules on single matches, with the identifiers that an earlier database lacks."""

import datetime

import duckdb
import pytest
from compare import difference

from policyscan.operators import quality
from policyscan.plans import catalog

MATCHES = [
    ("a", "CKV_AWS_1", "HIGH", 0.9),
    ("a", "CKV_AWS_1", "LOW", 0.9),
    ("a", "CKV2_AWS_FOO", None, 0.1),
    ("b", "CKV_GCP_2", "odd", 0.2),
    ("b", "CKV_GCP_3", "", 0.5),
]
OWN_RULES = [
    ("a", "CKV2_AWS_FOO", "INVALID_CHECKOV_ID"),
    ("a", "CKV2_AWS_FOO", "LOW_MATCH_CONFIDENCE"),
    ("a", "CKV2_AWS_FOO", "MISSING_SEVERITY"),
    ("b", "CKV_GCP_2", "INVALID_SEVERITY"),
    ("b", "CKV_GCP_3", "MISSING_SEVERITY"),
]


@pytest.mark.parametrize(
    ("known", "new"),
    [
        (None, []),
        ([], []),
        (["CKV_GCP_2", "CKV_GCP_2", None], [("a", "CKV_AWS_1"), ("a", "CKV_AWS_1"), ("a", "CKV2_AWS_FOO"), ("b", "CKV_GCP_3")]),
        (["CKV_AWS_1", "CKV2_AWS_FOO", "CKV_GCP_3", "CKV_GCP_2"], []),
    ],
)
def test_new_identifiers_are_told_beside_the_rules_of_a_match(spark, known, new):
    matches = spark.createDataFrame(MATCHES, "path string, checkov_id string, severity string, confidence double")
    if known is not None:
        known = spark.createDataFrame([(k, "LOW") for k in known], "checkov_id string, severity string")
    rows = quality.validate_matches(matches, known).collect()
    expected = [*OWN_RULES, *((path, identifier, "NEW_CHECKOV_ID") for path, identifier in new)]
    assert sorted((r.file_path, r.checkov_id, r.code) for r in rows) == sorted(expected)
    assert {r.level for r in rows if r.code == "NEW_CHECKOV_ID"} <= {"INFO"}


@pytest.mark.parametrize("closed", [True, False])
def test_query_looks_into_the_earlier_database(spark, tmp_path, closed):
    columns = "o_orderkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"
    day = datetime.datetime(1997, 1, 1)
    orders = [(k, "F" if closed and k < 30 else "O", "1-URGENT" if k % 2 else "2-HIGH", day) for k in range(90)]
    spark.createDataFrame(orders, columns).write.parquet(f"{tmp_path}/orders.parquet")
    texts = [(0, "one " * 30), (1, "severity of a page " * 9), (2, "three " * 40)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    done = catalog.QUERIES["dq_match"](spark, str(tmp_path))
    rows = done.collect()
    new = {r.checkov_id for r in rows if r.code == "NEW_CHECKOV_ID"}
    numbers = {int(n) for n in (i.rsplit("_", 1)[1] for i in new) if n.isdigit()}
    assert numbers == (set(range(10, 30)) if closed else set())
    assert {"INVALID_CHECKOV_ID", "MISSING_SEVERITY"} <= {r.code for r in rows}
    connection = duckdb.connect()
    for name in ("orders", "documents"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert difference(spark, connection, "dq_match", str(tmp_path)) is None
    assert not any("documents.parquet" in file for file in done.inputFiles())
