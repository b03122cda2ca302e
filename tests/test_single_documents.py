"""Documents as one file, written by several tasks: order, commas, repeated and null keys."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from policyscan.operators import database as db
from policyscan.sinks import documents as sinks

STAMP = "2024-01-01T00:00:00"


def document(spark, entries, tail="]"):
    head = spark.createDataFrame([("[",)], "line string")
    return sinks.document_lines(head, spark.createDataFrame(entries, "key string, line string").repartition(5), tail)


def test_one_file_from_several_tasks(spark, tmp_path):
    ids = spark.range(30_000).selectExpr("concat('CKV_AWS_', id) AS checkov_id", "'p' AS path", "IF(id % 3 = 0, 'LOW', 'HIGH') AS severity")
    metadata = db.assemble(ids)
    lines = sinks.compact_document(ids, metadata, STAMP)
    target = tmp_path / "one.json"
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # so little data would be one part
    try:
        sinks.write_document(lines, str(tmp_path / "parts"))
        sinks.write_single(lines, str(target))
    finally:
        spark.conf.set(setting, "true")
    parts = sorted((tmp_path / "parts").glob("part-*"))
    assert len([p for p in parts if p.stat().st_size]) > 2
    assert target.read_bytes() == b"".join(p.read_bytes() for p in parts)
    held = json.loads(target.read_text())["s"]
    assert held == {r.checkov_id: r.severity for r in ids.collect()} and list(held) == sorted(held)
    size = sinks.compact_size(ids, STAMP).first().compact_size_bytes
    assert size == len(target.read_text().replace("\n", ""))
    assert {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {"one.json", "parts"}


def test_written_anew_or_not_at_all(spark, tmp_path):
    target = tmp_path / "one.json"
    sinks.write_single(document(spark, [("a", "1")]), str(target))
    with pytest.raises(AnalysisException):
        sinks.write_single(document(spark, [("a", "2")]), str(target))
    assert json.loads(target.read_text()) == [1]
    sinks.write_single(document(spark, [("a", "2"), ("b", "3")]), str(target), mode="overwrite")
    assert json.loads(target.read_text()) == [2, 3]
    with pytest.raises(ValueError):
        sinks.write_single(document(spark, [("a", "2")]), str(target), mode="append")
    broken = document(spark, [("a", "2")]).selectExpr("section", "key", "raise_error('stop') AS line")
    with pytest.raises(Exception, match="stop"):
        sinks.write_single(broken, str(target), mode="overwrite")
    assert json.loads(target.read_text()) == [2, 3]
    assert {p.name for p in tmp_path.iterdir() if not p.name.startswith(".")} == {"one.json"}


@pytest.mark.parametrize(
    "entries",
    [
        [],
        [("a", "{}")],
        [("b", "2"), ("a", "1"), ("a", "1"), ("a", "0"), ("b", "2")],
        [(None, "{}"), (None, "{}"), ("", '"x"'), ("a", "1")],
        [("a", '"same"')] * 300 + [("b", "5")] * 300,
    ],
)
def test_commas(spark, tmp_path, entries):
    target = tmp_path / "one.json"
    sinks.write_single(document(spark, entries), str(target))
    expected = sorted(entries, key=lambda e: (e[0] or "", e[1]))
    assert json.loads(target.read_text()) == [json.loads(line) for _, line in expected]


def test_repeated_and_null_identifiers(spark, tmp_path):
    rows = [("CKV_AWS_2", "LOW"), ("CKV_AWS_1", "LOW"), ("CKV_AWS_1", "HIGH"), ("CKV_AWS_1", None), (None, "LOW"), ('q"', None)]
    mappings = spark.createDataFrame(rows, "checkov_id string, severity string").withColumn("path", F.lit("p"))
    target = tmp_path / "one.json"
    sinks.write_single(sinks.compact_document(mappings, db.assemble(mappings), STAMP), str(target))
    pairs = json.loads(target.read_text(), object_pairs_hook=list)
    assert dict(pairs)["s"] == [("CKV_AWS_1", "HIGH"), ("CKV_AWS_2", "LOW"), ('q"', None)]
