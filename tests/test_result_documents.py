"""The whole results document and the summary with the figures of a measured run, read back as JSON."""

import json

from policyscan.operators import database as db
from policyscan.operators.documents import exploded_matches, process_documents, result_mappings
from policyscan.sinks import documents as sinks

PAGE = "== T\n\n|Checkov ID\n|https://example.test/a.py[CKV_AWS_{0}]\n\n|Severity\n|HIGH\n"
STAMP = "2024-01-01T00:00:00"


def written(lines, folder):
    sinks.write_document(lines, str(folder))
    return json.loads("".join(p.read_text() for p in sorted(folder.glob("part-*"))))


def staged(spark, pages, folder):
    documents = spark.createDataFrame(pages, "path string, content string")
    process_documents(documents).write.parquet(str(folder))
    return spark.read.parquet(str(folder))


def test_results_document(spark, tmp_path):
    pages = [(f"p{k:03d}", PAGE.format(k)) for k in range(1, 40)] + [('odd "path"', "no rule here"), ("empty", None)]
    done = staged(spark, pages, tmp_path / "results")
    whole = written(sinks.results_document(done, STAMP), tmp_path / "document")
    assert whole["metadata"] == {
        "total_files": 41, "successful_extractions": 39, "generated_at": STAMP + "Z", "format_version": "1.0",
    }
    assert whole["statistics"]["total_matches"] == whole["statistics"]["unique_checkov_ids"] == 39
    assert [r["file_path"] for r in whole["extraction_results"]] == sorted(p for p, _ in pages)
    assert "start_position" not in whole["extraction_results"][5]["matches"][0]
    raw = written(sinks.results_document(done, STAMP, include_raw=True), tmp_path / "raw")
    assert {"start_position", "end_position", "context"} <= set(raw["extraction_results"][5]["matches"][0])
    none = written(sinks.results_document(done.limit(0), STAMP), tmp_path / "none")
    assert none["extraction_results"] == [] and none["statistics"]["average_confidence"] == 0.0


def test_summary_with_processing_statistics(spark, tmp_path):
    done = staged(spark, [("a", PAGE.format(1)), ("b", PAGE.format(2))], tmp_path / "results")
    metadata = db.assemble(result_mappings(done))
    known = spark.createDataFrame([("CKV_AWS_1", "HIGH")], "checkov_id string, severity string")
    added = db.new_mappings(exploded_matches(done), known)
    run = {"total_files_found": 2, "files_per_second": 1.5}
    summary = written(sinks.summary_document(metadata, done, added, STAMP, STAMP, run), tmp_path / "with")
    assert summary["processing_statistics"] == run
    assert [m["checkov_id"] for m in summary["extraction_summary"]["new_mappings"]] == ["CKV_AWS_2"]
    plain = written(sinks.summary_document(metadata, done, added, STAMP, STAMP), tmp_path / "without")
    assert plain == {k: v for k, v in summary.items() if k != "processing_statistics"}
