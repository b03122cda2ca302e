"""Runs measured while they write, and the reports made from them."""

from pyspark.sql import functions as F

from policyscan.operators import runs, statistics
from policyscan.operators.documents import process_documents
from policyscan.sources import files

PAGE = "== T\n\n|Checkov ID\n|https://example.test/a.py[{}]\n\n|Severity\n|{}\n"


def test_counters_and_times_of_one_write(spark, tmp_path):
    folder, target = tmp_path / "pages", str(tmp_path / "results")
    folder.mkdir()
    for i in range(5):
        (folder / f"p{i}.adoc").write_text(PAGE.format(f"CKV_AWS_{i}", "HIGH" if i else "NONE"))
    found = files.manifest(spark, str(folder))
    listed = files.listing(found).count()
    (folder / "p4.adoc").unlink()
    run = runs.measured_run(found, target, files_found=listed)
    assert (run.total_files_found, run.files_read, run.files_failed, run.total_files_processed) == (5, 4, 1, 4)
    assert (run.successful_extractions, run.failed_extractions, run.total_matches) == (3, 1, 4)
    sizes = [len(PAGE.format(f"CKV_AWS_{i}", "HIGH" if i else "NONE")) for i in range(4)]
    assert run.total_bytes_processed == sum(sizes) and run.duration_seconds > 0
    assert abs(run.files_per_second * run.duration_seconds - 4) < 1e-6
    stored = spark.read.parquet(target)
    assert stored.count() == 4
    report = statistics.statistics_report(stored, run.total_files_found, {"duration_seconds": run.duration_seconds})
    values = {(r.section, r.name): r.value for r in report.collect()}
    assert values["extraction_summary", "total_files_found"] == 5
    assert values["extraction_summary", "success_rate_percent"] == 75
    assert values["data_summary", "average_file_size_bytes"] == round(sum(sizes) / 4, 2)
    assert values["timing", "duration_seconds"] == run.duration_seconds


def test_an_empty_run(spark, tmp_path):
    found = spark.createDataFrame([], "path string, file string, length long, content binary")
    run = runs.measured_run(found, str(tmp_path / "none"))
    assert (run.total_files_found, run.files_failed, run.total_files_processed, run.total_bytes_processed) == (0, 0, 0, 0)


def test_counting_results_need_no_hash_or_context(spark):
    pages = spark.createDataFrame([("a", PAGE.format("CKV_AWS_1", "LOW"))], "path string, content string")
    light = process_documents(pages, validate=False, contexts=False, hashes=False)
    whole = process_documents(pages, validate=False)
    same = ["path", "checkov_id", "severity", "confidence"]
    assert light.select(same).collect() == whole.select(same).collect()
    assert light.select(F.get("matches", F.lit(0))["context"]).first()[0] is None
    assert "sha2" not in statistics.provider_counts(light)._jdf.queryExecution().optimizedPlan().toString()
