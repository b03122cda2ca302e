"""The file pipeline on real files: scan, read, write, and the streaming refresh."""

import json

from pyspark.sql import functions as F

from policyscan.operators import database as db
from policyscan.operators.documents import process_documents, result_mappings
from policyscan.session import stage
from policyscan.sinks import documents as sinks
from policyscan.sources import files
from policyscan.sources.database_json import (
    compact_mappings,
    compact_metadata,
    read_compact,
    read_compact_lines,
)
from policyscan.streaming.refresh import (
    changed_documents,
    latest_results,
    refresh,
    refreshed_mappings,
    start_refresh,
    text_hashes,
)

PAGE = "== T\n\n|Checkov ID\n|https://example.test/a.py[{}]\n\n|Severity\n|{}\n"


def make_tree(root):
    for folder in ("x/index", ".h"):
        (root / folder).mkdir(parents=True)
    (root / "x/a.adoc").write_bytes(PAGE.format("CKV_AWS_1", "HIGH").replace("\n", "\r\n").encode())
    (root / "x/B.ADOC").write_bytes(PAGE.format("CKV_AWS_2", "LOW").encode() + b"\xe9")
    (root / "x/index/c.adoc").write_text(PAGE.format("CKV_AWS_3", "LOW"))
    (root / ".h/h.adoc").write_text(PAGE.format("CKV_AWS_4", "LOW"))
    (root / "x/n.txt").write_text("no page")


def test_scan_read_and_process(spark, tmp_path):
    make_tree(tmp_path)
    listed = files.manifest(spark, str(tmp_path), extensions=[".adoc"])
    kept = files.scan(listed, [".adoc"], ["*index*"], 10)
    assert [r.path for r in files.in_path_order(kept).select("path").collect()] == ["x/B.ADOC", "x/a.adoc"]
    done = process_documents(files.read_documents(kept))
    assert {tuple(r)[1:] for r in result_mappings(done).collect()} == {
        ("CKV_AWS_1", "HIGH"),
        ("CKV_AWS_2", "LOW"),
    }
    twice = files.manifests(spark, [str(tmp_path), str(tmp_path)], extensions=[".adoc"])
    assert twice.count() == 3


def test_roots_that_share_names_and_missing_roots(spark, tmp_path):
    for name, level in (("A", "HIGH"), ("B", "LOW")):
        (tmp_path / name / "in").mkdir(parents=True)
        (tmp_path / name / "in/p.adoc").write_text(PAGE.format("CKV_AWS_1", level))
    (tmp_path / "A/big.adoc").write_bytes(b"x" * (11 << 20))
    (tmp_path / "A/n.txt").write_text("no page")
    roots = [str(tmp_path / n) for n in ("A", "B", "A/in", "gone")]
    listed = files.manifests(spark, roots)
    assert listed.count() == 4
    assert listed.select("path", "root").distinct().count() == 4
    assert [r.root for r in files.root_errors(spark, roots).collect()] == [roots[3]]
    counts = files.scan_counts(files.listing(listed), [".adoc"], ["*index*"], 10).collect()[0]
    assert tuple(counts) == (2, 4, 2)
    assert {r.path for r in files.scan(listed, [".adoc"], ["*index*"]).select("path").collect()} == {"in/p.adoc", "big.adoc"}


def test_vanished_files_are_counted(spark, tmp_path):
    make_tree(tmp_path)
    found = files.manifest(spark, str(tmp_path), extensions=[".adoc"])
    listed = spark.createDataFrame(files.listing(found).collect())
    (tmp_path / "x/a.adoc").unlink()
    assert tuple(files.batch_counts(found, listed).collect()[0]) == (3, 2, 1)
    assert [r.file.rsplit("/", 1)[1] for r in files.read_failures(listed, found).collect()] == ["a.adoc"]
    assert process_documents(files.read_documents(found)).count() == 2


def test_size_filter_reaches_the_scan(spark, tmp_path):
    make_tree(tmp_path)
    plan = files.manifest(spark, str(tmp_path), max_mb=10)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(length), LessThanOrEqual(length" in plan


def test_documents_are_valid_json(spark, tmp_path):
    found = spark.createDataFrame(
        [("a", "CKV_X_1", "HIGH"), ("b", "CKV_X_2", "LOW"), ("c", "CKV_X_2", "HIGH")],
        "path string, checkov_id string, severity string",
    )
    mappings, metadata = db.first_wins(found), db.assemble(found)

    def written(lines, name):
        sinks.write_document(lines, str(tmp_path / name))
        parts = sorted((tmp_path / name).glob("part-*"))
        return "".join(p.read_text() for p in parts)

    full = json.loads(written(sinks.database_document(mappings, metadata, "2024-01-01T00:00:00Z", "2024-01-01T00:00:00"), "full"))
    assert full["mappings"] == {"CKV_X_1": "HIGH", "CKV_X_2": "LOW"}
    assert full["metadata"]["total_mappings"] == 2
    assert full["metadata"]["timestamp"] == "2024-01-01T00:00:00Z"
    compact_text = written(sinks.compact_document(mappings, metadata, "2024-01-01T00:00:00"), "compact")
    compact = json.loads(compact_text)
    assert compact["c"] == 2 and compact["s"] == full["mappings"]
    size = sinks.compact_size(mappings, "2024-01-01T00:00:00").collect()[0][0]
    assert size == len(json.dumps(compact, separators=(",", ":")))

    (tmp_path / "one.json").write_text(json.dumps(compact))
    parsed = read_compact(spark, str(tmp_path / "one.json"))
    assert compact_metadata(parsed).collect()[0].total_mappings == 2
    assert {(r.checkov_id, r.severity) for r in compact_mappings(parsed).collect()} == set(full["mappings"].items())


def test_compact_database_reads_back_from_parts(spark, tmp_path):
    ids = spark.range(3000).selectExpr("concat('CKV_X_', id) AS checkov_id", "IF(id % 2 = 0, 'LOW', 'HIGH') AS severity")
    metadata = db.assemble(ids.withColumn("path", F.col("checkov_id")))
    sinks.write_document(sinks.compact_document(ids, metadata, "2024-01-01T00:00:00"), str(tmp_path / "db"))
    back = read_compact_lines(spark, str(tmp_path / "db"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ids.collect()))
    (tmp_path / "broken.json").write_text('{"v": "1.0", "s": {')
    assert read_compact(spark, str(tmp_path / "broken.json")).collect()[0].error


def test_streaming_refresh_resolves_late_files(spark, tmp_path):
    pages, log, checkpoint = tmp_path / "pages", tmp_path / "log", tmp_path / "checkpoint"
    pages.mkdir()
    (pages / "m.adoc").write_text(PAGE.format("CKV_AWS_1", "HIGH"))

    def run():
        start_refresh(spark, str(pages), str(log), str(checkpoint)).awaitTermination(60)
        results = latest_results(spark.read.parquet(str(log)))
        return {tuple(r) for r in db.first_wins(result_mappings(results)).collect()}

    assert run() == {("CKV_AWS_1", "HIGH")}
    (pages / "Z.ADOC").write_text(PAGE.format("CKV_AWS_1", "LOW"))
    (pages / "index.adoc").write_text(PAGE.format("CKV_AWS_9", "LOW"))
    assert run() == {("CKV_AWS_1", "LOW")}  # Z sorts before m
    (pages / "Z.ADOC").unlink()
    (pages / "a.adoc").write_text(PAGE.format("CKV_AWS_1", "LOW"))
    assert run() == {("CKV_AWS_1", "LOW")}
    assert spark.read.parquet(str(log)).filter("path = 'm.adoc'").count() == 1


def test_refresh_equals_a_full_run(spark, tmp_path):
    for name, rule in (("a", 1), ("b", 2), ("c", 3)):
        (tmp_path / f"{name}.adoc").write_text(PAGE.format(f"CKV_AWS_{rule}", "HIGH"))

    def now():
        return files.read_documents(files.manifest(spark, str(tmp_path)))

    first = stage(process_documents(now()).join(text_hashes(now()), "path"), "first-run")
    (tmp_path / "a.adoc").write_text(PAGE.format("CKV_AWS_1", "LOW"))
    (tmp_path / "b.adoc").unlink()
    (tmp_path / "d.adoc").write_text(PAGE.format("CKV_AWS_4", "INFO"))
    assert {r.path for r in changed_documents(now(), first).collect()} == {"a.adoc", "d.adoc"}
    fresh = {tuple(r) for r in refreshed_mappings(now(), first).collect()}
    assert fresh == {tuple(r) for r in db.first_wins(result_mappings(process_documents(now()))).collect()}
    kept = refresh(now(), first, keep_missing=True)
    assert {r.path for r in kept.collect()} == {"a.adoc", "b.adoc", "c.adoc", "d.adoc"}
