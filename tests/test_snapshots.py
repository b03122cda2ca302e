"""The snapshot store against full runs, under random edits of a folder and dying runs."""

import os
import random

import pytest

from policyscan import fixed
from policyscan.operators import database as db
from policyscan.operators.documents import process_documents, result_mappings
from policyscan.sources import files
from policyscan.streaming import snapshots

PAGE = "== T\n\n|Checkov ID\n|https://example.test/a.py[{}]\n\n|Severity\n|{}\n"


def put(folder, name, rule, level, stamp):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(PAGE.format(f"CKV_AWS_{rule}", level))
    os.utime(path, (stamp, stamp))


def full(spark, folder):
    chosen = files.scan(files.manifest(spark, str(folder)), [".adoc"], fixed.PIPELINE_IGNORE, 10)
    return result_mappings(process_documents(files.read_documents(chosen))).toPandas()


def agree(spark, store, folder):
    found = spark.createDataFrame(full(spark, folder), "path string, checkov_id string, severity string")
    expected = db.resolved(found).select(*snapshots.STATE)
    assert sorted(map(str, store.resolved().collect())) == sorted(map(str, expected.collect()))
    assert {r.path for r in store.results().collect()} == {
        r.path for r in files.scan(files.listing(files.manifest(spark, str(folder))), [".adoc"], fixed.PIPELINE_IGNORE, 10).collect()
    }


def test_random_changes_equal_full_runs(spark, tmp_path):
    rng = random.Random(5)
    folder, clock = tmp_path / "pages", 1_700_000_000
    names = [f"{d}/p{i}.adoc" for d in "abc" for i in range(7)] + ["odd [x]*.adoc", "index.adoc"]
    for name in names[:15]:
        put(folder, name, rng.randrange(6), rng.choice(fixed.SEVERITIES), clock)
    store = snapshots.Store(spark, str(tmp_path / "store"), buckets=8, columns=["path", "checkov_id", "severity"])
    assert store.update_folder(str(folder)).new == 15
    agree(spark, store, folder)
    for step in range(3):
        clock += 60
        chosen = rng.sample(names, 5)
        for name in chosen:
            if (folder / name).exists() and rng.random() < 0.4:
                (folder / name).unlink()
            else:
                put(folder, name, rng.randrange(6), rng.choice(fixed.SEVERITIES), clock)
        run = snapshots.Store(spark, str(tmp_path / "store"), columns=["path", "checkov_id", "severity"]).update_folder(str(folder))
        assert run.number == step + 1 and run.new + run.edited + run.removed <= 5
        agree(spark, store, folder)
    quiet = store.update_folder(str(folder))
    assert (quiet.new, quiet.edited, quiet.removed, quiet.identifiers) == (0, 0, 0, 0)


def test_only_changed_files_are_read(spark, tmp_path):
    folder, stamp = tmp_path / "pages", 1_700_000_000
    for i in range(6):
        put(folder, f"p{i}.adoc", i, "HIGH", stamp)
    read = []

    def process(documents):
        rows = documents.cache()
        read.append(sorted(r.path for r in rows.collect()))
        return process_documents(rows)

    store = snapshots.Store(spark, str(tmp_path / "store"), process, buckets=4)
    store.update_folder(str(folder))
    # A file altered behind the listing's back (same size, same time) must not be noticed.
    put(folder, "p1.adoc", 7, "HIGH", stamp)
    put(folder, "p2.adoc", 8, "LOW", stamp + 5)
    put(folder, "q [1].adoc", 9, "LOW", stamp)
    (folder / "p3.adoc").unlink()
    run = store.update_folder(str(folder))
    assert (run.new, run.edited, run.removed) == (1, 1, 1)
    assert read[1] == ["p2.adoc", "q [1].adoc"]
    assert {tuple(r) for r in store.mappings().collect()} == {
        ("CKV_AWS_0", "HIGH"), ("CKV_AWS_1", "HIGH"), ("CKV_AWS_4", "HIGH"), ("CKV_AWS_5", "HIGH"),
        ("CKV_AWS_8", "LOW"), ("CKV_AWS_9", "LOW"),
    }


def test_more_changes_than_are_named(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MAX_PATHS", 2)
    folder = tmp_path / "pages"
    for i in range(5):
        put(folder, f"p{i}.adoc", i, "LOW", 1_700_000_000)
    store = snapshots.Store(spark, str(tmp_path / "store"), buckets=4)
    store.update_folder(str(folder))
    assert store.mappings().count() == 5


@pytest.mark.parametrize("after", ["found", "results"])
def test_a_run_that_dies_is_repeated(spark, tmp_path, monkeypatch, after):
    """Also where the folder changes once more, back to what the snapshot holds."""
    folder, stamp = tmp_path / "pages", 1_700_000_000
    for i in range(6):
        put(folder, f"p{i}.adoc", i % 4, "HIGH", stamp)
    store = snapshots.Store(spark, str(tmp_path / "store"), buckets=4, columns=["path", "checkov_id", "severity"])
    store.update_folder(str(folder))
    put(folder, "p0.adoc", 50, "LOW", stamp + 9)
    put(folder, "a.adoc", 1, "INFO", stamp + 9)
    (folder / "p5.adoc").unlink()
    write = snapshots.Store._write

    def dying(self, rows, name, *rest, **more):
        write(self, rows, name, *rest, **more)
        if name == after:
            raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(snapshots.Store, "_write", dying)
        with pytest.raises(RuntimeError):
            store.update_folder(str(folder))
    (folder / "a.adoc").unlink()
    put(folder, "p0.adoc", 0, "HIGH", stamp)
    store.update_folder(str(folder))
    agree(spark, store, folder)


def test_an_emptied_folder(spark, tmp_path):
    folder = tmp_path / "pages"
    put(folder, "p.adoc", 1, "LOW", 1_700_000_000)
    (folder / "keep.txt").write_text("x")
    store = snapshots.Store(spark, str(tmp_path / "store"), buckets=4)
    store.update_folder(str(folder))
    (folder / "p.adoc").unlink()
    assert store.update_folder(str(folder)).removed == 1
    assert store.mappings().count() == 0 and store.results().count() == 0
