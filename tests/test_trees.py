"""Trees listed level by level on the executors, against Spark's own listing and the file system."""

import os
from pathlib import Path

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from policyscan.sources import files, trees


def grow(root: Path) -> None:
    for k in range(60):
        folder = root / f"d{k % 7}" / f"e {k % 5}" / ("f[x]*" if k % 2 else "ü")
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"p{k}.adoc").write_bytes(b"x" * k)
    (root / "top.adoc").write_text("Checkov severity\n")
    (root / "node_modules/deep/deeper").mkdir(parents=True)
    (root / "node_modules/deep/deeper/n.adoc").write_text("n")
    (root / ".hidden/in").mkdir(parents=True)
    (root / ".hidden/in/h.adoc").write_text("h")
    (root / "d1/_part.adoc").write_text("u")
    (root / "empty").mkdir()


def on_disk(root: Path) -> set[str]:
    return {str(p.relative_to(root)) for p in root.rglob("*") if p.is_file()}


def paths(frame) -> set[str]:
    rows = [r.path for r in frame.select("path").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_same_listing_as_spark(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trees, "FOLDERS_PER_TASK", 3)
    monkeypatch.setattr(trees, "CHUNK_ROWS", 2)
    grow(tmp_path)
    # Spark skips files without a byte.
    own = trees.list_tree(spark, str(tmp_path), hidden=False).filter("length > 0 AND error IS NULL")
    theirs = files.listing(files.manifest(spark, str(tmp_path)))
    columns = ["path", "root", "file", "modificationTime", "length"]
    assert sorted(own.select(*columns).collect()) == sorted(theirs.select(*columns).collect())
    assert paths(trees.list_tree(spark, str(tmp_path))) == on_disk(tmp_path)


def test_rules_prune_folders(spark, tmp_path):
    root = tmp_path
    grow(root)
    place = str(root)
    kept = trees.list_tree(spark, place, ignore=["node_modules", ".*"], connect=lambda: (fs.LocalFileSystem(), place))
    assert paths(kept) == {p for p in on_disk(root) if not p.startswith(("node_modules/", ".hidden/"))}
    assert paths(kept) == paths(trees.list_tree(spark, str(root)).filter(~files.is_ignored(["node_modules", ".*"])))
    for limit in (0, 1, 2):
        shallow = trees.list_tree(spark, str(root), max_depth=limit)
        assert paths(shallow) == {p for p in on_disk(root) if p.count("/") <= limit}


def test_contents_failures_and_links(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(trees, "CHUNK_BYTES", 64)
    grow(tmp_path)
    os.symlink(tmp_path / "d1", tmp_path / "d1/back")
    os.symlink(tmp_path / "d2", tmp_path / "also")
    listed = trees.list_tree(spark, str(tmp_path))
    assert {p for p in paths(listed) if "back" in p} == set()
    assert len({p for p in paths(listed) if p.startswith("also/")}) == len({p for p in paths(listed) if p.startswith("d2/")})
    gone = tmp_path / "top.adoc"
    gone.unlink()
    read = trees.read_tree(listed, str(tmp_path))
    held = {r.path: r.content for r in read.collect()}
    assert held.pop("top.adoc") is None
    assert {p: bytes(c) for p, c in held.items()} == {p: (tmp_path / p).read_bytes() for p in held}
    assert [r.path for r in trees.unreadable(read).collect()] == ["top.adoc"]
    (counts,) = files.batch_counts(read).collect()
    assert (counts.total_files, counts.failed) == (len(held) + 1, 1)
    kept = files.scan(read.filter(F.col("path").startswith("d3")), [".adoc"], ["e 1"], 1)
    assert files.read_documents(kept).count() == len([p for p in held if p.startswith("d3") and "/e 1/" not in p])


def test_empty_and_missing_roots(spark, tmp_path):
    (tmp_path / "none").mkdir()
    listed = trees.list_tree(spark, str(tmp_path / "none"))
    assert listed.collect() == [] and trees.read_tree(listed, str(tmp_path / "none")).collect() == []
    with pytest.raises(FileNotFoundError):
        trees.list_tree(spark, str(tmp_path / "gone"))


class Refusing(fs.FileSystemHandler):
    """Only what the listing asks for; one folder may not be listed."""

    def __init__(self, root):
        self.inner, self.root = fs.LocalFileSystem(), root

    def get_file_info_selector(self, selector):
        if selector.base_dir.endswith("/shut"):
            raise PermissionError("shut")
        return self.inner.get_file_info(selector)

    def _unused(self, *_):
        raise NotImplementedError

    get_type_name = lambda self: "refusing"
    normalize_path = lambda self, path: path
    get_file_info = create_dir = delete_dir = delete_dir_contents = delete_root_dir_contents = _unused
    delete_file = move = copy_file = open_input_stream = open_input_file = open_output_stream = open_append_stream = _unused


def test_a_folder_that_may_not_be_listed(tmp_path):
    (tmp_path / "shut").mkdir()
    system = fs.PyFileSystem(Refusing(str(tmp_path)))
    (row,) = trees._list_folder(system, str(tmp_path), "shut")
    assert row[0] == "shut" and row[1] is False and "shut" in row[4]
    assert [r[:2] for r in trees._list_folder(system, str(tmp_path), "")] == [("shut", True)]
