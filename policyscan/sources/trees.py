"""Folder trees of any size, listed and read on the executors.

Spark's own file sources keep the list of all files on the driver.  Here folders are rows:
a task lists the folders of its rows, what it finds is written as a table, and the folders
among that are the rows of the next level.  The driver sees one number per level.  Unlike
Spark's listing it finds names starting with "." or "_" and empty files, does not descend
into ignored folders, and records what cannot be listed or read instead of failing or
skipping it.

Defined results
    missing root: FileNotFoundError; a folder or file that vanishes later: no row, or no content
    folder that cannot be listed: a row with ``error`` and no length, counted as unreadable
    file that cannot be read: null content and an ``error``
    links to folders: followed, unless they lead back to a folder they lie in
    empty tree: no rows
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policyscan.session import stage
from policyscan.sources import files

FOLDERS_PER_TASK = 32
FILES_PER_TASK = 2_000
BYTES_PER_TASK = 128 << 20
MAX_TASKS = 20_000
CHUNK_ROWS = 10_000
CHUNK_BYTES = 16 << 20

# A file system and the root's path in it, made anew in every task.
Connect = Callable[[], tuple[fs.FileSystem, str]]

_FOUND = "path string, is_folder boolean, modificationTime timestamp, length long, error string"


def _tasks(rows: int, per_task: int) -> int:
    return max(1, min(MAX_TASKS, -(-rows // per_task)))


def _leads_back(path: str) -> bool:
    """A local link to a folder that it lies in."""
    return os.path.islink(path) and f"{os.path.realpath(os.path.dirname(path))}/".startswith(f"{os.path.realpath(path)}/")


def _list_folder(system: fs.FileSystem, root: str, folder: str) -> Iterator[tuple]:
    """Entries of a folder as rows of ``_FOUND``."""
    local = isinstance(system, fs.LocalFileSystem)
    full = f"{root}/{folder}" if folder else root
    try:
        entries = system.get_file_info(fs.FileSelector(full, recursive=False, allow_not_found=True))
    except OSError as failure:
        yield folder, False, None, None, str(failure)
        return
    for entry in entries:
        path = f"{folder}/{entry.base_name}" if folder else entry.base_name
        if entry.type == fs.FileType.Directory:
            if not (local and _leads_back(entry.path)):
                yield path, True, None, None, None
        elif entry.type == fs.FileType.File:
            yield path, False, pd.Timestamp(entry.mtime).tz_convert("UTC").floor("ms"), entry.size, None


def _lister(connect: Connect) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = [field.split()[0] for field in _FOUND.split(", ")]

    def frame(rows: list[tuple]) -> pd.DataFrame:
        made = pd.DataFrame(rows, columns=names)
        made["modificationTime"] = pd.to_datetime(made["modificationTime"], utc=True)
        return made.astype({"length": "Int64"})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = connect()
        rows = []
        for folders in frames:
            for folder in folders["path"]:
                for row in _list_folder(system, root, folder):
                    rows.append(row)
                    if len(rows) == CHUNK_ROWS:
                        yield frame(rows)
                        rows = []
        if rows:
            yield frame(rows)

    return run


def _by_uri(root: str) -> Connect:
    return lambda: fs.FileSystem.from_uri(root)


def list_tree(
    spark: SparkSession,
    root: str,
    ignore: list[str] | None = None,
    max_depth: int | None = None,
    hidden: bool = True,
    connect: Connect | None = None,
) -> DataFrame:
    """Files below ``root``: path (relative), root, file (absolute), modificationTime, length, error.

    Folders that fit an ``ignore`` glob or lie below ``max_depth`` are not listed, nor are
    names starting with "." or "_" unless ``hidden``.  ``connect`` replaces the file system
    that the root's address names.
    """
    connect = connect or _by_uri(root)
    run = _lister(connect)
    if files._missing(spark, root):
        raise FileNotFoundError(root)
    levels, n_folders = [], 1
    folders = spark.createDataFrame([("",)], "path string")
    while n_folders:
        dealt = folders.repartition(_tasks(n_folders, FOLDERS_PER_TASK))
        found = dealt.mapInPandas(run, _FOUND)
        listed = F.col("error").isNotNull() | ~files.is_ignored(ignore if ignore is not None else ["/"])
        if not hidden:
            listed = listed & ~F.rlike("path", F.lit(r"(\A|/)[._][^/]*\z"))
        levels.append(stage(found.filter(listed), "tree-level"))
        folders = levels[-1].filter("is_folder").select("path")
        n_folders = 0 if max_depth is not None and len(levels) > max_depth else folders.count()
    place = F.lit(files._absolute(spark, root) + "/")
    return (
        reduce(DataFrame.unionByName, levels)
        .filter("NOT is_folder")
        .select("path", F.lit(root).alias("root"), F.concat(place, "path").alias("file"), "modificationTime", "length", "error")
    )


def read_tree(listed: DataFrame, root: str, connect: Connect | None = None) -> DataFrame:
    """The listed files with ``content``; null, with an ``error``, where a file cannot be read.

    ``listed`` comes from ``list_tree``, filtered as wanted.  Files are dealt to tasks by
    number and bytes and handed on in batches of bounded size (or one larger file).
    """
    connect = connect or _by_uri(root)
    columns = ["path", "root", "file", "modificationTime", "length", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, base = connect()
        for frame in frames:
            at, held, contents, errors = 0, 0, [], []
            for k, (path, known) in enumerate(zip(frame["path"], frame["error"], strict=True)):
                content, error = None, known
                if error is None:
                    try:
                        with system.open_input_stream(f"{base}/{path}") as stream:
                            content = stream.readall()
                    except OSError as failure:
                        error = str(failure)
                contents.append(content)
                errors.append(error)
                held += len(content or b"")
                if held >= CHUNK_BYTES or k == len(frame) - 1:
                    yield frame.iloc[at : k + 1].assign(error=errors, content=contents)
                    at, held, contents, errors = k + 1, 0, [], []

    total = listed.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    tasks = max(_tasks(total[0], FILES_PER_TASK), _tasks(total[1], BYTES_PER_TASK))
    schema = "path string, root string, file string, modificationTime timestamp, length long, error string, content binary"
    return listed.select(*columns).repartition(tasks).mapInPandas(run, schema)


def unreadable(read: DataFrame) -> DataFrame:
    """(path, error) of folders that were not listed and files that were not read."""
    return read.filter("error IS NOT NULL").select("path", "error")
