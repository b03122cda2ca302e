"""Finding and reading page files.

The manifest is Spark's ``binaryFile`` table (path, length, modificationTime,
content).  The rules work on any table with those columns.  Rules that need no
content do not read it.  Spark's own listing skips names starting with "." or "_".
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.frames import compute_once
from policyscan.functions.paths import (
    any_glob_regex,
    depth,
    path_key,
    relative_to,
    suffix,
)
from policyscan.functions.text import (
    collapse_blank_lines,
    has_blank_run,
    has_bom,
    has_carriage_return,
    newlines,
    nfkc,
    rstrip_lines,
    strip_bom,
)


def manifest(
    spark: SparkSession,
    root: str,
    recursive: bool = True,
    extensions: list[str] | None = None,
    max_mb: float | None = None,
) -> DataFrame:
    """Files below a folder: path (relative to it), root, file (absolute), length, time, content.

    Nothing is left out unless asked for: the extensions become a file-name glob and the
    size a pushed filter, so files that do not qualify are never opened.  Files that
    vanish or cannot be read after the listing are missing from what is read; compare with
    ``listing`` to count them.
    """
    reader = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("ignoreMissingFiles", "true")
        .option("ignoreCorruptFiles", "true")
    )
    if extensions:
        reader = reader.option("pathGlobFilter", _extension_glob(extensions))
    files = reader.load(root)
    if max_mb is not None:
        files = files.filter(F.col("length") <= max_bytes(max_mb))
    return _manifest_columns(files, root)


MAX_PATHS = 50_000


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in path)


def read_listed(spark: SparkSession, root: str, chosen: DataFrame, whole: DataFrame) -> DataFrame:
    """The files of ``chosen`` (file) below ``root``; no other file is opened.

    ``whole`` is the manifest of the folder.  Up to ``MAX_PATHS`` files are named to the
    reader; of more, the whole folder is read and the chosen ones are kept.
    """
    names = [r["file"] for r in chosen.select("file").limit(MAX_PATHS + 1).collect()]
    if not names:
        return whole.limit(0)
    if len(names) > MAX_PATHS:
        return whole.join(chosen.select("file"), "file", "left_semi")
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    found = reader.load([_literal(n) for n in names])
    return _manifest_columns(found, root)


def _manifest_columns(found: DataFrame, root: str) -> DataFrame:
    return found.select(
        relative_to(F.col("path"), root).alias("path"),
        F.lit(root).alias("root"),
        F.col("path").alias("file"),
        "modificationTime",
        "length",
        "content",
    )


def listing(files: DataFrame) -> DataFrame:
    """The files without their contents, which are then not opened."""
    return files.drop("content")


def _extension_glob(extensions: list[str]) -> str:
    def letter(c: str) -> str:
        return f"[{c.lower()}{c.upper()}]" if c.isalpha() else c

    return "*{" + ",".join("".join(map(letter, e)) for e in extensions) + "}"


def manifests(spark: SparkSession, roots: list[str], recursive: bool = True, **options) -> DataFrame:
    """Several folders together; a file reached through two of them is listed once.

    The first folder that reaches a file lists it, decided by absolute paths, so no
    content is shuffled.  Folders that cannot be listed are left to ``root_errors``.
    """
    parts, earlier = [], []
    for root in dict.fromkeys(r.rstrip("/") or "/" for r in roots):
        if _missing(spark, root):
            continue
        part = manifest(spark, root, recursive=recursive, **options)
        folder = _absolute(spark, root)
        if folder in earlier:
            continue
        for other in earlier if recursive else ():
            part = part.filter(~F.startswith(F.col("file"), F.lit(other + "/")))
        earlier.append(folder)
        parts.append(part)
    if not parts:
        raise FileNotFoundError(f"no folder to list among {roots}")
    return reduce(DataFrame.unionByName, parts)


def root_errors(spark: SparkSession, roots: list[str]) -> DataFrame:
    """(root, error) of the folders that cannot be listed."""
    rows = [(root, "No such file or directory") for root in dict.fromkeys(roots) if _missing(spark, root)]
    return spark.createDataFrame(rows, "root string, error string")


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _missing(spark: SparkSession, root: str) -> bool:
    path, system = _file_system(spark, root)
    return not system.exists(path)


def _absolute(spark: SparkSession, root: str) -> str:
    path, system = _file_system(spark, root)
    return system.makeQualified(path).toString().rstrip("/")


def union_files(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["path"])


def max_bytes(megabytes: float) -> int:
    return int(megabytes * 1024 * 1024)


# --- rules, as boolean columns over the relative path and the length ---------


def is_ignored(globs: list[str] | None = None) -> Column:
    """Any component of the path fits a glob (a folder takes its files along)."""
    regex = any_glob_regex(globs or fixed.SCANNER_IGNORE)
    return F.exists(path_key(F.col("path")), lambda part: F.rlike(part, F.lit(regex)))


def has_extension(extensions: list[str] | None = None) -> Column:
    return F.lower(suffix(F.col("path"))).isin(extensions or fixed.SCANNER_EXTENSIONS)


def within_size(megabytes: float = fixed.SCANNER_MAX_MB) -> Column:
    return F.col("length") <= max_bytes(megabytes)


def within_depth(limit: int | None = None) -> Column:
    return F.lit(True) if limit is None else depth(F.col("path")) <= limit


def is_readable() -> Column:
    return F.col("content").isNotNull()


def scan(
    files: DataFrame,
    extensions: list[str] | None = None,
    ignore: list[str] | None = None,
    max_mb: float = fixed.SCANNER_MAX_MB,
    max_depth: int | None = None,
    recursive: bool = True,
) -> DataFrame:
    """The files that pass every rule."""
    return files.filter(
        ~is_ignored(ignore)
        & within_depth(max_depth if recursive else 0)
        & has_extension(extensions)
        & within_size(max_mb)
    )


def scan_counts(
    files: DataFrame,
    extensions: list[str] | None = None,
    ignore: list[str] | None = None,
    max_mb: float = fixed.SCANNER_MAX_MB,
    max_depth: int | None = None,
) -> DataFrame:
    """One row: files found, seen (not ignored) and filtered out.

    ``files`` may be a listing; files below a depth limit count as not seen.
    """
    seen = files.filter(~is_ignored(ignore) & within_depth(max_depth))
    kept = has_extension(extensions) & within_size(max_mb)
    if "content" in files.columns:
        kept = kept & is_readable()
    return seen.agg(
        F.count_if(kept).alias("files_found"),
        F.count("*").alias("total_scanned"),
        F.count_if(~kept).alias("filtered_out"),
    )


def in_path_order(files: DataFrame) -> DataFrame:
    return files.orderBy(path_key(F.col("path")))


# --- decoding -----------------------------------------------------------------

def _utf8(content: Column) -> Column:
    """Text of valid UTF-8 bytes, else NULL."""
    return F.try_validate_utf8(content.cast("string"))


_OTHER, _UTF8, _UTF8_RETURNS = range(3)


def _judged_udf():
    # Nested so that workers get it by value and need no installed package.
    other, plain, returns = _OTHER, _UTF8, _UTF8_RETURNS

    @F.arrow_udf("int")
    def judged(contents: pa.Array) -> pa.Array:
        def kind(value: bytes | None) -> int:
            try:
                fits = value is not None and (value.isascii() or value.decode("utf-8") is not None)
            except UnicodeDecodeError:
                fits = False
            return (returns if b"\r" in value else plain) if fits else other

        return pa.array([kind(v) for v in contents.cast(pa.binary()).to_pylist()], pa.int32())

    return judged


def decode_utf8_or_latin1(content: Column) -> Column:
    """UTF-8, or Latin-1 when the bytes are not UTF-8; newlines become ``\\n``.

    The bytes are judged in batches, and carriage returns sought there: Spark's own checks
    take several times longer a byte.
    """
    kind, text = _judged_udf()(content), content.cast("string")
    return (
        F.when(kind == _UTF8, text)
        .when(kind == _UTF8_RETURNS, newlines(text))
        .otherwise(newlines(F.decode(content, "ISO-8859-1")))
    )


# One byte is one character here; possessive, so the match neither branches nor recurses.
_UTF16 = {
    True: r"\A(?s:[^\xd8-\xdf].|[\xd8-\xdb].[\xdc-\xdf].)*+\z",
    False: r"\A(?s:.[^\xd8-\xdf]|.[\xd8-\xdb].[\xdc-\xdf])*+\z",
}


def _is_utf16(content: Column, big_endian: bool) -> Column:
    """Whole code units, and every high surrogate stands right before a low one."""
    return F.rlike(F.decode(content, "ISO-8859-1"), F.lit(_UTF16[big_endian]))


def _decode_or_null(content: Column, encoding: Column) -> Column:
    """Decode by a declared encoding; NULL when the bytes do not fit it."""
    code = F.hex(content)

    def utf16(big_endian: bool, skip: int = 1) -> Column:
        body = F.substr(content, F.lit(skip))
        charset = "UTF-16BE" if big_endian else "UTF-16LE"
        return F.when(_is_utf16(body, big_endian), F.decode(body, charset))

    ascii_only = ~F.rlike(F.decode(content, "ISO-8859-1"), F.lit(r"[^\x00-\x7f]"))
    return (
        F.when(encoding.isin("utf-8", "utf8"), _utf8(content))
        .when(encoding == "utf-8-sig", strip_bom(_utf8(content)))
        .when(encoding == "ascii", F.when(ascii_only, _utf8(content)))
        .when(encoding.isin("iso-8859-1", "latin-1"), F.decode(content, "ISO-8859-1"))
        .when(
            encoding == "utf-16",
            F.when(F.startswith(code, F.lit("FEFF")), utf16(big_endian=True, skip=3))
            .when(F.startswith(code, F.lit("FFFE")), utf16(big_endian=False, skip=3))
            .otherwise(utf16(big_endian=False)),
        )
        .when(encoding == "utf-16le", utf16(big_endian=False))
        .when(encoding == "utf-16be", utf16(big_endian=True))
    )


def decode_declared(content: Column, encoding: Column, fallback: str = "utf-8") -> Column:
    """Declared encoding, then the fallback, then the fallback with replacements.

    Bytes that fit neither encoding are replaced only when the declared encoding is
    the fallback itself; otherwise the file cannot be read and the text is NULL.
    """
    name = F.lower(encoding)
    replaced = (
        F.make_valid_utf8(content.cast("string"))
        if fallback == "utf-8"
        else F.lit(None).cast("string")
    )
    return newlines(
        F.coalesce(
            _decode_or_null(content, name),
            F.when(name != fallback, _decode_or_null(content, F.lit(fallback))),
            F.when(name == fallback, replaced),
        )
    )


def choose_encoding(content: Column, fallback: str = "utf-8") -> Column:
    """Encoding to read a file with: byte-order mark, then what the bytes allow."""
    code = F.hex(F.substring(content, 1, 3))
    return (
        F.when(F.octet_length(content) == 0, fallback)
        .when(code == "EFBBBF", "utf-8-sig")
        .when(F.startswith(code, F.lit("FFFE")) | F.startswith(code, F.lit("FEFF")), "utf-16")
        .when(~F.rlike(F.decode(content, "ISO-8859-1"), F.lit(r"[^\x00-\x7f]")), "ascii")
        .when(_utf8(content).isNotNull(), "utf-8")
        .otherwise(fallback)
    )


def read_documents(files: DataFrame) -> DataFrame:
    """documents(path, content, file_size) of the readable files."""
    readable = files.filter(is_readable()).select(
        "path", "content", F.col("length").alias("file_size")
    )
    return compute_once(readable, content=decode_utf8_or_latin1(F.col("content")))


def read_with_report(
    files: DataFrame, fallback: str = "utf-8", preprocess: bool = True
) -> DataFrame:
    """read_docs(path, content, encoding, file_size, preprocessing_applied)."""
    chosen = files.filter(is_readable()).withColumn(
        "encoding", choose_encoding(F.col("content"), fallback)
    )
    texts = chosen.select(
        "path",
        decode_declared(F.col("content"), F.col("encoding"), fallback).alias("content"),
        "encoding",
        F.col("length").alias("file_size"),
    )
    if preprocess:
        return preprocess_texts(texts)
    return texts.withColumn("preprocessing_applied", F.array().cast("array<string>"))


def read_failures(listed: DataFrame, files: DataFrame) -> DataFrame:
    """Paths of ``listed`` (a stored listing) that reading ``files`` does not bring."""
    return listed.select("file").join(files.filter(is_readable()).select("file"), "file", "left_anti")


def batch_counts(files: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Files asked for, read and failed; against a stored listing, vanished files count too."""
    if listed is not None:
        read = files.filter(is_readable()).select(F.col("file").alias("read"))
        both = listed.select("file").join(read, F.col("file") == F.col("read"), "left")
        return both.agg(
            F.count("*").alias("total_files"),
            F.count("read").alias("successful"),
            F.count_if(F.col("read").isNull()).alias("failed"),
        )
    return files.agg(
        F.count("*").alias("total_files"),
        F.count_if(is_readable()).alias("successful"),
        F.count_if(~is_readable()).alias("failed"),
    )


def preprocess_texts(texts: DataFrame) -> DataFrame:
    """Clean ``content`` and record what was changed in ``preprocessing_applied``.

    In order: newlines, trailing whitespace, blank runs, NFKC, byte-order mark.
    """
    text = F.col("content")
    stripped = compute_once(
        texts, tag_newlines=has_carriage_return(text), content=rstrip_lines(newlines(text))
    )
    collapsed = compute_once(
        stripped, tag_blank=has_blank_run(text), content=collapse_blank_lines(text)
    )
    normalized = collapsed.withColumn("normalized", nfkc(text))
    tags = F.array(
        F.when(F.col("tag_newlines"), fixed.TAG_NEWLINES),
        F.when(F.col("tag_blank"), fixed.TAG_BLANK_LINES),
        F.when(F.col("normalized") != text, fixed.TAG_UNICODE),
        F.when(has_bom(F.col("normalized")), fixed.TAG_BOM),
    )
    tagged = compute_once(
        normalized,
        preprocessing_applied=F.array_compact(tags),
        content=strip_bom(F.col("normalized")),
    )
    return tagged.drop("tag_newlines", "tag_blank", "normalized")
