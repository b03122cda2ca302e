"""JSON output.

Large lists are never gathered into one row: a document is a table of lines (head,
one line per entry, tail) that is sorted and written as text, so its part files
read in order are the JSON document.  ``write_single`` joins them to one file.

Defined results
    entries with equal keys: all stay in a list, ordered by their text; of a mapping's
    repeated identifiers, whose key may occur once, the least severity by code point stays
    null key: sorted as the empty string; a null identifier has no place in a mapping
    no entries: an empty list or mapping
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.operators.quality import count_level
from policyscan.operators.statistics import has_matches, result_statistics

_KEEP_NULLS = {"ignoreNullFields": "false"}


def to_json(value: Column) -> Column:
    return F.to_json(value, _KEEP_NULLS)


def _json_string(text: Column) -> Column:
    """A JSON string literal: the text quoted and escaped."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def document_lines(head: DataFrame, entries: DataFrame, tail: str) -> DataFrame:
    """Lines (section, key, line) of a document.

    ``head`` is one row (line), ``entries`` is (key, line).  One entry, the first, has no
    comma before it; of entries that share the first key, equal lines are told apart by
    number.
    """
    keyed = entries.withColumn("key", F.coalesce("key", F.lit("")))
    first = F.col("key") == keyed.select(F.min("key")).scalar()
    lead = keyed.filter(first).groupBy("key", "line").agg(F.count("*").alias("copies"))
    least = lead.select(F.min("line")).scalar()
    lead = lead.select("key", "line", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    bare = (F.col("copy") == 1) & (F.col("line") == least)
    comma = F.concat(F.lit(","), F.col("line"))
    body = [F.lit(1).alias("section"), "key"]
    return (
        head.select(F.lit(0).alias("section"), F.lit("").alias("key"), "line")
        .unionByName(lead.select(*body, F.when(bare, F.col("line")).otherwise(comma).alias("line")))
        .unionByName(keyed.filter(~first).select(*body, comma.alias("line")))
        .unionByName(head.select(F.lit(2).alias("section"), F.lit("").alias("key"), F.lit(tail).alias("line")))
    )


def write_document(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write lines in order; the part files together are the document."""
    has_comma = F.startswith("line", F.lit(","))
    lines.orderBy("section", "key", has_comma, "line").select("line").write.mode(mode).text(path)


_COPY_BYTES = 1 << 20


def write_single(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a document as one file.

    Tasks write its parts in order into a folder beside ``path``; these are joined by the
    file system itself where it can (HDFS), else streamed through one small buffer, which
    is as serial as the one file asked for.  The file appears at ``path`` whole, by renaming.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r}: a single file is written anew or not at all")
    spark = lines.sparkSession
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    target = hadoop.fs.Path(path)
    system = target.getFileSystem(conf)
    if mode == "errorifexists" and system.exists(target):
        raise AnalysisException(f"{path} exists")
    parts_folder = hadoop.fs.Path(f"{path}.parts-{uuid.uuid4().hex}")
    try:
        write_document(lines, parts_folder.toString())
        written = [s for s in system.listStatus(parts_folder) if s.getPath().getName().startswith("part-")]
        # By number: names are longer, and sort otherwise, from part 100,000 on.
        written.sort(key=lambda s: int(s.getPath().getName().split("-")[1]))
        joined = _joined(spark, system, [s.getPath() for s in written if s.getLen()], parts_folder)
        if mode == "overwrite":
            system.delete(target, False)
        if not system.rename(joined, target):
            raise OSError(f"cannot rename {joined.toString()} to {path}")
    finally:
        system.delete(parts_folder, True)


def _joined(spark, system, parts: list, folder):
    """One file with the bytes of all parts, in their folder."""
    hadoop = spark._jvm.org.apache.hadoop
    if system.getScheme() == "hdfs":
        others = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(parts) - 1)
        for k, part in enumerate(parts[1:]):
            others[k] = part
        if len(parts) > 1:
            system.concat(parts[0], others)
        return parts[0]
    whole = hadoop.fs.Path(folder, "document")
    out = system.create(whole)
    try:
        for part in parts:
            source = system.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(source, out, _COPY_BYTES, False)
            finally:
                source.close()
    finally:
        out.close()
    return whole


def mapping_entries(mappings: DataFrame) -> DataFrame:
    """Lines ``"id":"severity"``, one per identifier."""
    identifier, severity = F.col("checkov_id"), F.col("severity")
    single = mappings.filter(identifier.isNotNull()).groupBy("checkov_id").agg(F.min("severity").alias("severity"))
    level = F.when(severity.isNull(), F.lit("null")).otherwise(_json_string(severity))
    return single.select(
        identifier.alias("key"),
        F.concat(_json_string(identifier), F.lit(":"), level).alias("line"),
    )


def _level_counts() -> Column:
    return F.coalesce(F.to_json("severity_counts"), F.lit("{}"))


def database_document(
    mappings: DataFrame,
    metadata: DataFrame,
    timestamp: str,
    exported_at: str,
    exported_by: str = "policyscan",
) -> DataFrame:
    """Lines of the full database document.

    ``metadata`` is the row made by ``assemble``; ``timestamp`` is an ISO time and is
    written with one ``Z``.
    """
    counts = _level_counts()
    about = to_json(
        F.struct(
            "version",
            F.lit(_zulu(timestamp)).alias("timestamp"),
            "total_mappings",
            "generator_version",
        )
    )
    stats = F.concat(
        F.lit('{"total_mappings":'),
        F.col("stats_total").cast("string"),
        F.lit(',"severity_counts":'),
        counts,
        F.lit("}"),
    )
    metrics = to_json(
        F.struct(
            (F.col("version") != "").alias("has_metadata"),
            F.lit(bool(timestamp)).alias("has_timestamps"),
            F.when(F.col("total_mappings") > 0, 1.0).otherwise(0.0).alias("completeness_score"),
        )
    )
    export = to_json(
        F.struct(
            F.lit(_zulu(exported_at)).alias("exported_at"),
            F.lit(fixed.FORMAT_VERSION).alias("format_version"),
            F.lit(exported_by).alias("exported_by"),
        )
    )
    head = metadata.select(
        F.concat(
            F.lit('{"metadata":'),
            F.substr(about, F.lit(1), F.length(about) - 1),
            F.lit(',"extraction_stats":'),
            stats,
            F.lit('},"export_metadata":'),
            export,
            F.lit(',"statistics":{"total_mappings":'),
            F.col("total_mappings").cast("string"),
            F.lit(',"severity_breakdown":'),
            counts,
            F.lit(',"confidence_metrics":'),
            metrics,
            F.lit('},"mappings":{'),
        ).alias("line")
    )
    return document_lines(head, mapping_entries(mappings), "}}")


def _zulu(timestamp: str) -> str:
    return timestamp.removesuffix("Z").removesuffix("+00:00") + "Z"


def _compact_head(version: Column, timestamp: str, generator_version: Column) -> Column:
    about = to_json(
        F.struct(
            version.alias("v"),
            F.lit(_zulu(timestamp)).alias("t"),
            F.col("total_mappings").alias("c"),
            generator_version.alias("g"),
        )
    )
    return F.concat(F.substr(about, F.lit(1), F.length(about) - 1), F.lit(',"s":{'))


def compact_document(mappings: DataFrame, metadata: DataFrame, timestamp: str) -> DataFrame:
    """Lines of the compact document ``{v, t, c, g, s}``."""
    head = _compact_head(F.col("version"), timestamp, F.col("generator_version"))
    return document_lines(
        metadata.select(head.alias("line")), mapping_entries(mappings), "}}"
    )


def compact_size(
    mappings: DataFrame,
    timestamp: str,
    version: str = fixed.DATABASE_VERSION,
    generator_version: str = fixed.GENERATOR_VERSION,
) -> DataFrame:
    """Bytes of the compact document with non-ASCII characters escaped.

    A distributed sum over the entries plus the envelope; nothing is assembled.
    """
    # An escape takes 6 bytes, and 12 beyond the basic plane (two escapes).
    line = F.col("line")
    wide = F.length(F.regexp_replace(line, r"[^\x{10000}-\x{10ffff}]+", ""))
    foreign = F.length(F.regexp_replace(line, r"[\x00-\x7f]+", ""))
    size = F.length(line) + foreign * 5 + wide * 6
    summed = mapping_entries(mappings).agg(
        F.coalesce(F.sum(size), F.lit(0)).alias("bytes"), F.count("*").alias("total_mappings")
    )
    head = _compact_head(F.lit(version), timestamp, F.lit(generator_version))
    commas = F.greatest(F.col("total_mappings") - 1, F.lit(0))
    return summed.select(
        (F.length(head) + F.col("bytes") + commas + F.length(F.lit("}}")))
        .cast("bigint")
        .alias("compact_size_bytes")
    )


def result_documents(results: DataFrame, include_raw: bool = False) -> DataFrame:
    """(path, value): one JSON object per result row.

    ``include_raw`` adds positions and context; issues appear only where there are any.
    """
    detail = ["start_position", "end_position", "context"] if include_raw else []
    names = ["checkov_id", "severity", "confidence", "pattern_name", *detail]
    matches = F.transform("matches", lambda m: F.struct(*[m[n].alias(n) for n in names]))
    issues = F.transform(
        "validation_issues",
        lambda i: F.struct(
            i["level"].alias("severity"),
            i["code"].alias("code"),
            i["message"].alias("message"),
            i["checkov_id"].alias("checkov_id"),
        ),
    )
    common = [F.col("path").alias("file_path"), "confidence", matches.alias("matches")]
    return results.select(
        "path",
        F.when(
            F.size("validation_issues") > 0,
            to_json(F.struct(*common, issues.alias("validation_issues"))),
        )
        .otherwise(to_json(F.struct(*common)))
        .alias("value"),
    )


def results_document(results: DataFrame, generated_at: str, include_raw: bool = False) -> DataFrame:
    """Lines of the whole results document: metadata, statistics, and one line per result.

    ``results`` is read several times and should be a written table.
    """
    totals = result_statistics(results)
    metadata = to_json(
        F.struct(
            "total_files",
            F.col("files_with_matches").alias("successful_extractions"),
            F.lit(_zulu(generated_at)).alias("generated_at"),
            F.lit(fixed.FORMAT_VERSION).alias("format_version"),
        )
    )
    scores = [F.round(name, 6).alias(name) for name in ("average_confidence", "min_confidence", "max_confidence")]
    counts = ["total_files", "files_with_matches", "total_matches", "unique_checkov_ids"]
    head = totals.select(
        F.concat(
            F.lit('{"metadata":'),
            metadata,
            F.lit(',"statistics":'),
            to_json(F.struct(*counts, *scores)),
            F.lit(',"extraction_results":['),
        ).alias("line")
    )
    entries = result_documents(results, include_raw).select(F.col("path").alias("key"), F.col("value").alias("line"))
    return document_lines(head, entries, "]}")


def result_records(results: DataFrame) -> DataFrame:
    """The slim record of every result."""
    return results.select(
        F.col("path").alias("file_path"),
        "checkov_id",
        "severity",
        (F.col("checkov_id").isNotNull() & F.col("severity").isNotNull()).alias("success"),
        "errors",
        "warnings",
    )


def summary_document(
    metadata: DataFrame,
    results: DataFrame,
    new_mappings: DataFrame,
    timestamp: str,
    generated_at: str,
    processing_statistics: dict[str, float] | None = None,
) -> DataFrame:
    """Lines of the summary document; its list of new mappings is written line by line.

    ``processing_statistics`` are those of a measured run (``runs.Measured.row``).
    """
    per_result = results.select(
        "confidence",
        F.size("matches").alias("n"),
        has_matches().alias("hit"),
        *[
            count_level(F.col("validation_issues"), level).alias(level)
            for level in ("ERROR", "WARNING", "INFO")
        ],
    )
    totals = per_result.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("matches"),
        F.coalesce(F.try_divide(F.count_if("hit"), F.count("*")), F.lit(0.0)).alias("rate"),
        F.coalesce(F.avg(F.when(F.col("hit"), F.col("confidence"))), F.lit(0.0)).alias("mean"),
        *[F.coalesce(F.sum(level), F.lit(0)).alias(level) for level in ("ERROR", "WARNING", "INFO")],
    )
    one = F.lit(1).alias("one")
    both = metadata.select("*", one).join(totals.select("*", one), "one")
    summary = to_json(
        F.struct(
            F.lit(_zulu(generated_at)).alias("generated_at"),
            F.col("total_mappings").alias("database_entries"),
            F.col("files").alias("processed_files"),
            F.col("matches").alias("total_matches"),
        )
    )
    database = F.concat(
        F.lit('{"severity_distribution":'),
        _level_counts(),
        F.lit(f',"last_updated":"{timestamp}","version":'),
        _json_string(F.col("version")),
        F.lit("}"),
    )
    levels = F.to_json(
        F.struct(
            *[
                F.when(F.col(level) > 0, F.col(level)).alias(level)
                for level in ("ERROR", "WARNING", "INFO")
            ]
        )
    )
    rates = to_json(
        F.struct(
            F.round("rate", 6).alias("success_rate"),
            F.round("mean", 6).alias("average_confidence"),
        )
    )
    head = both.select(
        F.concat(
            F.lit('{"summary":'),
            summary,
            F.lit(',"database_summary":'),
            database,
            F.lit(',"extraction_summary":'),
            F.substr(rates, F.lit(1), F.length(rates) - 1),
            F.lit(',"validation_issues":'),
            levels,
            F.lit(',"new_mappings":['),
        ).alias("line")
    )
    entries = new_mappings.select(
        F.concat_ws("/", "file_path", "checkov_id", "severity").alias("key"),
        to_json(F.struct("checkov_id", "severity", "file_path")).alias("line"),
    )
    run = f',"processing_statistics":{json.dumps(processing_statistics)}' if processing_statistics else ""
    return document_lines(head, entries, "]}" + run + "}")


def quality_document(
    report: DataFrame, counts: DataFrame, issues: DataFrame, timestamp: str
) -> DataFrame:
    """Lines of the quality report; its list of issues is written line by line.

    ``report`` is the one-row database report, ``counts`` the rows per severity.
    """
    levels = counts.agg(
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("severity", "mapping_count")))
        ).alias("levels"),
        F.lit(1).alias("one"),
    )
    both = report.withColumn("one", F.lit(1)).join(levels, "one")
    total = F.col("error_count") + F.col("warning_count") + F.col("info_count")
    summary = to_json(
        F.struct(
            "is_valid",
            F.round("confidence_score", 6).alias("confidence_score"),
            total.alias("total_issues"),
            F.col("error_count").alias("errors"),
            F.col("warning_count").alias("warnings"),
            F.col("info_count").alias("info"),
        )
    )
    head = both.select(
        F.concat(
            F.lit('{"validation_summary":'),
            summary,
            F.lit(',"database_stats":{"total_mappings":'),
            F.col("total_mappings").cast("string"),
            F.lit(',"severity_distribution":'),
            F.to_json("levels"),
            F.lit(f',"last_updated":"{timestamp}"}},"issues":['),
        ).alias("line")
    )
    entries = issues.select(
        F.concat_ws("/", "code", "checkov_id", "message").alias("key"),
        to_json(
            F.struct(F.col("level").alias("severity"), "code", "message", "checkov_id", "file_path")
        ).alias("line"),
    )
    return document_lines(head, entries, "]}")
