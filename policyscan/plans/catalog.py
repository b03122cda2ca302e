"""Every operator as a query over the driver's tables.

Each query takes (spark, sf_dir) and reads whole tables.  Scores are rounded to six
places so that engines that add in another order agree.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.frames import compute_once
from policyscan.functions import ids, paths, text
from policyscan.operators import database as db
from policyscan.operators import documents as docs
from policyscan.operators import matching, quality, runs, statistics
from policyscan.operators.matchers import text_matcher
from policyscan.operators.patterns import Pattern
from policyscan.plans import corpus
from policyscan.session import stage, staging_dir
from policyscan.sinks import documents as sinks
from policyscan.sources import database_json, files
from policyscan.streaming import refresh, snapshots

STAMP = "2024-01-02T03:04:05"
EARLIER = "1998-01-01"

CUSTOM_PATTERNS = [
    Pattern("see_reference", r"see \[([A-Z0-9_]+)\]", 6, kind="id"),
    Pattern("any_code", r"\b(CKV2?_[A-Z0-9]+_[0-9]+[XYZ]?)\b", 2, kind="id"),
    Pattern("severity_cell", r"\|\s?Severity\s*\|\s*([A-Za-z]+)", 5),
    Pattern("level_word", r"^Severity: ([A-Z]+)$", 3, kind="severity"),
]


def content() -> Column:
    return F.col("content")


# --- frames the queries share -------------------------------------------------


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.documents(spark, sf)


def results(spark: SparkSession, sf: str, **options) -> DataFrame:
    return docs.process_documents(pages(spark, sf), **options)


def unchecked(spark: SparkSession, sf: str) -> DataFrame:
    """Results without issues, for queries that do not look at issues."""
    return results(spark, sf, validate=False)


def counted(spark: SparkSession, sf: str) -> DataFrame:
    """Results for queries that only count or join: no issues, contexts or hashes."""
    return results(spark, sf, validate=False, contexts=False, hashes=False)


def found(spark: SparkSession, sf: str) -> DataFrame:
    return docs.found_mappings(pages(spark, sf))


def mappings(spark: SparkSession, sf: str) -> DataFrame:
    return db.first_wins(found(spark, sf))


def staged_found(spark: SparkSession, sf: str) -> DataFrame:
    return stage(found(spark, sf), "found")


def staged_mappings(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping table, stored: joins that keep its rows and look into it read it twice."""
    return stage(mappings(spark, sf), "mappings")


def matches(spark: SparkSession, sf: str) -> DataFrame:
    return docs.exploded_matches(counted(spark, sf))


def noted_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results with the errors and warnings a caller would note on them."""
    path, raw = F.col("path"), F.col("raw_checkov_id")
    hit = F.size("matches") > 0
    errors = F.array_compact(
        F.array(
            F.when(~hit, F.concat(F.lit("Checkov ID not found in "), path)),
            F.when(hit & F.col("severity").isNull(), F.concat(F.lit("Severity missing for "), raw)),
            F.when(
                hit & F.col("checkov_id").isNull(), F.concat(F.lit("Invalid Checkov text "), raw)
            ),
            F.when(F.endswith(path, F.lit(".txt")), F.lit("Invalid severity column")),
            F.when(F.contains(path, F.lit("/.cache/")), F.lit("Permission denied")),
            F.when(F.contains(path, F.lit("/node_modules/")), F.lit("Unicode error")),
            F.when(F.contains(path, F.lit("/archive/")), F.lit("Timeout after 30 s")),
            F.when(F.endswith(path, F.lit(".ADOC")), F.lit("disk full")),
        )
    )
    warnings = F.array_compact(
        F.array(F.when(F.contains(path, F.lit("index")), F.lit("looks like an index page")))
    )
    return counted(spark, sf).withColumns({"errors": errors, "warnings": warnings})


def document_rows(frame: DataFrame) -> DataFrame:
    """Hits of a document with its severities and score."""
    return frame.select(
        "path",
        F.array_join(F.transform("hits", lambda h: h["checkov_id"]), ",").alias("ids"),
        F.array_join("severities", ",").alias("severities"),
        F.round(matching.overall_confidence(F.col("hits"), F.col("severities")), 6).alias(
            "confidence"
        ),
    )


def matched(spark: SparkSession, sf: str, patterns="config") -> DataFrame:
    # Behind a generator, as the filter below would else take the gate along and run it a second time.
    gated = compute_once(pages(spark, sf), content=F.when(text.process_gate(content()), content()))
    return compute_once(
        gated,
        hits=matching.find_ids("content", patterns),
        severities=matching.find_severities("content", patterns),
    ).filter(content().isNotNull())


def hit_rows(frame: DataFrame, hits: Column) -> DataFrame:
    return frame.select("path", F.posexplode(hits).alias("pos", "h")).select(
        "path",
        (F.col("pos") + 1).alias("rank"),
        "h.checkov_id",
        F.round("h.confidence", 6).alias("confidence"),
        "h.start_position",
        "h.end_position",
        "h.context",
        "h.pattern_name",
    )


def result_rows(frame: DataFrame) -> DataFrame:
    """Flat view of result rows, with issue codes in rule order."""
    return frame.select(
        "path",
        "checkov_id",
        "severity",
        "raw_checkov_id",
        "raw_severity",
        F.round("confidence", 6).alias("confidence"),
        "content_hash",
        F.size("matches").cast("bigint").alias("match_count"),
        F.array_join(F.transform("validation_issues", lambda i: i["code"]), ",").alias("codes"),
    )


def gated_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).withColumn("content", F.when(text.process_gate(content()), content()))


def raw_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Matches before repeats are removed, each with the severity of its turn."""
    frame = docs.gated_searches(pages(spark, sf), contexts=False, ranked=False)
    rows = frame.select("path", "severities", F.posexplode("hits").alias("pos", "h"))
    turn = F.when(F.size("severities") > 0, F.col("pos") % F.size("severities"))
    return rows.select(
        "path",
        "h.checkov_id",
        F.get("severities", turn).alias("severity"),
        "h.confidence",
    )


def previous_run(spark: SparkSession, sf: str) -> DataFrame:
    """Hashes of an earlier run: old pages only, and open orders had another text."""
    pages_then = corpus.policy_pages(spark, sf).filter(F.col("modificationTime") < EARLIER)
    then = text.newlines(content())
    return pages_then.select(
        "path",
        text.sha256_16(
            F.when(F.col("o_orderstatus") == "O", F.concat(then, F.lit("draft"))).otherwise(then)
        ).alias("text_hash"),
    )


# --- the queries --------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.file_manifest(spark, sf)


@query
def scan_recursive(spark, sf):
    return files.scan(manifest(spark, sf), max_mb=0.01).select("path", "length")


@query
def scan_single_level(spark, sf):
    below = manifest(spark, sf).withColumn("path", F.regexp_replace("path", "^docs/[^/]+/", ""))
    return files.scan(below, recursive=False).select("path", "length")


@query
def scan_max_depth(spark, sf):
    return manifest(spark, sf).filter(files.within_depth(2)).select("path", "length")


@query
def scan_ignore_globs(spark, sf):
    globs = fixed.PIPELINE_IGNORE + ["*-polic?es", "[a-d]*er", "[!0-9]ode_mod*"]
    return manifest(spark, sf).filter(~files.is_ignored(globs)).select("path")


@query
def scan_extension_filter(spark, sf):
    rows = manifest(spark, sf).filter(files.has_extension(fixed.PIPELINE_EXTENSIONS))
    return rows.select("path", F.lower(paths.suffix(F.col("path"))).alias("extension"))


@query
def scan_size_filter(spark, sf):
    return manifest(spark, sf).filter(files.within_size(0.005)).select("path", "length")


@query
def scan_unreadable(spark, sf):
    return manifest(spark, sf).filter(~files.is_readable()).select("path")


@query
def scan_counts(spark, sf):
    return files.scan_counts(
        manifest(spark, sf), fixed.PIPELINE_EXTENSIONS, fixed.PIPELINE_IGNORE, max_mb=0.01
    )


@query
def scan_multi_union(spark, sf):
    everything = manifest(spark, sf)
    even = everything.filter(F.contains("path", F.lit("-policies/")))
    archived = everything.filter(F.contains("path", F.lit("/archive/")))
    return files.union_files([even, archived]).select("path", "length")


@query
def scan_path_order(spark, sf):
    return files.in_path_order(manifest(spark, sf)).select("path")


@query
def read_utf8_latin1(spark, sf):
    read = files.read_documents(manifest(spark, sf))
    return read.select(
        "path",
        F.length("content").alias("chars"),
        F.md5(F.encode("content", "UTF-8")).alias("digest"),
        "file_size",
    )


@query
def read_with_encoding(spark, sf):
    declared = corpus.declared_files(spark, sf)
    read = declared.withColumn("text", files.decode_declared(content(), F.col("encoding")))
    return read.select(
        "path",
        "encoding",
        F.length("text").alias("chars"),
        F.md5(F.encode("text", "UTF-8")).alias("digest"),
    )


@query
def read_encoding_choice(spark, sf):
    return corpus.declared_files(spark, sf).select(
        "path", files.choose_encoding(content()).alias("encoding")
    )


@query
def read_batch(spark, sf):
    """Files of the listing, and how many of them reading brought; the rest failed."""
    found = manifest(spark, sf).withColumn("file", F.col("path"))
    return files.batch_counts(found, files.listing(found))


@query
def db_read_pieces(spark, sf):
    """Entries of compact documents that were written as files of long lines."""
    folder = f"{staging_dir(spark)}/compact-{uuid.uuid4().hex}"
    corpus.compact_documents(spark, sf).select("value").write.text(folder, lineSep=" ")
    return database_json.read_compact_pieces(spark, folder).select("checkov_id", "severity")


@query
def db_read_compact(spark, sf):
    parsed = database_json.parse_compact(corpus.compact_documents(spark, sf))
    entries = F.array_sort(F.map_entries("mappings"))
    joined = F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","
    )
    return parsed.select(
        "path",
        "version",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("generated"),
        "generator_version",
        F.size("mappings").cast("bigint").alias("total_mappings"),
        joined.alias("entries"),
    )


def _assembled(spark, sf):
    rows = staged_found(spark, sf)
    return rows, db.first_wins(rows), db.assemble(rows)


@query
def sink_database_json(spark, sf):
    _, table, metadata = _assembled(spark, sf)
    return sinks.database_document(table, metadata, STAMP, STAMP)


@query
def sink_compact_json(spark, sf):
    _, table, metadata = _assembled(spark, sf)
    return sinks.compact_document(table, metadata, STAMP)


@query
def sink_compact_size(spark, sf):
    return sinks.compact_size(mappings(spark, sf), STAMP)


def _rounded_results(spark, sf):
    return results(spark, sf).withColumns(
        {
            "confidence": F.round("confidence", 6),
            "matches": F.transform(
                "matches", lambda m: m.withField("confidence", F.round(m["confidence"], 6))
            ),
        }
    )


@query
def sink_results_json(spark, sf):
    return sinks.result_documents(_rounded_results(spark, sf), include_raw=True)


@query
def sink_results_document(spark, sf):
    """The whole results document with its metadata and statistics."""
    done = stage(_rounded_results(spark, sf).select("path", "confidence", "matches", "validation_issues"), "results")
    return sinks.results_document(done, STAMP, include_raw=True)


@query
def sink_summary_json(spark, sf):
    done = stage(
        results(spark, sf).select(
            "path", "checkov_id", "severity", "confidence", "matches", "validation_issues"
        ),
        "results",
    )
    metadata = db.assemble(docs.result_mappings(done))
    added = db.new_mappings(docs.exploded_matches(done), corpus.existing_database(spark, sf))
    return sinks.summary_document(metadata, done, added, STAMP, STAMP)


@query
def sink_result_record(spark, sf):
    rows = sinks.result_records(noted_results(spark, sf))
    return rows.withColumns(
        {"errors": F.array_join("errors", ";"), "warnings": F.array_join("warnings", ";")}
    )


# Text functions ---------------------------------------------------------------


def untidy(spark: SparkSession, sf: str) -> DataFrame:
    return corpus.untidy_texts(spark, sf)


def digest_rows(frame: DataFrame, value: Column) -> DataFrame:
    done = frame.withColumn("text", value)
    return done.select(
        "path",
        F.length("text").alias("chars"),
        F.md5(F.encode("text", "UTF-8")).alias("digest"),
    )


@query
def text_newlines(spark, sf):
    return digest_rows(untidy(spark, sf), text.newlines(content()))


@query
def text_rstrip_lines(spark, sf):
    return digest_rows(untidy(spark, sf), text.rstrip_lines(text.newlines(content())))


@query
def text_blank_collapse(spark, sf):
    stripped = text.rstrip_lines(text.newlines(content()))
    return digest_rows(untidy(spark, sf), text.let(stripped, text.collapse_blank_lines))


@query
def text_nfkc(spark, sf):
    return digest_rows(untidy(spark, sf), text.nfkc(content()))


@query
def text_strip_bom(spark, sf):
    return digest_rows(untidy(spark, sf), text.strip_bom(content()))


@query
def text_preprocess(spark, sf):
    done = files.preprocess_texts(untidy(spark, sf))
    return done.select(
        "path",
        F.length("content").alias("chars"),
        F.md5(F.encode("content", "UTF-8")).alias("digest"),
        F.array_join("preprocessing_applied", ",").alias("applied"),
    )


@query
def text_profile(spark, sf):
    return untidy(spark, sf).select(
        "path",
        F.length("content").cast("bigint").alias("chars"),
        text.line_count(content()).cast("bigint").alias("lines"),
        text.non_ascii_count(content()).cast("bigint").alias("non_ascii_chars"),
        text.control_count(content()).cast("bigint").alias("control_chars"),
    )


@query
def text_suitability(spark, sf):
    verdict = compute_once(
        pages(spark, sf), verdict=text.suitability(content())
    ).select("path", "verdict.*")
    return verdict.select(
        "path",
        "is_valid",
        F.array_join("issues", ";").alias("issues"),
        F.array_join("relevant_keywords", ",").alias("relevant_keywords"),
    )


@query
def text_sha256_16(spark, sf):
    return pages(spark, sf).select("path", text.sha256_16(content()).alias("content_hash"))


@query
def text_match_context(spark, sf):
    """Context of the first bracketed token of every page."""
    inner = F.regexp_instr(content(), F.lit(r"\[[A-Z0-9_]+\]"))
    token = F.regexp_extract(content(), r"\[[A-Z0-9_]+\]", 0)
    rows = pages(spark, sf).withColumns({"at": inner, "token": token}).filter(F.col("at") > 0)
    cut = rows.withColumns(
        {
            "before": F.substr(content(), F.lit(1), F.col("at") - 1),
            "after": F.substr(content(), F.col("at") + F.length("token")),
        }
    )
    return cut.select(
        "path", "token", text.match_context("before", "token", "after").alias("context")
    )


@query
def text_match_contexts(spark, sf):
    """Context of every bracketed token of every page."""
    found = matching.match_contexts("content", r"\[[A-Z0-9_]+\]")
    rows = pages(spark, sf).select("path", F.explode(found).alias("m"))
    return rows.select("path", F.col("m.match").alias("token"), "m.start_position", "m.context")


@query
def id_parse(spark, sf):
    """Every word of the pages that looks like a code, in lower case and padded."""
    words = pages(spark, sf).select(
        "path", F.explode(F.array_distinct(F.regexp_extract_all(content(), F.lit(r"([A-Z0-9]+_[A-Z0-9_]+)"), 1))).alias("word")
    )
    padded = F.concat(F.lit(" "), F.lower("word"), F.lit("\t"))
    return words.withColumn("p", ids.parse_id(padded)).select(
        "path", "word", "p.full_id", "p.type", "p.provider", "p.number"
    )


@query
def id_accept(spark, sf):
    words = pages(spark, sf).select(
        "path", F.explode(F.array_distinct(F.regexp_extract_all(content(), F.lit(r"([A-Z0-9_]{2,})"), 1))).alias("word")
    )
    return words.select("path", "word", ids.accept_id("word").alias("accepted"))


@query
def id_type_provider_dim(spark, sf):
    rows = found(spark, sf).select("path", "checkov_id")
    labelled = db.label_providers(rows, ids.parse_id(F.col("checkov_id")))
    return labelled.select("path", "checkov_id", "id_type", "provider", "provider_name", "is_known")


@query
def severity_parse(spark, sf):
    orders = corpus.table(spark, sf, "orders")
    word = F.substring("o_orderpriority", 3, 20)
    return orders.select("o_orderkey", word.alias("word"), ids.parse_severity(F.lower(word)).alias("severity"))


@query
def severity_rank(spark, sf):
    ranked = mappings(spark, sf).withColumn("rank", ids.severity_rank(F.col("severity")))
    return ranked.orderBy(F.desc("rank"), "checkov_id")


@query
def error_category(spark, sf):
    notes = noted_results(spark, sf).select("path", F.explode("errors").alias("message"))
    return notes.select("path", "message", ids.error_category(F.col("message")).alias("category"))


@query
def result_flags(spark, sf):
    return docs.result_flags(noted_results(spark, sf))


# Filters ----------------------------------------------------------------------


@query
def filter_empty(spark, sf):
    return pages(spark, sf).filter(text.is_blank(content())).select("path")


@query
def filter_min_length(spark, sf):
    return pages(spark, sf).filter(~text.long_enough(content())).select("path")


@query
def filter_keywords(spark, sf):
    return pages(spark, sf).filter(text.has_keyword(content())).select("path")


@query
def filter_binary(spark, sf):
    return pages(spark, sf).filter(text.appears_binary(content())).select("path")


@query
def filter_process_gate(spark, sf):
    return pages(spark, sf).select("path", text.process_gate(content()).alias("passed"))


@query
def db_get(spark, sf):
    return db.get(mappings(spark, sf), "CKV_AZURE_1")


@query
def db_filter_severity(spark, sf):
    return db.with_severity(mappings(spark, sf), "HIGH")


@query
def db_filter_provider(spark, sf):
    return db.with_provider(mappings(spark, sf), "docker")


# Extraction -------------------------------------------------------------------


@query
def extract_ids(spark, sf):
    return hit_rows(gated_text(spark, sf), matching.find_ids("content"))


@query
def extract_ids_builtin(spark, sf):
    return hit_rows(gated_text(spark, sf), matching.find_ids("content", "builtin"))


@query
def extract_first_per_strong_pattern(spark, sf):
    """All accepted hits before repeats are removed; strong patterns give one."""
    hits = matching.all_hits("content")
    rows = hit_rows(gated_text(spark, sf), hits)
    return rows.select("path", "rank", "checkov_id", "pattern_name", "start_position")


@query
def match_confidence(spark, sf):
    hits = matching.all_hits("content", "builtin")
    rows = hit_rows(gated_text(spark, sf), hits)
    return rows.select("path", "rank", "checkov_id", "pattern_name", "confidence")


@query
def dedup_matches(spark, sf):
    found_hits = docs.gated_searches(pages(spark, sf), contexts=False, ranked=False, levels=False)
    rows = hit_rows(found_hits, matching.dedup_hits("hits"))
    return rows.select("path", F.col("rank").alias("slot"), "checkov_id", "confidence", "pattern_name")


@query
def rank_matches(spark, sf):
    rows = hit_rows(gated_text(spark, sf), matching.find_ids("content"))
    return rows.select("path", "rank", "checkov_id", "confidence")


@query
def extract_severities(spark, sf):
    levels = matching.find_severities("content")
    return gated_text(spark, sf).select("path", F.posexplode(levels).alias("pos", "severity"))


@query
def extract_severities_builtin(spark, sf):
    levels = matching.find_severities("content", "builtin")
    return gated_text(spark, sf).select("path", F.posexplode(levels).alias("pos", "severity"))


@query
def overall_confidence(spark, sf):
    return document_rows(matched(spark, sf)).select("path", "confidence")


@query
def extract_document(spark, sf):
    return document_rows(matched(spark, sf))


@query
def extract_document_builtin(spark, sf):
    return document_rows(matched(spark, sf, "builtin"))


@query
def pair_positional(spark, sf):
    rows = matches(spark, sf)
    return rows.select("path", "rank", "checkov_id", "severity")


@query
def pair_nearest(spark, sf):
    """Severity written closest to each id, wherever a page has any severity."""
    frame = matched(spark, sf)
    near = docs.nearest_severities("hits", "places", "severities")
    placed = compute_once(
        frame, places=docs.level_occurrences("content", "severities")
    ).filter(F.size("severities") > 0)
    rows = placed.select("path", F.posexplode(near).alias("pos", "n"))
    return rows.select("path", (F.col("pos") + 1).alias("rank"), "n.checkov_id", "n.severity")


@query
def primary_mapping(spark, sf):
    return counted(spark, sf).select(
        "path", "raw_checkov_id", "raw_severity", "checkov_id", "severity", "provider"
    )


@query
def process_document(spark, sf):
    return result_rows(results(spark, sf))


@query
def process_batch(spark, sf):
    """The whole file pipeline: scan, read and process, with the pipeline's settings."""
    chosen = files.scan(
        manifest(spark, sf),
        fixed.PIPELINE_EXTENSIONS,
        fixed.PIPELINE_IGNORE,
        fixed.PIPELINE_MAX_MB,
    )
    return result_rows(docs.process_documents(files.read_documents(chosen)))


# Joins ------------------------------------------------------------------------


@query
def known_id_anti(spark, sf):
    return quality.new_id_issues(matches(spark, sf), corpus.existing_database(spark, sf))


@query
def severity_mismatch_join(spark, sf):
    found_rows = quality.severity_mismatches(
        matches(spark, sf), corpus.existing_database(spark, sf)
    )
    return found_rows.select("path", "rank", "checkov_id", "severity", "existing_severity")


@query
def new_mappings_anti(spark, sf):
    return db.new_mappings(matches(spark, sf), corpus.existing_database(spark, sf))


@query
def db_merge(spark, sf):
    return db.merge(staged_mappings(spark, sf), corpus.second_database(spark, sf))


@query
def db_merge_added(spark, sf):
    added = db.new_to(mappings(spark, sf), corpus.second_database(spark, sf))
    return added.agg(F.count("*").alias("added"))


@query
def db_add(spark, sf):
    return db.add(db.add(staged_mappings(spark, sf), "CKV_NEW_1", "LOW"), "CKV_AZURE_1", "LOW")


@query
def db_remove(spark, sf):
    return db.remove(mappings(spark, sf), corpus.deletions(spark, sf))


@query
def conflict_join(spark, sf):
    return db.conflicts(staged_found(spark, sf))


# Aggregations -----------------------------------------------------------------


@query
def mappings_first_wins(spark, sf):
    return mappings(spark, sf)


@query
def conflicts(spark, sf):
    """The same conflicts from full result rows."""
    done = docs.result_mappings(counted(spark, sf))
    return db.conflicts(stage(done, "found"))


@query
def extraction_stats(spark, sf):
    return db.extraction_stats(found(spark, sf))


@query
def db_assemble(spark, sf):
    row = db.assemble(found(spark, sf))
    return row.select(
        "version",
        "total_mappings",
        "generator_version",
        "stats_total",
        F.to_json("severity_counts").alias("severity_counts"),
    )


@query
def db_statistics(spark, sf):
    return db.severity_counts(mappings(spark, sf))


@query
def severity_percentages(spark, sf):
    rows = db.severity_percentages(mappings(spark, sf))
    return rows.select("severity", F.round("percentage", 6).alias("percentage"))


@query
def most_common_severity(spark, sf):
    return db.most_common_severity(found(spark, sf))


def _rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.round(n, 6) for n in names})


@query
def result_statistics(spark, sf):
    row = statistics.result_statistics(counted(spark, sf))
    return _rounded(row, "average_confidence", "min_confidence", "max_confidence")


@query
def summary_rates(spark, sf):
    row = statistics.summary_rates(counted(spark, sf))
    return _rounded(row, "success_rate", "average_confidence")


@query
def issue_counts(spark, sf):
    return statistics.issue_counts(quality.validate_results(results(spark, sf)))


@query
def processing_summary(spark, sf):
    listed = manifest(spark, sf)
    failed = listed.select(F.count_if(~files.is_readable())).scalar()
    done = docs.process_documents(files.read_documents(listed), validate=False)
    row = statistics.processing_summary(done, failed)
    return _rounded(row, "success_rate", "average_confidence")


def unreadable(spark: SparkSession, sf: str) -> DataFrame:
    """(file_path, error) of the files that cannot be read."""
    failed = manifest(spark, sf).filter(~files.is_readable())
    return failed.select(F.col("path").alias("file_path"), F.concat(F.lit("Cannot read "), "path").alias("error"))


@query
def extraction_summary(spark, sf):
    rows = staged_found(spark, sf)
    summary = statistics.extraction_summary(db.resolved(rows), db.conflicts(rows), unreadable(spark, sf))
    errors = F.array_join(F.transform("errors", lambda e: e["error"]), ";")
    lists = F.array_join(F.transform("conflicts", lambda c: F.concat_ws("|", c["checkov_id"], c["existing_severity"], c["new_severity"], c["file_path"])), ";")
    return summary.withColumns({"errors": errors, "conflicts": lists})


@query
def run_statistics(spark, sf):
    return statistics.run_statistics(noted_results(spark, sf))


@query
def provider_counts(spark, sf):
    return statistics.provider_counts(counted(spark, sf))


@query
def pattern_counts(spark, sf):
    return statistics.pattern_counts(counted(spark, sf))


@query
def error_category_counts(spark, sf):
    return statistics.error_category_counts(noted_results(spark, sf))


def _light(documents: DataFrame) -> DataFrame:
    return docs.process_documents(documents, validate=False, contexts=False, hashes=False)


def _measured(spark: SparkSession, sf: str) -> runs.Measured:
    return runs.measured_run(manifest(spark, sf), f"{staging_dir(spark)}/run-{uuid.uuid4().hex}", _light)


@query
def throughput(spark, sf):
    """Counters observed while the results are written; the rates are those of the measured time."""
    run = _measured(spark, sf)
    agrees = abs(run.files_per_second * run.duration_seconds - run.total_files_processed) < 1e-3
    agrees &= abs(run.mb_per_second * run.duration_seconds * (1 << 20) - run.total_bytes_processed) < 1
    names = [
        "total_files_found", "files_read", "files_failed", "total_files_processed", "successful_extractions",
        "failed_extractions", "files_with_matches", "total_matches", "total_bytes_processed",
    ]
    row = [run.row()[n] for n in names] + [bool(agrees and run.duration_seconds > 0)]
    return spark.createDataFrame([row], ", ".join(f"{n} long" for n in names) + ", rates_agree boolean")


@query
def statistics_report(spark, sf):
    listed = files.listing(manifest(spark, sf)).select(F.count("*")).scalar().cast("double")
    report = statistics.statistics_report(noted_results(spark, sf))
    number = F.when(F.col("name") == "total_files_found", listed).otherwise(F.col("value"))
    return report.withColumn("value", number)


@query
def db_confidence_metrics(spark, sf):
    return db.confidence_metrics(mappings(spark, sf), fixed.DATABASE_VERSION, True)


# Data quality -----------------------------------------------------------------


def _columns(issues: DataFrame) -> DataFrame:
    return issues.select("level", "code", "message", "file_path", "checkov_id")


@query
def dq_structure(spark, sf):
    frame = unchecked(spark, sf).filter(F.col("content_hash") != "")
    rules = quality.structure_issues(F.col("path"), F.col("matches"), F.col("confidence"))
    return _columns(quality.issue_rows(frame, rules))


@query
def dq_match(spark, sf):
    """All rules on single matches, with the identifiers an earlier database lacks (``known_id_anti``)."""
    done = results(spark, sf, patterns="builtin", validate=False, contexts=False, hashes=False)
    rows = docs.exploded_matches(done).select("path", "checkov_id", "severity", "confidence")
    rows = stage(rows, "matches")
    return _columns(quality.validate_matches(rows, corpus.existing_database(spark, sf)))


@query
def dq_match_report(spark, sf):
    return _rounded(quality.match_report(unchecked(spark, sf)), "confidence_score")


@query
def dq_duplicates(spark, sf):
    return _columns(quality.duplicate_issues(raw_matches(spark, sf)))


@query
def dq_confidence_spread(spark, sf):
    return _columns(quality.spread_issues(raw_matches(spark, sf)))


@query
def dq_against_db(spark, sf):
    known = corpus.existing_database(spark, sf)
    return _columns(quality.severity_mismatch_issues(matches(spark, sf), known))


@query
def dq_result(spark, sf):
    done = results(spark, sf, contexts=False, hashes=False).select("path", "matches", "validation_issues")
    done = stage(done, "results")
    return _columns(quality.validate_results(done, corpus.existing_database(spark, sf)))


@query
def dq_db_metadata(spark, sf):
    ids_in_orders = corpus.table(spark, sf, "orders").select(F.count("*")).scalar()
    return _columns(quality.metadata_issues(mappings(spark, sf), "", ids_in_orders))


@query
def dq_db_mapping(spark, sf):
    return _columns(quality.mapping_issues(corpus.doubtful_mappings(spark, sf)))


@query
def dq_db_skew(spark, sf):
    return _columns(quality.skew_issues(corpus.doubtful_mappings(spark, sf)))


@query
def dq_db_confidence(spark, sf):
    """Report and confidence of every provider's part of the database."""
    provider = F.split("checkov_id", "_")[1]
    parts = quality.part_reports(corpus.doubtful_mappings(spark, sf), provider, fixed.DATABASE_VERSION)
    return _rounded(parts, "confidence_score")


@query
def dq_report(spark, sf):
    return _rounded(quality.result_report(results(spark, sf)), "confidence_score")


@query
def dq_report_by_code(spark, sf):
    """Reports grouped over issue rows: here one per rule."""
    issues = quality.issue_rows(results(spark, sf), "validation_issues")
    return quality.report(issues, ["code"], F.lit(0.0))


@query
def dq_db_validate(spark, sf):
    counted = corpus.table(spark, sf, "orders").select(F.count("*")).scalar()
    row = quality.database_report(
        corpus.doubtful_mappings(spark, sf), fixed.DATABASE_VERSION, counted + 1
    )
    return _rounded(row, "confidence_score")


@query
def dq_quality_report(spark, sf):
    table = corpus.doubtful_mappings(spark, sf)
    counted = corpus.table(spark, sf, "orders").select(F.count("*")).scalar()
    report = quality.database_report(table, fixed.DATABASE_VERSION, counted + 1)
    issues = stage(quality.database_issues(table, fixed.DATABASE_VERSION, counted + 1), "issues")
    return sinks.quality_document(report, db.severity_counts(table), issues, STAMP)


@query
def db_integrity(spark, sf):
    per_severity = corpus.table(spark, sf, "orders").select(F.count("*")).scalar()
    return quality.integrity(corpus.doubtful_mappings(spark, sf), per_severity)


# Sorted lists and limits --------------------------------------------------------


@query
def topk_providers(spark, sf):
    rows = stage(counted(spark, sf).select("path", "provider", "checkov_id", "severity"), "rows")
    return _rounded(statistics.top_providers(rows), "percentage")


@query
def severity_distribution_sorted(spark, sf):
    return _rounded(db.distribution(mappings(spark, sf)), "percentage")


@query
def error_categories_sorted(spark, sf):
    return statistics.error_categories_sorted(noted_results(spark, sf))


@query
def limit_first_10(spark, sf):
    """The first conflicts and the first errors, in file order."""
    first = db.first_conflicts(staged_found(spark, sf)).withColumn("kind", F.lit("conflict"))
    errors = unreadable(spark, sf).orderBy(paths.path_key(F.col("file_path"))).limit(fixed.SUMMARY_LIST_LIMIT)
    return first.unionByName(errors.withColumn("kind", F.lit("error")), allowMissingColumns=True)


# Incremental work and hooks -----------------------------------------------------


@query
def incremental_changed(spark, sf):
    return refresh.changed_documents(pages(spark, sf), previous_run(spark, sf)).select(
        "path", "text_hash"
    )


def folder_then(spark: SparkSession, sf: str, chosen: DataFrame | None = None) -> DataFrame:
    """The folder of an earlier run, as files: old pages only, drafts of open orders."""
    pages_then = corpus.policy_pages(spark, sf, chosen).filter(F.col("modificationTime") < EARLIER)
    then = text.newlines(content())
    draft = F.replace(then, F.lit("|Severity"), F.lit("|Level"))
    return _as_files(pages_then.withColumn("content", F.when(F.col("o_orderstatus") == "O", draft).otherwise(then)))


def folder_now(spark: SparkSession, sf: str, chosen: DataFrame | None = None) -> DataFrame:
    """The folder now, as files."""
    return _as_files(corpus.policy_pages(spark, sf, chosen).withColumn("content", text.newlines(content())))


def _as_files(frame: DataFrame) -> DataFrame:
    size = F.octet_length("content").cast("bigint").alias("length")
    return frame.select("k", "path", F.col("path").alias("file"), size, "modificationTime", "content")


@query
def incremental_listing(spark, sf):
    """New, edited and removed files between two listings."""
    now = folder_now(spark, sf).filter(F.col("k") % 11 != 0)
    return snapshots.changes(files.listing(now), files.listing(folder_then(spark, sf))).select("path", "change")


@query
def incremental_refresh(spark, sf):
    """The mapping table of a store that saw the folder then and now."""
    store = snapshots.Store(
        spark, f"{staging_dir(spark)}/store-{uuid.uuid4().hex}", _light, ["path", "checkov_id", "severity"], buckets=16
    )
    for folder in (folder_then, folder_now):
        store.update(
            files.listing(folder(spark, sf)),
            lambda chosen, folder=folder: folder(spark, sf, chosen).select("path", "content"),
        )
    return store.mappings()


def urgent_rules(results: DataFrame) -> Column:
    """A validator of one's own: one issue for every critical page, no others."""
    found = quality.issue("ERROR", "URGENT", F.concat(F.lit("Critical: "), "checkov_id"), F.col("path"), F.col("checkov_id"))
    critical = (F.col("severity") == "CRITICAL") & F.col("checkov_id").isNotNull()
    return F.when(critical, F.array(found)).otherwise(F.array().cast(quality.ISSUES))


@query
def custom_validator(spark, sf):
    done = results(spark, sf, validator=urgent_rules, contexts=False, hashes=False)
    return _columns(quality.issue_rows(done, "validation_issues"))


@query
def read_report(spark, sf):
    """The full content reader: encoding, cleaning and what it changed."""
    declared = corpus.declared_files(spark, sf)
    found = declared.withColumn("length", F.octet_length("content").cast("bigint"))
    read = files.read_with_report(found)
    return read.select(
        "path",
        "encoding",
        F.length("content").alias("chars"),
        F.md5(F.encode("content", "UTF-8")).alias("digest"),
        F.array_join("preprocessing_applied", ",").alias("applied"),
    )


@query
def custom_patterns(spark, sf):
    return document_rows(matched(spark, sf, CUSTOM_PATTERNS))


def code_finder() -> Callable[[str], list[tuple]]:
    """A matcher of one's own: every code of the form CKV_WORD_DIGITS, score 0.9."""
    pattern = re.compile(r"CKV_[A-Z0-9]+_[0-9]+(?![0-9A-Z_])")

    def find(content: str) -> list[tuple]:
        return [
            (m.group(0), 0.9, m.start(), m.end(), "", "code") for m in pattern.finditer(content)
        ]

    return find


@query
def custom_matcher(spark, sf):
    matcher = text_matcher(code_finder())
    done = docs.process_documents(pages(spark, sf), matcher=matcher, validate=False)
    rows = docs.exploded_matches(done)
    return rows.select("path", "rank", "checkov_id", "severity", "start_position", "end_position")
