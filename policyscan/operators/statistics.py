"""Counts and rates over result rows and issue rows.

Everything is an aggregate that combines before its shuffle.  Top lists limit a
sorted aggregate; that limit is the feature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.functions.ids import error_category
from policyscan.functions.paths import path_key
from policyscan.session import stage


def has_matches() -> Column:
    return F.size("matches") > 0


def succeeded() -> Column:
    return F.col("checkov_id").isNotNull() & F.col("severity").isNotNull()


def _mean(total: Column, count: Column) -> Column:
    return F.coalesce(F.try_divide(total, count), F.lit(0.0))


def result_statistics(results: DataFrame) -> DataFrame:
    """Files, matches, distinct identifiers and the range of confidences above 0.

    Rows are matches; the first row of a file (or its only one) carries the file.
    """
    rows = results.select(
        "confidence", F.posexplode_outer(F.col("matches.checkov_id")).alias("pos", "id")
    )
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    score = F.when(first & (F.col("confidence") > 0), F.col("confidence"))
    return rows.agg(
        F.count_if(first).alias("total_files"),
        F.count_if(F.col("pos") == 0).alias("files_with_matches"),
        F.count("id").alias("total_matches"),
        F.count_distinct("id").alias("unique_checkov_ids"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("average_confidence"),
        F.coalesce(F.min(score), F.lit(0.0)).alias("min_confidence"),
        F.coalesce(F.max(score), F.lit(0.0)).alias("max_confidence"),
    )


def summary_rates(results: DataFrame) -> DataFrame:
    """Share of files with matches and their average confidence."""
    return results.agg(
        F.count("*").alias("processed_files"),
        F.coalesce(F.sum(F.size("matches")), F.lit(0)).alias("total_matches"),
        _mean(F.count_if(has_matches()), F.count("*")).alias("success_rate"),
        F.coalesce(F.avg(F.when(has_matches(), F.col("confidence"))), F.lit(0.0)).alias(
            "average_confidence"
        ),
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("level").agg(F.count("*").alias("issue_count"))


def processing_summary(results: DataFrame, failed: int | Column = 0) -> DataFrame:
    """What the processor counts: only files that passed the gate are processed.

    ``failed`` is the number of files that could not be read (they have no row).
    """
    processed = F.col("content_hash") != ""
    return results.agg(
        F.count_if(processed).alias("files_processed"),
        F.count_if(processed & has_matches()).alias("successful_extractions"),
        F.lit(failed).cast("bigint").alias("failed_extractions")
        if isinstance(failed, int)
        else failed.cast("bigint").alias("failed_extractions"),
        _mean(F.count_if(processed & has_matches()), F.count_if(processed)).alias("success_rate"),
        F.coalesce(F.sum(F.size("matches")), F.lit(0)).alias("total_matches"),
        F.coalesce(F.avg(F.when(has_matches(), F.col("confidence"))), F.lit(0.0)).alias(
            "average_confidence"
        ),
    )


def run_statistics(results: DataFrame, files_found: int | Column | None = None) -> DataFrame:
    """Counts, rates in percent and file sizes; ``results`` carries ``file_size``."""
    size = F.when(F.col("file_size") > 0, F.col("file_size"))
    count = F.count("*")
    found = count if files_found is None else files_found
    found = F.lit(found) if isinstance(found, int) else found
    return results.agg(
        found.cast("bigint").alias("total_files_found"),
        count.alias("total_files_processed"),
        F.count_if(succeeded()).alias("successful_extractions"),
        F.count_if(~succeeded()).alias("failed_extractions"),
        F.round(_mean(F.count_if(succeeded()) * 100, count), 2).alias("success_rate_percent"),
        F.round(_mean(F.count_if(~succeeded()) * 100, count), 2).alias("error_rate_percent"),
        F.count_if(F.size("errors") > 0).alias("files_with_errors"),
        F.count_if(F.size("warnings") > 0).alias("files_with_warnings"),
        F.coalesce(F.sum(size), F.lit(0)).alias("total_bytes_processed"),
        F.round(F.coalesce(F.avg(size), F.lit(0.0)), 2).alias("average_file_size_bytes"),
        F.coalesce(F.max(size), F.lit(0)).cast("bigint").alias("largest_file_bytes"),
        F.coalesce(F.min(size), F.lit(0)).cast("bigint").alias("smallest_file_bytes"),
    )


def provider_counts(results: DataFrame) -> DataFrame:
    """Successful files per provider."""
    return results.filter(succeeded()).groupBy("provider").agg(F.count("*").alias("file_count"))


def top_providers(results: DataFrame, limit: int = fixed.TOP_PROVIDERS) -> DataFrame:
    """Providers with the most successful files and their share; ties by first file."""
    counts = (
        results.filter(succeeded())
        .groupBy("provider")
        .agg(F.count("*").alias("file_count"), F.min(path_key(F.col("path"))).alias("first"))
    )
    total = results.filter(succeeded()).select(F.count("*")).scalar()
    return (
        counts.orderBy(F.desc("file_count"), "first")
        .limit(limit)
        .select("provider", "file_count", (F.col("file_count") / total * 100).alias("percentage"))
    )


def pattern_counts(results: DataFrame) -> DataFrame:
    names = results.select(F.explode("matches.pattern_name").alias("pattern_name"))
    return (
        names.filter(F.col("pattern_name") != "")
        .groupBy("pattern_name")
        .agg(F.count("*").alias("match_count"))
    )


def error_category_counts(results: DataFrame) -> DataFrame:
    return (
        results.select(F.explode("errors").alias("message"))
        .groupBy(error_category(F.col("message")).alias("category"))
        .agg(F.count("*").alias("error_count"))
    )


def error_categories_sorted(results: DataFrame) -> DataFrame:
    return error_category_counts(results).orderBy(F.desc("error_count"), "category")


def throughput(results: DataFrame, started: Column, ended: Column) -> DataFrame:
    """Files and megabytes per second between two timestamp aggregates or literals."""
    begin, end = (F.unix_micros(t.cast("timestamp")) for t in (started, ended))
    seconds = (end - begin) / 1e6
    size = F.coalesce(F.sum(F.when(F.col("file_size") > 0, F.col("file_size"))), F.lit(0))
    rate = F.when(seconds > 0, F.count("*") / seconds).otherwise(F.lit(0.0))
    megabytes = F.when(seconds > 0, size / (1024 * 1024) / seconds).otherwise(F.lit(0.0))
    return results.agg(
        F.count("*").alias("total_files_processed"),
        size.alias("total_bytes_processed"),
        seconds.alias("duration_seconds"),
        rate.alias("files_per_second"),
        megabytes.alias("mb_per_second"),
    )


def statistics_report(
    results: DataFrame, files_found: int | None = None, timing: dict[str, float] | None = None
) -> DataFrame:
    """The whole report in long form: (section, name, value), values as numbers.

    One pass over the results: each row is expanded into the counters it touches,
    and those are summed by name.  Percents and the average size follow from the sums.
    ``files_found`` comes from the listing (all result rows without one), ``timing`` from
    a measured run.
    """

    def counter(section: str, name: Column | str, value: Column) -> Column:
        label = F.lit(name) if isinstance(name, str) else name
        return F.struct(
            F.lit(section).alias("section"),
            label.alias("name"),
            value.cast("double").alias("value"),
        )

    single = F.array(
        counter("extraction_summary", "total_files_processed", F.lit(1)),
        counter("extraction_summary", "successful_extractions", succeeded().cast("int")),
        counter("extraction_summary", "failed_extractions", (~succeeded()).cast("int")),
        counter("data_summary", "total_bytes_processed", F.greatest("file_size", F.lit(0))),
        counter("data_summary", "sized_files", (F.col("file_size") > 0).cast("int")),
        counter("data_summary", "total_mappings_extracted", succeeded().cast("int")),
        counter("quality_metrics", "files_with_errors", (F.size("errors") > 0).cast("int")),
        counter("quality_metrics", "files_with_warnings", (F.size("warnings") > 0).cast("int")),
    )
    one = F.lit(1)
    grouped = F.when(
        succeeded(),
        F.array(
            counter("severity_distribution", F.col("severity"), one),
            counter("provider_distribution", F.col("provider"), one),
        ),
    ).otherwise(F.array().cast("array<struct<section:string,name:string,value:double>>"))
    patterns = F.transform(
        "matches", lambda m: counter("pattern_match_counts", m["pattern_name"], one)
    )
    errors = F.transform(
        "errors", lambda e: counter("error_categories", error_category(e), one)
    )
    counters = results.select(F.inline(F.concat(single, grouped, patterns, errors)))
    # Written once: the sums are listed, and the derived figures are made from them.
    sums = stage(counters.groupBy("section", "name").agg(F.sum("value").alias("value")), "report-sums")

    def total(name: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("name") == name, F.col("value"))), F.lit(0.0))

    processed = total("total_files_processed")
    found = processed if files_found is None else F.lit(float(files_found))
    derived = {
        ("extraction_summary", "total_files_found"): found,
        ("extraction_summary", "success_rate_percent"): F.round(_mean(total("successful_extractions") * 100, processed), 2),
        ("extraction_summary", "error_rate_percent"): F.round(_mean(total("failed_extractions") * 100, processed), 2),
        ("data_summary", "average_file_size_bytes"): F.round(_mean(total("total_bytes_processed"), total("sized_files")), 2),
    }
    derived |= {("timing", name): F.lit(float(value)) for name, value in (timing or {}).items()}
    fixed_names = ["total_files_processed", "successful_extractions", "failed_extractions", "total_bytes_processed", "sized_files"]
    # A handful of rows remain here: the sums that the derived figures need.
    needed = sums.filter(F.col("section").isin("extraction_summary", "data_summary") & F.col("name").isin(fixed_names))
    rows = [counter(section, name, value) for (section, name), value in derived.items()]
    return sums.unionByName(needed.agg(F.array(*rows).alias("rows")).select(F.inline("rows")))


def extraction_summary(resolved: DataFrame, conflicts: DataFrame, errors: DataFrame, limit: int = fixed.SUMMARY_LIST_LIMIT) -> DataFrame:
    """One row: counts, and the first conflicts and errors in file order.

    ``resolved`` is the state per identifier, ``conflicts`` the conflicting files and
    ``errors`` (file_path, error) the files that could not be processed.
    """

    def first(rows: DataFrame, fields: list[str], name: str) -> DataFrame:
        """Count of the rows and the first of them, sorted by at most ``limit`` rows a task."""
        order = path_key(F.col("file_path"))
        top = rows.select(order.alias("_order"), *fields).orderBy("_order").limit(limit)
        listed = F.transform(F.array_sort(F.collect_list(F.struct("_order", *fields))), lambda r: F.struct(*[r[f] for f in fields]))
        return top.agg(listed.alias(name))

    totals = resolved.agg(
        F.count("*").alias("total_mappings"),
        F.coalesce(F.sum("conflicting"), F.lit(0)).alias("duplicate_conflicts"),
    )
    failed = errors.agg(F.count("*").alias("processing_errors"))
    parts = [
        totals,
        failed,
        first(errors, ["file_path", "error"], "errors"),
        first(conflicts, ["checkov_id", "existing_severity", "new_severity", "file_path"], "conflicts"),
    ]
    joined = parts[0].withColumn("_one", F.lit(1))
    for part in parts[1:]:  # one row each
        joined = joined.join(part.withColumn("_one", F.lit(1)), "_one")
    return joined.drop("_one")
