"""The identifier-to-severity table: resolving, comparing and maintaining it.

``found`` is a table of (path, checkov_id, severity), one row per successful file;
``mappings`` is (checkov_id, severity) with distinct identifiers.  Files are ordered
by path components.  One identifier may own a large share of the files, so every
grouping here uses aggregates that combine before the shuffle; only ``conflicts``
joins rows back, with the rows of an identifier salted over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.frames import salted_join
from policyscan.functions.ids import severity_rank
from policyscan.functions.paths import path_key


def first_wins(found: DataFrame) -> DataFrame:
    """Severity of every identifier from its first file."""
    return found.groupBy("checkov_id").agg(
        F.min_by("severity", path_key(F.col("path"))).alias("severity")
    )


def conflicts(found: DataFrame) -> DataFrame:
    """Files whose severity differs from the one their identifier got first.

    Reads ``found`` twice: pass a stored table rather than a query over the texts.
    """
    first = first_wins(found).withColumnRenamed("severity", "existing_severity")
    return (
        salted_join(found, first, "checkov_id", "path")
        .filter(F.col("severity") != F.col("existing_severity"))
        .select(
            "checkov_id",
            "existing_severity",
            F.col("severity").alias("new_severity"),
            F.col("path").alias("file_path"),
        )
    )


def first_conflicts(found: DataFrame, limit: int = fixed.SUMMARY_LIST_LIMIT) -> DataFrame:
    """The first conflicts in file order, for the summary."""
    return conflicts(found).orderBy(path_key(F.col("file_path"))).limit(limit)


def resolved(found: DataFrame) -> DataFrame:
    """Per identifier: its severity, its first file, the files that agree with it and
    the files that do not.  Two combining aggregates, no join."""
    order = path_key(F.col("path"))
    per_level = found.groupBy("checkov_id", "severity").agg(
        F.count("*").alias("n"), F.min(order).alias("first_file")
    )
    winner = F.min_by(F.struct("severity", "n"), F.col("first_file"))
    return (
        per_level.groupBy("checkov_id")
        .agg(
            winner.alias("winner"),
            F.min("first_file").alias("first_file"),
            F.sum("n").alias("files"),
        )
        .select(
            "checkov_id",
            "winner.severity",
            "first_file",
            F.col("winner.n").alias("agreeing"),
            (F.col("files") - F.col("winner.n")).alias("conflicting"),
        )
    )


def extraction_stats(found: DataFrame) -> DataFrame:
    """Files per severity, conflicting files left out (counts files, not identifiers)."""
    return (
        resolved(found)
        .groupBy("severity")
        .agg(F.sum("agreeing").alias("file_count"))
    )


def assemble(
    found: DataFrame,
    version: str = fixed.DATABASE_VERSION,
    generator_version: str = fixed.GENERATOR_VERSION,
) -> DataFrame:
    """The metadata row of the database that ``found`` resolves to."""
    per_level = (
        resolved(found)
        .groupBy("severity")
        .agg(F.count("*").alias("ids"), F.sum("agreeing").alias("files"))
    )
    # At most five rows are left when they are gathered into the counts.
    return per_level.agg(
        F.lit(version).alias("version"),
        F.coalesce(F.sum("ids"), F.lit(0)).alias("total_mappings"),
        F.lit(generator_version).alias("generator_version"),
        F.coalesce(F.sum("files"), F.lit(0)).alias("stats_total"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("severity", "files")))).alias(
            "severity_counts"
        ),
    )


# --- look-ups and maintenance -------------------------------------------------


def get(mappings: DataFrame, checkov_id: str) -> DataFrame:
    return mappings.filter(F.col("checkov_id") == checkov_id)


def with_severity(mappings: DataFrame, severity: str) -> DataFrame:
    return mappings.filter(F.col("severity") == severity)


def with_provider(mappings: DataFrame, provider: str) -> DataFrame:
    return mappings.filter(F.contains("checkov_id", F.lit(f"_{provider.upper()}_")))


def new_to(mappings: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of ``others`` whose identifier is not mapped yet."""
    return others.select("checkov_id", "severity").join(
        mappings.select("checkov_id"), "checkov_id", "left_anti"
    )


def merge(mappings: DataFrame, others: DataFrame) -> DataFrame:
    """Add the identifiers that are absent; existing severities stay."""
    return mappings.select("checkov_id", "severity").unionByName(new_to(mappings, others))


def add(mappings: DataFrame, checkov_id: str, severity: str) -> DataFrame:
    """Add one mapping unless its identifier is present."""
    row = mappings.sparkSession.createDataFrame(
        [(checkov_id, severity)], "checkov_id string, severity string"
    )
    return merge(mappings, row)


def remove(mappings: DataFrame, removed: DataFrame) -> DataFrame:
    """Drop the identifiers listed in ``removed``."""
    return mappings.join(removed.select("checkov_id"), "checkov_id", "left_anti")


def new_mappings(matches: DataFrame, mappings: DataFrame) -> DataFrame:
    """Matched (identifier, severity) pairs the database lacks, with their first file.

    Repeats are combined before the database is looked at.
    """
    pairs = (
        matches.filter(F.col("severity").isNotNull() & (F.col("severity") != ""))
        .groupBy("checkov_id", "severity")
        .agg(F.min_by("path", path_key(F.col("path"))).alias("file_path"))
    )
    return pairs.join(mappings.select("checkov_id"), "checkov_id", "left_anti")


# --- statistics of a mapping table --------------------------------------------


def severity_counts(mappings: DataFrame) -> DataFrame:
    return mappings.groupBy("severity").agg(F.count("*").alias("mapping_count"))


def severity_percentages(mappings: DataFrame) -> DataFrame:
    """Share of each severity.  Five rows remain when the total is attached."""
    counts = severity_counts(mappings)
    return counts.groupBy().agg(
        F.collect_list(F.struct("severity", "mapping_count")).alias("rows"),
        F.sum("mapping_count").alias("total"),
    ).select("total", F.inline("rows")).select(
        "severity",
        "mapping_count",
        (F.col("mapping_count") / F.col("total") * 100).alias("percentage"),
    )


def most_common_severity(found: DataFrame) -> DataFrame:
    """The severity with the most mappings; on a tie the one that came first."""
    return (
        resolved(found)
        .groupBy("severity")
        .agg(F.count("*").alias("mapping_count"), F.min("first_file").alias("first_file"))
        .orderBy(F.desc("mapping_count"), "first_file")
        .limit(1)
        .select("severity", "mapping_count")
    )


def distribution(mappings: DataFrame) -> DataFrame:
    """Severity shares, most severe first."""
    return severity_percentages(mappings).orderBy(severity_rank(F.col("severity")).desc())


def confidence_metrics(mappings: DataFrame, version: str | None, has_timestamp: bool) -> DataFrame:
    return mappings.agg(
        F.lit(bool(version)).alias("has_metadata"),
        F.lit(has_timestamp).alias("has_timestamps"),
        F.when(F.count("*") > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("completeness_score"),
    )


def label_providers(ids: DataFrame, parsed: Column) -> DataFrame:
    """Attach id type and provider to rows and tell whether the provider is a known one.

    The provider list is a fixed 21-row table, so it is broadcast.
    """
    known = ids.sparkSession.createDataFrame(
        [(name, code) for name, code in fixed.PROVIDERS.items()],
        "provider_name string, provider string",
    )
    parts = ids.withColumns(
        {"id_type": parsed["type"], "provider": parsed["provider"]}
    )
    return parts.join(F.broadcast(known), "provider", "left").withColumn(
        "is_known", F.col("provider_name").isNotNull()
    )
