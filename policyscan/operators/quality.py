"""Data-quality rules: issue rows and reports.

File-level rules read one result row and stay narrow.  Rules that look something
up in a database are joins.  Database rules are aggregates.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.frames import salted_join
from policyscan.functions.ids import is_strict_id, parse_severity
from policyscan.functions.paths import path_key

ISSUE = (
    "struct<level:string,code:string,message:string,file_path:string,"
    "checkov_id:string,context:string>"
)
ISSUES = f"array<{ISSUE}>"


def issue(
    level: str,
    code: str,
    message: Column | str,
    file_path: Column | None = None,
    checkov_id: Column | None = None,
) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(level).alias("level"),
        F.lit(code).alias("code"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
        (none if file_path is None else file_path).alias("file_path"),
        (none if checkov_id is None else checkov_id).alias("checkov_id"),
        none.alias("context"),
    ).cast(ISSUE)


def two_places(number: Column) -> Column:
    return F.format_number(number, 2)


def _present(*issues: Column) -> Column:
    return F.array_compact(F.array(*issues)).cast(ISSUES)


def structure_issues(path: Column, matches: Column, confidence: Column) -> Column:
    """NO_MATCHES, LOW_CONFIDENCE and TOO_MANY_MATCHES of one result row."""
    count = F.size(matches)
    return _present(
        F.when(
            count == 0,
            issue("WARNING", "NO_MATCHES", "No Checkov matches found in file", path),
        ),
        F.when(
            confidence < fixed.LOW_CONFIDENCE,
            issue(
                "WARNING",
                "LOW_CONFIDENCE",
                F.concat(F.lit("Low confidence score: "), two_places(confidence)),
                path,
            ),
        ),
        F.when(
            count > fixed.MANY_MATCHES,
            issue(
                "WARNING",
                "TOO_MANY_MATCHES",
                F.concat(
                    F.lit("Unusually high number of matches: "), count.cast("string")
                ),
                path,
            ),
        ),
    )


def match_issues(path: Column, match: Column) -> Column:
    """Rules on a single match: identifier, severity and confidence."""
    identifier, severity = match["checkov_id"], match["severity"]
    given = severity.isNotNull() & (severity != "")
    return _present(
        F.when(
            ~is_strict_id(identifier),
            issue(
                "ERROR",
                "INVALID_CHECKOV_ID",
                F.concat(F.lit("Invalid Checkov ID format: "), identifier),
                path,
                identifier,
            ),
        ),
        F.when(
            given & parse_severity(severity).isNull(),
            issue(
                "ERROR",
                "INVALID_SEVERITY",
                F.concat(F.lit("Invalid severity level: "), severity),
                path,
                identifier,
            ),
        ),
        F.when(
            ~given,
            issue(
                "WARNING",
                "MISSING_SEVERITY",
                "No severity found for Checkov ID",
                path,
                identifier,
            ),
        ),
        F.when(
            match["confidence"] < fixed.LOW_MATCH_CONFIDENCE,
            issue(
                "WARNING",
                "LOW_MATCH_CONFIDENCE",
                F.concat(F.lit("Low match confidence: "), two_places(match["confidence"])),
                path,
                identifier,
            ),
        ),
    )


def spread_issue(path: Column, low: Column, high: Column) -> Column:
    """HIGH_CONFIDENCE_VARIATION when the scores of a file lie far apart."""
    return F.when(
        high - low > fixed.CONFIDENCE_SPREAD,
        issue(
            "INFO",
            "HIGH_CONFIDENCE_VARIATION",
            F.concat(F.lit("High confidence variation: "), two_places(high - low)),
            path,
        ),
    )


def result_issues() -> Column:
    """All rules that need only the result row, in rule order.

    Matches of a result row are distinct by identifier, so the duplicate rules have
    nothing to find here; ``duplicate_issues`` covers tables of raw matches.
    """
    path, matches = F.col("path"), F.col("matches")
    scores = F.transform(matches, lambda m: m["confidence"])
    return F.concat(
        structure_issues(path, matches, F.col("confidence")),
        F.flatten(F.transform(matches, lambda m: match_issues(path, m))),
        _present(spread_issue(path, F.array_min(scores), F.array_max(scores))),
    )


def issue_rows(frame: DataFrame, issues: Column | str) -> DataFrame:
    """Explode an issues column into rows (level, code, message, file_path, …)."""
    return frame.select(F.explode(issues).alias("i")).select("i.*")


def duplicate_issues(matches: DataFrame) -> DataFrame:
    """Identifiers that occur more than once in one file of matches(path, …)."""
    levels = F.collect_set(F.when(F.col("severity") != "", F.col("severity")))
    repeated = (
        matches.groupBy("path", "checkov_id")
        .agg(F.count("*").alias("n"), F.sort_array(levels).alias("levels"))
        .filter(F.col("n") > 1)
    )
    path, identifier = F.col("path"), F.col("checkov_id")
    conflicting = issue(
        "ERROR",
        "CONFLICTING_SEVERITIES",
        F.concat(
            F.lit("Conflicting severities for "),
            identifier,
            F.lit(": "),
            F.array_join("levels", ", "),
        ),
        path,
        identifier,
    )
    plain = issue(
        "WARNING",
        "DUPLICATE_CHECKOV_ID",
        F.concat(F.lit("Duplicate Checkov ID found: "), identifier),
        path,
        identifier,
    )
    return repeated.select(
        F.when(F.size("levels") > 1, conflicting).otherwise(plain).alias("i")
    ).select("i.*")


def spread_issues(matches: DataFrame) -> DataFrame:
    """HIGH_CONFIDENCE_VARIATION over a table of matches(path, confidence)."""
    ranges = matches.groupBy("path").agg(
        F.min("confidence").alias("low"), F.max("confidence").alias("high")
    )
    found = spread_issue(F.col("path"), F.col("low"), F.col("high"))
    return issue_rows(ranges, _present(found))


def _new_id() -> Column:
    message = "New Checkov ID not in existing database"
    return issue("INFO", "NEW_CHECKOV_ID", message, F.col("path"), F.col("checkov_id"))


def _mismatch() -> Column:
    message = F.concat(
        F.lit("Severity mismatch: found "),
        F.col("severity"),
        F.lit(", database has "),
        F.col("existing_severity"),
    )
    return issue("WARNING", "SEVERITY_MISMATCH", message, F.col("path"), F.col("checkov_id"))


def database_match_issues(matches: DataFrame, database: DataFrame) -> DataFrame:
    """NEW_CHECKOV_ID and SEVERITY_MISMATCH of matches, from one join with the database.

    Only path, identifier and severity of the matches are moved.
    """
    stored = database.select("checkov_id", F.col("severity").alias("existing_severity"), F.lit(True).alias("known"))
    narrow = matches.select("path", "checkov_id", "severity")
    joined = salted_join(narrow, stored, "checkov_id", "path", "left")
    differs = (F.col("severity") != "") & (F.col("severity") != F.col("existing_severity"))
    unknown = F.col("known").isNull() & F.col("filled")
    joined = joined.withColumn("filled", database.select("checkov_id").exists())
    return issue_rows(joined, _present(F.when(unknown, _new_id()), F.when(differs, _mismatch())))


def new_id_issues(matches: DataFrame, database: DataFrame) -> DataFrame:
    """NEW_CHECKOV_ID for matches whose identifier is not in a non-empty database."""
    known = database.select("checkov_id")
    unknown = salted_join(matches, known, "checkov_id", "path", "left_anti").filter(known.exists())
    return unknown.select(_new_id().alias("i")).select("i.*")


def severity_mismatches(matches: DataFrame, database: DataFrame) -> DataFrame:
    """Matches whose severity differs from the one the database holds."""
    stored = database.select("checkov_id", F.col("severity").alias("existing_severity"))
    return salted_join(matches, stored, "checkov_id", "path").filter(
        (F.col("severity") != "") & (F.col("severity") != F.col("existing_severity"))
    )


def severity_mismatch_issues(matches: DataFrame, database: DataFrame) -> DataFrame:
    return severity_mismatches(matches, database).select(_mismatch().alias("i")).select("i.*")


# --- database rules -----------------------------------------------------------


def mapping_issues(mappings: DataFrame) -> DataFrame:
    """INVALID_DB_CHECKOV_ID and INVALID_DB_SEVERITY rows."""
    identifier, severity = F.col("checkov_id"), F.col("severity")
    return issue_rows(
        mappings,
        _present(
            F.when(
                ~is_strict_id(identifier),
                issue(
                    "ERROR",
                    "INVALID_DB_CHECKOV_ID",
                    F.concat(F.lit("Invalid Checkov ID in database: "), identifier),
                    checkov_id=identifier,
                ),
            ),
            F.when(
                ~_is_level(severity),
                issue(
                    "ERROR",
                    "INVALID_DB_SEVERITY",
                    F.concat(
                        F.lit("Invalid severity in database: "),
                        F.coalesce(severity, F.lit("None")),
                    ),
                    checkov_id=identifier,
                ),
            ),
        ),
    )


def _is_level(severity: Column) -> Column:
    return F.coalesce(severity.isin(fixed.SEVERITIES), F.lit(False))


def metadata_issues(
    mappings: DataFrame, version: str | None, expected_total: int | Column
) -> DataFrame:
    """MISSING_VERSION and COUNT_MISMATCH, from one count of the mappings."""
    counted = mappings.agg(F.count("*").alias("n"))
    return issue_rows(counted, _present(*_metadata_rules(F.col("n"), version, expected_total)))


def _metadata_rules(actual: Column, version, expected_total) -> list[Column]:
    expected = F.lit(expected_total) if isinstance(expected_total, int) else expected_total
    expected = expected.cast("bigint")
    return [
        F.when(
            F.lit(not version),
            issue("WARNING", "MISSING_VERSION", "Database missing version information"),
        ),
        F.when(
            expected != actual,
            issue(
                "ERROR",
                "COUNT_MISMATCH",
                F.concat(
                    F.lit("Metadata count mismatch: "),
                    expected.cast("string"),
                    F.lit(" vs "),
                    actual.cast("string"),
                ),
            ),
        ),
    ]


def _skew_rule(severity: Column, count: Column, total: Column) -> Column:
    share = count / total
    return F.when(
        share > fixed.SKEW_SHARE,
        issue(
            "INFO",
            "SKEWED_DISTRIBUTION",
            F.concat(
                F.lit("Severity "),
                severity,
                F.lit(" represents "),
                F.format_number(share * 100, 1),
                F.lit("% of all entries"),
            ),
        ),
    )


def _level_counts(mappings: DataFrame, *keys: str) -> DataFrame:
    """At most six rows (for each of ``keys``): files per level, anything else counted under NULL."""
    level = F.when(_is_level(F.col("severity")), F.col("severity"))
    return mappings.groupBy(*keys, level.alias("severity")).agg(
        F.count("*").alias("n"),
        F.count_if(~is_strict_id(F.col("checkov_id"))).alias("bad_ids"),
    )


def skew_issues(mappings: DataFrame) -> DataFrame:
    """SKEWED_DISTRIBUTION when one level holds more than 80 % of the mappings."""
    counts = _level_counts(mappings).filter(F.col("severity").isNotNull())
    gathered = counts.agg(
        F.collect_list(F.struct("severity", "n")).alias("levels"), F.sum("n").alias("total")
    )
    rules = F.transform(
        "levels", lambda level: _skew_rule(level["severity"], level["n"], F.col("total"))
    )
    return issue_rows(gathered, F.array_compact(rules).cast(ISSUES))


def report(issues: DataFrame, keys: list[str], confidence: Column) -> DataFrame:
    """is_valid, counts per level and a confidence for each target of issue rows."""
    return (
        issues.groupBy(*keys)
        .agg(
            F.count_if(F.col("level") == "ERROR").alias("error_count"),
            F.count_if(F.col("level") == "WARNING").alias("warning_count"),
            F.count_if(F.col("level") == "INFO").alias("info_count"),
            F.first(confidence).alias("confidence_score"),
        )
        .select(
            *keys,
            (F.col("error_count") == 0).alias("is_valid"),
            "error_count",
            "warning_count",
            "info_count",
            "confidence_score",
        )
    )


def issue_counts_of(issues: Column) -> dict[str, Column]:
    """Counts per level of an issues array, for reports that stay on one row."""
    return {
        f"{level.lower()}_count": count_level(issues, level)
        for level in ("ERROR", "WARNING", "INFO")
    }


def count_level(issues: Column, level: str) -> Column:
    return F.size(F.filter(issues, lambda i: i["level"] == level)).cast("bigint")


def result_report(results: DataFrame) -> DataFrame:
    """Report of every result row over its attached issues; narrow."""
    return (
        results.withColumns(issue_counts_of(F.col("validation_issues")))
        .withColumn("is_valid", F.col("error_count") == 0)
        .select(
            "path",
            "is_valid",
            "error_count",
            "warning_count",
            "info_count",
            F.col("confidence").alias("confidence_score"),
        )
    )


def match_report(results: DataFrame) -> DataFrame:
    """Report of every single match; narrow."""
    rows = results.select("path", F.posexplode("matches").alias("pos", "m")).withColumn(
        "issues", match_issues(F.col("path"), F.col("m"))
    )
    return (
        rows.withColumns(issue_counts_of(F.col("issues")))
        .withColumn("is_valid", F.col("error_count") == 0)
        .select(
            "path",
            (F.col("pos") + 1).alias("rank"),
            F.col("m.checkov_id").alias("checkov_id"),
            "is_valid",
            "error_count",
            "warning_count",
            "info_count",
            F.col("m.confidence").alias("confidence_score"),
        )
    )


def database_confidence(
    errors: Column, warnings: Column, infos: Column, complete_metadata: bool
) -> Column:
    score = (
        1.0
        - fixed.ERROR_PENALTY * errors
        - fixed.WARNING_PENALTY * warnings
        - fixed.INFO_PENALTY * infos
    )
    if complete_metadata:
        score = score + fixed.METADATA_BONUS
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def database_report(
    mappings: DataFrame,
    version: str | None,
    expected_total: int | Column,
    has_timestamp: bool = True,
) -> DataFrame:
    """Validate a whole database: one pass that counts the issues of every rule.

    Mapping rows are only counted, never gathered: partial aggregation brings them
    down to at most six rows before the metadata and skew rules look at the totals.
    """
    totals = _level_counts(mappings).agg(*_totals())
    missing_version, mismatch = _metadata_rules(F.col("total"), version, expected_total)
    return _counted_report(totals, [mismatch], [missing_version], bool(version) and has_timestamp)


def part_reports(mappings: DataFrame, part: Column, version: str | None, has_timestamp: bool = True) -> DataFrame:
    """Validate every part of a database by itself, say every provider's mappings.

    The rules are those of ``database_report`` but for the stated total, which only the
    whole database has.  At most six rows of a part are left after partial aggregation.
    """
    totals = _level_counts(mappings.withColumn("part", part), "part").groupBy("part").agg(*_totals())
    missing_version = _metadata_rules(F.col("total"), version, F.col("total"))[0]
    return _counted_report(totals, [], [missing_version], bool(version) and has_timestamp, "part")


def _totals() -> list[Column]:
    """Sums over the rows of ``_level_counts``."""
    level, n = F.col("severity"), F.col("n")
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("bad_ids"), F.lit(0)).alias("bad_ids"),
        F.coalesce(F.sum(F.when(level.isNull(), n)), F.lit(0)).alias("bad_levels"),
        F.coalesce(F.sum(F.when(level.isNotNull(), n)), F.lit(0)).alias("levelled"),
        F.coalesce(F.max(F.when(level.isNotNull(), n)), F.lit(0)).alias("largest"),
    ]


def _counted_report(
    totals: DataFrame, errors: list[Column], warnings: list[Column], complete_metadata: bool, *keys: str
) -> DataFrame:
    """Reports from ``_totals``; of the rules in ``errors`` and ``warnings`` those count that are not NULL."""

    def broken(rules: list[Column]) -> Column:
        return reduce(operator.add, [rule.isNotNull().cast("bigint") for rule in rules], F.lit(0).cast("bigint"))

    skewed = F.coalesce(
        F.try_divide("largest", "levelled") > fixed.SKEW_SHARE, F.lit(False)
    ).cast("bigint")
    counted = totals.select(
        *keys,
        "total",
        (F.col("bad_ids") + F.col("bad_levels") + broken(errors)).alias("error_count"),
        broken(warnings).alias("warning_count"),
        skewed.alias("info_count"),
    )
    return counted.select(
        *keys,
        (F.col("error_count") == 0).alias("is_valid"),
        "error_count",
        "warning_count",
        "info_count",
        database_confidence(
            F.col("error_count"), F.col("warning_count"), F.col("info_count"), complete_metadata
        ).alias("confidence_score"),
        F.col("total").alias("total_mappings"),
    )


def database_issues(
    mappings: DataFrame, version: str | None, expected_total: int | Column
) -> DataFrame:
    """All issue rows of a database."""
    return (
        metadata_issues(mappings, version, expected_total)
        .unionByName(mapping_issues(mappings))
        .unionByName(skew_issues(mappings))
    )


def integrity(mappings: DataFrame, expected_total: int | Column) -> DataFrame:
    """One row: the count agrees and every severity is a level."""
    expected = F.lit(expected_total) if isinstance(expected_total, int) else expected_total
    return mappings.agg(
        (
            (F.count("*") == expected)
            & (F.count_if(~_is_level(F.col("severity"))) == 0)
        ).alias("is_consistent")
    )


def validate_results(results: DataFrame, database: DataFrame | None = None) -> DataFrame:
    """Issue rows of all results, with database rules when a database is given."""
    rows = issue_rows(results, "validation_issues")
    if database is None:
        return rows
    matches = results.select("path", F.explode("matches").alias("m")).select("path", "m.checkov_id", "m.severity")
    return rows.unionByName(database_match_issues(matches, database))


def validate_matches(matches: DataFrame, database: DataFrame | None = None) -> DataFrame:
    """Issue rows of single matches(path, checkov_id, severity, confidence), with NEW_CHECKOV_ID when a database is given.

    The matches are then read twice.
    """
    match = F.struct("checkov_id", "severity", "confidence")
    rows = issue_rows(matches, match_issues(F.col("path"), match))
    return rows if database is None else rows.unionByName(new_id_issues(matches, database))
