"""From documents to result rows: pairing, primary mapping, gates and issues.

``process_documents`` is a narrow transformation: one result row per document, no
shuffle, texts dropped as soon as they have been matched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.frames import compute_once
from policyscan.functions import sql
from policyscan.functions.ids import parse_id, parse_severity
from policyscan.functions.text import let, process_gate, sha256_16
from policyscan.operators.matching import (
    HITS,
    find_ids,
    find_severities,
    in_batches,
    overall_confidence,
    search_texts,
    severities_sql,
    top_id_sql,
)
from policyscan.operators.patterns import Pattern
from policyscan.operators.pieces import rows_of, split_at_matches
from policyscan.operators.quality import ISSUES, result_issues

MATCH = (
    "struct<checkov_id:string,severity:string,confidence:double,start_position:int,"
    "end_position:int,context:string,pattern_name:string>"
)
MATCHES = f"array<{MATCH}>"
_OCCURRENCE = "struct<position:int,level:int>"


def level_occurrences_sql(text: str, severities: str) -> str:
    """(position, index of level) of every word of ``severities`` in the text, in any case.

    The text is searched for the levels it has alone, one after the other by the word's
    first letter; only that letter is consumed, so words that overlap all count.
    """
    names = ", ".join(sql.string(s) for s in fixed.SEVERITIES)
    word = "concat(left(lower(sought), 1), '(?=', substring(lower(sought), 2), ')')"
    place = sql.struct(position="acc.state + item", level="turn")
    none = sql.empty(f"array<{_OCCURRENCE}>")
    places = sql.bind(
        f"split(lowered, {word}, -1)",
        "between",
        sql.fold(
            "transform(slice(between, 1, size(between) - 1), gap -> length(gap))",
            "0",
            _OCCURRENCE,
            "acc.state + item + 1",
            f"array(CAST({place} AS {_OCCURRENCE}))",
        ),
    )
    known = f"sought IN ({names}) AND array_position({severities}, sought) = turn + 1"
    each = f"transform({severities}, (sought, turn) -> CASE WHEN {known} THEN {places} ELSE {none} END)"
    found = sql.bind(f"lower({text})", "lowered", f"array_sort(flatten({each}))")
    return f"CASE WHEN {text} IS NOT NULL AND size({severities}) > 0 THEN {found} ELSE {none} END"


def level_occurrences(text: str, severities: str) -> Column:
    return F.expr(level_occurrences_sql(text, severities))


_SEEN = "struct<position:int,level:int>"
_CHOICE = "struct<hit:int,distance:int,level:int>"


def _closest_sql(starts: str, occurrences: str, forward: bool) -> str:
    """Per hit, in hit order: distance and level of the closest occurrence on one side.

    Hits and occurrences are merged by position and swept once; an occurrence at a hit's
    start counts on both sides.  Hits without one have a NULL level.
    """
    sign = "" if forward else "-"
    none = "CAST(NULL AS INT)"
    def event(position: str, later: int, value: str) -> str:
        return sql.struct(position=f"CAST({sign}{position} AS INT)", later=str(later), level=f"CAST({value} AS INT)")

    merged = (
        f"array_sort(concat(transform({occurrences}, o -> {event('o.position', 0, 'o.level')}),"
        f" transform({starts}, (p, n) -> {event('p', 1, 'n')})))"
    )
    seen = f"CAST({sql.struct(position='item.position', level='item.level')} AS {_SEEN})"
    chosen = sql.struct(
        hit="item.level",
        distance="CASE WHEN acc.state.level IS NULL THEN 2147483647 ELSE abs(item.position - acc.state.position) END",
        level="acc.state.level",
    )
    swept = sql.fold(
        merged,
        f"CAST({sql.struct(position=none, level=none)} AS {_SEEN})",
        _CHOICE,
        f"CASE WHEN item.later = 0 THEN {seen} ELSE acc.state END",
        f"CASE WHEN item.later = 1 THEN array(CAST({chosen} AS {_CHOICE})) ELSE {sql.empty(f'array<{_CHOICE}>')} END",
    )
    return f"array_sort({swept})"


def _nearest_levels_sql(hits: str, occurrences: str) -> str:
    """Level (as an index) closest to every hit's start, NULL without occurrences.

    Two sweeps over hits and occurrences together, so time grows with their sum.
    """
    starts = f"transform({hits}, h -> h.start_position)"
    pair = sql.struct(d="c.distance", level="c.level")
    other = sql.struct(d="back[n].distance", level="back[n].level")
    return sql.bind(
        _closest_sql(starts, occurrences, forward=False),
        "back",
        f"transform({_closest_sql(starts, occurrences, forward=True)}, (c, n) -> least({pair}, {other}).level)",
    )


def nearest_severities(hits: str, occurrences: str, severities: str) -> Column:
    """(checkov_id, severity) per hit: the level written closest to the hit's start.

    Ties go to the earlier level.
    """
    pair = sql.struct(
        checkov_id="h.checkov_id",
        severity=f"get({severities}, coalesce(levels[i], 0))",
    )
    return F.expr(
        sql.bind(_nearest_levels_sql(hits, occurrences), "levels", f"transform({hits}, (h, i) -> {pair})")
    )


def pair_severities(hits: str, severities: str, text: str, turns: str | None = None) -> Column:
    """Give every ranked hit a severity.

    Hit i takes severity i; with a single severity all hits take it; any other hit
    takes the level written closest to it.  ``turns`` (``finder.search``) tells them where
    the text was read in a batch; it is not searched again then.
    """

    def match(severity: str) -> str:
        rest = ("confidence", "start_position", "end_position", "context", "pattern_name")
        return sql.struct(
            checkov_id="h.checkov_id", severity=severity, **{n: f"h.{n}" for n in rest}
        )

    place = f"coalesce(get({turns}, i), i)" if turns else "i"
    turn = f"get({severities}, CASE WHEN size({severities}) = 1 THEN 0 ELSE {place} END)"
    in_order = f"transform({hits}, (h, i) -> {match(turn)})"
    if turns:
        return F.expr(in_order)
    nearest = f"get({severities}, coalesce(levels[i], 0))"
    either = f"CASE WHEN i < size({severities}) THEN get({severities}, i) ELSE {nearest} END"
    by_distance = sql.bind(
        sql.bind(
            level_occurrences_sql(text, severities), "places", _nearest_levels_sql(hits, "places")
        ),
        "levels",
        f"transform({hits}, (h, i) -> {match(either)})",
    )
    simple = f"size({severities}) < 2 OR size({hits}) <= size({severities})"
    return F.expr(f"CASE WHEN {simple} THEN {in_order} ELSE {by_distance} END")


def primary_mapping(results: DataFrame) -> DataFrame:
    """Add the best match's raw and parsed identifier and severity."""
    best = F.get("matches", F.lit(0))
    return results.withColumns(
        {
            "raw_checkov_id": best["checkov_id"],
            "raw_severity": best["severity"],
            "parsed_id": parse_id(best["checkov_id"]),
            "severity": parse_severity(best["severity"]),
        }
    ).withColumn("checkov_id", F.col("parsed_id.full_id"))


RESULT_COLUMNS = [
    "path",
    "checkov_id",
    "severity",
    "raw_checkov_id",
    "raw_severity",
    "matches",
    "errors",
    "warnings",
    "confidence",
    "content_hash",
    "validation_issues",
    "provider",
]


def gated_searches(
    documents: DataFrame,
    patterns: str | list[Pattern] = "config",
    min_content_length: int = fixed.MIN_CONTENT_LENGTH,
    contexts: bool = True,
    ranked: bool = True,
    levels: bool = True,
) -> DataFrame:
    """Documents with NULL for texts that fail the gate; ``hits``, ``severities`` and ``_turns`` of the others.

    For patterns that are matched in batches: a text is moved and read once for gate and
    searches, and one that fails the gate keeps empty arrays.  ``ranked`` as in ``find_ids``, else
    all hits as in ``all_hits``; without ``levels`` no severities are sought.
    """
    found = search_texts("content", patterns, contexts, ranked, levels)
    passed = process_gate(F.col("content"), min_content_length, found["plain"], found["topical"])
    searched = compute_once(
        documents,
        content=F.when(passed, F.col("content")),
        hits=found["hits"],
        severities=found["severities"],
        _turns=found["turns"],
    )
    kept = F.col("content").isNotNull()
    kinds = {"hits": HITS, "severities": "array<string>", "_turns": "array<int>"}
    return searched.withColumns(
        {name: F.when(kept, F.col(name)).otherwise(F.array().cast(kind)) for name, kind in kinds.items()}
    )


def process_documents(
    documents: DataFrame,
    patterns: str | list[Pattern] = "config",
    min_content_length: int = fixed.MIN_CONTENT_LENGTH,
    validate: bool = True,
    matcher: Callable[[DataFrame], DataFrame] | None = None,
    validator: Callable[[DataFrame], Column] | None = None,
    contexts: bool = True,
    hashes: bool = True,
) -> DataFrame:
    """One result row per document(path, content, …).

    Documents that fail the gate stay as empty rows: no matches, confidence 0,
    empty hash, no issues.  ``matcher`` replaces the regex matcher: it adds
    ``hits`` and ``severities`` to the documents it is given.  ``validator``
    replaces the issue rules: it returns the issues column.  Other columns of the
    documents are passed through.  Spark cannot prune what is computed behind a generator,
    so callers that only count leave out ``contexts`` and ``hashes``: both are then NULL
    (the hash of documents that fail the gate stays empty).
    """
    turns = None
    if matcher is None and in_batches(patterns):
        turns = "_turns"
        found = gated_searches(documents, patterns, min_content_length, contexts)
    else:
        passed = process_gate(F.col("content"), min_content_length)
        # The matcher sees NULL for gated-out texts, so their regexes never run.
        gated = compute_once(documents, content=F.when(passed, F.col("content")))
        if matcher:
            found = matcher(gated)
        else:
            found = compute_once(
                gated,
                hits=find_ids("content", patterns, contexts),
                severities=find_severities("content", patterns),
            )
    text, hits, severities = F.col("content"), F.col("hits"), F.col("severities")
    matched = compute_once(
        found,
        matches=F.coalesce(
            pair_severities("hits", "severities", "content", turns), F.array().cast(MATCHES)
        ),
        confidence=F.coalesce(overall_confidence(hits, severities), F.lit(0.0)),
        content_hash=F.when(text.isNull(), "").otherwise(sha256_16(text) if hashes else F.lit(None).cast("string")),
    ).drop("content", "hits", "severities", "_turns")
    results = primary_mapping(matched).withColumns(
        {
            "errors": F.array().cast("array<string>"),
            "warnings": F.array().cast("array<string>"),
            "provider": F.col("parsed_id.provider"),
        }
    )
    none = F.array().cast(ISSUES)
    rules = none
    if validate:
        rules = validator(results) if validator else result_issues()
    checked = compute_once(
        results,
        validation_issues=F.when(~F.col("content_hash").eqNullSafe(""), rules).otherwise(none),
    )
    extra = [c for c in documents.columns if c not in ("path", "content")]
    return checked.select(*RESULT_COLUMNS, *extra)


def found_mappings(
    documents: DataFrame,
    patterns: str | list[Pattern] = "config",
    min_content_length: int = fixed.MIN_CONTENT_LENGTH,
) -> DataFrame:
    """(path, checkov_id, severity) of every document that yields a mapping.

    The short way to the mapping table: the primary mapping is the best identifier
    with the first severity, so no pairing, context or issue is computed, and texts
    without a severity are left before their identifiers are ranked.
    """
    mapping = F.expr(
        sql.bind(
            f"get({severities_sql('content', patterns)}, 0)",
            "severity",
            "CASE WHEN severity IS NOT NULL THEN "
            + sql.struct(raw=top_id_sql("content", patterns), severity="severity")
            + " END",
        )
    )
    none = F.array().cast("array<struct<checkov_id:string,severity:string>>")

    def parsed(pair: Column) -> Column:
        return let(
            parse_id(pair["raw"])["full_id"],
            lambda full: F.when(
                full.isNotNull(),
                F.array(F.struct(full.alias("checkov_id"), pair["severity"].alias("severity"))),
            ).otherwise(none),
        )

    gate = process_gate(F.col("content"), min_content_length)
    return documents.select("path", F.inline(F.when(gate, let(mapping, parsed)).otherwise(none)))


def result_mappings(results: DataFrame) -> DataFrame:
    """(path, checkov_id, severity) of the successful result rows."""
    return results.filter(
        F.col("checkov_id").isNotNull() & F.col("severity").isNotNull()
    ).select("path", "checkov_id", "severity")


def result_flags(results: DataFrame) -> DataFrame:
    """success / has_errors / has_warnings per result row."""
    return results.select(
        "path",
        (F.col("checkov_id").isNotNull() & F.col("severity").isNotNull()).alias("success"),
        (F.size("errors") > 0).alias("has_errors"),
        (F.size("warnings") > 0).alias("has_warnings"),
    )


def exploded_matches(results: DataFrame) -> DataFrame:
    """One row per match: path, rank (from 1) and the match's fields."""
    return results.select("path", F.posexplode("matches").alias("pos", "m")).select(
        "path", (F.col("pos") + 1).alias("rank"), "m.*"
    )
