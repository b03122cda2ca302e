"""Identifier and severity matching inside one document, as column expressions.

Nothing here shuffles.  A document's matches are an array built next to its text:
every regex runs over the whole text, positions are running sums over the gaps
between matches, and duplicates are removed by sorting, so the work stays close to
linear in the text and in the number of matches.

``text``, ``hits`` and ``severities`` are column names or SQL expressions.
"""

from __future__ import annotations

from itertools import takewhile

from pyspark.sql import Column
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.functions import sql
from policyscan.functions.ids import accept_sql
from policyscan.functions.text import context_sql
from policyscan.operators import anchors, finder
from policyscan.operators.patterns import REGEX_FLAGS, Pattern, resolve
from policyscan.operators.pieces import rows_of, split_at_matches

HIT = (
    "struct<checkov_id:string,confidence:double,start_position:int,end_position:int,"
    "context:string,pattern_name:string>"
)
HITS = f"array<{HIT}>"
_SPAN = "struct<id:string,start:int,stop:int,before:string,match:string,after:string>"


def _spans(text: str, pattern: Pattern) -> str:
    """Accepted matches of one pattern with up to 100 characters on both sides.

    The characters after a match come from a look-ahead group, so they are not
    consumed and the next match may start among them.
    """
    window = fixed.TABLE_WINDOW
    pieces = split_at_matches(
        text,
        f"{REGEX_FLAGS}{pattern.grouped}(?=(.{{0,{window}}}))",
        ["$0", "$1", f"${pattern.groups + 1}"],
    )
    before = f"right(concat(acc.state.tail, item.tail), {window})"
    start = "acc.state.stop + item.skip"
    stop = f"{start} + length(item.match)"
    span = sql.struct(
        id="item.id", start=start, stop=stop, before=before, match="item.match", after="item.after"
    )
    spans = sql.fold(
        rows_of(pieces, ["match", "id", "after"], window),
        sql.struct(stop="0", tail="''"),
        _SPAN,
        sql.struct(stop=stop, tail=f"right(concat({before}, item.match), {window})"),
        f"CASE WHEN {accept_sql('item.id')} THEN array({span})"
        f" ELSE {sql.empty(f'array<{_SPAN}>')} END",
    )
    return f"slice({spans}, 1, 1)" if pattern.first_match_only else spans


def match_contexts(text: str, regex: str) -> Column:
    """Every match of ``regex`` (without groups), in text order: array of match, start_position, context."""
    window = fixed.CONTEXT_WINDOW
    pieces = split_at_matches(text, f"{REGEX_FLAGS}({regex})(?=((?s:.{{0,{window}}})))", ["$1", "$2"])
    before = f"right(concat(acc.state.tail, item.tail), {window})"
    start = "acc.state.stop + item.skip"
    found = sql.struct(match="item.match", start_position=start, context=context_sql(before, "item.match", "item.after"))
    return F.expr(
        sql.fold(
            rows_of(pieces, ["match", "after"], window),
            sql.struct(stop="0", tail="''"),
            "struct<match:string,start_position:int,context:string>",
            sql.struct(stop=f"{start} + length(item.match)", tail=f"right(concat({before}, item.match), {window})"),
            f"array({found})",
        )
    )


def _confidence(pattern: Pattern, surroundings: str) -> str:
    """Score of an accepted match; a table nearby raises it."""
    plain, boosted = pattern.confidence(False), pattern.confidence(True)
    if plain == boosted:
        return sql.double(plain)
    return sql.bind(
        surroundings,
        "around",
        "CASE WHEN contains(around, '|') OR contains(lower(around), 'table')"
        f" THEN {sql.double(boosted)} ELSE {sql.double(plain)} END",
    )


def _hits_of(spans: str, pattern: Pattern, confidence: str, contexts: bool) -> str:
    hit = sql.struct(
        checkov_id="s.id",
        confidence=confidence,
        start_position="s.start",
        end_position="s.stop",
        context=context_sql("s.before", "s.match", "s.after") if contexts else "CAST(NULL AS STRING)",
        pattern_name=sql.string(pattern.name),
    )
    return f"transform({spans}, s -> {hit})"


def _pattern_hits(text: str, pattern: Pattern, contexts: bool) -> str:
    """Accepted matches of one identifier pattern, in text order."""
    around = "concat(s.before, s.match, s.after)"
    found = _hits_of(_spans(text, pattern), pattern, _confidence(pattern, around), contexts)
    return _where_needed(text, pattern, found, sql.empty(HITS))


def _anchored_hits(text: str, pattern: Pattern, contexts: bool) -> str:
    """The same from the anchors of the text, bound as ``anchors``."""
    boosted = sql.double(pattern.confidence(True))
    around = "concat(s.before, s.match, s.after)"
    confidence = boosted if anchors.in_table(pattern) else _confidence(pattern, around)
    return _hits_of(anchors.spans_sql(text, "anchors", pattern), pattern, confidence, contexts)


def _captured(text: str, pattern: Pattern) -> str:
    if pattern.whole_words:
        return f"regexp_extract_all({text}, {sql.string(pattern.whole_words)}, 0)"
    return f"regexp_extract_all({text}, {sql.string(pattern.regex)}, 1)"


def _where_needed(text: str, pattern: Pattern, found: str, otherwise: str) -> str:
    """Skip the regex for texts without the literal that every match contains."""
    if not pattern.needs:
        return found
    needed = f"contains({text}, {sql.string(pattern.needs)})"
    return f"CASE WHEN {needed} THEN {found} ELSE {otherwise} END"


def _all_hits(text: str, patterns: list[Pattern], bound: bool = False, contexts: bool = True) -> str:
    """Hits of all patterns in their order; known ones share one scan of the text.

    ``bound``: the anchors of the text already stand under their name.  ``contexts``: with
    the readable surroundings of every hit, else NULL.
    """
    known = [p for p in patterns if anchors.shape(p)]
    found = ", ".join(
        _anchored_hits(text, p, contexts) if p in known else _pattern_hits(text, p, contexts) for p in patterns
    )
    hits = f"CAST(concat({found}) AS {HITS})" if found else sql.empty(HITS)
    return sql.bind(anchors.anchors_sql(text, known), "anchors", hits) if known and not bound else hits


def all_known(patterns: list[Pattern]) -> bool:
    """Whether the identifier patterns all hang on anchors, so that ``finder`` seeks them in batches."""
    return bool(patterns) and all(anchors.shape(p) for p in patterns)


def all_cells(patterns: list[Pattern]) -> bool:
    """The same of the severity patterns."""
    return bool(patterns) and all(finder.known_level(p) for p in patterns)


def _first_per_id(items: str) -> str:
    first = "i = 0 OR x.id <> get(items, i - 1).id"
    return sql.bind(items, "items", f"filter(items, (x, i) -> {first})")


def _distinct(hits: str) -> str:
    """One hit per identifier: the most confident, on a tie the first found.

    The result keeps the order in which identifiers were first found.  Sorting
    twice (by score within an identifier, by sequence within an identifier) lines
    both answers up without comparing all pairs.
    """
    scored = sql.struct(id="h.checkov_id", score="-h.confidence", seq="i", hit="h")
    placed = sql.struct(id="h.checkov_id", seq="i")
    by_score = _first_per_id(f"array_sort(transform(found, (h, i) -> {scored}))")
    by_sequence = _first_per_id(f"array_sort(transform(found, (h, i) -> {placed}))")
    zipped = f"zip_with({by_score}, {by_sequence}, (x, y) -> {sql.struct(slot='y.seq', hit='x.hit')})"
    distinct = f"transform(array_sort({zipped}), p -> p.hit)"
    return sql.bind(hits, "found", f"CASE WHEN size(found) <= 1 THEN found ELSE {distinct} END")


def _ranked(hits: str) -> str:
    """Most confident first; equal scores keep their order."""
    keyed = sql.struct(score="-h.confidence", slot="i", hit="h")
    return f"transform(array_sort(transform({hits}, (h, i) -> {keyed})), k -> k.hit)"


def all_hits(text: str, patterns: str | list[Pattern] = "config") -> Column:
    """Accepted matches of every identifier pattern, strongest pattern first."""
    ids = resolve(patterns)["id"]
    return finder.find_hits(text, ids, True, False, HITS) if all_known(ids) else F.expr(_all_hits(text, ids))


def dedup_hits(hits: str) -> Column:
    """One hit per identifier, in the order of first sighting."""
    return F.expr(_distinct(hits))


def rank_hits(hits: str) -> Column:
    """Hits by confidence."""
    return F.expr(_ranked(hits))


def find_ids(text: str, patterns: str | list[Pattern] = "config", contexts: bool = True) -> Column:
    """Distinct accepted identifiers of a text, best first."""
    ids = resolve(patterns)["id"]
    if all_known(ids):
        return finder.find_hits(text, ids, contexts, True, HITS)
    return F.expr(_ranked(_distinct(_all_hits(text, ids, contexts=contexts))))


def severities_sql(text: str, patterns: str | list[Pattern] = "config") -> str:
    levels = ", ".join(sql.string(s) for s in fixed.SEVERITIES)
    found = []
    for pattern in resolve(patterns)["severity"]:
        upper = f"transform({_captured(text, pattern)}, s -> upper(s))"
        valid = f"filter({upper}, s -> s IN ({levels}))"
        if pattern.first_level_only:
            valid = f"slice({valid}, 1, 1)"
        found.append(_where_needed(text, pattern, valid, sql.empty("array<string>")))
    if not found:
        return sql.empty("array<string>")
    return f"array_distinct(concat({', '.join(found)}))"


def find_severities(text: str, patterns: str | list[Pattern] = "config") -> Column:
    """Distinct valid levels of a text in the order they were found."""
    levels = resolve(patterns)["severity"]
    return finder.find_levels(text, levels) if all_cells(levels) else F.expr(severities_sql(text, patterns))


def in_batches(patterns: str | list[Pattern] = "config") -> bool:
    """Whether texts are matched in batches of their own, so that one transfer serves all searches."""
    by_kind = resolve(patterns)
    return all_known(by_kind["id"]) and all_cells(by_kind["severity"])


def search_texts(
    text: str, patterns: str | list[Pattern] = "config", contexts: bool = True, ranked: bool = True, levels: bool = True
) -> Column:
    """``finder.search`` of patterns that are matched in batches, in one reading of the text."""
    if not in_batches(patterns):
        raise ValueError("patterns that are not all known are not matched in batches")
    by_kind = resolve(patterns)
    return finder.search(text, by_kind["id"], by_kind["severity"] if levels else [], contexts, ranked, HITS)


def overall_confidence(hits: Column, severities: Column) -> Column:
    """Score of a document from its ranked hits and its severities."""
    n, m = F.size(hits), F.size(severities)
    best = F.get(hits, F.lit(0))["confidence"]
    penalty = (1.0 - (n - 1) * fixed.AMBIGUITY_STEP) * (1.0 - (m - 1) * fixed.AMBIGUITY_STEP)
    return (
        F.when((n == 0) | (m == 0), F.lit(0.0))
        .when((n == 1) & (m == 1), F.least(F.lit(1.0), best * fixed.SINGLE_PAIR_BOOST))
        .otherwise(F.greatest(F.lit(0.0), best * penalty))
    )


def top_id_sql(text: str, patterns: str | list[Pattern] = "config") -> str:
    """Identifier of the best hit, without positions where the score needs none.

    A pattern whose score cannot be beaten decides by its first accepted id; only
    texts without such a match take the full ranking.
    """
    ids = resolve(patterns)["id"]
    certain = list(takewhile(lambda p: p.confidence(False) >= 1.0, ids))
    known = [p for p in ids if anchors.shape(p)]
    first = [
        f"get({anchors.matches_sql('anchors', p)}, 0).id"
        if anchors.shape(p)
        else _where_needed(text, p, f"get(filter({_captured(text, p)}, c -> {accept_sql('c')}), 0)", "NULL")
        for p in certain
    ]
    ranked = _ranked(_distinct(_all_hits(text, ids[len(certain) :], bound=bool(known), contexts=False)))
    best = f"coalesce({', '.join([*first, f'get({ranked}, 0).checkov_id'])})"
    return sql.bind(anchors.anchors_sql(text, known), "anchors", best) if known else best
