"""The anchors of ``operators.anchors`` sought in whole Arrow batches of texts.

Array functions of SQL are interpreted for every text and step, which cost several times
the search itself.  Where all patterns hang on anchors, a text goes to Python once: its
anchors are found by plain substring search, and only what stands at them is looked at.
Hits equal those of ``anchors.spans_sql``.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.functions import text as text_functions
from policyscan.operators import anchors
from policyscan.operators.patterns import Pattern

# Workers get this module's functions by value and need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WORDS = "Checkov ID"
_WORD_BYTES = _WORDS.encode()
_MIN_LENGTH = fixed.MIN_ID_LENGTH
# Unicode's white space: what Java's \s means, without U+001C to U+001F of Python's.
_SPACE = r"[^\S\x1c-\x1f]"
_HEAD = re.compile(rf"({_SPACE}*+:?+{_SPACE}*+\|?+{_SPACE}*+(?:https?://)?+)([A-Z0-9_]*+)")
_BRACKET = re.compile(r"\[([A-Z0-9_]++)\]")
_TYPES = {
    "checkov_id": pa.string(),
    "confidence": pa.float64(),
    "start_position": pa.int32(),
    "end_position": pa.int32(),
    "context": pa.string(),
    "pattern_name": pa.string(),
}
_LEVELS = frozenset(fixed.SEVERITIES)
_LEVEL_CELLS = {p: "|Severity" for _, p, _ in fixed.CONFIG_PATTERNS if p.startswith(r"\|Severity\s*")}
_RUNS = re.compile(r"\s+")
_ACCEPTED = re.compile("|".join(p.replace("(?U)", "") for p in (fixed.LOOSE_ID, fixed.STRICT_ID)), re.ASCII)


def found_in(text: str):
    """(shape, id, start, stop) of every accepted match of every shape, by its end."""
    words, opened = text.find(_WORDS), text.find("[")
    pending: dict[str, int] = {}  # where earlier words began that the next bracketed token completes
    ends = dict.fromkeys(("cell_lines", "cell", "field_lines", "field"), 0)
    while words >= 0 or opened >= 0:
        if opened < 0 or 0 <= words < opened:
            start, stop = words, words + len(_WORDS)
            at = _HEAD.match(text, stop)
            head, token = at.groups()
            lead, border, _ = head.partition("|")
            url = head.endswith("://")
            table = border and start > 0 and text[start - 1] == "|" and ":" not in lead
            lines = "\n" in lead
            if table and lines:
                pending.setdefault("any_link", start - 1)
                if url:
                    pending.setdefault("link", start - 1)
            if token and not url:
                kinds = ()
                if table:
                    kinds = ("cell_lines", "cell") if lines else ("cell",)
                elif not border:
                    kinds = ("field_lines", "field") if "\n" in head.rpartition(":")[2] else ("field",)
                begin = start - 1 if table else start
                accepted = len(token) >= _MIN_LENGTH and _ACCEPTED.search(token)
                for kind in kinds:
                    if begin >= ends[kind]:
                        ends[kind] = at.end()
                        if accepted:
                            yield kind, token, begin, at.end()
        else:
            at = _BRACKET.match(text, opened)
            if not at:
                opened = text.find("[", opened + 1)
                continue
            start, stop, token = opened, at.end(), at[1]
            if len(token) >= _MIN_LENGTH and _ACCEPTED.search(token):
                yield "bracket", token, start, stop
                for kind, begin in pending.items():
                    yield kind, token, begin, stop
            pending.clear()
        if 0 <= words < stop:
            words = text.find(_WORDS, stop)
        if 0 <= opened < stop:
            opened = text.find("[", stop)


def _best(hits: list[tuple]) -> list[tuple]:
    """One hit per identifier (the most confident, on a tie the first), most confident first."""
    best: dict[str, tuple] = {}
    for hit in hits:
        if hit[0] not in best or hit[1] > best[hit[0]][1]:
            best[hit[0]] = hit
    return sorted(best.values(), key=lambda hit: -hit[1])


def _hits_of(rules: list[tuple], contexts: bool, ranked: bool):
    """Finds the hits of a text; ``rules`` are (shape, name, first match alone, score, score near a table)."""
    window, around, limit = fixed.TABLE_WINDOW, fixed.CONTEXT_WINDOW, fixed.CONTEXT_LIMIT

    def hits_of(text: str) -> list[tuple]:
        by_shape: dict[str, list[tuple]] = {}
        for shape, *match in found_in(text):
            by_shape.setdefault(shape, []).append(match)
        hits = []
        for shape, name, first, plain, boosted in rules if by_shape else ():
            found = by_shape.get(shape, ())
            for token, start, stop in found[:1] if first else found:
                score = plain
                if plain != boosted:
                    near = text[max(0, start - window) : stop + window]
                    score = boosted if "|" in near or "table" in near.lower() else plain
                context = None
                if contexts:
                    context = _RUNS.sub(" ", text[max(0, start - around) : stop + around]).strip(" ")
                    context = context[:limit] + "..." if len(context) > limit else context
                hits.append((token, score, start, stop, context, name))
        return _best(hits) if ranked and len(hits) > 1 else hits

    return hits_of


def _hit_arrays(offsets: list[int], rows: list[tuple]) -> pa.Array:
    columns = zip(*rows, strict=True) if rows else [()] * len(_TYPES)
    fields = [pa.array(column, kind) for column, kind in zip(columns, _TYPES.values(), strict=True)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, list(_TYPES)))


def _hits_udf(rules: list[tuple], contexts: bool, ranked: bool, hits_type: str):
    """Hits of a batch of texts."""
    hits_of = _hits_of(rules, contexts, ranked)

    @F.arrow_udf(hits_type)
    def batch_hits(texts: pa.Array) -> pa.Array:
        offsets, rows = [0], []
        for value in texts.cast(pa.binary()).to_pylist():
            if value is not None and (b"[" in value or _WORD_BYTES in value):
                rows += hits_of(value.decode("utf-8", "replace"))
            offsets.append(len(rows))
        return _hit_arrays(offsets, rows)

    return batch_hits


def _hit_rules(patterns: list[Pattern]) -> list[tuple]:
    return [
        (anchors.shape(p), p.name, p.first_match_only, p.confidence(anchors.in_table(p)), p.confidence(True))
        for p in patterns
    ]


def find_hits(text: str, patterns: list[Pattern], contexts: bool, ranked: bool, hits_type: str) -> Column:
    """Hits of ``patterns``, all of a known shape, pattern by pattern.

    ``ranked``: one hit per identifier, best first.  Being a Python function, it must not
    be used within a lambda.
    """
    return _hits_udf(_hit_rules(patterns), contexts, ranked, hits_type)(F.expr(text))


def known_level(pattern: Pattern) -> bool:
    """Whether a severity pattern is one of the cells, which begin with a literal."""
    return pattern.pattern in _LEVEL_CELLS


def _levels_of(rules: list[tuple]):
    """Finds the distinct valid levels of a text; ``rules`` are (literal, regex, first level alone)."""
    compiled = [(literal, re.compile(regex), first) for literal, regex, first in rules]

    def levels_of(text: str) -> list[str]:
        levels: dict[str, None] = {}
        for literal, regex, first in compiled:
            at = text.find(literal)
            while at >= 0:
                cell = regex.match(text, at)
                if cell and cell[1] in _LEVELS:
                    levels[cell[1]] = None
                    if first:
                        break
                at = text.find(literal, cell.end() if cell else at + 1)
        return list(levels)

    return levels_of


def _levels_udf(rules: list[tuple]):
    """Levels of a batch of texts."""
    levels_of = _levels_of(rules)
    wanted = min((literal.encode() for literal, _, _ in rules), key=len)

    @F.arrow_udf("array<string>")
    def find(texts: pa.Array) -> pa.Array:
        none: list[str] = []
        return pa.array(
            [levels_of(v.decode("utf-8", "replace")) if v is not None and wanted in v else none for v in texts.cast(pa.binary()).to_pylist()],
            pa.list_(pa.string()),
        )

    return find


def _level_rules(patterns: list[Pattern]) -> list[tuple]:
    return [(_LEVEL_CELLS[p.pattern], p.pattern.replace(r"\s", _SPACE), p.first_level_only) for p in patterns]


def find_levels(text: str, patterns: list[Pattern]) -> Column:
    """Distinct valid levels of ``patterns``, all known cells; not for lambdas either."""
    return _levels_udf(_level_rules(patterns))(F.expr(text))


# All that Latin-1 shows: a text of such characters alone is not binary.
_HIDDEN_BYTES = bytes(c for c in range(256) if not re.match(text_functions.SHOWN, chr(c)))


def _read(value: bytes) -> tuple[str, bool]:
    """A text, and whether it has shown Latin-1 characters alone."""
    letters = value
    if not value.isascii():
        try:
            text = value.decode("utf-8")
            letters = text.encode("latin-1")
        except UnicodeDecodeError:
            return value.decode("utf-8", "replace"), False
        except UnicodeEncodeError:
            return text, False
    else:
        text = value.decode("ascii")
    return text, len(letters.translate(None, _HIDDEN_BYTES)) == len(letters)


def _plain_udf():
    @F.arrow_udf("boolean")
    def plain(texts: pa.Array) -> pa.Array:
        return pa.array([v is not None and _read(v)[1] for v in texts.cast(pa.binary()).to_pylist()], pa.bool_())

    return plain


def is_plain(text: str) -> Column:
    """Whether a text has shown Latin-1 characters alone (NULL: no), told in batches."""
    return _plain_udf()(F.expr(text))


_KEYWORDS = [w.encode() for w in fixed.REQUIRED_KEYWORDS]
_USUAL_KEYWORDS = [form.encode() for w in fixed.REQUIRED_KEYWORDS for form in (w.capitalize(), w)]


def _on_topic(value: bytes) -> bool:
    """``functions.text.has_keyword``; the usual spellings are tried first."""
    for word in _USUAL_KEYWORDS:
        if word in value:
            return True
    low = value.lower() if value.isascii() else value.decode("utf-8", "replace").lower().encode("utf-8", "replace")
    return any(word in low for word in _KEYWORDS)


def _turns_of(text: str, hits: list[tuple], levels: list[str]) -> list[int]:
    """Index of the level of every ranked hit, of which there are more than levels.

    Hit i takes level i, any other the level written closest to its start
    (``documents.nearest_severities``); without any, the first.
    """
    try:
        # One byte a character, and no letter but A-Z matters.
        low = text.encode("latin-1").lower().decode("latin-1")
    except UnicodeEncodeError:
        low = text.lower()
    places = []
    for turn, level in enumerate(levels):
        word = level.lower()
        at = low.find(word)
        while at >= 0:
            places.append((at, turn))
            at = low.find(word, at + 1)
    places.sort()
    positions = [position for position, _ in places]
    turns = list(range(len(levels)))
    for hit in hits[len(levels) :]:
        start = hit[2]
        around = places[max(0, bisect_right(positions, start) - 1) : bisect_left(positions, start) + 1]
        turns.append(min(((abs(position - start), turn) for position, turn in around), default=(0, 0))[1])
    return turns


def _search_udf(hit_rules: list[tuple], level_rules: list[tuple], contexts: bool, ranked: bool, found_type: str):
    """What the gate asks of a batch of texts, and hits and levels of those with a keyword."""
    hits_of, levels_of = _hits_of(hit_rules, contexts, ranked), _levels_of(level_rules)

    @F.arrow_udf(found_type)
    def batch_hits(texts: pa.Array) -> pa.Array:
        topical, plain, offsets, rows, levels, turns = [], [], [0], [], [], []
        none: list = []
        for scalar in texts.cast(pa.binary()):
            value = scalar.as_py()
            on_topic = value is not None and _on_topic(value)
            shown, found, paired = False, none, none
            if on_topic:
                text, shown = _read(value)
                hits, found = hits_of(text), levels_of(text)
                rows += hits
                if ranked and 1 < len(found) < len(hits):
                    paired = _turns_of(text, hits, found)
            topical.append(on_topic)
            plain.append(shown)
            offsets.append(len(rows))
            levels.append(found)
            turns.append(paired)
        columns = [
            pa.array(topical, pa.bool_()),
            pa.array(plain, pa.bool_()),
            _hit_arrays(offsets, rows),
            pa.array(levels, pa.list_(pa.string())),
            pa.array(turns, pa.list_(pa.int32())),
        ]
        return pa.StructArray.from_arrays(columns, ["topical", "plain", "hits", "severities", "turns"])

    return batch_hits


def search(text: str, ids: list[Pattern], levels: list[Pattern], contexts: bool, ranked: bool, hits_type: str) -> Column:
    """struct(topical, plain, hits, severities, turns) of a text, read once for all of them.

    ``topical``: it has a keyword; only then the rest is sought.  ``plain`` as in
    ``is_plain``, ``hits`` as in ``find_hits``, ``severities`` as in ``find_levels``.  ``turns``: where ranked
    hits outnumber several levels, the index of the level of each, else empty.  Not for lambdas either.
    """
    found_type = f"struct<topical:boolean,plain:boolean,hits:{hits_type},severities:array<string>,turns:array<int>>"
    return _search_udf(_hit_rules(ids), _level_rules(levels), contexts, ranked, found_type)(F.expr(text))
