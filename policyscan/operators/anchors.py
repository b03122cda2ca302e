"""One scan of a text for all anchored identifier patterns.

The known patterns all begin at one of two anchors: the words "Checkov ID" or a
bracketed token.  A single regex pass finds every anchor and captures what stands right
after it; each pattern's matches then follow from the short list of anchors:

* what separates "Checkov ID" from the token after it (line end, colon, cell border)
  tells which of the field and table patterns fit there;
* a pattern that runs on to "the next bracketed token" is joined to that token while
  the anchors are put in order, so nothing is searched twice.  Of several anchors before
  one token only the first matches, as a match ends where the next may begin;
* the same holds where a token or a cell border runs into the next anchor, so the end of
  the last match of every pattern is kept along.

Every capture is possessive over disjoint kinds of characters, so it equals what the
pattern itself would capture.
"""

from __future__ import annotations

from policyscan import fixed
from policyscan.functions import sql
from policyscan.functions.ids import accept_token_sql
from policyscan.operators.patterns import REGEX_FLAGS, SHAPES, Pattern
from policyscan.operators.pieces import rows_of, split_at_matches

_WORDS = "Checkov ID"
_WINDOW = fixed.TABLE_WINDOW
_REGEX = (
    # Both anchors behind one class of first characters, which is searched faster than a choice.
    rf"{REGEX_FLAGS}[{_WORDS[0]}\[](?:(?<={_WORDS[0]}){_WORDS[1:]}"
    rf"(?=(\s*+:?+\s*+\|?+\s*+(?:https?://)?+)([A-Z0-9_]*+)(.{{0,{_WINDOW}}}))"
    rf"|(?<=\[)([A-Z0-9_]+)\](?=(.{{0,{_WINDOW}}})))"
)
_LINK = "struct<start:int,before:string>"
_DIRECT = ("cell_lines", "cell", "field_lines", "field")
_LINKED = ("link", "any_link")


def shape(pattern: Pattern) -> str | None:
    """How a known pattern hangs on an anchor; None for any other pattern."""
    return SHAPES.get(pattern.pattern) if pattern.kind != "severity" else None


def anchors_sql(text: str, patterns: list[Pattern]) -> str:
    """SQL array of the anchors of a text whose token is accepted, in text order.

    Only what the shapes of ``patterns`` ask for is kept along.
    ``before`` holds one character more than the window, as a match may begin at the
    cell border before the anchor.  ``link`` and ``any_link`` are the earlier anchors
    that a bracketed token completes.
    """
    pieces = split_at_matches(text, _REGEX, ["$0", "$1", "$2", "$3", "$4", "$5"])
    shapes = {shape(p) for p in patterns}
    direct_kinds = [kind for kind in _DIRECT if kind in shapes]
    linked = [kind for kind in _LINKED if kind in shapes]
    anchor_type = (
        "struct<start:int,stop:int,before:string,match:string,after:string,id:string,bracket:boolean"
        + "".join(f",{kind}:boolean" for kind in direct_kinds)
        + "".join(f",{kind}:{_LINK}" for kind in linked)
        + ">"
    )
    none = sql.empty(f"array<{anchor_type}>")
    names = ["match", "head", "token", "after", "bracketed", "following"]
    words = "r.bracketed = ''"
    front = f"({words} AND endswith(r.tail, '|'))"  # the border of the cell before the words
    lead = "substring_index(r.head, '|', 1)"
    url = "endswith(r.head, '://')"
    table = f"({front} AND contains(r.head, '|') AND NOT contains({lead}, ':'))"
    lines = f"contains({lead}, '\\n')"
    direct = f"(NOT {url} AND r.token <> '')"
    field = f"{words} AND NOT contains(r.head, '|') AND {direct}"
    kinds = {
        "cell_lines": f"{table} AND {direct} AND {lines}",
        "cell": f"{table} AND {direct}",
        # After a colon only what follows it may end the line.
        "field_lines": f"{field} AND contains(substring_index(r.head, ':', -1), '\\n')",
        "field": field,
        "link": f"{table} AND {lines} AND {url}",
        "any_link": f"{table} AND {lines}",
    }
    judged = sql.struct(
        skip="r.skip",
        tail="r.tail",
        match="concat(r.match, r.head, r.token)",
        anchor="length(r.match)",
        after="concat(r.after, r.following)",
        id="concat(r.token, r.bracketed)",
        bracket="r.bracketed <> ''",
        **{kind: kinds[kind] for kind in [*direct_kinds, *linked]},
    )
    rows = f"transform({rows_of(pieces, names, _WINDOW + 1)}, r -> {judged})"
    before = f"right(concat(acc.state.tail, item.tail), {_WINDOW + 1})"
    start = "(acc.state.stop + item.skip)"
    stop = f"{start} + item.anchor"
    here = f"CAST({sql.struct(start=f'{start} - 1', before=f'left({before}, greatest(length({before}) - 1, 0))')} AS {_LINK})"
    nothing = f"CAST(NULL AS {_LINK})"

    def pending(name: str) -> str:
        kept = f"WHEN acc.state.{name} IS NULL AND item.{name} THEN {here} ELSE acc.state.{name}"
        return f"CASE WHEN item.bracket THEN {nothing} {kept} END"

    def fits(kind: str) -> str:
        """Whether the anchor completes a match that begins after the last one ended."""
        begin = f"{start} - 1" if kind.startswith("cell") else start
        return f"(item.{kind} AND {begin} >= acc.state.{kind})"

    end = f"{start} + length(item.match)"
    state = sql.struct(
        stop=stop,
        tail=f"right(concat({before}, left(item.match, item.anchor)), {_WINDOW + 1})",
        **{kind: pending(kind) for kind in linked},
        **{kind: f"CASE WHEN {fits(kind)} THEN {end} ELSE acc.state.{kind} END" for kind in direct_kinds},
    )
    anchor = sql.struct(
        start=start,
        stop=stop,
        before=before,
        match="item.match",
        after="item.after",
        id="item.id",
        bracket="item.bracket",
        **{kind: fits(kind) for kind in direct_kinds},
        **{kind: f"CASE WHEN item.bracket THEN acc.state.{kind} ELSE {nothing} END" for kind in linked},
    )
    found = sql.fold(
        rows,
        sql.struct(stop="0", tail="''", **dict.fromkeys(linked, nothing), **dict.fromkeys(direct_kinds, "0")),
        anchor_type,
        state,
        f"CASE WHEN {accept_token_sql('item.id')} THEN array(CAST({anchor} AS {anchor_type})) ELSE {none} END",
    )
    needed = f"(contains({text}, '{_WORDS}') OR contains({text}, '['))"
    return f"CASE WHEN {needed} THEN {found} ELSE {none} END"


# Which anchors complete a match of each shape.
_FITS = {
    "link": "a.link IS NOT NULL",
    "any_link": "a.any_link IS NOT NULL",
    **{kind: f"a.{kind}" for kind in _DIRECT},
    "bracket": "a.bracket",
}


def matches_sql(anchors: str, pattern: Pattern) -> str:
    """SQL array of the anchors that complete a match of the pattern; strong patterns keep the first."""
    fitting = f"filter({anchors}, a -> {_FITS[shape(pattern)]})"
    return f"slice({fitting}, 1, 1)" if pattern.first_match_only else fitting


def spans_sql(text: str, anchors: str, pattern: Pattern) -> str:
    """SQL array of (id, start, stop, before, match, after) of a pattern's matches."""
    kind = shape(pattern)
    length = "length(a.match)"
    if kind in _LINKED:
        fields = {
            "start": f"a.{kind}.start",
            "stop": "a.stop",
            "before": f"a.{kind}.before",
            # The one match of a strong pattern: a single walk through the text.
            "match": f"substring({text}, a.{kind}.start + 1, a.stop - a.{kind}.start)",
        }
    elif kind in ("cell", "cell_lines"):
        fields = {
            "start": "a.start - 1",
            "stop": f"a.start + {length}",
            "before": "left(a.before, greatest(length(a.before) - 1, 0))",
            "match": "concat('|', a.match)",
        }
    else:
        fields = {"start": "a.start", "stop": f"a.start + {length}", "before": f"right(a.before, {_WINDOW})", "match": "a.match"}
    span = sql.struct(id="a.id", **fields, after="a.after")
    return f"transform({matches_sql(anchors, pattern)}, a -> {span})"


def in_table(pattern: Pattern) -> bool:
    """Whether every match of the shape holds a cell border itself."""
    return shape(pattern) in (*_LINKED, "cell", "cell_lines")
