"""Cutting a text at the matches of one regex, as SQL expressions."""

from __future__ import annotations

from policyscan.functions import sql

# A separator and Unicode noncharacters; the first that a text does not hold marks its matches.
# A mark of one byte comes first: Java keeps texts of plain letters in half the space, until wider ones join.
_MARKS = ("\x1e", "\uffff", "\ufffe", "\U0001ffff")


def split_at_matches(text: str, regex: str, groups: list[str]) -> str:
    """SQL array of gap, groups of match 1, gap, groups of match 2, …, tail.

    One regex pass wraps the groups of each match in marks; splitting at the mark
    then yields everything in order, with the text's own characters unchanged.  Only a
    text that holds all the marks loses the last of them.
    """

    def cut(source: str, mark: str) -> str:
        wrapped = sql.string(mark + mark.join(groups) + mark)
        return f"split(regexp_replace({source}, {sql.string(regex)}, {wrapped}), {sql.string(mark)}, -1)"

    last = _MARKS[-1]
    replaced = f"translate({text}, {sql.string(last)}, {sql.string(chr(0xFFFD))})"
    cases = " ".join(f"WHEN NOT contains({text}, {sql.string(mark)}) THEN {cut(text, mark)}" for mark in _MARKS)
    return f"CASE {cases} ELSE {cut(replaced, last)} END"


def rows_of(pieces: str, names: list[str], window: int = 0) -> str:
    """SQL array of structs, one per match; the tail is left out.

    The gap before a match is reduced to ``skip``, its length, and ``tail``, its last
    ``window`` characters, once; ``names`` are the groups.
    """
    width = len(names) + 1
    gap = f"get(pieces, i * {width})"
    # By bytes first, as counting characters from the end walks through the whole gap.
    last_bytes = f"CAST(substring(CAST({gap} AS BINARY), -{4 * window}) AS STRING)"
    kept = {"tail": f"right({last_bytes}, {window})"} if window else {}
    groups = {n: f"get(pieces, i * {width} + {at})" for at, n in enumerate(names, 1)}
    fields = sql.struct(skip=f"length({gap})", **kept, **groups)
    last = f"CAST((size(pieces) - 1) / {width} - 1 AS INT)"
    none = sql.empty("array<struct<skip:int," + ",".join(f"{n}:string" for n in [*kept, *names]) + ">>")
    rows = f"transform(sequence(0, {last}), i -> {fields})"
    return sql.bind(pieces, "pieces", f"CASE WHEN size(pieces) > 1 THEN {rows} ELSE {none} END")
