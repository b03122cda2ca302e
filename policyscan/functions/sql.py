"""Small helpers for writing SQL expressions as text.

Nested array functions are written as SQL: Spark parses a whole expression at once,
while building it from Column objects costs a driver round trip per operator.
"""

from __future__ import annotations


def string(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    return f"{value!r}D"


def empty(type_name: str) -> str:
    """Empty array of a type such as ``array<string>``."""
    return f"CAST(array() AS {type_name})"


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


_BLOCK = 256


def fold(items: str, state: str, emitted: str, following: str, emit: str) -> str:
    """Running fold over an array that keeps what each step emits.

    ``following`` (the next state) and ``emit`` (an array of ``emitted``) refer to
    ``acc.state`` and ``item``.  Appending to one long array would copy it again and
    again, so emitted values are gathered per block of items and the blocks are
    joined at the end.
    """
    step = f"(acc, item) -> {struct(state=following, out=f'concat(acc.out, {emit})')}"

    def over(block: str, start: str) -> str:
        return f"aggregate({block}, {struct(state=start, out=empty(f'array<{emitted}>'))}, {step})"

    blocks = (
        f"transform(sequence(0, CAST(floor((size(whole) - 1) / {_BLOCK}) AS INT)),"
        f" b -> slice(whole, b * {_BLOCK} + 1, {_BLOCK}))"
    )
    next_block = bind(
        over("block", "total.state"),
        "done",
        struct(state="done.state", out="concat(total.out, array(done.out))"),
    )
    start = struct(state=state, out=empty(f"array<array<{emitted}>>"))
    long = f"flatten(aggregate({blocks}, {start}, (total, block) -> {next_block}, total -> total.out))"
    short = over("whole", state) + ".out"
    return bind(items, "whole", f"CASE WHEN size(whole) <= {_BLOCK} THEN {short} ELSE {long} END")
