"""Extraction patterns: a small driver-side table that becomes column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark import SparkContext

from policyscan import fixed

# Case-sensitive, dot matches newline, ^ and $ work per line, only "\n" ends a
# line, and \s \d \b follow Unicode.
REGEX_FLAGS = "(?msdU)"


@dataclass(frozen=True)
class Pattern:
    """A regex (Java syntax; ``(?P<name>`` is read as ``(?<name>``) whose first group is an identifier or a severity.

    ``kind`` is "id" or "severity"; left empty, the name decides (see
    ``kind_by_name``).  ``needs`` is a literal every match contains: texts without
    it skip the regex.  A pattern must consume at least one character.
    """

    name: str
    pattern: str
    priority: int = 1
    kind: str | None = None
    needs: str | None = None

    @property
    def regex(self) -> str:
        return REGEX_FLAGS + self.java

    @property
    def java(self) -> str:
        return self.pattern.replace("(?P<", "(?<")

    @property
    def grouped(self) -> str:
        """The pattern, ready to be followed by more regex.

        Only an alternation needs a group; without one, a leading literal keeps its
        fast search.
        """
        bare = re.sub(r"\\.|\[[^\]]*\]", "", self.java)
        return f"(?:{self.java})" if "|" in bare else self.java

    @property
    def whole_words(self) -> str | None:
        """For a choice of whole words, the same matches as a regex that is searched by first letters."""
        choice = re.fullmatch(r"\\b\(([A-Z]+(?:\|[A-Z]+)*)\)\\b", self.java)
        if not choice:
            return None
        words = choice[1].split("|")
        rest = "|".join(rf"(?<=\b{w[0]}){w[1:]}" for w in words)
        return rf"{REGEX_FLAGS}[{''.join(dict.fromkeys(w[0] for w in words))}](?:{rest})\b"

    @property
    def groups(self) -> int:
        """Number of groups, as the engine that runs the pattern counts them."""
        regex = SparkContext.getOrCreate()._jvm.java.util.regex.Pattern
        return regex.compile(self.regex).matcher("").groupCount()

    @property
    def base_confidence(self) -> float:
        """Score before the table boost; every kept match has a valid format."""
        return self.priority / fixed.PRIORITY_SCALE * fixed.FORMAT_BOOST

    @property
    def damping(self) -> float:
        return fixed.GENERIC_DAMPING if self.name == fixed.GENERIC_PATTERN else 1.0

    def confidence(self, in_table: bool) -> float:
        score = self.base_confidence * (fixed.TABLE_BOOST if in_table else 1.0)
        return min(1.0, score * self.damping)

    @property
    def first_match_only(self) -> bool:
        """Identifier patterns this strong stop at their first accepted match."""
        return self.confidence(False) > fixed.STOP_CONFIDENCE

    @property
    def first_level_only(self) -> bool:
        """Severity patterns this strong stop at their first valid level."""
        return self.priority >= fixed.STOP_SEVERITY_PRIORITY


def kind_by_name(name: str) -> str | None:
    """What a pattern without a kind finds; None means it is not used at all."""
    lowered = name.lower()
    if any(part in lowered for part in fixed.ID_NAME_PARTS):
        return "id"
    if any(part in lowered for part in fixed.SEVERITY_NAME_PARTS):
        return "severity"
    return None


def _needed_literal(pattern: str) -> str | None:
    for literal in ("Checkov ID", "Severity"):
        if re.match(rf"(?:\\\|)?{literal}", pattern):
            return literal
    return "[" if pattern.startswith(r"\[") else None


def _table(rows) -> list[Pattern]:
    return [Pattern(*row, needs=_needed_literal(row[1])) for row in rows]


# How the known identifier patterns hang on their anchors (see ``operators.anchors``).
_KNOWN = dict.fromkeys(p for n, p, _ in [*fixed.CONFIG_PATTERNS, *fixed.BUILTIN_PATTERNS] if kind_by_name(n) != "severity")
SHAPES = dict(zip(_KNOWN, ("link", "cell_lines", "any_link", "cell", "field_lines", "field", "bracket"), strict=True))

PATTERN_SETS = {
    "config": _table(fixed.CONFIG_PATTERNS),
    "builtin": _table(fixed.BUILTIN_PATTERNS),
}


def resolve(patterns: str | list[Pattern] = "config") -> dict[str, list[Pattern]]:
    """Patterns by kind, highest priority first; equal priorities keep their order."""
    chosen = PATTERN_SETS[patterns] if isinstance(patterns, str) else patterns
    by_kind: dict[str, list[Pattern]] = {"id": [], "severity": []}
    for pattern in chosen:
        kind = pattern.kind or kind_by_name(pattern.name)
        if kind:
            by_kind[kind].append(replace(pattern, kind=kind))
    return {
        kind: sorted(found, key=lambda p: -p.priority) for kind, found in by_kind.items()
    }
