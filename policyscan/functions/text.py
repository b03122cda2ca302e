"""Column functions over document text.

Whitespace follows Unicode plus U+001C..U+001F, lengths and positions count code
points.  Every expression is linear in the text.
"""

from __future__ import annotations

import operator
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from policyscan import fixed
from policyscan.functions import sql

SPACE = r"\s\x1c-\x1f"
# SPACE without the newline, letter by letter: the regex engine keeps those of Latin-1 in a table.
INLINE_SPACE = r"[\t\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
_ASCII = "".join(f"\\x{c:02x}" for c in range(128))
BOM = "\ufeff"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often body uses it."""
    return F.transform(F.array(value), body)[0]


_ENDS = rf"(?U)^[{SPACE}]+|(?<![{SPACE}])[{SPACE}]+\z"


def strip(text: Column) -> Column:
    """Remove whitespace at both ends."""
    return F.regexp_replace(text, _ENDS, "")


def strip_sql(text: str) -> str:
    return f"regexp_replace({text}, {sql.string(_ENDS)}, '')"


def is_blank(text: Column) -> Column:
    """True when the text has no visible character."""
    return ~F.rlike(text, F.lit(rf"(?U)[^{SPACE}]"))


def newlines(text: Column) -> Column:
    """Turn ``\\r\\n`` and ``\\r`` into ``\\n``."""
    return F.when(has_carriage_return(text), F.regexp_replace(text, "\r\n?", "\n")).otherwise(text)


def has_carriage_return(text: Column) -> Column:
    return F.contains(text, F.lit("\r"))


def rstrip_lines(text: Column) -> Column:
    """Remove trailing whitespace from every line.

    What stands before a run is looked at only where a blank was found.
    """
    return F.regexp_replace(text, rf"{INLINE_SPACE}(?<!{INLINE_SPACE}{{2}}){INLINE_SPACE}*+(?=\n|\z)", "")


def has_blank_run(text: Column) -> Column:
    return F.contains(text, F.lit("\n\n\n\n"))


def collapse_blank_lines(text: Column) -> Column:
    """Shorten runs of four or more newlines to three (lines already stripped)."""
    return F.when(has_blank_run(text), F.regexp_replace(text, "\n{4,}", "\n\n\n")).otherwise(text)


def _nfkc_udf():
    # Nested so that workers get it by value and need no installed package.
    @F.pandas_udf("string")
    def nfkc(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: unicodedata.normalize("NFKC", t), na_action="ignore"
        )

    return nfkc


def nfkc(text: Column) -> Column:
    """Unicode NFKC.  Spark has no such function, so Arrow batches carry the texts
    that hold a non-ASCII character to Python; plain ASCII never leaves the JVM."""
    foreign = F.when(~F.rlike(text, F.lit(rf"\A[{_ASCII}]*\z")), text)
    return F.coalesce(_nfkc_udf()(foreign), text)


def strip_bom(text: Column) -> Column:
    return F.when(has_bom(text), F.substr(text, F.lit(2))).otherwise(text)


def has_bom(text: Column) -> Column:
    return F.startswith(text, F.lit(BOM))


# Neither printable nor whitespace.
_SPACES = r"\t-\r\x1c-\x1f\x85"
# The other Latin-1 characters one by one, which the regex engine keeps in a table: most texts are told by it alone.
_SHOWN = "".join(f"\\x{c:02x}" for c in range(256) if unicodedata.category(chr(c))[0] != "C" or c in (*range(9, 14), *range(28, 32), 133))
_HIDDEN = rf"[[^{_SHOWN}]&&[\p{{C}}&&[^{_SPACES}]]]"


def printable_ratio(text: Column) -> Column:
    """Share of characters that are printable or whitespace (NULL for empty text)."""
    visible = F.regexp_replace(text, f"{_HIDDEN}+", "")
    return F.try_divide(F.length(visible), F.length(text))


SHOWN = f"[{_SHOWN}]"


def appears_binary(text: Column, plain: Column | None = None) -> Column:
    """Too few printable characters; most texts have no other kind and are only searched for one.

    A text of shown Latin-1 letters alone is told by one run over a table of them, or by
    ``plain`` where the caller knows it.
    """
    plain = F.rlike(text, F.lit(rf"\A{SHOWN}*\z")) if plain is None else plain
    low = F.coalesce(printable_ratio(text) < fixed.MIN_PRINTABLE_RATIO, F.lit(False))
    return F.when(plain, F.lit(False)).when(F.rlike(text, F.lit(_HIDDEN)), low).otherwise(F.lit(False))


def has_keyword(text: Column, keywords: list[str] | None = None) -> Column:
    """Any keyword occurs, in any letter case.

    The usual spellings are tried first; only texts without them are lower-cased.
    """
    words = keywords or fixed.REQUIRED_KEYWORDS
    usual = [F.contains(text, F.lit(form)) for w in words for form in (w.capitalize(), w)]
    any_case = let(F.lower(text), lambda low: reduce(operator.or_, [F.contains(low, F.lit(w)) for w in words]))
    return reduce(operator.or_, [*usual, any_case])


def long_enough(text: Column, minimum: int = fixed.MIN_CONTENT_LENGTH) -> Column:
    """At least ``minimum`` characters; a text of four times as many bytes is not counted."""
    return (F.octet_length(text) >= 4 * max(minimum, 0)) | (F.length(text) >= minimum)


def process_gate(
    text: Column, min_length: int = fixed.MIN_CONTENT_LENGTH, plain: Column | None = None, topical: Column | None = None
) -> Column:
    """Text is worth matching: not blank, long enough, on topic and not binary.

    A text with a keyword is not blank, so blanks need no test of their own.  ``topical`` and
    ``plain`` are given where the caller knows whether it has a keyword and shown letters alone.
    """
    topical = has_keyword(text) if topical is None else topical
    return long_enough(text, min_length) & topical & ~appears_binary(text, plain)


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def non_ascii_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[\x00-\x7f]+", ""))


# One by one: the regex engine keeps single letters in a table, but tests ranges in a row.
_CONTROL = "[" + "".join(f"\\x{c:02x}" for c in range(32) if chr(c) not in "\t\n\r") + "]"


def control_count(text: Column) -> Column:
    """Characters below U+0020 other than newline, carriage return and tab."""
    return F.regexp_count(text, F.lit(_CONTROL))


def found_keywords(text: Column) -> Column:
    def found(lowered: Column) -> Column:
        words = [F.when(F.contains(lowered, F.lit(w)), F.lit(w)) for w in fixed.RELEVANT_KEYWORDS]
        return F.array_compact(F.array(*words))

    return let(F.lower(text), found)


def suitability(text: Column) -> Column:
    """struct(is_valid, issues, relevant_keywords): is the text fit for matching?"""
    measured = F.struct(
        F.length(text).alias("chars"),
        control_count(text).alias("controls"),
        found_keywords(text).alias("keywords"),
    )

    def verdict(m: Column) -> Column:
        short = m["chars"] < fixed.MIN_CONTENT_LENGTH
        ratio = F.try_divide(m["controls"], m["chars"])
        noisy = F.coalesce(ratio > fixed.MAX_CONTROL_RATIO, F.lit(False))
        issues = F.array(
            F.when(short, fixed.SUITABILITY_TOO_SHORT),
            F.when(noisy, fixed.SUITABILITY_CONTROL),
            F.when(F.size(m["keywords"]) == 0, fixed.SUITABILITY_NO_KEYWORD),
        )
        return F.struct(
            (~short & ~noisy).alias("is_valid"),
            F.array_compact(issues).alias("issues"),
            m["keywords"].alias("relevant_keywords"),
        )

    return let(measured, verdict)


def sha256_16(text: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 16)


def context_sql(before: str, match: str, after: str) -> str:
    """Readable surroundings of a match: 50 characters on both sides, whitespace runs
    squeezed to one space, cut after 100 characters."""
    window = (
        f"concat(right({before}, {fixed.CONTEXT_WINDOW}), {match},"
        f" substring({after}, 1, {fixed.CONTEXT_WINDOW}))"
    )
    runs = sql.string(rf"(?U)[{SPACE}]+")
    limit = fixed.CONTEXT_LIMIT
    return sql.bind(
        f"trim(regexp_replace({window}, {runs}, ' '))",
        "ctx",
        f"CASE WHEN length(ctx) > {limit} THEN concat(substring(ctx, 1, {limit}), '...') ELSE ctx END",
    )


def match_context(before: str, match: str, after: str) -> Column:
    """``context_sql`` of three columns."""
    return F.expr(context_sql(before, match, after))
