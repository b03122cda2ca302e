"""Line-first quality rules over whole texts, in DataFrame functions only.

Every line is judged by itself (punctuation, navigation, boilerplate); failing lines
are removed, and a document is rejected when the removed lines held more than a given
share of its words, or when it fails the base rules (too few words, or most words
inside repeated three-word windows).

The plan is narrow: no shuffle, one task's memory is bounded by one document.  Word
windows are compared by 64-bit hashes within a document.

Defined results
    null or empty text: no words, base rules fail, cleaned text is empty
    text without line breaks: one line
    lines without a word: kept, never counted
    repeated rows and ties: each row is judged by itself
    input columns named like a result column: replaced by the result
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policyscan.frames import compute_once

# Phrases of the boilerplate and navigation rules.
BOILERPLATE = (
    "accept cookies",
    "cookie policy",
    "we use cookies",
    "this site uses cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "all rights reserved",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "subscribe to our newsletter",
    "sign up for our newsletter",
    "page not found",
)
NAVIGATION = (
    "home",
    "menu",
    "main menu",
    "log in",
    "login",
    "sign in",
    "sign up",
    "register",
    "next",
    "next page",
    "previous",
    "previous page",
    "back to top",
    "skip to content",
    "skip to main content",
    "read more",
    "show more",
    "click here",
    "share",
    "search",
    "contact",
    "contact us",
    "about us",
    "site map",
    "sitemap",
)

# The base rules.
WORD = r"[^ \t-\r]+"
SYMBOL = "[#*$%&|<>]"
OTHER = "[^#*$%&|<>]+"
MIN_WORDS = 50
REPEAT_PERCENT = 50

# A line fails when these appear more often than once in so many words.
SYMBOL_SHARE = 0.3
SHOUT_SHARE = 0.3
MAX_LOSS = 0.5

NAVIGATION_RE = r"(?i)^[ \t-\r>«‹←]*(?:" + "|".join(NAVIGATION) + r")[ \t-\r»›>→:.]*$"
# Three or more short entries between separators.
MENU_RE = r"^(?:[^|»>·•]{0,30}[|»>·•]){2,}[^|»>·•]{0,30}$"
SHOUT_RE = r"[!?]{2,}"

WORDS = "_quality_words"
HASHES = "_quality_windows"
JUDGED = "_quality_lines"
SPLIT = "_quality_split"
LOWER = "_quality_lower"
HAS_PHRASE = "_quality_phrase"


def _sql(text: str) -> str:
    return "r'" + text.replace("'", "\\'") + "'"


def has_phrase(lowered: str) -> str:
    """SQL condition: a lower-case text holds a boilerplate phrase."""
    return "(" + " OR ".join(f"contains({lowered}, '{phrase}')" for phrase in BOILERPLATE) + ")"


def line_fails(line: str, words: str) -> str:
    """SQL condition: a line of so many words fails one of the three line rules."""
    phrases = f"({HAS_PHRASE} AND transform(array(lower({line})), low -> {has_phrase('low')})[0])"
    return (
        f"(length({line}) - length(regexp_replace({line}, {_sql(SYMBOL)}, '')) > {SYMBOL_SHARE}D * {words}"
        f" OR regexp_count({line}, {_sql(SHOUT_RE)}) > {SHOUT_SHARE}D * {words}"
        f" OR {line} RLIKE {_sql(NAVIGATION_RE)} OR {line} RLIKE {_sql(MENU_RE)} OR {phrases})"
    )


def repeat_words(hashes: str) -> str:
    """SQL count of the words covered by windows that occur more than once.

    Windows are sorted with their positions, those equal to a neighbour are kept, and
    every covered position is counted once: n log n in the words of one document.
    """
    pairs = f"sort_array(transform({hashes}, (h, i) -> named_struct('h', h, 'i', i)))"
    repeated = (
        f"transform(array({pairs}), s -> sort_array(transform(filter(s, (x, k) ->"
        " (k > 0 AND s[k - 1].h = x.h) OR (k < size(s) - 1 AND s[k + 1].h = x.h)), x -> x.i)))[0]"
    )
    covered = (
        f"transform(array({repeated}), p -> aggregate(transform(p, (x, k) ->"
        " CASE WHEN k = size(p) - 1 THEN 3 ELSE least(3, p[k + 1] - x) END), 0, (a, n) -> a + n))[0]"
    )
    return f"CASE WHEN size({hashes}) = size(array_distinct({hashes})) THEN 0 ELSE {covered} END"


def measure(docs: DataFrame, text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """Add the measures, both verdicts and the cleaned text to every row of ``docs``.

    Added: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines, n_lines_failed, lost_share (words in failed lines, as a share), kept,
    clean_text (the lines that passed).
    """
    # One regex pass: the words of every line; those of the text are their concatenation.
    lines = f"split(coalesce(`{text_col}`, ''), '\\n', -1)"
    # Lines are searched for phrases only where the whole text holds one.
    steps = docs.withColumn(LOWER, F.lower(F.coalesce(F.col(text_col), F.lit(""))))
    steps = steps.withColumn(HAS_PHRASE, F.expr(has_phrase(LOWER))).drop(LOWER)
    steps = steps.withColumn(
        SPLIT, F.expr(f"transform({lines}, l -> named_struct('l', l, 'w', regexp_extract_all(l, {_sql(WORD)}, 0)))")
    )
    steps = steps.withColumns(
        {
            WORDS: F.expr(f"flatten(transform({SPLIT}, x -> x.w))"),
            JUDGED: F.expr(
                f"transform({SPLIT}, x -> named_struct('l', x.l, 'w', size(x.w),"
                f" 'bad', size(x.w) > 0 AND {line_fails('x.l', 'size(x.w)')}))"
            ),
        }
    )
    steps = steps.withColumn(
        HASHES,
        F.expr(
            f"CASE WHEN size({WORDS}) < 3 THEN CAST(array() AS array<bigint>) ELSE transform("
            f"slice({WORDS}, 1, size({WORDS}) - 2), (w, i) -> xxhash64(w, {WORDS}[i + 1], {WORDS}[i + 2])) END"
        ),
    )
    worded = f"transform(filter({JUDGED}, x -> x.w > 0), x -> x.l)"
    lost = f"aggregate({JUDGED}, 0L, (a, x) -> a + CASE WHEN x.bad THEN x.w ELSE 0 END)"
    steps = steps.withColumns(
        {
            "n_words": F.size(WORDS).cast("long"),
            "word_chars": F.length(F.array_join(WORDS, "")).cast("long"),
            "n_symbols": F.length(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), OTHER, "")).cast("long"),
            "n_dup_lines": F.expr(
                f"CAST(transform(array({worded}), l -> size(l) - size(array_distinct(l)))[0] AS bigint)"
            ),
            "n_repeat_words": F.expr(f"CAST({repeat_words(HASHES)} AS bigint)"),
            "n_lines": F.expr(f"CAST(size(filter({JUDGED}, x -> x.w > 0)) AS bigint)"),
            "n_lines_failed": F.expr(f"CAST(size(filter({JUDGED}, x -> x.bad)) AS bigint)"),
            "lost_share": F.expr(f"CASE WHEN size({WORDS}) = 0 THEN 0D ELSE {lost} / CAST(size({WORDS}) AS double) END"),
            "clean_text": F.expr(f"array_join(transform(filter({JUDGED}, x -> NOT x.bad), x -> x.l), '\\n')"),
        }
    ).drop(HAS_PHRASE, SPLIT, WORDS, HASHES, JUDGED)
    steps = steps.withColumn("base_failed", base_failed())
    steps = steps.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= F.lit(float(max_loss))))
    # Behind a generator: a filter on a verdict must not pull its expressions below.
    added = [*MEASURES, "n_lines", "n_lines_failed", "lost_share", "clean_text"]
    return compute_once(steps, **{c: F.col(c) for c in added})


def base_failed() -> Column:
    """Too few words, or more than half of them inside repeated windows."""
    few = F.col("n_words") < MIN_WORDS
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    return few | repeats


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """One row per row of ``docs``: its id, measures and verdicts."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return measure(narrow, "text", max_loss).select(
        "doc_id", *MEASURES, "n_lines", "n_lines_failed", "lost_share"
    )


def clean(docs: DataFrame, text_col: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` without rejected rows, with texts cleaned of failing lines.

    Columns are those of ``docs``; a column ``n_chars`` is brought up to date.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    kept = measure(row, "text", max_loss).filter("kept")
    values = {c: F.col("row")[c] for c in docs.columns}
    values[text_col] = F.col("clean_text")
    if "n_chars" in values:
        values["n_chars"] = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return kept.select(*[v.alias(c) for c, v in values.items()])


_RE2_WORD = r"[^ \t-\r]+"
ORACLE = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents
), lines AS (
  SELECT rid, i, string_split(text, chr(10))[i] AS l
  FROM (SELECT rid, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM base)
), judged AS (
  SELECT rid, l, len(regexp_extract_all(l, '{_RE2_WORD}')) AS w,
    length(l) - length(regexp_replace(l, '{SYMBOL}', '', 'g')) AS s,
    len(regexp_extract_all(l, '[!?]{{2,}}')) AS shouts
  FROM lines
), verdicts AS (
  SELECT rid, l, w, w > 0 AND (s > {SYMBOL_SHARE}::DOUBLE * w OR shouts > {SHOUT_SHARE}::DOUBLE * w
    OR regexp_matches(l, '{NAVIGATION_RE}')
    OR regexp_matches(l, '{MENU_RE}')
    OR list_has_any([contains(lower(l), p) FOR p IN {list(BOILERPLATE)!r}], [true])) AS bad
  FROM judged
), per_line AS (
  SELECT rid, count(*) FILTER (w > 0) AS n_lines, count(*) FILTER (bad) AS n_lines_failed,
    coalesce(sum(w) FILTER (bad), 0)::DOUBLE AS lost,
    count(l) FILTER (w > 0) - count(DISTINCT l) FILTER (w > 0) AS n_dup_lines
  FROM verdicts GROUP BY rid
), worded AS (
  SELECT rid, regexp_extract_all(text, '{_RE2_WORD}') AS words FROM base
), windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS win
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM worded)
), repeated AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY rid
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[ \t-\r]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '{OTHER}', '', 'g'))::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    n_lines::BIGINT AS n_lines, n_lines_failed::BIGINT AS n_lines_failed,
    CASE WHEN len(words) = 0 THEN 0.0::DOUBLE ELSE lost / len(words)::DOUBLE END AS lost_share
  FROM base JOIN worded USING (rid) JOIN per_line USING (rid) LEFT JOIN covered USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words)
    AND lost_share <= {MAX_LOSS}::DOUBLE AS kept,
  n_lines, n_lines_failed, lost_share
FROM measured
"""
