"""Hooks for matchers of one's own.

A matcher is any function from documents(path, content, …) to the same rows with
``hits`` and ``severities`` added.  ``text_matcher`` makes one from a Python function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.operators.matching import HITS, find_severities, rank_hits


def text_matcher(
    find: Callable[[str], Iterable[tuple]], severity_patterns="config"
) -> Callable[[DataFrame], DataFrame]:
    """Matcher from ``find(text)`` yielding (id, confidence, start, end, context, name).

    Texts travel to Python in Arrow batches; documents without text stay in the JVM
    side of the batch as NULL.  Severities use the regex patterns.
    """

    def match(documents: DataFrame) -> DataFrame:
        @F.pandas_udf(HITS)
        def hits(texts: pd.Series) -> pd.Series:
            fields = (
                "checkov_id",
                "confidence",
                "start_position",
                "end_position",
                "context",
                "pattern_name",
            )
            return texts.map(
                lambda t: None if t is None else [dict(zip(fields, row)) for row in find(t)]
            )

        return documents.withColumns(
            {
                "hits": hits(F.col("content")),
                "severities": find_severities("content", severity_patterns),
            }
        ).withColumn("hits", rank_hits("hits"))

    return match
