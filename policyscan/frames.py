"""DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(frame: DataFrame, **columns: Column) -> DataFrame:
    """Add columns behind a generator.

    Spark pushes a filter on a projected column below the projection, which runs the
    column's expression once for the filter and once more for the value.  It does
    not push through a generator, so here each text is matched exactly once.
    """
    names = [c for c in frame.columns if c not in columns]
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return frame.select(*names, F.inline(F.array(row)))


SALTS = 16


def salted_join(rows: DataFrame, single: DataFrame, key: str, spread: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``single`` (one row per key) with hot keys spread over ``SALTS`` tasks.

    Rows are salted by a hash of their ``spread`` column and ``single`` is repeated for
    every salt.  Adaptive execution cannot split such a join itself when ``single`` is an
    aggregate by the same key.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    repeated = single.withColumn("_salt", F.explode(salts))
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
