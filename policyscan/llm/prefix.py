"""Running totals over rows spread over many partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 10_000


def buckets(n_rows: int) -> int:
    """How many buckets keep one at about ``ROWS_PER_BUCKET`` rows when one group has them all."""
    return max(1, -(-n_rows // ROWS_PER_BUCKET))


def running(rows: DataFrame, group: str, order: list[str], amounts: dict[str, str], n_buckets: int) -> DataFrame:
    """``rows`` with the sum of earlier rows' amounts within each group.

    ``amounts`` maps a new column to the long column it sums.  Rows are ordered by
    ``order``; ``group`` is never null.  The first order column is a non-negative long spread evenly over 63 bits (a
    hash): its range is cut into buckets.  Rows are summed within a bucket and buckets
    within a group, so a hot group is never in one task; the bucket totals are one row
    per group and bucket.  ``rows`` is computed twice, so it should be cheap or written.
    """
    width = min((1 << 63) - 1, (1 << 63) // n_buckets + 1)
    placed = rows.withColumn("_bucket", F.expr(f"{order[0]} div {width}L"))
    totals = placed.groupBy(group, "_bucket").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in amounts.items()])
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(group).alias("_group"),
        F.col("_bucket").alias("_b"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in amounts],
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_i_{n}") for n, c in amounts.items()])
    joined = summed.join(offsets, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_b")))
    return joined.select(*rows.columns, *[(F.col(f"_i_{n}") + F.col(f"_o_{n}")).alias(n) for n in amounts])
