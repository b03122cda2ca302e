"""Connected components over edges of any number, by alternating stars.

Each round hangs the larger neighbours of every node on its smallest neighbour, then
the smaller ones.  Every intermediate table is written to the shared folder, which cuts
the lineage and leaves plain scans on both sides of the joins, so that adaptive
execution can split the partition of a hot node.  Nothing is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.session import stage


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _with_min(directed: DataFrame) -> DataFrame:
    """``u``'s neighbours ``v`` with the smallest of ``u`` and all its neighbours."""
    smallest = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return directed.join(stage(smallest, "smallest"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    hung = _with_min(both).filter("v > u AND v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return stage(hung.distinct(), "large-star")


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    hung = _with_min(down).select(
        F.inline(
            F.array(
                F.struct(F.col("v").alias("a"), F.col("m").alias("b")),
                F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
            )
        )
    )
    return stage(hung.filter("a <> b").distinct(), "small-star")


def components(edges: DataFrame) -> DataFrame:
    """``a``, ``b`` (long, any direction) to one row per linked node: node, component.

    The component is its smallest node.  Self links and repeated edges do no harm; no
    edges give no rows.  Rounds grow with the logarithm of a component's width.
    """
    now = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _signature(now)
    while before[0]:
        now = _small_star(_large_star(now))
        after = _signature(now)
        if after == before:
            break
        before = after
    root = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    own = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return root.unionByName(own)
