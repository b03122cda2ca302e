"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: the sources, in code point order with null last, weigh 3, 1, 2, repeating, and
share ``share`` times all words.  A target stops at ``max_epochs`` times its source's
words; the excess is shared by weight among the others until none is above.

Quotas: the documents of a source are put in hash order, laid end to end by their words,
and cut into blocks of about ``block_words``; a document belongs to the block in which it
begins.  The mix takes the first ``target`` words of that line, repeated, in whole
documents: the one that straddles the end is in if at least half of it is.  So every source
has an exact number of blocks to give, and misses its target by half a document at most.

Splitting tree: the root holds the quota of every source.  A node splits its shards in
two halves and draws the left half's share of every source from the multivariate
hypergeometric distribution; so all shards have equal numbers of blocks, each shard's
sources vary as a random draw would, and the quotas hold exactly.  A task walks from the
root into its own run of shards (random numbers come from the node, so all tasks agree),
which needs no exchange.  Blocks grow where the mix would have more than ``MAX_BLOCKS``.
Shards take disjoint runs of a permutation of each source's blocks
and are shuffled by the order key of their rows.

Words are counted next to the texts; running totals go by buckets of rows, so no source,
however large, is in one task.  Gathered on the driver is one quota per source.

Defined results
    null text or texts without a word: size 0, nothing taken
    null source: the rows without a source are one source, the last
    repeated rows: each row is a document; equal rows share their texts' hash order
    no words at all: targets 0
    extra input columns: carried in ``row``, whatever their names
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from policyscan.llm import prefix
from policyscan.llm.shingles import _SPACE, text_bytes
from policyscan.session import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
BLOCK_WORDS = 16_384
SHARD_WORDS = 4_000_000  # words of one output shard, unless a number of shards is given
SEED = 20
MAX_BLOCKS = 500_000_000  # numpy draws from fewer than 10^9; every source rounds up by a block or two
BLOCKS_PER_TASK = 20_000
MAX_TASKS = 10_000

_POSITIVE = (1 << 63) - 1
_CHUNK_BYTES = 4 << 20


def count_words(texts: pa.Array) -> np.ndarray:
    """Words of every text, counted over byte buffers of a bounded size (or one longer text)."""
    counts = []
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), _CHUNK_BYTES, side="right")))
        buffer, starts = text_bytes(texts.slice(begin, n))
        space = np.concatenate(([True], _SPACE[buffer]))
        begins = np.flatnonzero(space[:-1] & ~space[1:])
        counts.append(np.diff(np.searchsorted(begins, starts)))
        begin += n
    return np.concatenate([np.zeros(0, np.int64), *counts])


@F.pandas_udf(LongType())
def n_words(texts: pd.Series) -> pd.Series:
    return pd.Series(count_words(pa.Array.from_pandas(texts, type=pa.string())))


def targets(sources: DataFrame, share: float, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """``source``, ``source_size`` with ``rank`` (from 0) and ``target``; one row per source.

    Sources are capped in the order of cap over weight; the water level is that of the
    first source that its own level would not overfill.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(order) - 1)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumns(
        {
            "weight": cycle[F.col("rank") % len(weights)],
            "cap": F.col("source_size").cast("double") * max_epochs,
            "wanted": F.sum("source_size").over(Window.partitionBy()).cast("double") * share,
        }
    )
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    rest = ordered.rowsBetween(0, Window.unboundedFollowing)
    filled = ordered.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("wanted") - F.coalesce(F.sum("cap").over(filled), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = ranked.withColumn("level", level)
    reached = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "rank", "level"))
    water = F.min(reached).over(Window.partitionBy())["level"]
    return levels.withColumn("water", water).select(
        "source", "source_size", "rank", F.least("cap", F.coalesce("water", F.lit(np.inf)) * F.col("weight")).alias("target")
    )


def quota(goal: int, size: int, block_words: int) -> int:
    """Blocks that ``goal`` words of a source's repeated line touch."""
    if not size:
        return 0
    full, rest = divmod(goal, size)
    return full * -(-size // block_words) + -(-rest // block_words)


def run_draws(
    quotas: np.ndarray, shards: int, first: int, last: int, seed: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of every shard from ``first`` up to ``last``: its sources, where its blocks begin in each, how many.

    Walks the tree from the root into this run of shards alone; a node hands on only the
    sources it holds blocks of, so far down the work follows the blocks, not the sources.
    """
    total = int(quotas.sum())

    def upto(i: int) -> int:
        return i * total // shards

    present = np.flatnonzero(quotas)
    todo = [(0, shards, present, np.zeros(len(present), np.int64), quotas[present].astype(np.int64))]
    while todo:
        low, high, ranks, offsets, mine = todo.pop()
        if high <= first or low >= last or not len(ranks):
            continue
        if high - low == 1:
            yield low, ranks, offsets, mine
            continue
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = rng.multivariate_hypergeometric(mine, upto(middle) - upto(low), method="marginals")
        for edges, begin, part in (((middle, high), offsets + left, mine - left), ((low, middle), offsets, left)):
            held = np.flatnonzero(part)
            todo.append((*edges, ranks[held], begin[held], part[held]))


def path_draws(quotas: np.ndarray, shards: int, shard: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a shard's blocks begin in every source's permuted line, and how many they are."""
    begins, counts = np.zeros(len(quotas), np.int64), np.zeros(len(quotas), np.int64)
    for _, ranks, offsets, mine in run_draws(quotas, shards, shard, shard + 1, seed):
        begins[ranks], counts[ranks] = offsets, mine
    return begins, counts


def fitting_block(words: int, block_words: int) -> int:
    """Words of a block: ``block_words``, or more where the mix would have over ``MAX_BLOCKS`` blocks."""
    return max(block_words, -(-words // MAX_BLOCKS))


def permuted(position: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Block at each position of a permutation of ``n`` blocks: steps coprime to ``n``."""
    step = int(n * 0.6180339887498949) | 1
    while gcd(step, n) > 1:
        step += 1
    return (position.astype(np.int64) * step + seed) % n


def block_plan(docs: DataFrame, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """``rank``, ``block``, ``shard`` of every block that the mix takes."""
    held = np.array(quotas, np.int64)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            # A partition of the range is a run of shards without gaps.
            first, last = int(frame["id"].iloc[0]), int(frame["id"].iloc[-1]) + 1
            for shard, ranks, offsets, counts in run_draws(held, shards, first, last, seed):
                blocks = [
                    permuted(np.arange(offsets[k], offsets[k] + counts[k]), int(held[rank]), seed)
                    for k, rank in enumerate(ranks)
                ]
                yield pd.DataFrame({"rank": np.repeat(ranks, counts), "block": np.concatenate(blocks), "shard": shard})

    tasks = max(1, min(shards, MAX_TASKS, -(-int(held.sum()) // BLOCKS_PER_TASK)))
    return docs.sparkSession.range(0, shards, 1, tasks).mapInPandas(run, "rank int, block long, shard int")


def draw(
    docs: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    carried: list[str] | None = None,
    share: float = SHARE,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    block_words: int = BLOCK_WORDS,
    shards: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``.

    Columns: row (struct of the ``carried`` columns, all by default), size, source_size,
    target, draws: one struct per epoch that takes the document, with epoch, words (its
    size), shard and order_key (order of the rows within the shard).
    """
    carried = docs.columns if carried is None else carried
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"),
        F.col(f"`{source_col}`").alias("source"),
        n_words(F.col(f"`{text_col}`")).alias("size"),
        F.expr(f"xxhash64({seed}, `{id_col}`, `{text_col}`) & {_POSITIVE}L").alias("key"),
        F.col(f"`{id_col}`").alias("tie"),
    )
    if text_col not in carried:
        rows = stage(rows, "sized-documents")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    counted = stage(sources, "sources")
    aimed = targets(counted.select("source", "source_size"), share, weights, max_epochs)
    aimed = stage(aimed.withColumn("goal", F.round("target").cast("long")), "targets")
    held = aimed.orderBy("rank").select("goal", "source_size").collect()  # one row per source
    words = sum(r.goal for r in held)
    block_words = fitting_block(words, block_words)
    quotas = [quota(r.goal, r.source_size, block_words) for r in held]
    shards = shards or max(1, -(-words // SHARD_WORDS))
    plan = stage(block_plan(docs, quotas, shards, seed), "block-plan")

    known = aimed.select(F.col("source").alias("_source"), "source_size", "target", "goal", F.col("rank").alias("group"))
    placed = rows.join(known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    n_rows = counted.agg(F.sum("n_rows")).first()[0] or 0
    lined = prefix.running(placed, "group", ["key", "tie", "size"], {"start": "size"}, prefix.buckets(n_rows))
    draws = []
    for epoch in range(max_epochs):
        taken = f"CASE WHEN 2L * (goal - {epoch}L * source_size - start) >= size THEN size ELSE 0L END"
        block = f"{epoch}L * ceil(source_size / {block_words}D) + start div {block_words}L"
        mine = plan.select(
            F.col("rank").alias("group"), F.col("block").alias(f"b{epoch}"), F.col("shard").alias(f"s{epoch}")
        )
        lined = lined.withColumns({f"w{epoch}": F.expr(taken), f"b{epoch}": F.expr(f"CAST({block} AS bigint)")})
        lined = lined.join(mine, ["group", f"b{epoch}"], "left")
        draws.append(
            F.struct(
                F.lit(epoch).alias("epoch"),
                F.col(f"w{epoch}").alias("words"),
                F.col(f"s{epoch}").alias("shard"),
                F.xxhash64(F.lit(seed), F.lit(epoch), "key").alias("order_key"),
            )
        )
    return lined.select(
        "row", "size", "source_size", "target", F.filter(F.array(*draws), lambda d: d["words"] > 0).alias("draws")
    )


def mixed(docs: DataFrame, source_col: str = "source", text_col: str = "text", **settings) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken, dealt and shuffled."""
    drawn = draw(docs, source_col, text_col, **settings).select("row", F.explode("draws").alias("d"))
    dealt = drawn.repartition("d.shard").sortWithinPartitions("d.shard", "d.order_key")
    return dealt.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards of every document."""
    drawn = draw(docs, carried=["doc_id"])
    return drawn.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]).alias("taken"),
        F.transform("draws", lambda d: d["shard"]).alias("shards"),
    )
