"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal texts are one group and go to one shard together.  The differencing
keeps partial partitions (one sum per shard) and repeatedly combines the two of largest
spread, oppositely ordered, so that their differences cancel.

Differencing needs all partial partitions in one place, so it is done as a tree: groups
are dealt by hash into buckets of a few thousand, each bucket is differenced to one
partial partition, and the partial partitions of the buckets are the items of the next
level, until one is left.  A bucket's task holds a bounded number of items, and what
goes up a level is one row per bucket.

Buckets of small items come out level, so nothing above could make up for a large item.
Items above a bucket's mean share of a shard are therefore placed first, by themselves,
and every bucket then differences its small items together with its part of what the
large ones left uneven.

A group larger than a whole shard cannot be indivisible in balanced shards (one group
may hold a third of all rows).  It is dealt by a hash of its ids into pieces of about a
quarter of a shard, and the pieces are the indivisible items.  Fewer groups than shards
can be so large, which bounds the broadcast of their list.

Slots are running counts within a shard in hash order, summed over buckets of rows.

Defined results
    null text: no bytes (size 1), a group of its own, apart from empty texts
    equal sizes and repeated rows: any row gets a slot of its own; reruns agree
    fewer groups than shards: some shards stay empty
    extra input columns: not read
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.llm import prefix
from policyscan.session import stage

SHARDS = 8
ITEMS_PER_BUCKET = 4096
PIECES_PER_SHARD = 4


def difference(sums: np.ndarray) -> np.ndarray:
    """Karmarkar-Karp over partial partitions.

    ``sums`` has one row per item and one column per shard.  Returns the shard that
    every column of every item ends in, as an array of the same shape.
    """
    n, shards = sums.shape
    values = [row for row in sums]
    # Children of every combination: (a, b, column of b that meets each column of a).
    merges: list[tuple[int, int, np.ndarray]] = []
    heap = [(-(int(row.max()) - int(row.min())), i) for i, row in enumerate(values)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        meets = np.empty(shards, np.int64)
        meets[np.argsort(-values[a], kind="stable")] = np.argsort(values[b], kind="stable")
        row = values[a] + values[b][meets]
        values.append(row)
        merges.append((a, b, meets))
        heapq.heappush(heap, (-(int(row.max()) - int(row.min())), len(values) - 1))
    ends = np.empty((len(values), shards), np.int64)
    # The largest sum of the whole becomes shard 0, and so on.
    ends[-1, np.argsort(-values[-1], kind="stable")] = np.arange(shards)
    for k in range(len(merges) - 1, -1, -1):
        a, b, meets = merges[k]
        ends[a] = ends[n + k]
        ends[b, meets] = ends[n + k]
    return ends[:n]


def _level(items: DataFrame, shards: int, n_items: int) -> DataFrame:
    """``item``, ``sums`` to ``item``, ``bucket``, ``sums``, ``ends`` (shard of every column in the bucket)."""
    n_buckets = -(-n_items // ITEMS_PER_BUCKET)
    dealt = items.select("item", F.expr(f"pmod(xxhash64(item, 17), {n_buckets}L)").alias("bucket"), "sums")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item")
        sums = np.array(group["sums"].tolist(), np.int64).reshape(len(group), shards)
        return group.assign(ends=difference(sums).tolist())

    schema = "item long, bucket long, sums array<long>, ends array<long>"
    return dealt.groupBy("bucket").applyInPandas(run, schema)


def _around(small: DataFrame, uneven: np.ndarray, n_small: int, n_bytes: int) -> DataFrame:
    """``item``, ``shard`` of small items, dealt so that they level out ``uneven`` (bytes per shard)."""
    shards, n_buckets = len(uneven), -(-n_small // ITEMS_PER_BUCKET)
    dealt = small.select("item", F.expr(f"pmod(xxhash64(item, 17), {n_buckets}L)").alias("bucket"), "bytes")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("item")
        own = group["bytes"].to_numpy(np.int64)
        # Another order of the shards in each bucket, so that ties do not add up.
        order = np.random.default_rng([int(group["bucket"].iloc[0]), 17]).permutation(shards)
        sums = np.zeros((len(own) + 1, shards), np.int64)
        sums[0] = (uneven[order] * (own.sum() / n_bytes)).astype(np.int64)
        sums[1:, 0] = own
        ends = difference(sums)
        shard_of = np.empty(shards, np.int64)
        shard_of[ends[0]] = order
        return pd.DataFrame({"item": group["item"], "shard": shard_of[ends[1:, 0]].astype(np.int32)})

    return dealt.groupBy("bucket").applyInPandas(run, "item long, shard int")


def balance(items: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``item`` (distinct long), ``bytes`` to ``item``, ``shard``."""
    counted = items.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
    n_items = counted["n"]
    if n_items > ITEMS_PER_BUCKET:
        bound = counted["bytes"] // (-(-n_items // ITEMS_PER_BUCKET) * shards)
        big = items.filter(F.col("bytes") > bound)
        over = big.agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).first()
        # Fewer than shards for every bucket; none when all items are about alike.
        if over["n"]:
            big = stage(big, "large-items")
            placed = stage(balance(big, shards), "large-shards")
            uneven = np.zeros(shards, np.int64)
            for r in big.join(placed, "item").groupBy("shard").agg(F.sum("bytes").alias("b")).collect():
                uneven[r["shard"]] = r["b"]
            small = items.filter(F.col("bytes") <= bound)
            rest = _around(small, uneven, n_items - over["n"], max(1, counted["bytes"] - over["bytes"]))
            return placed.unionByName(rest)
    first = F.concat(F.array(F.col("bytes").cast("long")), F.array_repeat(F.lit(0).cast("long"), shards - 1))
    now = items.select("item", first.alias("sums"))
    levels: list[DataFrame] = []
    while n_items:
        level = stage(_level(now, shards, n_items), f"differencing-{len(levels)}")
        levels.append(level)
        if n_items <= ITEMS_PER_BUCKET:
            break
        summed = level.select("bucket", F.posexplode(F.arrays_zip("sums", "ends")).alias("i", "x")).groupBy(
            "bucket", F.col("x.ends").alias("column")
        ).agg(F.sum("x.sums").alias("total"))
        now = summed.groupBy(F.col("bucket").alias("item")).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("column", "total"))), lambda s: s["total"]).alias("sums")
        )
        now = stage(now, f"partial-partitions-{len(levels)}")
        n_items = now.count()
    if not levels:
        return items.select("item", F.lit(0).alias("shard"))
    # From the last level down: the shard of every column of every bucket.
    ends = levels[-1].select("item", "ends")
    for level in reversed(levels[:-1]):
        above = ends.select(F.col("item").alias("bucket"), F.col("ends").alias("above"))
        ends = level.join(above, "bucket").select(
            "item", F.expr("transform(ends, e -> above[CAST(e AS INT)])").alias("ends")
        )
    return ends.select("item", F.col("ends")[0].cast("int").alias("shard"))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot."""
    text = F.col(f"`{text_col}`")
    encoded = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(encoded).alias("text_crc32"),
        F.concat(F.when(text.isNull(), "-").otherwise("="), F.md5(encoded)).alias("group"),
    )
    rows = stage(rows, "sized-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    piece = max(1, total // (shards * PIECES_PER_SHARD))
    large = rows.groupBy("group").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > max(1, total // shards))
    large = large.select("group", F.ceil(F.col("bytes") / F.lit(piece)).alias("pieces"))
    # At most as many groups as shards are larger than a shard.
    pieces = rows.join(F.broadcast(large), "group", "left").withColumn(
        "item", F.xxhash64("group", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("pieces")), F.lit(0).cast("long")))
    )
    pieces = stage(pieces.drop("pieces", "group"), "pieces")
    items = stage(pieces.groupBy("item").agg(F.sum("size").alias("bytes")), "items")
    placed = stage(pieces.join(stage(balance(items, shards), "shards"), "item"), "placed-rows")
    keyed = placed.withColumns(
        {"_order": F.expr(f"xxhash64(doc_id, text_crc32, item) & {(1 << 63) - 1}L"), "_one": F.lit(1).cast("long")}
    )
    slots = prefix.running(keyed, "shard", ["_order", "doc_id"], {"slot": "_one"}, prefix.buckets(keyed.count()))
    return slots.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
