"""Near-duplicate documents by ProbMinHash over weighted five-word shingles.

The similarity is the probability Jaccard similarity of two weighted sets: with weights
x and y it is the sum over shared shingles i of 1 / sum_j max(x_j / x_i, y_j / y_i).
Weights are occurrences; for texts without repeated shingles it is the plain Jaccard
similarity.

Signatures: every shingle is a Poisson process whose rate is its weight.  Its arrivals
fall on random signature places, each place keeps its earliest arrival, and a text is
done when its next arrivals come later than all of its places (early termination).  Two
texts keep the same shingle at a place with the probability of their similarity.

Candidates: signatures are cut into bands; texts that agree on a band share a bucket.
With the default 48 bands of 6, a pair of similarity 0.8 meets in some bucket with
probability 1 - 4e-7, one of similarity 0.2 with 0.003.

Verification: exact similarity from the texts.  In a bucket every text is first compared
with one leader only, the member with the most company in all of its buckets (the
original of a family of copies rather than one of them).  Texts that this leaves outside
the leader's component are then compared with the bucket's other components, block by
block inside tasks that return spanning links only.  So no pair is lost, while the pairs
within a family of copies are never listed.

Equal texts are one text throughout: copies are grouped by hash before anything else and
join their representative at the end.

Defined results
    null texts and texts without a word: a class of their own, always kept
    texts of one to four words: one shingle, all of the words
    null doc_id: class null, kept
    repeated doc_id: the id is one document; ``keep_one`` leaves one row of equal texts
    ties: the class id is the smallest doc_id of the class
    extra input columns: not read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.llm.components import components
from policyscan.llm.shingles import mix, shingles
from policyscan.session import stage

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 48
ROWS = 6

_U = np.uint64
_CHUNK_DOCS = 512
_CHUNK_BYTES = 4 << 20
_BLOCK_TEXTS = 256
_MATRIX_COLUMNS = 4096
# Arrivals that one step draws for each shingle of a text with at most so many shingles.
_STEPS = ((4, 256), (32, 48), (256, 8), (1 << 62, 2))


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many texts and, unless one text is longer, so many bytes."""
    sizes = pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(sizes):
        reach = np.searchsorted(np.cumsum(sizes[begin : begin + _CHUNK_DOCS]), _CHUNK_BYTES, side="right")
        n = max(1, int(reach))
        yield batch.slice(begin, n)
        begin += n


def signatures(owner: np.ndarray, hashed: np.ndarray, weight: np.ndarray, n: int, places: int) -> np.ndarray:
    """Signature (the earliest shingle of every place) of ``n`` texts; 0 for texts without shingles."""
    earliest = np.full((n, places), np.inf)
    chosen = np.zeros((n, places), np.uint64)
    per_text = np.bincount(owner, minlength=n)
    low = 0
    for high, step in _STEPS:
        mine = (per_text > low) & (per_text <= high)
        low = high
        active = np.flatnonzero(mine[owner])
        clock = np.zeros(len(active))
        draw = 0
        while len(active):
            seed = hashed[active][:, None] + (np.arange(draw, draw + step, dtype=np.uint64) * _U(0xD1342543DE82EF95))
            first = mix(seed)
            second = mix(first ^ _U(0x5851F42D4C957F2D))
            gap = -np.log1p(-(first >> _U(11)).astype(np.float64) * 2.0**-53) / weight[active][:, None]
            time = clock[:, None] + np.cumsum(gap, axis=1)
            place = (owner[active][:, None] * places + (second % _U(places)).astype(np.int64)).ravel()
            flat, times = earliest.ravel(), time.ravel()
            useful = times < flat[place]
            place, times = place[useful], times[useful]
            np.minimum.at(flat, place, times)
            won = times == flat[place]
            chosen.ravel()[place[won]] = np.broadcast_to(hashed[active][:, None], time.shape).ravel()[useful][won]
            clock = time[:, -1]
            touched = np.unique(owner[active])
            latest = np.zeros(n)
            latest[touched] = earliest[touched].max(axis=1)
            stay = clock < latest[owner[active]]
            active, clock = active[stay], clock[stay]
            draw += step
    return chosen


def band_keys(chosen: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    keys = np.zeros((len(chosen), bands), np.uint64)
    for i in range(rows):
        keys = mix(keys * _U(0x9E3779B97F4A7C15) + chosen[:, i : bands * rows : rows])
    return mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * _U(0xD1342543DE82EF95)).view(np.int64)


def signed(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``text`` to ``doc_id``, ``n`` shingles, ``bands`` (their keys)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                owner, hashed, weight = shingles(part.column("text"), size)
                count = np.bincount(owner, minlength=len(part))
                chosen = signatures(owner, hashed, weight, len(part), bands * rows)
                keys = band_keys(chosen, bands, rows)
                offsets = np.concatenate(([0], np.cumsum(np.where(count > 0, bands, 0)))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("digest"),
                        pa.array(count),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[count > 0].ravel())),
                    ],
                    names=["doc_id", "digest", "n", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, digest binary, n long, bands array<long>")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard similarity of two weighted sets (sorted hashes, weights)."""
    if not len(a[0]) or not len(b[0]):
        return 0.0
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    both = (x > 0) & (y > 0)
    if not both.any():
        return 0.0
    # max(x_j / x_i, y_j / y_i) is the first where x_j / y_j >= x_i / y_i, the second elsewhere.
    with np.errstate(divide="ignore"):
        ratio = np.where(y > 0, x / np.where(y > 0, y, 1), np.inf)
    order = np.argsort(ratio, kind="stable")
    below = np.concatenate(([0.0], np.cumsum(y[order])))
    above = np.concatenate((np.cumsum(x[order][::-1])[::-1], [0.0]))
    at = np.searchsorted(ratio[order], ratio[both], side="left")
    return float((1.0 / (above[at] / x[both] + below[at] / y[both])).sum())


def verify(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """The pairs ``a``, ``b`` whose texts are similar enough.

    ``texts`` is a written table of ``doc_id``, ``text``; both joins have plain scans
    below their shuffles, so a leader with many pairs is split.
    """
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, None

        def weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
            return shingles(pa.array([text]), size)[1:]

        for batch in batches:
            similar = []
            for a, text_a, text_b in zip(
                batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b"), strict=True
            ):
                if a != last:
                    last, known = a, weighted(text_a.as_py())
                similar.append(similarity(known, weighted(text_b.as_py())) >= least)
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    return joined.mapInArrow(run, "a long, b long")


def candidate_buckets(texts: DataFrame) -> DataFrame:
    """Written table of the shared buckets: key, id, leader (of the bucket).

    ``texts`` has ``id`` and ``bands``.  The leader is the member with the most company
    over all of its buckets, ties by the smaller id.
    """
    entries = texts.select("id", F.explode("bands").alias("key"))
    shared = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-buckets")
    hits = stage(entries.join(shared, "key").select("key", "id", "n"), "bucket-members")
    company = hits.groupBy("id").agg(F.sum("n").alias("company"))
    ranked = hits.join(company, "id").groupBy("key")
    leaders = ranked.agg(F.min(F.struct((-F.col("company")).alias("less"), F.col("id"))).alias("first"))
    leaders = stage(leaders.select("key", F.col("first.id").alias("leader")), "leaders")
    return stage(hits.join(leaders, "key").select("key", "id", "leader"), "led")


def intersections(owner: np.ndarray, hashed: np.ndarray, n: int) -> np.ndarray:
    """Shared distinct shingles of every two of ``n`` texts, as products of 0/1 matrices."""
    known, column, times = np.unique(hashed, return_inverse=True, return_counts=True)
    shared = times > 1
    column = (np.cumsum(shared) - 1)[column][shared[column]]
    row = owner[shared[np.searchsorted(known, hashed)]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), _MATRIX_COLUMNS):
        begin, end = np.searchsorted(column, [low, low + _MATRIX_COLUMNS])
        part = np.zeros((n, _MATRIX_COLUMNS), np.float32)
        part[row[begin:end], column[begin:end] - low] = 1
        total += part @ part.T
    return total


def similar_pairs(texts: list[str], apart: np.ndarray, size: int, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``texts`` that are similar enough, among those marked in the square matrix ``apart``."""
    owner, hashed, weight = shingles(pa.array(texts, pa.string()), size)
    n = len(texts)
    count = np.bincount(owner, minlength=n)
    repeated = np.zeros(n, bool)
    repeated[owner[weight > 1]] = True
    shared = intersections(owner, hashed, n)
    plain = shared >= least * (count[:, None] + count[None, :] - shared) - 1e-3
    weighted = repeated[:, None] | repeated[None, :]
    close = np.triu(apart & (shared > 0) & (plain | weighted), 1)
    first = np.searchsorted(owner, np.arange(n + 1))
    kept = []
    for a, b in zip(*np.nonzero(close), strict=True):
        x = hashed[first[a] : first[a + 1]], weight[first[a] : first[a + 1]]
        y = hashed[first[b] : first[b + 1]], weight[first[b] : first[b + 1]]
        if similarity(x, y) >= least:
            kept.append((a, b))
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def remaining_edges(led: DataFrame, edges: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Links between texts of one bucket that ``edges`` leave in different components.

    Buckets with the same members are compared once.  A bucket's members are dealt by
    hash into blocks, and every two blocks are compared in one task, which returns links
    that span what it found similar, never all of its pairs.
    """
    found = stage(components(edges), "star-components").select(F.col("node").alias("id"), "component")
    placed = led.join(found, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    placed = stage(placed, "placed")
    # Members in numbers; sums of hashes tell sets of members apart.
    open_keys = (
        placed.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("members"),
        )
        .filter("low <> high")
        .groupBy("n", "low", "high", "members")
        .agg(F.min("key").alias("key"))
        .select("key", F.ceil(F.col("n") / _BLOCK_TEXTS).alias("n_blocks"))
    )
    spread = placed.join(stage(open_keys, "open-buckets"), "key").withColumn("own", F.expr("pmod(xxhash64(id), n_blocks)"))
    spread = spread.select(
        "key", "id", "component", "own", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("other")
    ).select("key", "id", "component", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    with_texts = stage(spread, "open-members").join(texts.withColumnRenamed("doc_id", "id"), "id")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        own, part = frame["own"].to_numpy(), frame["component"].to_numpy()
        apart = part[:, None] != part[None, :]
        if i != j:  # pairs within a block are compared where it meets itself
            apart &= own[:, None] != own[None, :]
        ids = frame["id"].to_numpy(np.int64)
        a, b = similar_pairs(frame["text"].tolist(), apart, size, least)
        root = ids.copy()
        while len(a):
            before = root.copy()
            np.minimum.at(root, a, root[b])
            np.minimum.at(root, b, root[a])
            if (root == before).all():
                break
        linked = ids != root
        return pd.DataFrame({"a": root[linked], "b": ids[linked]})

    return with_texts.groupBy("key", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of its class), kept."""
    narrow = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.unhex(F.md5(F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8"))).alias("digest"),
    )
    table = stage(signed(narrow, size, bands, rows), "signatures")
    linkable = table.filter("n > 0 AND doc_id IS NOT NULL")
    texts = linkable.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    texts = stage(texts, "distinct-texts")
    led = candidate_buckets(texts.select("id", "bands"))

    wanted = led.select(F.col("id").alias("doc_id")).distinct()
    wanted = stage(narrow.select("doc_id", "text").join(wanted, "doc_id", "left_semi"), "candidate-texts")
    stars = led.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    edges = stage(verify(stars, wanted, size, least), "star-edges")
    rest = stage(remaining_edges(led, edges, wanted, size, least), "remaining-edges")
    found = stage(components(edges.unionByName(rest)), "classes")

    copies = table.select("doc_id", "digest", "n").join(texts.select("digest", "id"), "digest", "left")
    placed = copies.join(found.select(F.col("node").alias("id"), "component"), "id", "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "id"))
    class_id = F.coalesce(own, F.col("doc_id"))
    return placed.select(
        "doc_id",
        class_id.alias("class_id"),
        F.coalesce(F.col("doc_id") == class_id, F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id.

    Of rows that repeat an id and its text one stays; rows without an id all stay.
    """
    gone = classes(docs, id_col, text_col, **settings).filter(~F.col("kept"))
    gone = stage(gone.select(F.col("doc_id").alias("_gone_id")).distinct(), "duplicates")
    left = docs.join(gone, F.col(f"`{id_col}`") == F.col("_gone_id"), "left_anti")
    again = left.groupBy(f"`{id_col}`").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if again.filter(F.col(f"`{id_col}`").isNotNull()).isEmpty():
        return left
    # Rows without an id are always kept, whatever other rows repeat.
    known = F.col(f"`{id_col}`").isNotNull()
    return left.filter(known).dropDuplicates([id_col, text_col]).unionByName(left.filter(~known))
