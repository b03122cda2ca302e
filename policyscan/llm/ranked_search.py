"""Ranked lexical search: sharded block indexes and Block-Max MaxScore.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
lower-cased.  A document of n terms scores, over the query's distinct terms,

    w(term) * (1000000000 tf div (1000 tf + 20 m)),   m = 50 + (50 n N) div L,

with w(term) = floor(1000 ln((2N + 2) / (2 df + 1))); N documents hold a term, L is the sum
of their n.  All but w is in 64-bit integers, so results do not depend on the plan.

Index: every task cuts its part of the table into shards of ``shard_bytes`` of text and
inverts each by itself; nothing is shuffled.  A term's postings in a shard are cut into
blocks of ``block`` documents: distances and frequencies in the fewest bytes the block
needs, and beside them the block's last document, its largest tf and its smallest n.
These bound every score in the block, whatever N, L and df come out to be, so one read of
the texts yields both the index and the statistics.  The terms of a shard lie in ``PAGES``
rows by the leading bits of their hash, each page sorted by hash; terms are told apart by
their bytes.

Search: the postings of the queries' terms meet by shard.  In a shard each query's terms
are sorted by their global bounds; those whose bounds together stay below the score of
the best documents so far (the threshold) are non-essential.  Ranges of documents are
scored by the essential terms alone.  A candidate that the non-essential blocks' maxima
cannot lift to the threshold is rejected before any of those blocks is decompressed.
Decompressed blocks serve all queries of the shard.  Each shard returns a heap of the
``k`` best documents a query; heaps are merged in two levels.  The first
``priming_shards`` shards go ahead, and the k-th best scores they find are thresholds that
the others start with, which changes the work, not the result.

Queries reach the shards in groups of at most ``GROUP_TERMS`` terms (dealt by hash), so what
is sent along is bounded however many queries there are.

Defined results
    null text or text without a term: not a document (not in N), never found
    query without a term, or with terms no document holds: no rows
    equal scores: ascending doc_id, null ids last; repeated rows: a document each
    queries of equal id and text: one query; of equal id and other text: a query each
    very long text: a shard by itself
    empty tables: no rows
    extra input columns: not read
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from policyscan.llm.shingles import _BYTES, _power_tables, mix, text_bytes
from policyscan.session import stage

K = 50
GROUP_TERMS = 200_000
MERGES = 64
_CHUNK_BYTES = 1 << 20
PAGES = 64
_HEAD = 3  # numbers that describe a block: last document, largest tf, smallest n

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x30:0x3A] = _IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 32


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts; hash, begin, end and text number of every term, in order."""
    raw, starts = text_bytes(texts)
    buffer = _LOWERED[raw]
    inside = np.concatenate(([False], _IN_TERM[buffer], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edges[0::2], edges[1::2]
    # Hashes as in ``shingles``: differences of prefix sums.
    up, down = _power_tables(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTES[buffer] * up[: len(buffer)], out=sums[1:])
    hashed = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return buffer, hashed, begin, end, np.searchsorted(starts, begin, side="right") - 1


def packed_ids(ids: pa.Array) -> bytes:
    """Ids as 64-bit numbers, then a byte for each that is null."""
    missing = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes() + missing.astype(np.uint8).tobytes()


def unpacked_ids(data: bytes) -> list[int | None]:
    n = len(data) // 9
    values, missing = np.frombuffer(data, "<i8", n), np.frombuffer(data, np.uint8, n, 8 * n)
    return [None if gone else value for value, gone in zip(values.tolist(), missing.tolist(), strict=True)]


@dataclass(frozen=True)
class Layout:
    """Sizes of blocks, shards and ranges; an index is searched with the layout it was built with."""

    block: int = 128
    shard_bytes: int = 16 << 20
    shard_docs: int = 1 << 16
    range_docs: int = 2048
    priming_shards: int = 8


LAYOUT = Layout()


class Shard:
    """Terms of documents gathered until they are inverted."""

    def __init__(self, number: int, layout: Layout):
        self.number, self.layout = number, layout
        self.ids: list[pa.Array] = []
        self.hashes: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []
        self.words: list[tuple] = []  # of every part: distinct hashes, lengths and bytes of their terms
        self.n_docs = self.n_bytes = 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        buffer, hashed, begin, end, owner = terms_of(texts)
        held, owner = np.unique(owner, return_inverse=True)  # texts without a term are no documents
        self.ids.append(ids.take(pa.array(held)))
        self.hashes.append(hashed)
        self.owners.append((owner + self.n_docs).astype(np.int32))
        distinct, first = np.unique(hashed, return_index=True)
        sizes = (end - begin)[first]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin[first] - (ends - sizes), sizes)
        self.words.append((distinct, sizes, buffer[places]))
        self.n_docs += len(held)
        self.n_bytes += len(buffer)

    def full(self) -> bool:
        return self.n_bytes >= self.layout.shard_bytes or self.n_docs >= self.layout.shard_docs

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row for the documents (page -1), then one per page of terms."""
        if not self.n_docs:
            return
        hashed, owner = np.concatenate(self.hashes), np.concatenate(self.owners)
        lengths = np.bincount(owner, minlength=self.n_docs)
        ids = packed_ids(pa.concat_arrays(self.ids))
        yield self._row(-1, self.n_docs, len(owner), heads=lengths.astype("<i4").tobytes(), data=ids)
        order = np.argsort(hashed, kind="stable")
        hashed, owner = hashed[order], owner[order]
        fresh = np.ones(len(hashed), bool)
        fresh[1:] = (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(fresh)
        tf = np.diff(np.append(at, len(hashed)))
        hashed, owner = hashed[at], owner[at].astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], hashed[1:] != hashed[:-1])))
        terms, df = hashed[first], np.diff(np.append(first, len(hashed)))
        lists = compressed(owner, tf, lengths, first, df, self.layout.block)
        known = np.concatenate([h for h, _, _ in self.words])
        _, place = np.unique(known, return_index=True)  # sorted by hash, as ``terms`` is
        sizes = np.concatenate([n for _, n, _ in self.words])
        begins = (np.cumsum(sizes) - sizes)[place]
        sizes = sizes[place]
        spelled_at = np.concatenate(([0], np.cumsum(sizes)))
        places = np.arange(spelled_at[-1]) + np.repeat(begins - spelled_at[:-1], sizes)
        spelled = np.concatenate([w for _, _, w in self.words])[places]
        cuts = np.searchsorted(terms, np.arange(1, PAGES, dtype=np.uint64) << np.uint64(64 - PAGES.bit_length() + 1))
        for page, (low, high) in enumerate(zip([0, *cuts], [*cuts, len(terms)], strict=True)):
            if low < high:
                blocks, bytes_ = lists.block_at[[low, high]], lists.data_at[[low, high]]
                yield self._row(
                    page,
                    high - low,
                    int(df[low:high].sum()),
                    hashes=terms[low:high].astype("<u8").tobytes(),
                    df=df[low:high].astype("<i4").tobytes(),
                    spelled_at=(spelled_at[low : high + 1] - spelled_at[low]).astype("<i4").tobytes(),
                    spelled=spelled[spelled_at[low] : spelled_at[high]].tobytes(),
                    heads=lists.heads[blocks[0] : blocks[1]].astype("<i4").tobytes(),
                    widths=lists.widths[blocks[0] : blocks[1]].tobytes(),
                    data_at=(lists.data_at[low : high + 1] - bytes_[0]).astype("<i4").tobytes(),
                    data=lists.data[bytes_[0] : bytes_[1]].tobytes(),
                )

    def _row(self, page: int, n: int, total: int, **columns: bytes) -> pa.RecordBatch:
        row = [[self.number], [page], [n], [total], *([columns.get(c)] for c in _BINARY)]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _INDEX, strict=True)], schema=_INDEX)


_BINARY = ("hashes", "df", "spelled_at", "spelled", "heads", "widths", "data_at", "data")
_INDEX = pa.schema(
    [("shard", pa.int64()), ("page", pa.int32()), ("n", pa.int64()), ("total", pa.int64())] + [(c, pa.binary()) for c in _BINARY]
)
_INDEX_DDL = "shard long, page int, n long, total long, " + ", ".join(f"{c} binary" for c in _BINARY)


@dataclass
class Lists:
    """Packed posting lists: blocks in order, and where each list's blocks and bytes begin."""

    heads: np.ndarray
    widths: np.ndarray
    block_at: np.ndarray
    data: np.ndarray
    data_at: np.ndarray


def compressed(owner, tf, lengths, first, df, block_docs: int) -> Lists:
    """Blocks of all lists (list i: ``df[i]`` postings from ``first[i]`` on, documents ascending).

    A block is packed as the distances of its documents from one to the next, then their
    frequencies, each in 1, 2 or 4 bytes a number.
    """
    n = len(owner)
    blocks_of = -(-df // block_docs)
    block_at = np.concatenate(([0], np.cumsum(blocks_of)))
    listed = np.repeat(np.arange(len(df)), blocks_of)
    nth = np.arange(len(listed)) - block_at[listed]
    start = first[listed] + nth * block_docs
    count = np.minimum(df[listed] - nth * block_docs, block_docs)
    block = np.repeat(np.arange(len(start)), count)
    distance = np.empty(n, np.int64)
    distance[1:] = owner[1:] - owner[:-1]
    distance[first] = owner[first]  # a list's first document counts from 0
    top_tf = np.maximum.reduceat(tf, start)

    def width(top):
        return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))

    wide, wide_tf = width(np.maximum.reduceat(distance, start)), width(top_tf)
    ends = np.cumsum(count * (wide + wide_tf))
    begins = ends - count * (wide + wide_tf)
    data = np.zeros(int(ends[-1]), np.uint8)
    within = np.arange(n) - start[block]
    for values, widths, base in ((distance, wide, begins), (tf, wide_tf, begins + count * wide)):
        at, each = base[block] + within * widths[block], widths[block]
        for byte in range(4):
            rows = np.flatnonzero(each > byte)
            data[at[rows] + byte] = (values[rows] >> (8 * byte)) & 255
    heads = np.stack([owner[start + count - 1], top_tf, np.minimum.reduceat(lengths[owner], start)], axis=1)
    widths = (wide * 8 + wide_tf).astype(np.uint8)
    return Lists(heads, widths, block_at, data, np.append(begins[block_at[:-1]], len(data)))


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layout: Layout = LAYOUT) -> DataFrame:
    """The index of all documents, one row per shard and page of terms.

    Columns: shard, page, n (terms), total (postings) and the page's arrays.  Page -1 holds
    a shard's documents: n of them with ``total`` terms, lengths in heads, ids in data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(TaskContext.get().partitionId() << 24, layout)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            begin = 0
            while begin < len(sizes):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), _CHUNK_BYTES, side="right")))
                shard.add(batch.column(0).slice(begin, n), batch.column(1).slice(begin, n))
                begin += n
                if shard.full():
                    yield from shard.rows()
                    shard = Shard(shard.number + 1, layout)
        yield from shard.rows()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, _INDEX_DDL)


class Vocabulary:
    """Terms to look up in pages, numbered in the order of their hashes."""

    def __init__(self, terms: list[str]):
        buffer, hashed, begin, end, _ = terms_of(pa.array(terms, pa.string()))
        order = np.argsort(hashed, kind="stable")
        self.hashes = hashed[order]
        self.spelled = [bytes(buffer[a:b]) for a, b in zip(begin[order].tolist(), end[order].tolist(), strict=True)]
        self.number = {t: i for i, t in enumerate(self.spelled)}

    def find(self, hashes: bytes, spelled_at: bytes, spelled: bytes) -> Iterator[tuple[int, int]]:
        """Number of every term that a page holds, and its place there."""
        held, at = np.frombuffer(hashes, "<u8"), np.frombuffer(spelled_at, "<i4")
        low, high = np.searchsorted(self.hashes, held[[0, -1]])
        for number in range(low, min(high + 1, len(self.hashes))):
            place = int(np.searchsorted(held, self.hashes[number]))
            # Two terms of one hash would be one list in the index; that this one is spelled alike is checked.
            if place < len(held) and spelled[at[place] : at[place + 1]] == self.spelled[number]:
                yield number, place


@dataclass
class Statistics:
    """Of all documents: how many hold a term, their terms."""

    n_docs: int
    n_terms: int

    def damping(self, n: np.ndarray) -> np.ndarray:
        """What the length of a document adds to its occurrence counts."""
        return 20 * (50 + (50 * n.astype(np.int64) * self.n_docs) // self.n_terms)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))


def parts(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
    """What occurrence counts add to scores, before the term's weight."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + damping)


class Postings:
    """One term's list in a shard; blocks are decompressed when asked for, once."""

    def __init__(self, heads: bytes, widths: bytes, data: bytes, df: int, weight: int, statistics: Statistics, damping, block: int):
        heads = np.frombuffer(heads, "<i4").reshape(-1, _HEAD)
        self.data, self.weight, self.damping, self.widths, self.block = data, weight, damping, widths, block
        self.last = heads[:, 0].astype(np.int64)
        self.bounds = weight * parts(heads[:, 1], statistics.damping(heads[:, 2]))
        self.bound = int(self.bounds.max())
        self.df, self.closed = df, len(self.last)
        self.documents = self.scored = self.begins = self.opened = None

    def _prepare(self) -> None:
        blocks = len(self.last)
        count = np.full(blocks, self.block)
        count[-1] = self.df - self.block * (blocks - 1)
        wide, wide_tf = np.divmod(np.frombuffer(self.widths, np.uint8).astype(np.int64), 8)
        ends = np.cumsum(count * (wide + wide_tf))
        self.begins, self.wide, self.wide_tf = (ends - count * (wide + wide_tf)).tolist(), wide.tolist(), wide_tf.tolist()
        self.opened = np.zeros(blocks, bool)
        # A closed block's documents read as its last one, which keeps the list in order.
        self.documents, self.scored = np.repeat(self.last, count), np.zeros(self.df, np.int64)

    def open(self, blocks: np.ndarray) -> None:
        if self.opened is None:
            self._prepare()
        if not self.closed:
            return
        for b in blocks[~self.opened[blocks]].tolist():
            low, high = b * self.block, min((b + 1) * self.block, self.df)
            count, place = high - low, self.begins[b]
            distances = np.frombuffer(self.data, f"<u{self.wide[b]}", count, place)
            tf = np.frombuffer(self.data, f"<u{self.wide_tf[b]}", count, place + count * self.wide[b])
            documents = np.cumsum(distances, dtype=np.int64)
            if b:
                documents += self.last[b - 1]
            self.documents[low:high] = documents
            self.scored[low:high] = self.weight * parts(tf, self.damping[documents])
            self.opened[b] = True
            self.closed -= 1

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Postings of the documents from ``low`` up to ``high``."""
        first, after = np.searchsorted(self.last, (low, high - 1))
        self.open(np.arange(first, min(after + 1, len(self.last))))
        a, b = np.searchsorted(self.documents, (low, high))
        return self.documents[a:b], self.scored[a:b]

    def block_bounds(self, documents: np.ndarray) -> np.ndarray:
        """Bound of the block that would hold each document, 0 beyond the last."""
        at = np.searchsorted(self.last, documents)
        return np.where(at < len(self.last), self.bounds[np.minimum(at, len(self.last) - 1)], 0)

    def scores(self, documents: np.ndarray) -> np.ndarray:
        """Exact scores of ascending documents; opens only the blocks they fall in."""
        at = np.searchsorted(self.last, documents)
        self.open(np.unique(at[at < len(self.last)]))
        place = np.minimum(np.searchsorted(self.documents, documents), self.df - 1)
        return np.where(self.documents[place] == documents, self.scored[place], 0)


def best(lists: list[Postings], n_docs: int, keys: np.ndarray, k: int, floor: int, range_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best documents of a shard with at least ``floor`` (and more than 0), and their scores.

    ``keys`` ranks the documents' ids.  Block-Max MaxScore, a range of documents at a time.
    """
    lists = sorted(lists, key=lambda p: p.bound)
    upto = np.cumsum([p.bound for p in lists])
    top, top_scores, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), max(1, floor)
    for low in range(0, n_docs, range_docs):
        high = min(low + range_docs, n_docs)
        split = int(np.searchsorted(upto, threshold))  # lists before it cannot reach the threshold together
        if split == len(lists):
            break
        total = np.zeros(high - low, np.int64)
        for postings in lists[split:]:
            documents, scores = postings.between(low, high)
            total[documents - low] += scores
        candidates = np.flatnonzero(total)
        scored = total[candidates]
        candidates += low
        if split:
            rest = [p.block_bounds(candidates) for p in lists[:split]]
            possible = scored + np.sum(rest, axis=0)
            for i in range(split - 1, -1, -1):  # the largest bounds first
                stay = possible >= threshold
                candidates, scored, possible = candidates[stay], scored[stay], possible[stay]
                rest = [r[stay] for r in rest[: i + 1]]
                if not len(candidates):
                    break
                exact = lists[i].scores(candidates)
                scored = scored + exact
                possible = possible - rest[i] + exact
        stay = scored >= threshold
        if not stay.any():
            continue
        top, top_scores = np.concatenate((top, candidates[stay])), np.concatenate((top_scores, scored[stay]))
        if len(top) > k:
            order = np.lexsort((keys[top], -top_scores))[:k]
            top, top_scores = top[order], top_scores[order]
        if len(top) == k:
            threshold = max(threshold, int(top_scores.min()))
    return top, top_scores


def _document_counts(pages: DataFrame, vocabulary: Vocabulary) -> dict[int, int]:
    """How many documents hold each term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(vocabulary.spelled), np.int64)
        for batch in batches:
            for hashes, spelled_at, spelled, df in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = np.frombuffer(df, "<i4")
                for number, place in vocabulary.find(hashes, spelled_at, spelled):
                    sums[number] += counts[place]
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], names=["term", "df"])

    rows = pages.select("hashes", "spelled_at", "spelled", "df").mapInArrow(run, "term long, df long")
    return {r["term"]: r["df"] for r in rows.groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _postings(pages: DataFrame, vocabulary: Vocabulary, block: int) -> DataFrame:
    """shard, term (number), df, heads, widths, data of the vocabulary's lists; term -1 for the documents."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = ["shard", "term", "df", "heads", "widths", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, page, n, *columns = (batch.column(i)[row].as_py() for i in range(batch.num_columns))
                values = dict(zip(_BINARY, columns, strict=True))
                out = []
                if page < 0:
                    out.append((shard, -1, n, values["heads"], b"", values["data"]))
                else:
                    df, data_at = (np.frombuffer(values[c], "<i4") for c in ("df", "data_at"))
                    block_at = np.concatenate(([0], np.cumsum(-(-df // block))))
                    for number, place in vocabulary.find(values["hashes"], values["spelled_at"], values["spelled"]):
                        a, b = int(block_at[place]), int(block_at[place + 1])
                        heads = values["heads"][4 * _HEAD * a : 4 * _HEAD * b]
                        data = values["data"][int(data_at[place]) : int(data_at[place + 1])]
                        out.append((shard, number, int(df[place]), heads, values["widths"][a:b], data))
                if out:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = pages.select("shard", "page", "n", *_BINARY)
    return rows.mapInArrow(run, "shard long, term long, df long, heads binary, widths binary, data binary")


def _search_shards(found: DataFrame, queries: list[list[int]], weights: dict[int, int], statistics: Statistics,
                   floors: dict[int, int], k: int, layout: Layout) -> DataFrame:
    """Heaps of every shard: query (number), doc_id, score.  ``queries`` lists their terms' numbers."""

    def run(rows: pa.Table) -> pa.Table:
        held = list(zip(*(rows.column(c).to_pylist() for c in ("term", "df", "heads", "widths", "data")), strict=True))
        lengths, ids = next((np.frombuffer(heads, "<i4"), unpacked_ids(data)) for t, _, heads, _, data in held if t < 0)
        order = sorted(range(len(ids)), key=lambda d: (ids[d] is None, ids[d]))
        keys = np.empty(len(ids), np.int64)
        keys[order] = np.arange(len(ids))
        damping = statistics.damping(lengths)
        known = {
            t: Postings(heads, widths, data, df, weights[t], statistics, damping, layout.block)
            for t, df, heads, widths, data in held
            if t >= 0
        }
        out: list[tuple] = []
        for number, terms in enumerate(queries):
            lists = [known[t] for t in terms if t in known]
            if lists:
                top, scores = best(lists, len(lengths), keys, k, floors.get(number, 0), layout.range_docs)
                out += [(number, ids[d], s) for d, s in zip(top.tolist(), scores.tolist(), strict=True)]
        return pa.table([pa.array([row[c] for row in out], pa.int64()) for c in range(3)], ["query", "doc_id", "score"])

    return found.groupBy("shard").applyInArrow(run, "query long, doc_id long, score long")


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every query, in two levels so that no task holds all heaps of a query."""
    dealt = heaps.withColumn("part", F.expr(f"pmod(xxhash64(doc_id, score), {MERGES}L)"))
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
    first = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order)))
    first = first.filter(F.col("rank") <= k).drop("part", "rank")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).filter(F.col("rank") <= k)


def distinct_queries(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, terms of every distinct query that has a term."""
    rows = queries.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("_text")).distinct()
    lowered = F.translate("_text", UPPER, LOWER)
    terms = F.array_sort(F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({TERM})"), F.lit(1))))
    return rows.select("item", terms.alias("terms")).filter(F.size("terms") > 0)


def search(
    indexed: DataFrame,
    queries: DataFrame,
    id_col: str = "item_id",
    text_col: str = "text",
    k: int = K,
    layout: Layout = LAYOUT,
) -> DataFrame:
    """The ``k`` best documents of an index (written, see ``index``) for every query.

    Columns: item_id, rank (from 1), doc_id, score.
    """
    spark = indexed.sparkSession
    about, pages = indexed.filter("page < 0"), indexed.filter("page >= 0")
    sums = about.agg(F.sum("n").alias("n"), F.sum("total").alias("terms")).first()
    asked = stage(distinct_queries(queries, id_col, text_col), "queries")
    kind = asked.schema["item"].dataType.simpleString()
    n_terms = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    if not n_terms or not sums["n"]:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    statistics = Statistics(sums["n"], sums["terms"])
    priming = [r["shard"] for r in about.select("shard").orderBy("shard").limit(layout.priming_shards).collect()]
    groups = -(-n_terms // GROUP_TERMS)
    results = []
    for group in range(groups):
        # At most about GROUP_TERMS terms, or one query.
        rows = asked.filter(F.expr(f"pmod(xxhash64(terms), {groups}L) = {group}")).collect()
        vocabulary = Vocabulary(sorted({t for r in rows for t in r["terms"]}))
        df = _document_counts(pages, vocabulary)
        weights = {number: statistics.weight(count) for number, count in df.items()}
        wanted = [[vocabulary.number[t.encode()] for t in r["terms"]] for r in rows]
        found = stage(_postings(indexed, vocabulary, layout.block), "postings")
        ahead = F.col("shard").isin(priming)
        first = stage(_search_shards(found.filter(ahead), wanted, weights, statistics, {}, k, layout), "first-heaps")
        kth = _merged(first, k).filter(F.col("rank") == k).select("query", "score").collect()  # one per query
        floors = {r["query"]: r["score"] for r in kth}
        others = _search_shards(found.filter(~ahead), wanted, weights, statistics, floors, k, layout)
        merged = _merged(first.unionByName(others), k)
        names = spark.createDataFrame([(n, r["item"]) for n, r in enumerate(rows)], f"query long, item_id {kind}")
        ranked = merged.join(F.broadcast(names), "query")
        results.append(stage(ranked.select("item_id", "rank", "doc_id", "score"), "ranked"))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def rank(docs: DataFrame, queries: DataFrame, k: int = K, layout: Layout = LAYOUT) -> DataFrame:
    """All ``docs`` (doc_id, text) ranked for every query (item_id, text)."""
    return search(stage(index(docs, layout=layout), "search-index"), queries, k=k, layout=layout)


ORACLE = r"""
WITH terms AS (
    SELECT doc_id, row_number() OVER () AS d,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
    FROM documents WHERE text IS NOT NULL
),
sized AS (SELECT doc_id, d, len(ts) AS n, ts FROM terms WHERE len(ts) > 0),
totals AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nl FROM sized),
tfs AS (SELECT d, t, count(*)::BIGINT AS tf FROM (SELECT d, unnest(ts) AS t FROM sized) GROUP BY d, t),
asked AS (
    SELECT DISTINCT item_id, text, unnest(list_distinct(
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t
    FROM benchmark
),
weights AS (
    SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM tfs, totals WHERE t IN (SELECT t FROM asked) GROUP BY t, nd
),
scores AS (
    SELECT item_id, text, d,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // nl))))::BIGINT AS score
    FROM asked JOIN weights USING (t) JOIN tfs USING (t) JOIN (SELECT d, n FROM sized) USING (d), totals
    GROUP BY item_id, text, d
),
ranked AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item_id, scores.text ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
    FROM scores JOIN sized USING (d) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
