"""Packing of documents into training sequences by order-preserving dynamic programming.

Documents become ids of a public byte-level vocabulary, each closed by an end id, and are
laid end to end in the order of the table.  A window of that line is a sequence.  Cuts may
stand at document ends (free), at sentence ends and, inside a sentence, after every
``SOFT_TOKENS`` ids without another place to cut (both truncate a document and carry a
penalty).  With cuts at places p0 < p1 < ... the cost is

    sum over windows of padding(length) + penalty(cut),

where the padding up to the capacity is zero for lengths that are a power of two.  The best
cost D(j) of a line ending at place j is the least, over places i within the capacity, of
D(i) + p(i), which a monotone queue holds at its head, plus what depends on j alone; and of
D(i) for the few places a power of two before j.  So the work is linear in the places.

The job is narrow: every task packs its part of the table as a stream, without a shuffle.
It plans ``PLAN_TOKENS`` ids at a time, commits all but the last windows and carries the rest
on, so its memory is bounded but for the ids of the document at hand; only the last windows
of a task see an end of the line that is not the table's.

Ids are taken by the rank form of the vocabulary, whose results equal those of the
tokenizer file (tested); texts it refuses (blanks by the million) go to the tokenizer file
itself.  Long texts are encoded in parts, cut where two words always part.

Defined results
    null or empty text: the end id alone
    a special token's string in a text: the special id, as the tokenizer file has it
    very long texts: pieces in as many sequences as they need
    repeated rows, null ids: a document of its own each
    empty tables: no rows
    extra input columns: not read
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructType

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPECIAL = {"<|endoftext|>": 50256}
CAPACITY = 1024
END_ID = 0
SENTENCE_PENALTY = 8
SOFT_PENALTY = 16
SOFT_TOKENS = 8
PLAN_TOKENS = 1 << 18
_PART_CHARS = 1 << 18
_BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
_CHUNK_BYTES = 1 << 20


class Encoder:
    """Ids of texts, and which ids end a sentence."""

    def __init__(self, tokenizer: str, ranks: str):
        import tiktoken

        self.path, self.slow = tokenizer, None
        with open(ranks, "rb") as lines:
            pieces = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=pieces, special_tokens=SPECIAL)
        size = max(max(pieces.values()), *SPECIAL.values()) + 1
        self.ends, self.closes, self.opens = (np.zeros(size, bool) for _ in range(3))
        for piece, rank in pieces.items():
            bare = piece.rstrip(b"\"')]")
            self.ends[rank] = bare.endswith((b".", b"!", b"?"))
            self.closes[rank] = piece.endswith((b"\n", "。".encode(), "！".encode(), "？".encode()))
            self.opens[rank] = piece[:1].isspace()

    def _whole(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # a run of blanks beyond what the pattern's machine holds
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text and the end id."""
        parts, begin = [], 0
        while text and begin < len(text):
            found = _BETWEEN_WORDS.search(text, begin + _PART_CHARS)
            end = found.start() if found else len(text)
            parts.append(self._whole(text[begin:end]))
            begin = end
        return np.concatenate([*parts, np.array([END_ID], np.uint32)]).astype(np.uint32, copy=False)

    def sentence_ends(self, ids: np.ndarray) -> np.ndarray:
        """Whether a sentence ends with each id: closed by a mark, and a blank or nothing follows."""
        after = np.append(self.opens[ids[1:]], True)
        return self.closes[ids] | (self.ends[ids] & after)


@lru_cache(maxsize=2)
def encoder(tokenizer: str, ranks: str) -> Encoder:
    return Encoder(tokenizer, ranks)


def places(ids: np.ndarray, document_ends: np.ndarray, model: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Where the line may be cut, from 0 on, and the penalty of a cut there."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[1:][model.sentence_ends(ids)] = SENTENCE_PENALTY
    penalty[document_ends] = 0
    penalty[[0, -1]] = [0, max(0, penalty[-1])]
    hard = np.flatnonzero(penalty >= 0)
    more = (np.diff(hard) - 1) // SOFT_TOKENS
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    penalty[np.repeat(hard[:-1], more) + step * SOFT_TOKENS] = SOFT_PENALTY
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def cuts(at: np.ndarray, penalty: np.ndarray, capacity: int = CAPACITY) -> list[int]:
    """Places (indices into ``at``) that cut the line at least cost; no gap of ``at`` exceeds the capacity."""
    n = len(at)
    # Places a power of two before each place; the capacity itself is the queue's.
    pairs = []
    for exponent in range(capacity.bit_length()):
        power = 1 << exponent
        if power < capacity:
            before = np.searchsorted(at, at - power)
            later = np.flatnonzero(at[np.minimum(before, n - 1)] == at - power)
            pairs.append((later, before[later]))
    later, before = (np.concatenate(x) for x in zip(*pairs, strict=True))
    order = np.argsort(later, kind="stable")
    first = np.searchsorted(later[order], np.arange(n + 1)).tolist()
    before, where, extra = before[order].tolist(), at.tolist(), penalty.tolist()
    cost, back = [0] * n, [0] * n
    queue, keys, head = [0], [0], 0  # places by rising D(i) + p(i)
    for j in range(1, n):
        here = where[j]
        low = here - capacity
        while where[queue[head]] < low:
            head += 1
        best, came = keys[head] + capacity - here, queue[head]
        for k in range(first[j], first[j + 1]):
            if cost[before[k]] < best:
                best, came = cost[before[k]], before[k]
        best += extra[j]
        cost[j], back[j] = best, came
        key = best + here
        while len(queue) > head and keys[-1] > key:
            queue.pop()
            keys.pop()
        queue.append(j)
        keys.append(key)
    path = [n - 1]
    while path[-1]:
        path.append(back[path[-1]])
    return path[::-1]


class Line:
    """The documents not yet in a sequence, laid end to end."""

    def __init__(self, model: Encoder, capacity: int, first_sequence: int):
        self.model, self.capacity, self.sequence = model, capacity, first_sequence
        self.parts: list[np.ndarray] = []
        self.rows: list[tuple] = []  # key, ids of the document, ids of it that are already placed
        self.held = 0

    def add(self, key, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.rows.append((key, len(ids), 0))
        self.held += len(ids)

    def packed(self, last: bool) -> Iterator[dict]:
        """Pieces of the windows that are settled, in column form; all of them if ``last``."""
        while self.held >= PLAN_TOKENS or (last and self.held):
            ids = np.concatenate(self.parts)
            sizes = np.array([total - placed for _, total, placed in self.rows], np.int64)
            starts = np.cumsum(sizes) - sizes
            plan = min(PLAN_TOKENS, len(ids))
            ends = (starts + sizes)[starts + sizes <= plan]
            at, penalty = places(ids[:plan], ends, self.model)
            path = at[cuts(at, penalty, self.capacity)]
            if plan < len(ids) or not last:
                path = path[:-2] if len(path) > 3 else path[:-1]  # the end may not be a place to cut
            yield self._pieces(ids, starts, path)
            self._drop(ids, starts, sizes, int(path[-1]))

    def _pieces(self, ids: np.ndarray, starts: np.ndarray, path: np.ndarray) -> dict:
        begins = np.union1d(path[:-1], starts[starts < path[-1]])
        stops = np.append(begins[1:], path[-1])
        document = np.searchsorted(starts, begins, side="right") - 1
        window = np.searchsorted(path, begins, side="right") - 1
        line = memoryview(np.ascontiguousarray(ids[: path[-1]], "<u4")).cast("B")
        keys, totals, placed = zip(*[self.rows[d] for d in document.tolist()], strict=True)
        out = {
            "key": list(keys),
            "start": begins - starts[document] + np.array(placed, np.int64),
            "length": stops - begins,
            "ids_crc32": [zlib.crc32(line[4 * a : 4 * b]) for a, b in zip(begins.tolist(), stops.tolist(), strict=True)],
            "doc_tokens": np.array(totals, np.int64),
            "sequence_id": self.sequence + window,
            "offset": begins - path[window],
            "ids": (ids[: path[-1]], begins),
        }
        self.sequence += len(path) - 1
        return out

    def _drop(self, ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, end: int) -> None:
        kept = int(np.searchsorted(starts + sizes, end, side="right"))
        rows = self.rows[kept:]
        if rows and starts[kept] < end:
            key, total, placed = rows[0]
            rows[0] = (key, total, placed + end - int(starts[kept]))
        self.rows, self.parts, self.held = rows, [ids[end:]], len(ids) - end


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = True,
    tokenizer: str = TOKENIZER,
    ranks: str = RANKS,
) -> DataFrame:
    """One row per piece: a run of one document's ids in one sequence.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, unless
    left out, ids.  The pieces of a sequence, by offset, are its content.
    """
    schema = StructType().add("doc_id", docs.select(F.col(f"`{id_col}`")).schema[0].dataType)
    for name in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"):
        schema = schema.add(name, LongType())
    if with_ids:
        schema = schema.add("ids", ArrayType(IntegerType(), False))

    def batch_of(out: dict, id_type: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array(out["key"], id_type)]
        columns += [pa.array(out[f.name], pa.int64()) for f in schema.fields[1:7]]
        if with_ids:
            ids, begins = out["ids"]
            offsets = pa.array(np.append(begins, len(ids)).astype(np.int32))
            columns.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32))))
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, id_type = encoder(tokenizer, ranks), None
        line = Line(model, capacity, TaskContext.get().partitionId() << 40)
        for batch in batches:
            id_type = batch.schema.field(0).type
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
            begin = 0
            while begin < len(sizes):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), _CHUNK_BYTES, side="right")))
                part = batch.slice(begin, n)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    line.add(key, model.ids(text))
                begin += n
                for out in line.packed(last=False):
                    yield batch_of(out, id_type)
        for out in line.packed(last=True):
            yield batch_of(out, id_type)

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, schema)
