"""SentencePiece encoding and decoding by batched Viterbi in numpy.

The text is normalised as the model's identity rule does: one blank is put in front and
blanks become the word mark.  No piece holds a mark after another character, so a text
splits before every run of marks that follows something else, and the splits (words) are
encoded apart.  Distinct words of a batch are encoded once; words of equal length advance
together, one character per step:

* every substring of at most the longest piece is hashed by rolling sums and looked up
  in the sorted piece keys by binary search;
* at every end position the pieces ending there are compared, and the best start is
  stored as a backpointer by a vectorised maximum.

``unigram`` models take the start with the highest total score.  The public model file
is a ``bpe`` model: there scores are merge ranks and their sums mean nothing.  Its
segmentation is the one path on which every two neighbours are *stable* (merging the two
by rank again gives the same two pieces), so a start is scored 1 when its piece is stable
after the last piece of the best path to that start, else 0.  Ties go to the longer piece.
The result equals the ids of the model's own library.

Words are found and told apart in the bytes of a whole chunk of texts, by 64-bit hashes from
differences of prefix sums; only words not met before become strings.  A long word (a text
without blanks) is first cut where two neighbouring characters stand side by side in no
piece: nothing merges across such a border, so its parts are encoded apart, each distinct
part once.

Marks before a word merge after everything else, so a run of marks is encoded by its
length.  Characters outside the pieces become byte pieces (or the unknown id, for models
without them).  Work is narrow: one row of ids per text, no shuffle.

Defined results
    null text: null ids; empty text: no ids
    a text that holds the word mark itself decodes with blanks in its place
    very long words: in parts; what no border cuts advances by itself, linear in its length
    ids out of range: an error; control ids decode to nothing
    extra input columns: passed through
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from policyscan.llm.shingles import _BYTES, _power_tables, mix

_U = np.uint64
MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_CHUNK_BYTES = 900_000
_CHUNK_IDS = 1 << 19
_CACHE_WORDS = 250_000
_TABLE_BITS = 18
_LONG = 48  # characters from which a word is cut where no piece spans two neighbours
_UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BASE = _U(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Model:
    """Pieces of a SentencePiece model, prepared for look-ups; plain arrays, bounded by the vocabulary."""

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: list[int] | None, unknown: int, kind: str,
                 hidden: set[int] = frozenset(), prefix: bool = True):
        """``hidden``: ids that never match text (control, byte, unknown); ``kind``: bpe or unigram."""
        self.text = [p for p, _ in pieces]
        self.score = np.array([s for _, s in pieces], np.float64)
        self.bytes, self.unknown, self.kind, self.hidden, self.prefix = byte_ids, unknown, kind, hidden, prefix
        plain = [i for i in range(len(pieces)) if i not in hidden and self.text[i]]
        self.longest = max((len(self.text[i]) for i in plain), default=1)
        keys = np.array([self._key(_codes(self.text[i])) for i in plain], np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids = keys[order], np.array(plain, np.int64)[order]
        self.first = np.searchsorted(self.keys, np.arange(1 << 20, dtype=np.uint64) << _U(44))
        self.probes = int(np.bincount((self.keys >> _U(44)).astype(np.int64), minlength=1).max()) if plain else 0
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a key")
        self.lookup = {self.text[i]: i for i in plain}
        # Characters that stand side by side in some piece.
        codes = [_codes(self.text[i]).astype(np.int64) for i in plain]
        self.neighbours = np.unique(np.concatenate([np.zeros(0, np.int64), *((c[:-1] << 21) + c[1:] for c in codes)]))
        self.met = self.met_ok = None  # made by the worker that uses them
        self.runs: dict[int, list[int]] = {}  # bounded: cleared with the words
        if kind == "bpe":
            self._split_pieces()

    @staticmethod
    def _key(codes: np.ndarray) -> int:
        with np.errstate(over="ignore"):
            total = _U(0)
            for c in codes:
                total = total * _BASE + _mix(np.array([c], np.uint64) + _U(1))[0]
        return int(total)

    @staticmethod
    def load(path: str = MODEL) -> "Model":
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        pieces = [(library.id_to_piece(i), library.get_score(i)) for i in range(n)]
        hidden = {i for i in range(n) if library.is_control(i) or library.is_byte(i) or library.is_unknown(i) or library.is_unused(i)}
        found = {library.id_to_piece(i): i for i in range(n) if library.is_byte(i)}
        byte_ids = [found[f"<0x{b:02X}>"] for b in range(256)] if len(found) == 256 else None
        # Scores of merge ranks fall by one from piece to piece; log probabilities do not.
        shown = np.array([s for i, (_, s) in enumerate(pieces) if i not in hidden and s > -1e8])
        kind = "bpe" if len(shown) and (shown == np.round(shown)).all() else "unigram"
        return Model(pieces, byte_ids, library.unk_id(), kind, hidden)

    def _split_pieces(self) -> None:
        """For every piece the two pieces it was last merged from; -1 for one character."""
        n = len(self.text)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.canonical = np.array([len(p) == 1 for p in self.text])  # those that merging by rank can reach
        pair_keys, pair_rank = [], []
        for piece, i in self.lookup.items():
            for cut in range(1, len(piece)):
                a, b = self.lookup.get(piece[:cut]), self.lookup.get(piece[cut:])
                if a is not None and b is not None:
                    pair_keys.append(a * n + b)
                    pair_rank.append(self.score[i])
            if len(piece) > 1:
                parts = self.merge(piece, stop=2)
                if len(parts) == 2 and all(p in self.lookup for p in parts):
                    self.left[i], self.right[i] = self.lookup[parts[0]], self.lookup[parts[1]]
                    self.canonical[i] = True
        order = np.argsort(np.array(pair_keys, np.int64), kind="stable")
        self.pair_keys = np.array(pair_keys, np.int64)[order]
        self.pair_rank = np.array(pair_rank)[order]

    def merge(self, word: str, stop: int = 1) -> list[str]:
        """Merges one short word by rank, best score first, leftmost of ties, down to ``stop`` parts."""
        parts = list(word)
        while len(parts) > stop:
            best, at = -np.inf, -1
            for k in range(len(parts) - 1):
                i = self.lookup.get(parts[k] + parts[k + 1])
                if i is not None and self.score[i] > best:
                    best, at = self.score[i], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Piece id of every key, -1 where there is none: probes by the leading bits of the sorted keys."""
        at = self.first[(keys >> _U(44)).astype(np.int64)]
        out = np.full(keys.shape, -1, np.int64)
        for step in range(self.probes):
            place = np.minimum(at + step, len(self.keys) - 1)
            hit = self.keys[place] == keys
            out[hit] = self.ids[place[hit]]
        return out

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Score of the merge of two pieces; minus infinity where they do not merge."""
        if not len(self.pair_keys):
            return np.full(len(a), -np.inf)
        keys = a * len(self.text) + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        known = (self.pair_keys[at] == keys) & (a >= 0) & (b >= 0)
        return np.where(known, self.pair_rank[at], -np.inf)

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging by rank keeps the border between the pieces ``a`` and ``b``.

        Walks both pieces back to their single characters, always undoing the later
        (worse) merge.  A merge across the border that was possible at some moment and
        came before the merge that ended that moment would have been taken.
        """
        score = self.score
        ok = np.ones(len(a), bool)
        a, b = a.copy(), b.copy()
        # Score and side (True: right) of the merge that ended the present moment.
        until, by_right = np.full(len(a), -np.inf), np.ones(len(a), bool)
        live = np.flatnonzero((a >= 0) & (b >= 0))
        while len(live):
            x, y = a[live], b[live]
            across = self.rank(x, y)
            # Of equal ranks the left one goes first: the border is left of the right piece's merges.
            taken = (across > until[live]) | ((across == until[live]) & by_right[live] & np.isfinite(across))
            ok[live[taken]] = False
            split_x = np.where(self.left[x] >= 0, score[x], np.inf)
            split_y = np.where(self.left[y] >= 0, score[y], np.inf)
            go = ~taken & (np.isfinite(split_x) | np.isfinite(split_y))
            live, x, y, split_x, split_y = live[go], x[go], y[go], split_x[go], split_y[go]
            undo_right = split_y <= split_x
            until[live] = np.where(undo_right, split_y, split_x)
            by_right[live] = undo_right
            a[live] = np.where(undo_right, x, self.right[x])
            b[live] = np.where(undo_right, self.left[y], y)
        return ok

    def stay_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``stable`` from a table of the pairs met so far: one slot per hash, the last pair stays in it."""
        if self.met is None:
            self.met, self.met_ok = np.full(1 << _TABLE_BITS, -1, np.int64), np.zeros(1 << _TABLE_BITS, bool)
        width = len(self.text) + 1
        pairs = (a + 1) * width + b + 1

        def slots(keys: np.ndarray) -> np.ndarray:
            return ((keys.astype(_U) * _BASE) >> _U(64 - _TABLE_BITS)).astype(np.int64)

        place = slots(pairs)
        ok = self.met_ok[place]
        missed = np.flatnonzero(self.met[place] != pairs)
        if len(missed):
            fresh, back = np.unique(pairs[missed], return_inverse=True)
            answers = self.stable(fresh // width - 1, fresh % width - 1)
            ok[missed] = answers[back]
            place = slots(fresh)
            self.met[place], self.met_ok[place] = fresh, answers
        return ok

    def run(self, n: int) -> list[int]:
        """Ids of ``n`` word marks that merge with nothing else: leftmost first, in one sweep."""
        if n not in self.runs:
            parts: list[int] = []
            for _ in range(n):
                if not parts or MARK * (parts[-1] + 1) not in self.lookup:
                    parts.append(1)
                    continue
                parts[-1] += 1
                while len(parts) > 1 and MARK * (parts[-2] + parts[-1]) in self.lookup:
                    parts[-2:] = [parts[-2] + parts[-1]]
            self.runs[n] = [self.lookup[MARK * p] for p in parts]
        return self.runs[n]

    def _fallback(self, code: int) -> list[int]:
        if self.bytes is None:
            return [self.unknown]
        return [self.bytes[b] for b in chr(code).encode("utf-8", "surrogatepass")]

    def words(self, words: list[str]) -> list[list[int]]:
        """Ids of every word; words of equal length are encoded together."""
        flat, offsets = self.ragged(words)
        return [flat[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]

    def ragged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's begin (one more at the end)."""
        lengths = np.array([len(w) for w in words], np.int64)
        parts, order, sizes = [], [], []
        for length in np.unique(lengths[lengths > 0]):
            rows = np.flatnonzero(lengths == length)
            step = max(1, (1 << 20) // int(length * min(length, self.longest)))
            for begin in range(0, len(rows), step):
                part = rows[begin : begin + step]
                codes = _codes("".join([words[r] for r in part])).reshape(len(part), length)
                flat, counts = self._viterbi(codes)
                parts.append(flat)
                order.append(part)
                sizes.append(counts)
        counts = np.zeros(len(words), np.int64)
        if not parts:
            return np.zeros(0, np.int32), np.zeros(len(words) + 1, np.int64)
        order, sizes = np.concatenate(order), np.concatenate(sizes)
        counts[order] = sizes
        begins = np.zeros(len(words), np.int64)
        begins[order] = np.cumsum(sizes) - sizes
        offsets = np.concatenate(([0], np.cumsum(counts)))
        return np.concatenate(parts)[gather(begins, counts)], offsets

    def _viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, length = codes.shape
        reach = min(self.longest, length)
        # found[l - 1][:, i]: the piece of l characters from i on.
        mixed = _mix(codes.astype(np.uint64) + _U(1))
        found, keys = [], np.zeros((n, length), np.uint64)
        for size in range(1, reach + 1):
            keys = keys[:, : length - size + 1] * _BASE + mixed[:, size - 1 :]
            found.append(self.find(keys))
        worst = self.score[self.ids].min() - 10 if len(self.ids) else -10.0
        best = np.full((n, length + 1), -np.inf)
        best[:, 0] = 0
        last = np.full((n, length + 1), -1, np.int64)
        start = np.zeros((n, length + 1), np.int64)
        for end in range(1, length + 1):
            sizes = np.arange(min(reach, end), 0, -1)  # longest first: argmax takes it in ties
            ids = np.stack([found[s - 1][:, end - s] for s in sizes], axis=1)
            known = ids >= 0
            known[:, -1] = True  # one character: a byte or unknown piece at least
            before = best[:, end - sizes]
            if self.kind == "unigram":
                gain = np.where(ids >= 0, self.score[ids], worst)
                total = np.where(known, before + gain, -np.inf)
            else:
                total = np.where(known & (ids >= 0) & ~self.canonical[ids], -np.inf, np.where(known, before, -np.inf))
                word, which = np.nonzero(np.isfinite(total))
                previous, piece = last[word, end - sizes[which]], ids[word, which]
                ok = self.stay_apart(previous, piece)
                total[word[~ok], which[~ok]] = -np.inf
            pick = total.argmax(axis=1)
            rows = np.arange(n)
            best[:, end] = total[rows, pick]
            last[:, end] = ids[rows, pick]
            start[:, end] = end - sizes[pick]
        # All words walk their backpointers together; ids come out last piece first.
        rows, at = np.arange(n), np.full(n, length)
        path = np.full((n, length), -2, np.int64)
        for step in range(length):
            live = at > 0
            if not live.any():
                break
            path[live, step] = last[rows[live], at[live]]
            at[live] = start[rows[live], at[live]]
        path = path[:, ::-1]
        taken = path != -2
        counts, flat = taken.sum(axis=1), path[taken].astype(np.int32)
        odd = np.flatnonzero((path == -1).any(axis=1))
        offsets, parts, done = np.concatenate(([0], np.cumsum(counts))), [], 0
        for row in odd:
            spelled, position = [], 0
            for piece in flat[offsets[row] : offsets[row + 1]].tolist():
                spelled += [piece] if piece >= 0 else self._fallback(int(codes[row, position]))
                position += len(self.text[piece]) if piece >= 0 else 1
            parts += [flat[done : offsets[row]], np.array(spelled, np.int32)]
            done = offsets[row + 1]
            counts[row] = len(spelled)
        return np.concatenate([*parts, flat[done:]]), counts

    def units(self, text: str) -> list[str]:
        """The words of a text, each with the marks before it."""
        if not text:
            return []
        return _UNITS.findall((MARK if self.prefix else "") + text.replace(" ", MARK))

    def parts_of(self, word: str) -> list[str]:
        """A long word, cut at every border that no piece spans."""
        codes = _codes(word).astype(np.int64)
        pairs = (codes[:-1] << 21) + codes[1:]
        at = np.minimum(np.searchsorted(self.neighbours, pairs), max(0, len(self.neighbours) - 1))
        apart = self.neighbours[at] != pairs if len(self.neighbours) else np.ones(len(pairs), bool)
        cuts = [0, *(np.flatnonzero(apart) + 1).tolist(), len(word)]
        return [word[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def long_and_short(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``ragged`` with long words in parts."""
        long = [k for k, w in enumerate(words) if len(w) > _LONG]
        if not long:
            return self.ragged(words)
        parts: list[str] = []
        first = np.zeros(len(words) + 1, np.int64)
        done = 0
        for k in long:
            parts += words[done:k]
            first[done : k + 1] = np.arange(len(parts) - (k - done), len(parts) + 1)
            parts += self.parts_of(words[k])
            done = k + 1
        first[done : len(words)] = np.arange(len(parts), len(parts) + len(words) - done)
        parts += words[done:]
        first[-1] = len(parts)
        distinct = {part: i for i, part in enumerate(dict.fromkeys(parts))}
        flat, offsets = self.ragged(list(distinct))
        which = np.array([distinct[part] for part in parts], np.int64)
        sizes = np.diff(offsets)[which]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return flat[gather(offsets[:-1][which], sizes)], ends[first]

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of every unit as one array with offsets."""
        if self.kind == "unigram":
            return self.long_and_short(units)
        # Most units are one mark and a word; runs of marks are taken off the others.
        odd = [k for k, u in enumerate(units) if u[0] != MARK or u[1:2] in ("", MARK)]
        words = list(units)
        for k in odd:
            bare = units[k].lstrip(MARK)
            words[k] = (MARK if len(bare) < len(units[k]) else "") + bare if bare else ""
        flat, offsets = self.long_and_short(words)
        if not odd:
            return flat, offsets
        mark, parts, counts, done = self.lookup.get(MARK), [], np.diff(offsets), 0
        for k in odd:
            marks = len(units[k]) - len(units[k].lstrip(MARK))
            ids = flat[offsets[k] : offsets[k + 1]]
            if not words[k]:
                ids = np.array(self.run(marks), np.int32)
            elif marks and ids[0] == mark:
                ids = np.concatenate((np.array(self.run(marks), np.int32), ids[1:]))
            elif marks > 1:
                ids = np.concatenate((np.array(self.run(marks - 1), np.int32), ids))
            parts += [flat[done : offsets[k]], ids]
            done = offsets[k + 1]
            counts[k] = len(ids)
        return np.concatenate([*parts, flat[done:]]), np.concatenate(([0], np.cumsum(counts)))

    def encode_ragged(self, texts: list[str | None], known: "Known") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        front = b" " if self.prefix else b""
        values = [front + t.replace(MARK, " ").encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        buffer = np.frombuffer(b"".join(values), np.uint8)
        ends = np.cumsum([len(v) for v in values])
        starts = ends - [len(v) for v in values]
        if not len(buffer):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        # A unit begins with each text and with each run of blanks after something else.
        blank = buffer == 0x20
        opens = np.zeros(len(buffer), bool)
        opens[1:] = blank[1:] & ~blank[:-1]
        opens[starts[starts < ends]] = True
        begin = np.flatnonzero(opens)
        end = np.append(begin[1:], len(buffer))
        up, down = _power_tables(len(buffer) + 1)
        sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(_BYTES[buffer] * up[: len(buffer)], out=sums[1:])
        hashed = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(_U))
        distinct, first, which = np.unique(hashed, return_index=True, return_inverse=True)
        if len(known.hashes) > _CACHE_WORDS:
            known.clear()
            self.runs.clear()
        new = np.flatnonzero(~known.holds(distinct))
        if len(new):
            data = buffer.tobytes()
            spelled = [
                data[a:b].decode("utf-8", "surrogatepass").replace(" ", MARK)
                for a, b in zip(begin[first[new]].tolist(), end[first[new]].tolist(), strict=True)
            ]
            known.add(distinct[new], *self.encode_units(spelled))
        places = known.places(distinct)[which]
        sizes = known.sizes[places]
        flat = known.flat[gather(known.begins[places], sizes)]
        total = np.concatenate(([0], np.cumsum(sizes)))
        unit = np.searchsorted(begin, np.concatenate(([0], ends)))
        return flat, np.diff(total[unit])

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of every text."""
        flat, counts = self.encode_ragged(texts, Known())
        pieces = np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []
        return [None if t is None else ids for t, ids in zip(texts, pieces, strict=True)]

    def decode_ragged(self, flat: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of consecutive runs of ids."""
        if not hasattr(self, "surface"):
            raw = {i: b for b, i in enumerate(self.bytes or [])}
            shown = [
                bytes([raw[i]]) if i in raw else b"" if i in self.hidden else p.replace(MARK, " ").encode("utf-8", "surrogatepass")
                for i, p in enumerate(self.text)
            ]
            shown[self.unknown] = " \u2047 ".encode()
            self.surface = np.frombuffer(b"".join(shown), np.uint8)
            self.surface_sizes = np.array([len(b) for b in shown], np.int64)
            self.surface_begins = np.cumsum(self.surface_sizes) - self.surface_sizes
        sizes = self.surface_sizes[flat]
        data = self.surface[gather(self.surface_begins[flat], sizes)].tobytes()
        ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts)))]
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in texts]

    def decode(self, rows: list[list[int] | None]) -> list[str | None]:
        """Texts of every row of ids."""
        flat = np.array([i for ids in rows for i in ids or ()], np.int64)
        texts = self.decode_ragged(flat, np.array([len(ids or ()) for ids in rows], np.int64))
        return [None if ids is None else t for ids, t in zip(rows, texts, strict=True)]


def gather(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of consecutive runs that begin at ``begins``."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)


class Known:
    """Ids of the distinct units met so far, by hash; bounded by ``_CACHE_WORDS`` and one batch."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted, and their words' places
        self.flat, self.begins, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _at(self, hashes: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return self.hashes[self._at(hashes)] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        return self.order[self._at(hashes)]

    def add(self, hashes: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> None:
        """Ids of words that are not held yet; ``hashes`` ascending."""
        at = np.searchsorted(self.hashes, hashes)
        self.order = np.insert(self.order, at, np.arange(len(hashes)) + len(self.begins))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.begins = np.concatenate((self.begins, offsets[:-1] + len(self.flat)))
        self.sizes = np.concatenate((self.sizes, np.diff(offsets)))
        self.flat = np.concatenate((self.flat, flat))


def _chunks(sizes: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Begin and length of runs of rows whose sizes come to at most ``most``, or one row."""
    sizes = sizes.fill_null(0).to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(sizes):
        n = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), most, side="right")))
        yield begin, n
        begin += n


def encode(docs: DataFrame, model: Model, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with a column of ids (array of int); an input column of that name is replaced."""
    docs = docs.drop(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            for begin, n in _chunks(pc.binary_length(batch.column(text_col)), _CHUNK_BYTES):
                part = batch.slice(begin, n)
                texts = part.column(text_col)
                flat, counts = model.encode_ragged(texts.to_pylist(), known)
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=texts.is_null())
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, ids_col])

    schema = StructType([*docs.schema.fields]).add(ids_col, ArrayType(IntegerType(), False))
    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, model: Model, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with a column of texts decoded from ids; an input column of that name is replaced."""
    docs = docs.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, n in _chunks(pc.list_value_length(batch.column(ids_col)), _CHUNK_IDS):
                part = batch.slice(begin, n)
                ids = part.column(ids_col)
                counts = pc.list_value_length(ids).fill_null(0).to_numpy(zero_copy_only=False)
                texts = model.decode_ragged(ids.flatten().to_numpy(zero_copy_only=False), counts.astype(np.int64))
                decoded = pa.array(texts, pa.string(), mask=ids.is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, out_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(out_col, StringType()))
