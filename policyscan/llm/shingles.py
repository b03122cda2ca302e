"""Word shingles of many texts at once, as 64-bit hashes, in numpy.

All texts of a batch are one byte buffer.  Words are runs of bytes other than
``\\x20\\x09-\\x0D``; the hash of a word is a difference of prefix sums, so the whole
batch is hashed without a loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over the word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        n = max(1 << 16, 1 << int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
        _powers["n"] = n
    return _powers["up"], _powers["down"]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, a blank after each, and the start of each text (one more at the end)."""
    values = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts.to_pylist()]
    starts = np.zeros(len(values) + 1, np.int64)
    np.cumsum([len(v) + 1 for v in values], out=starts[1:])
    return np.frombuffer(b" ".join(values) + b" ", np.uint8), starts


def words(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the text it is in, in order."""
    space = np.concatenate(([True], _SPACE[buffer]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    begin, end = edges[0::2], edges[1::2]
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    up, down = _power_tables(len(buffer) + 1)
    sums = np.zeros(len(buffer) + 1, np.uint64)
    np.cumsum(_BYTES[buffer] * up[: len(buffer)], out=sums[1:])
    hashed = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    return hashed, np.searchsorted(starts, begin, side="right") - 1


def shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles: text number, hash, occurrences; sorted by text, then hash.

    A text of fewer words than ``size`` has one shingle, all of its words.
    """
    hashed, owner = words(*text_bytes(texts))
    n = len(hashed)
    if not n:
        return owner, hashed, owner
    first = np.searchsorted(owner, np.arange(len(texts)), side="left")
    count = np.diff(np.append(first, n))
    padded = np.concatenate((hashed, np.zeros(size, np.uint64)))
    whole = np.zeros(n, np.uint64)
    position = np.arange(n)
    left = (first + count)[owner] - position
    for i in range(size):
        part = mix(padded[i : i + n] + _U((i + 1) * int(_BASE) % (1 << 64)))
        whole += np.where(left > i, part, _U(0)) * _U(2 * i + 3)
    valid = (left >= size) | ((position == first[owner]) & (count[owner] < size))
    whole, owner = mix(whole[valid]), owner[valid]
    order = np.lexsort((whole, owner))
    whole, owner = whole[order], owner[order]
    fresh = np.ones(len(whole), bool)
    fresh[1:] = (whole[1:] != whole[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], whole[at], np.diff(np.append(at, len(whole)))
