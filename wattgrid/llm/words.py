"""Words of many texts at once, as numpy arrays over an Arrow text column.

A batch is cut into pieces of about ``PIECE`` bytes (a longer text is a piece
of its own), so the memory of a task follows the longest text, not the number
of rows in a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_SHINGLE = _U(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64 for i < n."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(PIECE * 2, n)
        inverse = pow(int(_BASE), -1, 1 << 64)
        for name, base in (("up", int(_BASE)), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial in the bytes, and the inverse powers: the
    hash of ``data[s:e]`` is ``(sums[e] - sums[s]) * down[s]``."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = data.astype(np.uint64)
    terms += _U(1)
    terms *= up[:len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums, down


class Piece:
    """Consecutive texts: their bytes, one after the other, and their bounds."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray):
        self.first = first      # row of the batch that the first text is in
        self.data = data        # uint8
        self.bounds = bounds    # int64, one more than there are texts

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i]:self.bounds[i + 1]].tobytes()


def pieces(column: pa.Array | pa.ChunkedArray, size: int = PIECE) -> Iterator[Piece]:
    """The texts of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or
                                  pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if n == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, values = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(bounds, bounds[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        lo, hi = bounds[at], bounds[end]
        yield Piece(at, data[lo:hi], bounds[at:end + 1] - lo)
        at = end


class Words:
    """Words of a piece: byte bounds, hash, and which words each text has."""

    def __init__(self, piece: Piece, inside: np.ndarray, fold: np.ndarray | None = None):
        """``inside[b]``: kind of byte ``b``, 0 if it belongs to no word; a word
        is a longest run of one kind.  ``fold``: table that maps bytes before
        they are looked at (lower-casing)."""
        data = piece.data if fold is None else fold[piece.data]
        self.data = data
        n = len(data)
        kind = np.zeros(n + 2, dtype=np.uint8)
        kind[1:-1] = inside[data]
        change = kind[1:] != kind[:-1]
        change[piece.bounds] = True
        self.start = np.flatnonzero((kind[1:-1] > 0) & change[:-1])
        self.end = np.flatnonzero((kind[1:-1] > 0) & change[1:]) + 1
        self.first = np.searchsorted(self.start, piece.bounds)
        sums, down = prefix_hash(data)
        self.sums, self.down = sums, down
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start])

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """For each word the text it is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def prefix(self, length: int) -> np.ndarray:
        """Hash of the first ``length`` bytes of each word (all, if shorter)."""
        end = np.minimum(self.start + length, self.end)
        return mix((self.sums[end] - self.sums[self.start]) * self.down[self.start])


def join_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive hashes, in their order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for j in range(1, k):
        total *= _SHINGLE
        total += hashes[j:j + n]
    return mix(total)


def byte_table(pattern_outside: bytes) -> np.ndarray:
    """``inside`` table of the bytes that do not occur in ``pattern_outside``."""
    inside = np.ones(256, dtype=bool)
    inside[np.frombuffer(pattern_outside, dtype=np.uint8)] = False
    return inside


#: a-z for A-Z, every other byte as it is.
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[65:91] += 32
#: Words between blanks: all bytes but 0x20 and 0x09-0x0D.
BETWEEN_BLANKS = byte_table(bytes([0x20, *range(0x09, 0x0E)]))
#: Words of letters, digits and all non-ASCII bytes (lower-cased text).
LETTERS_DIGITS = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def list_array(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))
