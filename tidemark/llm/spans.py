"""Words and hashes of many texts at once, over their bytes, in numpy.

A text's bytes get one running sum of (value of the byte) * BASE ** position, modulo 2 ** 64.
The hash of any stretch is then a difference of two sums, moved back to position 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
SECOND_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1


def _table(words: str) -> np.ndarray:
    table = np.zeros(256, bool)
    if words == "spaced":
        table[:] = True
        table[[0x20, *range(0x09, 0x0E)]] = False
    else:
        table[0x80:] = True
        table[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
    return table


#: Which bytes belong to words: those that are no ASCII white space.
IN_WORD = _table("spaced")


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a hash over all of it (a fixed, reversible mixing)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A value for each byte.
BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64, for i below n; kept, as every batch needs them."""
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(n, 1 << 16)
        made = []
        for factor in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, factor & _MASK, np.uint64)
            row[0] = 1
            made.append(np.cumprod(row, dtype=np.uint64))
        _powers[base] = (made[0], made[1])
    forward, back = _powers[base]
    return forward[:n], back[:n]


class Sums:
    """Hashes of stretches of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        forward, self.back = powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * forward[:-1], out=self.sums[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])

    def windows(self, size: int) -> np.ndarray:
        """The hash of each run of ``size`` values, by its start."""
        if len(self.sums) <= size:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])


def binary(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """One array of bytes with 64-bit offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column.cast(pa.large_binary())


class Texts:
    """The bytes of several texts in a row, and where each begins."""

    def __init__(self, column: pa.Array):
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = whole[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]

    def __len__(self) -> int:
        return len(self.offsets) - 1


def in_pieces(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, Texts]]:
    """First row and texts of runs of rows with up to ``limit`` bytes, or one longer text.

    Work arrays take some 60 bytes for a byte of text, so pieces bound memory.
    """
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, Texts(column.slice(at, end - at))
        at = end


class Words:
    """Where the words of ``texts`` begin and end, and a hash of each."""

    def __init__(self, texts: Texts, base: int = BASE):
        data = texts.bytes
        self.texts = texts
        inside = IN_WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[texts.offsets] = True
        before = np.empty(len(data), bool)
        before[:1] = False
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(len(data), bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.hash = Sums(BYTE_VALUE[data], base).between(self.start, self.end)
        self.bounds = np.searchsorted(self.start, texts.offsets)  # of each text's words
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def __len__(self) -> int:
        return len(self.start)

    def place(self) -> np.ndarray:
        """Number of each word within its text."""
        return np.arange(len(self)) - self.bounds[self.text]

    def runs(self, size: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``size`` words within one text."""
        first = np.arange(max(0, len(self) - size + 1))
        whole = self.text[first] == self.text[first + size - 1]
        return first[whole], Sums(self.hash, base).windows(size)[whole]


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``keys``, and where each distinct key begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return order, first


def covered(length: int, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Which of ``length`` places lie within any stretch of ``size`` from ``start``."""
    steps = np.zeros(length + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + size, -1)
    return np.cumsum(steps[:-1]) > 0


def found_in(wanted: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is among ``ordered``, and where."""
    at = np.searchsorted(ordered, wanted)
    at[at == len(ordered)] = 0
    return (ordered[at] == wanted if len(ordered) else np.zeros(len(wanted), bool)), at
