"""Words of whole Arrow batches as numpy arrays.

A task sees the UTF-8 bytes of many texts as one buffer. Words are found by a byte table and hashed
eight bytes at a time, all words together, so no Python object is made per word. All separators are
ASCII, which makes byte tables exact for UTF-8. Buffers are taken in blocks of a megabyte; only a single
longer text makes a longer block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
LONG = 512  # bytes of a span that is hashed by itself
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15

#: space and \t \n \v \f \r separate words
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: everything ASCII but digits and letters separates words
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[128:] = False
for _first, _last in ("09", "az", "AZ"):
    NOT_ALNUM[ord(_first) : ord(_last) + 1] = False

LOWER = np.arange(256, dtype=np.uint8)  # A-Z only
LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass(frozen=True)
class Block:
    """Texts ``lo`` to ``hi`` of a batch: their bytes, and where each begins (one more at the end)."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return self.hi - self.lo

    def text(self, i: int) -> str:
        return bytes(self.data[self.offsets[i] : self.offsets[i + 1]]).decode("utf-8")

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many of the marked bytes each text has."""
        at = np.flatnonzero(marks)
        return np.diff(np.searchsorted(at, self.offsets))


def blocks(texts: pa.Array | pa.ChunkedArray, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """A NULL text counts as an empty one."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield Block(lo, hi, whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


@dataclass(frozen=True)
class Words:
    """Byte positions of the words of a block, and for each text the range of its words."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(block: Block, separators: np.ndarray) -> Words:
    inside = ~separators[block.data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = block.offsets[(block.offsets > 0) & (block.offsets < len(inside))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return Words(starts, np.flatnonzero(last) + 1, np.searchsorted(starts, block.offsets))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _SAME) -> np.ndarray:
    """Hash of each byte span after mapping bytes by ``table``.

    Eight bytes after the other are mixed in; mixing is not linear, so spans of a regular structure are
    told apart like any others. Few spans are long, they are hashed each by a cryptographic hash.
    """
    mapped = np.zeros(len(data) + 8, np.uint8)
    mapped[: len(data)] = data if table is _SAME else table[data]
    eights = np.ndarray(len(data) + 1, "<u8", mapped, strides=(1,))  # from every byte on
    length = ends - starts
    out = mix(length.astype(_U) + _U(_BASE))
    left = np.flatnonzero((length > 0) & (length <= LONG))
    at, rest = starts[left], length[left]
    while len(left):
        part = eights[at]
        short = np.flatnonzero(rest < 8)
        part[short] &= (_U(1) << (rest[short] * 8).astype(_U)) - _U(1)
        out[left] = mix((out[left] ^ part) + _U(_BASE))
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    for i in np.flatnonzero(length > LONG):
        out[i] = int.from_bytes(hashlib.blake2b(mapped[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def grams(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``n`` words inside one text, and the index of its first word."""
    counts = np.diff(bounds)
    runs = np.maximum(counts - n + 1, 0)
    if len(hashes) < n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    width = len(hashes) - n + 1
    rolled = np.zeros(width, _U)
    for j in range(n):
        rolled += hashes[j : j + width] * _U(pow(_BASE, n - j, 1 << 64))
    valid = np.zeros(len(hashes) + 1, np.int8)
    np.add.at(valid, bounds[:-1][runs > 0], 1)
    np.add.at(valid, (bounds[:-1] + runs)[runs > 0], -1)
    first = np.flatnonzero(np.cumsum(valid)[:width])
    return mix(rolled[first]), first
