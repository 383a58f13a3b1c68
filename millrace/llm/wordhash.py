"""Words and word windows of many texts at once, as 64-bit hashes in numpy arrays.

Texts come as an Arrow string array and are read in place: no Python object is made for a text or a
word. A word is a run of bytes other than space and 0x09-0x0D, which on UTF-8 is the same as a run
of such characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes looked at together; a text longer than that is a piece of its own.
PIECE_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(of: int, n: int) -> np.ndarray:
    out = np.full(n, of, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as long as the longest piece so far."""

    up = _powers(_BASE, 1)
    down = _powers(_INVERSE, 1)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up, cls.down


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@dataclass
class Piece:
    """Consecutive texts: their bytes end to end, where each begins, and which bytes are white space."""

    first: int
    bytes: np.ndarray
    begins: np.ndarray
    space: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.begins) - 1

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has."""
        total = np.zeros(len(flags) + 1, dtype=np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.begins[1:]] - total[self.begins[:-1]]


def pieces(texts: pa.Array, piece_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts (NULL: empty) in pieces of about ``piece_bytes``."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + piece_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(texts))
        body = data[offsets[at] : offsets[to]]
        yield Piece(at, body, offsets[at : to + 1] - offsets[at], _SPACE[body])
        at = to


def words(piece: Piece, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word and, per text, where its words begin among them (one entry more than texts)."""
    n = len(piece.bytes)
    if not n:
        return np.empty(0, np.uint64), np.zeros(piece.texts + 1, np.int64)
    edge = np.zeros(n + 1, dtype=bool)
    edge[piece.begins] = True
    inside = ~piece.space
    begins = inside.copy()
    begins[1:] &= piece.space[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= piece.space[1:] | edge[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _Powers.upto(n)
    body = _LOWER[piece.bytes] if lower else piece.bytes
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    hashes = mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return hashes, np.searchsorted(start, piece.begins)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` words, by its first word; runs across texts are in it too."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + hashes[k : k + count]
    return mixed(out + np.uint64(width))
