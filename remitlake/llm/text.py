"""Texts as flat byte arrays inside a task: words, hashes of spans, sets of word shingles.

A batch of texts is worked on in pieces of about a megabyte, so memory follows the piece or, where a single text is
longer, that text. Words are ``[^\\x20\\x09-\\x0D]+``; white space is ASCII, so bytes and characters agree on them.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; different numbers stay different."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors)
    return _powers


def at_rest() -> None:
    """Give memory that is free back to the system: workers stay alive between tasks, and executors share a budget."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


class Piece(NamedTuple):
    """Some texts of a batch: ``first`` is the row of the first of them, text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes one after the other, and n + 1 offsets. Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, places, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(texts: pa.Array | pa.ChunkedArray, size: int = PIECE_BYTES) -> Iterator[Piece]:
    data, offsets = flat(texts)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield Piece(at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
        at = end


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, every other byte as it is."""
    return _LOWER[data]


class Words(NamedTuple):
    """Start and end of each word, and for each text (and the end) the number of words before it."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words(piece: Piece) -> Words:
    n, offsets = len(piece.data), piece.offsets
    ink = np.zeros(n + 1, bool)
    np.logical_not(_SPACE[piece.data], out=ink[:n])
    before = np.zeros(n + 1, bool)
    before[1:] = ink[:-1]
    before[offsets] = False
    starts = np.flatnonzero(ink & ~before)
    after = np.zeros(n + 1, bool)
    after[:-1] = ink[1:]
    after[offsets[offsets > 0] - 1] = False
    ends = np.flatnonzero(ink & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """n + 1 running sums from which ``span_hashes`` takes the hash of any span."""
    powers = _powers_to(len(data) + 1)[0]
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal spans have equal hashes wherever they stand."""
    return mixed((prefix[ends] - prefix[starts]) * _powers_to(len(prefix))[1][starts])


def word_hashes(piece: Piece, found: Words) -> np.ndarray:
    return span_hashes(prefix_hashes(piece.data), found.starts, found.ends)


def _joined(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of k words, by its first word."""
    n = max(0, len(hashes) - k + 1)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + hashes[j : j + n]
    return mixed(out)


def shingles(piece: Piece, k: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its k-word shingles in order; of a shorter text, the one of all its words.

    Upper and lower case A-Z count as the same. A text without words has none.
    """
    piece = piece._replace(data=lowered(piece.data))
    found = words(piece)
    hashes = word_hashes(piece, found)
    runs = _joined(hashes, k)
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= k:
            yield runs[a : b - k + 1]
        elif b > a:
            yield _joined(hashes[a:b], b - a)
        else:
            yield runs[:0]


def shingle_sets(texts: pa.Array | pa.ChunkedArray, k: int) -> Iterator[np.ndarray]:
    """For each text of a batch the sorted distinct hashes of its shingles."""
    for piece in pieces(texts):
        for run in shingles(piece, k):
            yield np.unique(run)
