"""Vectorised word work on Arrow text batches: word boundaries and 64-bit word hashes for whole batches at once.

Texts are handled as UTF-8 bytes. Every word class used here is defined on ASCII (bytes from 0x80 up are always word
bytes), so byte positions cut words at the same places as code points do.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single document forms a chunk of its own.
CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: word classes: True where a (lower-cased) byte belongs to a word
SPACE_WORDS = np.ones(256, dtype=bool)          # [^\x20\x09-\x0D]+
SPACE_WORDS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM_WORDS = np.zeros(256, dtype=bool)         # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM_WORDS[0x30:0x3A] = True
ALNUM_WORDS[0x61:0x7B] = True
ALNUM_WORDS[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply rounds)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95 & ~7 | 5               # odd, 1 mod 4: the longest period modulo 2^64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POW.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.ones(size, dtype=np.uint64)
        filled = 1
        while filled < size:   # doubling: p[k:2k] = p[:k] * base^k
            step = min(filled, size - filled)
            have[filled:filled + step] = have[:step] * np.uint64(pow(base, filled, 1 << 64))
            filled += step
        _POW[base] = have
    return have[:n]


class Words:
    """Words of consecutive documents: ``start``/``end`` are byte positions in ``buf`` (ASCII lower-cased), ``doc``
    the index of the document in the chunk, ``offsets`` the documents' byte bounds, ``first`` the number of words
    before each document (length n_docs + 1)."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        inside = word_bytes.take(buf)
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:]
        cuts = np.unique(offsets)
        cuts = cuts[(cuts > 0) & (cuts < n)]
        begin[cuts] = inside[cuts]
        stop[cuts - 1] = inside[cuts - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, offsets, side="left")
        self.n_docs = len(offsets) - 1
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))
        self._sums = None

    def _prefix(self) -> np.ndarray:
        if self._sums is None:
            n = len(self.buf)
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE_VALUE.take(self.buf) * _powers(_BASE, n), out=sums[1:])
            self._sums = sums
        return self._sums

    def hash_spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of the bytes of each span; equal bytes give equal hashes anywhere."""
        sums = self._prefix()
        return mix((sums.take(end) - sums.take(start)) * _powers(_BASE_INV, len(self.buf) + 1).take(start))

    def hashes(self) -> np.ndarray:
        return self.hash_spans(self.start, self.end)


def chunks(texts: pa.Array, budget: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, lower-cased bytes, byte offsets) for runs of rows of about ``budget`` bytes.
    Null texts count as empty."""
    budget = budget or CHUNK_BYTES
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    bounds = bounds[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        stop = int(np.searchsorted(bounds, bounds[at] + budget, side="right")) - 1
        stop = min(max(stop, at + 1), n)
        yield at, stop, _LOWER[data[bounds[at]:bounds[stop]]], bounds[at:stop + 1] - bounds[at]
        at = stop


def words(texts: pa.Array, word_bytes: np.ndarray = SPACE_WORDS) -> Iterator[tuple[int, int, Words]]:
    """(first row, last row + 1, words) for consecutive chunks of a text column."""
    for a, b, buf, offsets in chunks(texts):
        yield a, b, Words(buf, offsets, word_bytes)


def hash_word(word: str) -> int:
    """The hash of one word, as :meth:`Words.hashes` gives it."""
    buf = _LOWER[np.frombuffer(word.encode(), dtype=np.uint8)]
    return int(Words(buf, np.array([0, len(buf)]), np.ones(256, dtype=bool)).hashes()[0]) if len(buf) else 0
