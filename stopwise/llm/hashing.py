"""Hashes of the words of many texts at once, as numpy arrays over an Arrow batch.

All arithmetic is modulo 2**64. Two words have the same hash if they have the same bytes; that
two others do is taken to be impossible, which over n words of a comparison errs with a chance
of n*n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# The bytes that end a word.
GAP_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BATCH_BYTES = 4 << 20
PIECE_BYTES = 256 << 10


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stream(n: int, seed: int) -> np.ndarray:
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed)) | np.uint64(1)


_BYTE = _stream(256, 11)
_PLACE = _stream(4096, 23)
_IN_WORD = np.ones(256, bool)
_IN_WORD[list(GAP_BYTES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """The words of a batch: ``hashes`` of all, text ``k`` having those from ``first[k]`` up to
    ``first[k + 1]``; ``begin`` and ``end`` are byte offsets into ``body``."""

    body: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def words_of_texts(texts: pa.Array, lower: bool = False) -> Words:
    """The words of an Arrow string array; null has none. ``lower`` folds A-Z."""
    if pa.types.is_large_string(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    texts = texts.fill_null("") if texts.null_count else texts
    n = len(texts)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind)[texts.offset : texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    body = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = _IN_WORD[body]
    # A word also ends where a text does.
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    starts = offsets[:-1][offsets[:-1] < len(body)]
    opens[starts] = inside[starts]
    begin = np.flatnonzero(opens)
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | opens[1:]
    end = np.flatnonzero(closes) + 1
    hashes = np.empty(len(begin), np.uint64)
    # In stretches of words, as the numbers made here take many times the space of the text.
    cuts = np.searchsorted(begin, np.arange(0, len(body) + PIECE_BYTES, PIECE_BYTES))
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            hashes[a:b] = _word_hashes(body, begin[a:b], end[a:b], lower)
    return Words(body, begin, end, hashes, np.searchsorted(begin, offsets))


def _word_hashes(body: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool) -> np.ndarray:
    size = end - begin
    at = np.cumsum(size) - size
    off = np.arange(at[-1] + size[-1]) - np.repeat(at, size)
    chars = body[np.repeat(begin, size) + off]
    if lower:
        chars = _LOWER[chars]
    terms = _BYTE[chars] * _PLACE[off & 4095]
    if size.max() > 4096:
        terms *= (off >> 12).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    return mixed(np.add.reduceat(terms, at) + size.astype(np.uint64) * GOLDEN)


def chained(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` neighbours, in order; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n]
    for k in range(1, size):
        out = mixed(out * GOLDEN + hashes[k : k + n])
    return out


def small_batches(
    batches: Iterator[pa.RecordBatch], text: int, limit: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text, or one row, so that the arrays made
    from them stay small."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
