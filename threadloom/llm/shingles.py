"""Hashes of words and shingles of whole Arrow string columns at once, with numpy.

Lower-cases A-Z and takes words `[^\\x20\\x09-\\x0D]+`. A word's hash is a polynomial of its bytes, finished by a
mixing step; equal words have equal hashes everywhere. Texts are taken in slices of about `_SLICE` bytes, so the
memory needed does not grow with the batch, only with its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SLICE = 1 << 19
_U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 2 * _SLICE)
        got = np.full(size, base, np.uint64)
        got[0] = 1
        got = _powers[base] = np.multiply.accumulate(got)
    return got[:n]


def text_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, ends of the rows' texts in them) for runs of rows; nulls are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE, "right")) - 1)
        stop = min(stop, len(texts))
        yield row, data[offsets[row]:offsets[stop]], offsets[row + 1:stop + 1] - offsets[row]
        row = stop


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and for each row the number of words up to its end."""
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    solid = ~_BLANK[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = ends[:-1][ends[:-1] < len(data)]
    first[cut] = solid[cut]  # a row begins a word
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(ends), np.int64)
    terms = _BYTE[data]
    terms *= powers(BASE, len(data))
    terms[~solid] = 0
    words = np.add.reduceat(terms, starts)
    words *= powers(INVERSE, len(data))[starts]
    return mix(words), np.searchsorted(starts, ends)


def shingle_sets(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row after the other, and where each row ends. Rows of
    fewer words have one shingle, rows without words none."""
    words, upto = word_hashes(data, ends)
    counts = np.diff(upto, prepend=0)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    shingle_ends = np.cumsum(n)
    total = int(shingle_ends[-1])
    out = np.empty(total, np.uint64)
    row = np.repeat(np.arange(len(ends)), n)
    at = np.arange(total) - (shingle_ends - n)[row] + (upto - counts)[row]
    length = np.minimum(counts, width)[row]
    h = mix(length.astype(np.uint64))
    for i in range(width):
        more = i < length
        h = np.where(more, mix(h * _U(0xD6E8FEB86659FD93) + words[np.where(more, at + i, 0)]), h) if not more.all() \
            else mix(h * _U(0xD6E8FEB86659FD93) + words[at + i])
    out[:] = h
    begin = 0
    for end in shingle_ends.tolist():
        out[begin:end].sort()
        begin = end
    new = np.ones(total, bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.concatenate([[0], np.cumsum(new)])[shingle_ends]


def text_shingles(text: str | None, width: int) -> np.ndarray:
    """The set of one text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    return shingle_sets(data, np.array([len(data)]), width)[0]
