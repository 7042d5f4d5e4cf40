"""Word hashes of whole Arrow text columns, computed with numpy over their UTF-8 bytes.

A word is a maximal run of word bytes; A-Z count as a-z. Bytes from 0x80 up are word bytes
in both tables, so characters are never split. A word's hash has 64 bits: the sum of random
numbers, one for each pair of a byte and its place, so that no rule of the text's can make two
words agree. Equal hashes are taken for equal words (one chance in 10**19 per pair of different ones).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: letters a-z, digits and everything beyond ASCII
ALNUM = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
#: everything but space, tab, line feed, vertical tab, form feed and carriage return
NON_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: A number for each byte at each of 64 places; later places take these and are mixed with the turn.
_PLACES = 64
_NUMBERS = np.random.default_rng(20).integers(0, 1 << 64, size=_PLACES * 256, dtype=np.uint64)
CHUNK_BYTES = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def hash_words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each row's first word and one more at the end)."""
    low = LOWER[data]
    is_word = table[low]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = is_word[heads]
    at = np.flatnonzero(is_word)
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    idx = np.flatnonzero(first[at])
    sizes = np.diff(np.append(idx, len(at)))
    pos = np.arange(len(at)) - np.repeat(idx, sizes)
    values = _NUMBERS[((pos % _PLACES) << 8) | low[at]]
    far = np.flatnonzero(pos >= _PLACES)
    if len(far):
        values[far] = mix(values[far] ^ ((pos[far] // _PLACES).astype(np.uint64) * _ODD))
    h = np.add.reduceat(values, idx)
    return mix(h ^ (sizes.astype(np.uint64) << np.uint64(48))), np.searchsorted(starts, offsets)
