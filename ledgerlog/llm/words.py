"""Words of many texts at once: numpy over the UTF-8 buffer of an Arrow column.

A word class is a table of 256 bytes: 0 for a separator, else the byte that stands for it
(A-Z become a-z). Both classes in use end words at ASCII bytes only, so bytes are enough.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def word_class(separators: bytes) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A"):ord("Z") + 1] += 32
    table[list(separators)] = 0
    return table


#: Words ``[^\x20\x09-\x0D]+`` after lower-casing A-Z. NUL is a word byte there, so it becomes 255, which UTF-8 lacks.
BLANK_SEPARATED = word_class(b" \t\n\x0b\x0c\r")
BLANK_SEPARATED[0] = 255
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
ALPHANUMERIC = word_class(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


@dataclass
class Words:
    """``starts`` and ``ends`` are byte positions in ``data``; text i has the words ``offsets[i]:offsets[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8)
    if offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0])
    return data, offsets - offsets[0]


def split(texts: pa.Array, table: np.ndarray) -> Words:
    raw, bounds = utf8(texts)
    data = table[raw]
    inside = data != 0
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        heads = bounds[:-1][bounds[:-1] < len(data)]
        tails = bounds[1:][bounds[1:] > 0] - 1
        first[heads] = inside[heads]
        last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return Words(data, starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer of 64-bit values, in place."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 1), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= BLOCK_BYTES + 1:
            _POWERS[base] = have
    return have[:n]


_RANDOM = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def hashes(words: Words, random: np.ndarray = _RANDOM) -> np.ndarray:
    """A 64-bit hash of each word's bytes, block by block, so that memory stays small for long texts.

    ``random`` has an odd number for each byte.
    """
    found = np.empty(len(words.starts), np.uint64)
    begin = 0
    while begin < len(found):
        at = words.starts[begin]
        end = max(begin + 1, int(np.searchsorted(words.ends, at + BLOCK_BYTES, "right")))
        total = random[words.data[at:words.ends[end - 1]]]
        total *= _powers(_BASE, len(total))
        np.cumsum(total, out=total)
        left = words.starts[begin:end] - at
        value = total[words.ends[begin:end] - at - 1]
        value -= np.where(left > 0, total[left - 1], np.uint64(0))
        value *= _powers(_INVERSE, len(total))[left]
        found[begin:end] = mix(value)
        begin = end
    return found


def runs(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive values, in their order; it starts at the first of them."""
    count = max(0, len(values) - width + 1)
    found = values[:count] ^ np.uint64(width)
    for k in range(1, width):
        found ^= found >> np.uint64(29)
        found *= np.uint64(0xBF58476D1CE4E5B9)
        found += values[k:k + count]
    return mix(found)
