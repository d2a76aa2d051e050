"""Vectorised splitting and hashing of words in Arrow text columns (white space is ASCII)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: The white-space bytes that separate words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Text bytes handled at a time; hashing needs about 60 times as much memory.
SLICE = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, 1 << 20)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), 1 << 20)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        size = 1 << n.bit_length()
        _UP, _DOWN = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    return _UP[:n], _DOWN[:n]


def _spans(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(flat) + 2, np.int8)
    inside[1:-1] = ~_SPACE[flat]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _piece(flat: np.ndarray) -> np.ndarray:
    """Hash of each word of a byte array that neither starts nor ends inside a word."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    starts, ends = _spans(flat)
    up, down = _tables(len(flat) + 1)
    sums = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum((_LOWER[flat].astype(np.uint64) + np.uint64(1)) * up[: len(flat)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A-Z taken as a-z, in text order. Works in slices."""
    flat = np.frombuffer(data, np.uint8)
    if len(flat) <= SLICE:
        return _piece(flat)
    out, at = [], 0
    while at < len(flat):
        end = min(at + SLICE, len(flat))
        while end < len(flat) and not _SPACE[flat[end]]:
            rest = np.flatnonzero(_SPACE[flat[end : end + SLICE]])
            end = end + int(rest[0]) if len(rest) else min(end + SLICE, len(flat))
        out.append(_piece(flat[at:end]))
        at = end
    return np.concatenate(out)


def batches_of(column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, word hashes of each row) for runs of rows of about SLICE bytes; null is empty."""
    row, size, texts = 0, 0, []
    for i, value in enumerate(column):
        data = value.as_buffer() if value.is_valid else b""
        texts.append(data)
        size += len(data)
        if size >= SLICE:
            yield row, _together(texts)
            row, size, texts = i + 1, 0, []
    if texts:
        yield row, _together(texts)


def _together(texts: list) -> list[np.ndarray]:
    """Word hashes of each text; many short texts are hashed as one."""
    if len(texts) == 1:
        return [word_hashes(texts[0])]
    lengths = np.array([len(x) for x in texts])
    if lengths.max() > SLICE:
        return [word_hashes(x) for x in texts]
    flat = np.frombuffer(b" ".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum(lengths + 1)])
    hashes = _piece(flat)
    cuts = np.searchsorted(_spans(flat)[0], offsets)
    return [hashes[cuts[i] : cuts[i + 1]] for i in range(len(texts))]


def shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes.

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    """
    n = len(hashes)
    if not n:
        return hashes
    width = min(words, n)
    total = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        factor = (2 * k + 1) * 0xD1342543DE82EF95 % (1 << 64)
        total = mix(total + hashes[k : n - width + 1 + k] * np.uint64(factor))
    return np.unique(total)
