"""Anchors: sampled positions by which equal byte strings of one length find each other."""

from __future__ import annotations

import functools

import numpy as np

GRAM = 48  # bytes of an anchor
_POSITION_BITS = 21
PIECE = 1 << 20  # bytes handled at once


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BASE = 0xD6E8FEB86659FD93  # odd
_LETTERS = scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.cache
def _powers(n: int, inverse: bool) -> np.ndarray:
    base = np.full(n, pow(_BASE, -1, 1 << 64) if inverse else _BASE, np.uint64)
    base[0] = 1
    return np.cumprod(base, dtype=np.uint64)


class Hashes:
    """64-bit hashes of any substrings of a piece of up to 2 ** 21 bytes, by differences of running sums."""

    def __init__(self, raw: np.ndarray):
        n = max(PIECE, 1 << (len(raw)).bit_length())
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LETTERS[raw] * _powers(n, False)[: len(raw)], out=self.sums[1:])
        self.inverse = _powers(n, True)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return scramble((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by running minima of blocks from both ends."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def segments(raw: np.ndarray, hashes: Hashes, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, anchor, place): runs of window starts that have the same anchor, its hash and where it is.

    The anchor of a window of ``length`` bytes is the gram of least hash in it, the first of equals. It depends on the
    window's bytes only, so equal windows have equal anchors at equal places.
    """
    grams = hashes.grams(gram)
    width = length - gram + 1
    keyed = (grams & ~np.uint64((1 << _POSITION_BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)
    at = (sliding_min(keyed, width) & np.uint64((1 << _POSITION_BITS) - 1)).astype(np.int64)
    if not len(at):
        return at, at, grams[:0], at
    start = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    return start, np.diff(np.append(start, len(at))), grams[at[start]], at[start]
