"""Word shingles and min-max signatures of documents, vectorised over the bytes of a batch."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

PIECE = 2 << 20
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _random(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, size=n, dtype=np.uint64)


def _byte_values() -> np.ndarray:
    values = _random(11, 256)
    values[65:91] = values[97:123]  # A-Z count as a-z
    values[SPACE] = 0
    return values


VALUES = _byte_values()
BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply) so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a string array (no nulls), and the bounds of each text's words.

    The bytes are worked through in pieces of about ``PIECE``, cut where no word is cut.
    """
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    hashes, firsts, lo = [], [], 0
    while lo < len(data):
        hi = min(lo + PIECE, len(data))
        while hi < len(data):  # on to the next blank or text start
            blank = np.flatnonzero(SPACE[data[hi:hi + PIECE]])
            k = np.searchsorted(offsets, hi)
            ahead = [int(offsets[k]) if k < len(offsets) else len(data), len(data)] + ([hi + int(blank[0])] if len(blank) else [])
            if len(blank) or min(ahead) <= hi + PIECE:
                hi = min(ahead)
                break
            hi += PIECE
        hi = min(hi, len(data))
        part = data[lo:hi]
        solid = ~SPACE[part]
        head = solid.copy()
        head[1:] &= ~solid[:-1]
        inside = offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo
        head[inside] = solid[inside]
        first = np.flatnonzero(head)
        if len(first):
            size = np.diff(first, append=len(part))
            place = np.arange(first[0], len(part)) - np.repeat(first, size)
            power = np.cumprod(np.full(int(size.max()), BASE, dtype=np.uint64))
            hashes.append(mix(np.add.reduceat(VALUES[part[first[0]:]] * power[place], first - first[0])))
            firsts.append(first + lo)
        lo = hi
    none = np.empty(0, dtype=np.int64)
    where = np.concatenate(firsts) if firsts else none
    return np.concatenate(hashes) if hashes else none.astype(np.uint64), np.searchsorted(where, offsets)


def shingle_sets(texts: pa.Array, size: int):
    """For each text its distinct shingle hashes, ascending; one shingle of all words if there are fewer than ``size``."""
    words, bounds = word_hashes(texts)
    factors = _random(13, size) | np.uint64(1)
    n = max(0, len(words) - size + 1)
    grams = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        grams += words[k:k + n] * factors[k]
    grams = mix(grams)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= size:
            yield np.unique(grams[lo:hi - size + 1])
        elif hi > lo:
            yield mix((words[lo:hi] * factors[:hi - lo]).sum(keepdims=True, dtype=np.uint64) + np.uint64(hi - lo))
        else:
            yield np.empty(0, dtype=np.uint64)


def digest(grams: np.ndarray) -> bytes:
    return blake2b(grams.tobytes(), digest_size=16).digest()


def cells(grams: np.ndarray, size: int) -> np.ndarray:
    """A sketch of ``size`` 64-bit words with one bit for each cell that holds a gram."""
    filled = np.zeros(size * 64, dtype=bool)
    filled[(grams & np.uint64(0xFFFFFFFF)).astype(np.int64) % (size * 64)] = True
    return np.packbits(filled).view(np.int64)


class MinMax:
    """Signatures of ``perms`` permutations that keep both the minimum and the maximum of each.

    Two sets agree in a value with probability equal to their similarity, so
    ``perms`` hash evaluations per shingle give ``2 * perms`` values, which are
    cut into bands of ``rows``.
    """

    def __init__(self, perms: int, rows: int):
        if 2 * perms % rows:
            raise ValueError("2 * perms must be a multiple of rows")
        self.perms, self.rows, self.bands = perms, rows, 2 * perms // rows
        self.a = (_random(17, perms) >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
        self.b = (_random(19, perms) >> np.uint64(32)).astype(np.uint32)[:, None]
        self.fold = _random(23, self.bands * rows).reshape(self.bands, rows) | np.uint64(1)

    def signature(self, grams: np.ndarray) -> np.ndarray:
        """(perms, 2) minima and maxima of a set that isn't empty."""
        x = (grams >> np.uint64(32)).astype(np.uint32)
        out = np.empty((self.perms, 2), dtype=np.uint32)
        out[:, 0], out[:, 1] = np.uint32(0xFFFFFFFF), np.uint32(0)
        for lo in range(0, len(x), 4096):
            h = x[lo:lo + 4096] * self.a + self.b
            np.minimum(out[:, 0], h.min(axis=1), out=out[:, 0])
            np.maximum(out[:, 1], h.max(axis=1), out=out[:, 1])
        return out

    def keys(self, grams: np.ndarray) -> np.ndarray:
        """One 64-bit bucket key per band."""
        values = self.signature(grams).reshape(self.bands, self.rows).astype(np.uint64) + np.uint64(1)
        return mix((values * self.fold).sum(axis=1, dtype=np.uint64)).view(np.int64)
