"""Words of a batch of texts as numpy columns: one code, text and place per word.

All separators are ASCII, so the bytes of a UTF-8 column are classed by a table
and words are cut without decoding a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 4 << 20


@dataclass
class WordTable:
    """Distinct words, and per word in reading order its code, its text's number and the separators before it."""

    names: pa.Array
    code: np.ndarray
    text: np.ndarray
    cuts: np.ndarray


def classes(blank: bytes, cut: bytes = b"") -> np.ndarray:
    """Class of each byte: 0 part of a word, 1 blank, 2 separator of pieces."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[list(blank)] = 1
    kind[list(cut)] = 2
    return kind


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, at, raw = texts.buffers()
    off = np.frombuffer(at, dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset) if len(texts) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(raw, dtype=np.uint8)[off[0]:off[-1]] if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    return off - off[0], raw


def word_table(texts: pa.Array, kind: np.ndarray, fold: bool = False) -> WordTable:
    """The words of ``texts``; with ``fold``, A-Z are lower-cased."""
    off, raw = _buffers(texts)
    of = kind[raw]
    inside = of == 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]  # no word goes on from one text into the next
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[heads[1:] - 1] = inside[heads[1:] - 1]
    ends = np.flatnonzero(last) + 1
    letters = raw[inside]
    if fold:
        letters = np.where((letters >= 65) & (letters <= 90), letters + 32, letters).astype(np.uint8)
    at = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=at[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(letters))).dictionary_encode()
    return WordTable(words.dictionary, words.indices.to_numpy(zero_copy_only=False), np.searchsorted(off, starts, "right") - 1,
                     np.searchsorted(np.flatnonzero(of == 2), starts))


def text_chunks(batch: pa.RecordBatch, column: int, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows with at most ``most`` bytes of text each (or one longer text)."""
    off, _ = _buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def mixed(a: np.ndarray, b: np.ndarray | int = 0) -> np.ndarray:
    """64-bit hashes of pairs of 64-bit values."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b, dtype=np.uint64) + np.uint64(0xD1B54A32D192ED03)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
