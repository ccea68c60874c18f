"""Periodic runs of words by string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends, of at least ``least`` words and ``repeats``
periods. The texts of a batch are laid end to end with a word of its own after
each, so that no run leaves its text; all steps below work on the whole batch.

1. Periods below ``SMALL`` are read off directly: stretches where the word at i
   equals the word at i + q. These are the highly periodic regions that the
   synchronising sets leave out, and the runs of small periods themselves.
2. At each scale t = 8, 16, 32, ... a position is in the synchronising set if
   the least hash of the t-word windows that start at i .. i + t is the one at i
   or at i + t. Windows inside a region of period <= t / 3 (found at smaller
   scales) hold no hash. Membership depends on the 2t words from i on only, so
   equal contexts are chosen alike wherever they stand.
3. Chosen positions with equal contexts of 2t words, 1.5t to 3t apart, propose
   their distance as a period. A run of period q in that range and 3q words or
   more holds such a pair: if it held none, its first 2q words would have a
   period <= t / 3, and then q were not its smallest. Equal contexts stand more
   than t / 3 apart, so each position has at most nine partners to look at.
4. Neighbouring proposals of one period are joined and extended word by word to
   the maximal run; of several periods of one stretch the smallest stays.

A scale works only on texts that are long enough for a run of its periods, so
the work falls with the scale. Hashes choose positions and propose; every run
is confirmed on the words.

Defined results: null, empty and blank texts have no words, no runs and an
empty collapsed text; repeated rows get equal results; an empty table gives an
empty table; other columns stay, but for those with the names of the two
result columns, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import WHITE, col, fresh
from quarry.llm.wordtable import classes, mixed, text_chunks, word_table

FIRST = 8
SMALL = 12  # 1.5 x FIRST: periods from here on are proposed by the scales
BLOCK = 4096
RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
KIND = classes(WHITE.encode())
MAX = np.uint64(2**64 - 1)


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


def _extend(words: np.ndarray, at: np.ndarray, q: np.ndarray, step: int) -> np.ndarray:
    """The first place from ``at`` on, in steps of ``step``, where the words q apart differ."""
    out, last = at.copy(), len(words) - 1
    for lo in range(0, len(at), BLOCK):
        live, width = np.arange(lo, min(lo + BLOCK, len(at))), 16
        while len(live):
            j = out[live][:, None] + step * np.arange(width)
            k = j + q[live][:, None]
            differ = (j < 0) | (k > last)
            differ |= words[np.clip(j, 0, last)] != words[np.clip(k, 0, last)]
            found = differ.any(axis=1)
            out[live] += step * np.where(found, differ.argmax(axis=1), width)
            live = live[~found]
            width = min(2 * width, 1024)
    return out


def _proposals(window: np.ndarray, context: np.ndarray, periodic: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and distances of equal contexts of the synchronising set at scale ``t``."""
    none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
    if len(window) <= t:
        return none
    least = np.where(periodic, MAX, window)
    masked, wide = least, 1
    while wide < t:  # least of t neighbours by doubling
        least = np.minimum(least, np.concatenate((least[wide:], np.full(wide, MAX))))
        wide *= 2
    least = np.minimum(least[:-t], masked[t:])
    chosen = np.flatnonzero(((least == masked[:-t]) | (least == masked[t:])) & (least < MAX))
    key = context[chosen]
    order = np.argsort(key, kind="stable")
    key, at = key[order], chosen[order]
    found_at, found_q = [], []
    step = 1
    while step < len(at):
        apart = at[step:] - at[:-step]
        near = (key[step:] == key[:-step]) & (apart < 3 * t)
        if not near.any():
            break
        near &= 2 * apart >= 3 * t
        found_at.append(at[:-step][near])
        found_q.append(apart[near])
        step += 1
    return (np.concatenate(found_at), np.concatenate(found_q)) if found_at else none


def _runs_from(words: np.ndarray, at: np.ndarray, q: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal stretches (start, length, period) around proposals whose contexts are 2t words long."""
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (q[1:] != q[:-1]) | (at[1:] - at[:-1] > 2 * t)
    lead = np.flatnonzero(new)
    q = q[lead]
    lo, hi = at[lead], at[np.append(lead[1:], len(at)) - 1] + 2 * t
    start = _extend(words, lo - 1, q, -1) + 1
    return start, _extend(words, hi, q, 1) + q - start, q


def _confirmed(words: np.ndarray, start: int, length: int, q: int) -> list[tuple[int, int, int]]:
    """The stretch itself, or, should hashes have lied, the stretches of period q in it."""
    equal = words[start:start + length - q] == words[start + q:start + length]
    if equal.all():
        return [(start, length, q)]
    return [(start + s, n + q, q) for s, n in zip(*(x.tolist() for x in _stretches(equal)), strict=True)]


def find_word_runs(code: np.ndarray, text: np.ndarray, least: int = 24, repeats: int = 3) -> np.ndarray:
    """(run, 4) text number, start in the text, length and period, by text, start and period.

    ``code`` are word numbers from 0 in reading order and ``text`` the number of each word's text.
    """
    if repeats < 3 or least < FIRST:
        raise ValueError("runs have at least three periods and eight words")
    if len(code) < least:
        return np.zeros((0, 4), dtype=np.int64)
    first = np.flatnonzero(np.diff(text, prepend=text[0] - 1))
    size = np.diff(np.append(first, len(code)))
    rank = np.repeat(np.arange(len(first)), size)
    words = np.empty(len(code) + len(first), dtype=np.int64)
    words[np.arange(len(code)) + rank] = code
    ends = first + size + np.arange(len(first))
    words[ends] = -1 - np.arange(len(first))  # a word of its own after each text

    starts, lengths, periods = [], [], []  # of all stretches that can make a window of some scale periodic

    def keep(s: np.ndarray, n: np.ndarray, q: np.ndarray) -> None:
        ok = n >= np.maximum(FIRST, 3 * q)
        starts.append(s[ok])
        lengths.append(n[ok])
        periods.append(q[ok])

    for q in range(1, min(SMALL, len(words))):
        s, n = _stretches(words[:-q] == words[q:])
        keep(s, n + q, np.full(len(s), q, dtype=np.int64))

    where = np.arange(len(words))
    window = mixed(words.view(np.uint64))
    t = 1
    while size.max() * 2 >= 9 * max(t, FIRST):  # a run of period 1.5t has 4.5t words
        if t >= FIRST:
            long = size * 2 >= 9 * t
            if not long.all():  # texts too short for a run of these periods are left out from here on
                stays = np.repeat(long, size + 1)
                where, window, size = where[stays], window[stays], size[long]
            s, n, q = np.concatenate(starts), np.concatenate(lengths), np.concatenate(periods)
            ok = (3 * q <= t) & (n >= t)
            mark = np.zeros(len(where) + 1, dtype=np.int64)
            lo = np.searchsorted(where, s[ok])
            hi = np.searchsorted(where, s[ok] + n[ok] - t + 1)
            np.add.at(mark, lo, 1)
            np.add.at(mark, hi, -1)
            periodic = np.cumsum(mark[:-1]) > 0
        shifted = np.concatenate((window[t:], np.arange(min(t, len(window)), dtype=np.uint64)))[:len(window)]
        context = mixed(window, shifted)
        if t >= FIRST:
            at, q = _proposals(window, context, periodic, t)
            if len(at):
                # In the whole batch again; equal contexts lie in one text, where both count alike.
                keep(*_runs_from(words, where[at], q, t))
        window, t = context, 2 * t

    s, n, q = np.concatenate(starts), np.concatenate(lengths), np.concatenate(periods)
    ok = n >= np.maximum(least, repeats * q)
    found = {r for a, b, c in zip(s[ok].tolist(), n[ok].tolist(), q[ok].tolist(), strict=True) for r in _confirmed(words, a, b, c)}
    smallest: dict[tuple[int, int], int] = {}
    for a, b, c in found:
        if b >= max(least, repeats * c):
            smallest[a, b] = min(c, smallest.get((a, b), c))
    if not smallest:
        return np.zeros((0, 4), dtype=np.int64)
    rows = np.array([(a, b, c) for (a, b), c in smallest.items()], dtype=np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    doc = np.searchsorted(ends, rows[:, 0])
    return np.column_stack((text[first[doc]], rows[:, 0] - (first + np.arange(len(first)))[doc], rows[:, 1], rows[:, 2]))


def _row_results(texts: pa.Array, least: int, repeats: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each row."""
    table = word_table(texts, KIND)
    runs = find_word_runs(table.code, table.text, least, repeats)
    lists: dict[int, list[tuple[int, int, int]]] = {}
    for text, *run in runs.tolist():
        lists.setdefault(text, []).append(tuple(run))
    collapsed = []
    for k, raw in enumerate(texts.cast(pa.large_binary()).to_pylist()):
        words = (raw or b"").split()
        if k in lists:
            stays = np.ones(len(words), dtype=bool)
            for start, length, period in lists[k]:
                stays[start + period:start + length] = False
            words = [words[i] for i in np.flatnonzero(stays).tolist()]
        collapsed.append(b" ".join(words))
    at = np.zeros(len(texts) + 1, dtype=np.int32)
    if len(runs):
        np.cumsum(np.bincount(runs[:, 0], minlength=len(texts)), out=at[1:])
    body = pa.StructArray.from_arrays([pa.array(runs[:, c + 1]) for c in range(3)], names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(at), body), pa.array(collapsed, pa.binary()).cast(pa.string())


def find_runs(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed", least: int = 24,
              repeats: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with each text's runs (by start, then period) and its words without the repetitions.

    The collapsed text holds the words that no run covers after its first period, joined by one blank.
    """
    out = {runs_col.lower(), collapsed_col.lower()}
    rest = [c for c in (docs.columns if keep is None else keep) if c.lower() not in out]
    whole, = fresh(docs, "whole_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch, batch.num_columns - 1):
                runs, collapsed = _row_results(part.column(part.num_columns - 1), least, repeats)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], runs, collapsed], names=[*rest, runs_col, collapsed_col])

    schema = T.StructType([*[docs.schema[c] for c in rest], T.StructField(runs_col, RUNS), T.StructField(collapsed_col, T.StringType())])
    return docs.select(*[col(c) for c in rest], col(text_col).cast("string").alias(whole)).mapInArrow(run, schema)


def strongest(runs: Column) -> Column:
    """The run of the greatest exact length / period; ties: the smallest start, then period. Null without runs."""
    def better(a, b):
        left, right = a["length"].cast("decimal(19,0)") * b["period"], b["length"].cast("decimal(19,0)") * a["period"]
        before = (left > right) | ((left == right) & ((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))))
        return F.when(before, F.lit(-1)).otherwise(F.lit(1))

    return F.get(F.array_sort(runs, better), F.lit(0))


__all__ = ["find_runs", "find_word_runs", "strongest"]
