"""Packing documents into fixed-length token sequences by dynamic programming.

Documents keep their input order. Every task tokenizes its rows in order and
packs blocks of about ``block_tokens`` tokens. In a block the possible cuts are
document ends (free), sentence ends (``sentence_cost``) and, where neither lies
close to a full window or in the last window, any other position
(``hard_cost``). For a cut j

    best[j] = cost(j) + min over i of (best[i] + padding(j - i) + sequence_cost)

Padding to the full length is linear in i, so the minimum over the last
``length`` tokens comes from a monotone queue; sequences whose size is a power
of two need no padding and are tried as single transitions.

No shuffle: a row's pieces depend on its task's rows only, and a rerun task
reads the same rows. Defined results: null or empty text is the end id alone;
rows with null or repeated ids are packed like any other; an empty table gives
an empty result; other columns are not read. A block is longer than
``block_tokens`` only by its last document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import col
from quarry.llm.tokens import encoder, sentence_ends

OUT_BYTES = 4 << 20
ROWS = 2000


def candidates(ends: np.ndarray, soft: np.ndarray, length: int, sentence_cost: float,
               hard_cost: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a cut may lie, ascending from 0, and the cost of each."""
    total = int(ends[-1])
    kind = np.zeros(total + 1, dtype=np.uint8)  # 1 any position, 2 sentence end, 3 text end
    kind[max(0, total - length + 1):total] = 1
    kind[soft[soft < total]] = 2
    kind[ends] = 3
    kind[0] = 3
    new = pos = np.flatnonzero(kind)
    while len(new):  # a window without a cut close to its end may be cut exactly there
        reach = new + length
        last = pos[np.searchsorted(pos, reach, "right") - 1]
        new = np.unique(reach[(reach < total) & (reach - last >= max(1, length // 64))])
        if len(new):
            kind[new] = 1
            pos = np.flatnonzero(kind)
    return pos, np.array([0.0, hard_cost, sentence_cost, 0.0])[kind[pos]]


def best_cuts(pos: np.ndarray, cost: np.ndarray, length: int, sequence_cost: float = 1.0) -> np.ndarray:
    """Cut positions of least padding plus cost, from 0 to the last candidate."""
    n = len(pos)
    is_cut = np.zeros(int(pos[-1]) + 1, dtype=bool)
    is_cut[pos] = True
    later, earlier = [], []  # pairs of candidates a power of two apart
    size = 1
    while size < length:
        reach = int(np.searchsorted(pos, size))
        before = pos[reach:] - size
        some = np.flatnonzero(is_cut[before])
        later.append((some + reach).astype(np.int32))
        earlier.append(np.searchsorted(pos, before[some]).astype(np.int32))
        size *= 2
    later, earlier = (np.concatenate([*x, [n]]) for x in (later, earlier))
    order = np.argsort(later, kind="stable")
    later, earlier, at = later[order].tolist(), earlier[order].tolist(), 0
    p, c = pos.tolist(), (cost + sequence_cost).tolist()
    best, back = [0.0] * n, [0] * n
    queue, values, head = [0], [0.0], 0  # indices with rising best + position, live from ``head`` on
    for j in range(1, n):
        here = p[j]
        low = here - length
        while p[queue[head]] < low:
            head += 1
        i, value = queue[head], values[head] - low
        while later[at] == j:
            k = earlier[at]
            if best[k] < value:
                i, value = k, best[k]
            at += 1
        value += c[j]
        best[j], back[j] = value, i
        value += here
        while len(queue) > head and values[-1] >= value:
            queue.pop()
            values.pop()
        queue.append(j)
        values.append(value)
    cuts = [n - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return pos[cuts[::-1]]


def pieces(ends: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Piece bounds (one more than pieces), and each piece's document, sequence and start in its document."""
    bounds = np.union1d(np.concatenate(([0], ends)), cuts)
    starts = bounds[:-1]
    doc = np.searchsorted(ends, starts, "right")
    seq = np.searchsorted(cuts, starts, "right") - 1
    return bounds, doc, seq, starts - np.concatenate(([0], ends))[doc]


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
         end_id: int = 2, drops_white_space: bool = True, block_tokens: int = 4_000_000,
         sentence_cost: float = 8.0, hard_cost: float = 48.0) -> DataFrame:
    """One row per piece: id, start, length, doc_tokens, sequence_id, offset, ids (little-endian uint32 bytes)."""
    soft_ids = np.array(sorted(sentence_ends(tokenizer)), dtype=np.uint32)
    end_bytes = int(end_id).to_bytes(4, "little")

    def block(ids: list, data: list[bytes], first: int) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum([len(x) // 4 for x in data], dtype=np.int64)
        raw = b"".join(data)
        data.clear()
        tokens = np.frombuffer(raw, dtype="<u4")
        is_soft = np.zeros(int(max(tokens.max(), soft_ids.max(initial=0))) + 1, dtype=bool)
        is_soft[soft_ids] = True
        cuts = best_cuts(*candidates(ends, np.flatnonzero(is_soft[tokens]) + 1, length, sentence_cost, hard_cost), length)
        bounds, doc, seq, start = pieces(ends, cuts)
        sizes = np.diff(bounds)
        doc_tokens = np.diff(ends, prepend=0)[doc]
        offset = bounds[:-1] - cuts[seq]
        all_ids = pa.concat_arrays(ids)
        lo = 0
        while lo < len(sizes):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + OUT_BYTES // 4, "right")) - 1)
            at = ((bounds[lo:hi + 1] - bounds[lo]) * 4).astype(np.int32)
            body = pa.py_buffer(memoryview(raw)[int(bounds[lo]) * 4:int(bounds[hi]) * 4])
            yield pa.RecordBatch.from_arrays(
                [all_ids.take(pa.array(doc[lo:hi])), pa.array(start[lo:hi]), pa.array(sizes[lo:hi]),
                 pa.array(doc_tokens[lo:hi]), pa.array(seq[lo:hi] + first), pa.array(offset[lo:hi]),
                 pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(at), body])],
                names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            lo = hi
        pa.default_memory_pool().release_unused()
        return len(cuts) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, drops_white_space).encode
        first = TaskContext.get().partitionId() << 36
        ids, data, held = [], [], 0
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            lo = 0
            for k, raw in enumerate(encode(["" if x is None else x for x in batch.column(1).to_pylist()])):
                data.append(raw + end_bytes)
                held += len(raw) // 4 + 1
                if held >= block_tokens:
                    ids.append(batch.column(0).slice(lo, k + 1 - lo))
                    first += yield from block(ids, data, first)
                    ids, data, held, lo = [], [], 0, k + 1
            if lo < batch.num_rows:
                ids.append(batch.column(0).slice(lo))
        if data:
            yield from block(ids, data, first)

    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), *[T.StructField(c, T.LongType()) for c in
                          ("start", "length", "doc_tokens", "sequence_id", "offset")], T.StructField("ids", T.BinaryType())])
    return docs.select(col(id_col).alias(id_col), F.coalesce(col(text_col), F.lit("")).alias("text")).mapInArrow(run, schema)
