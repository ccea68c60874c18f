"""Approximate nearest neighbours by randomly rotated one-bit codes.

Every vector is centred, rotated by one random orthogonal matrix and kept as
the signs of its components (one bit each), with two correction scalars: its
length after centring, and the product x of its rotated direction with its own
sign vector. The inner product with a query is estimated from the bits alone,

    <centre, q> + length * <signs / sqrt(d), rotated q> / x,

and the error is below length * |q| * sqrt((1 - x*x) / x*x) * eps / sqrt(d - 1)
but for a share that falls with exp(-eps * eps).

Codes lie in groups of about ``group`` rows (dealt by a hash) together with
their vectors; a block of queries meets every group. In a group the best
estimates are computed exactly first; their k-th best is a bound, and only
vectors whose estimate plus error reaches it are reranked on the original
vectors in double precision. k rows a query and group go on to a window.

Nothing is trained: the rotation comes from ``seed`` and the centre is the mean
of all vectors (rounded, so that it doesn't depend on the order of a sum).

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and rows with a null id, take no part; vectors of unequal
length are compared as if the shorter one ended in zeros; a candidate with the
query's id is the query's own row; a query id that repeats is searched once,
with its least vector, while repeated candidates count each; ties go to the
smaller id; a query with fewer than k candidates gets all; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import col, write_scratch

GROUP = 4_096
QUERIES = 256
BLOCK = "block int, dim int, ids binary, vecs binary"


@lru_cache(maxsize=2)
def rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vecs: np.ndarray, centre: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed signs, length, product of direction and signs) of each row."""
    rest = vecs - centre
    length = np.sqrt(np.einsum("ij,ij->i", rest, rest))
    turned = rest @ rotation(vecs.shape[1], seed).T
    own = np.abs(turned).sum(axis=1) / (np.sqrt(vecs.shape[1]) * np.where(length > 0, length, 1.0))
    return np.packbits(turned >= 0, axis=1), length, np.where(length > 0, own, 1.0)


def estimate(queries: np.ndarray, bits: np.ndarray, length: np.ndarray, own: np.ndarray, centre: np.ndarray, seed: int,
             eps: float) -> tuple[np.ndarray, np.ndarray]:
    """(queries, rows) estimated inner products and their error bounds."""
    dim = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=dim).astype(np.float32) * 2 - 1
    turned = (queries @ rotation(dim, seed).T).astype(np.float32)
    scale = (length / (own * np.sqrt(dim))).astype(np.float32)
    guess = turned @ signs.T * scale + (queries @ centre).astype(np.float32)[:, None]
    spread = length * np.sqrt(np.maximum(1 - own * own, 0.0)) / own * eps / np.sqrt(max(dim - 1, 1))
    size = np.sqrt(np.einsum("ij,ij->i", queries, queries))
    return guess, (size[:, None] * spread[None, :] + 1e-4 * (1 + size)[:, None]).astype(np.float32)


def nearest(q_ids, queries, ids, vecs, bits, length, own, centre, k: int, seed: int, eps: float) -> tuple[list, list, list]:
    """Query ids, candidate ids and exact products of each query's k best of a group."""
    guess, error = estimate(queries, bits, length, own, centre, seed, eps)
    out_q, out_v, out_s = [], [], []

    def exact(row: int, at: np.ndarray) -> np.ndarray:
        return np.einsum("ij,j->i", vecs[at], queries[row])  # row by row the same sum, so equal vectors tie

    for row in range(len(queries)):
        line = np.where(ids == q_ids[row], -np.inf, guess[row])
        some = np.argpartition(-line, 2 * k)[:2 * k] if len(line) > 2 * k else np.arange(len(line))
        some = some[np.isfinite(line[some])]
        if not len(some):
            continue
        bound = -np.inf if len(some) < k else np.partition(exact(row, some), len(some) - k)[len(some) - k]
        at = np.flatnonzero(line + error[row] >= bound)
        score = exact(row, at)
        best = np.lexsort((ids[at], -score))[:k]
        out_q.append(np.full(len(best), q_ids[row]))
        out_v.append(ids[at[best]])
        out_s.append(score[best])
    return out_q, out_v, out_s


def _blocks(rows: DataFrame, most: int, dim: int, n_blocks: int) -> DataFrame:
    """(block, dim, ids, vecs): rows of one ``block`` number together, at most ``most`` in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, vecs = None, [], []

        def emit():
            body = np.zeros((len(vecs), dim))
            for k, v in enumerate(vecs):
                body[k, :len(v)] = v
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([dim], pa.int32()), pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()),
                 pa.array([body.tobytes()], pa.binary())], names=["block", "dim", "ids", "vecs"])

        for batch in batches:
            column = batch.column(2)
            flat, at = column.flatten().to_numpy(), column.offsets.to_numpy()
            at = at - at[0]
            for k, (block, i) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if ids and (block != now or len(ids) == most):
                    yield emit()
                    ids, vecs = [], []
                now = block
                ids.append(i)
                vecs.append(flat[at[k]:at[k + 1]])
        if ids:
            yield emit()

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(n_blocks)).cast("int"))
    return dealt.select("block", "id", "v").repartition(n_blocks, "block").sortWithinPartitions("block", "id").mapInArrow(run, BLOCK)


def one_bit_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 7,
                  group: int = GROUP) -> tuple[DataFrame, int, int, list[float]]:
    """((block, dim, ids, vecs, bits, length, own), number of blocks, components, centre) over every valid row."""
    rows = valid_rows(vectors, id_col, vector_col)
    n, dim = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    sums = dict(rows.select(F.posexplode("v")).groupBy("pos").agg(F.sum("col")).collect())  # one number a component
    centre = [round(sums.get(k, 0.0) / max(n, 1), 6) for k in range(dim)]
    groups = max(1, -(-n // group))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                bits, length, own = encode(np.frombuffer(r["vecs"]).reshape(-1, dim), np.array(centre), seed)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["block"]], pa.int32()), pa.array([dim], pa.int32()), *(pa.array([x], pa.binary()) for x in (
                        r["ids"], r["vecs"], bits.tobytes(), length.tobytes(), own.tobytes()))],
                    names=["block", "dim", "ids", "vecs", "bits", "length", "own"])

    index = _blocks(rows, group, dim, groups).mapInArrow(code, BLOCK + ", bits binary, length binary, own binary")
    return write_scratch(index, "one-bit-codes"), groups, dim, centre


def valid_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = col(vector_col).cast("array<double>")
    ok = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.coalesce(ok & F.col("id").isNotNull(), F.lit(False)))


def nearest_neighbours(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20,
                       seed: int = 7, eps: float = 1.9, group: int = GROUP, block: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query over all other rows."""
    index, groups, dim, centre = one_bit_index(vectors, id_col, vector_col, seed, group)
    queries = valid_rows(vectors.filter(is_query), id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    n = queries.count()
    asked = _blocks(queries, block, dim, max(1, -(-n // block))).select(F.col("ids").alias("q_ids"), F.col("vecs").alias("q_vecs")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)}
                found = nearest(np.frombuffer(r["q_ids"], "<i8"), np.frombuffer(r["q_vecs"]).reshape(-1, dim), np.frombuffer(r["ids"], "<i8"),
                                np.frombuffer(r["vecs"]).reshape(-1, dim), np.frombuffer(r["bits"], np.uint8).reshape(-1, -(-dim // 8)),
                                np.frombuffer(r["length"]), np.frombuffer(r["own"]), np.array(centre), k, seed, eps)
                if found[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in found], names=["query_id", "vec_id", "score"])

    best = asked.join(index, "block").select("q_ids", "q_vecs", "ids", "vecs", "bits", "length", "own") \
        .mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
