"""Exact top-k inner products by norm buckets.

Vectors are dealt by range of length (then id, so equal lengths are split) and
numbered within a partition, longest first; ``bucket`` consecutive ones are a
bucket with its longest length.

1. Every query meets the bucket of the greatest length: the k-th best product
   is a lower bound of its k-th best score.
2. A bucket whose longest length times the query's length is below that bound
   is left out (length pruning between buckets). A query is sent to the
   partitions of the length range that it reaches, a prefix of them, and there
   to the buckets that it reaches.
3. A bucket's vectors and its queries come to one task, vectors first, so that
   neither is repeated for every pair; a bucket that many queries reach is
   copied to several tasks with a part of the queries each. The local cosine
   threshold, bound / (query length x bucket length), chooses the pruning: from
   ``coord_from`` up by coordinates (a vector with the needed cosine has each
   of the query's largest coordinates in a known interval), below it by length
   (a prefix of the bucket).
4. What is left is verified by exact integer products, and the k best per query
   and bucket go to a window per query.

Defined results: null vectors, empty vectors and vectors with a null or
non-finite component, and rows with a null id, take no part; vectors of unequal
length are compared as if the shorter one ended in zeros; ties go to the
smaller id; a candidate with the query's id is the query's own row; a query
with fewer than k candidates gets all of them; an empty table gives no rows.
Products are exact while they fit in 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import col, write_scratch
from quarry.operators.partitioning import sized_broadcast

SLACK = 1e-9
FOCUS = 3


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, in double precision; null if the vector takes no part."""
    x = vector.cast("array<double>")
    valid = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v))
    return F.when(valid & (F.size(x) > 0), whole)


def _dense(vectors: pa.ListArray) -> np.ndarray:
    """Vectors as rows of a matrix, shorter ones ended with zeros."""
    flat, at = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
    at = at - at[0]
    size = np.diff(at)
    dim = int(size.max(initial=0))
    if len(flat) == len(size) * dim:
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim), dtype=np.int64)
    out[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(at[:-1], size)] = flat
    return out


def _stacked(blocks: list[np.ndarray]) -> np.ndarray:
    dim = max(b.shape[1] for b in blocks)
    return np.concatenate([np.pad(b, ((0, 0), (0, dim - b.shape[1]))) for b in blocks])


def products(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact integer products of rows; by floating point where every sum stays below 2**53."""
    d = min(q.shape[1], p.shape[1])
    q, p = q[:, :d], p[:, :d]
    if len(q) and len(p) and d and float(np.abs(q).max()) * float(np.abs(p).max()) * d < 2**53:
        return np.rint(q.astype(np.float64) @ p.T.astype(np.float64)).astype(np.int64)
    return q @ p.T


def search(q_ids, q, bound, p_ids, p, k: int, coord_from: float) -> tuple[list, list, list]:
    """Query ids, candidate ids and scores of each query's k best in one bucket (rows of ``p`` by falling length)."""
    qf, pf = q.astype(np.float64), p.astype(np.float64)
    qn, pn = np.sqrt((qf**2).sum(axis=1)), np.sqrt((pf**2).sum(axis=1))
    unit = pf / np.where(pn > 0, pn, 1.0)[:, None]
    out_q, out_p, out_s = [], [], []
    known = np.isfinite(bound) & (bound > 0) & (qn > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(known, bound / np.where(qn > 0, qn, 1.0), -np.inf)
        cosine = np.where(known, need / max(pn[0], 1e-300), -np.inf)
    reach = np.searchsorted(-pn, -need * (1 - SLACK), "right")  # length pruning: a prefix
    by_coord = known & (cosine >= coord_from)
    by_length = ~by_coord & (reach > 0)

    def keep(row: int, at: np.ndarray, score: np.ndarray) -> None:
        own = p_ids[at] != q_ids[row]
        if np.isfinite(bound[row]):
            own &= score >= bound[row]
        at, score = at[own], score[own]
        order = np.lexsort((p_ids[at], -score))[:k]
        out_q.append(np.full(len(order), q_ids[row]))
        out_p.append(p_ids[at[order]])
        out_s.append(score[order])

    rows = np.flatnonzero(by_length)
    if len(rows):
        most = int(reach[rows].max())
        table = products(q[rows], p[:most])
        for line, row in enumerate(rows.tolist()):
            keep(row, np.arange(reach[row]), table[line, :reach[row]])
    for row in np.flatnonzero(by_coord & (cosine <= 1 + SLACK)).tolist():
        at = np.arange(reach[row])
        c = min(1.0, cosine[row])
        for f in np.argsort(-np.abs(qf[row]))[:FOCUS].tolist():
            if f >= unit.shape[1]:
                continue
            x = qf[row, f] / qn[row]
            spread = np.sqrt(max(0.0, (1 - c * c) * (1 - x * x))) + SLACK
            value = unit[at, f]
            ok = value >= x * c - spread
            if x < 0:
                ok = value <= x * c + spread
            at = at[ok]
        if len(at):
            keep(row, at, products(q[row:row + 1], p[at])[0])
    return out_q, out_p, out_s


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, scale: int = 1024,
          bucket: int = 2048, block: int = 512, coord_from: float = 0.5, queries_per_task: int = 65536) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best integer products of each query over all other rows."""
    rows = vectors.select(col(id_col).cast("long").alias("id"), scaled(col(vector_col), scale).alias("v"), is_query.alias("is_query")) \
        .filter("id IS NOT NULL AND v IS NOT NULL")
    rows = rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))))
    # The number of a row is its partition, shifted by 33 bits, and its place in it.
    number, shift = F.col("number"), 33
    dealt = rows.repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id").withColumn("number", F.monotonically_increasing_id())
    first_of = F.shiftleft(F.shiftright(number, shift), shift)
    dealt = write_scratch(dealt.select("id", "v", "norm", "is_query", F.shiftright(number, shift).alias("part"),
                                       (first_of + F.floor((number - first_of) / bucket)).alias("bucket")), "norm-buckets")
    buckets = write_scratch(dealt.groupBy("part", "bucket").agg(F.max("norm").alias("top")), "bucket-lengths")

    # Collected: the rows of one bucket, and the longest length of each partition of the range.
    longest = buckets.agg(F.max_by("bucket", F.struct("top", "bucket"))).first()[0]
    seed = dealt.filter(F.col("bucket") == F.lit(longest)).select("id", "v").toArrow().combine_chunks()
    seed = vectors.sparkSession.sparkContext.broadcast(
        (seed["id"].to_numpy(), _dense(seed["v"].chunk(0))) if seed.num_rows else (np.zeros(0, np.int64), np.zeros((0, 0), np.int64)))
    lengths = sorted((r.part, r.top) for r in buckets.groupBy("part").agg(F.max("top").alias("top")).collect()) or [(0, 0.0)]

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p_ids, p = seed.value
        for whole in batches:
            for batch in (whole.slice(s, block) for s in range(0, whole.num_rows, block)):
                q_ids, q = batch.column(0).to_numpy(), _dense(batch.column(1))
                score = products(q, p).astype(np.float64)
                score[q_ids[:, None] == p_ids[None, :]] = -np.inf
                bound = np.full(len(q), -np.inf) if len(p) < k else np.partition(score, len(p) - k, axis=1)[:, len(p) - k]
                norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
                sure = np.isfinite(bound) & (bound > 0) & (norm > 0)
                need = np.where(sure, bound / np.where(norm > 0, norm, 1.0), 0.0) * (1 - SLACK)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(need), pa.array(bound)], names=["id", "v", "need", "bound"])

    queries = dealt.filter("is_query").select("id", "v").repartition("id").mapInArrow(seeds, "id long, v array<long>, need double, bound double")
    queries = write_scratch(queries, "bounded-queries")

    # A query reaches the partitions up to the last one whose longest length is long enough.
    parts = F.lit([part for part, _ in lengths])
    tops = F.lit(np.maximum.accumulate([top for _, top in lengths][::-1])[::-1].tolist())
    reached = F.slice(parts, F.lit(1), F.size(F.filter(tops, lambda top: top >= F.col("need"))))
    meet = queries.withColumn("part", F.explode(reached)).join(sized_broadcast(buckets), "part").filter("top >= need")
    tasks = write_scratch(meet.groupBy("bucket").agg(F.ceil(F.count("*") / queries_per_task).cast("int").alias("tasks")), "bucket-tasks")
    share = sized_broadcast(tasks)
    of_bucket = dealt.select("bucket", "id", "v").join(share, "bucket") \
        .select("bucket", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), F.lit(0).alias("kind"), "id", "v", F.lit(0.0).alias("bound"))
    of_queries = meet.join(share, "bucket") \
        .select("bucket", F.pmod(F.xxhash64("id"), "tasks").cast("int").alias("task"), F.lit(1).alias("kind"), "id", "v", "bound")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ready = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            at, kind, ids, bound = np.stack([batch.column(c).to_numpy() for c in (0, 1)], axis=1), *[batch.column(c).to_numpy() for c in (2, 3, 5)]
            change = np.flatnonzero((at[1:] != at[:-1]).any(axis=1) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                if tuple(at[a]) != key:
                    key, held, ready = tuple(at[a]), [], None
                if kind[a] == 0:
                    held.append((ids[a:b], _dense(batch.column(4).slice(a, b - a))))
                    continue
                if ready is None:
                    p = _stacked([x for _, x in held])
                    order = np.argsort(-(p.astype(np.float64) ** 2).sum(axis=1), kind="stable")
                    ready = np.concatenate([x for x, _ in held])[order], p[order]
                for s in range(a, b, block):
                    e = min(s + block, b)
                    found = search(ids[s:e], _dense(batch.column(4).slice(s, e - s)), bound[s:e], *ready, k, coord_from)
                    if found[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in found], names=["query_id", "vec_id", "score"])

    met = of_bucket.unionByName(of_queries).repartition("bucket", "task").sortWithinPartitions("bucket", "task", "kind")
    best = met.mapInArrow(verify, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
