"""Cited passage retrieval (R1-R4, J3): chunks, term index, BM25 top-k per question.

Postings carry the chunk length and the document language, so a search needs
no join back to the documents. ``segments.py`` writes them bucketed by chunk
and sorted by term part and term: the scores of a chunk are summed where its
postings lie, and the parts of a file without a question term are skipped by
the pushed filter. Question terms are broadcast only after a size check; top-k
per question is a row_number filter, which Spark plans as a partial
WindowGroupLimit before the one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.arrays import posexplode_rows
from quarry.functions.text import terms, words
from quarry.operators.partitioning import fits_broadcast, spread

TERM_PARTS = 64
BM25_K1 = 1.2
BM25_B = 0.75


def chunk(df: DataFrame, key: str, text_col: str, size: int = 200, overlap: int = 50,
          keep: list[str] = ()) -> DataFrame:
    """Word windows of ``size`` words, consecutive windows sharing ``overlap`` words."""
    step = size - overlap
    w = words(F.col(text_col))
    d = spread(df).select(key, *keep, w.alias("__w")).withColumn("__n", F.size("__w"))
    # No chunk for a text without words: an empty start list, not a row filter (a filter on __n
    # would be pushed below the projection and split every text a second time).
    starts = F.when(F.col("__n") > 0,
                    F.sequence(F.lit(0), F.greatest(F.col("__n") - overlap, F.lit(1)) - 1, F.lit(step))) \
        .otherwise(F.array().cast("array<int>"))
    d = d.select(key, *keep, "__w", F.posexplode(starts).alias("chunk_no", "__s"))
    piece = F.slice("__w", F.col("__s") + 1, F.lit(size))
    return d.select(key, *keep, "chunk_no", F.size(piece).alias("n_words"), F.array_join(piece, " ").alias("text"))


def term_part(term: Column, parts: int = TERM_PARTS) -> Column:
    """Number of the part of the index that holds a term's postings."""
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def term_index(chunks: DataFrame, key: str = "doc_id", keep: list[str] = ()) -> DataFrame:
    """R2: postings (term, key, chunk_no, tf, dl, *keep); dl = number of terms of the chunk."""
    t = chunks.select(key, "chunk_no", *keep, terms(F.col("text")).alias("__t"))
    # Each chunk is tokenised once; dl is the chunk's term count. Chunks are grouped, not their many terms: rows of
    # one key and number become one sorted list, whose runs of equal terms are the postings.
    t = t.groupBy(key, "chunk_no", F.size("__t").alias("dl"), *keep).agg(F.sort_array(F.flatten(F.collect_list("__t"))).alias("__t"))
    places = F.transform("__t", lambda x, i: F.when((i == 0) | (x != F.get("__t", i - 1)), i))
    t = t.select(key, "chunk_no", "dl", *keep, "__t", F.array_compact(places).alias("__s"))
    runs = F.transform("__s", lambda s, i: F.struct(
        F.get("__t", s).alias("term"), (F.coalesce(F.get("__s", i + 1), F.size("__t")) - s).cast("long").alias("tf")))
    rows = posexplode_rows(t, [key, "chunk_no", "dl", *keep], runs, "__p", "__r")
    return rows.select("__r.term", key, "chunk_no", "dl", *keep, "__r.tf")


def term_dictionary(postings: DataFrame) -> DataFrame:
    """(term, df): the index's dictionary, built once next to the postings."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def index_stats(postings: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row (n_chunks, sum_dl, n_postings) of collection statistics, from the postings alone.

    Chunks without a term have no posting and don't count. sum_dl is the sum of tf, so no text is tokenised again.
    """
    per_chunk = postings.groupBy(key, "chunk_no").agg(F.sum("tf").alias("dl"), F.count(F.lit(1)).alias("n"))
    return per_chunk.agg(F.count(F.lit(1)).alias("n_chunks"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a)
                                                              for c, a in (("dl", "sum_dl"), ("n", "n_postings"))])


def search(questions: DataFrame, qkey: str, qtext: str, postings: DataFrame | list[DataFrame], key: str = "doc_id", k: int = 3,
           prefer: tuple[str, str] | None = None, dictionary: DataFrame | None = None, stats: DataFrame | None = None,
           parts: int = TERM_PARTS) -> DataFrame:
    """Top-k chunks per question by BM25; ties by key, chunk. ``prefer=(col, value)`` ranks those first.

    One plan: the postings of the question terms, summed per question and chunk. ``postings`` may be the segments of
    an index; a chunk lies in one of them. If they have a ``part`` column (see ``term_part``), the parts without a
    question term are skipped by a pushed filter; the part numbers, at most ``parts``, are the only thing collected.
    ``dictionary`` and ``stats`` may be partial sums (a row a segment); without them they are computed here.
    """
    segments = postings if isinstance(postings, list) else [postings]
    qt = questions.select(qkey, F.explode(F.array_distinct(terms(F.col(qtext)))).alias("term")).distinct()
    # One size check: the distinct terms and their weights are never larger than qt.
    small = fits_broadcast(qt)
    bc = F.broadcast if small else (lambda d: d)
    qterms = qt.select("term").distinct()
    if all("part" in p.columns for p in segments):
        wanted = sorted(r.part for r in qterms.select(term_part(F.col("term"), parts).alias("part")).distinct().collect())
        # Equalities reach the scan one by one; of a long IN list only its least and greatest value would. Beyond half of
        # the parts, the test of each row costs more than the rows that it saves.
        if len(wanted) <= parts // 2:
            among = reduce(Column.__or__, [F.col("part") == p for p in wanted], F.lit(False))
            segments = [p.filter(among) for p in segments]
            if dictionary is not None and "part" in dictionary.columns:
                dictionary = dictionary.filter(among)
    whole = reduce(DataFrame.unionByName, postings if isinstance(postings, list) else [postings])
    st = (stats if stats is not None else index_stats(whole, key)).agg(F.sum("n_chunks").alias("n_chunks"), F.sum("sum_dl").alias("sum_dl")).first()
    n_chunks = float(st["n_chunks"] or 0)
    avgdl = st["sum_dl"] / n_chunks if n_chunks else 0.0
    source = dictionary if dictionary is not None else term_dictionary(whole)
    dfreq = source.join(bc(qterms), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (n_chunks - F.col("df") + 0.5) / (F.col("df") + 0.5))
    keep = [prefer[0]] if prefer else []
    part = F.col("idf") * F.col("tf") * (BM25_K1 + 1) / (
        F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / avgdl))
    order = [F.col("score").desc(), F.col(key), F.col("chunk_no")]
    if prefer:
        order = [(F.col(prefer[0]) == prefer[1]).desc()] + order
    w = Window.partitionBy(qkey).orderBy(*order)
    idfs = dfreq.select("term", idf.alias("idf"))
    # Scores are rounded so that exact copies tie whatever the summation order, then ties go by key, chunk.
    if small:
        asking, numbered, numbers = _numbered(qt, qkey)
        weights = F.broadcast(numbered.join(F.broadcast(idfs), "term", "inner"))
        level = F.when(F.col(prefer[0]) == prefer[1], 0).when(F.col(prefer[0]) != prefer[1], 1).otherwise(2) if prefer else F.lit(0)
        in_chunk = Window.partitionBy(key, "chunk_no", *keep).orderBy(key)
        # A task sees the question terms of one chunk after the other and makes no row for a question and a chunk.
        scores = reduce(DataFrame.unionByName, [_best_of_tasks(
            p.join(weights, "term", "inner").select(key, "chunk_no", *keep, level.alias("__level"), "__t", part.alias("__w"))
            .withColumn("__first", F.row_number().over(in_chunk) == 1).sortWithinPartitions(key, "chunk_no", *keep), asking, k) for p in segments])
        scores = scores.join(F.broadcast(numbers), "__q")
    else:
        scores = reduce(DataFrame.unionByName, [
            p.join(qt.join(idfs, "term", "inner"), "term", "inner").groupBy(qkey, key, "chunk_no", *keep)
            .agg(F.round(F.sum(part), 6).alias("score")) for p in segments])
    return scores.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select(qkey, "rank", key, "chunk_no", *keep, "score")


def _numbered(qt: DataFrame, qkey: str) -> tuple[tuple[np.ndarray, np.ndarray], DataFrame, DataFrame]:
    """Question terms and questions numbered from 0; ``qt`` has passed the size check of a broadcast.

    Returns the question numbers in order of their terms with the place where each term's begin, the terms
    (term, __t), and the questions (__q, qkey).
    """
    pairs = qt.select("term", qkey).toArrow()
    (terms_, t), (questions_, q) = ((c.dictionary, c.indices.to_numpy()) for c in (
        pairs.column(i).combine_chunks().dictionary_encode("encode") for i in (0, 1)))
    starts = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=len(terms_)))])
    asking = q[np.argsort(t, kind="stable")].astype(np.int64)

    def table(values: pa.Array, field: T.StructField, number: str) -> DataFrame:
        numbers = pa.array(np.arange(len(values), dtype=np.int32))
        schema = T.StructType([T.StructField(number, T.IntegerType()), T.StructField(field.name, field.dataType)])
        return qt.sparkSession.createDataFrame(pa.table([numbers, values], names=[number, field.name]), schema)
    return (starts, asking), table(terms_, qt.schema["term"], "__t"), table(questions_, qt.schema[qkey], "__q")


def _best_of_tasks(hits: DataFrame, asking: tuple[np.ndarray, np.ndarray], k: int, pairs_at_once: int = 2_000_000) -> DataFrame:
    """(__q, the leading columns of ``hits``, score): each task's first k chunks a question by __level, score, place.

    ``hits`` has a row for a chunk and a term that questions ask for, the terms of a chunk behind each other: behind the columns
    that are given back lie __level, the number of the term __t, its weight __w, and __first in a chunk. Chunks are taken
    by blocks of at most ``pairs_at_once`` pairs of a row and a question (or one chunk), so that memory grows neither with the
    task nor with questions times chunks.
    """
    shared = hits.sparkSession.sparkContext.broadcast(asking)
    columns = [f for f in hits.schema.fields if f.name not in ("__level", "__t", "__w", "__first")]

    def whole_chunks(batches: Iterator[pa.RecordBatch], rows_at_once: int = 100_000) -> Iterator[tuple[pa.Table, np.ndarray]]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= rows_at_once:
                got = pa.Table.from_batches(held)
                first = np.flatnonzero(got["__first"].to_numpy())
                held = got.slice(first[-1]).to_batches()
                if len(first) > 1:
                    yield got.slice(0, first[-1]).combine_chunks(), first
        if held:
            got = pa.Table.from_batches(held).combine_chunks()
            yield got, np.append(np.flatnonzero(got["__first"].to_numpy()), got.num_rows)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, asking = shared.value
        asked, n = np.diff(starts), int(asking.max(initial=-1)) + 1
        # Found so far, in order of question, level, falling score and place; the last ones are what a new one has to beat.
        q, level, score, rows = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), None
        last_level, last_score = np.full(n, 3), np.full(n, -np.inf)
        for got, first in whole_chunks(batches):
            given = got.select([f.name for f in columns])
            levels, t, w = (got[c].to_numpy() for c in ("__level", "__t", "__w"))
            times = asked[t]
            upto = np.concatenate([[0], np.cumsum(times)])
            rows = given.slice(0, 0) if rows is None else rows
            a = 0
            while a < len(first) - 1:
                s = first[a]
                b = max(a + 1, int(np.searchsorted(upto[first], upto[s] + pairs_at_once, "right")) - 1)
                e = first[b]
                # The pairs of the block: each term of a chunk with each question that asks for it.
                cell = np.arange(upto[s], upto[e]) + np.repeat(starts[t[s:e]] - upto[s:e], times[s:e])
                cell = asking[cell] + np.repeat(np.repeat(np.arange(b - a) * n, np.diff(first[a:b + 1])), times[s:e])
                weight = np.repeat(w[s:e], times[s:e])
                if (b - a) * n <= 8 * len(cell):
                    total, seen = np.bincount(cell, weight, (b - a) * n), np.zeros((b - a) * n, bool)
                    seen[cell] = True
                    cells = np.flatnonzero(seen)
                    total = total[cells]
                else:
                    cells, place = np.unique(cell, return_inverse=True)
                    total = np.bincount(place, weight, len(cells))
                new_q, at = cells % n, first[cells // n + a]
                new_score = np.sign(total) * np.floor(np.abs(total) * 1e6 + 0.5) / 1e6
                new_level = levels[at]
                better = (new_level < last_level[new_q]) | (new_level == last_level[new_q]) & (new_score > last_score[new_q])
                if better.any():
                    had = len(q)
                    q, level, score = (np.concatenate([x, y[better]]) for x, y in ((q, new_q), (level, new_level), (score, new_score)))
                    order = np.lexsort((-score, level, q))
                    begins = np.flatnonzero(np.diff(q[order], prepend=-1))
                    rank = np.arange(len(order)) - np.repeat(begins, np.diff(begins, append=len(order)))
                    kept, rank = order[rank < k], rank[rank < k]
                    fresh = kept >= had
                    found = at[better][kept[fresh] - had]
                    q, level, score = q[kept], level[kept], score[kept]
                    kept[fresh] = had + np.arange(len(found))
                    rows = pa.concat_tables([rows, given.take(found)]).combine_chunks().take(kept)
                    full = rank == k - 1
                    last_level[q[full]], last_score[q[full]] = level[full], score[full]
                a = b
        if len(q):
            out = pa.table([pa.array(q.astype(np.int32)), *rows.columns, pa.array(score)], names=["__q", *rows.column_names, "score"])
            yield from out.combine_chunks().to_batches(max_chunksize=10_000)

    return hits.mapInArrow(best, T.StructType([T.StructField("__q", T.IntegerType()), *columns, T.StructField("score", T.DoubleType())]))


def new_rows(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key (e.g. path + modified time) is not in ``known`` (left anti join)."""
    return df.join(known.select(*keys).distinct(), on=keys, how="left_anti")
