"""Phrase collocations by SON partitioning.

Documents are dealt to ``shards`` by a hash of their id. A phrase found
``min_count`` times in all is found at least ceil(min_count / shards) times in
one shard, so that is the local support.

1. Mining. Every shard is mined completely, level by level: its frequent words,
   then the pairs of two frequent words, then longer phrases whose pairs are
   all frequent. A shard is a key and not a task: the tasks that read its
   documents count ahead, and one shuffle a level adds the counts up.
2. Union. A phrase frequent in some shard is a candidate.
3. Counting. One more pass counts every candidate over all documents, exactly
   and by its words; what stays below ``min_count`` goes.

Between passes only sets of 64-bit hashes are handed on, as bit tables of at
most ``2**MOST_BITS`` bits (16 per member, so of a proven size). Two phrases on
one bit can only add a candidate that the exact count then drops. Mining counts
by hash for the same reason; the counts in the result are by words.

Scores come from the frequent phrases alone, since every part of a frequent
phrase is frequent. A part such as a common first word is a hot key: its count
is dealt to ``SALTS`` copies and the phrases to one of them each. Neither side
is broadcast: both grow with the frequent phrases, and by their copies and cuts
they are far larger than the files that Spark sizes them by.

Defined results: null texts are empty; a null language is ``und``; rows of one
id, also of a null id, lie in one shard and count each; repeated texts count
each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import col, write_scratch
from quarry.llm.wordtable import WordTable, classes, mixed, text_chunks, word_table

KIND = classes(b" \t", b".,;:!?\n\x0b\x0c\r")
CHUNK = 4 << 20
SHARD_BITS = 5
LEAST_BITS, MOST_BITS = 16, 27
UNION_SHIFT = 32
SALTS = 16


def keys(h: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Hashes whose last bits are the shard."""
    return (h & ~np.uint64((1 << SHARD_BITS) - 1)) | shard.astype(np.uint64)


class Bits:
    """A set of keys as a broadcast bit table; may hold more than was put in, never less.

    A shard's keys are read from a bit of their own on; with ``union`` the shard is no part of a member.
    """

    def __init__(self, members: DataFrame, union: bool = False):
        n = members.count()
        self.size, self.union = 1 << min(MOST_BITS, max(LEAST_BITS, (16 * n - 1).bit_length() if n else 0)), union
        shift = F.lit(UNION_SHIFT) if union else F.col("key").bitwiseAND(F.lit((1 << SHARD_BITS) - 1)).cast("int") + SHARD_BITS
        spot = F.call_function("shiftrightunsigned", F.col("key"), shift).bitwiseAND(F.lit(self.size - 1))
        lines = members.select(spot.alias("spot")).groupBy(F.shiftright("spot", 6).cast("int").alias("line")) \
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("spot") % 64).cast("int"))).alias("bits")).toArrow()
        table = np.zeros(self.size // 64, dtype=np.int64)
        table[lines.column("line").to_numpy()] = lines.column("bits").to_numpy()
        self.table = members.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def has(self, h: np.ndarray, shard: np.ndarray | None = None) -> np.ndarray:
        shift = np.uint64(UNION_SHIFT) if self.union else shard.astype(np.uint64) + np.uint64(SHARD_BITS)
        spot = (h >> shift) & np.uint64(self.size - 1)
        return (self.table.value[(spot >> np.uint64(6)).view(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


class Chunk:
    """Words of some documents with their languages, shards and hashes."""

    def __init__(self, langs: pa.Array, shards: pa.Array, texts: pa.Array):
        words: WordTable = word_table(texts, KIND, fold=True)
        lang = langs.dictionary_encode()
        self.names, self.langs, self.code = words.names, lang.dictionary, words.code
        self.lang = lang.indices.to_numpy(zero_copy_only=False)[words.text]
        self.shard = shards.to_numpy(zero_copy_only=False)[words.text]
        named = pd.util.hash_array(self.names.to_numpy(zero_copy_only=False), categorize=False) if len(self.names) else np.zeros(0, dtype=np.uint64)
        tongue = pd.util.hash_array(self.langs.to_numpy(zero_copy_only=False), categorize=False) if len(self.langs) else np.zeros(0, dtype=np.uint64)
        self.h = mixed(named[self.code], tongue[self.lang])
        n = len(self.code)
        self.next = np.zeros(n, dtype=bool)  # the following word stands in the same piece
        self.next[:-1] = (words.text[1:] == words.text[:-1]) & (words.cuts[1:] == words.cuts[:-1])

    def longer(self, at: np.ndarray, h: np.ndarray, m: int) -> np.ndarray:
        """Hashes of the phrases of m words from those of their first m - 1."""
        return mixed(h, self.h[at + m - 1])

    def counted(self, at: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """A first place and the count of each distinct phrase of m words that starts at ``at``, by its words."""
        key = self.lang[at].astype(np.int64)
        for k in range(m):
            _, key = np.unique(key * np.int64(len(self.names)) + self.code[at + k], return_inverse=True)
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        return at[first], counts


def _per_chunk(docs: DataFrame, emit: Callable[[Chunk], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_chunks(batch, 2, CHUNK):
                chunk = Chunk(part.column(0), part.column(1), part.column(2))
                if len(chunk.code):
                    yield from emit(chunk)

    return docs.mapInArrow(run, schema)


def _mined(found: list[np.ndarray]) -> pa.RecordBatch:
    """Counts of keys."""
    key, counts = np.unique(np.concatenate(found), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(counts)], names=["key", "c"])


def mine_phrases(docs: DataFrame, min_count: int = 30, max_words: int = 4, shards: int = 5, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, n), (lang, phrase, m, f)): words per language and every phrase of 1 to ``max_words`` words found ``min_count`` times."""
    if not 1 <= shards <= 31 or max_words < 2:
        raise ValueError("1 to 31 shards, phrases of two words at least")
    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.pmod(F.xxhash64(col(id_col)), F.lit(shards)).cast("int").alias("shard"), col(text_col).cast("string").alias("text"))
    support = -(-min_count // shards)
    mined = "key long, c long"

    def words(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        key = ((chunk.lang.astype(np.int64) << SHARD_BITS) + chunk.shard) * len(chunk.names) + chunk.code
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [chunk.langs.take(pa.array(chunk.lang[first])), pa.array(chunk.shard[first], pa.int32()),
             chunk.names.take(pa.array(chunk.code[first])).cast(pa.string()), pa.array(keys(chunk.h[first], chunk.shard[first]).view(np.int64)),
             pa.array(counts)], names=["lang", "shard", "word", "key", "c"])

    counted = write_scratch(_per_chunk(rows, words, "lang string, shard int, word string, key long, c long")
                            .groupBy("lang", "shard", "word").agg(F.max("key").alias("key"), F.sum("c").alias("c")), "shard-words")
    frequent_words = Bits(counted.filter(F.col("c") >= support))

    def pairs(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        known = frequent_words.has(chunk.h, chunk.shard)
        at = np.flatnonzero(chunk.next[:-1] & known[:-1] & known[1:])
        yield _mined([keys(chunk.longer(at, chunk.h[at], 2), chunk.shard[at])])

    def local(emit: Callable[[Chunk], Iterator[pa.RecordBatch]], name: str) -> DataFrame:
        return write_scratch(_per_chunk(rows, emit, mined).groupBy("key").agg(F.sum("c").alias("c")).filter(F.col("c") >= support), name)

    frequent_pairs = local(pairs, "shard-pairs")
    candidates = frequent_pairs.select("key")
    if max_words > 2:
        pair_bits = Bits(frequent_pairs)

        def rest(chunk: Chunk) -> Iterator[pa.RecordBatch]:
            at = np.flatnonzero(chunk.next)
            h = chunk.longer(at, chunk.h[at], 2)
            some = pair_bits.has(h, chunk.shard[at])
            at, h = at[some], h[some]
            linked = np.zeros(len(chunk.code) + max_words, dtype=bool)
            linked[at] = True
            found = []
            for m in range(3, max_words + 1):
                some = linked[at + m - 2]
                at = at[some]
                h = chunk.longer(at, h[some], m)
                found.append(keys(h, chunk.shard[at]))
            yield _mined(found)

        candidates = candidates.unionAll(local(rest, "shard-phrases").select("key"))
    candidate_bits = Bits(candidates, union=True)

    def count(chunk: Chunk) -> Iterator[pa.RecordBatch]:
        joined = np.append(chunk.next, np.zeros(max_words, dtype=bool))
        at, h = np.arange(len(chunk.code)), chunk.h
        for m in range(2, max_words + 1):
            some = joined[at + m - 2]
            at = at[some]
            h = chunk.longer(at, h[some], m)
            some = candidate_bits.has(h)  # a phrase is a candidate only if its beginning is
            at, h = at[some], h[some]
            if not len(at):
                return
            first, counts = chunk.counted(at, m)
            parts = [chunk.names.take(pa.array(chunk.code[first + k])).cast(pa.string()) for k in range(m)]
            yield pa.RecordBatch.from_arrays(
                [chunk.langs.take(pa.array(chunk.lang[first])), pc.binary_join_element_wise(*parts, " "),
                 pa.array(np.full(len(first), m, dtype=np.int32)), pa.array(counts)], names=["lang", "phrase", "m", "f"])

    phrases = _per_chunk(rows, count, "lang string, phrase string, m int, f long").groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f"))
    singles = counted.groupBy("lang", F.col("word").alias("phrase")).agg(F.sum("c").alias("f")).select("lang", "phrase", F.lit(1).alias("m"), "f")
    found = write_scratch(singles.unionAll(phrases).filter(F.col("f") >= min_count), "phrases")
    return counted.groupBy("lang").agg(F.sum("c").alias("n")), found


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(28,0)")


def collocations(docs: DataFrame, min_count: int = 30, max_words: int = 4, top: int = 2000, scale: int = 2_000_000, covered: int = 80,
                 shards: int = 5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of two words or more.

    The score floor(scale * a / (l + r)) is that of the cut into a first and a second part (counts l and r) with the
    lowest score, ties to the shortest first part. A phrase inside a longer one with 100 * f(longer) >= covered * a is
    dropped. Order: score and a falling, then phrase by bytes.
    """
    totals, found = mine_phrases(docs, min_count, max_words, shards, id_col, text_col, lang_col)
    longer = found.filter("m > 1")
    sides = F.array(F.struct(F.lit(0).alias("side"), F.expr("substring_index(phrase, ' ', k)").alias("part")),
                    F.struct(F.lit(1).alias("side"), F.expr("substring_index(phrase, ' ', k - m)").alias("part")))
    cuts = longer.withColumn("k", F.explode(F.expr("sequence(1, m - 1)"))).withColumn("x", F.explode(sides)) \
        .select("lang", "phrase", F.col("f").alias("a"), "k", "x.side", "x.part", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("salt"))
    parts = found.filter(F.col("m") < max_words) \
        .select("lang", F.col("phrase").alias("part"), "f", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")).alias("salt"))
    names = [f"{side}{k}" for k in range(1, max_words) for side in "lr"]
    cuts = cuts.join(parts.hint("merge"), ["lang", "part", "salt"]).select(
        "lang", "phrase", "a", F.lit(None).cast("long").alias("longer"),
        *[F.when((F.col("k") == int(x[1:])) & (F.col("side") == "lr".index(x[0])), F.col("f")).alias(x) for x in names])
    inside = longer.filter("m > 2").withColumn("w", F.split("phrase", " ")) \
        .withColumn("size", F.explode(F.expr("sequence(2, m - 1)"))).withColumn("from", F.explode(F.expr("sequence(1, m - size + 1)"))) \
        .select("lang", F.array_join(F.slice("w", F.col("from"), F.col("size")), " ").alias("phrase"), F.lit(None).cast("long").alias("a"),
                F.col("f").alias("longer"), *[F.lit(None).cast("long").alias(x) for x in names])
    rows = cuts.unionAll(inside).groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in ("a", "longer", *names)]) \
        .filter(F.col("longer").isNull() | (F.lit(100) * _exact("longer") < F.lit(covered) * _exact("a")))

    def cut(k: int) -> Column:
        score = F.expr(f"(CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(28,0))) div (CAST(l{k} AS DECIMAL(28,0)) + CAST(r{k} AS DECIMAL(28,0)))")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    rows = rows.withColumn("best", F.array_min(F.array_compact(F.array(*[cut(k) for k in range(1, max_words)]))))
    rows = rows.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


__all__ = ["collocations", "mine_phrases"]
