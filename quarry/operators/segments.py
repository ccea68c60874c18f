"""A passage index of immutable segments.

A sync writes the new documents as one segment: their keys, chunks, postings
(bucketed by chunk, sorted by term part and term), term counts and statistics.
Nothing of the other segments is touched. The segment counts from the moment its name is
appended to the list of segments, the last and only visible step: a sync that
fails before leaves a folder that nobody reads, and running it again adds what
is missing and nothing else.

Readers see the union of the listed segments. Document frequencies and
statistics are sums over segments, so a search over old and new segments equals
one over an index built at once. ``compact`` writes the union as one segment
and lists it together with the names it replaces.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.retrieval import TERM_PARTS, chunk, new_rows, term_dictionary, term_index, term_part
from quarry.session import scratch_path
from quarry.sources.tables import ensure_namespace

DATABASE = "quarry_index"
LIST = "segment string, replaces array<string>"


@dataclass(frozen=True)
class PassageIndex:
    """Where an index lies, and how its documents are keyed and cut."""

    path: str
    key: str = "doc_id"
    version: tuple[str, ...] = ()          # further columns that tell a known document from a new one
    keep: tuple[str, ...] = ()             # columns carried to chunks and postings
    size: int = 200
    overlap: int = 50
    parts: int = TERM_PARTS
    buckets: int | None = None             # of a segment's postings; None: the session's shuffle partitions


@dataclass(frozen=True)
class IndexTables:
    """The live segments: unions of their tables, but for the postings, which stay apart with their buckets."""

    documents: DataFrame
    chunks: DataFrame
    dictionary: DataFrame
    stats: DataFrame
    postings: list[DataFrame]


def _listed(spark: SparkSession, index: PassageIndex) -> DataFrame:
    """The list of segments; empty before the first sync."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{index.path}/list")
    exists = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(LIST).parquet(f"{index.path}/list") if exists else spark.createDataFrame([], LIST)


def live_segments(spark: SparkSession, index: PassageIndex) -> list[str]:
    """Names of the listed segments that no other has replaced."""
    rows = _listed(spark, index).collect()  # one row a sync
    gone = {s for r in rows for s in r.replaces}
    return sorted(r.segment for r in rows if r.segment not in gone)


def read_index(spark: SparkSession, index: PassageIndex) -> IndexTables:
    """The index as tables. Term counts and statistics have a row a segment."""
    names = live_segments(spark, index)
    if not names:
        raise ValueError(f"no segment at {index.path}")
    whole = {t: reduce(DataFrame.unionByName, [spark.read.parquet(f"{index.path}/segments/{s}/{t}") for s in names])
             for t in ("documents", "chunks", "dictionary", "stats")}
    return IndexTables(**whole, postings=[_postings(spark, index, s) for s in names])


def _postings(spark: SparkSession, index: PassageIndex, segment: str) -> DataFrame:
    """A segment's postings as a bucketed table; the catalog entry is made again from the files where it is missing."""
    ensure_namespace(spark, DATABASE, scratch_path(spark, "database"))
    name, path = f"{DATABASE}.postings_{segment}", f"{index.path}/segments/{segment}/postings"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
        buckets = spark.read.parquet(f"{index.path}/segments/{segment}/stats").first().buckets
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{index.key}`, chunk_no) SORTED BY (part, term) "
                  f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _append(spark: SparkSession, index: PassageIndex, segment: str, replaces: list[str]) -> None:
    spark.createDataFrame([(segment, replaces)], LIST).coalesce(1).write.mode("append").parquet(f"{index.path}/list")


def _write_postings(postings: DataFrame, index: PassageIndex, segment: str, buckets: int) -> None:
    ensure_namespace(postings.sparkSession, DATABASE, scratch_path(postings.sparkSession, "database"))
    postings.withColumn("part", term_part(F.col("term"), index.parts)).write.format("parquet") \
        .option("path", f"{index.path}/segments/{segment}/postings").bucketBy(buckets, index.key, "chunk_no").sortBy("part", "term") \
        .saveAsTable(f"{DATABASE}.postings_{segment}")


def _write_terms(dictionary: DataFrame, index: PassageIndex, path: str) -> None:
    dictionary.withColumn("part", term_part(F.col("term"), index.parts)).repartitionByRange("part", "term") \
        .sortWithinPartitions("part", "term").write.parquet(path)


def sync(docs: DataFrame, index: PassageIndex, text_col: str = "text") -> DataFrame:
    """Add the documents that no segment holds; returns the chunks added (none if all are known)."""
    spark = docs.sparkSession
    keys = [index.key, *index.version]
    names = live_segments(spark, index)
    # Keys alone are compared; the texts of the new documents are fetched by them.
    fresh = docs.select(*keys).distinct()
    if names:
        fresh = new_rows(fresh, read_index(spark, index).documents, keys)
    name = uuid.uuid4().hex
    folder = f"{index.path}/segments/{name}"
    fresh.write.parquet(f"{folder}/documents")
    fresh = spark.read.parquet(f"{folder}/documents")
    chunks = chunk(docs.join(fresh, keys, "left_semi"), index.key, text_col, index.size, index.overlap, keep=list(index.keep))
    chunks.write.parquet(f"{folder}/chunks")
    chunks = spark.read.parquet(f"{folder}/chunks")
    if fresh.take(1):
        buckets = index.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Chunks are shuffled, which are far smaller than their postings; those are then counted and written where they are made.
        _write_postings(term_index(chunks.repartition(buckets, index.key, "chunk_no"), index.key, keep=list(index.keep)), index, name, buckets)
        postings = _postings(spark, index, name)
        _write_terms(term_dictionary(postings), index, f"{folder}/dictionary")
        # sum_dl is the sum of tf, so no text is tokenised again; chunks count even if they hold no term.
        postings.agg(F.coalesce(F.sum("tf"), F.lit(0)).alias("sum_dl"), F.count(F.lit(1)).alias("n_postings")) \
            .withColumn("n_chunks", F.lit(chunks.count())).withColumn("buckets", F.lit(buckets)).coalesce(1).write.parquet(f"{folder}/stats")
        _append(spark, index, name, [])
    return chunks


def compact(spark: SparkSession, index: PassageIndex) -> None:
    """Write the live segments as one; readers of the old ones are not disturbed."""
    names = live_segments(spark, index)
    if len(names) < 2:
        return
    tables = read_index(spark, index)
    name = uuid.uuid4().hex
    folder = f"{index.path}/segments/{name}"
    buckets = max(r.buckets for r in tables.stats.select("buckets").collect())
    tables.documents.write.parquet(f"{folder}/documents")
    tables.chunks.write.parquet(f"{folder}/chunks")
    postings = reduce(DataFrame.unionByName, tables.postings).drop("part")
    _write_postings(postings.repartition(buckets, index.key, "chunk_no"), index, name, buckets)
    _write_terms(tables.dictionary.groupBy("term").agg(F.sum("df").alias("df")), index, f"{folder}/dictionary")
    tables.stats.agg(*[F.sum(c).alias(c) for c in ("sum_dl", "n_postings", "n_chunks")]).withColumn("buckets", F.lit(buckets)) \
        .coalesce(1).write.parquet(f"{folder}/stats")
    _append(spark, index, name, names)
