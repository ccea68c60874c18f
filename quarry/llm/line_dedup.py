"""Line dedup across documents (native).

Lines are normalised (white space stripped at both ends, A-Z lower-cased),
hashed to 128 bits and exploded. Per hash the smallest document and the number
of distinct documents are aggregated with map-side partials; the hashes over
the threshold are written once, so the join that finds the lines to drop has a
plain exchange on both sides and a hot line is split by AQE. Positions to drop
are gathered per document (bounded by its own lines) and the text is rebuilt by
position from the document's own line array.

Defined results: null text counts as one empty line and stays null; a row with
a null id neither counts nor loses lines; rows that repeat an id are the same
document (all of them keep a line whose first document they are); repeated rows
are each rebuilt; extra columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WHITE, ascii_lower, col, fresh, write_scratch


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
                min_docs: int = 2, n_lines_col: str | None = None, n_dropped_col: str | None = None) -> DataFrame:
    """``docs`` with repeated lines gone from every document but the first that holds them.

    A line counts if its key has ``min_chars`` code points or more; it is
    repeated if ``min_docs`` or more documents hold the key.
    """
    text = F.coalesce(col(text_col), F.lit(""))
    lines = docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("version"), F.split(text, "\n", -1).alias("lines")) \
        .filter(F.col("id").isNotNull())
    keys = lines.select("id", "version", F.posexplode("lines").alias("pos", "line")) \
        .select("id", "version", "pos", ascii_lower(F.btrim("line", F.lit(WHITE))).alias("key")) \
        .filter(F.length("key") >= min_chars) \
        .select("id", "version", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))

    if min_docs <= 2:
        holders = keys.groupBy("h1", "h2").agg(F.min("id").alias("first"), F.max("id").alias("last"))
        repeated = holders.filter((F.col("first") < F.col("last")) | F.lit(min_docs < 2))
    else:
        repeated = keys.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one")).groupBy("h1", "h2") \
            .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter(F.col("n") >= min_docs)
    repeated = write_scratch(repeated.select("h1", "h2", "first"), "repeated-lines")

    drops = keys.join(repeated, ["h1", "h2"]).filter(F.col("id") > F.col("first")) \
        .groupBy("id", "version").agg(F.collect_set("pos").alias("drops"))

    version, drop, line, d_id, d_version = fresh(docs, "l_version", "l_drops", "l_lines", "l_id", "l_of")
    left = docs.withColumn(version, F.xxhash64(text))
    right = drops.select(F.col("id").alias(d_id), F.col("version").alias(d_version), F.col("drops").alias(drop))
    out = left.join(right, (col(id_col) == col(d_id)) & (col(version) == col(d_version)), "left")
    out = out.withColumn(line, F.split(text, "\n", -1))
    left_over = F.array_except(F.sequence(F.lit(0), F.size(col(line)) - 1), col(drop))
    rebuilt = F.array_join(F.transform(left_over, lambda i: F.get(col(line), i)), "\n")
    kept = F.when(col(drop).isNull(), col(text_col)).otherwise(rebuilt)
    counts = {n_lines_col: F.size(col(line)).cast("long"),
              n_dropped_col: F.when(col(drop).isNull(), 0).otherwise(F.size(col(drop))).cast("long")}
    counts = {k: v for k, v in counts.items() if k}
    taken = {k.lower() for k in counts}
    return out.select(*[kept.alias(c) if c == text_col else col(c) for c in docs.columns if c.lower() not in taken],
                      *[v.alias(k) for k, v in counts.items()])
