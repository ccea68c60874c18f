"""Parallelism for CPU-heavy narrow work.

Regex extraction, segmentation, chunking and response flattening cost far more
per row than reading the row. A scan of few, large row groups (or one small
file) gives few input partitions, and the heavy projection then runs on one
core. ``spread`` round-robins such an input to the session's parallelism first.
It looks at the planner's size estimate only and starts no job: an input of at
least one scan split per core (the normal case on a cluster) is left alone, so
no shuffle is added there. An explicit repartition is not coalesced back by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bounds for an explicit broadcast: a side is broadcast only after a count proves it is below both.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    if df.isStreaming or not hasattr(df, "_jdf"):
        return df
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(target) if size < target * split else df


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and ``max_bytes`` bytes; reads at most ``max_rows + 1`` rows."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, (T.StringType, T.BinaryType))
                 else F.lit(0) for f in df.schema.fields), F.lit(16 * len(df.columns)))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only if a bounded count shows that it is small.

    Beyond the bounds the join is left to the planner (a shuffle join, with AQE
    still free to broadcast at runtime and to split skewed keys).
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
