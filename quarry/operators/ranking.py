"""Ranking helpers that never move a whole table into one task.

``top_with_ties`` returns the rows whose SQL ``rank()`` over ``order`` is at
most ``k``. The rank is computed on at most ``k`` distinct sort keys (found
with a distributed top-k and a partial aggregate), and the qualifying keys are
joined back with a broadcast equi-join whose size is bounded by ``k``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_with_ties(df: DataFrame, col: str, k: int, descending: bool = True, rank_col: str = "rnk") -> DataFrame:
    """Rows with rank() <= k over ``col`` (NULLs never rank)."""
    keyed = df.filter(F.col(col).isNotNull())
    order = F.col(col).desc() if descending else F.col(col).asc()
    # k best distinct keys with their multiplicities: top-k over a partial aggregate.
    counts = keyed.groupBy(col).agg(F.count(F.lit(1)).alias("__n")).orderBy(order).limit(k)
    # rank = 1 + rows strictly before this key; the window runs over <= k rows.
    # One constant partition on purpose: ``counts`` holds at most k rows.
    w = Window.partitionBy(F.lit(0)).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (counts.withColumn(rank_col, (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).cast("int"))
             .filter(F.col(rank_col) <= k).select(col, rank_col))
    return keyed.join(F.broadcast(ranks), on=col, how="inner")


def first_by(df: DataFrame, group: list[str], order: list[Column], cols: list[str]) -> DataFrame:
    """One row per group: the first by ``order`` (a total order), via min_by on a struct key.

    Aggregates partially on the map side, so a hot group never lands whole in one task.
    """
    key = F.struct(*order)
    aggs = [F.min_by(F.col(c), key).alias(c) for c in cols]
    return df.groupBy(*group).agg(*aggs)
