"""Row generation from array columns without evaluating the array twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def posexplode_rows(df: DataFrame, keep: list, arr: str | Column, pos: str, value: str) -> DataFrame:
    """Rows (keep..., pos, value) for every element of ``arr``; none for an empty or NULL array.

    ``posexplode`` of a column computed in an earlier projection makes Catalyst infer
    ``size(arr) > 0`` and push it below that projection, so a regex-built array is
    computed twice per row. The outer form infers nothing, and the filter on the
    generated position cannot move below the generator.
    """
    return df.select(*keep, F.posexplode_outer(arr).alias(pos, value)).filter(F.col(pos).isNotNull())
