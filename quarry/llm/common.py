"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.tables import write_scratch

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for intermediate results that clash with no column of ``df`` (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its literal name, also with dots or spaces in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """Maximal runs without space, tab, line feed, vertical tab, form feed or carriage return."""
    trimmed = F.btrim(c, F.lit(WHITE))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


__all__ = ["WHITE", "ascii_lower", "col", "fresh", "is_empty", "let", "words", "write_scratch"]
