"""Declarative extraction (X1-X12): text column + FieldSpec list -> result columns.

A narrow, per-row projection: no shuffle, no Python. The section split (D5) is
materialised once in its own column so every field reads it without repeating
the regex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.fieldspec import FieldSpec, declared_labels, with_response, with_typed
from quarry.functions.text import CODE, label_values, section_text
from quarry.operators.partitioning import spread

_PAIRS = "__kv"


def _with_pairs(df: DataFrame, text_col: str | Column, spec: list[FieldSpec], section: str | None, markers: str) -> DataFrame:
    df = spread(df)
    text = F.col(text_col) if isinstance(text_col, str) else text_col
    if section:
        text = section_text(text, section, markers)
    return df.withColumn(_PAIRS, label_values(text, *declared_labels(spec)))


def extract(df: DataFrame, text_col: str | Column, spec: list[FieldSpec], out: str = "ai_result",
            section: str | None = "en", root: str = "response", markers: str = CODE) -> DataFrame:
    """Add ``out`` = variant ``{root: {field: value}}``; the reference's extract stage contract."""
    return with_response(_with_pairs(df, text_col, spec, section, markers), _PAIRS, spec, out, root).drop(_PAIRS)


def extract_typed(df: DataFrame, text_col: str | Column, spec: list[FieldSpec],
                  section: str | None = "en", markers: str = CODE) -> DataFrame:
    """Add one typed column per field (string or double) directly, for callers that need no variant."""
    return with_typed(_with_pairs(df, text_col, spec, section, markers), _PAIRS, spec).drop(_PAIRS)
