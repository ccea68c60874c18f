"""Typed flatten of a variant result into a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _path(root: str | None, name: str) -> str:
    return f"$.{root}.{name}" if root else f"$.{name}"


def flatten(df: DataFrame, value_col: str, schema: T.StructType, keys: list[str] | None = None,
            root: str | None = "response", strict: bool = False, errors_col: str | None = "cast_errors") -> DataFrame:
    """One typed column per schema field read from ``value_col``.

    Lenient by default: a value that does not cast becomes NULL and its field
    name is listed in ``errors_col``; ``strict=True`` raises instead.
    Fields of ``schema`` that are also in ``keys`` are taken from the row, not the value.
    """
    keys = keys or []
    v = F.col(value_col)
    cols: list[Column] = []
    errs: list[Column] = []
    for f in schema.fields:
        if f.name in keys:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
            continue
        tname = f.dataType.simpleString()
        p = _path(root, f.name)
        typed = F.variant_get(v, p, tname) if strict else F.try_variant_get(v, p, tname)
        cols.append(typed.alias(f.name))
        raw = F.try_variant_get(v, p, "string")
        errs.append(F.when(typed.isNull() & raw.isNotNull(), F.lit(f.name)))
    extra = [F.array_compact(F.array(*errs)).alias(errors_col)] if (errors_col and errs) else []
    return df.select(*cols, *extra)
