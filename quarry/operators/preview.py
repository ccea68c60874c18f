"""JSON row preview (P10) and variant path reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREVIEW_ROWS = 1000


def iso_text(ts: Column) -> Column:
    """datetime.isoformat(): fraction only when the microseconds are not zero."""
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == 0, base).otherwise(F.concat(base, F.lit("."), F.lpad(micros.cast("string"), 6, "0")))


def json_preview(df: DataFrame, order_by: list[str], n: int = PREVIEW_ROWS) -> DataFrame:
    """At most ``n`` rows (in key order) as JSON objects; NULL stays null, timestamps ISO, decimals text.

    ``orderBy().limit()`` is a distributed top-n (TakeOrderedAndProject).
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = iso_text(c)
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    top = df.orderBy(*order_by).limit(n)
    return top.select(*order_by, F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("row_json"))


def variant_path(df: DataFrame, json_col: str, path: str, type_: str, keys: list[str]) -> DataFrame:
    """Typed value, text value and the whole document as JSON text, read from a JSON column."""
    v = F.parse_json(F.col(json_col))
    return df.select(*keys, F.try_variant_get(v, path, type_).alias("value"),
                     F.try_variant_get(v, path, "string").alias("value_text"),
                     F.variant_get(v, "$", "string").alias("doc_text"))
