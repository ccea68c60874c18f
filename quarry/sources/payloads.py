"""Bulk payload ingest (S6): (name, base64) rows -> accepted files and rejects.

Set-based version of an upload endpoint: names must end in '.pdf' (any case),
payloads must decode, the target path is folder + '/' + name, and a later
payload for the same name replaces an earlier one. The latest row per name is
found with max_by over an explicit sequence column (a partial aggregate, so a
name repeated millions of times is not one task's input).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ingest_payloads(df: DataFrame, folder: str, name_col: str = "name", b64_col: str = "content_base64",
                    order_col: str = "seq", suffix: str = ".pdf") -> tuple[DataFrame, DataFrame]:
    decoded = df.select(F.col(name_col).alias("name"), F.col(order_col).alias("seq"),
                        F.try_to_binary(F.col(b64_col), F.lit("base64")).alias("content"))
    is_pdf = F.lower("name").endswith(suffix.lower())
    reason = F.when(~is_pdf, F.lit("not a pdf")).when(F.col("content").isNull(), F.lit("invalid base64"))
    marked = decoded.withColumn("reason", reason)
    rejected = marked.filter(F.col("reason").isNotNull()).select("seq", "name", "reason")
    ok = marked.filter(F.col("reason").isNull())
    latest = ok.groupBy("name").agg(F.max_by("content", "seq").alias("content"), F.max("seq").alias("seq"))
    prefix = folder.rstrip("/") + "/"
    accepted = latest.select("name", F.concat(F.lit(prefix), F.col("name")).alias("path"),
                             F.octet_length("content").cast("bigint").alias("size"), "seq", "content")
    return accepted, rejected
