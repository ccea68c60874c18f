"""The document -> catalog flow as batch DataFrames: parsed -> extract -> processed.

These are the same functions the streaming runner applies per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarry.operators.extract import extract
from quarry.operators.flatten import flatten
from quarry.plans.specs import PROCESSED_SCHEMA, PRODUCT_SPEC
from quarry.sources.fixtures import parsed_manuals
from quarry.sources.tables import materialize


def extract_stage(parsed: DataFrame, spec=None, text_col: str = "document") -> DataFrame:
    """Stage 2: (path, file_name, file_size, ai_result)."""
    return extract(parsed.select("path", "file_name", "file_size", text_col), text_col,
                   spec or PRODUCT_SPEC).select("path", "file_name", "file_size", "ai_result")


def process_stage(extracted: DataFrame, schema: T.StructType = PROCESSED_SCHEMA,
                  errors_col: str | None = None) -> DataFrame:
    """Stage 3: the declared, typed catalog."""
    return flatten(extracted, "ai_result", schema, keys=["file_name"], errors_col=errors_col)


def manuals_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_stage(parsed_manuals(spark, sf_dir))


def manuals_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15-column processed catalog built from the ``manuals`` fixture."""
    return process_stage(manuals_extract(spark, sf_dir))


def manuals_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed catalog as a table: built once per session and data folder, then read."""
    return materialize(lambda: manuals_processed(spark, sf_dir), "processed", scope=sf_dir, spark=spark)

