"""Structured Streaming runners around the batch operators.

Each stage is a stateless append query: read the stage before as a stream,
apply the same DataFrame function the batch path uses, write parquet with its
own checkpoint, run with ``availableNow`` (process what is there, then stop).
A rerun picks up only new input files; the checkpoint makes the sink
exactly-once, so a lost executor or a restarted run does not duplicate rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.extract import extract
from quarry.operators.flatten import flatten
from quarry.operators.parse import document_text, to_document
from quarry.plans.specs import EXTRACT_COMMENT, PARSED_COMMENT, PROCESSED_COMMENT, PROCESSED_SCHEMA, PRODUCT_SPEC
from quarry.sources.tables import create_table, ensure_namespace

STAGE_COMMENTS = {"parsed": PARSED_COMMENT, "extract": EXTRACT_COMMENT, "processed": PROCESSED_COMMENT}


def run_stage(source: DataFrame, fn: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
              name: str | None = None) -> None:
    """Run one append stage to completion over the input available now."""
    w = fn(source).writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start(out_path)
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_batches(source: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``fn(rows, number)`` for every batch of the input available now."""
    q = source.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def stream_table(spark: SparkSession, path: str, like: DataFrame | None = None, schema=None) -> DataFrame:
    """Stream the files of a parquet table; file sources need an explicit schema."""
    schema = schema or (like.schema if like is not None else spark.read.parquet(path).schema)
    return spark.readStream.schema(schema).parquet(path)


# The three stages of the document -> catalog flow, as functions of a DataFrame.

def parse_stage(raw: DataFrame) -> DataFrame:
    """Stage 1: (path, file_name, file_size, content bytes) -> parsed value + document text."""
    d = raw.select("path", "file_name", "file_size", F.decode("content", "UTF-8").alias("__text"))
    return to_document(d, "path", "__text", keep=["file_name", "file_size"])


def extract_stage(parsed: DataFrame) -> DataFrame:
    """Stage 2: parsed -> ai_result (extraction reads the element texts)."""
    d = parsed.select("path", "file_name", "file_size", document_text(F.col("parsed")).alias("__text"))
    return extract(d, "__text", PRODUCT_SPEC).select("path", "file_name", "file_size", "ai_result")


def process_stage(extracted: DataFrame) -> DataFrame:
    """Stage 3: the declared, typed catalog."""
    return flatten(extracted, "ai_result", PROCESSED_SCHEMA, keys=["file_name"], errors_col=None)


RAW_SCHEMA = "path string, file_name string, file_size bigint, content binary"


def stage_schema(spark: SparkSession, *stages: Callable[[DataFrame], DataFrame]) -> T.StructType:
    """Columns that a chain of stages gives for raw documents; no file is read, so an empty first run has them too."""
    df = spark.createDataFrame([], RAW_SCHEMA)
    for stage in stages:
        df = stage(df)
    return df.schema


def _folder(spark: SparkSession, path: str) -> str:
    """``path``, made if it is missing: a file stream needs its folder, also before the stage before wrote a row."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)
    return path


def run_pipeline(spark: SparkSession, source: DataFrame, workdir: str, prefix: str | None = None, database: str | None = None) -> dict[str, str]:
    """Run the three chained stages once over a stream of raw documents; returns the output path of each stage.

    ``source`` has the columns of ``RAW_SCHEMA``: ``stream_files`` over a folder of files (with files and bytes a
    trigger), or ``stream_table`` over a table of them. A run without new documents leaves all stages as they are.
    With ``prefix``, each stage is also a table ``{database}.{prefix}_productmanuals_{stage}`` with its table and
    column comments, as the reference names and comments its pipeline tables.
    """
    out = {s: f"{workdir}/{s}" for s in ("parsed", "extract", "processed")}
    ck = {s: f"{workdir}/_checkpoints/{s}" for s in out}
    schemas = {"parsed": stage_schema(spark, parse_stage), "extract": stage_schema(spark, parse_stage, extract_stage),
               "processed": PROCESSED_SCHEMA}
    run_stage(source, parse_stage, out["parsed"], ck["parsed"])
    run_stage(stream_table(spark, _folder(spark, out["parsed"]), schema=schemas["parsed"]), extract_stage, out["extract"], ck["extract"])
    run_stage(stream_table(spark, _folder(spark, out["extract"]), schema=schemas["extract"]), process_stage, out["processed"], ck["processed"])
    _folder(spark, out["processed"])
    if prefix:
        db = f"{database}." if database else ""
        if database:
            ensure_namespace(spark, database, f"{workdir}/database")
        for stage, path in out.items():
            create_table(spark, f"{db}{prefix}_productmanuals_{stage}", path, schemas[stage], STAGE_COMMENTS[stage])
    return out
