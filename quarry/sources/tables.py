"""Table scans (S4) and table sinks (K2-K6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table of a data folder; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(table_path(sf_dir, name))


def ensure_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Idempotent namespace set-up (K5); ``location`` places a new database's folder."""
    where = f" LOCATION {_sql_str(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in declared order, cast to the declared types (K4).

    A value that does not fit its type becomes NULL and never ends the job; ``flatten`` reports such fields.
    """
    cols = []
    for field in schema.fields:
        c = F.col(field.name).try_cast(field.dataType)
        comment = (field.metadata or {}).get("comment")
        cols.append(c.alias(field.name, metadata={"comment": comment}) if comment else c.alias(field.name))
    return df.select(*cols)


def save_table(df: DataFrame, name: str, schema: T.StructType | None = None, comment: str | None = None,
               path: str | None = None) -> None:
    """Create-or-replace a table as select (K2/K3), with table and column comments (K4).

    The rows go to a new folder below ``path`` (default: the warehouse folder of that name); then the table is
    pointed at it by one ALTER TABLE. Until then readers see the old rows, a failing write changes nothing, and
    ``df`` may read the table itself. Old folders stay until they are cleaned up. A table whose columns change
    is dropped and created anew, which takes two steps.
    """
    import uuid

    spark = df.sparkSession
    if schema is not None:
        df = enforce_schema(df, schema)
    base = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}-versions"
    location = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(location)
    columns = spark.read.parquet(location).schema
    if spark.catalog.tableExists(name):
        if [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in columns]:
            spark.sql(f"ALTER TABLE {name} SET LOCATION {_sql_str(location)}")
            spark.catalog.refreshTable(name)
        else:
            spark.sql(f"DROP TABLE {name}")
    if not spark.catalog.tableExists(name):
        create_table(spark, name, location, schema or columns)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_sql_str(comment)}")


def create_table(spark: SparkSession, name: str, location: str, schema: T.StructType, comment: str | None = None) -> None:
    """A named parquet table over a folder, with its column and table comments (idempotent)."""
    def column(f: T.StructField) -> str:
        said = (f.metadata or {}).get("comment")
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_sql_str(said)}" if said else "")

    about = f" COMMENT {_sql_str(comment)}" if comment else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(map(column, schema.fields))}) USING parquet LOCATION {_sql_str(location)}{about}")


def column_comments(spark: SparkSession, name: str) -> DataFrame:
    """(col_name, data_type, comment) of a table, as DESCRIBE reports it."""
    return (spark.sql(f"DESCRIBE TABLE {name}")
            .filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
            .select("col_name", "data_type", "comment"))


METRICS = "run_ts timestamp, metric string, value double, experiment string, run_id string"


def append_metrics(metrics: DataFrame, path: str, experiment: str = "default") -> None:
    """Run metrics sink (K6): (run_id, run_ts, metric, value) rows under an experiment.

    A run is a partition of its own and replaces itself only, so a retry never doubles its metrics.
    """
    metrics.select("run_ts", "metric", F.col("value").cast("double").alias("value"), F.lit(experiment).alias("experiment"), "run_id") \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("experiment", "run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str, experiment: str = "default") -> DataFrame:
    """(run_id, run_ts, metric, value) of all runs of an experiment."""
    return spark.read.schema(METRICS).parquet(path).filter(F.col("experiment") == experiment).select("run_id", "run_ts", "metric", "value")


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back (no memo).

    For an intermediate read by several branches of one plan: each branch reads the
    files instead of recomputing the input, and a lost executor re-reads them.
    """
    from quarry.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


SCRATCH_DATABASE = "quarry_scratch"
_MATERIALIZED: dict[tuple[str, str, str], DataFrame] = {}


def materialize(df: DataFrame | Callable[[], DataFrame], key: str, scope: str = "",
                spark: SparkSession | None = None, bucket_by: tuple[int, list[str]] | None = None) -> DataFrame:
    """Write a DataFrame once as parquet below the shared checkpoint folder and read it back.

    A written table cuts the lineage (a lost executor re-reads files instead of
    recomputing the extraction) and is an optimisation barrier: filters on the
    result become parquet pushed filters instead of being inlined into the
    costly projection below. Memoised per application, ``scope`` and ``key``.
    ``df`` may be a zero-argument builder (then ``spark`` is required): a memo
    hit then skips building and analysing the plan that produced the table.

    ``bucket_by=(n, cols)`` writes a bucketed table (registered in the session
    catalog, files still below the shared folder). Its readers know the hash
    partitioning on ``cols``, so aggregations and joins grouped by a superset of
    ``cols`` need no shuffle of this table.
    """
    import uuid

    from quarry.session import scratch_path

    if spark is None:
        spark = df.sparkSession
    memo = (spark.sparkContext.applicationId, scope, key)
    table = _MATERIALIZED.get(memo)
    if table is None:
        built = df() if callable(df) else df
        path = scratch_path(spark, key)
        if bucket_by is None:
            built.write.mode("overwrite").parquet(path)
            table = spark.read.parquet(path)
        else:
            n, cols = bucket_by
            # Bucketed tables need a catalog entry; their database lives below the shared folder too.
            ensure_namespace(spark, SCRATCH_DATABASE, scratch_path(spark, "database"))
            name = f"{SCRATCH_DATABASE}.{key}_{uuid.uuid4().hex[:12]}"
            built.write.mode("overwrite").format("parquet").option("path", path) \
                .bucketBy(n, *cols).saveAsTable(name)
            table = spark.table(name)
        _MATERIALIZED[memo] = table
    return table
