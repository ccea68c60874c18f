"""Rewritten and removed files.

Spark's file stream source remembers paths: a file rewritten at a path it has
already seen is skipped, and rows of a deleted file stay. The replace mode here
is a batch sync instead. The snapshot is dealt to buckets by a hash of the
source path, and a sync

1. lists the folder (no bytes read) and compares it with the last listing by a
   full outer join: added, changed and removed files;
2. writes the buckets of those files anew, into a folder of its own: their old
   rows but for the named paths, and the rows of added and changed files. Files
   older than the oldest changed one are left out by the scan;
3. appends its number and its buckets to the list of syncs, the one visible step.

A bucket is read from the last sync that wrote it, so buckets without a change
keep their files, and a sync that fails before its last step changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.partitioning import sized_broadcast
from quarry.sources.files import scan_files

BUCKETS = 64
LIST = "sync int, buckets array<int>"
_FILE = "file_path string, file_modification_time timestamp"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _owners(spark: SparkSession, out: str) -> dict[int, int]:
    """Bucket -> the last sync that wrote it."""
    rows = spark.read.schema(LIST).parquet(f"{out}/list").collect() if _exists(spark, f"{out}/list") else []
    return {b: r.sync for r in sorted(rows, key=lambda r: r.sync) for b in r.buckets}


def read_snapshot(spark: SparkSession, out: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of all files as of the last sync, with their file_path; ``buckets`` reads some buckets only."""
    owners = _owners(spark, out)
    wanted: dict[int, list[int]] = {}
    for b, sync in owners.items():
        if buckets is None or b in buckets:
            wanted.setdefault(sync, []).append(b)
    whole = f"{schema}, file_path string, bucket int"
    parts = [spark.read.schema(whole).parquet(f"{out}/rows/sync={k}").filter(F.col("bucket").isin(bs))
             for k, bs in sorted(wanted.items()) if _exists(spark, f"{out}/rows/sync={k}")]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], whole)


def sync_latest(spark: SparkSession, folder: str, schema: str, out: str, fn=lambda d: d, buckets: int = BUCKETS) -> dict[str, int]:
    """One replace-mode sync of ``folder`` into ``out``; returns the numbers of added, changed and removed files.

    ``fn`` maps the rows of added and changed files and keeps the columns of ``schema`` and file_path.
    """
    owners = _owners(spark, out)
    number = max(owners.values(), default=0) + 1
    while _exists(spark, f"{out}/state/sync={number}"):  # left by a sync that failed
        number += 1
    listing = scan_files(spark, folder, pattern="*.parquet", content=False) \
        .select(F.col("path").alias("file_path"), F.col("modified_at").alias("file_modification_time"))
    listing.write.parquet(f"{out}/state/sync={number}")
    listing = spark.read.schema(_FILE).parquet(f"{out}/state/sync={number}")
    known = spark.read.schema(_FILE).parquet(f"{out}/state/sync={max(owners.values())}") if owners else listing.limit(0)
    kind = F.when(F.col("was").isNull(), "added").when(F.col("file_modification_time").isNull(), "removed") \
        .when(F.col("was") != F.col("file_modification_time"), "changed")
    diff = listing.join(known.withColumnRenamed("file_modification_time", "was"), "file_path", "full_outer") \
        .select("file_path", "file_modification_time", kind.alias("kind"), F.pmod(F.xxhash64("file_path"), F.lit(buckets)).cast("int").alias("bucket")) \
        .filter("kind IS NOT NULL")
    diff.write.parquet(f"{out}/diff/sync={number}")
    diff = spark.read.parquet(f"{out}/diff/sync={number}")
    counts = {r.kind: r.n for r in diff.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    touched = sorted(r.bucket for r in diff.select("bucket").distinct().collect())  # at most ``buckets`` numbers
    if touched:
        since = diff.agg(F.min("file_modification_time")).first()[0]
        rows = spark.read.schema(schema).parquet(folder).select(
            "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("file_modification_time"))
        rows = rows.filter(F.col("_metadata.file_modification_time") >= F.lit(since)) if since is not None else rows.limit(0)
        # The changed-file set grows with the folder: broadcast only behind a row-count check.
        now = sized_broadcast(diff.filter("kind <> 'removed'").select("file_path", "file_modification_time"))
        fresh = fn(rows.join(now, ["file_path", "file_modification_time"], "left_semi").drop("file_modification_time"))
        fresh = fresh.withColumn("bucket", F.pmod(F.xxhash64("file_path"), F.lit(buckets)).cast("int"))
        kept = read_snapshot(spark, out, schema, touched).join(sized_broadcast(diff.select("file_path")), "file_path", "left_anti")
        kept.unionByName(fresh.select(*kept.columns)).write.partitionBy("bucket").parquet(f"{out}/rows/sync={number}")
        spark.createDataFrame([(number, touched)], LIST).coalesce(1).write.mode("append").parquet(f"{out}/list")
    return {k: counts.get(k, 0) for k in ("added", "changed", "removed")}


def place_files(spark: SparkSession, df: DataFrame, key: str, folder: str, tmp: str, id_col: str | None = None,
                rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` as parquet files ``folder/<value>-<i>.parquet`` per ``key`` value, replacing them.

    A value gets ceil(rows / rows_per_file) files, so a hot value (a third of all rows) is
    written by many tasks, not one. Rows go to file pmod(hash(id_col), files): with a stable
    id, a rewrite of the same rows lands on the same paths.
    """
    n = df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).cast("int").alias("__files"))
    ident = F.col(id_col) if id_col else F.col(key)
    d = df.join(sized_broadcast(n), key)
    d = d.withColumn("__part", F.concat(F.col(key).cast("string"), F.lit("-"),
                                        F.pmod(F.xxhash64(ident), F.col("__files")).cast("string")))
    d.drop("__files").repartition("__part").write.partitionBy("__part").parquet(tmp)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(tmp)
    fs = base.getFileSystem(conf)
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{tmp}/__part=*/part-*.parquet")):
        value = st.getPath().getParent().getName().split("=", 1)[1]
        dst = jvm.org.apache.hadoop.fs.Path(f"{folder}/{value}.parquet")
        fs.mkdirs(dst.getParent())
        if fs.exists(dst):
            fs.delete(dst, False)
        fs.rename(st.getPath(), dst)


def remove_files(spark: SparkSession, pattern: str) -> None:
    """Delete the files of a path pattern."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.globStatus(at) or []:
        fs.delete(st.getPath(), False)
