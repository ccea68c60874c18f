"""Near-duplicate documents: min-max hashing, banding, exact confirmation, components.

1. One scan gives per document the size and a digest of its set of word
   shingles and the bucket keys of its min-max signature (``shingles.MinMax``).
   Equal sets are one class from here on; only the smallest id of a class, its
   representative, goes further, so a group of exact copies of any size is one
   row.
2. Per bucket every representative is paired with the bucket's smallest id:
   pairs are at most representatives x bands, whatever a bucket's size.
3. Candidates' full sets are built once more from their texts and each pair is
   confirmed on them (hashes of 64 bits). Confirmed links give components.
4. A bucket whose members lie in one component is settled. In the others, the
   members outside the bucket's largest component are paired with all members
   of other components and confirmed, so no pair that shares a bucket is left
   untested unless it is connected already. A sketch of each set (one bit per
   cell of its hashes) bounds the shared part from above, so the join itself
   leaves out pairs that cannot reach the threshold. While many pairs would
   have to be compared, further rounds take another member of the largest
   component only; they end when a round finds no link.

A pair at the threshold of 0.85 shares one of 52 bands of 10 values but for 1 in
100 000, and one of similarity 0.65 shares a given band in 1 of 75 cases. Defined results: null or blank text has an empty set, is linked
with nothing and is its own component; texts with fewer words than a shingle
have their whole sequence as one shingle; a null id takes the component of its
class (null if it has none) and is kept only then; rows that repeat an id are
judged by their own text; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import col, fresh, write_scratch
from quarry.llm.components import connected_components, merge_components
from quarry.llm.shingles import MinMax, cells, digest, shingle_sets

SPREAD = 32  # comparisons per bucket member that one round may make
CELLS = 8  # sketch size in 64-bit words
SLICE = 4096  # members of a bucket that one task compares with as many others


def _versions(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(col(text_col), F.lit(""))
    return docs.select(col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))


def signatures(rows: DataFrame, size: int, perms: int, band_rows: int) -> DataFrame:
    """(id, version, n, digest, keys) per row of (id, version, text); keys are empty for an empty set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = MinMax(perms, band_rows)
        for batch in batches:
            n, digests, keys = [], [], []
            for grams in shingle_sets(batch.column(2), size):
                n.append(len(grams))
                digests.append(digest(grams))
                keys.append(sketch.keys(grams) if len(grams) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                                              pa.array(keys, pa.list_(pa.int64()))], names=["id", "version", "n", "digest", "keys"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("keys", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(run, schema)


def full_sets(rows: DataFrame, size: int) -> DataFrame:
    """(id, grams, sketch) per row of (id, version, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(2), size))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g.view("int64") for g in sets], pa.list_(pa.int64())),
                 pa.array([cells(g, CELLS) for g in sets], pa.list_(pa.int64()))], names=["id", "grams", "sketch"])

    longs = T.ArrayType(T.LongType())
    return rows.mapInArrow(run, T.StructType([rows.schema.fields[0], T.StructField("grams", longs), T.StructField("sketch", longs)]))


def may_link(n: Column, m: Column, a: list[Column], b: list[Column], percent: int) -> Column:
    """False only if sets of n and m grams with sketches a and b cannot share ``percent`` of their union.

    A cell that only one set fills holds at least one gram that the other lacks.
    """
    only_a = sum((F.bit_count(x.bitwiseAND(F.bitwise_not(y))) for x, y in zip(a, b, strict=True)), F.lit(0))
    only_b = sum((F.bit_count(y.bitwiseAND(F.bitwise_not(x))) for x, y in zip(a, b, strict=True)), F.lit(0))
    most = F.least(n - only_a, m - only_b)
    return 100 * most >= percent * (n + m - most)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets share at least ``percent`` of their union."""
    left = pairs.join(sets.select(F.col("id").alias("b"), F.col("grams").alias("g_b")), "b")
    both = left.join(sets.select(F.col("id").alias("a"), F.col("grams").alias("g_a")), "a")
    shared = both.select("a", "b", F.size(F.array_intersect("g_a", "g_b")).cast("long").alias("s"),
                         (F.size("g_a") + F.size("g_b")).cast("long").alias("t"))
    return shared.filter(100 * F.col("s") >= percent * (F.col("t") - F.col("s"))).select("a", "b")


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` (key, id, ...) of buckets that hold more than one component, with comp, main, total and top."""
    own = members.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    by_comp = own.groupBy("key", "comp").agg(F.count("*").alias("c"))
    by_key = by_comp.groupBy("key").agg(F.count("*").alias("comps"), F.sum("c").alias("total"), F.max("c").alias("top"),
                                        F.max_by("comp", F.struct("c", "comp")).alias("main")).filter("comps > 1")
    return own.join(write_scratch(by_key.drop("comps"), "open-buckets"), "key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85, size: int = 5,
                    perms: int = 260, band_rows: int = 10) -> DataFrame:
    """(id, version, n_shingles, component_id, kept) per row; version is xxhash64 of the text."""
    rows = _versions(docs, id_col, text_col)
    sig = write_scratch(signatures(rows, size, perms, band_rows), "signatures")
    classes = write_scratch(
        sig.filter("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min(F.struct("id", "version", "n", "keys")).alias("r"))
        .select("digest", "r.*"), "classes")
    buckets = classes.select(F.explode("keys").alias("key"), "id", "n")
    shared = write_scratch(buckets.groupBy("key").agg(F.count("*").alias("c"), F.min("id").alias("a")).filter("c > 1").drop("c"), "buckets")
    members = write_scratch(buckets.join(shared, "key"), "members")

    pairs = write_scratch(members.filter("a <> id").groupBy("a", F.col("id").alias("b")).agg(F.lit(1).alias("one")).select("a", "b"), "pairs")
    wanted = classes.select("id", "version").join(members.select("id").distinct(), "id")
    sets = write_scratch(full_sets(rows.join(wanted, ["id", "version"], "left_semi").dropDuplicates(["id", "version"]), size), "sets")
    links = write_scratch(confirm(pairs, sets, percent), "links")
    labels = connected_components(links)

    bits = [f"s{k}" for k in range(CELLS)]
    sketches = sets.select("id", *[F.col("sketch")[k].alias(c) for k, c in enumerate(bits)])
    size_of_all = members.count()
    # Later rounds can only settle buckets, so the sketches are joined once.
    left = still = write_scratch(_open_buckets(members.select("key", "id", "n"), labels).join(sketches, "id"), "open")
    tested, turn = pairs, 0
    while True:
        turn += 1
        if turn > 1:
            left = write_scratch(_open_buckets(still.drop("comp", "main", "total", "top"), labels), "open")
        bound = left.agg(F.count("*"), F.sum(F.when(F.col("comp") != F.col("main"), F.col("total")).otherwise(0))).collect()[0]
        if not bound[0]:
            break
        everything = bound[1] <= SPREAD * size_of_all or turn > 1 and not found
        outer_columns = ["key", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"), *[F.col(c).alias(f"x{c}") for c in bits]]
        outer = left.filter("comp <> main").select(*outer_columns)
        inner = left.select("key", "id", "n", "comp", "main", *bits)
        on = ["key"]
        if everything:
            # A member lies in one slice of its bucket and meets all slices of the other side.
            slices = F.ceil(F.col("total") / SLICE).cast("int")
            every = F.explode(F.sequence(F.lit(0), slices - 1))
            outer = left.filter("comp <> main").select(*outer_columns, F.pmod(F.xxhash64("id"), slices).cast("int").alias("x_slice"), every.alias("slice"))
            inner = left.select(*inner.columns, F.pmod(F.xxhash64("id"), slices).cast("int").alias("slice"), every.alias("x_slice"))
            on = ["key", "x_slice", "slice"]
        else:
            order = F.xxhash64(F.lit(turn), "id")
            one = inner.filter("comp = main").groupBy("key").agg(F.min(F.struct(order.alias("o"), "id", "n", "comp", "main", *bits)).alias("m"))
            inner = write_scratch(one.select("key", "m.*").drop("o"), "inner")
        near = may_link(F.col("n"), F.col("nx"), [F.col(c) for c in bits], [F.col(f"x{c}") for c in bits], percent)
        new = outer.join(inner, on) \
            .filter((F.col("comp") != F.col("cx")) & ((F.col("comp") == F.col("main")) | (F.col("x") < F.col("id"))) & near) \
            .groupBy(F.least("x", "id").alias("a"), F.greatest("x", "id").alias("b")).agg(F.lit(1).alias("one")).select("a", "b")
        new = write_scratch(new.join(tested, ["a", "b"], "left_anti"), "pairs")
        more = write_scratch(confirm(new, sets, percent), "links")
        found = bool(more.take(1))
        if found:
            labels = merge_components(labels, more)
        if everything:
            break
        tested = tested.union(new)

    parts = write_scratch(classes.select("digest", "id").join(labels, "id", "left")
                          .select("digest", F.coalesce("comp", "id").alias("comp")), "parts")
    out = sig.select("id", "version", "n", "digest").join(parts, "digest", "left")
    comp = F.when(F.col("n") > 0, F.col("comp")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "version", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("id") == comp, comp.isNull()).alias("kept"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are the kept document of their component, with their own columns."""
    found = near_duplicates(docs, id_col, text_col, **options).filter("kept")
    version, key, of = fresh(docs, "n_version", "n_id", "n_of")
    left = docs.withColumn(version, F.xxhash64(F.coalesce(col(text_col), F.lit(""))))
    right = found.select(col(id_col).alias(key), F.col("version").alias(of))
    return left.join(right, col(id_col).eqNullSafe(col(key)) & (col(version) == col(of)), "left_semi").select(*[col(c) for c in docs.columns])
