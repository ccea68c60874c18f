"""Value matching and profiling over catalog columns.

``entity_match`` finds, for every distinct mention, the nearest dictionary
value within an edit distance ``max_dist`` without a cross join: candidate
pairs come from an equi-join on exact segments (pigeonhole partition filter:
if two strings are within ``d`` edits, one of ``d + 1`` segments of the
dictionary string occurs unchanged in the mention, at most ``d`` positions
away). Every true match is a candidate, so the result equals brute force.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.partitioning import sized_broadcast
from quarry.sources.tables import write_scratch


def normalise(c: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", ""))


def entity_dictionary(catalog: DataFrame, cols: list[str]) -> DataFrame:
    """V1: (column_name, value, n) for the given columns; partial aggregation per (column, value)."""
    long = catalog.select(*[F.col(c).cast("string") for c in cols]).unpivot([], list(cols), "column_name", "value")
    return long.filter(F.col("value").isNotNull()).groupBy("column_name", "value") \
        .agg(F.count(F.lit(1)).alias("n"))


def _segments(length: Column, i: Column, d: int) -> tuple[Column, Column]:
    start = F.floor(i * length / (d + 1)).cast("int")
    end = F.floor((i + 1) * length / (d + 1)).cast("int")
    return start, end - start


def _range(lo: Column, hi: Column) -> Column:
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def entity_match(mentions: DataFrame, mention_col: str, dictionary: DataFrame, value_col: str,
                 max_dist: int = 2) -> DataFrame:
    """V2: (mention, value, distance) for every distinct mention; value NULL when nothing is within max_dist."""
    d = max_dist
    # The distinct mentions feed three branches and the distinct values two: each set is
    # deduplicated (one shuffle) and written once, instead of once per branch.
    m = write_scratch(
        mentions.select(F.col(mention_col).alias("mention")).filter(F.col("mention").isNotNull()).distinct()
        .withColumn("mn", normalise(F.col("mention"))).withColumn("ml", F.length("mn")), "entity-mentions")
    dic = write_scratch(
        dictionary.select(F.col(value_col).alias("value")).filter(F.col("value").isNotNull()).distinct()
        .withColumn("dn", normalise(F.col("value"))).withColumn("dl", F.length("dn")), "entity-values")

    # Dictionary segments (only strings long enough to have d + 1 non-empty segments).
    seg = dic.filter(F.col("dl") > d).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(d))))
    s_start, s_len = _segments(F.col("dl"), F.col("i"), d)
    seg = seg.select("value", "dn", "dl", "i", F.substring("dn", s_start + 1, s_len).alias("key"))

    # Mention probes: for each dictionary length L within +-d and segment i, substrings near the segment start.
    pr = m.withColumn("L", F.explode(_range(F.greatest(F.col("ml") - d, F.lit(d + 1)), F.col("ml") + d))) \
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(d))))
    p_start, p_len = _segments(F.col("L"), F.col("i"), d)
    pr = pr.withColumn("__s", p_start).withColumn("__l", p_len)
    pr = pr.withColumn("p", F.explode(_range(F.greatest(F.col("__s") - d, F.lit(0)),
                                             F.least(F.col("__s") + d, F.col("ml") - F.col("__l")))))
    pr = pr.select("mention", "mn", F.col("L").alias("dl"), "i",
                   F.substring("mn", F.col("p") + 1, F.col("__l")).alias("key"))
    long_cands = pr.join(seg, on=["dl", "i", "key"], how="inner").select("mention", "mn", "value", "dn")

    # Short dictionary strings (length <= d): two strings within distance d meet in a string that d deletions make of each.
    short = dic.filter(F.col("dl") <= d)
    keys = short.select("value", "dn", F.explode(_deletions(F.col("dn"), d)).alias("key"))
    short_cands = m.filter(F.col("ml") <= 2 * d).select("mention", "mn", F.explode(_deletions(F.col("mn"), d)).alias("key")) \
        .join(keys, on="key", how="inner").select("mention", "mn", "value", "dn")
    # If they meet in the empty string only, they share no character and the distance is the greater length. The least
    # value of each length stands for all: those that share a character are found above with their own distance.
    least = short.groupBy("dl").agg(F.min("value").alias("value"))  # d + 1 rows at most
    apart = m.filter(F.col("ml") <= d).withColumn("dl", F.explode(F.sequence(F.lit(0), F.lit(d)))).join(F.broadcast(least), "dl") \
        .select("mention", "value", F.greatest("ml", "dl").alias("distance"))

    scored = long_cands.unionByName(short_cands).withColumn("distance", F.levenshtein("mn", "dn", d)).filter(F.col("distance") >= 0)
    best = scored.select("mention", "value", "distance").unionByName(apart).groupBy("mention").agg(
        F.min_by(F.struct("value", "distance"), F.struct("distance", "value")).alias("b"))
    return m.select("mention").join(best, "mention", "left") \
        .select("mention", F.col("b.value").alias("value"), F.col("b.distance").cast("int").alias("distance"))


def _deletions(s: Column, d: int) -> Column:
    """The non-empty strings that up to ``d`` deletions make of a short string, itself included."""
    def shorter(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substr(w, i + 1)))

    level = out = F.filter(F.array(s), lambda w: w != "")
    for _ in range(d):
        level = F.filter(F.array_distinct(F.flatten(F.transform(level, shorter))), lambda w: w != "")
        out = F.array_union(out, level)
    return out


def format_profile(catalog: DataFrame, cols: list[str], samples: int = 3) -> DataFrame:
    """V3: per column null count, exact distinct count, min, max and the ``samples`` smallest values (as text).

    One wide aggregate for nulls/min/max; distinct counts and samples come from the
    deduplicated (column, value) pairs, whose per-column top-k is a WindowGroupLimit.
    """
    wide = catalog.agg(*[x for c in cols for x in (
        F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__nulls"),
        F.min(c).cast("string").alias(f"{c}__min"),
        F.max(c).cast("string").alias(f"{c}__max"))])
    stats = wide.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"{c}__nulls").cast("bigint").alias("null_count"),
        F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value")) for c in cols])).alias("s")
    ).select("s.*")
    pairs = catalog.select(*[F.col(c).cast("string") for c in cols]).unpivot([], list(cols), "column_name", "value") \
        .filter(F.col("value").isNotNull()).distinct()
    distinct = pairs.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
    w = Window.partitionBy("column_name").orderBy("value")
    smp = pairs.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= samples) \
        .groupBy("column_name").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("rn", "value"))), lambda s: s["value"]), ", ").alias("sample_values"))
    return stats.join(distinct, "column_name", "left").join(smp, "column_name", "left") \
        .select("column_name", "null_count", F.coalesce("distinct_count", F.lit(0)).cast("bigint").alias(
            "distinct_count"), "min_value", "max_value", "sample_values")


def in_dictionary(df: DataFrame, col: str, dictionary: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Semi (known) / anti (unknown) join to a dictionary (case-insensitive).

    The dictionary is broadcast only behind a row-count check; a large one gets a shuffle join.
    """
    dk = sized_broadcast(dictionary.select(F.lower(F.col(key)).alias("__k")).distinct())
    return df.join(dk, F.lower(F.col(col)) == F.col("__k"), how)
