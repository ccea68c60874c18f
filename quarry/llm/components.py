"""Connected components of an edge table by hooking and pointer jumping.

Every round takes, for each node, the smallest label among its neighbours, hands
that label to the node itself and to the node's present root (so whole trees
join at once and a chain of any length needs a logarithmic number of rounds),
and then takes the label of the label. The label table is written to the shared
scratch folder each round, which cuts the lineage. Hubs and hot roots are
pre-aggregated by the map-side minimum, and the joins have plain exchanges that
AQE can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import write_scratch


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every node of ``edges`` (a, b); comp is the smallest id reachable. No edges: no rows."""
    both = write_scratch(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b"), "edges")
    labels = write_scratch(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "comp"), "b").groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("seen"))
        # One offer to the node (with its present label) and one to its present root.
        offers = F.array(F.struct("id", F.least("comp", "seen").alias("comp"), F.col("comp").alias("was")),
                         F.struct(F.col("comp").alias("id"), F.col("seen").alias("comp"), F.lit(None).cast(labels.schema["comp"].dataType).alias("was")))
        lower = write_scratch(labels.join(near, "id").select(F.inline(offers)).groupBy("id")
                              .agg(F.min("comp").alias("comp"), F.max("was").alias("was")), "labels")
        to = lower.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        labels = write_scratch(lower.join(to, "comp").select("id", F.col("next").alias("comp"), "was"), "labels")
        moved = labels.filter(F.col("comp") != F.col("was")).take(1)
        labels = labels.select("id", "comp")
        if not moved:
            return labels


def merge_components(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The components after ``edges`` (a, b) are added to those of ``labels`` (id, comp).

    Only the graph of the touched components is walked; nodes new to ``labels``
    start as their own component.
    """
    def of(side: str) -> DataFrame:
        return labels.select(F.col("id").alias(side), F.col("comp").alias(f"c{side}"))

    met = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    roots = connected_components(met.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    moved = labels.join(roots.select(F.col("id").alias("comp"), F.col("comp").alias("next")), "comp", "left") \
        .select("id", F.coalesce("next", "comp").alias("comp"))
    return write_scratch(moved.union(roots.join(labels, "id", "left_anti").select("id", "comp")), "labels")
