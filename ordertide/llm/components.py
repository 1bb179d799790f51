"""Connected components of a link table, by alternating large and small stars."""

from pyspark.sql import functions as F

from ordertide.llm.shared import saved


def components(links):
    """node and root (the smallest node reachable) for every node of ``links`` (a, b).

    Each step halves what is left of long paths; every node's links are reduced to its minimum
    by partial aggregation, and joins on a busy node are plain joins that can be split. Null
    ends and loops are ignored; without links the result is empty.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(high.alias("u"), low.alias("v"))
    edges = saved(edges.distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = state
