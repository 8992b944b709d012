"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmine.llm.common import settle


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root): each node of the edges ``a, b`` with the smallest node that it can reach.

    Alternating large-star and small-star rounds (Kiveris et al., 2014) until only stars are left.  Every
    round is aggregation and equi-joins over the edges and is written to the shared folder; nothing but
    counts comes to the driver.  An empty edge list gives an empty result.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = settle(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        now = settle(small.distinct(), name)
        n, leaves = now.agg(F.count("*"), F.countDistinct("u")).first()
        if n == leaves and not now.join(now.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
