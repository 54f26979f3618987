"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is a few joins and aggregates with map-side partial minima; no
neighbour list is ever collected in one task, and a round's edges are written
to the checkpoint folder, so neither lineage nor driver grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import scratch_path


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): each node that has an edge and the smallest node it can reach.

    Nodes are longs; loops and repeated edges are harmless.
    """
    spark = edges.sparkSession

    def stored(e: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "star")
        e.write.parquet(path)
        out = spark.read.schema("u long, v long").parquet(path)
        return out, tuple(out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    # Each edge once, from the larger to the smaller node.
    now, mark = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct())
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        now, after = stored(small)
        if after == mark:
            break
        mark = after
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))
