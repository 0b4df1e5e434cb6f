"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesmith.session import fresh_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for the nodes of ``edges(a, b)``; a component is named by its smallest node.

    Each step is a partial aggregate and a join on the node, written to the
    shared folder before the next one reads it, so a lost executor costs one
    step.  The number of steps grows with the logarithm of the node count, not
    with a chain's length.  An empty edge table gives an empty result.
    """
    spark = edges.sparkSession
    path = fresh_dir(spark, "components")

    def settle(e: DataFrame, step: str) -> tuple[DataFrame, tuple]:
        e.write.parquet(f"{path}/{step}")
        e = spark.read.parquet(f"{path}/{step}")
        return e, tuple(e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first())

    oriented = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    e, state = settle(oriented, "0")
    step = 0
    while True:
        step += 1
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, _ = settle(large, f"{step}a")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        )
        e, now = settle(small, f"{step}b")
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
