"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join, written to the shared folder, so
no group, link or label passes through the driver and a lost executor costs
one step. The number of steps grows with the logarithm of the graph's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..workspace import delete_path, scratch_path


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    out = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.unionByName(low.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` of every node of ``edges(u, v)``; component is its smallest reachable node.

    Self loops and null ends are ignored; repeated and mirrored edges are
    fine. Each step's table replaces the one before it.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, at = written(e)
    digest = None
    while True:
        nxt, path = written(_small(_large(e).distinct()).distinct())
        row = tuple(nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        delete_path(spark, at)
        if row == digest:
            break
        digest, e, at = row, nxt, path
    done = nxt.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return done.unionByName(nxt.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
