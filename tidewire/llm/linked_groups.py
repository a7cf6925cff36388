"""Groups of linked nodes by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written below ``folder`` and read again: the plan starts anew, and a lost executor loses nothing."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("_m"))
    least = least.select("a", F.least("a", "_m").alias("_m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("_m"))
    others = down.join(least, "a").where("b <> _m").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    return others.union(least.select("a", F.col("_m").alias("b"))).distinct()


def group_roots(edges: DataFrame, folder: str) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b) but the roots; the root is the component's smallest node.

    Stars with a hot centre are joined on the centre, where adaptive execution splits them; minima are pre-aggregated.
    """
    edges = edges.where("a <> b")
    step, before = 0, None
    while True:
        edges = stored(_small_star(_large_star(edges)), folder, f"stars-{step}")
        state = edges.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, step = state, step + 1


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
