"""Sets of triggers: merging, de-duplication, order, expiry, batch limits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import DEFAULT_TRIGGER_BATCH
from ..plans.ordering import numbered

# Up to this rank Spark cuts each group before the shuffle (its default for this optimization).
EARLY_LIMIT = 1000


def merge_triggers(*inputs: DataFrame) -> DataFrame:
    """Several trigger inputs as one; fields an input lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), inputs)


def dedupe_triggers(df: DataFrame, with_etag: bool = False) -> DataFrame:
    """The earliest trigger per reference (per reference and etag): lowest time, then lowest id.

    Each task keeps one row per reference before the shuffle, so a hot reference stays small.
    """
    keys = ["reference", "etag"] if with_etag else ["reference"]
    earliest = Window.partitionBy(*keys).orderBy("ts", "trigger_id")
    return df.withColumn("_rank", F.row_number().over(earliest)).where("_rank = 1").drop("_rank")


def order_triggers(df: DataFrame, rank: str = "rank", rows_per_slice: int | None = None) -> DataFrame:
    """Triggers in time order (ties by id), with their global ``rank``."""
    return numbered(df, [], ["ts", "trigger_id"], rank, rows_per_slice=rows_per_slice).orderBy(rank)


def expire_triggers(df: DataFrame, now: Column, ttl_s: int, ts: str = "ts") -> DataFrame:
    """Drop triggers older than ``ttl_s`` seconds before ``now``; one that is exactly as old stays."""
    return df.where(F.col(ts) >= now - F.expr(f"interval {int(ttl_s)} seconds"))


def limit_batch(df: DataFrame, n: int = DEFAULT_TRIGGER_BATCH, cap: int | None = None, by: str = "source") -> DataFrame:
    """At most ``n`` triggers per input and read, earliest first.

    ``n <= 0`` means the default of 10. ``cap`` is a queue's own limit: outside 1..10 it counts as 10, and never more
    than 10 are taken.
    """
    wanted = n if n > 0 else DEFAULT_TRIGGER_BATCH
    if cap is not None:
        allowed = cap if 0 < cap <= DEFAULT_TRIGGER_BATCH else DEFAULT_TRIGGER_BATCH
        wanted = min(wanted, allowed, DEFAULT_TRIGGER_BATCH)
    if wanted > EARLY_LIMIT:
        ranked = numbered(df, [by], ["ts", "trigger_id"], "_rank")
    else:
        earliest = Window.partitionBy(by).orderBy("ts", "trigger_id")
        ranked = df.withColumn("_rank", F.row_number().over(earliest))
    return ranked.where(F.col("_rank") <= wanted).drop("_rank")
