"""Positions inside ordered groups, without ever putting a large group into one task.

A plain ``row_number() over (partition by channel order by ts)`` sends a whole channel to one task. Where a group is too large for
that, all rows are dealt out by range instead: Spark samples the group and *all* order columns together and cuts where rows are, so a
million rows with one time are cut too. Each range is sorted and written with a running number; a range's rows of one group are a slice.
Positions are the running number, shifted by the counts of the group's earlier slices. What is written is read from then on, so
every pass, and every retried task, agrees on it. Rows are shuffled once, whole; where they are wide and have a key, number the
keys and join them back (``sources.objects.page_objects``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_folder

ROWS_PER_SLICE = 1_000_000
LEAST_PER_SLICE = 50_000  # a window does as well
RUN_BITS = 33  # monotonically_increasing_id: the task above, the row in it below


def slice_of(key: Column, bounds: Sequence) -> Column:
    """How many split points are <= key: a binary search over a literal array."""
    if not bounds:
        return F.lit(0)
    points = F.lit(list(bounds))
    steps = F.lit([1 << i for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(points, at + step - 1) <= key, at + step).otherwise(at)
    )


def group_of(by: Sequence[str]) -> Column:
    """A struct is never null itself, so a null channel is a group like any other, in windows and joins."""
    return F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0))


def flag_hot(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame | None:
    """``df`` with ``_group`` and ``_hot``: whether the group has more than ``rows`` rows; ``None`` if none has.

    The names of the hot ones stay a table. It is written, so that its size is known: Spark sends it to the tasks if it is
    small, and shuffles it if not.
    """
    spark = df.sparkSession
    folder = new_run_folder(spark, "hot")
    counts = df.groupBy(group_of(by).alias("_group")).agg(F.count(F.lit(1)).alias("_rows"))
    counts.where(F.col("_rows") > rows).select("_group", F.lit(True).alias("_hot")).write.parquet(folder)
    hot = spark.read.parquet(folder)
    if not hot.head(1):
        return None
    flagged = df.withColumn("_group", group_of(by)).join(hot, ["_group"], "left")
    return flagged.withColumn("_hot", F.col("_hot").isNotNull())


def dealt_by_range(df: DataFrame, by: Sequence[str], order: Sequence[str], rows_per_slice: int, rows: int) -> DataFrame:
    """``df``, written in the order of ``by`` and ``order``, with ``_group``, ``_slice`` (ascending within a group) and ``_run`` (ascending
    within a slice, without gaps).

    Two levels: ranges of at most about ``ROWS_PER_SLICE`` rows, as many as the session has shuffle partitions or more, are tasks and
    files; within a range every ``rows_per_slice`` rows are a slice.
    """
    spark = df.sparkSession
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(math.ceil(rows / rows_per_slice), max(parallel, math.ceil(rows / ROWS_PER_SLICE))) or 1
    folder = new_run_folder(spark, "ranges")
    keys = [*by, *order]
    dealt = df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt.withColumn("_at", F.monotonically_increasing_id()).write.parquet(folder)
    at, run = F.col("_at"), F.col("_at").bitwiseAND(F.lit((1 << RUN_BITS) - 1))
    place = F.expr(f"(_at & {(1 << RUN_BITS) - 1}L) div {int(rows_per_slice)}")
    return spark.read.parquet(folder).withColumns({
        "_group": group_of(by), "_slice": (at - run) + place, "_run": run,
    }).drop("_at")


def sliced(df: DataFrame, by: Sequence[str], order: Sequence[str], rows_per_slice: int | None = None) -> DataFrame | None:
    """``dealt_by_range`` if some group has more rows than a slice, else ``None``: then a window by group will do.

    A slice is a shuffle partition's share of all rows, within ``LEAST_PER_SLICE`` and ``ROWS_PER_SLICE``, or ``rows_per_slice``.
    """
    largest, rows = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows"), F.sum("_rows")).first()
    share = (rows or 0) // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_slice = rows_per_slice or min(max(share, LEAST_PER_SLICE), ROWS_PER_SLICE)
    if not largest or largest <= per_slice:
        return None
    return dealt_by_range(df, by, order, per_slice, rows)


def slice_table(rows: DataFrame) -> DataFrame:
    """One row per (group, slice) of ``dealt_by_range``: ``_first`` (its first ``_run``), ``_rows``, ``_before`` (rows of the group in earlier
    slices), ``_total`` (rows of the group), ``_number`` (from 0) and ``_slices`` of the group."""
    counts = rows.groupBy("_group", "_slice").agg(F.min("_run").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("_group")  # as many rows as the group has slices
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns({
        "_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_total": F.sum("_rows").over(group),
        "_number": (F.row_number().over(group.orderBy("_slice")) - 1).cast("bigint"), "_slices": F.count(F.lit(1)).over(group),
    })


def numbered(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    position: str = "position",
    total: str | None = None,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row within its group, and optionally the group's row count.

    ``order`` should be unique within a group: rows that agree in all of it are numbered in any order, and stay together.
    """
    rows = sliced(df, by, order, rows_per_slice)
    if rows is None:
        within = Window.partitionBy(*by)
        out = df.withColumn(position, F.row_number().over(within.orderBy(*order)).cast("bigint"))
        return out.withColumn(total, F.count(F.lit(1)).over(within)) if total else out
    placed = rows.join(slice_table(rows).select("_group", "_slice", "_first", "_before", "_total"), ["_group", "_slice"])
    out = placed.withColumn(position, F.col("_run") - F.col("_first") + F.col("_before") + 1)
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.select(*df.columns, position, *([total] if total else []))
