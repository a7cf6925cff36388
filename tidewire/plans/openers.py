"""Time-window de-duplication of groups that are too large for one task.

In each group the first time is accepted, then the first one at least a window later, and so on: every time has one
successor, and wanted is the path from the first. Following it step by step would be sequential; so it is followed in
strides that double.

Time is cut into blocks of 1, 2, 4, ... windows, counted from the group's first time. A path enters a block within its
first window, or at its first time if there is none that early. Only those entries are kept per block size, about half
as many for each doubling, with the time at which the path leaves the block:

* blocks of one window: leaving is the successor, found by a running minimum within bounded slices;
* twice the size: an exit that lands in the block's second half is followed by one more exit, an equi-join;
* when one block covers everything the path's start is known, and the same tables, read from large to small, fill in
  the stops between.

Every step is a join or aggregation on (group, time), so even a single group spreads over all tasks. The number of steps
grows with the logarithm of span / window. Each table is written to the shared folder, which ends its lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_folder
from .ordering import dealt_by_range

KEY = ["_group", "_us"]


def accepted_times(hot: DataFrame, rows_per_slice: int, window_us: int) -> DataFrame:
    """(``_group``, ``_us``) of every accepted message."""
    spark = hot.sparkSession
    folder = new_run_folder(spark, "openers")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    times = written(hot.select(*KEY).distinct(), "times")
    # one row per hot group
    starts = written(times.groupBy("_group").agg(F.min("_us").alias("_start"), F.max("_us").alias("_end")), "starts")
    longest = starts.agg(F.max(F.expr("_end - _start"))).head()[0] or 0

    successors = _successors(times, rows_per_slice, window_us).join(starts.drop("_end"), ["_group"])
    levels = [written(successors, "level-0")]
    while (window_us << len(levels)) <= longest:
        levels.append(written(_doubled(levels[-1], window_us << (len(levels) - 1)), f"level-{len(levels)}"))

    path = starts.select("_group", F.col("_start").alias("_us"))
    for i in reversed(range(len(levels))):
        block = _block(window_us << (i + 1))
        stops = levels[i].join(path, KEY, "left_semi")
        between = stops.where(block(F.col("_exit")) == block(F.col("_us"))).select("_group", F.col("_exit").alias("_us"))
        path = written(path.unionByName(between), f"path-{i}")
    return path


def _block(size_us: int):
    """Number of the block a time is in. Whole-number arithmetic: a quotient of doubles could round across an edge."""

    def number(us: Column) -> Column:
        offset = us - F.col("_start")
        return ((offset - F.pmod(offset, F.lit(size_us))) / F.lit(size_us)).cast("bigint")

    return number


def _successors(times: DataFrame, rows_per_slice: int, window_us: int) -> DataFrame:
    """(group, time, ``_exit``): the first time that is at least a window later, or null."""
    nothing, us = F.lit(None).cast("bigint"), F.col("_us")
    known = times.select("_group", us.alias("_x"), us.alias("_known"), nothing.alias("_us"))
    asked = times.select("_group", (us + window_us).alias("_x"), nothing.alias("_known"), "_us")
    points = known.unionByName(asked)
    points = dealt_by_range(points, ["_group"], ["_x", "_known", "_us"], rows_per_slice, 2 * times.count())
    points = points.withColumn("_group", F.col("_group._group"))
    # downwards from the latest: the smallest time seen so far, a known one before an equal asked one
    down = Window.partitionBy("_group", "_slice").orderBy(F.col("_x").desc(), F.col("_known").asc_nulls_last())
    placed = points.withColumn("_here", F.min("_known").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    firsts = points.groupBy("_group", "_slice").agg(F.min("_known").alias("_first"))
    later = Window.partitionBy("_group").orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    following = firsts.select("_group", "_slice", F.min("_first").over(later).alias("_later"))
    found = placed.where(F.col("_us").isNotNull()).join(following, ["_group", "_slice"])
    return found.select(*KEY, F.coalesce("_here", "_later").alias("_exit"))


def _doubled(level: DataFrame, size_us: int) -> DataFrame:
    """The entries of blocks twice as long as ``size_us``, and where the path leaves those."""
    half = _block(size_us)(F.col("_us"))
    entries = level.withColumn("_half", half)
    # in a second half only its first time can be where a path enters the whole block
    firsts = entries.where(F.col("_half") % 2 == 1).groupBy("_group", "_half").agg(F.min("_us").alias("_us"))
    kept = entries.where(F.col("_half") % 2 == 0).drop("_half").unionByName(
        entries.join(firsts, ["_group", "_half", "_us"], "left_semi").select(*level.columns)
    )
    onward = level.select("_group", F.col("_us").alias("_exit"), F.col("_exit").alias("_onward"), F.lit(True).alias("_met"))
    joined = kept.join(onward, ["_group", "_exit"], "left")
    block = _block(size_us * 2)
    inside = F.col("_met") & (block(F.col("_exit")) == block(F.col("_us")))
    exit_ = F.when(inside, F.col("_onward")).otherwise(F.col("_exit"))
    return joined.select("_group", "_us", exit_.alias("_exit"), "_start")
