"""Counters, gauges and timers: summaries of recorded samples."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def component_metrics(samples: DataFrame, order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Summary per metric from ``(name, kind, value, <order>)`` samples.

    A counter is the sum of its increments, a gauge its last value, a timer the count, sum, minimum, maximum and
    average of its durations. Columns that do not apply to a kind are null.
    """
    value, kind = F.col("value"), F.col("kind")
    of_gauge, of_timer = kind == "gauge", kind == "timer"
    # with a single order column both stay plain values, which Spark aggregates in its hash table
    if len(order) == 1:
        last = F.max_by(value, F.when(of_gauge, F.col(order[0])))
    else:
        last = F.max(F.when(of_gauge, F.struct(*order, "value")))["value"]
    timed = F.when(of_timer, value)
    return samples.groupBy("name", "kind").agg(
        F.sum(F.when(kind == "counter", value)).alias("counter"),
        F.when(kind == "gauge", last).alias("gauge"),
        F.count(timed).alias("timer_count"),
        F.sum(timed).alias("timer_sum"),
        F.min(timed).alias("timer_min"),
        F.max(timed).alias("timer_max"),
        F.avg(timed).alias("timer_avg"),
    )


def observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, Observation | str]:
    """Record aggregates of the rows that pass through, without a pass of their own.

    The observation's values are there once an action on the returned frame has finished. A stream has values per micro-batch, read by
    the name with ``streaming.observed_progress``.
    """
    observation = name if df.isStreaming else Observation(name)
    return df.observe(observation, *[value.alias(key) for key, value in metrics.items()]), observation
