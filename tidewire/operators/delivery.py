"""Batches, acknowledgement, redelivery and consumer positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import duration_us
from ..model import DEFAULT_BATCH_WAIT_MS
from ..plans.greedy import assign_greedy, first_per_window
from ..plans.joins import null_safe_join
from ..plans.ordering import numbered


def batch_by_count(
    df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, rows_per_slice: int | None = None
) -> DataFrame:
    """Batches of ``n`` in arrival order per channel (the last may be shorter); ``n <= 0`` means 1.

    Adds ``batch_no`` and ``batch_idx``, both from 0. ``order`` ends in a unique column.
    """
    size = n if n > 0 else 1
    placed = numbered(df, by, order, "_position", rows_per_slice=rows_per_slice)
    return placed.withColumns({
        "batch_no": F.expr(f"(_position - 1) div {size}"),
        "batch_idx": F.expr(f"(_position - 1) % {size}"),
    }).drop("_position")


def batch_by_count_or_time(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    ts: str,
    n: int,
    wait_ms: float | str = DEFAULT_BATCH_WAIT_MS,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """The first message opens a batch; the next ones join while it has fewer than ``n`` and they arrive less than
    ``wait_ms`` after it was opened. ``n <= 0`` means 1. The wait is in milliseconds or a text such as ``2s``; one that is
    not positive, or not a duration, counts as the default of 100 ms.

    Adds ``batch_no`` and ``batch_idx``, both from 0. A large channel is cut into slices that are worked out in
    parallel and then linked (``plans.greedy``), so it does not become one task.
    """
    return assign_greedy(df, by, order, ts, n if n > 0 else 1, batch_wait_us(wait_ms), rows_per_slice)


def batch_wait_us(wait_ms: float | str) -> int:
    try:
        wait = duration_us(wait_ms, "ms")
    except ValueError:
        wait = 0
    return wait if wait > 0 else DEFAULT_BATCH_WAIT_MS * 1000


def dedupe_by_message_id(
    df: DataFrame,
    id: str = "msg_id",
    ts: str = "ts",
    window_s: float | str | None = None,
    order: Sequence[str] = ("seq",),
    rows_per_slice: int | None = None,
) -> DataFrame:
    """First message per id within a time window.

    An accepted message blocks its id for ``window_s`` seconds (or a text such as ``2m``); what is dropped meanwhile does
    not extend that. ``None`` blocks forever, which needs one row per id and task only. A window that is not positive
    blocks nothing: every message is kept. A message without a time came before all others.
    """
    if window_s is None:
        first = Window.partitionBy(id).orderBy(ts, *order)
        return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")
    window_us = duration_us(window_s)
    return first_per_window(df, [id], order, ts, window_us, rows_per_slice) if window_us > 0 else df


def ack_outcome(df: DataFrame) -> DataFrame:
    """Add ``outcome``: ``ack``, ``redeliver`` or ``lost``.

    Reads ``transport`` (mqtt, mq, jetstream, nats, sqs) and the flags ``auto_ack``, ``context_ended``, ``connected``,
    ``failed``, ``closed`` (input closed with an open batch) and ``parsed``; a missing flag has its harmless value.
    """
    harmless = {
        "auto_ack": False, "context_ended": False, "connected": True, "failed": False, "closed": False, "parsed": True
    }
    flag = {
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in harmless.items()
    }
    over, failed = flag["context_ended"], flag["failed"]

    def choose(redeliver: Column, lost: Column) -> Column:
        return F.when(redeliver, F.lit("redeliver")).when(lost, F.lit("lost")).otherwise(F.lit("ack"))

    never = F.lit(False)
    by_transport = {
        "mqtt": choose(~flag["auto_ack"] & (over | failed | ~flag["connected"]), never),
        "mq": choose(over | failed | flag["closed"], never),
        "jetstream": choose(failed, never),
        "nats": choose(never, failed),
        "sqs": choose(~flag["parsed"], failed),
    }
    outcome = F.lit(None).cast("string")
    for transport, rule in by_transport.items():
        outcome = F.when(F.col("transport") == transport, rule).otherwise(outcome)
    return df.withColumn("outcome", outcome)


def pending_by_ack_policy(
    messages: DataFrame, acks: DataFrame, policy: str | None, consumer: str = "consumer", seq: str = "seq"
) -> DataFrame:
    """Messages that still wait for an acknowledgement.

    ``none``: nothing ever waits. ``all``: acknowledging n covers everything up to n. ``explicit`` (also when unset or
    unknown): every message on its own.
    """
    if policy == "none":
        return messages.where(F.lit(False))
    if policy == "all":
        covered = acks.groupBy(consumer).agg(F.max(seq).alias("_covered"))
        open_ = null_safe_join(messages, covered, [consumer], "left")
        return open_.where(F.col("_covered").isNull() | (F.col(seq) > F.col("_covered"))).drop("_covered")
    return null_safe_join(messages, acks.select(consumer, seq), [consumer, seq], "left_anti")


def redeliver(
    deliveries: DataFrame, now: Column, ack_wait_s: float | str, max_deliver: int = 0
) -> tuple[DataFrame, DataFrame]:
    """``(due, failed)`` from delivery attempts.

    A message with no acknowledged attempt becomes due again ``ack_wait_s`` (seconds, or a text such as ``1m30s``) after
    its last attempt, until it has been delivered ``max_deliver`` times; then it has failed. ``max_deliver <= 0`` never gives up. ``due`` carries the
    number of the next attempt. An attempt without an outcome is not acknowledged, one without a delivery time has waited long
    enough, and a null consumer or message is one like any other.
    """
    latest = deliveries.groupBy("consumer", "seq").agg(
        F.max("attempt").alias("attempt"),
        F.max_by("delivered_at", "attempt").alias("delivered_at"),
        F.coalesce(F.bool_or(F.col("outcome") == "ack"), F.lit(False)).alias("_acked"),
    )
    waited = F.col("delivered_at") + F.expr(f"interval {duration_us(ack_wait_s)} microseconds") <= now
    waited = F.col("delivered_at").isNull() | waited
    open_ = latest.where(~F.col("_acked") & waited).drop("_acked")
    if max_deliver <= 0:
        return open_.withColumn("attempt", F.col("attempt") + 1), open_.where(F.lit(False))
    exhausted = F.col("attempt") >= max_deliver
    return open_.where(~exhausted).withColumn("attempt", F.col("attempt") + 1), open_.where(exhausted)


def rollback_batch(deliveries: DataFrame, nacked: DataFrame, on: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Every message of a rejected batch again, at its old place, as the next attempt."""
    back = null_safe_join(deliveries, nacked.select(*on).distinct(), on, "left_semi")
    return back.withColumn("attempt", F.col("attempt") + 1)


def consumer_lag(
    df: DataFrame, stream: str = "stream", seq: str = "seq", rows_per_slice: int | None = None
) -> DataFrame:
    """Add ``delivered`` (messages of the stream up to and including this one) and ``pending`` (those after it)."""
    placed = numbered(df, [stream], [seq], "delivered", "_total", rows_per_slice)
    return placed.withColumn("pending", F.col("_total") - F.col("delivered")).drop("_total")


def resume_durable(
    messages: DataFrame, offsets: DataFrame, default_policy: str | None = None, consumer: str = "consumer",
    seq: str = "seq", ts: str = "ts",
) -> DataFrame:
    """What each consumer reads next.

    ``offsets`` has one row per consumer: ``durable``, ``acked_seq`` (null before the first acknowledgement) and
    ``created_at``. A durable consumer continues after ``acked_seq``; any other, or one that never acknowledged,
    starts by the policy: ``all``, ``last``, or ``new`` (the default). A consumer without a row gets nothing; a
    null consumer is one like any other.
    """
    known = offsets.select(consumer, F.col("durable").alias("_durable"), F.col("acked_seq").alias("_acked"),
                           F.col("created_at").alias("_created"))
    if default_policy == "last":
        newest = messages.groupBy(consumer).agg(F.max(seq).alias("_newest"))
        known = null_safe_join(known, newest, [consumer], "left")
        start = F.col(seq) == F.col("_newest")
    elif default_policy == "all":
        start = F.lit(True)
    else:
        start = F.col(ts) > F.col("_created")
    resumes = F.col("_durable") & F.col("_acked").isNotNull()
    wanted = F.when(resumes, F.col(seq) > F.col("_acked")).otherwise(start)
    return null_safe_join(messages, known, [consumer], "inner").where(wanted).select(*messages.columns)
