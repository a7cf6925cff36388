"""Streams whose rule runs along each group, on Spark's keyed state with timers.

What is still open is Spark's state: one value per key, kept with the query's checkpoint and written where it changes. Timers let a
batch close or a message come back when its time is up, also when its channel is quiet. ``clock="event"`` takes time from the
newest message of all channels (the watermark, one micro-batch later; the last one follows without input); ``"processing"`` takes
it from the wall clock, which needs no traffic at all under a running trigger.

Messages are expected in time order from one micro-batch to the next; late ones are not thrown away but held against what is
still open. A key's messages of one micro-batch are put in order in one task, so the size of a micro-batch (``max_files``) bounds
what a hot channel brings to it. Times count in whole milliseconds, rounded up.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.time import duration_us, micros
from ..operators.delivery import batch_wait_us
from ..plans.greedy import arrival
from .flow import stream_sink

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BLOCK = 512


def _keyed(
    df: DataFrame, keys: Mapping, times: str, processor: StatefulProcessor, schema: T.StructType, clock: str
) -> DataFrame:
    """``processor`` over ``df`` grouped by ``keys`` (name -> column); the watermark follows the column ``times`` without delay."""
    if clock not in ("event", "processing"):
        raise ValueError("clock is event or processing")
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    rows = df.withColumns({**keys, "_event": F.col(times).cast("timestamp")})
    if clock == "event":
        rows = rows.withWatermark("_event", "0 seconds")
    # without the watermarked column nothing is dropped for being late
    grouped = rows.drop("_event").groupBy(*keys)
    return grouped.transformWithState(processor, schema, "append", f"{clock}time")


def _ms(us: int) -> int:
    """The millisecond by which a time has come."""
    return -(-us // 1000)


def _reached(clock: str, timers: Any) -> int:
    ms = timers.getCurrentWatermarkInMs() if clock == "event" else timers.getCurrentProcessingTimeInMs()
    return ms * 1000


def _place(order: Sequence[str]):
    """Sort key of a message: its time, then ``order``, nulls first."""
    return lambda row: (row["_us"], *[(row[c] is not None, row[c]) for c in order])


class _Opener(StatefulProcessor):
    """State of an id: when the window that blocks it was opened."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], window_us: int):
        self.columns, self.order, self.window_us, self.out = list(columns), list(order), window_us, Row(*columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.opened = handle, handle.getValueState("opened", "us bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = self.opened.get()
        opened = before[0] if before else None
        for row in sorted(rows, key=_place(self.order)):
            if opened is None or row["_us"] >= opened + self.window_us:
                opened = row["_us"]
                yield self.out(*[row[c] for c in self.columns])
        if before is None or opened != before[0]:
            self.opened.update((opened,))
            self.handle.registerTimer(_ms(opened + self.window_us))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        opened = self.opened.get()
        if opened and _ms(opened[0] + self.window_us) <= expiredTimerInfo.getExpiryTimeInMs():
            self.opened.clear()
        return iter(())


def stream_dedupe(
    df: DataFrame, id: str, ts: str, window_s: float | str, path: str, checkpoint: str, order: Sequence[str] = ("seq",),
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """``dedupe_by_message_id`` on a stream. State: for each id whose window is still open, when it was opened; a timer drops it
    once the watermark has passed the window.

    A late message is held against the open window too, so it is dropped rather than accepted a second time. A message without
    a time came before all others. A null id is one like any other. A window that is not positive keeps every message.
    """
    window_us = duration_us(window_s)
    if window_us <= 0:
        return stream_sink(df, path, checkpoint, trigger=trigger)
    timed = df.withColumn("_us", arrival(ts))
    accepted = _keyed(timed, {"_id": F.col(id)}, ts, _Opener(df.columns, order, window_us), df.schema, "event")
    return stream_sink(accepted, path, checkpoint, trigger=trigger)


class _Batcher(StatefulProcessor):
    """State of a channel: number and opening time of its open batch, and the batch's messages (fewer than ``n``)."""

    def __init__(self, schema: T.StructType, order: Sequence[str], n: int, wait_us: int, clock: str):
        self.schema, self.order, self.n, self.wait_us, self.clock = schema, list(order), n, wait_us, clock
        self.out = Row(*schema.names, "batch_no", "batch_idx")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.batch = handle.getValueState("batch", "no bigint, opened bigint")
        self.messages = handle.getListState("messages", self.schema)

    def _emitted(self, messages: Sequence, no: int) -> Iterator[Row]:
        return (self.out(*message, no, i) for i, message in enumerate(messages))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        no, opened = self.batch.get() or (0, None)
        held = [tuple(m) for m in self.messages.get()] if opened is not None else []
        kept, before = len(held), (no, opened)
        for row in sorted(rows, key=_place(self.order)):
            if held and not (len(held) < self.n and row["_us"] < opened + self.wait_us):
                yield from self._emitted(held, no)
                no, held, kept = no + 1, [], 0
            if not held:
                opened = row["_us"]
            held.append(tuple(row[c] for c in self.schema.names))
            if len(held) == self.n:
                yield from self._emitted(held, no)
                no, opened, held, kept = no + 1, None, [], 0
        if kept:
            self.messages.appendList(held[kept:])
        elif held:
            self.messages.put(held)
        else:
            self.messages.clear()
        if (no, opened) != before:
            self.batch.update((no, opened))
            if held:
                self.handle.registerTimer(max(1, _ms(opened + self.wait_us)))  # a message without a time: with the first that has one

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        no, opened = self.batch.get() or (0, None)
        if opened is not None and opened + self.wait_us <= _reached(self.clock, timerValues):
            yield from self._emitted([tuple(m) for m in self.messages.get()], no)
            self.messages.clear()
            self.batch.update((no + 1, None))


def _channel(by: Sequence[str]) -> dict:
    return {f"_by_{i}": F.col(c) for i, c in enumerate(by)} or {"_by_0": F.lit(0)}


def stream_batcher(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    n: int,
    wait_ms: float | str,
    path: str,
    checkpoint: str,
    order: Sequence[str] = ("seq",),
    trigger: Mapping | None = None,
    clock: str = "event",
) -> StreamingQuery:
    """``batch_by_count_or_time`` on a stream: a batch is emitted, whole, once it is full or its time is up.

    State: the messages of each channel's open batch (fewer than ``n``), and the number of its next batch. A timer closes the
    batch: when the newest message of any channel has passed the wait (``clock="event"``), or the wall clock has
    (``"processing"``: messages carry the time they came in). What is open in the end is read with ``open_batches``. A message
    without a time came first and waits for no time.
    """
    timed = df.withColumn("_us", arrival(ts))
    processor = _Batcher(df.schema, order, max(n, 1), batch_wait_us(wait_ms), clock)
    schema = T.StructType([*df.schema.fields, T.StructField("batch_no", T.LongType()), T.StructField("batch_idx", T.LongType())])
    return stream_sink(_keyed(timed, _channel(by), ts, processor, schema, clock), path, checkpoint, trigger=trigger)


def open_batches(spark: SparkSession, checkpoint: str, by: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """The messages of batches that a stopped ``stream_batcher`` has not emitted, with the numbers they would get.

    Reads the query's state as of its last micro-batch; each channel's open batch is a list of fewer than ``n`` messages.
    """
    def state(name: str) -> DataFrame:
        return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()

    numbers = state("batch").select(F.struct("key.*").alias("_key"), F.col("value.no").alias("batch_no"))
    held = state("messages").select(F.struct("key.*").alias("_key"), F.col("list_element").alias("_message"))
    place = F.row_number().over(Window.partitionBy("_key").orderBy(*[F.col("_message")[c] for c in order])) - 1
    return held.withColumn("batch_idx", place.cast("bigint")).join(numbers, "_key").select("_message.*", "batch_no", "batch_idx")


class _Redeliverer(StatefulProcessor):
    """State of a block of neighbouring messages of a consumer: latest attempt, deadline and acknowledgement of those inside it."""

    def __init__(self, max_deliver: int, clock: str):
        self.max_deliver, self.clock = max_deliver, clock
        self.out = Row("consumer", "seq", "attempt", "due_us", "status")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = "seq array<bigint>, attempt array<bigint>, due array<bigint>, acked array<boolean>, timer bigint"
        self.block = handle.getValueState("block", lists)

    def _read(self) -> tuple[dict, int | None]:
        state = self.block.get()
        return ({s: x for s, *x in zip(*state[:4])}, state[4]) if state else ({}, None)

    def _write(self, open_: dict, timer: int | None) -> None:
        """Keep what is open, with one timer at the earliest deadline."""
        if not open_:
            self.block.clear()
            return
        earliest = max(0, _ms(min(due for _, due, _ in open_.values())))
        if timer != earliest:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(earliest)
        self.block.update((list(open_), *[[x[i] for x in open_.values()] for i in range(3)], earliest))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        open_, timer = self._read()
        for row in rows:
            attempt, due, acked = open_.get(row["seq"], (None, None, False))
            if attempt is None or (row["attempt"], row["due_us"]) > (attempt, due):
                attempt, due = row["attempt"], row["due_us"]
            open_[row["seq"]] = (attempt, due, acked or bool(row["acked"]))
        self._write(open_, timer)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        open_, timer = self._read()
        if timer != expiredTimerInfo.getExpiryTimeInMs():
            return
        reached = _reached(self.clock, timerValues)
        for seq, (attempt, due, acked) in open_.items():
            if due <= reached and not acked:
                gone = 0 < self.max_deliver <= attempt
                yield self.out(key[0], seq, attempt + (not gone), due, "failed" if gone else "due")
        self._write({s: x for s, x in open_.items() if x[1] > reached}, None)


def stream_redelivery(
    deliveries: DataFrame, ack_wait_s: float | str, path: str, checkpoint: str, max_deliver: int = 0,
    trigger: Mapping | None = None, clock: str = "event",
) -> StreamingQuery:
    """``redeliver`` on a stream of delivery attempts: a row once a timer finds the deadline of a message's latest attempt passed,
    by the newest delivery time (``clock="event"``) or the wall clock (``"processing"``).

    ``status`` is ``due`` with the number of the next attempt, or ``failed`` after ``max_deliver`` attempts. State: messages still
    inside their deadline, acknowledged or not, in blocks of ``BLOCK`` neighbouring ``seq`` of a consumer; so an attempt that
    comes in after its acknowledgement does not reopen the message, and one that comes in late, without one, is due at once. An attempt
    without an outcome is not acknowledged; one without a delivery time is due at once; a null consumer is one like any other.
    """
    attempts = deliveries.select(
        "consumer", F.col("seq").cast("bigint").alias("seq"),
        F.coalesce(F.col("attempt").cast("bigint"), F.lit(0)).alias("attempt"), "delivered_at",
        F.coalesce(micros("delivered_at") + duration_us(ack_wait_s), F.lit(0)).alias("due_us"),
        F.coalesce(F.col("outcome") == "ack", F.lit(False)).alias("acked"),
    )
    keys = {"_consumer": F.col("consumer"), "_block": F.floor(F.col("seq") / BLOCK)}
    schema = T.StructType([
        deliveries.schema["consumer"], T.StructField("seq", T.LongType()), T.StructField("attempt", T.LongType()),
        T.StructField("due_us", T.LongType()), T.StructField("status", T.StringType()),
    ])
    due = _keyed(attempts, keys, "delivered_at", _Redeliverer(max_deliver, clock), schema, clock)
    return stream_sink(due, path, checkpoint, trigger=trigger)
