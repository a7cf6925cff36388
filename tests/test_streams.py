"""A stream over several micro-batches gives the batch result; a restart goes on where it stopped."""

import pytest
from pyspark.sql import functions as F

from tidewire import operators as op
from tidewire import sources as src
from tidewire.streaming import (
    read_sink,
    retrieve_stream,
    stream_batcher,
    stream_dedupe,
    stream_flow,
    stream_redelivery,
    stream_sink,
)
from workloads.reading import EVENTS_SCHEMA
from workloads.views import derive, table


@pytest.fixture
def arrivals(spark, sf, tmp_path):
    """Events in time order, as files that are added one by one."""
    folder = tmp_path / "in"
    folder.mkdir()
    cut = F.expr("event_id div 200")
    events = table(spark, sf, "events").withColumn("part", cut)
    parts = events.agg(F.max("part")).head()[0] + 1

    def add(*numbers):
        for i in numbers:
            events.where(F.col("part") == i).drop("part").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / f"p{i}"))
            (source,) = (tmp_path / f"p{i}").glob("*.parquet")
            (folder / f"{i:04d}.parquet").write_bytes(source.read_bytes())

    return folder, add, parts


def messages_of(spark, folder):
    return derive(spark, "messages", events=src.stream_table(spark, str(folder), EVENTS_SCHEMA, max_files=1))


def run_in_two_starts(arrivals, start):
    """Half of the files, a stop, the other half."""
    folder, add, parts = arrivals
    add(*range(parts // 2))
    start(folder).awaitTermination()
    add(*range(parts // 2, parts))
    start(folder).awaitTermination()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_sink_takes_each_message_once(spark, sf, arrivals, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run_in_two_starts(arrivals, lambda f: stream_sink(messages_of(spark, f).select("seq", "topic"), out, check))
    assert rows(read_sink(spark, out), "seq", "topic") == rows(table(spark, sf, "messages"), "seq", "topic")


def test_flow(spark, sf, arrivals, tmp_path):
    def steps(df):
        return op.route_by_expression(op.filter_subject(df, "subject", "events.click.>"), "s.${!qos}")

    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run_in_two_starts(arrivals, lambda f: stream_flow(
        messages_of(spark, f), lambda df: op.filter_subject(df, "subject", "events.click.>"),
        lambda df: op.route_by_expression(df, "s.${!qos}"), path=out, checkpoint=check))
    assert rows(read_sink(spark, out), "seq", "route") == rows(steps(table(spark, sf, "messages")), "seq", "route")


@pytest.mark.parametrize("window_s", [3600, 200_000])
def test_dedupe(spark, sf, arrivals, tmp_path, window_s):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run_in_two_starts(arrivals, lambda f: stream_dedupe(
        messages_of(spark, f).select("topic", "seq", "ts"), "topic", "ts", window_s, out, check))
    batch = op.dedupe_by_message_id(table(spark, sf, "messages"), "topic", "ts", window_s)
    assert rows(read_sink(spark, out), "topic", "seq") == rows(batch, "topic", "seq")


@pytest.mark.parametrize("n,wait_h", [(3, 12), (50, 60), (2, 1000)])
def test_batcher(spark, sf, arrivals, tmp_path, n, wait_h):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    wait_ms = wait_h * 3_600_000
    run_in_two_starts(arrivals, lambda f: stream_batcher(
        messages_of(spark, f).select("queue", "seq", "ts"), ["queue"], "ts", n, wait_ms, out, check))
    messages = table(spark, sf, "messages").select("queue", "seq", "ts")
    batch = op.batch_by_count_or_time(messages, ["queue"], ["seq"], "ts", n, wait_ms)
    columns = ["queue", "batch_no", "batch_idx", "seq"]
    expected = set(rows(batch, *columns))
    emitted = rows(read_sink(spark, out), *columns)
    assert len(emitted) == len(set(emitted)) and set(emitted) <= expected
    # only each channel's last batch may still be open
    last = {}
    for queue, no, _, _ in expected:
        last[queue] = max(last.get(queue, 0), no)
    assert all(no == last[queue] for queue, no, _, _ in expected - set(emitted))


def test_redelivery(spark, sf, arrivals, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    run_in_two_starts(arrivals, lambda f: stream_redelivery(
        derive(spark, "deliveries", messages=messages_of(spark, f)), 60, out, check, 3))
    deliveries = table(spark, sf, "deliveries")
    newest = deliveries.agg(F.max("delivered_at")).head()[0]
    due, failed = op.redeliver(deliveries, F.lit(newest).cast("timestamp_ntz"), 60, 3)
    for status, part in (("due", due), ("failed", failed)):
        got = read_sink(spark, out).where(F.col("status") == status)
        assert rows(got, "consumer", "seq", "attempt") == rows(part, "consumer", "seq", "attempt")


def test_late_message_is_not_accepted_twice(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def arrive(name, seq, t):
        spark.createDataFrame([("x", seq, t)], "id string, seq bigint, t bigint").coalesce(1).write.json(str(folder / name))

    def start():
        df = src.stream_table(spark, f"{folder}/*", spark.createDataFrame([], "id string, seq bigint, t bigint").schema, fmt="json")
        timed = df.withColumn("ts", F.timestamp_seconds("t"))
        stream_dedupe(timed, "id", "ts", 100, out, str(tmp_path / "check")).awaitTermination()

    for name, seq, t in (("a", 1, 1000), ("b", 2, 990), ("c", 3, 1099), ("d", 4, 1100)):
        arrive(name, seq, t)
        start()
    assert [r.seq for r in read_sink(spark, out).orderBy("seq").collect()] == [1, 4]


def test_retrieval(spark, sf, arrivals, tmp_path):
    objects = table(spark, sf, "objects")

    def start(folder):
        events = src.stream_table(spark, str(folder), EVENTS_SCHEMA, max_files=1)
        triggers = derive(spark, "triggers", events=events, documents=table(spark, sf, "documents"))
        return retrieve_stream(op.resolve_location(triggers), lambda: objects, str(tmp_path / "out"), str(tmp_path / "check"),
                               lambda df: df.select("trigger_id", "key"))

    run_in_two_starts(arrivals, start)
    batch = op.retrieve_lenient(op.resolve_location(table(spark, sf, "triggers")), objects)
    assert rows(read_sink(spark, str(tmp_path / "out")), "trigger_id", "key") == rows(batch, "trigger_id", "key")


def test_file_trigger_stream(spark, arrivals, tmp_path):
    folder, add, _ = arrivals
    add(0, 1)
    found = src.file_triggers(spark, str(folder), "*.parquet", streaming=True).select("source", "reference")
    stream_sink(found, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    names = {r.reference.rsplit("/", 1)[-1] for r in read_sink(spark, str(tmp_path / "out")).collect()}
    assert names == {"0000.parquet", "0001.parquet"}
