"""Inputs the fixtures lack: null keys and times, odd windows, odd texts, objects that land later."""

import time

import pytest
from pyspark.sql import functions as F

from tidewire import functions as fn
from tidewire import operators as op
from tidewire import sources as src
from tidewire.streaming import flow, open_batches, read_sink, retrieve_stream, retrieve_stream_waiting, stream_batcher, stream_dedupe, stream_redelivery, stream_sink


@pytest.fixture
def few_partitions(spark):
    """State of a handful of keys in two stores."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_batch_policies_with_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 0, None), (None, 1, "bad"), (None, 2, None), ("a", 0, None)], "batch string, idx int, err string")
    status = {(r.batch, r.idx): r.status for r in op.publish_fail_fast(df, F.col("err"), ["batch"], "idx").collect()}
    assert status == {(None, 0): "sent", (None, 1): "failed", (None, 2): "not_attempted", ("a", 0): "sent"}
    written, back = op.publish_transactional(df, F.col("err"), ["batch"])
    assert [tuple(r) for r in written.collect()] == [("a", 0, None)] and back.count() == 3 and back.columns == df.columns + ["error"]
    deliveries = df.withColumn("attempt", F.lit(1))
    assert op.rollback_batch(deliveries, df.where("err is not null"), ["batch"]).count() == 3


def test_pending_and_strict_with_null_keys(spark):
    messages = spark.createDataFrame([(None, 1), (None, 2), ("c", 1)], "consumer string, seq int")
    acks = spark.createDataFrame([(None, 1)], "consumer string, seq int")
    for policy in ("explicit", "all"):
        left = op.pending_by_ack_policy(messages, acks, policy).collect()
        assert {(r.consumer, r.seq) for r in left} == {(None, 2), ("c", 1)}
    triggers = spark.createDataFrame(
        [(None, "b", "x", None), (None, "b", "gone", None), (1, "b", "x", None)],
        "batch_id int, bucket string, key string, location_error string")
    objects = spark.createDataFrame([("b", "x", "body")], "bucket string, key string, body string")
    rows, failures = op.retrieve_strict(triggers, objects)
    assert [r.batch_id for r in rows.collect()] == [1]
    assert [tuple(r) for r in failures.collect()] == [(None, 1)]


@pytest.mark.parametrize("per_slice", [None, 3])
@pytest.mark.parametrize("window,kept", [(0, 6), (-5, 6), (0.5, 4), ("500ms", 4), ("1h", 2)])
def test_windows_of_any_kind(spark, per_slice, window, kept):
    times = [None, 0, 200, 600, 900, 1200]
    df = spark.createDataFrame([("x", i, t) for i, t in enumerate(times)], "id string, seq int, ms int").withColumn(
        "ts", F.timestamp_millis("ms"))
    out = op.dedupe_by_message_id(df, "id", "ts", window, rows_per_slice=per_slice)
    assert out.count() == kept and out.columns == df.columns


def test_event_times_and_repeated_keys(spark):
    def body(time):
        return f'{{"source":"s","detail":{{}},"time":"{time}","source":"last"}}'

    times = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.5+01:00", "10:00", "2024", "2024-01-02", "2024-01-02T03:04:05"]
    df = spark.createDataFrame([(i, body(t)) for i, t in enumerate(times)], "id int, body string")
    rows = op.judge_event_envelopes(df).orderBy("id").collect()
    assert [r.error for r in rows] == [None, None] + ["invalid event time"] * 4
    assert rows[0].event.source == "last" and rows[2].event is None
    obj = spark.createDataFrame([('{"a":1,"a":2}',)], "t string").select(
        F.try_variant_get(fn.parse_json_object("t"), "$.a", "int").alias("a"))
    assert obj.first().a == 2


def test_line_breaks_in_names(spark):
    df = spark.createDataFrame([("e.c.7\n",), ("e.c.7",), ("e.x.a\nb",)], "s string")
    assert {r.s for r in op.filter_subject(df, "s", "e.*.7").collect()} == {"e.c.7"}
    assert op.filter_subject(df, "s", "*.*.>").count() == 3
    topics = spark.createDataFrame([("e/c/7\n", 0), ("e/c/7", 0), ("e/a\nb", 0)], "t string, q int")
    assert {r.t for r in op.filter_topic(topics, "t", "q", {"e/+/7": 1}).collect()} == {"e/c/7"}
    assert op.filter_topic(topics, "t", "q", {"e/#": 1}).count() == 3


def test_patterns_are_those_of_the_engine(spark):
    md = spark.createDataFrame([({"ключ": "1", "2": "x"},)], "m map<string,string>")
    assert md.select(fn.filter_metadata("m", [r"^\p{L}+$"]).alias("m")).first().m == {"ключ": "1"}
    for bad in ("(", r"(?P<a>x)"):
        with pytest.raises(ValueError):
            fn.filter_metadata("m", [bad])


def test_objects_below_a_folder_of_the_same_name(spark, tmp_path):
    deep = tmp_path / "D" / "b" / "D" / "a"
    deep.mkdir(parents=True)
    (deep / "f.txt").write_bytes(b"abc")
    row = src.read_objects(spark, str(tmp_path / "D"), "bucket").first()
    assert (row.key, row.size, row.etag, row.user_metadata) == ("b/D/a/f.txt", 3, "900150983cd24fb0d6963f7d28e17f72", {})
    polled = src.poll_listing_triggers(src.read_objects(spark, str(tmp_path / "D"), "bucket"), spark.createDataFrame(
        [], "bucket string, key string, etag string"))
    assert op.expire_triggers(polled, F.current_timestamp(), 3600).count() == 1


def test_savings_count_triggers_not_listings(spark):
    triggers = spark.createDataFrame([("s", "b", "k")], "source string, bucket string, key string")
    objects = spark.createDataFrame([("b", "k"), ("b", "k")], "bucket string, key string")
    assert op.fetch_savings(triggers, objects, F.lit(True)).first().seen == 1


def test_strict_templates(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "v string").select("v", fn.render_strict("a.${!try_cast(v as int)}").alias("r"))
    assert [(r.r["value"], r.r["error"]) for r in df.collect()] == [
        ("a.1", None), (None, "no value for try_cast(v as int)"), (None, "no value for try_cast(v as int)")]


def test_objects_that_land_after_the_start(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("triggers", "objects", "out", "check")}

    def land(n):
        spark.createDataFrame([("b", f"k{n}", f"body{n}")], "bucket string, key string, body string").write.mode("append").parquet(paths["objects"])
        spark.createDataFrame([(n, "b", f"k{n}")], "id int, bucket string, key string").write.mode("append").parquet(paths["triggers"])

    land(1)
    triggers = spark.readStream.schema("id int, bucket string, key string").parquet(paths["triggers"])
    for n in (2, 3):
        query = retrieve_stream(triggers, lambda: spark.read.parquet(paths["objects"]), paths["out"], paths["check"])
        query.awaitTermination()
        land(n)
    retrieve_stream(triggers, lambda: spark.read.parquet(paths["objects"]), paths["out"], paths["check"]).awaitTermination()
    assert {(r.id, r.body) for r in read_sink(spark, paths["out"]).collect()} == {(n, f"body{n}") for n in (1, 2, 3)}


def test_batches_without_times_are_carried(spark, few_partitions, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([("q", 1, None), ("q", 2, None)], "queue string, seq bigint, ts timestamp").write.parquet(folder)
    rows = spark.readStream.schema("queue string, seq bigint, ts timestamp").parquet(folder)
    stream_batcher(rows, ["queue"], "ts", 3, 1000, out, str(tmp_path / "check")).awaitTermination()
    left = open_batches(spark, str(tmp_path / "check"), ["queue"]).orderBy("seq").collect()
    assert [(r.seq, r.batch_no, r.batch_idx) for r in left] == [(1, 0, 0), (2, 0, 1)]


def run_until(query, done):
    """Lets a running stream go on until ``done()``, for two minutes at most, without new input."""
    try:
        end = time.monotonic() + 120
        while not done() and time.monotonic() < end:
            assert query.exception() is None
            time.sleep(0.3)
    finally:
        query.stop()


def emitted(spark, out):
    def count():
        try:
            return read_sink(spark, out).count()
        except FileNotFoundError:
            return 0
    return count


def test_wall_clock_closes_a_quiet_channel(spark, few_partitions, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.sql("select 'q' queue, 1L seq, current_timestamp() ts").write.parquet(folder)
    rows = spark.readStream.schema("queue string, seq bigint, ts timestamp").parquet(folder)
    query = stream_batcher(rows, ["queue"], "ts", 3, 1000, out, str(tmp_path / "check"), clock="processing",
                           trigger={"processingTime": "1 second"})
    run_until(query, lambda: emitted(spark, out)() >= 1)
    assert [(r.seq, r.batch_no, r.batch_idx) for r in read_sink(spark, out).collect()] == [(1, 0, 0)]


def test_wall_clock_redelivers_without_traffic(spark, few_partitions, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.sql("""select * from values ('c', 1L, 1, 'ack'), ('c', 2L, 1, null), (null, 3L, 3, 'nack'), ('c', 4L, 1, 'none')
                 as t(consumer, seq, attempt, outcome)""").withColumn("delivered_at", F.current_timestamp()).write.parquet(folder)
    rows = spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)
    query = stream_redelivery(rows, 1, out, str(tmp_path / "check"), 3, clock="processing", trigger={"processingTime": "1 second"})
    run_until(query, lambda: emitted(spark, out)() >= 3)
    got = {(r.consumer, r.seq, r.attempt, r.status) for r in read_sink(spark, out).collect()}
    assert got == {("c", 2, 2, "due"), (None, 3, 3, "failed"), ("c", 4, 2, "due")}


def test_late_acknowledgements_and_attempts(spark, few_partitions, tmp_path):
    """Deliveries that come in out of order: an acknowledgement before its attempt, one in time, one too late, a late attempt."""
    folder, out, schema = tmp_path / "in", str(tmp_path / "out"), "consumer string, seq bigint, attempt int, t bigint, outcome string"

    def arrive(name, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(str(folder / name))
        df = spark.readStream.schema(schema).json(f"{folder}/*").withColumn("delivered_at", F.timestamp_seconds("t"))
        stream_redelivery(df, 60, out, str(tmp_path / "check")).awaitTermination()
        return sorted((r.seq, r.attempt) for r in read_sink(spark, out).collect())

    assert arrive("a", ("c", 1, 1, 1000, "ack"), ("c", 2, 1, 1000, None), ("c", 3, 1, 1000, "none")) == []
    assert arrive("b", ("c", 1, 1, 1000, "none"), ("c", 2, 1, 1000, "ack"), ("c", 9, 1, 1059, "ack")) == []
    assert arrive("c", ("c", 9, 1, 1060, "ack")) == [(3, 2)]  # 3 is due, 1 and 2 were acknowledged
    assert arrive("d", ("c", 3, 1, 1000, "ack"), ("c", 4, 1, 900, "none")) == [(3, 2), (4, 2)]  # 3 is out already, 4 at once
    assert arrive("e", ("c", 2000, 1, 2000, "ack")) == [(3, 2), (4, 2)]


def test_state_of_closed_windows_is_dropped(spark, few_partitions, tmp_path):
    folder, check = tmp_path / "in", str(tmp_path / "check")
    for name, rows in (("a", [("x", 1, 1000), ("y", 2, 1001), (None, 3, 1001), (None, 4, 1002)]), ("b", [("z", 5, 5000)])):
        spark.createDataFrame(rows, "id string, seq bigint, t bigint").coalesce(1).write.json(str(folder / name))
        df = spark.readStream.schema("id string, seq bigint, t bigint").json(f"{folder}/*").withColumn("ts", F.timestamp_seconds("t"))
        stream_dedupe(df, "id", "ts", 100, str(tmp_path / "out"), check).awaitTermination()
    assert sorted(r.seq for r in read_sink(spark, str(tmp_path / "out")).collect()) == [1, 2, 3, 5]
    state = spark.read.format("statestore").option("path", check).option("stateVarName", "opened").load()
    assert [r.key[0] for r in state.collect()] == ["z"]


def test_readers_see_whole_micro_batches_only(spark, few_partitions, tmp_path):
    out, check, folder = str(tmp_path / "out"), str(tmp_path / "check"), str(tmp_path / "in")
    spark.sql("select 1L seq, 'sent' outcome union all select 2L, 'dead'").write.parquet(folder)
    rows = spark.readStream.schema("seq bigint, outcome string").parquet(folder)
    flow._write_whole(out, "parquet", "outcome", {}, spark.sql("select 7L seq, 'sent' outcome"), 100)
    # a writer that is still at work, or has died, has a folder that the manifest does not name
    spark.sql("select 8L seq, 'sent' outcome").write.parquet(f"{out}/{flow.BATCH}=0-dead")
    assert [r.seq for r in read_sink(spark, out).collect()] == [7]
    for _ in range(2):  # started again, nothing is taken twice
        stream_sink(rows, out, check, by="outcome").awaitTermination()
    assert sorted(r.seq for r in read_sink(spark, out).collect()) == [1, 2, 7]
    # the crash after the manifest was written and before the query noted its progress: the same micro-batch once more
    flow._write_whole(out, "parquet", "outcome", {}, spark.sql("select 1L seq, 'sent' outcome"), 0)
    assert sorted(r.seq for r in read_sink(spark, out).collect()) == [1, 2, 7]


def test_triggers_wait_for_their_objects(spark, few_partitions, tmp_path):
    """An object before its trigger, one after it in a later lot, one too late, one never; a trigger without a key."""
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    t, o = "id bigint, bucket string, key string, t bigint", "bucket string, key string, etag string, t bigint"

    def arrive(lot, triggers, objects):
        spark.createDataFrame(triggers, t).coalesce(1).write.json(str(tmp_path / f"t/{lot}"))
        spark.createDataFrame(objects, o).coalesce(1).write.json(str(tmp_path / f"o/{lot}"))
        asked = spark.readStream.schema(t).json(str(tmp_path / "t/*")).withColumn("ts", F.timestamp_seconds("t")).drop("t")
        landed = spark.readStream.schema(o).json(str(tmp_path / "o/*")).withColumn("modified", F.timestamp_seconds("t")).drop("t")
        retrieve_stream_waiting(asked, landed, out, check, 60, 100).awaitTermination()
        return sorted(((r.id, r.etag, r.found) for r in read_sink(spark, out).collect()), key=lambda r: r[:1] + (r[1] or "",))

    first = arrive(0, [(1, "b", "before", 1000), (2, "b", "after", 1000), (3, "b", "late", 1000), (4, "b", "never", 1000), (5, "b", None, 1000)],
                   [("b", "before", "x1", 950), ("b", "before", "too old", 899), ("b", "other", "y", 1000)])
    assert first == [(1, "x1", True)]
    second = arrive(1, [(6, "b", "other", 1050)], [("b", "after", "x2", 1060), ("b", "before", "x3", 1001)])
    assert second == [(1, "x1", True), (1, "x3", True), (2, "x2", True), (6, "y", True)]
    third = arrive(2, [(7, "b", "next", 2000)], [("b", "late", "x4", 1061), ("b", "z", "z", 2000)])
    assert third == sorted([*second, (3, None, False), (4, None, False), (5, None, False)], key=lambda r: r[:1] + (r[1] or "",))


@pytest.mark.parametrize("glob", ["*", "*.txt", "a?[bc]*"])
def test_files_are_found_by_tasks_as_by_the_file_index(spark, tmp_path, glob):
    for name in ("a.txt", "x/a1b.txt", "x/b.dat", "x/y/z/a2c", "x/y/z/ab.txt", "x/_hidden.txt", "x/.hidden.txt", "empty folder/sp ace.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name * 3)
    (tmp_path / "nothing").mkdir()

    def found(df):
        return sorted((r.reference.replace("%20", " ").removeprefix("file://").removeprefix("file:"), r.size, r.metadata, r.ts.timestamp() // 1)
                      for r in df.drop("metadata").withColumn("metadata", F.col("size").cast("string")).collect())

    walked = src.walked_file_triggers(spark, f"file://{tmp_path}", glob)
    listed = src.file_triggers(spark, str(tmp_path), glob)
    assert walked.dtypes == listed.dtypes and found(walked) == found(listed) and found(walked)
    assert src.walked_file_triggers(spark, f"file://{tmp_path}/nothing").collect() == []


def test_timer_stream(spark):
    assert src.timer_triggers(spark, "t", 5).isStreaming
    with pytest.raises(ValueError):
        src.timer_triggers(spark, "t", 0)
