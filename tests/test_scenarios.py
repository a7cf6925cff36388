"""Small literal cases of the message model's rules.

Fixed values: the messages, names and numbers in these cases are given by the scenarios to be replayed.
"""

import pytest
from pyspark.sql import functions as F

from tidewire import functions as fn
from tidewire import operators as op
from tidewire import sources as src
from tidewire.model import MESSAGE, SOURCE_GENERATE


def maps(df, column="metadata"):
    return [r[column] for r in df.collect()]


# --- expressions -----------------------------------------------------------------------------------------------

@pytest.fixture(scope="module", params=[False, True])
def contexts(spark, request):
    rows = [
        (1, '{"name": "test", "value": 42}', {"source": "test", "timestamp": "2023-01-01"}),
        (2, "invalid json", {"source": "test"}),
        (3, None, {"source": "test"}),
        (4, "[1, 2]", None),
        (5, "7", {}),
    ]
    df = spark.createDataFrame(rows, "id int, raw string, metadata map<string,string>")
    return fn.message_context(df, parse_once=request.param)


def test_context_columns(contexts):
    rows = {r.id: r for r in contexts.withColumn("j", F.to_json("json")).collect()}
    assert rows[1].content == '{"name": "test", "value": 42}' and rows[1].metadata["timestamp"] == "2023-01-01"
    assert (rows[2].content, rows[2].j) == ("invalid json", "{}")
    assert rows[3].content is None and rows[3].j is None and rows[3].metadata == {"source": "test"}
    assert (rows[4].j, rows[4].metadata, rows[5].j) == ("{}", {}, "{}")


def test_templates(contexts):
    def render(template):
        return [r.t for r in contexts.orderBy("id").select(fn.render_template(template).alias("t")).collect()]

    assert render("a-${!metadata['source']}-b") == ["a-test-b"] * 3 + ["a--b"] * 2
    assert render("${!try_variant_get(json, '$.name', 'string')}") == ["test", "", "", "", ""]
    assert render("plain }") == ["plain }"] * 5
    assert render("${!'test'}") == ["test"] * 5
    assert render("x${!concat('{', '}')}y${!id}z") == [f"x{{}}y{i}z" for i in range(1, 6)]
    assert render("") == [""] * 5
    with pytest.raises(ValueError):
        fn.render_template("a${!b")


def test_json_is_parsed_once(spark):
    df = spark.range(10).select("id", F.lit('{"a": 1}').alias("raw"))
    look = [F.try_variant_get("json", f"$.{c}", "string").alias(c) for c in "abc"]
    for once in (False, True):
        out = fn.message_context(df, parse_once=once).where(F.try_variant_get("json", "$.a", "int") == 1).select("id", *look)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == 10 and ("explode" in plan) == once


# --- metadata --------------------------------------------------------------------------------------------------

def test_metadata_filter(spark):
    md = fn.stringify_metadata({"mq_priority": F.lit(7), "custom_header": F.lit("x")})

    def keys(patterns, invert=False):
        return set(spark.range(1).select(fn.filter_metadata(md, patterns, invert).alias("m")).head().m)

    assert keys(["^mq_.*"]) == {"mq_priority"} and keys(["^custom_.*"]) == {"custom_header"}
    assert keys(["^mq_.*"], True) == {"custom_header"} and keys(["^custom_.*"], True) == {"mq_priority"}
    assert keys(["prior", "head"]) == {"mq_priority", "custom_header"}
    assert keys([]) == set() and keys([], True) == {"mq_priority", "custom_header"}
    with pytest.raises(Exception):
        fn.filter_metadata(md, ["("])


def test_set_and_merge(spark):
    base = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2"))
    top = F.create_map(F.lit("b"), F.lit("3"), F.lit("c"), F.lit("4"))
    row = spark.range(1).select(
        fn.merge_maps(base, top).alias("m"), fn.set_metadata(base, "a", F.lit(9)).alias("s"),
        fn.merge_maps(base, top, base).alias("t"),
    ).head()
    assert row.m == {"a": "1", "b": "3", "c": "4"} and row.s == {"a": "9", "b": "2"}
    assert row.t == {"a": "1", "b": "2", "c": "4"}


def test_headers(spark):
    df = spark.createDataFrame(
        [("s", None, {"A": ["1"], "B": ["1", "2"], "C": []})], "subject string, reply string, headers map<string,array<string>>"
    )
    assert maps(op.nats_metadata(df)) == [{"A": "1", "B": "1,2", "C": "", "nats_subject": "s", "nats_reply": ""}]
    assert maps(op.nats_metadata(df, stream=True)) == [{"A": "1", "B": "1,2", "nats_subject": "s"}]


def test_published_headers(spark):
    md = fn.stringify_metadata({"jetstream_stream": F.lit("x"), "k": F.lit("v")})
    at = F.lit("2024-05-06 07:08:09.5").cast("timestamp_ntz")
    row = spark.range(1).select(
        op.publish_headers(md, published_at=at).alias("h"), op.publish_headers(md, ["^z"], host="n1").alias("i")
    ).head()
    assert row.h == {"k": "v", "publish_timestamp": "2024-05-06T07:08:09Z"}
    assert row.i == {"publish_source": "n1"}


@pytest.mark.parametrize("ccsid,encoding,expected", [("819", "273", (819, 273)), ("abc", "x1", (1208, 546)), (None, "", (1208, 546)), (" 819", "+7", (1208, 7))])
def test_descriptor_numbers(spark, ccsid, encoding, expected):
    df = spark.createDataFrame([({},)], "metadata map<string,string>")
    row = op.mq_descriptor(df, ccsid=ccsid, encoding=encoding).head()
    assert (row.ccsid, row.encoding, row.format, row.priority, row.new_correlation_id) == (*expected, "MQSTR", None, True)


def test_descriptor_fields(spark):
    rows = [("7", "1", "CORR123"), ("high", " 1", "x" * 24), ("999", "-1", "x" * 25), ("3", "1", "é" * 13)]
    df = spark.createDataFrame(rows, "p string, q string, c string").select(
        F.create_map(F.lit("mq_priority"), "p", F.lit("mq_persistence"), "q", F.lit("mq_correlation_id"), "c").alias("metadata")
    )
    out = op.mq_descriptor(df).withColumn("error", op.descriptor_error()).collect()
    assert [(r.priority, r.persistence, r.new_correlation_id) for r in out] == [
        (7, 1, False), (None, None, False), (999, -1, True), (3, 1, True)]
    assert [r.correlation_id for r in out] == ["CORR123", "x" * 24, None, None]
    assert [r.error for r in out] == [None, None, "invalid priority 999", None]
    only = op.mq_descriptor(df, patterns=["^custom_.*"]).collect()
    assert all(r.priority is None and r.correlation_id is None for r in only)
    inverted = op.mq_descriptor(df, patterns=["^custom_.*"], invert=True).head()
    assert (inverted.priority, inverted.correlation_id) == (7, "CORR123")


# --- subscriptions ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("pattern,matching", [
    ("events.*.7", {"events.click.7"}),
    ("events.>", {"events.click.7", "events.click.8", "events.click", "events.a.b.7"}),
    ("events.click.*", {"events.click.7", "events.click.8"}),
    ("*.click.>", {"events.click.7", "events.click.8"}),
    (">", {"events.click.7", "events.click.8", "events.click", "events.a.b.7", "events", "eventsx.click"}),
    ("events", {"events"}),
])
def test_subjects(spark, pattern, matching):
    subjects = ["events.click.7", "events.click.8", "events.click", "events.a.b.7", "events", "eventsx.click"]
    df = spark.createDataFrame([(s,) for s in subjects], "subject string")
    assert {r.subject for r in op.filter_subject(df, "subject", pattern).collect()} == matching


@pytest.mark.parametrize("bad", ["a..b", "a.>.b", "", ".a"])
def test_bad_subjects(spark, bad):
    with pytest.raises(ValueError):
        op.filter_subject(spark.createDataFrame([("a",)], "subject string"), "subject", bad)


@pytest.mark.parametrize("filters,expected", [
    ({"events/+/7": 1}, {"events/click/7": 1}),
    ({"events/#": 0}, {"events": 0, "events/click": 0, "events/click/7": 0}),
    ({"#": 2}, {"events": 2, "events/click": 2, "events/click/7": 2, "other": 2}),
    ({"#": 0, "events/click/7": 1, "+": 1}, {"events": 1, "events/click": 0, "events/click/7": 1, "other": 1}),
    ({"$SYS/#": 1}, {"$SYS/x": 1}),
])
def test_topics(spark, filters, expected):
    df = spark.createDataFrame(
        [(t, 2) for t in ("events", "events/click", "events/click/7", "other", "$SYS/x")], "topic string, qos int"
    )
    out = op.filter_topic(df, "topic", "qos", filters).collect()
    assert {r.topic: r.effective_qos for r in out} == expected


@pytest.mark.parametrize("bad", ["a/#/b", "a+/b", "a#", ""])
def test_bad_topics(spark, bad):
    with pytest.raises(ValueError):
        op.filter_topic(spark.createDataFrame([("a", 1)], "topic string, qos int"), "topic", "qos", {bad: 1})


# --- events and triggers ---------------------------------------------------------------------------------------

S3 = ('{"source":"aws.s3","detail-type":"Object Created","detail":{"eventName":"ObjectCreated:Put","bucket":{"name":"b"},'
      '"object":{"key":"d/f.json","size":2048.0,"etag":"\\"d41d\\""}},"time":"2024-01-01T00:00:00Z","region":"r",'
      '"account":"1","resources":["arn:b"]}')


def wrap(event):
    import json

    return json.dumps({"Type": "Notification", "MessageId": "m", "Message": event})


@pytest.fixture(scope="module")
def envelopes(spark):
    bodies = [S3, wrap(S3), None, "{", wrap("{"), "[1]", '{"source":5}', '{"detail":[1]}', '{"resources":[1]}',
              '{"time":"noon"}', '{"Message":""}', '{"Message":"x","MessageId":3}', "{}"]
    return op.parse_event_envelope(spark.createDataFrame(list(enumerate(bodies)), "id int, body string"))


def test_envelopes(envelopes):
    events, errors = envelopes
    assert {r.id for r in events.select("id").collect()} == {0, 1, 10, 11, 12}
    reasons = {r.id: r.error for r in errors.collect()}
    assert reasons == {
        2: "no message body", 3: "invalid event", 4: "invalid inner event", 5: "event is not an object",
        6: "event field has the wrong type", 7: "event field has the wrong type", 8: "event field has the wrong type",
        9: "invalid event time",
    }
    empty = events.where("id = 12").select("event.source", "event.resources").head()
    assert (empty.source, empty.resources) == ("", [])


def test_event_to_trigger(envelopes):
    e = F.col("event")
    made = op.make_trigger(
        envelopes[0], F.lit("eventbridge"), fn.event_reference(e), fn.event_metadata(e), e["time"], keep=("id",))
    first, second = made.where("id < 2").orderBy("id").collect()
    assert first.reference == "s3://b/d/f.json" and first.asDict() | {"id": 1} == second.asDict()
    assert (first.bucket, first.key, first.size, first.etag, first.event_name) == (
        "b", "d/f.json", 2048, "d41d", "ObjectCreated:Put")
    assert first.metadata["event_time"] == "1704067200" and first.metadata["detail_eventName"] == "ObjectCreated:Put"
    assert first.metadata["event_resources"] == "[arn:b]" and first.metadata["detail_bucket"] == '{"name":"b"}'


def test_event_references_fall_back(spark):
    bodies = ['{"source":"aws.ec2","resources":["arn:1","arn:2"],"time":"2024-01-01T00:00:00Z"}',
              '{"source":"aws.s3","detail":{"bucket":{"name":7}},"resources":["arn:3"]}',
              '{"source":"x","time":"2024-01-01T00:00:00.5Z"}']
    events, _ = op.parse_event_envelope(spark.createDataFrame(list(enumerate(bodies)), "id int, body string"))
    refs = [r.r for r in events.orderBy("id").select(fn.event_reference(F.col("event")).alias("r")).collect()]
    assert refs == ["arn:1", "arn:3", "x-1704067200500000000"]


def test_event_filters(envelopes):
    def ids(*args):
        return {r.id for r in op.filter_events(envelopes[0], *args).select("id").collect()}

    assert ids("aws.s3") == {0, 1} and ids(None, "Object Created", {"object.key": "d/f.json"}) == {0, 1}
    assert ids(None, None, None, "ObjectCreated:*") == {0, 1} and ids(None, None, None, "ObjectRemoved:*") == set()
    assert ids(None, None, None, "Object_reated:*") == set() and ids() == {0, 1, 10, 11, 12}


def test_trigger_without_metadata(spark):
    df = spark.createDataFrame([("timer-1", "2024-01-01")], "id string, at string")
    row = op.make_trigger(df, F.lit(SOURCE_GENERATE), F.col("id"), None, F.col("at").cast("timestamp")).head()
    assert (row.source, row.reference, row.metadata, row.bucket, row.size) == ("generate", "timer-1", {}, None, None)


def test_generated_triggers(spark):
    timers = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00", "2024-01-01 06:00:00"), ("none", "2024-01-02", "2024-01-01")],
        "timer_id string, start string, stop string",
    ).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "stop")})
    every_second = src.generate_triggers(timers, 1)
    stats = every_second.groupBy("reference").agg(F.count("*").alias("n"), F.max("ts").alias("m"), F.countDistinct("ts").alias("d"))
    assert [(r.reference, r.n, r.d, str(r.m)) for r in stats.collect()] == [("a", 21601, 21601, "2024-01-01 06:00:00")]
    assert src.generate_triggers(timers, 7).count() == 21600 // 7 + 1


def test_limits(spark):
    df = spark.createDataFrame([("s", i, i) for i in range(30)], "source string, ts int, trigger_id int")
    counts = [op.limit_batch(df, n, cap).count() for n, cap in ((0, None), (-3, None), (25, None), (25, 7), (25, 99), (5, 0))]
    assert counts == [10, 10, 25, 7, 10, 5]
    assert {r.ts for r in op.limit_batch(df, 3).collect()} == {0, 1, 2}


# --- retrieval -------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(
        [("bucket", "file1.json", '{"id": 1}', 9), ("bucket", "file2.json", '{"id": 2}', 9)],
        "bucket string, key string, body string, size bigint")


def triggers_of(spark, *references):
    df = spark.createDataFrame(
        [(i, "s3", r, 1) for i, r in enumerate(references)], "trigger_id int, source string, reference string, batch_id int")
    return op.resolve_location(df.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")))


def test_retrieval(spark, store):
    triggers = triggers_of(spark, "bucket/file1.json", "bucket/file2.json", "bucket/missing.json")
    assert {r.body for r in op.retrieve_lenient(triggers, store).collect()} == {'{"id": 1}', '{"id": 2}'}
    rows, failures = op.retrieve_strict(triggers, store)
    assert rows.count() == 0 and [(r.batch_id, r.n_failed) for r in failures.collect()] == [(1, 1)]
    assert [r.key for r in op.missing_objects(triggers, store).collect()] == ["missing.json"]
    # what the filter rejects cannot fail
    rows, failures = op.retrieve_strict(triggers, store, prefix="file")
    assert rows.count() == 2 and failures.count() == 0


def test_strict_counts_unresolvable(spark, store):
    triggers = triggers_of(spark, "bucket/file1.json", "invalid-reference")
    _, failures = op.retrieve_strict(triggers, store, suffix=".json")
    assert [r.n_failed for r in failures.collect()] == [1]


def test_no_triggers(spark, store):
    triggers = triggers_of(spark, "bucket/file1.json").where("false")
    rows, failures = op.retrieve_strict(triggers, store)
    assert (op.retrieve_lenient(triggers, store).count(), rows.count(), failures.count()) == (0, 0, 0)


def test_enriched(spark, store):
    triggers = triggers_of(spark, "bucket/file1.json").withColumn("metadata", F.create_map(F.lit("k"), F.lit("v")))
    md = op.retrieve_enriched(triggers, store).head().metadata
    assert md == {"trigger_source": "s3", "trigger_reference": "bucket/file1.json", "trigger_k": "v",
                  "trigger_timestamp": "1704067200000000000"}


def test_locations(spark):
    rows = [
        ("test-bucket/test/file.txt", None), ("x/y", {"bucket": "test-bucket", "key": "test/file.txt"}),
        ("invalid-reference", None), ("b/", None), ("s3://b/k/l", {"bucket": "only"}),
        ("none", {"bucket": '{"name":"n"}', "object": '{"key":"k"}'}), (None, None), ("none", {"bucket": '{"x":1}'}),
    ]
    out = op.resolve_location(spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "id int, reference string, metadata map<string,string>")).orderBy("id").collect()
    assert [(r.bucket, r.key) for r in out] == [
        ("test-bucket", "test/file.txt"), ("test-bucket", "test/file.txt"), (None, None), ("b", ""), ("b", "k/l"),
        ("n", "k"), (None, None), (None, None)]
    assert [r.location_error is None for r in out] == [True, True, False, True, True, True, False, False]


def test_filters(spark):
    df = spark.createDataFrame([("a.json", 50), ("a.csv", 500), ("a.tmp", 500), ("b.json", 5000)], "key string, size bigint")

    def keys(out):
        return {r.key for r in out.collect()}

    assert keys(op.filter_object_attrs(df, [".json", ".csv"], 100, 1000)) == {"a.csv"}
    assert keys(op.filter_object_attrs(df)) == {"a.json", "a.csv", "a.tmp", "b.json"}
    assert keys(op.filter_key_affix(df, prefix="a", suffix=".json")) == {"a.json"} and op.filter_key_affix(df) is df


def test_objects_on_disk(spark, tmp_path):
    (tmp_path / "test" / "files").mkdir(parents=True)
    (tmp_path / "test" / "files" / "one").write_text("hello, world")
    (tmp_path / "other").write_text("x")
    objects = src.read_objects(spark, str(tmp_path), "testbucket")
    found = src.scan_objects(objects, "testbucket", "test/files/")
    assert [(r.key, r.size, bytes(r.body)) for r in found.collect()] == [("test/files/one", 12, b"hello, world")]
    messages = src.object_messages(found, F.create_map(F.lit("k"), F.lit("v"))).collect()
    assert [(bytes(r.raw), r.metadata) for r in messages] == [(b"hello, world", {"k": "v"})]
    triggers = src.file_triggers(spark, str(tmp_path)).orderBy("size").collect()
    assert [(r.source, r.size, r.metadata["size"]) for r in triggers] == [("file", 1, "1"), ("file", 12, "12")]


def test_message_log_fields(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("n"), F.lit("x").alias("p")).write.json(str(tmp_path / "log"))
    log = src.scan_message_log(spark, str(tmp_path / "log"), {"seq": "n", "raw": "p"}, "json")
    assert log.schema.names == MESSAGE.names and {(r.seq, r.raw, r.ts) for r in log.collect()} == {(i, "x", None) for i in range(3)}
    with pytest.raises(ValueError):
        src.scan_message_log(spark, str(tmp_path / "log"), {"sequence": "n"}, "json")


# --- sinks -----------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def bad_third(spark):
    df = spark.createDataFrame([(1, 0, 4), (1, 1, 5), (1, 2, 999), (1, 3, 1), (2, 0, 3)], "batch int, batch_idx int, priority int")
    return df, op.descriptor_error()


def test_policies(bad_third):
    df, error = bad_third
    written, back = op.publish_transactional(df, error, ["batch"])
    assert [r.batch for r in written.collect()] == [2] and back.count() == 4
    status = {(r.batch, r.batch_idx): (r.status, r.error) for r in op.publish_fail_fast(df, error, ["batch"]).collect()}
    assert status == {
        (1, 0): ("sent", None), (1, 1): ("sent", None), (1, 2): ("failed", "batch #2: invalid priority 999"),
        (1, 3): ("not_attempted", None), (2, 0): ("sent", None)}
    sent, dead = op.publish_continue(df, error)
    assert sent.count() == 4 and [r.error for r in dead.collect()] == ["invalid priority 999"]
    none, back = op.publish_transactional(df.where("false"), error, ["batch"])
    assert none.count() == 0 and back.count() == 0


def test_error_report(spark):
    df = spark.createDataFrame([(1, i, f"e{i}" if i % 2 else None) for i in range(12)], "batch int, idx int, error string")
    row = op.batch_error_report(df, ["batch"], "idx", "error", "; ").head()
    assert (row.n_errors, row.first_error, row.report) == (6, "e1", "e1; e3; e5; e7; e9; e11")


def test_ordered_write_keeps_order(spark, tmp_path):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("q"), F.col("id") % 5)).alias("queue"), "id"
    ).repartition(6)
    path = str(tmp_path / "out")
    op.ordered_write(df, path, ["queue"], ["id"], 8)
    files = spark.read.parquet(path).select("queue", "id", "_metadata.file_name", F.col("_metadata.row_index").alias("at"))
    rows = sorted(files.collect(), key=lambda r: (r.file_name, r.at))
    for queue in {r.queue for r in rows}:
        ids = [r.id for r in rows if r.queue == queue]
        assert ids == sorted(ids)
    assert len({r.file_name for r in rows if r.queue == "hot"}) > 1  # the hot channel is spread


def test_round_trip_by_route(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "kind string, n int")
    op.write_routes(op.route_by_expression(df, "q.${!kind}"), str(tmp_path / "r"))
    back = spark.read.parquet(str(tmp_path / "r"))
    assert {(r.route, r.n) for r in back.collect()} == {("q.a", 1), ("q.b", 2), ("q.a", 3)}


# --- delivery --------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("transport,flags,expected", [
    ("mqtt", {"auto_ack": True, "failed": True, "context_ended": True}, "ack"),
    ("mqtt", {"context_ended": True}, "redeliver"),
    ("mqtt", {}, "ack"),
    ("mqtt", {"connected": False}, "redeliver"),
    ("mqtt", {"failed": True}, "redeliver"),
    ("mq", {"context_ended": True}, "redeliver"),
    ("mq", {"failed": True}, "redeliver"),
    ("mq", {}, "ack"),
    ("mq", {"closed": True}, "redeliver"),
    ("jetstream", {}, "ack"),
    ("jetstream", {"failed": True}, "redeliver"),
    ("nats", {}, "ack"),
    ("nats", {"failed": True}, "lost"),
    ("sqs", {}, "ack"),
    ("sqs", {"failed": True}, "lost"),
    ("sqs", {"parsed": False}, "redeliver"),
    ("other", {}, None),
])
def test_ack_outcomes(spark, transport, flags, expected):
    df = spark.range(1).select(F.lit(transport).alias("transport"), *[F.lit(v).alias(k) for k, v in flags.items()])
    assert op.ack_outcome(df).head().outcome == expected


def test_nack_then_ack(spark):
    delivered = spark.createDataFrame([("b1", 0, "x", 1), ("b1", 1, "y", 1), ("b2", 0, "z", 1)], "batch_id string, batch_idx int, raw string, attempt int")
    nacked = spark.createDataFrame([("b1",), ("b1",)], "batch_id string")
    again = op.rollback_batch(delivered, nacked).orderBy("batch_idx").collect()
    assert [(r.raw, r.attempt) for r in again] == [("x", 2), ("y", 2)]
    assert op.rollback_batch(delivered, nacked.where("false")).count() == 0


def test_redelivery_limits(spark):
    at = F.timestamp_seconds(F.col("t")).cast("timestamp_ntz")
    rows = [("c", 1, 1, 0, "none"), ("c", 2, 1, 0, "nack"), ("c", 2, 2, 30, "nack"), ("c", 3, 1, 0, "nack"), ("c", 3, 2, 9, "ack"), ("c", 4, 1, 95, "none")]
    df = spark.createDataFrame(rows, "consumer string, seq bigint, attempt int, t bigint, outcome string").withColumn("delivered_at", at)
    now = F.timestamp_seconds(F.lit(100)).cast("timestamp_ntz")

    def split(wait, most):
        return [sorted((r.seq, r.attempt) for r in part.collect()) for part in op.redeliver(df, now, wait, most)]

    assert split(60, 2) == [[(1, 2)], [(2, 2)]]
    assert split(60, 0) == [[(1, 2), (2, 3)], []]
    assert split(5, 5) == [[(1, 2), (2, 3), (4, 2)], []]


def test_metrics(spark):
    rows = [("m", "counter", 2.0, 1), ("m", "counter", 3.0, 2), ("g", "gauge", 9.0, 1), ("g", "gauge", 4.0, 3), ("g", "gauge", 7.0, 2), ("t", "timer", 1.0, 1), ("t", "timer", 3.0, 2)]
    out = {r.name: r for r in op.component_metrics(spark.createDataFrame(rows, "name string, kind string, value double, ts int")).collect()}
    assert out["m"].counter == 5 and out["m"].gauge is None and out["g"].gauge == 4
    t = out["t"]
    assert (t.timer_count, t.timer_sum, t.timer_min, t.timer_max, t.timer_avg, t.counter) == (2, 4, 1, 3, 2, None)


def test_processors(spark):
    df = spark.range(10)
    assert op.apply_processor(df, lambda d: d.where("id > 6")).count() == 3

    def split(frames):
        import pandas as pd

        for frame in frames:
            yield pd.DataFrame({"x": [v for i in frame.id for v in (i, -i)]})

    assert op.apply_processor(df, split, "x bigint").count() == 20


def test_json_columns(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{"), (3, '{"a": "x"}'), (4, None)], "id int, content string")
    rows, bad = op.json_parser(df, T.StructType([T.StructField("a", T.IntegerType())]))
    assert [(r.id, r.a) for r in rows.collect()] == [(1, 1)]
    assert {(r.id, r.content) for r in bad.collect()} == {(2, "{"), (3, '{"a": "x"}'), (4, None)}


@pytest.mark.parametrize("text,us", [("100ms", 100_000), ("1.5s", 1_500_000), ("1h30m", 5_400_000_000), ("-2s", -2_000_000), ("0", 0), (".5us", 0), (2, 2_000_000)])
def test_durations(text, us):
    assert fn.duration_us(text) == us


@pytest.mark.parametrize("bad", ["", "100", "1x", "s", "1s2", "1 s"])
def test_bad_durations(spark, bad):
    with pytest.raises(ValueError):
        fn.duration_us(bad)
    rows = spark.createDataFrame([("a", i, i * 60) for i in range(4)], "c string, seq int, ms int")
    df = rows.withColumn("ts", F.timestamp_millis("ms"))
    # as a batch wait it counts as 100 ms
    out = op.batch_by_count_or_time(df, ["c"], ["seq"], "ts", 9, bad).orderBy("seq").collect()
    assert [r.batch_no for r in out] == [0, 0, 1, 1]


def test_message_errors(spark):
    df = spark.createDataFrame([("r", "p", 1), ("", "p", 1), (None, None, 1), ("r", None, 1), ("r", "p", 10)], "route string, raw string, priority int")
    reasons = [r.e for r in df.select(op.message_error("route", "raw", "priority").alias("e")).collect()]
    assert reasons == [None, "no destination", "no destination", "unreadable payload", "invalid priority 10"]
    assert df.where(op.message_error().isNotNull()).count() == 0


def test_observed(spark):
    df, seen = op.observed(spark.range(10), "sent", {"n": F.count(F.lit(1)), "top": F.max("id")})
    assert df.count() == 10 and seen.get == {"n": 10, "top": 9}


def test_large_limit_uses_positions(spark):
    df = spark.range(5000).select(F.lit("s").alias("source"), F.col("id").alias("ts"), F.col("id").alias("trigger_id"))
    kept = op.limit_batch(df, 2000)
    assert kept.count() == 2000 and kept.agg(F.max("ts")).head()[0] == 1999 and kept.columns == df.columns
