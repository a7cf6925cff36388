"""Queries on sources, expressions, metadata and filters."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import functions as fn
from tidewire import operators as op
from tidewire import sources as src
from tidewire.session import configure, new_run_folder
from tidewire.streaming import read_sink, stream_sink

from .registry import query
from .views import derive, table

def us(column: str = "ts"):
    return fn.micros(column).alias(f"{column}_us")


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])



def text_map(**values):
    return fn.stringify_metadata(values)


def log_mapping():
    return {
        "msg_id": F.concat(F.lit("m"), (F.col("event_id") % 9000).cast("string")),
        "seq": F.col("event_id") + 1,
        "ts": "ts",
        "channel": F.concat(F.lit("events."), F.col("event_type"), F.lit("."), F.col("user_id").cast("string")),
        "raw": "props",
    }


SCAN_SQL = "select msg_id, seq, epoch_us(ts) as ts_us, subject as channel, raw from messages"


@query("scan_message_log", ["messages"], SCAN_SQL)
def scan_message_log(spark, sf):
    configure(spark)
    log = src.scan_message_log(spark, f"{sf}/events.parquet", log_mapping())
    return log.select("msg_id", "seq", us(), "channel", "raw")


@query("stream_message_log", ["messages"], SCAN_SQL)
def stream_message_log(spark, sf):
    configure(spark)
    log = src.stream_message_log(spark, sf, EVENTS_SCHEMA, log_mapping(), max_files=4, glob="events.parquet")
    run = new_run_folder(spark, "stream_message_log")
    stream_sink(log, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return read_sink(spark, f"{run}/out").select("msg_id", "seq", us(), "channel", "raw")


ARRIVALS, FILES_EACH = 5, 4


def events_stream(spark, sf):
    """The events as a log that arrived in ``ARRIVALS`` lots, in time order; each is a micro-batch."""
    events = table(spark, sf, "events")
    us = fn.micros("ts")
    first, last = events.agg(F.min(us), F.max(us)).first()
    lot = F.floor((us - first) / ((last - first) // ARRIVALS + 1))
    folder = new_run_folder(spark, "arrivals")
    for i in range(ARRIVALS):
        events.where(lot == i).repartition(FILES_EACH).write.mode("append").parquet(folder)
    return src.stream_table(spark, folder, EVENTS_SCHEMA, max_files=FILES_EACH)


def messages_stream(spark, sf):
    return derive(spark, "messages", events=events_stream(spark, sf))


@query("scan_objects", ["objects"], """
select bucket, key, size, etag from objects where bucket = 'corpus-src1' and starts_with(key, 'en/')
""")
def scan_objects(spark, sf):
    return src.scan_objects(table(spark, sf, "objects"), "corpus-src1", "en/").select("bucket", "key", "size", "etag")


@query("page_objects", ["objects"], """
select bucket, key, cast((row_number() over (partition by bucket order by key) - 1) // 100 + 1 as bigint) as page
from objects
""")
def page_objects(spark, sf):
    return src.page_objects(table(spark, sf, "objects"), 100).select("bucket", "key", "page")


@query("page_objects_sliced", ["objects"], """
select bucket, key, cast((row_number() over (partition by bucket order by key) - 1) // 7 + 1 as bigint) as page
from objects
""")
def page_objects_sliced(spark, sf):
    return src.page_objects(table(spark, sf, "objects"), 7, rows_per_slice=20).select("bucket", "key", "page")


@query("object_messages", ["objects"], """
select bucket, key, md5(body) as raw_md5,
       concat('doc_id=', doc_id, ';etag=custom-', etag, ';size=', size) as metadata
from objects
""")
def object_messages(spark, sf):
    objects = table(spark, sf, "objects").withColumn("user_metadata", text_map(etag=F.col("etag"), size=F.col("size")))
    custom = text_map(etag=F.concat(F.lit("custom-"), F.col("etag")), doc_id=F.col("doc_id"))
    return src.object_messages(objects, custom).select(
        "bucket", "key", F.md5("raw").alias("raw_md5"), fn.render_map("metadata").alias("metadata")
    )


EVENT_FIELDS_SQL = """
with opened as (
  select doc_id, body, json_valid(body) as ok,
         case when json_valid(body)
              then coalesce(nullif(json_extract_string(body, '$.Message'), ''), body) end as event
  from envelopes)
"""


@query("parse_event_envelope", ["envelopes"], EVENT_FIELDS_SQL + """
select doc_id, json_extract_string(event, '$.source') as source,
       json_extract_string(event, '$."detail-type"') as detail_type, json_extract_string(event, '$.region') as region,
       cast(cast(epoch(cast(json_extract_string(event, '$.time') as timestamptz)) as bigint) as varchar) as time_s,
       cast(json_array_length(event, '$.resources') as varchar) as n_resources,
       case when not ok then 'invalid event' end as error
from opened
""")
def parse_event_envelope(spark, sf):
    e = F.col("event")
    return op.judge_event_envelopes(table(spark, sf, "envelopes")).select(
        "doc_id", e["source"].alias("source"), e["detail_type"].alias("detail_type"), e["region"].alias("region"),
        F.unix_seconds(e["time"]).cast("string").alias("time_s"),
        F.when(e.isNotNull(), F.size(e["resources"])).cast("string").alias("n_resources"), "error",
    )


@query("generate_triggers", ["messages"], """
select 'generate' as source, event_type as reference, epoch_us(unnest(generate_series(
         date_trunc('hour', min(ts)), date_trunc('hour', max(ts)), interval '1 hour'))) as ts_us
from messages group by event_type
""")
def generate_triggers(spark, sf):
    timers = table(spark, sf, "messages").groupBy(F.col("event_type").alias("timer_id")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("stop")
    )
    hour = {c: F.date_trunc("hour", F.col(c)).cast("timestamp_ntz") for c in ("start", "stop")}
    return src.generate_triggers(timers.withColumns(hour), 3600).select("source", "reference", us())


def previous_listing(spark, sf):
    """An older listing: only the labelled documents were there, those labelled toxic with other contents."""
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    earlier = table(spark, sf, "objects").join(labels, "doc_id")
    return earlier.withColumn("etag", F.when(F.col("toxic") == 1, F.lit("old")).otherwise(F.col("etag"))).drop("toxic")


POLLED_SQL = """
select 's3-polling' as source, bucket || '/' || key as reference, size, etag
from objects left join labels using (doc_id) where toxic is null or toxic = 1
"""


@query("poll_listing_triggers", ["objects"], POLLED_SQL)
def poll_listing_triggers(spark, sf):
    polled = src.poll_listing_triggers(table(spark, sf, "objects"), previous_listing(spark, sf))
    return polled.select("source", "reference", "size", "etag")


@query("poll_null_etag", ["objects"], """
with now as (select * replace (case when doc_id % 3 > 0 then etag end as etag, case when doc_id % 5 > 0 then bucket end as bucket) from objects),
before as (
  select bucket, key, case when toxic = 1 and etag is not null then 'old' else etag end as etag,
         case when toxic = 1 and etag is null then size + 1 else size end as size
  from now join labels using (doc_id))
select 's3-polling' as source, doc_key as key, size, etag from (select *, key as doc_key from now) n
where not exists (
  select 1 from before b where b.bucket is not distinct from n.bucket and b.key = n.key and b.etag is not distinct from n.etag
    and (n.etag is not null or b.size = n.size))
""")
def poll_null_etag(spark, sf):
    """A third of the objects have an etag, a fifth no bucket; the changed ones have another etag, or another size."""
    now = table(spark, sf, "objects").withColumns({
        "etag": F.when(F.col("doc_id") % 3 > 0, F.col("etag")), "bucket": F.when(F.col("doc_id") % 5 > 0, F.col("bucket"))})
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    changed = F.col("toxic") == 1
    before = now.join(labels, "doc_id").withColumns({
        "size": F.when(changed & F.col("etag").isNull(), F.col("size") + 1).otherwise(F.col("size")),
        "etag": F.when(changed & F.col("etag").isNotNull(), F.lit("old")).otherwise(F.col("etag"))})
    return src.poll_listing_triggers(now, before).select("source", "key", "size", "etag")


@query("file_triggers", ["messages"], """
select distinct 'file' as source, 'route=' || event_type || '.' || qos as folder, true as has_rows from messages
""")
def file_triggers(spark, sf):
    """Messages are written by route; each file found there is a trigger, and the routes are those of the messages."""
    folder = new_run_folder(spark, "found")
    routed = op.route_by_expression(table(spark, sf, "messages"), "${!event_type}.${!qos}")
    op.write_routes(routed.select("route", "seq"), folder)
    found = src.file_triggers(spark, folder, "*.parquet")
    route = F.element_at(F.split("reference", "/"), -2)
    return found.select("source", route.alias("folder"), (F.col("size") > 0).alias("has_rows")).distinct()


@query("walked_file_triggers", ["messages"], """
select distinct 'file' as source, 'route=' || event_type || '.' || qos as folder, true as has_rows from messages
""")
def walked_file_triggers(spark, sf):
    """The same routes, found by tasks that list a folder each."""
    folder = new_run_folder(spark, "walked")
    routed = op.route_by_expression(table(spark, sf, "messages"), "${!event_type}.${!qos}")
    op.write_routes(routed.select("route", "seq"), folder)
    found = src.walked_file_triggers(spark, folder if ":/" in folder else f"file://{folder}", "*.parquet")
    route = F.element_at(F.split("reference", "/"), -2)
    return found.select("source", route.alias("folder"), (F.col("size") > 0).alias("has_rows")).distinct()


@query("message_context", ["messages"], """
select seq, raw as content, cast(json_extract(raw, '$.k') as bigint) as k,
       concat('event_type=', event_type, ';queue=', queue) as metadata
from messages
""")
def message_context(spark, sf):
    messages = table(spark, sf, "messages").withColumn(
        "metadata", text_map(event_type=F.col("event_type"), queue=F.col("queue"))
    )
    return fn.message_context(messages).select(
        "seq", "content", F.try_variant_get("json", "$.k", "bigint").alias("k"),
        fn.render_map("metadata").alias("metadata"),
    )


@query("render_template", ["messages"], """
select seq, concat('a-', event_type, '-', '', '/', cast(json_extract(raw, '$.k') as bigint) % 4, '{}', upper(queue))
         as rendered
from messages
""")
def render_template(spark, sf):
    messages = table(spark, sf, "messages").withColumn("metadata", text_map(type=F.col("event_type")))
    template = (
        "a-${!metadata['type']}-${!metadata['absent']}/${!try_variant_get(json, '$.k', 'bigint') % 4}"
        "${!concat('{', '}')}${!upper(queue)}"
    )
    return fn.message_context(messages).select("seq", fn.render_template(template).alias("rendered"))


@query("parse_json_object", ["envelopes"], """
select doc_id, not json_valid(body) as is_empty,
       case when json_valid(body) then json_extract_string(body, '$.source') end as source,
       case when json_valid(body) then json_extract_string(body, '$.MessageId') end as message_id
from envelopes
""")
def parse_json_object(spark, sf):
    json = F.col("json")
    return table(spark, sf, "envelopes").withColumn("json", fn.parse_json_object("body")).select(
        "doc_id", (F.to_json(json) == "{}").alias("is_empty"),
        F.try_variant_get(json, "$.source", "string").alias("source"),
        F.try_variant_get(json, "$.MessageId", "string").alias("message_id"),
    )


def with_headers(messages):
    return messages.withColumn("headers", F.create_map(
        F.lit("Kind"), F.array("event_type", "queue"),
        F.lit("None"), F.array().cast("array<string>"),
        F.lit("One"), F.array("msg_id"),
    ))


@query("flatten_headers", ["messages"], """
select seq, concat('Kind=', event_type, ',', queue, ';None=;One=', msg_id) as kept,
       concat('Kind=', event_type, ',', queue, ';One=', msg_id) as skipped
from messages
""")
def flatten_headers(spark, sf):
    return with_headers(table(spark, sf, "messages")).select(
        "seq", fn.render_map(fn.flatten_headers("headers")).alias("kept"),
        fn.render_map(fn.flatten_headers("headers", keep_empty=False)).alias("skipped"),
    )


@query("nats_metadata", ["messages"], """
select seq, concat('Kind=', event_type, ',', queue, ';None=;One=', msg_id, ';nats_reply=',
                   case when seq % 2 = 0 then 'inbox.' || queue else '' end, ';nats_subject=', subject) as core,
       concat('Kind=', event_type, ',', queue, ';One=', msg_id,
              case when seq % 2 = 0 then ';nats_reply=inbox.' || queue else '' end, ';nats_subject=', subject) as stream
from messages
""")
def nats_metadata(spark, sf):
    messages = with_headers(table(spark, sf, "messages")).withColumn(
        "reply", F.when(F.col("seq") % 2 == 0, F.concat(F.lit("inbox."), F.col("queue"))).otherwise("")
    )
    core = op.nats_metadata(messages).withColumn("core", fn.render_map("metadata"))
    return op.nats_metadata(core, stream=True).select("seq", "core", fn.render_map("metadata").alias("stream"))


@query("jetstream_metadata", ["messages"], """
with m as (select *, concat('c', seq % 4) as consumer from messages),
p as (select *, row_number() over (partition by event_type, consumer order by seq) as n,
             count(*) over (partition by event_type, consumer) as total from m)
select seq, concat('jetstream_consumer=', consumer, ';jetstream_delivered=', 1 + seq % 3,
                   ';jetstream_pending=', total - n, ';jetstream_sequence_consumer=', n,
                   ';jetstream_sequence_stream=', seq, ';jetstream_stream=', event_type,
                   ';jetstream_timestamp=', strftime(ts, '%Y-%m-%dT%H:%M:%SZ')) as metadata
from p
""")
def jetstream_metadata(spark, sf):
    delivered = table(spark, sf, "messages").withColumns({
        "consumer": F.concat(F.lit("c"), (F.col("seq") % 4).cast("string")), "attempt": 1 + F.col("seq") % 3,
    })
    out = op.jetstream_metadata(delivered, stream="event_type")
    return out.select("seq", fn.render_map("metadata").alias("metadata"))


@query("mqtt_metadata", ["messages"], """
select seq, concat('mqtt_duplicate=', case when seq % 3 > 0 then 'true' else 'false' end,
                   ';mqtt_message_id=', seq % 65536, ';mqtt_qos=', qos,
                   ';mqtt_retained=', case when retained then 'true' else 'false' end,
                   ';mqtt_topic=', topic) as metadata
from messages
""")
def mqtt_metadata(spark, sf):
    delivered = table(spark, sf, "messages").withColumns(
        {"attempt": 1 + F.col("seq") % 3, "message_id": F.col("seq") % 65536}
    )
    return op.mqtt_metadata(delivered).select("seq", fn.render_map("metadata").alias("metadata"))


@query("mq_metadata", ["messages"], """
select seq, concat('mq_correlation_id=', 'corr-', seq, ';mq_format=MQSTR;mq_message_id=', msg_id,
                   ';mq_persistence=', seq % 2, ';mq_priority=', mq_priority, ';mq_queue=', queue) as metadata
from messages
""")
def mq_metadata(spark, sf):
    read = table(spark, sf, "messages").withColumns({
        "correlation_id": F.concat(F.lit("corr-"), F.col("seq").cast("string")), "format": F.lit("MQSTR"),
        "persistence": F.col("seq") % 2,
    })
    return op.mq_metadata(read, priority="mq_priority").select("seq", fn.render_map("metadata").alias("metadata"))


@query("set_metadata", ["messages"], """
select seq, concat('msg_id=', msg_id, ';qos=', qos, ';queue=', subject) as metadata from messages
""")
def set_metadata(spark, sf):
    base = text_map(queue=F.col("queue"), qos=F.col("qos"))
    updated = fn.set_metadata(fn.set_metadata(base, "queue", F.col("subject")), "msg_id", F.col("msg_id"))
    return table(spark, sf, "messages").select("seq", fn.render_map(updated).alias("metadata"))


@query("stringify_metadata", ["messages"], """
select seq, concat('list=[', event_type, ' ', queue, ']', case when seq % 2 = 0 then ';maybe=' || qos else '' end,
                   ';qos=', qos, ';retained=', case when retained then 'true' else 'false' end,
                   ';type=', event_type) as metadata
from messages
""")
def stringify_metadata(spark, sf):
    values = text_map(
        type=F.col("event_type"), qos=F.col("qos"), retained=F.col("retained"),
        list=fn.stringify_list(F.array("event_type", "queue")), maybe=F.when(F.col("seq") % 2 == 0, F.col("qos")),
    )
    return table(spark, sf, "messages").select("seq", fn.render_map(values).alias("metadata"))


@query("filter_metadata", ["messages"], """
select seq, concat('mq_priority=', mq_priority, ';msg_id=', msg_id) as kept,
       concat('qos=', qos, ';type=', event_type) as inverted
from messages
""")
def filter_metadata(spark, sf):
    md = text_map(mq_priority=F.col("mq_priority"), msg_id=F.col("msg_id"), qos=F.col("qos"), type=F.col("event_type"))
    patterns = ["^mq_", "id$"]
    return table(spark, sf, "messages").select(
        "seq", fn.render_map(fn.filter_metadata(md, patterns)).alias("kept"),
        fn.render_map(fn.filter_metadata(md, patterns, invert=True)).alias("inverted"),
    )


@query("filter_subject", ["messages"], """
select seq, subject from messages
where regexp_full_match(subject, 'events\\.[^.]+\\.7') or starts_with(subject, 'events.click.')
   or regexp_full_match(subject, '[^.]+\\.view\\..+')
""")
def filter_subject(spark, sf):
    return op.filter_subject(
        table(spark, sf, "messages"), "subject", "events.*.7", "events.click.>", "*.view.>"
    ).select("seq", "subject")


@query("filter_topic", ["messages"], """
select seq, topic, qos, least(qos, granted) as effective_qos from (
  select *, greatest(case when regexp_full_match(topic, 'events/[^/]*/7') then 2 end,
                     case when starts_with(topic, 'events/click/') or topic = 'events/click' then 1 end,
                     case when regexp_full_match(topic, 'events/view/[^/]*') then 0 end) as granted from messages)
where granted is not null
""")
def filter_topic(spark, sf):
    filters = {"events/+/7": 2, "events/click/#": 1, "events/view/+": 0}
    return op.filter_topic(table(spark, sf, "messages"), "topic", "qos", filters).select(
        "seq", "topic", "qos", "effective_qos"
    )


@query("deliver_policy", ["messages"], """
select 'all' as policy, seq from messages
union all select 'new', seq from messages where ts > timestamp '2024-01-15 12:00:00'
union all select 'last', max(seq) from messages
union all select 'last_per_subject', max(seq) from messages group by subject
""")
def deliver_policy(spark, sf):
    messages = table(spark, sf, "messages")
    created = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    out = None
    for policy in ("all", "new", "last", "last_per_subject"):
        part = op.deliver_policy(messages, policy, created).select(F.lit(policy).alias("policy"), "seq")
        out = part if out is None else out.unionByName(part)
    return out


@query("queue_group_assign", ["messages"], """
select 'group' as mode, seq, case seq % 3 when 0 then 'a' when 1 then 'b' else 'c' end as member from messages
union all select 'every', seq, unnest(['x', 'y']) from messages
""")
def queue_group_assign(spark, sf):
    messages = table(spark, sf, "messages")
    group = op.queue_group_assign(messages, "seq", members=["a", "b", "c"])
    every = op.queue_group_assign(messages, "seq", subscribers=["x", "y"])
    return group.select(F.lit("group").alias("mode"), "seq", "member").unionByName(
        every.select(F.lit("every").alias("mode"), "seq", "member")
    )
