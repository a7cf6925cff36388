"""Queries on batches, delivery rules, sinks, metrics, processors and streams."""

from __future__ import annotations

import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire import functions as fn
from tidewire import operators as op
from tidewire.session import new_run_folder
from tidewire.streaming import (
    observed_progress,
    read_sink,
    stream_batcher,
    stream_dedupe,
    stream_flow,
    stream_redelivery,
    stream_sink,
)

from .reading import messages_stream, text_map, us
from .registry import query
from .triggering import located
from .views import derive, table

BATCHES_SQL = """
with batched as (
  select *, (n - 1) // 5 as batch_no, (n - 1) % 5 as batch_idx,
         case when mq_priority > 9 then 'invalid priority ' || mq_priority end as err
  from (select *, row_number() over (partition by queue order by ts, seq) as n from messages))
"""


def batches(spark, sf, n=5):
    return op.batch_by_count(table(spark, sf, "messages"), ["queue"], ["ts", "seq"], n)


def bad_priority():
    return op.descriptor_error("mq_priority")


@query("batch_by_count", ["messages"], BATCHES_SQL + "select queue, batch_no, batch_idx, seq from batched")
def batch_by_count(spark, sf):
    return batches(spark, sf).select("queue", "batch_no", "batch_idx", "seq")


@query("batch_by_count_sliced", ["messages"], BATCHES_SQL + "select queue, batch_no, batch_idx, seq from batched")
def batch_by_count_sliced(spark, sf):
    messages = table(spark, sf, "messages")
    return op.batch_by_count(messages, ["queue"], ["ts", "seq"], 5, rows_per_slice=20).select(
        "queue", "batch_no", "batch_idx", "seq")


GREEDY_SQL = """
placed as (select queue, seq, epoch_us(ts) as us, row_number() over (partition by queue order by ts, seq) as n
           from messages),
walk(queue, n, seq, opened, taken, batch_no) as (
  select queue, n, seq, us, cast(0 as bigint), cast(0 as bigint) from placed where n = 1
  union all
  select p.queue, p.n, p.seq,
         case when w.taken + 1 < 3 and p.us < w.opened + 43200000000 then w.opened else p.us end,
         case when w.taken + 1 < 3 and p.us < w.opened + 43200000000 then w.taken + 1 else 0 end,
         case when w.taken + 1 < 3 and p.us < w.opened + 43200000000 then w.batch_no else w.batch_no + 1 end
  from walk w join placed p on p.queue = w.queue and p.n = w.n + 1)
"""


@query("batch_by_count_or_time", ["messages"], "with " + GREEDY_SQL + """
select queue, batch_no, taken as batch_idx, seq from walk
""", recursive=True)
def batch_by_count_or_time(spark, sf):
    messages = table(spark, sf, "messages").select("queue", "seq", "ts")
    return op.batch_by_count_or_time(messages, ["queue"], ["seq"], "ts", 3, "12h").select(
        "queue", "batch_no", "batch_idx", "seq"
    )


@query("batch_by_count_or_time_sliced", ["messages"], "with " + GREEDY_SQL + """
select queue, batch_no, taken as batch_idx, seq from walk
""", recursive=True)
def batch_by_count_or_time_sliced(spark, sf):
    messages = table(spark, sf, "messages").select("queue", "seq", "ts")
    return op.batch_by_count_or_time(messages, ["queue"], ["seq"], "ts", 3, "12h", rows_per_slice=20).select(
        "queue", "batch_no", "batch_idx", "seq"
    )


DEDUPE_SQL = """
with opened(topic, ts) as (
  select topic, min(ts) from messages group by topic
  union all
  select m.topic, min(m.ts) from opened o join messages m on m.topic = o.topic and m.ts >= o.ts + interval '48' hour
  group by m.topic)
select topic, min(seq) as seq from messages join opened using (topic, ts) group by topic, ts
"""


@query("dedupe_by_message_id", ["messages"], DEDUPE_SQL, recursive=True)
def dedupe_by_message_id(spark, sf):
    messages = table(spark, sf, "messages").select("topic", "seq", "ts")
    return op.dedupe_by_message_id(messages, "topic", "ts", 172_800).select("topic", "seq")


@query("dedupe_by_message_id_sliced", ["messages"], DEDUPE_SQL, recursive=True)
def dedupe_by_message_id_sliced(spark, sf):
    messages = table(spark, sf, "messages").select("topic", "seq", "ts")
    return op.dedupe_by_message_id(messages, "topic", "ts", "48h", rows_per_slice=12).select("topic", "seq")


@query("dedupe_by_message_id_forever", ["messages"], """
select msg_id, arg_min(seq, (ts, seq)) as seq from messages group by msg_id
""")
def dedupe_by_message_id_forever(spark, sf):
    return op.dedupe_by_message_id(table(spark, sf, "messages")).select("msg_id", "seq")


@query("route_by_expression", ["messages"], """
select concat('store.', event_type, '.', cast(json_extract(raw, '$.k') as bigint) % 4) as route, count(*) as n
from messages group by 1
""")
def route_by_expression(spark, sf):
    messages = fn.message_context(table(spark, sf, "messages"))
    routed = op.route_by_expression(messages, "store.${!event_type}.${!try_variant_get(json, '$.k', 'bigint') % 4}")
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query("write_routes", ["messages"], "select event_type || '.' || qos as route, seq from messages")
def write_routes(spark, sf):
    routed = op.route_by_expression(table(spark, sf, "messages"), "${!event_type}.${!qos}")
    path = new_run_folder(spark, "routes")
    op.write_routes(routed.select("route", "seq"), path)
    return spark.read.parquet(path).select("route", "seq")


@query("publish_continue", ["messages"], """
select seq, case when mq_priority > 9 then 'invalid priority ' || mq_priority end as error,
       case when mq_priority > 9 then 'dead' else 'sent' end as status
from messages
""")
def publish_continue(spark, sf):
    sent, dead = op.publish_continue(table(spark, sf, "messages"), bad_priority())
    sent = sent.select("seq", F.lit(None).cast("string").alias("error"), F.lit("sent").alias("status"))
    return sent.unionByName(dead.select("seq", "error", F.lit("dead").alias("status")))


@query("publish_fail_fast", ["messages"], BATCHES_SQL + """
, firsts as (select *, min(case when err is not null then batch_idx end) over (partition by queue, batch_no) as f from batched)
select queue, batch_no, batch_idx, seq,
       case when f is null or batch_idx < f then 'sent' when batch_idx = f then 'failed' else 'not_attempted' end as status,
       case when batch_idx = f then 'batch #' || batch_idx || ': ' || err end as error
from firsts
""")
def publish_fail_fast(spark, sf):
    out = op.publish_fail_fast(batches(spark, sf), bad_priority(), ["queue", "batch_no"])
    return out.select("queue", "batch_no", "batch_idx", "seq", "status", "error")


@query("publish_transactional", ["messages"], BATCHES_SQL + """
select queue, batch_no, seq, max(err is not null) over (partition by queue, batch_no) as rolled_back from batched
""")
def publish_transactional(spark, sf):
    judged = op.judge_transactions(batches(spark, sf), bad_priority(), ["queue", "batch_no"])
    return judged.select("queue", "batch_no", "seq", "rolled_back")


NULL_BATCHES_SQL = """
with batched as (
  select case when seq % 3 > 0 then queue end as batch, seq as batch_idx,
         case when mq_priority > 9 and seq % 500 < 60 then 'invalid priority ' || mq_priority end as err
  from messages)
"""


def null_batches(spark, sf):
    """Batches named by queue, a third of all messages under no name; few messages fail."""
    messages = table(spark, sf, "messages")
    batch = F.when(F.col("seq") % 3 > 0, F.col("queue"))
    error = F.when(F.col("seq") % 500 < 60, bad_priority())
    return messages.select(batch.alias("batch"), F.col("seq").alias("batch_idx"), "mq_priority", error.alias("err"))


@query("publish_fail_fast_null_batch", ["messages"], NULL_BATCHES_SQL + """
, firsts as (select *, min(case when err is not null then batch_idx end) over (partition by batch) as f from batched)
select batch, batch_idx,
       case when f is null or batch_idx < f then 'sent' when batch_idx = f then 'failed' else 'not_attempted' end as status,
       case when batch_idx = f then 'batch #' || batch_idx || ': ' || err end as error
from firsts
""")
def publish_fail_fast_null_batch(spark, sf):
    out = op.publish_fail_fast(null_batches(spark, sf), F.col("err"), ["batch"])
    return out.select("batch", "batch_idx", "status", "error")


@query("publish_fail_fast_null_place", ["messages"], NULL_BATCHES_SQL + """
, placed as (select * replace (case when batch_idx % 7 > 0 then batch_idx // 2 end as batch_idx), batch_idx as seq from batched),
firsts as (
  select *, bool_or(err is not null) over (partition by batch) as stopped,
         coalesce(batch_idx, 1000000000) as place,
         min(case when err is not null then coalesce(batch_idx, 1000000000) end) over (partition by batch) as f from placed)
select batch, seq, case when not stopped or place < f or place = f and err is null then 'sent'
                        when place = f then 'failed' else 'not_attempted' end as status,
       case when place = f then 'batch #' || coalesce(batch_idx::varchar, '?') || ': ' || err end as error
from firsts
""")
def publish_fail_fast_null_place(spark, sf):
    """Two messages share a place, every seventh has none."""
    place = F.when(F.col("batch_idx") % 7 > 0, F.expr("batch_idx div 2"))
    placed = null_batches(spark, sf).withColumn("seq", F.col("batch_idx")).withColumn("batch_idx", place)
    return op.publish_fail_fast(placed, F.col("err"), ["batch"]).select("batch", "seq", "status", "error")


@query("publish_transactional_null_batch", ["messages"], NULL_BATCHES_SQL + """
select batch, batch_idx, max(err is not null) over (partition by batch) as rolled_back from batched
""")
def publish_transactional_null_batch(spark, sf):
    judged = op.judge_transactions(null_batches(spark, sf), F.col("err"), ["batch"])
    return judged.select("batch", "batch_idx", "rolled_back")


@query("rollback_batch_null_batch", ["messages"], NULL_BATCHES_SQL + """
select batch, batch_idx, 2 as attempt from (
  select *, max(err is not null) over (partition by batch) as nacked from batched) where nacked
""")
def rollback_batch_null_batch(spark, sf):
    delivered = null_batches(spark, sf).withColumn("attempt", F.lit(1))
    back = op.rollback_batch(delivered, delivered.where("err is not null"), ["batch"])
    return back.select("batch", "batch_idx", "attempt")


@query("batch_error_report", ["messages"], BATCHES_SQL + """
select queue, batch_no, count(*) as n_errors, arg_min(err, batch_idx) as first_error,
       string_agg(err, ';' order by batch_idx) as report
from batched where err is not null group by queue, batch_no
""")
def batch_error_report(spark, sf):
    judged = batches(spark, sf).withColumn("error", bad_priority())
    return op.batch_error_report(judged, ["queue", "batch_no"], "batch_idx", "error")


@query("mq_descriptor", ["messages"], """
select seq, 'MQSTR' as format, 819 as ccsid, 546 as encoding,
       case when seq % 7 > 0 then cast(mq_priority as varchar) end as priority, cast(null as varchar) as persistence,
       case when seq % 30 <= 24 then repeat('x', cast(seq % 30 as int)) end as correlation_id,
       seq % 30 > 24 as new_correlation_id
from messages
""")
def mq_descriptor(spark, sf):
    metadata = text_map(
        mq_priority=F.when(F.col("seq") % 7 > 0, F.col("mq_priority").cast("string")).otherwise("high"),
        mq_persistence=F.col("qos"),
        mq_correlation_id=F.repeat(F.lit("x"), (F.col("seq") % 30).cast("int")),
    )
    messages = table(spark, sf, "messages").withColumn("metadata", metadata)
    out = op.mq_descriptor(messages, ccsid="819", encoding="none", patterns=["^mq_prio", "_id$"])
    return out.select(
        "seq", "format", "ccsid", "encoding", F.col("priority").cast("string").alias("priority"),
        F.col("persistence").cast("string").alias("persistence"), "correlation_id", "new_correlation_id",
    )


@query("publish_headers", ["messages"], """
select seq, concat('mq_priority=', mq_priority, ';publish_source=host-1;publish_timestamp=',
                   strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), ';topic=', topic) as headers
from messages
""")
def publish_headers(spark, sf):
    metadata = text_map(
        jetstream_stream=F.lit("s"), jetstream_pending=F.col("seq"), mq_priority=F.col("mq_priority"),
        topic=F.col("topic"), qos=F.col("qos"),
    )
    headers = op.publish_headers(metadata, ["^mq_", "topic", "^jet"], published_at=F.col("ts"), host="host-1")
    return table(spark, sf, "messages").select("seq", fn.render_map(headers).alias("headers"))


@query("retained_last_value", ["messages"], """
select topic, arg_max(seq, (ts, seq)) as seq from messages where retained group by topic
""")
def retained_last_value(spark, sf):
    return op.retained_last_value(table(spark, sf, "messages")).select("topic", "seq")


@query("ordered_write", ["messages"], "select queue, seq, epoch_us(ts) as ts_us from messages")
def ordered_write(spark, sf):
    path = new_run_folder(spark, "ordered")
    op.ordered_write(table(spark, sf, "messages").select("queue", "seq", "ts"), path, ["queue"], ["ts", "seq"], 8)
    return spark.read.parquet(path).select("queue", "seq", us())


@query("dead_letter", ["envelopes", "messages", "triggers", "objects"], """
select 'parse' as stage, 'invalid event' as reason, body as msg from envelopes where not json_valid(body)
union all select 'publish', 'invalid priority ' || mq_priority, raw from messages where mq_priority > 9
union all
select 'retrieve', 'no such object', reference from triggers t
where not exists (select 1 from objects o where o.bucket || '/' || o.key = t.reference)
""")
def dead_letter(spark, sf):
    _, unparsed = op.parse_event_envelope(table(spark, sf, "envelopes"))
    _, unsent = op.publish_continue(table(spark, sf, "messages"), bad_priority())
    gone = located(spark, sf).join(table(spark, sf, "objects").select("bucket", "key"), ["bucket", "key"], "left_anti")
    return op.dead_letter(
        ("parse", unparsed, "error", "body"), ("publish", unsent, "error", "raw"),
        ("retrieve", gone, F.lit("no such object"), "reference"),
    )


@query("ack_outcome", ["messages"], """
with flags as (
  select seq, case seq % 5 when 0 then 'mqtt' when 1 then 'mq' when 2 then 'jetstream' when 3 then 'nats' else 'sqs' end
           as transport,
         seq // 5 % 2 = 1 as auto_ack, seq // 10 % 2 = 1 as context_ended, seq // 20 % 2 = 1 as connected,
         seq // 40 % 2 = 1 as failed, seq // 80 % 2 = 1 as closed, seq // 160 % 2 = 1 as parsed
  from messages)
select seq, case transport
    when 'mqtt' then case when auto_ack then 'ack' when context_ended or failed or not connected then 'redeliver' else 'ack' end
    when 'mq' then case when context_ended or failed or closed then 'redeliver' else 'ack' end
    when 'jetstream' then case when failed then 'redeliver' else 'ack' end
    when 'nats' then case when failed then 'lost' else 'ack' end
    else case when not parsed then 'redeliver' when failed then 'lost' else 'ack' end end as outcome
from flags
""")
def ack_outcome(spark, sf):
    names = F.lit(["mqtt", "mq", "jetstream", "nats", "sqs"])
    flags = {"auto_ack": 5, "context_ended": 10, "connected": 20, "failed": 40, "closed": 80, "parsed": 160}
    columns = {name: F.expr(f"(seq div {step}) % 2 = 1") for name, step in flags.items()}
    messages = table(spark, sf, "messages").withColumns(
        {"transport": F.get(names, (F.col("seq") % 5).cast("int")), **columns}
    )
    return op.ack_outcome(messages).select("seq", "outcome")


NOW = "2024-01-20 00:00:00"


def acks(spark, sf):
    """What has been acknowledged by ``NOW``."""
    done = table(spark, sf, "deliveries").where("outcome = 'ack'")
    return done.where(F.col("delivered_at") <= F.lit(NOW).cast("timestamp_ntz")).select("consumer", "seq")


def consumer_messages(spark, sf):
    consumer = F.concat(F.lit("c"), (F.col("seq") % 4).cast("string"))
    return table(spark, sf, "messages").select(consumer.alias("consumer"), "seq", "ts")


ACKS_SQL = f"""
with m as (select concat('c', seq % 4) as consumer, seq, ts from messages),
a as (select consumer, seq from deliveries where outcome = 'ack' and delivered_at <= timestamp '{NOW}')
"""


@query("pending_by_ack_policy", ["messages", "deliveries"], ACKS_SQL + """
select 'explicit' as policy, consumer, seq from m
where not exists (select 1 from a where a.consumer = m.consumer and a.seq = m.seq)
union all
select 'all', consumer, seq from m left join (select consumer, max(seq) as top from a group by consumer) using (consumer)
where top is null or seq > top
""")
def pending_by_ack_policy(spark, sf):
    messages, acked = consumer_messages(spark, sf).drop("ts"), acks(spark, sf)
    parts = [
        op.pending_by_ack_policy(messages, acked, policy).select(F.lit(policy).alias("policy"), "consumer", "seq")
        for policy in ("explicit", "all", "none")
    ]
    return op.merge_triggers(*parts)


@query("pending_null_consumer", ["messages", "deliveries"], ACKS_SQL + """
, m2 as (select nullif(consumer, 'c3') as consumer, seq from m), a2 as (select nullif(consumer, 'c3') as consumer, seq from a)
select 'explicit' as policy, consumer, seq from m2
where not exists (select 1 from a2 where a2.consumer is not distinct from m2.consumer and a2.seq = m2.seq)
union all
select 'all', consumer, seq from (
  select m2.*, (select max(seq) from a2 where a2.consumer is not distinct from m2.consumer) as top from m2)
where top is null or seq > top
""")
def pending_null_consumer(spark, sf):
    unnamed = F.nullif(F.col("consumer"), F.lit("c3"))
    messages = consumer_messages(spark, sf).drop("ts").withColumn("consumer", unnamed)
    acked = acks(spark, sf).withColumn("consumer", unnamed)
    parts = [
        op.pending_by_ack_policy(messages, acked, policy).select(F.lit(policy).alias("policy"), "consumer", "seq")
        for policy in ("explicit", "all")
    ]
    return op.merge_triggers(*parts)


REDELIVER_SQL = """
with latest as (
  select consumer, seq, max(attempt) as attempt, arg_max(delivered_at, attempt) as delivered_at,
         bool_or(outcome = 'ack') as acked
  from deliveries group by consumer, seq)
"""


@query("redeliver", ["deliveries"], REDELIVER_SQL + """
select case when attempt < 3 then 'due' else 'failed' end as status, consumer, seq,
       cast(case when attempt < 3 then attempt + 1 else attempt end as bigint) as attempt
from latest where not acked and delivered_at + interval '60' second <= timestamp '2024-01-20 00:00:00'
""")
def redeliver(spark, sf):
    now = F.lit(NOW).cast("timestamp_ntz")
    due, failed = op.redeliver(table(spark, sf, "deliveries"), now, 60, 3)
    parts = [
        df.select(F.lit(status).alias("status"), "consumer", "seq", F.col("attempt").cast("bigint").alias("attempt"))
        for status, df in (("due", due), ("failed", failed))
    ]
    return op.merge_triggers(*parts)


@query("redeliver_null_outcome", ["deliveries"], """
with unsettled as (
  select nullif(consumer, 'c3') as consumer, seq, attempt, case when seq % 11 > 0 then delivered_at end as delivered_at,
         case when seq % 7 > 0 then nullif(outcome, 'none') end as outcome
  from deliveries),
latest as (
  select consumer, seq, max(attempt) as attempt, max(delivered_at) as delivered_at,
         coalesce(bool_or(outcome = 'ack'), false) as acked
  from unsettled group by consumer, seq)
select case when attempt < 3 then 'due' else 'failed' end as status, consumer, seq,
       cast(case when attempt < 3 then attempt + 1 else attempt end as bigint) as attempt
from latest
where not acked and (delivered_at is null or delivered_at + interval '60' second <= timestamp '2024-01-20 00:00:00')
""")
def redeliver_null_outcome(spark, sf):
    """Attempts without an outcome, without a delivery time, and of a consumer without a name."""
    unsettled = table(spark, sf, "deliveries").withColumns({
        "consumer": F.nullif(F.col("consumer"), F.lit("c3")),
        "delivered_at": F.when(F.col("seq") % 11 > 0, F.col("delivered_at")),
        "outcome": F.when(F.col("seq") % 7 > 0, F.nullif(F.col("outcome"), F.lit("none"))),
    })
    due, failed = op.redeliver(unsettled, F.lit(NOW).cast("timestamp_ntz"), 60, 3)
    parts = [
        df.select(F.lit(status).alias("status"), "consumer", "seq", F.col("attempt").cast("bigint").alias("attempt"))
        for status, df in (("due", due), ("failed", failed))
    ]
    return op.merge_triggers(*parts)


@query("rollback_batch", ["messages"], BATCHES_SQL + """
select queue, batch_no, batch_idx, seq, 2 as attempt from batched b
where exists (select 1 from batched x where x.queue = b.queue and x.batch_no = b.batch_no and x.err is not null)
""")
def rollback_batch(spark, sf):
    delivered = batches(spark, sf).withColumn("attempt", F.lit(1))
    nacked = delivered.where(bad_priority().isNotNull())
    back = op.rollback_batch(delivered, nacked, ["queue", "batch_no"])
    return back.select("queue", "batch_no", "batch_idx", "seq", "attempt")


@query("consumer_lag", ["messages"], """
select event_type as stream, seq,
       count(*) over (partition by event_type order by seq rows unbounded preceding) as delivered,
       count(*) over (partition by event_type order by seq rows between 1 following and unbounded following) as pending
from messages
""")
def consumer_lag(spark, sf):
    messages = table(spark, sf, "messages").select(F.col("event_type").alias("stream"), "seq")
    return op.consumer_lag(messages).select("stream", "seq", "delivered", "pending")


@query("consumer_lag_sliced", ["messages"], """
select event_type as stream, seq,
       count(*) over (partition by event_type order by seq rows unbounded preceding) as delivered,
       count(*) over (partition by event_type order by seq rows between 1 following and unbounded following) as pending
from messages
""")
def consumer_lag_sliced(spark, sf):
    messages = table(spark, sf, "messages").select(F.col("event_type").alias("stream"), "seq")
    return op.consumer_lag(messages, rows_per_slice=150).select("stream", "seq", "delivered", "pending")


@query("resume_durable", ["messages", "deliveries"], ACKS_SQL + f""",
o as (select consumer, consumer in ('c0', 'c1') as durable,
             case when consumer <> 'c1' then max(seq) end as acked_seq, timestamp '{NOW}' as created_at
      from a where consumer <> 'c3' group by consumer),
j as (select *, max(seq) over (partition by consumer) as newest from m join o using (consumer)),
p as (select unnest(['all', 'last', 'new']) as policy)
select policy, consumer, seq from j, p
where case when durable and acked_seq is not null then seq > acked_seq
           when policy = 'all' then true when policy = 'last' then seq = newest else ts > created_at end
""")
def resume_durable(spark, sf):
    """c0 is durable, c1 too but has not acknowledged anything, c2 is not durable, c3 is unknown."""
    offsets = acks(spark, sf).where("consumer <> 'c3'").groupBy("consumer").agg(F.max("seq").alias("acked_seq"))
    offsets = offsets.select(
        "consumer", F.col("consumer").isin("c0", "c1").alias("durable"),
        F.when(F.col("consumer") != "c1", F.col("acked_seq")).alias("acked_seq"),
        F.lit(NOW).cast("timestamp_ntz").alias("created_at"),
    )
    messages = consumer_messages(spark, sf)
    parts = [
        op.resume_durable(messages, offsets, policy).select(F.lit(policy).alias("policy"), "consumer", "seq")
        for policy in ("all", "last", "new")
    ]
    return op.merge_triggers(*parts)


@query("resume_null_consumer", ["messages", "deliveries"], ACKS_SQL + f""",
m2 as (select nullif(consumer, 'c0') as consumer, seq, ts from m), a2 as (select nullif(consumer, 'c0') as consumer, seq from a),
o as (select consumer, consumer is null as durable, max(seq) as acked_seq, timestamp '{NOW}' as created_at
      from a2 where consumer is distinct from 'c3' group by consumer),
j as (select m2.*, o.durable, o.acked_seq, o.created_at, max(m2.seq) over (partition by m2.consumer) as newest
      from m2 join o on m2.consumer is not distinct from o.consumer),
p as (select unnest(['all', 'last', 'new']) as policy)
select policy, consumer, seq from j, p
where case when durable and acked_seq is not null then seq > acked_seq
           when policy = 'all' then true when policy = 'last' then seq = newest else ts > created_at end
""")
def resume_null_consumer(spark, sf):
    """The durable consumer has no name."""
    unnamed = F.nullif(F.col("consumer"), F.lit("c0"))
    offsets = acks(spark, sf).where("consumer <> 'c3'").groupBy(unnamed.alias("consumer")).agg(F.max("seq").alias("acked_seq"))
    offsets = offsets.select(
        "consumer", F.col("consumer").isNull().alias("durable"), "acked_seq", F.lit(NOW).cast("timestamp_ntz").alias("created_at"))
    messages = consumer_messages(spark, sf).withColumn("consumer", unnamed)
    parts = [
        op.resume_durable(messages, offsets, policy).select(F.lit(policy).alias("policy"), "consumer", "seq")
        for policy in ("all", "last", "new")
    ]
    return op.merge_triggers(*parts)


@query("component_metrics", ["messages"], """
with samples as (
  select event_type as name, case seq % 3 when 0 then 'counter' when 1 then 'gauge' else 'timer' end as kind,
         cast(value as decimal(12, 2)) as value, ts, seq from messages)
select name, kind, cast(sum(value) filter (kind = 'counter') as varchar) as counter,
       cast(arg_max(value, (ts, seq)) filter (kind = 'gauge') as varchar) as gauge,
       count(*) filter (kind = 'timer') as timer_count,
       cast(sum(value) filter (kind = 'timer') as varchar) as timer_sum,
       cast(min(value) filter (kind = 'timer') as varchar) as timer_min,
       cast(max(value) filter (kind = 'timer') as varchar) as timer_max,
       cast(cast(sum(value) filter (kind = 'timer') * 100 as bigint) // nullif(count(*) filter (kind = 'timer'), 0)
            as varchar) as timer_avg_cents
from samples group by name, kind
""")
def component_metrics(spark, sf):
    kinds = F.lit(["counter", "gauge", "timer"])
    samples = table(spark, sf, "messages").select(
        F.col("event_type").alias("name"), F.get(kinds, (F.col("seq") % 3).cast("int")).alias("kind"),
        F.col("value").cast("decimal(12,2)").alias("value"), "ts", "seq",
    )
    out = op.component_metrics(samples, ("ts", "seq"))
    exact = {c: F.col(c).cast("string") for c in ("counter", "gauge", "timer_sum", "timer_min", "timer_max")}
    cents = F.floor(F.col("timer_avg") * 100).cast("bigint").cast("string")  # in whole cents, rounded down
    return out.withColumns({**exact, "timer_avg_cents": cents}).drop("timer_avg")


PROCESSED_SQL = "select seq, upper(event_type) as kind, value * 2 as doubled from messages where retained"


@query("apply_processor", ["messages"], PROCESSED_SQL)
def apply_processor(spark, sf):
    return op.apply_processor(table(spark, sf, "messages"), lambda df: df.where("retained").select(
        "seq", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("doubled")
    ))


@query("apply_processor_arrow", ["messages"], PROCESSED_SQL)
def apply_processor_arrow(spark, sf):
    import pyarrow as pa

    def double(batches):
        for rb in batches:
            rb = rb.filter(rb.column("retained"))
            columns = [rb.column("seq"), pc.utf8_upper(rb.column("event_type")), pc.multiply(rb.column("value"), 2.0)]
            yield pa.RecordBatch.from_arrays(columns, names=["seq", "kind", "doubled"])

    messages = table(spark, sf, "messages").select("seq", "event_type", "value", "retained")
    return op.apply_processor(messages, double, "seq bigint, kind string, doubled double", arrow=True)


@query("json_parser", ["envelopes"], """
select doc_id, case when json_valid(body) then json_extract_string(body, '$.source') end as source,
       case when json_valid(body) then json_extract_string(body, '$.MessageId') end as message_id,
       not json_valid(body) as bad
from envelopes
""")
def json_parser(spark, sf):
    schema = T.StructType([T.StructField("source", T.StringType()), T.StructField("MessageId", T.StringType())])
    rows, bad = op.json_parser(table(spark, sf, "envelopes"), schema, "body")
    good = rows.select("doc_id", "source", F.col("MessageId").alias("message_id"), F.lit(False).alias("bad"))
    return good.unionByName(bad.select("doc_id", F.lit(True).alias("bad")), allowMissingColumns=True)


@query("stream_sink", ["messages"], "select seq, topic, raw from messages")
def stream_sink_query(spark, sf):
    run = new_run_folder(spark, "stream_sink")
    rows = messages_stream(spark, sf).select("seq", "topic", "raw")
    stream_sink(rows, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return read_sink(spark, f"{run}/out")


FLOW_SQL = """
select seq, concat('store.', event_type) as route, case when mq_priority <= 9 then 'sent' else 'dead' end as outcome
from messages where starts_with(subject, 'events.click.') or starts_with(subject, 'events.view.')
"""


@query("stream_pipeline", ["messages"], FLOW_SQL)
def stream_pipeline_query(spark, sf):
    """Sent and dead messages in one pass, a folder each."""
    run = new_run_folder(spark, "stream_pipeline")
    outcome = F.when(bad_priority().isNull(), "sent").otherwise("dead").alias("outcome")
    stream_flow(
        messages_stream(spark, sf),
        lambda df: op.filter_subject(df, "subject", "events.click.>", "events.view.>"),
        lambda df: op.route_by_expression(df, "store.${!event_type}").select("seq", "route", outcome),
        path=f"{run}/out", checkpoint=f"{run}/checkpoint", by="outcome",
    ).awaitTermination()
    return read_sink(spark, f"{run}/out").select("seq", "route", "outcome")


@query("stream_flow", ["messages"], """
select seq, concat('store.', event_type) as route from messages
where (starts_with(subject, 'events.click.') or starts_with(subject, 'events.view.')) and mq_priority <= 9
""")
def stream_flow_query(spark, sf):
    run = new_run_folder(spark, "stream_flow")
    stream_flow(
        messages_stream(spark, sf),
        lambda df: op.filter_subject(df, "subject", "events.click.>", "events.view.>"),
        lambda df: op.publish_continue(df, bad_priority())[0],
        lambda df: op.route_by_expression(df, "store.${!event_type}").select("seq", "route"),
        path=f"{run}/out", checkpoint=f"{run}/checkpoint",
    ).awaitTermination()
    return read_sink(spark, f"{run}/out")


@query("stream_dedupe", ["messages"], DEDUPE_SQL, recursive=True)
def stream_dedupe_query(spark, sf):
    run = new_run_folder(spark, "stream_dedupe")
    rows = messages_stream(spark, sf).select("topic", "seq", "ts")
    stream_dedupe(rows, "topic", "ts", 172_800, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return read_sink(spark, f"{run}/out").select("topic", "seq")


# A batch is out once it is full, or its time is up by the newest message of all.
@query("stream_batcher", ["messages"], "with " + GREEDY_SQL + """
, judged as (select *, count(*) over (partition by queue, batch_no) as size from walk)
select queue, batch_no, taken as batch_idx, seq from judged
where size = 3 or opened + 43200000000 <= (select max(us) from placed)
""", recursive=True)
def stream_batcher_query(spark, sf):
    run = new_run_folder(spark, "stream_batcher")
    rows = messages_stream(spark, sf).select("queue", "seq", "ts")
    stream_batcher(rows, ["queue"], "ts", 3, 43_200_000, f"{run}/out", f"{run}/checkpoint").awaitTermination()
    return read_sink(spark, f"{run}/out").select("queue", "batch_no", "batch_idx", "seq")


@query("stream_redelivery", ["deliveries"], REDELIVER_SQL + """
, due as (select *, epoch_us(delivered_at) + 60000000 as due_us from latest where not acked)
select case when attempt < 3 then 'due' else 'failed' end as status, consumer, seq,
       cast(case when attempt < 3 then attempt + 1 else attempt end as bigint) as attempt, due_us
from due where due_us <= (select max(epoch_us(delivered_at)) from deliveries)
""")
def stream_redelivery_query(spark, sf):
    run = new_run_folder(spark, "stream_redelivery")
    attempts = derive(spark, "deliveries", messages=messages_stream(spark, sf))
    stream_redelivery(attempts, 60, f"{run}/out", f"{run}/checkpoint", 3).awaitTermination()
    return read_sink(spark, f"{run}/out").select("status", "consumer", "seq", "attempt", "due_us")


@query("stream_metrics", ["messages"], """
select event_type = 'click' as click, count(*) as n_rows, sum(length(raw))::bigint as n_bytes, max(seq) as last_seq
from messages group by 1
""")
def stream_metrics_query(spark, sf):
    """Rows, bytes and the last message of two outputs, counted while they are written and summed over the micro-batches."""
    messages = messages_stream(spark, sf)
    totals = []
    for click in (True, False):
        run = new_run_folder(spark, "stream_metrics")
        part = messages.where((F.col("event_type") == "click") == click).select("seq", "raw")
        counted, _ = op.observed(part, "out", {
            "n_rows": F.count(F.lit(1)), "n_bytes": F.coalesce(F.sum(F.length("raw")), F.lit(0)), "last_seq": F.max("seq")})
        running = stream_sink(counted, f"{run}/out", f"{run}/checkpoint")
        running.awaitTermination()
        seen = [m for m in observed_progress(running, "out") if m["n_rows"]]
        totals.append((click, sum(m["n_rows"] for m in seen), sum(m["n_bytes"] for m in seen), max(m["last_seq"] for m in seen)))
    return spark.createDataFrame(totals, "click boolean, n_rows bigint, n_bytes bigint, last_seq bigint")
