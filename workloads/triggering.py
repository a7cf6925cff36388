"""Queries on events, triggers and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewire import functions as fn
from tidewire import operators as op
from tidewire import sources as src
from tidewire.session import new_run_folder
from tidewire.streaming import read_sink, retrieve_stream, retrieve_stream_waiting

from .reading import EVENT_FIELDS_SQL, POLLED_SQL, events_stream, messages_stream, previous_listing, text_map, us
from .registry import query
from .views import derive, table


def parsed_events(spark, sf):
    return op.parse_event_envelope(table(spark, sf, "envelopes"))[0]


@query("filter_events", ["envelopes"], EVENT_FIELDS_SQL + """
select doc_id, json_extract_string(event, '$.detail.eventName') as event_name,
       json_extract_string(event, '$.detail.object.key') as key
from opened
where ok and json_extract_string(event, '$.source') = 'aws.s3'
  and json_extract_string(event, '$."detail-type"') = 'Object Created'
  and json_extract_string(event, '$.detail.bucket.name') = 'web'
  and starts_with(json_extract_string(event, '$.detail.eventName'), 'ObjectCreated:')
""")
def filter_events(spark, sf):
    kept = op.filter_events(
        parsed_events(spark, sf), "aws.s3", "Object Created", {"bucket.name": "web"}, "ObjectCreated:*"
    )
    detail = F.col("event.detail")
    return kept.select(
        "doc_id", F.try_variant_get(detail, "$.eventName", "string").alias("event_name"),
        F.try_variant_get(detail, "$.object.key", "string").alias("key"),
    )


TIME_US_SQL = "epoch_us(cast(json_extract_string(event, '$.time') as timestamptz))"
REFERENCE_SQL = f"""
case when json_extract_string(event, '$.source') = 'aws.s3'
     then concat('s3://', json_extract_string(event, '$.detail.bucket.name'), '/',
                 json_extract_string(event, '$.detail.object.key'))
     else coalesce(json_extract_string(event, '$.resources[0]'),
                   concat(json_extract_string(event, '$.source'), '-', {TIME_US_SQL} * 1000)) end
"""
S3_MAP_SQL = """
case when json_extract_string(event, '$.source') = 'aws.s3' then concat(
  'bucket=', json_extract_string(event, '$.detail.bucket.name'),
  ';etag=', trim(json_extract_string(event, '$.detail.object.etag'), '"'),
  ';event_name=', json_extract_string(event, '$.detail.eventName'),
  ';key=', json_extract_string(event, '$.detail.object.key'),
  case when json_type(event, '$.detail.object.size') <> 'VARCHAR'
       then ';size=' || cast(json_extract(event, '$.detail.object.size') as bigint) else '' end) else '' end
"""


@query("event_reference", ["envelopes"], EVENT_FIELDS_SQL + f"""
select doc_id, {REFERENCE_SQL} as reference from opened where ok
""")
def event_reference(spark, sf):
    return parsed_events(spark, sf).select("doc_id", fn.event_reference(F.col("event")).alias("reference"))


@query("s3_event_metadata", ["envelopes"], EVENT_FIELDS_SQL + f"""
select doc_id, {S3_MAP_SQL} as metadata from opened where ok
""")
def s3_event_metadata(spark, sf):
    return parsed_events(spark, sf).select(
        "doc_id", fn.render_map(fn.s3_event_metadata(F.col("event"))).alias("metadata")
    )


@query("event_metadata", ["envelopes"], EVENT_FIELDS_SQL + f"""
, pairs as (
  select doc_id, event, unnest(json_keys(event, '$.detail')) as k from opened where ok),
details as (
  select doc_id, list('detail_' || k || '=' || json_extract_string(event, '$.detail."' || k || '"')) as d
  from pairs group by doc_id)
select o.doc_id, array_to_string(list_sort(list_concat(d, case when json_extract_string(event, '$.source') = 'aws.s3' then string_split({S3_MAP_SQL}, ';') else [] end, [
         'event_source=' || json_extract_string(event, '$.source'),
         'detail_type=' || json_extract_string(event, '$."detail-type"'),
         'event_time=' || ({TIME_US_SQL} // 1000000),
         'event_region=' || json_extract_string(event, '$.region'),
         'event_account=' || json_extract_string(event, '$.account'),
         'event_resources=[' || coalesce(json_extract_string(event, '$.resources[0]'), '') || ']'])), ';') as metadata
from opened o join details using (doc_id) where ok
""")
def event_metadata(spark, sf):
    return parsed_events(spark, sf).select(
        "doc_id", fn.render_map(fn.event_metadata(F.col("event"))).alias("metadata")
    )


@query("make_trigger", ["envelopes"], EVENT_FIELDS_SQL + f"""
select doc_id, 'eventbridge' as source, {REFERENCE_SQL} as reference, {TIME_US_SQL} as ts_us,
       json_extract_string(event, '$.detail.bucket.name') as bucket,
       json_extract_string(event, '$.detail.object.key') as key,
       case when json_type(event, '$.detail.object.size') <> 'VARCHAR'
            then cast(cast(json_extract(event, '$.detail.object.size') as bigint) as varchar) end as size,
       trim(json_extract_string(event, '$.detail.object.etag'), '"') as etag,
       json_extract_string(event, '$.detail.eventName') as event_name
from opened where ok
""")
def make_trigger(spark, sf):
    e = F.col("event")
    triggers = op.make_trigger(
        parsed_events(spark, sf), F.lit("eventbridge"), fn.event_reference(e), fn.event_metadata(e), e["time"],
        keep=("doc_id",),
    )
    size = F.col("size").cast("string").alias("size")
    return triggers.select("doc_id", "source", "reference", us(), "bucket", "key", size, "etag", "event_name")


@query("resolve_location", ["triggers"], """
select trigger_id,
       case when trigger_id % 6 = 4 then null when trigger_id % 6 = 5 then 'nested'
            else split_part(reference, '/', 1) end as bucket,
       case when trigger_id % 6 = 4 then null when trigger_id % 6 = 5 then 'k' || trigger_id
            when trigger_id % 6 = 2 then '' else substr(reference, instr(reference, '/') + 1) end as key,
       trigger_id % 6 = 4 as unresolved
from triggers
""")
def resolve_location(spark, sf):
    way, ref = F.col("trigger_id") % 6, F.col("reference")
    bucket = F.substring_index(ref, "/", 1)
    key = F.substr(ref, F.instr(ref, "/") + 1)
    mixed = table(spark, sf, "triggers").withColumns({
        "metadata": F.when(way == 0, F.create_map(F.lit("bucket"), bucket, F.lit("key"), key)).when(
            way == 5, F.create_map(
                F.lit("bucket"), F.lit('{"name":"nested"}'),
                F.lit("object"), F.concat(F.lit('{"key":"k'), F.col("trigger_id").cast("string"), F.lit('"}')))),
        "reference": F.when(way == 0, "elsewhere/x").when(way == 2, F.concat(bucket, F.lit("/"))).when(
            way == 3, F.concat(F.lit("s3://"), ref)).when(way >= 4, "no-slash").otherwise(ref),
    })
    return op.resolve_location(mixed).select(
        "trigger_id", "bucket", "key", F.col("location_error").isNotNull().alias("unresolved")
    )


LOCATED_SQL = """
with located as (select *, split_part(reference, '/', 1) as bucket,
                        substr(reference, instr(reference, '/') + 1) as key from triggers)
"""


def located(spark, sf):
    return op.resolve_location(table(spark, sf, "triggers"))


@query("filter_key_affix", ["triggers"], LOCATED_SQL + """
select trigger_id, bucket, key from located where starts_with(key, 'en/') and ends_with(key, '.txt')
""")
def filter_key_affix(spark, sf):
    return op.filter_key_affix(located(spark, sf), prefix="en/", suffix=".txt").select("trigger_id", "bucket", "key")


@query("filter_object_attrs", ["objects"], """
select bucket, key, size from objects
where (ends_with(key, '.html') or ends_with(key, '.txt')) and size between 500 and 20000
""")
def filter_object_attrs(spark, sf):
    kept = op.filter_object_attrs(table(spark, sf, "objects"), [".html", ".txt"], 500, 20000)
    return kept.select("bucket", "key", "size")


@query("retrieve_lenient", ["triggers", "objects"], LOCATED_SQL + """
select trigger_id, bucket, key, size, md5(body) as body_md5 from located join objects using (bucket, key)
""")
def retrieve_lenient(spark, sf):
    found = op.retrieve_lenient(located(spark, sf), table(spark, sf, "objects"))
    return found.select("trigger_id", "bucket", "key", "size", F.md5("body").alias("body_md5"))


def strict_batches(spark, sf):
    """Eight triggers per batch."""
    return located(spark, sf).withColumn("batch_id", F.expr("trigger_id div 8"))


STRICT_SQL = LOCATED_SQL + """
, wanted as (select *, trigger_id // 8 as batch_id from located where ends_with(key, '.txt') and starts_with(key, 'e')),
judged as (select w.*, o.doc_id is null as failed, o.size from wanted w left join objects o using (bucket, key))
"""


@query("retrieve_strict", ["triggers", "objects"], STRICT_SQL + """
select batch_id, trigger_id, key, size from (
  select *, max(failed) over (partition by batch_id) as bad from judged) where not bad
""")
def retrieve_strict(spark, sf):
    rows, _ = op.retrieve_strict(strict_batches(spark, sf), table(spark, sf, "objects"), prefix="e", suffix=".txt")
    return rows.select("batch_id", "trigger_id", "key", "size")


@query("retrieve_strict_null_batch", ["triggers", "objects"], LOCATED_SQL + """
, wanted as (select *, case when trigger_id % 3 > 0 then trigger_id // 8 % 50 end as batch_id from located),
judged as (select w.*, o.doc_id is null as failed from wanted w left join objects o using (bucket, key))
select batch_id, trigger_id from (
  select *, max(failed) over (partition by batch_id) as bad from judged) where not bad
""")
def retrieve_strict_null_batch(spark, sf):
    batch = F.when(F.col("trigger_id") % 3 > 0, F.expr("trigger_id div 8 % 50"))
    rows, _ = op.retrieve_strict(located(spark, sf).withColumn("batch_id", batch), table(spark, sf, "objects"))
    return rows.select("batch_id", "trigger_id")


@query("retrieve_strict_failures", ["triggers", "objects"], LOCATED_SQL + """
select trigger_id // 8 as batch_id, cast(count(*) as bigint) as n_failed
from located left join objects using (bucket, key) where doc_id is null group by all
""")
def retrieve_strict_failures(spark, sf):
    _, failures = op.retrieve_strict(strict_batches(spark, sf), table(spark, sf, "objects"))
    return failures.select("batch_id", "n_failed")


@query("retrieve_enriched", ["triggers", "objects"], LOCATED_SQL + """
select trigger_id, concat('etag=', etag, ';trigger_id=', trigger_id, ';trigger_reference=', reference,
         ';trigger_source=', source, ';trigger_timestamp=', epoch_us(ts) * 1000) as metadata, length(body) as body_chars
from located join objects using (bucket, key)
""")
def retrieve_enriched(spark, sf):
    triggers = located(spark, sf).withColumn("metadata", text_map(id=F.col("trigger_id")))
    objects = table(spark, sf, "objects").withColumn("user_metadata", text_map(etag=F.col("etag")))
    return op.retrieve_enriched(triggers, objects).select(
        "trigger_id", fn.render_map("metadata").alias("metadata"), F.length("body").cast("bigint").alias("body_chars")
    )


@query("missing_objects", ["triggers", "objects"], LOCATED_SQL + """
select bucket, key, count(*) as n_triggers, min(trigger_id) as first_trigger
from located l where not exists (select 1 from objects o where o.bucket = l.bucket and o.key = l.key)
group by bucket, key
""")
def missing_objects(spark, sf):
    return op.missing_objects(located(spark, sf), table(spark, sf, "objects"))


@query("retrieve_stream", ["triggers", "objects"], LOCATED_SQL + """
select trigger_id, bucket, key, md5(body) as body_md5 from located join objects using (bucket, key)
where ends_with(key, '.txt')
""")
def retrieve_stream_query(spark, sf):
    triggers = derive(spark, "triggers", events=events_stream(spark, sf), documents=table(spark, sf, "documents"))
    wanted = op.filter_key_affix(op.resolve_location(triggers), suffix=".txt")
    run = new_run_folder(spark, "retrieve_stream")
    retrieve_stream(
        wanted, lambda: table(spark, sf, "objects"), f"{run}/out", f"{run}/checkpoint",
        lambda df: df.select("trigger_id", "bucket", "key", F.md5("body").alias("body_md5")),
    ).awaitTermination()
    return read_sink(spark, f"{run}/out")


# Uploads and the triggers that ask for them come from one log; a third of a day later at most, or half a day before.
@query("retrieve_stream_waiting", ["messages"], """
with asked as (select seq, queue || '/' || seq % 3 as key, ts from messages where event_type = 'click'),
landed as (select seq, queue || '/' || seq % 3 as key, ts, 'v' || seq as etag from messages where event_type = 'view'),
pairs as (
  select a.seq, a.key, l.etag from asked a join landed l
  on a.key = l.key and l.ts between a.ts - interval '12' hour and a.ts + interval '8' hour),
reached as (select least((select max(ts) from asked), (select max(ts) from landed)) as t)
select seq, key, etag, true as found from pairs
union all
select seq, key, null, false from asked a, reached
where a.ts + interval '8' hour < t and not exists (select 1 from pairs p where p.seq = a.seq)
""")
def retrieve_stream_waiting_query(spark, sf):
    """Triggers whose object comes first, later, or never."""
    key = F.concat("queue", F.lit("/"), (F.col("seq") % 3).cast("string")).alias("key")
    log = messages_stream(spark, sf)
    asked = log.where("event_type = 'click'").select("seq", F.lit("uploads").alias("bucket"), key, "ts")
    landed = log.where("event_type = 'view'").select(
        F.lit("uploads").alias("bucket"), key, F.concat(F.lit("v"), F.col("seq").cast("string")).alias("etag"), F.col("ts").alias("modified"))
    run = new_run_folder(spark, "retrieve_stream_waiting")
    retrieve_stream_waiting(asked, landed, f"{run}/out", f"{run}/checkpoint", "8h", "12h").awaitTermination()
    return read_sink(spark, f"{run}/out").select("seq", "key", "etag", "found")


@query("merge_triggers", ["triggers", "objects"], """
select source, reference, cast(epoch_us(ts) as varchar) as ts_us from triggers
union all select source, reference, null from (""" + POLLED_SQL + """) p
""")
def merge_triggers(spark, sf):
    polled = src.poll_listing_triggers(table(spark, sf, "objects"), previous_listing(spark, sf))
    merged = op.merge_triggers(table(spark, sf, "triggers"), polled)
    return merged.select("source", "reference", fn.micros("ts").cast("string").alias("ts_us"))


@query("dedupe_triggers", ["triggers"], """
select reference, arg_min(trigger_id, (ts, trigger_id)) as trigger_id from triggers group by reference
""")
def dedupe_triggers(spark, sf):
    return op.dedupe_triggers(table(spark, sf, "triggers")).select("reference", "trigger_id")


@query("dedupe_triggers_by_etag", ["triggers"], """
select reference, etag, min(trigger_id) as trigger_id
from (select *, 'v' || (trigger_id // 700 % 2) as etag from triggers) group by reference, etag
""")
def dedupe_triggers_by_etag(spark, sf):
    tagged = table(spark, sf, "triggers").withColumn("etag", F.expr("concat('v', (trigger_id div 700) % 2)"))
    return op.dedupe_triggers(tagged, with_etag=True).select("reference", "etag", "trigger_id")


@query("order_triggers", ["triggers"], """
select cast(row_number() over (order by ts, trigger_id) as bigint) as rank, trigger_id, source from triggers
""")
def order_triggers(spark, sf):
    return op.order_triggers(table(spark, sf, "triggers")).select("rank", "trigger_id", "source")


@query("order_triggers_sliced", ["triggers"], """
select cast(row_number() over (order by ts, trigger_id) as bigint) as rank, trigger_id, source from triggers
""")
def order_triggers_sliced(spark, sf):
    return op.order_triggers(table(spark, sf, "triggers"), rows_per_slice=700).select("rank", "trigger_id", "source")


@query("expire_triggers", ["triggers"], """
select trigger_id, epoch_us(ts) as ts_us from triggers
where ts >= timestamp '2024-01-25 00:00:00' - interval '864000' second
""")
def expire_triggers(spark, sf):
    now = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    return op.expire_triggers(table(spark, sf, "triggers"), now, 864000).select("trigger_id", us())


@query("limit_batch", ["triggers"], """
with ranked as (select *, row_number() over (partition by source order by ts, trigger_id) as n from triggers)
select 'asked' as read, source, trigger_id from ranked where n <= 25
union all select 'queue', source, trigger_id from ranked where n <= 7
union all select 'default', source, trigger_id from ranked where n <= 10
""")
def limit_batch(spark, sf):
    triggers = table(spark, sf, "triggers")
    reads = {"asked": op.limit_batch(triggers, 25), "queue": op.limit_batch(triggers, 25, cap=7),
             "default": op.limit_batch(triggers, 0)}
    parts = [df.select(F.lit(name).alias("read"), "source", "trigger_id") for name, df in reads.items()]
    return op.merge_triggers(*parts)


@query("fetch_savings", ["triggers", "objects"], LOCATED_SQL + """
, judged as (
  select source, starts_with(key, 'e') and (ends_with(key, '.txt') or ends_with(key, '.html')) as keep,
         doc_id is not null as present
  from located left join (select bucket, key, doc_id from objects) using (bucket, key))
select source, count(*) as seen, count(*) filter (not keep) as filtered_out,
       count(*) filter (keep and present) as fetched, count(*) filter (keep and not present) as missing,
       count(*) filter (not keep) * 100 // count(*) as avoided_pct
from judged group by source
""")
def fetch_savings(spark, sf):
    keep = op.key_affix(F.col("key"), prefix="e") & op.object_attrs(F.col("key"), F.lit(None), [".txt", ".html"])
    return op.fetch_savings(located(spark, sf), table(spark, sf, "objects"), keep)


@query("retrieved_routes", ["triggers", "objects"], LOCATED_SQL + """
select concat('store.', split_part(key, '/', 1), '.', source) as route, count(*) as n_messages
from located join objects using (bucket, key) where ends_with(key, '.txt') group by 1
""")
def retrieved_routes(spark, sf):
    wanted = op.filter_key_affix(located(spark, sf), suffix=".txt")
    found = op.retrieve_lenient(wanted, table(spark, sf, "objects"))
    routed = op.route_by_expression(found, "store.${!split_part(key, '/', 1)}.${!source}")
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n_messages"))
