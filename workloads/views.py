"""The message-model tables derived from the given ones. Each view is one SQL text that Spark and DuckDB both run.

Spark binds the tables it names as DataFrames; DuckDB gets the texts as common table expressions. ``STRING`` is written
``varchar`` for DuckDB. Everything is integer arithmetic over the given rows: no random numbers, no clock.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tidewire.session import configure

BASE_TABLES = ("events", "documents", "pages", "conversations", "labels")

MESSAGES = """
select event_id + 1 as seq, ts,
       concat('events.', event_type, '.', cast(user_id as string)) as subject,
       concat('events/', event_type, '/', cast(user_id as string)) as topic,
       cast(user_id as string) as queue, props as raw,
       concat('m', cast(event_id % 9000 as string)) as msg_id,
       event_id % 3 as qos, event_id % 10 = 0 as retained, event_id % 12 as mq_priority, value, event_type
from {events}
"""

OBJECTS = """
select concat('corpus-', source) as bucket, concat(lang, '/', cast(doc_id as string), '.txt') as key,
       n_chars as size, md5(text) as etag, text as body, doc_id
from {documents}
union all
select 'web' as bucket, concat('html/', cast(page_id as string), '.html') as key,
       cast(length(html) as bigint) as size, md5(html) as etag, html as body, 1000000000 + page_id as doc_id
from {pages}
"""

TRIGGERS = """
select e.event_id as trigger_id,
       case when e.event_type = 'view' then 'eventbridge' when e.event_type = 'click' then 's3-polling' else 'sqs' end
         as source,
       case when d.doc_id is null then concat('corpus-missing/gone/', cast(e.slot as string), '.txt')
            else concat('corpus-', d.source, '/', d.lang, '/', cast(d.doc_id as string), '.txt') end as reference,
       e.ts
from (select event_id, event_type, ts,
             event_id % (select cast(floor(count(*) * 6 / 5) as bigint) from {documents}) as slot from {events}) e
left join (select doc_id, source, lang from {documents}) d on d.doc_id = e.slot
"""

# Attempts 1..(1 + seq % 3), 30 s apart; only the last can be acknowledged.
DELIVERIES = """
select concat('c', cast(seq % 4 as string)) as consumer, seq, attempt,
       ts + (attempt - 1) * interval '30' second as delivered_at,
       case when attempt < 1 + seq % 3 then case when attempt % 2 = 1 then 'nack' else 'none' end
            when seq % 5 < 3 then 'ack' when seq % 5 = 3 then 'nack' else 'none' end as outcome
from (select seq, ts, 1 as attempt from {messages}
      union all select seq, ts, 2 from {messages} where seq % 3 >= 1
      union all select seq, ts, 3 from {messages} where seq % 3 = 2) a
"""

# Object-store events as queue bodies: every 3rd wrapped, every 17th cut short, some of other services.
ENVELOPES = """
select doc_id,
       case when doc_id % 17 = 0 then substring(wrapped, 1, length(wrapped) - 2) else wrapped end as body
from (select doc_id,
             case when doc_id % 3 = 0
                  then concat('{{"Type":"Notification","MessageId":"n', cast(doc_id as string), '","Message":"',
                              replace(replace(event, chr(92), concat(chr(92), chr(92))), '"', concat(chr(92), '"')), '"}}')
                  else event end as wrapped
      from (select doc_id,
                   case when doc_id % 5 = 1
                        then concat('{{"source":"aws.ec2","detail-type":"State Change","detail":{{"instance-id":"i-',
                                    cast(doc_id as string), '","state":"running"}},"time":"2024-01-',
                                    lpad(cast(1 + doc_id % 28 as string), 2, '0'), 'T10:00:00Z","region":"us-east-1",',
                                    '"account":"123456789012","resources":',
                                    case when doc_id % 2 = 0 then '[]' else
                                      concat('["arn:aws:ec2:instance/i-', cast(doc_id as string), '"]') end, '}}')
                        else concat('{{"source":"aws.s3","detail-type":"Object Created","detail":{{"bucket":{{"name":"',
                                    bucket, '"}},"eventName":"', case when doc_id % 4 = 0 then 'ObjectRemoved:Delete'
                                      when doc_id % 4 = 1 then 'ObjectCreated:Copy' else 'ObjectCreated:Put' end,
                                    '","object":{{"etag":"', chr(92), '"', etag, chr(92), '"","key":"', key, '","size":',
                                    case when doc_id % 7 = 0 then concat('"', cast(size as string), '"')
                                         else cast(size as string) end,
                                    '}}}},"time":"2024-01-', lpad(cast(1 + doc_id % 28 as string), 2, '0'),
                                    'T10:00:00Z","region":"eu-west-1","account":"123456789012",',
                                    '"resources":["arn:aws:s3:::', bucket, '"]}}') end as event
            from {objects}) x) y
"""

# name -> (SQL text, tables and views it reads)
VIEWS = {
    "messages": (MESSAGES, ["events"]),
    "objects": (OBJECTS, ["documents", "pages"]),
    "triggers": (TRIGGERS, ["events", "documents"]),
    "deliveries": (DELIVERIES, ["messages"]),
    "envelopes": (ENVELOPES, ["objects"]),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view derived from the given tables."""
    configure(spark)
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    text, inputs = VIEWS[name]
    return spark.sql(text, **{i: table(spark, sf_dir, i) for i in inputs})


def derive(spark: SparkSession, name: str, **inputs: DataFrame) -> DataFrame:
    """A view over DataFrames of the caller's choice, for instance streams."""
    return spark.sql(VIEWS[name][0], **inputs)


def _needed(names: list[str]) -> list[str]:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in order:
            for i in VIEWS[name][1]:
                visit(i)
            order.append(name)

    for name in names:
        visit(name)
    return order


def duckdb_text(name: str) -> str:
    text, inputs = VIEWS[name]
    text = reduce(lambda t, i: t.replace("{%s}" % i, i), inputs, text)
    return text.replace("{{", "{").replace("}}", "}").replace("as string)", "as varchar)").strip()


def with_views(names: list[str], query: str, recursive: bool = False) -> str:
    """A DuckDB query over the named views."""
    texts = [f"{name} as ({duckdb_text(name)})" for name in _needed(names)]
    if query.lstrip().lower().startswith("with "):
        texts.append(query.lstrip()[5:])
        body = ",\n".join(texts)
    else:
        body = ",\n".join(texts) + "\n" + query
    return ("with recursive " if recursive else "with ") + body
