"""Metadata each transport attaches to the messages it reads, as string maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import flatten_headers, merge_maps, stringify_metadata
from ..functions.time import rfc3339
from ..plans.ordering import numbered


def nats_metadata(
    df: DataFrame, headers: str = "headers", subject: str = "subject", reply: str = "reply", stream: bool = False
) -> DataFrame:
    """Headers plus ``nats_subject`` and ``nats_reply``.

    Plain subscriptions always carry a reply (empty if there is none) and keep empty headers; stream consumers leave
    both out.
    """
    reply_to = F.nullif(F.col(reply), F.lit("")) if stream else F.coalesce(F.col(reply), F.lit(""))
    own = stringify_metadata({"nats_subject": F.col(subject), "nats_reply": reply_to})
    return df.withColumn("metadata", merge_maps(flatten_headers(headers, keep_empty=not stream), own))


def jetstream_metadata(
    df: DataFrame, stream: str = "stream", consumer: str = "consumer", seq: str = "seq", attempt: str = "attempt",
    ts: str = "ts", rows_per_slice: int | None = None,
) -> DataFrame:
    """Stream and consumer names, both sequence numbers, what the consumer has yet to receive, the delivery count and
    the time."""
    placed = numbered(df, [stream, consumer], [seq], "_consumer_seq", "_total", rows_per_slice)
    own = stringify_metadata({
        "jetstream_stream": F.col(stream),
        "jetstream_consumer": F.col(consumer),
        "jetstream_sequence_stream": F.col(seq),
        "jetstream_sequence_consumer": F.col("_consumer_seq"),
        "jetstream_pending": F.col("_total") - F.col("_consumer_seq"),
        "jetstream_delivered": F.col(attempt),
        "jetstream_timestamp": rfc3339(ts),
    })
    metadata = merge_maps(F.col("metadata"), own) if "metadata" in df.columns else own
    return placed.withColumn("metadata", metadata).drop("_consumer_seq", "_total")


def mqtt_metadata(
    df: DataFrame, topic: str = "topic", qos: str = "qos", retained: str = "retained", attempt: str = "attempt",
    message_id: str = "message_id",
) -> DataFrame:
    """Duplicate flag (any attempt after the first), level, retained flag, topic, id."""
    return df.withColumn("metadata", stringify_metadata({
        "mqtt_duplicate": F.col(attempt) > 1,
        "mqtt_qos": F.col(qos).cast("int"),
        "mqtt_retained": F.col(retained),
        "mqtt_topic": F.col(topic),
        "mqtt_message_id": F.col(message_id).cast("int"),
    }))


def mq_metadata(
    df: DataFrame, queue: str = "queue", message_id: str = "msg_id", correlation_id: str = "correlation_id",
    format: str = "format", priority: str = "priority", persistence: str = "persistence",
) -> DataFrame:
    """Queue name, ids and descriptor fields."""
    return df.withColumn("metadata", stringify_metadata({
        "mq_queue": F.col(queue),
        "mq_message_id": F.col(message_id),
        "mq_correlation_id": F.col(correlation_id),
        "mq_format": F.col(format),
        "mq_priority": F.col(priority).cast("int"),
        "mq_persistence": F.col(persistence).cast("int"),
    }))
