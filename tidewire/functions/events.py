"""Trigger fields derived from an event struct.

An event is ``STRUCT<source, detail_type, detail VARIANT, time TIMESTAMP, region, account, resources ARRAY<STRING>>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .maps import merge_maps, stringify_list, stringify_metadata
from .time import micros

OBJECT_STORE_SOURCE = "aws.s3"


def variant_type(value: Column, path: str) -> Column:
    """SQL type name of the value at ``path``; null when there is none, ``VOID`` for a JSON null."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def string_at(value: Column, path: str) -> Column:
    """The value at ``path`` if, and only if, it is a JSON string."""
    return F.when(variant_type(value, path) == "STRING", F.try_variant_get(value, path, "string"))


def number_at(value: Column, path: str) -> Column:
    """The value at ``path`` as a double if, and only if, it is a JSON number."""
    kind = variant_type(value, path)
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(numeric, F.try_variant_get(value, path, "double"))


def event_reference(event: Column) -> Column:
    """Where the event's data is: object URI, else the first resource, else source and time in nanoseconds."""
    detail = event["detail"]
    uri = F.concat(
        F.lit("s3://"), string_at(detail, "$.bucket.name"), F.lit("/"), string_at(detail, "$.object.key")
    )
    stamped = F.concat(event["source"], F.lit("-"), (micros(event["time"]) * 1000).cast("string"))
    return F.coalesce(
        F.when(event["source"] == OBJECT_STORE_SOURCE, uri), F.get(event["resources"], 0), stamped
    )


def s3_event_metadata(event: Column) -> Column:
    """bucket, key, size, etag, event_name of an object-store event; each only if it has the right type."""
    detail = event["detail"]
    fields = stringify_metadata({
        "bucket": string_at(detail, "$.bucket.name"),
        "key": string_at(detail, "$.object.key"),
        "size": number_at(detail, "$.object.size").cast("bigint"),
        "etag": F.btrim(string_at(detail, "$.object.etag"), F.lit('"')),
        "event_name": string_at(detail, "$.eventName"),
    })
    return F.when(event["source"] == OBJECT_STORE_SOURCE, fields).otherwise(F.map_filter(fields, lambda k, v: F.lit(False)))


def event_metadata(event: Column) -> Column:
    """Everything a trigger keeps of its event: event fields, object fields, and ``detail_<key>`` for each detail."""
    common = stringify_metadata({
        "event_source": event["source"],
        "detail_type": event["detail_type"],
        "event_time": F.unix_seconds(event["time"].cast("timestamp")),
        "event_region": event["region"],
        "event_account": event["account"],
        "event_resources": stringify_list(event["resources"]),
    })
    details = F.coalesce(
        F.from_json(F.to_json(event["detail"]), "map<string,string>"), F.create_map().cast("map<string,string>")
    )
    prefixed = F.transform_keys(details, lambda k, v: F.concat(F.lit("detail_"), k))
    return merge_maps(common, s3_event_metadata(event), prefixed)
