"""From queue bodies to events to triggers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import string_at, variant_type
from ..functions.maps import empty_map
from ..functions.time import col
from ..plans.binding import bind

# A date and a time with seconds and an offset; anything less would be completed from the clock.
RFC3339 = r"(?i)\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})\z"
_TEXT_FIELDS = {"source": "$.source", "detail_type": "$['detail-type']", "region": "$.region", "account": "$.account"}


def judge_event_envelopes(df: DataFrame, body: str = "body") -> DataFrame:
    """Add ``event`` and ``error`` to queue bodies, one of which is null: one pass for both outcomes.

    A body with a non-empty string ``Message`` wraps the event as JSON text in it; any other body is the event itself.
    A null body, invalid JSON, or a field of the wrong type is an error row (``error`` says which); the rest get an
    ``event`` struct in which absent text fields are empty.
    """
    opened = bind(df, "_outer", F.try_parse_json(F.col(body)))

    def text_or_absent(path: str) -> Column:
        return F.coalesce(variant_type(F.col("_outer"), path).isin("STRING", "VOID"), F.lit(True))

    is_wrapper = text_or_absent("$.Type") & text_or_absent("$.MessageId")
    opened = bind(opened, "_inner", F.when(is_wrapper, F.nullif(string_at(F.col("_outer"), "$.Message"), F.lit(""))))
    inner = F.col("_inner")
    opened = bind(opened, "_event", F.when(inner.isNull(), F.col("_outer")).otherwise(F.try_parse_json(inner)))
    v = F.col("_event")

    def wrong(path: str, *allowed: str) -> Column:
        kind = variant_type(v, path)
        fits = kind == "VOID"
        for name in allowed:
            fits = fits | kind.startswith(name)
        return F.coalesce(~fits, F.lit(False))  # an absent field is fine

    mistyped = wrong("$.detail", "OBJECT") | wrong("$.resources", "ARRAY<STRING>", "ARRAY<VOID>") | wrong("$.time", "STRING")
    for path in _TEXT_FIELDS.values():
        mistyped = mistyped | wrong(path, "STRING")
    time_text = F.try_variant_get(v, "$.time", "string")
    time = F.try_to_timestamp(F.when(time_text.rlike(RFC3339), time_text))
    error = (
        F.when(F.col(body).isNull(), F.lit("no message body"))
        .when(v.isNull() & inner.isNotNull(), F.lit("invalid inner event"))
        .when(v.isNull(), F.lit("invalid event"))
        .when(~F.coalesce(inner, F.col(body)).rlike(r"^[ \t\r\n]*\{"), F.lit("event is not an object"))
        .when(mistyped, F.lit("event field has the wrong type"))
        .when(time_text.isNotNull() & time.isNull(), F.lit("invalid event time"))
    )
    event = F.struct(
        *[F.coalesce(F.try_variant_get(v, path, "string"), F.lit("")).alias(name) for name, path in _TEXT_FIELDS.items()],
        F.try_variant_get(v, "$.detail", "variant").alias("detail"),
        time.alias("time"),
        F.coalesce(F.try_variant_get(v, "$.resources", "array<string>"), F.array().cast("array<string>")).alias("resources"),
    )
    parsed = bind(opened, "_error", error)
    judged = bind(parsed, "_parsed", F.when(F.col("_error").isNull(), event))
    kept = [c for c in df.columns if c not in ("event", "error")]
    return judged.select(*kept, F.col("_parsed").alias("event"), F.col("_error").alias("error"))


def parse_event_envelope(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """``(events, errors)`` of ``judge_event_envelopes``; use that one, or write by whether ``error`` is null, to parse once
    for both."""
    judged = judge_event_envelopes(df, body)
    events = judged.where(F.col("error").isNull()).drop(body, "error")
    return events, judged.where(F.col("error").isNotNull()).drop("event")


def glob_to_like(glob: str) -> str:
    """``*`` matches any run of characters; everything else is literal."""
    escaped = glob.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return escaped.replace("*", "%")


def filter_events(
    df: DataFrame,
    source: str | None = None,
    detail_type: str | None = None,
    fields: Mapping[str, str] | None = None,
    name_glob: str | None = None,
    event: str = "event",
) -> DataFrame:
    """Keep the events that match every given test.

    ``fields`` maps a dotted path in the detail to the text it must equal; ``name_glob`` is matched against the
    detail's ``eventName``.
    """
    e = F.col(event)
    out = df
    if source:
        out = out.where(e["source"] == source)
    if detail_type:
        out = out.where(e["detail_type"] == detail_type)
    for path, expected in (fields or {}).items():
        out = out.where(F.try_variant_get(e["detail"], f"$.{path}", "string") == expected)
    if name_glob:
        out = out.where(string_at(e["detail"], "$.eventName").like(glob_to_like(name_glob)))
    return out


def make_trigger(
    df: DataFrame, source: Column, reference: Column, metadata: Column | None, ts: Column | str, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Trigger rows: null metadata becomes an empty map, and the well-known keys become typed columns.

    The timestamp is the one given, so that a re-run makes the same triggers.
    """
    known = empty_map() if metadata is None else F.coalesce(metadata, empty_map())
    base = df.select(
        *keep, source.alias("source"), reference.alias("reference"), known.alias("metadata"), col(ts).alias("ts")
    )
    md = F.col("metadata")
    return base.withColumns({
        "bucket": md["bucket"],
        "key": md["key"],
        "size": md["size"].try_cast("bigint"),
        "etag": md["etag"],
        "event_name": md["event_name"],
    })

