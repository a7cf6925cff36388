from .events import event_metadata, event_reference, s3_event_metadata
from .expressions import message_context, parse_json_object, render_strict, render_template
from .maps import (
    filter_metadata,
    flatten_headers,
    merge_maps,
    render_map,
    set_metadata,
    stringify_list,
    stringify_metadata,
)
from .time import duration_us, micros, rfc3339

__all__ = [
    "event_metadata", "event_reference", "s3_event_metadata",
    "message_context", "parse_json_object", "render_strict", "render_template",
    "filter_metadata", "flatten_headers", "merge_maps", "render_map", "set_metadata", "stringify_list",
    "stringify_metadata", "duration_us", "micros", "rfc3339",
]
