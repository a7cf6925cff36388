from .channels import deliver_policy, filter_subject, filter_topic, queue_group_assign
from .delivery import (
    ack_outcome,
    batch_by_count,
    batch_by_count_or_time,
    consumer_lag,
    dedupe_by_message_id,
    pending_by_ack_policy,
    redeliver,
    resume_durable,
    rollback_batch,
)
from .events import filter_events, judge_event_envelopes, make_trigger, parse_event_envelope
from .metrics import component_metrics, observed
from .processors import apply_processor, json_parser
from .retrieval import (
    fetch_savings,
    filter_key_affix,
    filter_object_attrs,
    key_affix,
    missing_objects,
    object_attrs,
    resolve_location,
    retrieve_enriched,
    retrieve_lenient,
    retrieve_strict,
)
from .sinks import (
    batch_error_report,
    dead_letter,
    descriptor_error,
    judge_transactions,
    message_error,
    mq_descriptor,
    ordered_write,
    publish_continue,
    publish_fail_fast,
    publish_headers,
    publish_transactional,
    retained_last_value,
    route_by_expression,
    write_routes,
)
from .transport import jetstream_metadata, mq_metadata, mqtt_metadata, nats_metadata
from .triggers import dedupe_triggers, expire_triggers, limit_batch, merge_triggers, order_triggers

__all__ = [name for name in dir() if not name.startswith("_")]
