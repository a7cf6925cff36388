from .listings import file_triggers, generate_triggers, poll_listing_triggers, timer_triggers, walked_file_triggers
from .messages import scan_message_log, stream_message_log, stream_table
from .objects import object_messages, page_objects, read_objects, scan_objects

__all__ = [
    "file_triggers", "generate_triggers", "poll_listing_triggers", "timer_triggers", "walked_file_triggers",
    "scan_message_log", "stream_message_log", "stream_table",
    "object_messages", "page_objects", "read_objects", "scan_objects",
]
