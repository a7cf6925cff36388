from .flow import observed_progress, read_sink, retrieve_stream, retrieve_stream_waiting, stream_flow, stream_sink
from .stateful import open_batches, stream_batcher, stream_dedupe, stream_redelivery

__all__ = [
    "observed_progress", "open_batches", "read_sink", "retrieve_stream", "retrieve_stream_waiting", "stream_batcher", "stream_dedupe", "stream_flow",
    "stream_redelivery", "stream_sink",
]
