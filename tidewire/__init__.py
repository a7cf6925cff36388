"""Message-stream analytics on Spark: sources, filters, triggers and retrieval, batching and delivery, sinks, streams."""

from . import functions, model, operators, plans, session, sources, streaming

__all__ = ["functions", "model", "operators", "plans", "session", "sources", "streaming"]
