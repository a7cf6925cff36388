"""Continuous input, processing and output. The query's checkpoint plays the part of the acknowledgement: input counts
as taken once the micro-batch it came in is written.

``trigger`` says how long a stream runs: ``ONCE`` (the default) processes what is available and stops, and goes on from there
when started again with the same checkpoint; ``{"processingTime": "1 second"}`` keeps running.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import duration_us
from ..operators.retrieval import retrieve_lenient

BATCH = "write_id"
MANIFEST = "_manifest"
ONCE = {"availableNow": True}
Processor = Callable[[DataFrame], DataFrame]


def start(df: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, trigger: Mapping | None) -> StreamingQuery:
    return df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or ONCE)).start()


def stream_sink(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: Mapping | None = None, by: str | None = None
) -> StreamingQuery:
    """Write each micro-batch to a folder of its own, and name it in a manifest once it is whole.

    Readers (``read_sink``) take folders from the manifest only, so a micro-batch is seen whole or not at all, all its outcomes at
    once. A micro-batch that is run again after a crash gets another folder if it had not been named; if it had, it is left as it is.
    Folders that a crash left unnamed stay unseen.

    ``by`` names a column with the outcome of each row (``sent``, ``dead``): one pass then writes a folder per outcome.
    """
    return start(df, partial(_write_whole, path, fmt, by, {}), checkpoint, trigger)


def _write_whole(path: str, fmt: str, by: str | None, started: dict, rows: DataFrame, batch_id: int) -> None:
    spark = rows.sparkSession
    # only the first micro-batch after a start can have been written before
    again, started["on"] = not started, True
    if again and batch_id in {row.batch_id for row in _committed(spark, path).collect()}:
        return
    folder = f"{batch_id}-{uuid.uuid4().hex}"
    writer = rows.write.format(fmt)
    (writer.partitionBy(by) if by else writer).save(f"{path}/{BATCH}={folder}")
    # one file, which appears under its name when it is whole
    entry = spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(folder).alias(BATCH))
    entry.coalesce(1).write.mode("append").json(f"{path}/{MANIFEST}")


def _committed(spark: SparkSession, path: str) -> DataFrame:
    """(``batch_id``, folder) of the micro-batches that are whole; none before the first."""
    schema = f"batch_id bigint, {BATCH} string"
    try:
        return spark.read.schema(schema).json(f"{path}/{MANIFEST}")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_sink(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Everything a ``stream_sink`` has committed so far: whole micro-batches, whatever is being written meanwhile.

    The manifest has one short name per micro-batch. Raises ``FileNotFoundError`` before the first.
    """
    folders = sorted({row[BATCH] for row in _committed(spark, path).collect()})
    if not folders:
        raise FileNotFoundError(f"no micro-batch is committed below {path}")
    rows = spark.read.format(fmt).option("basePath", path).load([f"{path}/{BATCH}={folder}" for folder in folders])
    return rows.drop(BATCH)


def stream_flow(
    source: DataFrame, *processors: Processor, path: str, checkpoint: str, trigger: Mapping | None = None, by: str | None = None
) -> StreamingQuery:
    """Input, any number of DataFrame-to-DataFrame processors, output. ``by``: see ``stream_sink``."""
    out = source
    for processor in processors:
        out = out.transform(processor)
    return stream_sink(out, path, checkpoint, trigger=trigger, by=by)


def retrieve_stream(
    triggers: DataFrame, objects: Callable[[], DataFrame], path: str, checkpoint: str,
    then: Processor | None = None, trigger: Mapping | None = None,
) -> StreamingQuery:
    """Join each micro-batch of triggers to the object table as it is at that time (a trigger that comes before its object finds
    nothing; ``retrieve_stream_waiting`` lets it wait), and write the found rows.

    ``objects`` is called for every micro-batch, so objects that land after the start are seen; the join runs as a batch
    job, where a hot location is split. Filter the triggers first: bodies are fetched for the survivors only. ``then`` is
    applied to the found rows.
    """

    def run(found: Processor | None, rows: DataFrame, batch_id: int) -> None:
        out = retrieve_lenient(rows, objects())
        out = found(out) if found else out
        write(out, batch_id)

    write = partial(_write_whole, path, "parquet", None, {})
    return start(triggers, partial(run, then), checkpoint, trigger)


def retrieve_stream_waiting(
    triggers: DataFrame, objects: DataFrame, path: str, checkpoint: str, wait_s: float | str, keep_s: float | str,
    ts: str = "ts", modified: str = "modified", then: Processor | None = None, trigger: Mapping | None = None,
) -> StreamingQuery:
    """Join a stream of triggers to a stream of objects that land before or after them, by ``bucket`` and ``key``.

    A trigger finds every version of its object that was modified from ``keep_s`` before its time to ``wait_s`` after it, whichever
    of the two came in first. If none has come when the newest times of both streams have passed the wait, the trigger comes out
    once with ``found`` false and nulls for the object. Both times bound what Spark keeps: triggers for the wait, objects until no
    trigger can ask for them any more. Messages are expected in time order from one micro-batch to the next; a trigger without
    a bucket, key or time finds nothing. ``then`` is applied to the rows (the triggers' columns, the objects' other columns, ``found``).
    """
    later, earlier = (F.expr(f"interval {duration_us(s)} microseconds") for s in (wait_s, keep_s))
    asked = triggers.withColumn("_asked", F.col(ts).cast("timestamp")).withWatermark("_asked", "0 seconds")
    names = [c for c in objects.columns if c not in triggers.columns]
    landed = objects.select(
        F.col("bucket").alias("_bucket"), F.col("key").alias("_key"), *names, F.col(modified).cast("timestamp").alias("_landed"),
    ).withWatermark("_landed", "0 seconds")
    same = (F.col("bucket") == F.col("_bucket")) & (F.col("key") == F.col("_key"))
    in_time = (F.col("_landed") <= F.col("_asked") + later) & (F.col("_landed") >= F.col("_asked") - earlier)
    joined = asked.join(landed, same & in_time, "left_outer")
    out = joined.select(*triggers.columns, *names, F.col("_landed").isNotNull().alias("found"))
    return stream_sink(then(out) if then else out, path, checkpoint, trigger=trigger)


def observed_progress(query: StreamingQuery, name: str) -> list[dict]:
    """What ``operators.observed`` recorded under ``name``, per micro-batch, oldest first, with its ``batch_id``.

    A running query shows each micro-batch as soon as it is done. Spark keeps the last 100
    (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    seen = ((p["batchId"], p["observedMetrics"].get(name)) for p in query.recentProgress)
    return [{"batch_id": batch_id, **metrics.asDict()} for batch_id, metrics in seen if metrics is not None]
