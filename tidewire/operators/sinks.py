"""Where messages go, and what happens to a batch when one of them cannot be sent."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import render_template
from ..functions.maps import filter_metadata, key_predicate, merge_maps
from ..functions.time import rfc3339
from ..model import (
    CORRELATION_ID_BYTES,
    DESCRIPTOR_CCSID,
    DESCRIPTOR_ENCODING,
    DESCRIPTOR_FORMAT,
    MAX_PRIORITY,
    RESERVED_HEADERS,
)
from ..plans.joins import null_safe_join


def route_by_expression(df: DataFrame, template: str, col: str = "route") -> DataFrame:
    """Add the destination (subject, topic, queue) a template computes from each message."""
    return df.withColumn(col, render_template(template))


def write_routes(df: DataFrame, path: str, col: str = "route", fmt: str = "parquet") -> None:
    """One folder per destination. Rebalancing splits a hot destination over several tasks and merges small ones."""
    df.hint("rebalance", col).write.mode("overwrite").partitionBy(col).format(fmt).save(path)


def publish_continue(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """``(sent, dead)``: failing messages are skipped and kept with their ``error``; all others are sent."""
    judged = df.withColumn("error", error)
    return judged.where(F.col("error").isNull()).drop("error"), judged.where(F.col("error").isNotNull())


def publish_fail_fast(df: DataFrame, error: Column, batch: Sequence[str], idx: str = "batch_idx") -> DataFrame:
    """Add ``status``: in each batch, messages before the first error are ``sent``, that one ``failed``, the rest
    ``not_attempted``; ``error`` names its place.

    A message without a place comes after all that have one. Of several messages at the failing place, those with an error
    ``failed``, the others were ``sent``. First errors are aggregated on their own and joined back, so a huge batch is never gathered.
    """
    judged = df.withColumn("_error", error)
    bad = judged.where(F.col("_error").isNotNull())
    first = bad.groupBy(*batch).agg(F.lit(True).alias("_stopped"), F.min(idx).alias("_first"))
    joined = null_safe_join(judged, first, batch, "left")
    at, stop = F.col(idx), F.col("_first")
    before = F.when(stop.isNull(), at.isNotNull()).otherwise(F.coalesce(at < stop, F.lit(False)))
    here = at.eqNullSafe(stop) & F.col("_stopped").isNotNull()
    sent = F.col("_stopped").isNull() | before | (here & F.col("_error").isNull())
    status = F.when(sent, "sent").when(here, "failed").otherwise("not_attempted")
    place = F.coalesce(at.cast("string"), F.lit("?"))
    message = F.when(here, F.concat(F.lit("batch #"), place, F.lit(": "), F.col("_error")))
    return joined.withColumns({"status": status, "error": message}).drop("_error", "_first", "_stopped")


def judge_transactions(df: DataFrame, error: Column, batch: Sequence[str]) -> DataFrame:
    """Add ``error`` and ``rolled_back``: whether some message of the row's batch fails. One pass for both outcomes; a
    null batch key is a batch like any other."""
    judged = df.withColumn("error", error)
    bad = judged.where(F.col("error").isNotNull()).select(*batch).distinct().withColumn("_bad", F.lit(True))
    joined = null_safe_join(judged, bad, batch, "left")
    return joined.withColumn("rolled_back", F.col("_bad").isNotNull()).drop("_bad")


def publish_transactional(df: DataFrame, error: Column, batch: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(written, rolled_back)``: one failing message takes its whole batch back.

    To use both without reading the input twice, write ``judge_transactions`` by its ``rolled_back`` column.
    """
    judged = judge_transactions(df, error, batch)
    written = judged.where(~F.col("rolled_back")).drop("rolled_back", "error")
    return written, judged.where("rolled_back").drop("rolled_back")


def _whole_number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"[+-]?[0-9]+", text) else default


def mq_descriptor(
    df: DataFrame,
    format: str | None = None,
    ccsid: str | None = None,
    encoding: str | None = None,
    patterns: Sequence[str] | None = None,
    invert: bool = False,
    metadata: str = "metadata",
) -> DataFrame:
    """Add the queue message descriptor.

    ``ccsid`` and ``encoding`` fall back to their defaults when unset or not a number. Priority and persistence come
    from metadata that passes the filter and is a number, else they are null (the queue's own default). A
    correlation id of more than 24 bytes is dropped and a new one requested. ``patterns=None`` filters nothing.
    """
    include = (lambda key: F.lit(True)) if patterns is None else key_predicate(patterns, invert)
    md = F.col(metadata)

    def passed(key: str) -> Column:
        return F.when(include(F.lit(key)), md[key])

    def number(key: str) -> Column:
        return F.when(passed(key).rlike(r"^[+-]?[0-9]+$"), passed(key)).try_cast("int")

    correlation = passed("mq_correlation_id")
    fits = F.octet_length(correlation) <= CORRELATION_ID_BYTES
    return df.withColumns({
        "format": F.lit(format or DESCRIPTOR_FORMAT),
        "ccsid": F.lit(_whole_number(ccsid, DESCRIPTOR_CCSID)),
        "encoding": F.lit(_whole_number(encoding, DESCRIPTOR_ENCODING)),
        "priority": number("mq_priority"),
        "persistence": number("mq_persistence"),
        "correlation_id": F.when(fits, correlation),
        "new_correlation_id": ~F.coalesce(fits, F.lit(False)),
    })


def descriptor_error(priority: str = "priority") -> Column:
    """Why a queue would refuse the descriptor, or null."""
    p = F.col(priority)
    return F.when((p < 0) | (p > MAX_PRIORITY), F.concat(F.lit("invalid priority "), p.cast("string")))


def message_error(route: str | None = None, payload: str | None = None, priority: str | None = None) -> Column:
    """Why a message cannot be sent, or null: no destination, an unreadable payload, a refused descriptor."""
    reasons = []
    if route:
        reasons.append(F.when(F.coalesce(F.col(route), F.lit("")) == "", F.lit("no destination")))
    if payload:
        reasons.append(F.when(F.col(payload).isNull(), F.lit("unreadable payload")))
    if priority:
        reasons.append(descriptor_error(priority))
    return F.coalesce(*reasons, F.lit(None).cast("string"))


def publish_headers(
    metadata: Column,
    patterns: Sequence[str] | None = None,
    invert: bool = False,
    published_at: Column | None = None,
    host: str = "",
    prefix: str = "publish",
) -> Column:
    """Outgoing headers: the metadata that passes the filter, without the reserved keys, plus when (``<prefix>_timestamp``)
    and where (``<prefix>_source``, if a host is given) it was published."""
    kept = metadata if patterns is None else filter_metadata(metadata, patterns, invert)
    kept = F.map_filter(kept, lambda k, v: ~k.isin(*RESERVED_HEADERS))
    stamps = []
    if published_at is not None:
        stamps += [F.lit(f"{prefix}_timestamp"), rfc3339(published_at)]
    if host:
        stamps += [F.lit(f"{prefix}_source"), F.lit(host)]
    return merge_maps(kept, F.create_map(*stamps)) if stamps else kept


def retained_last_value(df: DataFrame, topic: str = "topic", order: Sequence[str] = ("ts", "seq"), retained: str = "retained") -> DataFrame:
    """The newest retained message per topic: what a late subscriber is given."""
    newest = Window.partitionBy(topic).orderBy(*[F.col(c).desc() for c in order])
    return df.where(F.col(retained)).withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def ordered_write(df: DataFrame, path: str, by: Sequence[str], order: Sequence[str], n: int, fmt: str = "parquet") -> None:
    """Write ``n`` files that, read by name, keep every channel's order.

    Ranges are cut by channel *and* order, so a hot channel spans several files.
    """
    placed = df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
    placed.write.mode("overwrite").format(fmt).save(path)


def dead_letter(*stages: tuple[str, DataFrame, Column | str, Column | str]) -> DataFrame:
    """One table of ``(stage, reason, msg)`` from ``(stage, rows, reason, msg)`` inputs."""
    parts = [
        df.select(
            F.lit(stage).alias("stage"),
            (F.col(reason) if isinstance(reason, str) else reason).alias("reason"),
            (F.col(msg) if isinstance(msg, str) else msg).cast("string").alias("msg"),
        )
        for stage, df, reason, msg in stages
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def batch_error_report(df: DataFrame, batch: Sequence[str], idx: str, error: str, separator: str = ";") -> DataFrame:
    """Per batch with errors: how many, the first, and all of them joined in batch order.

    The report is as long as the batch's errors; batches are of bounded size (``batch_by_count``).
    """
    failing = df.where(F.col(error).isNotNull())
    quoted = separator.replace("\\", "\\\\").replace("'", "\\'")
    return failing.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("n_errors"),
        F.min_by(error, idx).alias("first_error"),
        F.expr(f"listagg(`{error}`, '{quoted}') within group (order by `{idx}`)").alias("report"),
    )
