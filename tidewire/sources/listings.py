"""Inputs that only point at data: timers, differences between listings, discovered files."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.maps import empty_map, stringify_metadata
from ..model import SOURCE_FILE, SOURCE_GENERATE, SOURCE_POLLING
from ..plans.joins import null_safe_join
from ..session import new_run_folder

TICKS_PER_BLOCK = 10_000
ENTRIES_AT_ONCE = 10_000


def generate_triggers(timers: DataFrame, every_s: int) -> DataFrame:
    """A trigger every ``every_s`` seconds from ``start`` to ``stop`` (inclusive) for each ``timer_id``.

    Ticks are produced in blocks that are spread over the cluster, so no row ever holds a whole timer.
    """
    if every_s <= 0:
        raise ValueError("every_s must be positive")
    span_s = F.timestamp_diff("SECOND", F.col("start"), F.col("stop"))
    ticks = F.when(F.col("stop") >= F.col("start"), F.floor(span_s / every_s) + 1).otherwise(0)
    last_block = F.floor((ticks - 1) / TICKS_PER_BLOCK)
    blocks = (
        timers.withColumn("_ticks", ticks.cast("bigint"))
        .where("_ticks > 0")
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last_block.cast("bigint"))))
        .hint("rebalance")
    )
    first = F.col("_block") * TICKS_PER_BLOCK
    last = F.least(first + TICKS_PER_BLOCK, F.col("_ticks")) - 1
    ticked = blocks.withColumn("_tick", F.explode(F.sequence(first, last)))
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_tick") * every_s).cast("decimal(18,6)"))
    return ticked.select(
        F.lit(SOURCE_GENERATE).alias("source"),
        F.col("timer_id").cast("string").alias("reference"),
        empty_map().alias("metadata"),
        (F.col("start") + seconds).alias("ts"),
    )


def timer_triggers(spark: SparkSession, timer_id: str, every_s: int) -> DataFrame:
    """``generate_triggers`` as a stream: a trigger every ``every_s`` seconds for as long as the stream runs."""
    if every_s <= 0:
        raise ValueError("every_s must be positive")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.where(F.col("value") % every_s == 0).select(
        F.lit(SOURCE_GENERATE).alias("source"), F.lit(timer_id).alias("reference"), empty_map().alias("metadata"),
        F.col("timestamp").alias("ts"),
    )


def poll_listing_triggers(current: DataFrame, previous: DataFrame, polled_at: Column | None = None) -> DataFrame:
    """A trigger for each object that is new, or changed, since the previous listing: by bucket, key and etag, or by size and
    ``modified`` (those that both listings have) where there is no etag. A null bucket or key is one like any other.

    Its ``ts`` is ``polled_at``, or else the object's ``modified``; with neither it is null, and rules on age drop it.
    """
    untagged = [c for c in ("size", "modified") if c in current.columns and c in previous.columns]
    version = {f"_{c}": F.when(F.col("etag").isNull(), F.col(c)) for c in untagged}
    same = ["bucket", "key", "etag", *version]
    fresh = null_safe_join(current.withColumns(version), previous.withColumns(version).select(*same), same, "left_anti")
    stamp = F.col("modified") if "modified" in current.columns else F.lit(None).cast("timestamp")
    stamp = stamp if polled_at is None else polled_at
    return fresh.select(
        F.lit(SOURCE_POLLING).alias("source"),
        F.concat_ws("/", "bucket", "key").alias("reference"),
        stringify_metadata({c: F.col(c) for c in ("bucket", "key", "size", "etag")}).alias("metadata"),
        "bucket", "key", "size", "etag", stamp.alias("ts"),
    )


def file_triggers(spark: SparkSession, folder: str, glob: str = "*", streaming: bool = False) -> DataFrame:
    """A trigger per discovered file. Only names, sizes and times are looked at; contents are pruned away."""
    reader = (spark.readStream if streaming else spark.read).format("binaryFile")
    if streaming:
        reader = reader.schema("path string, modificationTime timestamp, length bigint, content binary")
    files = reader.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select(
        F.lit(SOURCE_FILE).alias("source"),
        F.col("path").alias("reference"),
        stringify_metadata({"size": F.col("length"), "modified": F.col("modificationTime")}).alias("metadata"),
        F.col("modificationTime").alias("ts"),
        F.col("length").alias("size"),
    )


def _lister(root: str):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The files and folders in each given folder, in pieces of ``ENTRIES_AT_ONCE``."""
        store, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                found = [x for x in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)) if x.base_name[:1] not in ("_", ".")]
                for at in range(0, len(found), ENTRIES_AT_ONCE):
                    part = found[at:at + ENTRIES_AT_ONCE]
                    is_folder = [x.type == fs.FileType.Directory for x in part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([x.path for x in part]), pa.array(is_folder),
                        pa.array([None if d else x.size for d, x in zip(is_folder, part)], type=pa.int64()),
                        pa.array([x.mtime_ns // 1000 if x.mtime_ns else None for x in part], type=pa.int64()),
                    ], names=["path", "is_folder", "size", "modified_us"])

    return entries


def walked_file_triggers(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """A trigger per file below ``root``, listed by tasks: the driver sees no names.

    Folders are listed level by level, each by one task; what a level holds is written and its folders are the next level's work.
    ``root`` is a URI of a store that every executor reaches by itself (``file://`` on a shared mount, ``hdfs://``, ``s3://``); others, and
    streams, take ``file_triggers``. ``glob`` is for file names; names that start with ``_`` or ``.`` are left out, as Spark does. A
    folder that goes away meanwhile holds nothing. A root without files gives no rows.
    """
    _, inner = fs.FileSystem.from_uri(root)
    if not root.rstrip("/").endswith(inner.rstrip("/")):
        raise ValueError(f"write the root without escapes: {root!r}")
    prefix = root.rstrip("/")[:len(root.rstrip("/")) - len(inner.rstrip("/"))]
    work = new_run_folder(spark, "listing")
    schema = "path string, is_folder boolean, size bigint, modified_us bigint"
    folders, level = spark.createDataFrame([(inner.rstrip("/"),)], "path string"), 0
    while True:
        folders.select("path").mapInArrow(_lister(root), schema).write.parquet(f"{work}/level={level}")
        below = spark.read.schema(schema).parquet(f"{work}/level={level}").where("is_folder").select("path")
        if not below.head(1):
            break
        folders, level = below.repartition("path"), level + 1
    found = spark.read.schema(schema).parquet(*[f"{work}/level={i}" for i in range(level + 1)]).where(~F.col("is_folder"))
    pattern = fnmatch.translate(glob)
    named = found.where(F.element_at(F.split("path", "/"), -1).rlike("^" + pattern)).withColumn("modified", F.timestamp_micros("modified_us"))
    return named.select(
        F.lit(SOURCE_FILE).alias("source"),
        F.concat(F.lit(prefix), "path").alias("reference"),
        stringify_metadata({"size": F.col("size"), "modified": F.col("modified")}).alias("metadata"),
        F.col("modified").alias("ts"),
        "size",
    )
