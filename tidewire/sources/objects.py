"""Object-store inputs: listing, paging, and turning objects into messages."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.maps import empty_map, merge_maps
from ..plans.joins import null_safe_join
from ..plans.ordering import numbered


def read_objects(spark: SparkSession, folder: str, bucket: str) -> DataFrame:
    """Files below ``folder`` as object rows; a query that uses neither ``body`` nor ``etag`` never opens the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    root = (folder if "://" in folder or ":/" in folder else os.path.abspath(folder)).rstrip("/") + "/"
    root = re.sub(r"^(\w+):/+", r"/", root) if root.startswith("file:") else root
    # the root is stripped once, where it first stands: the same folder names may follow below it
    return files.withColumn("_root", F.lit(root)).select(
        F.lit(bucket).alias("bucket"),
        F.expr("substring(path, locate(_root, path) + length(_root))").alias("key"),
        F.col("length").alias("size"),
        F.md5("content").alias("etag"),
        empty_map().alias("user_metadata"),
        F.col("modificationTime").alias("modified"),
        F.col("content").alias("body"),
    )


def scan_objects(objects: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    """Objects of one bucket whose key starts with ``prefix``; both tests reach the file scan."""
    found = objects.where(F.col("bucket") == bucket)
    return found.where(F.col("key").startswith(prefix)) if prefix else found


def page_objects(
    objects: DataFrame, max_keys: int, token: str | None = None, rows_per_slice: int | None = None
) -> DataFrame:
    """Listing in key order, ``max_keys`` per page and bucket.

    Without a token every object gets its ``page`` number: keys are numbered on their own and joined back, so bodies are neither
    sorted nor part of a window. Rows that repeat a key share its place. With one (the last key of the page before), and objects of
    a single bucket, only the next page is returned, found by key rather than by counting.
    """
    if max_keys <= 0:
        raise ValueError("max_keys must be positive")
    if token is not None:
        return objects.where(F.col("key") > token).orderBy("key").limit(max_keys)
    keys = objects.groupBy("bucket", "key").agg(F.lit(1).alias("_one")).select("bucket", "key")
    placed = numbered(keys, ["bucket"], ["key"], "_position", rows_per_slice=rows_per_slice)
    page = F.expr(f"(_position - 1) div {int(max_keys)} + 1")
    pages = placed.select("bucket", "key", page.alias("page"))
    # bodies are not sorted: they meet their page by a hash table of keys
    return null_safe_join(objects, pages.hint("shuffle_hash"), ["bucket", "key"], "left")


def object_messages(objects: DataFrame, custom: Column | None = None) -> DataFrame:
    """An object as a message: its body is the payload; user metadata first, ``custom`` keys override."""
    user = F.coalesce(F.col("user_metadata"), empty_map()) if "user_metadata" in objects.columns else empty_map()
    metadata = merge_maps(user, custom) if custom is not None else user
    return objects.select(
        "bucket", "key", F.col("body").alias("raw"), metadata.alias("metadata")
    )
