"""Triggers meet the data they point to.

All joins are plain equi-joins on (bucket, key) and every filter sits on the trigger side, so Spark drops triggers
before it looks at objects, picks a broadcast only below its own size limit, and splits a hot key at run time. Work
that needs no body is aggregated per location before it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.maps import empty_map, merge_maps, stringify_metadata
from ..functions.time import micros
from ..plans.binding import bind
from ..plans.joins import null_safe_join

LOCATION = ["bucket", "key"]


def resolve_location(df: DataFrame, reference: str = "reference", metadata: str = "metadata") -> DataFrame:
    """Add ``bucket``, ``key`` and ``location_error``.

    Tried in order: both in the metadata; the reference, less an ``s3://``, cut at its first slash; the nested form
    with JSON objects ``bucket.name`` and ``object.key`` in the metadata.
    """
    split = bind(df, "_parts", F.split(F.regexp_replace(F.col(reference), "^s3://", ""), "/", 2))
    candidates = [(F.get("_parts", F.lit(0)), F.get("_parts", F.lit(1)))]
    if metadata in df.columns:
        md = F.col(metadata)
        nested = md["bucket"].startswith("{")
        candidates.insert(0, (F.when(~nested, md["bucket"]), md["key"]))
        candidates.append((
            F.when(nested, F.get_json_object(md["bucket"], "$.name")), F.get_json_object(md["object"], "$.key")
        ))
    pairs = [F.when(b.isNotNull() & k.isNotNull(), F.struct(b.alias("bucket"), k.alias("key"))) for b, k in candidates]
    found = bind(split, "_at", F.coalesce(*pairs))
    reason = F.concat(F.lit("no location in trigger: "), F.coalesce(F.col(reference), F.lit("")))
    return found.withColumns({
        "bucket": F.col("_at.bucket"),
        "key": F.col("_at.key"),
        "location_error": F.when(F.col("_at").isNull(), reason),
    }).drop("_parts", "_at")


def key_affix(key: Column, prefix: str = "", suffix: str = "") -> Column:
    test = key.startswith(prefix) if prefix else F.lit(True)
    return test & key.endswith(suffix) if suffix else test


def filter_key_affix(df: DataFrame, key: str = "key", prefix: str = "", suffix: str = "") -> DataFrame:
    """Keep rows whose key has the prefix and the suffix; an empty one does not restrict. Others just disappear."""
    return df.where(key_affix(F.col(key), prefix, suffix)) if prefix or suffix else df


def object_attrs(
    key: Column, size: Column, extensions: Sequence[str] = (), min_bytes: int | None = None, max_bytes: int | None = None
) -> Column:
    test = F.lit(True)
    if extensions:
        ends = F.lit(False)
        for extension in extensions:
            ends = ends | key.endswith(extension)
        test = ends
    if min_bytes is not None:
        test = test & (size >= min_bytes)
    if max_bytes is not None:
        test = test & (size <= max_bytes)
    return test


def filter_object_attrs(
    df: DataFrame, extensions: Sequence[str] = (), min_bytes: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Keep triggers by what they say about the object, before it is fetched."""
    return df.where(object_attrs(F.col("key"), F.col("size"), extensions, min_bytes, max_bytes))


def _fetch(triggers: DataFrame, objects: DataFrame) -> DataFrame:
    clash = [c for c in triggers.columns if c in objects.columns and c not in LOCATION]
    return triggers.drop(*clash).join(objects, LOCATION)


def retrieve_lenient(triggers: DataFrame, objects: DataFrame) -> DataFrame:
    """One row per trigger whose object exists; the others are dropped. Fields both sides have come from the object.

    A listing names each location once; if it does not, a trigger gives a row for each of the location's objects.
    """
    return _fetch(triggers, objects)


def retrieve_strict(
    triggers: DataFrame, objects: DataFrame, batch: str = "batch_id", prefix: str = "", suffix: str = ""
) -> tuple[DataFrame, DataFrame]:
    """``(rows, failures)``: a batch with any unresolvable or missing object yields no rows, only its failure count.

    Triggers rejected by the key filter are skipped and do not count. Which batches fail is decided on locations
    alone; bodies are read once, for clean batches.
    """
    wanted = triggers.where(F.col("location_error").isNotNull() | key_affix(F.col("key"), prefix, suffix))
    per_location = wanted.groupBy(batch, *LOCATION).agg(F.count(F.lit(1)).alias("_n"))
    absent = per_location.join(objects.select(*LOCATION), LOCATION, "left_anti")
    failures = absent.groupBy(batch).agg(F.sum("_n").alias("n_failed"))
    clean = null_safe_join(wanted, failures.select(batch), [batch], "left_anti")
    return _fetch(clean, objects), failures


def retrieve_enriched(triggers: DataFrame, objects: DataFrame) -> DataFrame:
    """Retrieved messages whose metadata is the object's, plus ``trigger_source``, ``trigger_reference``,
    ``trigger_timestamp`` (nanoseconds) and every trigger metadata key with a ``trigger_`` prefix."""
    own = F.coalesce(F.col("metadata"), empty_map()) if "metadata" in triggers.columns else empty_map()
    carried = triggers.withColumn("_md", merge_maps(
        stringify_metadata({
            "trigger_source": F.col("source"),
            "trigger_reference": F.col("reference"),
            "trigger_timestamp": micros("ts") * 1000,
        }),
        F.transform_keys(own, lambda k, v: F.concat(F.lit("trigger_"), k)),
    )).drop("metadata")
    user = F.coalesce(F.col("user_metadata"), empty_map()) if "user_metadata" in objects.columns else empty_map()
    return _fetch(carried, objects).withColumn("metadata", merge_maps(user, F.col("_md"))).drop("_md", "user_metadata")


def missing_objects(triggers: DataFrame, objects: DataFrame) -> DataFrame:
    """Locations that triggers point to but no object has, with how many triggers and the first one's id."""
    pointed = triggers.groupBy(*LOCATION).agg(
        F.count(F.lit(1)).alias("n_triggers"), F.min("trigger_id").alias("first_trigger")
    )
    return pointed.join(objects.select(*LOCATION), LOCATION, "left_anti")


def fetch_savings(triggers: DataFrame, objects: DataFrame, keep: Column, by: str = "source") -> DataFrame:
    """Per input: triggers seen, filtered out, fetched and missing, and the share of fetches the filter avoided.

    ``keep`` is the pre-fetch test (see ``key_affix``, ``object_attrs``). Triggers are counted per location first, so
    the join sees each location once.
    """
    per_location = triggers.groupBy(by, *LOCATION, F.coalesce(keep, F.lit(False)).alias("_keep")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    present = objects.select(*LOCATION).distinct().withColumn("_present", F.lit(True))
    joined = per_location.join(present, LOCATION, "left")

    def total(test: Column) -> Column:
        return F.sum(F.when(test, F.col("_n")).otherwise(0))

    there = F.col("_present").isNotNull()
    counts = joined.groupBy(by).agg(
        F.sum("_n").alias("seen"),
        total(~F.col("_keep")).alias("filtered_out"),
        total(F.col("_keep") & there).alias("fetched"),
        total(F.col("_keep") & ~there).alias("missing"),
    )
    return counts.withColumn("avoided_pct", F.expr("filtered_out * 100 div seen"))
