"""Inputs whose rows carry their own payload: captured message logs, at rest or arriving."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import col
from ..model import MESSAGE


def _as_messages(df: DataFrame, mapping: Mapping[str, Column | str]) -> DataFrame:
    unknown = set(mapping) - set(MESSAGE.names)
    if unknown:
        raise ValueError(f"not message fields: {sorted(unknown)}")
    return df.select(*[
        (col(mapping[f.name]) if f.name in mapping else F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE.fields
    ])


def scan_message_log(
    spark: SparkSession, path: str, mapping: Mapping[str, Column | str], fmt: str = "parquet", **options: str
) -> DataFrame:
    """Read a captured log and project it into message rows.

    ``mapping`` gives a column or expression per message field; fields left out are null, and only the
    columns it mentions are read.
    """
    return _as_messages(spark.read.format(fmt).options(**options).load(path), mapping)


def stream_table(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    glob: str | None = None,
    max_files: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Files of a folder as a stream; ``max_files`` bounds what one micro-batch admits."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_message_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    mapping: Mapping[str, Column | str],
    max_files: int | None = None,
    glob: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """``scan_message_log`` as a stream: new files are picked up as they land."""
    return _as_messages(stream_table(spark, path, schema, glob, max_files, fmt), mapping)
