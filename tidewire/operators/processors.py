"""User code and parsing between input and output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.binding import bind


def apply_processor(df: DataFrame, fn: Callable, schema: T.StructType | str | None = None, arrow: bool = False) -> DataFrame:
    """Run a user transform that may filter, split or enrich messages.

    Without a schema ``fn`` maps DataFrame to DataFrame and stays inside Spark's optimizer. With one it gets an
    iterator of pandas frames (or Arrow batches) per task.
    """
    if schema is None:
        return df.transform(fn)
    return df.mapInArrow(fn, schema) if arrow else df.mapInPandas(fn, schema)


def json_parser(df: DataFrame, schema: T.StructType, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """JSON content to columns: ``(rows, bad)``. Content that does not fit the schema goes, unchanged, to ``bad``."""
    broken = "_corrupt"
    full = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    parsed = bind(df, "_parsed", F.from_json(F.col(content), full, options))
    failed = F.col(content).isNull() | F.col("_parsed").isNull() | F.col(f"_parsed.{broken}").isNotNull()
    kept = [c for c in df.columns if c != content]
    rows = parsed.where(~failed).select(*kept, *[F.col(f"_parsed.{n}") for n in schema.names])
    bad = parsed.where(failed).drop("_parsed")
    return rows, bad
