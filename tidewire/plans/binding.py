"""Computing an expensive value once per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bind(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, however often it is used.

    The optimizer copies an ordinary column's expression into every later use, filters included; for parsed JSON, used
    a dozen times, that means a dozen parses. It does not look through a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
