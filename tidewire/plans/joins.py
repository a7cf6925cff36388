"""Joins in which a null key meets a null key, and joins that cut hot keys into pieces."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = 1024  # a key with more than one in so many of all rows is hot


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """``left.join(right, on, how)`` for inner, left, semi and anti joins, with null keys equal to each other.

    An equi-join for the planner, so a hot key is split like any other.
    """
    named = right.withColumnsRenamed({c: f"_on_{i}" for i, c in enumerate(on)})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{i}")) for i, c in enumerate(on)])
    return left.join(named, same, how).drop(*[f"_on_{i}" for i in range(len(on))])


def hot_keys(counts: DataFrame, on: Sequence[str], n: str, share: int = PIECES) -> DataFrame:
    """Keys that hold more than one in ``share`` of all rows, and into how many pieces of that size each is cut.

    ``counts`` has a row per key (written, as it is read more than once). There are fewer than ``share`` such keys, with
    fewer than ``2 * share`` pieces together, whatever the data: small enough to broadcast.
    """
    total = max(1, counts.agg(F.sum(n)).head()[0] or 0)
    pieces = F.ceil(F.col(n) * F.lit(share) / F.lit(total))
    return counts.where(F.col(n) * F.lit(share) > F.lit(total)).select(*on, pieces.alias("_pieces"))


def dealt_to_pieces(df: DataFrame, hot: DataFrame, on: Sequence[str], by: Sequence[str], share: int = PIECES) -> DataFrame:
    """Add ``_piece``: rows of a hot key are dealt over its pieces by a hash of ``by``, those of other keys are in piece 0.

    Rows with a null in the key meet nothing in an equi-join and are dealt as well.
    """
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    place = F.xxhash64(*by)
    piece = F.when(unknown, F.pmod(place, F.lit(share))).otherwise(F.coalesce(F.pmod(place, F.col("_pieces")), F.lit(0)))
    return df.join(F.broadcast(hot), list(on), "left").withColumn("_piece", piece.cast("bigint")).drop("_pieces")


def copied_to_pieces(df: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row of ``df`` (few rows per key) for each piece of its key, to be joined on the key and ``_piece``."""
    places = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_pieces", F.lit(1).cast("bigint")) - 1)
    return df.join(F.broadcast(hot), list(on), "left").withColumn("_piece", F.explode(places)).drop("_pieces")
