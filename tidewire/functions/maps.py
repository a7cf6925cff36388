"""Metadata and header maps as plain column expressions (all stay in the JVM)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import IllegalArgumentException
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .time import col


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def merge_maps(first: Column, *others: Column) -> Column:
    """Union of maps where the right-most map wins; independent of the session's duplicate-key policy."""

    def overlay(base: Column, top: Column) -> Column:
        # the one-element transform gives both maps a name, so that neither is recomputed for every key
        pair = F.array(F.struct(base.alias("base"), top.alias("top")))
        merged = F.transform(pair, lambda p: F.map_concat(
            F.map_filter(p["base"], lambda k, v: ~F.map_contains_key(p["top"], k)), p["top"]
        ))
        return F.get(merged, F.lit(0))

    return reduce(overlay, others, first)


def set_metadata(metadata: Column | str, key: str, value: Column) -> Column:
    """Insert or replace one key."""
    return merge_maps(col(metadata), F.create_map(F.lit(key), value.cast("string")))


def _check_pattern(pattern: str) -> None:
    """A bad pattern fails while the query is built, by the rules of the engine that will run it."""
    try:
        SparkSession.active()._jvm.java.util.regex.Pattern.compile(pattern)
    except IllegalArgumentException as error:
        raise ValueError(f"bad pattern: {pattern!r}") from error


def key_predicate(patterns: Sequence[str], invert: bool):
    """``Column -> Column`` test for a metadata key: any pattern found in it (or none, if inverted)."""
    for pattern in patterns:
        _check_pattern(pattern)
    if not patterns:
        return lambda key: F.lit(bool(invert))
    regex = "|".join(f"(?:{pattern})" for pattern in patterns)
    if invert:
        return lambda key: ~key.rlike(regex)
    return lambda key: key.rlike(regex)


def filter_metadata(metadata: Column | str, patterns: Sequence[str], invert: bool = False) -> Column:
    """Keep the keys in which any regular expression is found; ``invert`` keeps the others.

    No patterns keeps nothing (everything when inverted).
    """
    include = key_predicate(patterns, invert)
    return F.map_filter(col(metadata), lambda k, v: include(k))


def flatten_headers(headers: Column | str, keep_empty: bool = True) -> Column:
    """Multi-valued headers to one comma-joined string each.

    A header with no values becomes ``""`` or, with ``keep_empty=False``, is left out.
    """
    source = col(headers)
    if not keep_empty:
        source = F.map_filter(source, lambda k, v: F.size(v) > 0)
    return F.transform_values(source, lambda k, v: F.array_join(v, ","))


def stringify_list(values: Column) -> Column:
    """Text of a list value: ``[a b c]``."""
    return F.concat(F.lit("["), F.array_join(values.cast("array<string>"), " "), F.lit("]"))


def stringify_metadata(values: Mapping[str, Column]) -> Column:
    """Typed columns to a string map; a null column adds no key."""
    if not values:
        return empty_map()
    pairs = [part for name, value in values.items() for part in (F.lit(name), value.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


def render_map(metadata: Column | str) -> Column:
    """A map as ``k=v;k=v`` with sorted keys: a scalar that compares alike in every engine."""
    entries = F.array_sort(F.map_entries(col(metadata)))
    text = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(text, ";")
