"""Who receives a message: wildcard subscriptions, start positions, load-sharing groups."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def subject_predicate(subject: Column, pattern: str) -> Column:
    """Dot-separated subject against a pattern: ``*`` is exactly one token, a last ``>`` one or more tokens."""
    tokens = pattern.split(".")
    if not all(tokens) or ">" in tokens[:-1]:
        raise ValueError(f"bad subject pattern: {pattern!r}")
    if "*" not in tokens and tokens[-1] != ">":
        return subject == pattern
    if "*" not in tokens and len(tokens) > 1:
        # a plain prefix test, which file statistics can serve too
        prefix = pattern[:-1]
        return subject.startswith(prefix) & (F.length(subject) > len(prefix))
    parts = {"*": r"[^.]+", ">": r".+"}
    return subject.rlike(r"(?s)\A" + r"\.".join(parts.get(t, re.escape(t)) for t in tokens) + r"\z")


def filter_subject(df: DataFrame, column: str, *patterns: str) -> DataFrame:
    """Messages whose subject matches any of the patterns."""
    tests = [subject_predicate(F.col(column), p) for p in patterns]
    return df.where(reduce(lambda a, b: a | b, tests)) if tests else df.where(F.lit(False))


def topic_predicate(topic: Column, pattern: str) -> Column:
    """Slash-separated topic against a filter: ``+`` is one level, a last ``#`` the parent and all below it.

    A leading wildcard does not match topics that start with ``$``.
    """
    levels = pattern.split("/")
    if "#" in levels[:-1] or any(len(x) > 1 and ("#" in x or "+" in x) for x in levels) or not pattern:
        raise ValueError(f"bad topic filter: {pattern!r}")
    regex = "/".join("[^/]*" if x == "+" else re.escape(x) for x in levels if x != "#")
    if levels[-1] == "#":
        regex = f"{regex}(/.*)?" if len(levels) > 1 else ".*"
    test = topic == pattern if "+" not in levels and levels[-1] != "#" else topic.rlike(rf"(?s)\A{regex}\z")
    return test & ~topic.startswith("$") if levels[0] in ("+", "#") else test


def filter_topic(df: DataFrame, topic: str, qos: str, filters: Mapping[str, int]) -> DataFrame:
    """Messages matched by any subscription, with ``effective_qos``: the lower of the published level and the highest
    granted by a matching filter.

    The subscription list is configuration, so it becomes one expression instead of a join.
    """
    granted = [F.when(topic_predicate(F.col(topic), p), F.lit(q)) for p, q in filters.items()]
    if not granted:
        return df.where(F.lit(False)).withColumn("effective_qos", F.col(qos))
    best = F.greatest(*granted) if len(granted) > 1 else granted[0]
    matched = df.withColumn("_granted", best).where(F.col("_granted").isNotNull())
    return matched.withColumn("effective_qos", F.least(F.col(qos), F.col("_granted"))).drop("_granted")


def deliver_policy(
    df: DataFrame,
    policy: str | None,
    created_at: Column | None = None,
    seq: str = "seq",
    ts: str = "ts",
    subject: str = "subject",
) -> DataFrame:
    """Where a new consumer starts.

    ``all``: everything. ``last``: the last message only. ``last_per_subject``: the last one of each subject.
    ``new`` (also for an unset or unknown policy): messages after the consumer was created.
    """
    if policy == "all":
        return df
    if policy == "last":
        return df.orderBy(F.col(seq).desc()).limit(1)
    if policy == "last_per_subject":
        # the limit is applied before the shuffle too, so a hot subject arrives as one row per task
        newest = Window.partitionBy(subject).orderBy(F.col(seq).desc())
        return df.withColumn("_newest", F.row_number().over(newest)).where("_newest = 1").drop("_newest")
    if created_at is None:
        raise ValueError("policy 'new' needs the time the consumer was created")
    return df.where(F.col(ts) > created_at)


def queue_group_assign(
    df: DataFrame, seq: str, members: Sequence[str] | None = None, subscribers: Sequence[str] | None = None
) -> DataFrame:
    """Add ``member``. With ``members`` (a queue group) each message goes to exactly one of them, evenly by sequence;
    with ``subscribers`` (no group) each of them gets every message."""
    if bool(members) == bool(subscribers):
        raise ValueError("give either members or subscribers")
    if members:
        names = F.lit(list(members))
        return df.withColumn("member", F.get(names, F.pmod(F.col(seq), F.lit(len(members))).cast("int")))
    return df.withColumn("member", F.explode(F.lit(list(subscribers))))
