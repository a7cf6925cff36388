"""Positions and greedy batches: sliced and unsliced runs against plain Python."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewire import operators as op
from tidewire.plans import flag_hot, greedy, numbered, slice_of, sliced
from tidewire.sources import page_objects

START = datetime(2024, 1, 1)


def log(spark, rows):
    """(channel, seq, seconds) rows with one channel holding a third of all, and a null channel."""
    data = [(c, i, START + timedelta(seconds=s)) for i, (c, s) in enumerate(rows)]
    return spark.createDataFrame(data, "channel string, seq bigint, ts timestamp_ntz").repartition(7)


def random_rows(seed, n=900, span=5000, burst=False):
    rng = random.Random(seed)
    seconds = sorted(rng.randrange(span // 50) if burst and i % 2 else rng.randrange(span) for i in range(n))
    return [("hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", None]), s) for s in seconds]


def python_positions(rows):
    seen, out = {}, {}
    for i, (c, _) in enumerate(rows):
        seen[c] = seen.get(c, 0) + 1
        out[i] = (seen[c],)
    return {i: (p[0], seen[rows[i][0]]) for i, p in out.items()}


@pytest.mark.parametrize("per_slice", [None, 200, 50, 7])
@pytest.mark.parametrize("order", [["seq"], ["ts", "seq"]])
def test_positions(spark, per_slice, order):
    rows = random_rows(1, burst=True)
    out = numbered(log(spark, rows), ["channel"], order, "p", "t", per_slice)
    assert {r.seq: (r.p, r.t) for r in out.collect()} == python_positions(rows)


def test_positions_by_text_and_without_groups(spark):
    keys = [f"{lang}/{i}.txt" for lang in ("de", "en", "fr") for i in range(120)]
    df = spark.createDataFrame([("b", k) for k in random.Random(3).sample(keys, len(keys))], "bucket string, key string")
    expected = {k: i // 25 + 1 for i, k in enumerate(sorted(keys))}
    for per_slice in (None, 20):
        assert {r.key: r.page for r in page_objects(df, 25, rows_per_slice=per_slice).collect()} == expected
        ranked = numbered(df, [], ["key"], "p", rows_per_slice=per_slice).collect()
        assert [r.key for r in sorted(ranked, key=lambda r: r.p)] == sorted(keys)
        assert sorted(r.p for r in ranked) == list(range(1, len(keys) + 1))


def test_page_by_token_continues_the_listing(spark):
    keys = sorted(f"k{i}" for i in range(57))
    df = spark.createDataFrame([("b", k) for k in keys], "bucket string, key string")
    listed, token = [], ""
    while True:
        page = [r.key for r in page_objects(df, 10, token).collect()]
        if not page:
            break
        listed += page
        token = page[-1]
    assert listed == keys
    with pytest.raises(ValueError):
        page_objects(df, 0)


def test_hot_groups_are_cut(spark):
    df = spark.range(10_000).withColumn("c", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")))
    assert sliced(df, ["c"], ["id"], 10_000) is None and flag_hot(df, ["c"], 10_000) is None
    cut = sliced(df, ["c"], ["id"], 300)
    counts = cut.groupBy("_slice").count().agg(F.max("count")).head()[0]
    assert counts < 900 and cut.where("c = 'hot'").select("_slice").distinct().count() > 5
    assert {r.c for r in flag_hot(df, ["c"], 300).where("_hot").select("c").distinct().collect()} == {"hot"}


def test_rows_of_one_time_are_cut(spark):
    df = spark.range(20_000).select(F.lit("c").alias("c"), F.lit(START).alias("ts"), "id")
    cut = sliced(df, ["c"], ["ts", "id"], 500)
    assert cut.groupBy("_slice").count().agg(F.max("count")).head()[0] < 1500
    out = numbered(df, ["c"], ["ts", "id"], "p", "t", 500)
    assert out.where("p <> id + 1 or t <> 20000").count() == 0 and out.count() == 20_000


def test_slice_search(spark):
    exact = spark.range(300).select("id", slice_of(F.col("id"), [10, 20, 200]).alias("s")).collect()
    assert {r.id: r.s for r in exact} == {i: (i >= 10) + (i >= 20) + (i >= 200) for i in range(300)}


@pytest.mark.parametrize("limit,wait", [(1, 5), (3, 5), (7, 50), (40, 30), (4, 10_000), (1000, 10_000), (100, 100)])
def test_tables_compose(limit, wait):
    """A composed table does what its parts do one after the other, from every state that can come in."""
    rng = np.random.default_rng(limit)
    us = np.sort(rng.integers(0, 400, 120))
    cuts = [0, *sorted(rng.choice(np.arange(1, 120), 9, replace=False).tolist()), 120]
    parts = [greedy.tabulated(us[a:b], limit, wait) for a, b in zip(cuts, cuts[1:])]
    for start in range(len(parts)):
        whole = parts[start]
        for stop in range(start + 1, len(parts)):
            whole = greedy.compose(whole, parts[stop], limit, wait)
            first = int(whole["head_us"][0])
            states = [(0, 0, -1), *[(first - ago, count, 3) for ago in (0, 1, 3, 7, 29, 60, 200) for count in (1, 2, 5, 39, 99)]]
            for state in states:
                if state[1] > limit:
                    continue
                end = state
                for part in parts[start:stop + 1]:
                    end = greedy.after(part, end, limit, wait)
                assert greedy.after(whole, state, limit, wait) == end, (start, stop, state)


def test_a_group_of_many_slices_needs_small_tasks(spark, monkeypatch):
    monkeypatch.setattr(greedy, "RADIX", 3)
    rows = [("hot", s) for s in sorted(random.Random(8).randrange(3000) for _ in range(600))]
    out = op.batch_by_count_or_time(log(spark, rows), ["channel"], ["seq"], "ts", 6, 40_000, 12)
    assert {r.seq: (r.batch_no, r.batch_idx) for r in out.collect()} == python_batches(rows, 6, 40)


def python_batches(rows, n, wait, key=lambda c: c):
    state, out = {}, {}
    for i, (c, s) in enumerate(rows):
        opened, count, no = state.get(c, (0, 0, -1))
        if no >= 0 and (n is None or count < n) and s < opened + wait:
            count += 1
        else:
            opened, count, no = s, 1, no + 1
        state[c] = (opened, count, no)
        out[i] = (no, count - 1)
    return out


@pytest.mark.parametrize("per_slice", [None, 200, 9])
@pytest.mark.parametrize("n,wait", [(3, 40), (10, 1000), (1, 10), (500, 30), (4, 100_000), (10_000, 100_000)])
def test_count_or_time(spark, per_slice, n, wait):
    rows = random_rows(n + wait, burst=n % 2 == 0)
    out = op.batch_by_count_or_time(log(spark, rows), ["channel"], ["seq"], "ts", n, wait * 1000, per_slice)
    assert {r.seq: (r.batch_no, r.batch_idx) for r in out.collect()} == python_batches(rows, n, wait)


@pytest.mark.parametrize("per_slice", [None, 200, 9])
@pytest.mark.parametrize("wait", [5, 90, 2000, 100_000])
def test_dedupe_window(spark, per_slice, wait):
    rows = random_rows(wait)
    out = op.dedupe_by_message_id(log(spark, rows), "channel", "ts", wait, rows_per_slice=per_slice)
    expected = {i for i, (_, idx) in python_batches(rows, None, wait).items() if idx == 0}
    assert {r.seq for r in out.collect()} == expected


@pytest.mark.parametrize("wait", [3, 17, 60, 400])
def test_dedupe_window_with_gaps_and_ties(spark, wait):
    """Runs of times, gaps longer and shorter than the window, many equal times; one id has nearly all rows."""
    rng = random.Random(wait)
    seconds, at = [], 0
    for _ in range(40):
        seconds += sorted(at + rng.randrange(rng.choice([2, 20, 90])) for _ in range(rng.choice([1, 5, 25])))
        at = seconds[-1] + rng.choice([1, 10, 70, 900])
    rows = [("hot" if rng.random() < 0.9 else "cold", s) for s in seconds]
    out = op.dedupe_by_message_id(log(spark, rows), "channel", "ts", wait, rows_per_slice=60)
    expected = {i for i, (_, idx) in python_batches(rows, None, wait).items() if idx == 0}
    assert {r.seq for r in out.collect()} == expected


@pytest.mark.parametrize("limit,wait", [(1, 5), (3, 5), (7, 50), (greedy.NO_LIMIT, 9), (4, 10_000)])
def test_exits(limit, wait):
    us = np.sort(np.random.default_rng(limit % 97).integers(0, 400, 150))
    last, count, started = greedy.exits(us, limit, wait)
    for start in range(len(us)):
        at, batches, size = start, 1, 1
        for i in range(start + 1, len(us)):
            if size < limit and us[i] < us[at] + wait:
                size += 1
            else:
                at, batches, size = i, batches + 1, 1
        assert (last[start], count[start], started[start]) == (at, size, batches)


def test_batch_sizes(spark):
    rows = [("a", i) for i in range(7)]
    by_three = op.batch_by_count(log(spark, rows), ["channel"], ["seq"], 3).orderBy("seq").collect()
    assert [(r.batch_no, r.batch_idx) for r in by_three] == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0)]
    ones = op.batch_by_count(log(spark, rows), ["channel"], ["seq"], 0).orderBy("seq").collect()
    assert [(r.batch_no, r.batch_idx) for r in ones] == [(i, 0) for i in range(7)]
    # a wait that is not positive counts as 100 ms
    waits = op.batch_by_count_or_time(log(spark, rows), ["channel"], ["seq"], "ts", 5, 0).collect()
    assert sorted(r.batch_no for r in waits) == list(range(7))


def test_wide_columns_survive_the_arrow_stage(spark):
    df = log(spark, random_rows(5, 60)).withColumns({
        "m": F.create_map(F.lit("k"), F.col("channel")), "a": F.array("seq"), "s": F.struct("seq", "channel"),
        "b": F.col("channel").cast("binary"),
    })
    for per_slice in (None, 10):
        out = op.batch_by_count_or_time(df, ["channel"], ["seq"], "ts", 3, 50_000, per_slice)
        # what has been written and read may hold nulls as far as the schema goes
        assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields[:-2]] == df.dtypes
        for r in out.collect():
            assert (r.m, r.a, r.s.seq) == ({"k": r.channel}, [r.seq], r.seq)
