"""Greedy batching of ordered groups: a batch is opened by its first message and takes the following ones while it
has fewer than ``n`` and their time is before ``opened + wait``.

The rule is sequential, but only two numbers travel along a group: when the open batch was opened, and how many it
has. Sorted rows stream through Arrow with that pair as the only state. A group that is too large for one task is cut
into slices of bounded size (``plans.ordering``):

1. every slice, in parallel and on times alone, works out for each possible position of its first *new* batch which
   batch is open at its end. Positions beyond ``n`` rows, or beyond ``wait`` after the slice's first row, cannot occur;
2. such a table is a function from the batch that is open before a slice to the one open after it. Functions of ``RADIX``
   neighbouring slices are composed into one, those again, until a group has one; then the incoming batches are handed down
   the same tree. No task ever has more than ``RADIX`` tables of a group, and the rounds grow with the logarithm of its slices;
3. every slice, in parallel, assigns its rows from there.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from ..functions.time import micros
from ..session import new_run_folder
from .openers import accepted_times
from .ordering import ROWS_PER_SLICE, flag_hot, group_of, slice_table, sliced

NO_LIMIT = 1 << 62
FIRST_US = -62_135_596_800_000_000  # the start of year 1, before any time a log can hold
# Strides cost more than one pass of a task over a few million rows.
ROWS_PER_ID = 5 * ROWS_PER_SLICE
RADIX = 32
# when the open batch was opened, how many messages it has, its number
NOTHING_OPEN = {"_opened": 0, "_count": 0, "_batch": -1}


def arrival(ts: str) -> Column:
    """Microseconds; a message without a time arrived first."""
    return F.coalesce(micros(ts), F.lit(FIRST_US))


def assign_greedy(
    df: DataFrame, by: Sequence[str], order: Sequence[str], ts: str, n: int, wait_us: int,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Add ``batch_no`` (from 0 per group) and ``batch_idx`` (from 0 per batch)."""
    timed = df.withColumn("_us", arrival(ts))
    cut = sliced(timed, by, ["_us", *order], rows_per_slice)
    if cut is None:
        return _assign(_as_one_slice(timed, by), df, order, n, wait_us)
    return _assign(cut.join(_entries(cut, n, wait_us), ["_group", "_slice"], "left"), df, order, n, wait_us)


def first_per_window(
    df: DataFrame, by: Sequence[str], order: Sequence[str], ts: str, window_us: int, rows_per_slice: int | None = None
) -> DataFrame:
    """The messages that open a batch when only time closes one.

    Without a count limit the tables of the batch plan could grow with the window, so groups that are too large for
    one task are followed in doubling strides instead (``plans.openers``).
    """
    timed = df.withColumn("_us", arrival(ts))
    per_id = rows_per_slice or ROWS_PER_ID
    flagged = flag_hot(timed, by, per_id)
    if flagged is None:
        return _assign(_as_one_slice(timed, by), df, order, NO_LIMIT, window_us, True).select(*df.columns)
    small = _assign(flagged.where(~F.col("_hot")).withColumn("_slice", F.lit(0)), df, order, NO_LIMIT, window_us, True)
    large = flagged.where("_hot")
    same_time = Window.partitionBy("_group", "_us").orderBy(*order)
    opened = large.join(accepted_times(large, per_id, window_us), ["_group", "_us"])
    opened = opened.withColumn("_rank", F.row_number().over(same_time)).where("_rank = 1")
    return small.select(*df.columns).unionByName(opened.select(*df.columns))


def _as_one_slice(timed: DataFrame, by: Sequence[str]) -> DataFrame:
    return timed.withColumns({"_group": group_of(by), "_slice": F.lit(0)})


def _assign(
    cut: DataFrame, df: DataFrame, order: Sequence[str], limit: int, wait: int, only_first: bool = False
) -> DataFrame:
    """The columns of ``df`` and the batch of each row of ``cut``. A slice without an incoming batch starts afresh."""
    entered = cut.withColumns({
        name: F.coalesce(F.col(name) if name in cut.columns else F.lit(None), F.lit(value)).cast("bigint")
        for name, value in NOTHING_OPEN.items()
    })
    place = ["_group", "_slice", "_us", *order]
    rows = Window.partitionBy(*place[:2]).orderBy(*place[2:])
    # the window leaves the rows in this order already; saying so costs nothing and makes it certain
    placed = entered.withColumn("_row", F.row_number().over(rows)).sortWithinPartitions(*place)
    # times and places go through Arrow, the messages do not: they meet again in the same partitioning
    names = [cut.schema["_group"], cut.schema["_slice"], T.StructField("_row", T.IntegerType())]
    schema = T.StructType([*names, _long("batch_no"), _long("batch_idx")])
    narrow = placed.select("_group", "_slice", "_row", "_us", *NOTHING_OPEN)
    assigned = narrow.mapInArrow(_assigner(limit, wait, only_first), schema)
    joined = placed.drop("batch_no", "batch_idx").join(assigned, ["_group", "_slice", "_row"])
    return joined.select(*[c for c in df.columns if c not in ("batch_no", "batch_idx")], "batch_no", "batch_idx")


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _assigner(limit: int, wait: int, only_first: bool):
    state_columns = ["_us", "_row", *NOTHING_OPEN]
    kept_columns = ["_group", "_slice", "_row"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, count, batch = 0, 0, -1
        for rb in batches:
            if rb.num_rows == 0:
                continue
            us, row, in_opened, in_count, in_batch = (
                rb.column(rb.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in state_columns
            )
            batch_no = np.empty(len(us), dtype=np.int64)
            batch_idx = np.empty(len(us), dtype=np.int64)
            heads = np.flatnonzero(row == 1)
            edges = [*([] if len(heads) and heads[0] == 0 else [0]), *heads.tolist(), len(us)]
            for start, end in zip(edges[:-1], edges[1:]):
                if row[start] == 1:
                    opened, count, batch = int(in_opened[start]), int(in_count[start]), int(in_batch[start])
                at = start
                while at < end:
                    taken = 0
                    if batch >= 0 and count < limit:
                        room = min(end - at, limit - count)
                        taken = int(np.searchsorted(us[at:at + room], opened + wait, side="left"))
                    if taken == 0:
                        batch, opened, count, taken = batch + 1, int(us[at]), 0, 1
                    batch_no[at:at + taken] = batch
                    batch_idx[at:at + taken] = np.arange(count, count + taken)
                    count += taken
                    at += taken
            kept = [rb.schema.get_field_index(name) for name in kept_columns]
            out = pa.RecordBatch.from_arrays(
                [rb.column(i) for i in kept] + [pa.array(batch_no), pa.array(batch_idx)],
                names=[rb.schema.names[i] for i in kept] + ["batch_no", "batch_idx"],
            )
            yield out.filter(pa.array(batch_idx == 0)) if only_first else out

    return assign


def exits(us: np.ndarray, limit: int, wait: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every position: if a batch starts there, where the slice's last batch starts, how many rows that one has,
    and how many batches are started up to it. ``us`` is sorted."""
    size = len(us)
    here = np.arange(size)
    following = np.minimum(np.searchsorted(us, us + wait, side="left"), here + min(limit, size))
    following = np.maximum(following, here + 1)
    last = np.where(following < size, following, here)
    started = np.where(following < size, 2, 1)
    while True:  # each round doubles the number of batches looked ahead
        further = last[last]
        if np.array_equal(further, last):
            break
        started = started + started[last] - 1
        last = further
    return last, size - last, started


TABLE = [("size", pa.int64()), ("last_us", pa.int64()), ("whole", pa.bool_()), *[
    (name, pa.list_(pa.int64())) for name in ("head_us", "exit_us", "exit_count", "exit_started")]]
State = tuple[int, int, int]  # when the open batch was opened, how many it has, its number


def _entries(rows: DataFrame, limit: int, wait: int) -> DataFrame:
    """The batch that is open when each slice begins, for groups of several slices: one row per (group, slice)."""
    spark = rows.sparkSession
    folder = new_run_folder(spark, "batches")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    slices = written(slice_table(rows).where(F.col("_slices") > 1).select("_group", "_slice", "_number", "_slices"), "slices")
    within = Window.partitionBy("_group", "_slice").orderBy("_us")
    narrow = rows.select("_group", "_slice", "_us").join(slices.drop("_slices"), ["_group", "_slice"])
    narrow = narrow.withColumn("_row", F.row_number().over(within)).sortWithinPartitions("_group", "_slice", "_us")
    keys = [rows.schema["_group"], _long("_number")]
    schema = T.StructType([*keys, *from_arrow_type(pa.struct(TABLE)).fields])
    level = narrow.select("_group", "_number", "_us", "_row").mapInArrow(_tabulator(limit, wait), schema)

    names = [name for name, _ in TABLE]
    most = slices.agg(F.max("_slices")).first()[0] or 0
    families = []
    while most > 1:
        family = level.groupBy("_group", F.floor(F.col("_number") / RADIX).alias("_number")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("_number").alias("number"), *names))).alias("_tables"))
        families.append(written(family, f"level-{len(families)}"))
        most = -(-most // RADIX)
        if most > 1:
            composed = families[-1].withColumn("_table", _composed(limit, wait)("_tables"))
            level = composed.select("_group", "_number", *[F.col(f"_table.{name}").alias(name) for name in names])

    nothing = F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in NOTHING_OPEN.items()])
    states = None
    for i, family in reversed(list(enumerate(families))):
        met = family.withColumn("_entry", nothing) if states is None else family.join(states, ["_group", "_number"])
        handed = met.withColumn("_into", _handed_down(limit, wait)("_tables", "_entry"))
        each = F.explode(F.arrays_zip(F.col("_tables.number").alias("number"), F.col("_into").alias("into"))).alias("_each")
        states = handed.select("_group", each).select(
            "_group", F.col("_each.number").alias("_number"), F.col("_each.into").alias("_entry"))
        if i:
            states = written(states, f"states-{i}")
    if states is None:
        return slices.select("_group", "_slice", *[F.lit(v).cast("bigint").alias(c) for c, v in NOTHING_OPEN.items()])
    return slices.join(states, ["_group", "_number"]).select("_group", "_slice", "_entry.*")


def _tabulator(limit: int, wait: int):
    def tabulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        head: pa.RecordBatch | None = None

        def flush() -> pa.RecordBatch:
            table = tabulated(np.concatenate(held), limit, wait)
            return pa.RecordBatch.from_arrays(
                [head.column(0), head.column(1), *[pa.array([table[name]], type=kind) for name, kind in TABLE]],
                names=["_group", "_number", *[name for name, _ in TABLE]])

        for rb in batches:
            if rb.num_rows == 0:
                continue
            us = rb.column(2).to_numpy(zero_copy_only=False)
            row = rb.column(3).to_numpy(zero_copy_only=False)
            heads = np.flatnonzero(row == 1).tolist()
            before = heads[0] if heads else len(us)
            if before:
                held.append(us[:before])
            for start, end in zip(heads, [*heads[1:], len(us)]):
                if held:
                    yield flush()
                head, held = rb.slice(start, 1), [us[start:end]]
        if held:
            yield flush()

    return tabulate


def tabulated(us: np.ndarray, limit: int, wait: int) -> dict:
    """The table of one slice: for each place where its first new batch may start, the batch that is open at its end.

    A batch that is open before the slice ends within ``limit`` rows and before its first time + ``wait``, so no new one can
    start later than that for the first time; ``whole``: the open batch may also take the whole slice.
    """
    last, count, started = exits(us, limit, wait)
    reach = min(len(us), limit + 1, int(np.searchsorted(us, us[0] + wait, side="left")) + 1)
    return {
        "size": len(us), "last_us": int(us[-1]), "whole": reach == len(us), "head_us": us[:reach], "exit_us": us[last[:reach]],
        "exit_count": count[:reach], "exit_started": started[:reach]}


def after(table: dict, state: State, limit: int, wait: int) -> State:
    """The batch that is open after a slice, or a run of slices, from the one before it."""
    opened, count, batch = state
    entry = 0
    if batch >= 0 and count < limit:
        if table["last_us"] < opened + wait and count + table["size"] <= limit:
            return opened, count + table["size"], batch
        entry = min(int(np.searchsorted(table["head_us"], opened + wait, side="left")), limit - count)
    return int(table["exit_us"][entry]), int(table["exit_count"][entry]), batch + int(table["exit_started"][entry])


def compose(first: dict, second: dict, limit: int, wait: int) -> dict:
    """The table of two neighbouring runs of slices."""
    # a new batch starts in the first run ...
    ends = [after(second, (int(u), int(c), int(s)), limit, wait)
            for u, c, s in zip(first["exit_us"], first["exit_count"], first["exit_started"])]
    exits_ = [np.array(x, dtype=np.int64) for x in zip(*ends)]
    heads = first["head_us"]
    if first["whole"]:  # ... or an open batch takes all of that, and it starts in the second
        room = min(max(0, limit + 1 - first["size"]), len(second["head_us"]))
        in_time = int(np.searchsorted(second["head_us"], heads[0] + wait, side="left")) + 1
        room = min(room, in_time)
        heads = np.concatenate([heads, second["head_us"][:room]])
        exits_ = [np.concatenate([a, second[name][:room]]) for a, name in zip(exits_, ("exit_us", "exit_count", "exit_started"))]
    return {
        "size": first["size"] + second["size"], "last_us": second["last_us"],
        "whole": bool(first["whole"] and second["whole"] and len(heads) == len(first["head_us"]) + len(second["head_us"])),
        "head_us": heads, "exit_us": exits_[0], "exit_count": exits_[1], "exit_started": exits_[2]}


def _tables(row: list) -> list[dict]:
    return [{k: np.array(v, dtype=np.int64) if isinstance(v, list) else v for k, v in table.items()} for table in row]


def _composed(limit: int, wait: int):
    kind = pa.struct(TABLE)

    @F.arrow_udf(from_arrow_type(kind))
    def composed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in batches:
            out = []
            for i in range(len(rows)):  # one at a time: the tables of a family are the most a task holds
                table, *others = _tables(rows[i].as_py())
                for other in others:
                    table = compose(table, other, limit, wait)
                table.pop("number", None)
                out.append({k: v.tolist() if isinstance(v, np.ndarray) else v for k, v in table.items()})
            yield pa.array(out, type=kind)

    return composed


def _handed_down(limit: int, wait: int):
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in NOTHING_OPEN]))

    @F.arrow_udf(from_arrow_type(kind))
    def handed_down(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """The batch that is open before each table of a family."""
        for families, entries in batches:
            out = []
            for i in range(len(families)):
                state = tuple(entries[i].as_py().values())
                into = []
                for table in _tables(families[i].as_py()):
                    into.append(dict(zip(NOTHING_OPEN, state)))
                    state = after(table, state, limit, wait)
                out.append(into)
            yield pa.array(out, type=kind)

    return handed_down
