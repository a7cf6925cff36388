"""Merkle manifest of a dataset: trees kept as aligned subtrees in van Emde Boas order.

Every group (a language, say) has a tree over its rows in key order, and the groups' roots have a tree of their own. A tree is cut
into aligned subtrees of ``2 ** BLOCK_LEVELS`` leaves. Such a block is one row: its digests stand in one binary in van Emde Boas
order: the upper half of the levels first, then one block of the lower half for each of its leaves, each laid out the same way. So
the way from a leaf to the block's root stays in few stretches of memory at every scale. ``address`` works out a node's place by
arithmetic alone; it serves construction (children to parent) and retrieval (siblings of the way up). The roots of the blocks are
the leaves of the next level of blocks, until one block is left. Going down again, a block's way to the root of everything is worked
out once and handed to the blocks below it, so a leaf's proof needs its own block and one list.

Two digests become one by SHA-256 of their hex texts; the last node of an odd run is hashed alone, also within the last block. A tree
ends where one node remains. Blocks are bounded rows, positions come from distributed numbering, each level is written to the run
folder. At a thousand leaves a block, a level has a thousandth of the rows of the one below.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from ..plans.ordering import numbered
from ..session import new_run_folder

BLOCK_LEVELS = 10
ROWS_PER_SLICE = None  # the share of a shuffle partition
SIZE = 32
STEPS = pa.list_(pa.string())  # a way up: "L" or "R" and the sibling that stands there, "-" for a node without one
PROOF = pa.struct([("proof", pa.string()), ("folded", pa.string())])


def record_digest(*columns: str) -> Column:
    """Lowercase hex SHA-256 of the columns: ``-`` for null, else byte count, ``:`` and the value as text."""
    def field(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def address(height: int, depth: int, index):
    """Place of the node ``index`` at ``depth`` (0 is the root) of a perfect tree with ``height`` levels; numbers or arrays."""
    if height == 1:
        return index * 0
    upper = height // 2
    if depth < upper:
        return address(upper, depth, index)
    lower, below = height - upper, depth - upper
    return (1 << upper) - 1 + (index >> below) * ((1 << lower) - 1) + address(lower, below, index & ((1 << below) - 1))


@lru_cache(maxsize=None)
def places(height: int) -> list[list[int]]:
    """The address of every node by level, leaves first."""
    return [address(height, height - 1 - k, np.arange(1 << (height - 1 - k))).tolist() for k in range(height)]


def parent(left: bytes, right: bytes = b"") -> bytes:
    return hashlib.sha256((left.hex() + right.hex()).encode()).digest()


def lay_out(leaves: Sequence[bytes], height: int) -> bytes:
    """The block over ``leaves`` (at most ``2 ** (height - 1)``) in van Emde Boas order; places without a node are zero."""
    at = places(height)
    block = bytearray(SIZE * ((1 << height) - 1))
    nodes = list(leaves)
    for k in range(height):
        for i, digest in enumerate(nodes):
            start = SIZE * at[k][i]
            block[start:start + SIZE] = digest
        nodes = [parent(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]
    return bytes(block)


def way_up(block: bytes, height: int, n: int, index: int) -> list[str]:
    """The siblings from leaf ``index`` of ``n`` to the block's root."""
    at, steps = places(height), []
    for k in range(height - 1):
        other = index ^ 1
        if other < n:
            start = SIZE * at[k][other]
            steps.append(("L" if index & 1 else "R") + block[start:start + SIZE].hex())
        else:
            steps.append("-")
        index, n = index >> 1, (n + 1) >> 1
    return steps


def fold(leaf: str, steps: Sequence[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for step in steps:
        both = leaf if step == "-" else step[1:] + leaf if step[0] == "L" else leaf + step[1:]
        leaf = hashlib.sha256(both.encode()).hexdigest()
    return leaf


@F.arrow_udf(T.BinaryType())
def _laid_out(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for leaves, heights in batches:
        yield pa.array([lay_out(row, h) for row, h in zip(leaves.to_pylist(), heights.to_pylist())], type=pa.binary())


@F.arrow_udf(from_arrow_type(pa.list_(STEPS)))
def _ways_down(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """For every leaf of a block its way to the root of everything."""
    for blocks, heights, sizes, above in batches:
        rows = zip(blocks.to_pylist(), heights.to_pylist(), sizes.to_pylist(), above.to_pylist())
        yield pa.array([[way_up(b, h, n, i) + up for i in range(n)] for b, h, n, up in rows], type=pa.list_(STEPS))


@F.arrow_udf(from_arrow_type(pa.list_(PROOF)))
def _proofs(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """For every leaf of a block the digest of its siblings and the root that its presented leaf leads to."""
    for blocks, heights, above, presented in batches:
        out = []
        for block, h, up, leaves in zip(blocks.to_pylist(), heights.to_pylist(), above.to_pylist(), presented.to_pylist()):
            found = []
            for i, leaf in enumerate(leaves):
                steps = way_up(block, h, len(leaves), i) + up
                proof = hashlib.sha256("".join(s[1:] for s in steps).encode()).hexdigest()
                found.append({"proof": proof, "folded": fold(leaf, steps)})
            out.append(found)
        yield pa.array(out, type=pa.list_(PROOF))


def _blocks(nodes: DataFrame, kept: Sequence[str]) -> DataFrame:
    """One row per block of ``nodes`` (group, n, pos, digest, kept): ``n`` nodes of the group at this level, ``rows`` in order."""
    full = 1 << BLOCK_LEVELS
    rows = nodes.groupBy("_group", "_n", F.shiftright("_pos", BLOCK_LEVELS).alias("_block")).agg(
        F.sort_array(F.collect_list(F.struct("_pos", "_digest", *kept))).alias("_rows"))
    # a tree of one block ends with its last node; blocks of a larger one all have the full height
    height = F.when(F.col("_n") > full, BLOCK_LEVELS + 1).otherwise(F.ceil(F.log2(F.col("_n").cast("double"))) + 1).cast("int")
    return rows.withColumn("_height", height).withColumn("_tree", _laid_out(F.col("_rows._digest"), "_height"))


def _levels(nodes: DataFrame, folder: str, name: str, kept: Sequence[str] = ()) -> list[DataFrame]:
    """Blocks of all groups' trees, level by level, written below ``folder``. ``nodes``: group, n, pos, digest, kept."""
    spark, full, levels = nodes.sparkSession, 1 << BLOCK_LEVELS, []
    while True:
        path = f"{folder}/{name}-{len(levels)}"
        _blocks(nodes, kept if not levels else ()).write.parquet(path)
        levels.append(spark.read.parquet(path))
        # one row tells whether a larger tree is left
        if not levels[-1].where(F.col("_n") > full).select("_n").head(1):
            return levels
        nodes = levels[-1].where(F.col("_n") > full).select(
            "_group", F.ceil(F.col("_n") / full).alias("_n"), F.col("_block").alias("_pos"),
            F.substring("_tree", 1, SIZE).alias("_digest"))


def _roots(levels: Sequence[DataFrame]) -> DataFrame:
    """(group, root digest) of every tree."""
    ended = [b.where(F.col("_n") <= 1 << BLOCK_LEVELS).select("_group", F.substring("_tree", 1, SIZE).alias("_root")) for b in levels]
    out = ended[0]
    for more in ended[1:]:
        out = out.unionByName(more)
    return out


def _ways(levels: Sequence[DataFrame], tops: DataFrame, folder: str, name: str) -> DataFrame:
    """The lowest level's blocks with ``_up``, the way from the block's root upwards, and the other columns of ``tops``.

    ``tops``: group, ``_up`` (the way from the group's root) and columns to hand down.
    """
    handed = [c for c in tops.columns if c not in ("_group", "_up")]
    ways = None
    for k in reversed(range(len(levels))):
        last = levels[k].where(F.col("_n") <= 1 << BLOCK_LEVELS).select("_group", "_block").join(tops, "_group")
        last = last.select("_group", "_block", "_up", *handed)
        ways = last if ways is None else ways.unionByName(last)
        met = levels[k].join(ways, ["_group", "_block"])
        if not k:
            return met
        down = met.withColumn("_ways", _ways_down("_tree", "_height", F.size("_rows"), "_up"))
        one = down.select("_group", *handed, F.explode(F.arrays_zip(F.col("_rows._pos").alias("p"), F.col("_ways").alias("w"))).alias("_w"))
        one = one.select("_group", F.col("_w.p").alias("_block"), F.col("_w.w").alias("_up"), *handed)
        one.write.parquet(f"{folder}/{name}-ways-{k}")
        ways = levels[0].sparkSession.read.schema(one.schema).parquet(f"{folder}/{name}-ways-{k}")
    return ways


class Manifest:
    """The written trees of a dataset."""

    def __init__(self, rows: list[DataFrame], groups: list[DataFrame], folder: str):
        self.rows, self.groups, self.folder = rows, groups, folder

    def root(self) -> DataFrame:
        """One row: the digest of the whole dataset in hex (no row for an empty one)."""
        return _roots(self.groups).select(F.lower(F.hex("_root")).alias("root"))


def build_manifest(docs: DataFrame, key: str, group: str, digest: Column, presented: Column | None = None) -> Manifest:
    """Trees over the rows' ``digest`` (hex), one per value of ``group`` in ascending ``key`` order, and one over the groups' roots.

    Groups are ordered by their text's bytes, null first. A null key comes first; rows of one key are ordered by their digest,
    and repeated rows are leaves of their own. ``presented`` is the digest that ``prove`` checks in place of the row's own where
    it is not null. Other columns do not matter, whatever their names. No rows: empty tables.
    """
    spark = docs.sparkSession
    folder = new_run_folder(spark, "manifest")
    group_text = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    nothing = F.lit(None).cast("string")
    docs.select(
        group_text.alias("_group"), F.col(key).alias("_key"), F.unhex(digest).alias("_digest"),
        (nothing if presented is None else presented).alias("_presented"),
    ).write.parquet(f"{folder}/leaves")
    leaves = spark.read.parquet(f"{folder}/leaves")
    placed = numbered(leaves, ["_group"], ["_key", "_digest"], "_place", "_n", rows_per_slice=ROWS_PER_SLICE)
    rows = _levels(placed.withColumn("_pos", F.col("_place") - 1), folder, "rows", ["_key", "_presented"])
    subroots = _roots(rows).select(F.col("_group").alias("_of"), F.col("_root").alias("_digest"))
    subroots.write.parquet(f"{folder}/subroots")
    placed = numbered(spark.read.parquet(f"{folder}/subroots"), [], ["_of"], "_place", "_n", rows_per_slice=ROWS_PER_SLICE)
    groups = _levels(placed.withColumns({"_pos": F.col("_place") - 1, "_group": F.lit("")}), folder, "groups", ["_of"])
    return Manifest(rows, groups, folder)


def prove(manifest: Manifest) -> DataFrame:
    """A row per leaf: ``key``, ``leaf``, ``subroot``, ``root`` (hex), ``proof`` (digest of its siblings from leaf to root, left to
    right, "" where there is none) and ``folded`` (the root that the presented leaf, or else the leaf, and the siblings lead to)."""
    tops = _roots(manifest.groups).select(
        "_group", F.array().cast("array<string>").alias("_up"), F.lower(F.hex("_root")).alias("root"))
    top = _ways(manifest.groups, tops, manifest.folder, "groups")
    met = top.withColumn("_ways", _ways_down("_tree", "_height", F.size("_rows"), "_up"))
    each = met.select("root", F.explode(F.arrays_zip(F.col("_rows").alias("r"), F.col("_ways").alias("w"))).alias("_w")).select(
        F.col("_w.r._of").alias("_group"), F.col("_w.w").alias("_up"), F.lower(F.hex("_w.r._digest")).alias("subroot"), "root")
    blocks = _ways(manifest.rows, each, manifest.folder, "rows")
    presented = F.transform("_rows", lambda r: F.coalesce(r["_presented"], F.lower(F.hex(r["_digest"]))))
    proved = blocks.withColumn("_proofs", _proofs("_tree", "_height", "_up", presented))
    one = proved.select("subroot", "root", F.explode(F.arrays_zip(F.col("_rows").alias("r"), F.col("_proofs").alias("p"))).alias("_w"))
    return one.select(
        F.col("_w.r._key").alias("key"), F.lower(F.hex("_w.r._digest")).alias("leaf"), "subroot", "root",
        F.col("_w.p.proof").alias("proof"), F.col("_w.p.folded").alias("folded"))
