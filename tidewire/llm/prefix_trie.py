"""Prefix trie of conversations, built and totalled by van Emde Boas recursion over depths.

A conversation is a sequence of turns; a node of the trie is a distinct sequence of first turns, the root the empty one.

Naming. Sequences are cut at half depth: the sequence of turns before the cut, within what was named already, gets a name that
equal sequences share. The cut prefixes of one name are leaves of an upper trie and the root of one lower forest. Upper and
lower parts are cut again in the same round, so the number of rounds is the logarithm of the longest conversation, and a round
is one join over all parts at once. A half's own name comes from its halves (``_block_names``), so no row holds more than a
turn. Names are SHA-256 digests of two names, the same in every task; nodes are grouped by name and depth.

Totals. A part of height 1 is a node with its own value. Twice the height: the totals of the lower forests' roots are grafted
onto the nodes above the cut, all of them at once: the turns of one member of each root (its smallest) name the nodes above
it. After the last round each node has the total of its whole subtree.

Rows per round are bounded by the turns of the members that stand for nodes. Counts of a name are pre-aggregated, so a first
turn that a third of all conversations share arrives as one row per task. Tables of a round are written to the run folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_run_folder

PIECE_IDS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def _digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def turn_name(role: Column, text: Column) -> Column:
    """Digest of a turn; the length of the role keeps role and text apart."""
    return _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


class _Folder:
    """Tables of one run, each written once and read again."""

    def __init__(self, spark):
        self.spark, self.path = spark, new_run_folder(spark, "trie")

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.read(df, name)

    def read(self, like: DataFrame, *names: str) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(*[f"{self.path}/{name}" for name in names])


def _block_names(items: DataFrame, rounds: int, folder: _Folder) -> list[DataFrame]:
    """Names of complete aligned blocks of 1, 2, 4, ... turns: (``seq``, ``block``, ``name``) per size."""
    levels = [folder.stored(items.select("seq", (F.col("place") - 1).alias("block"), F.col("token").alias("name")), "blocks-0")]
    for j in range(1, rounds):
        half = F.col("block") % 2
        both = levels[-1].groupBy("seq", F.shiftright("block", 1).alias("block")).agg(
            F.max(F.when(half == 0, F.col("name"))).alias("left"), F.max(F.when(half == 1, F.col("name"))).alias("right"))
        named = both.where(F.col("right").isNotNull()).select("seq", "block", _digest(F.concat("left", "right")).alias("name"))
        levels.append(folder.stored(named, f"blocks-{j}"))
    return levels


def _prefix_names(items: DataFrame, members: DataFrame, rounds: int, folder: _Folder) -> DataFrame:
    """(``seq``, ``depth``, ``name``) for every prefix of every member, from the longest cuts to the shortest."""
    blocks = _block_names(items, rounds, folder) if rounds else []
    root = F.unhex(F.sha2(F.lit("").cast("binary"), 256))
    names = folder.stored(members.select("seq", F.lit(0).cast("bigint").alias("depth"), root.alias("name")), "names")
    tables = ["names"]
    for j in reversed(range(rounds)):
        # a part starts where a longer cut, or the root, has been named; its upper half is a block with an even number
        halves = blocks[j].where("block % 2 = 0").select(
            "seq", (F.col("block") * (1 << j)).alias("depth"), F.col("name").alias("half"))
        cut = folder.read(names, *tables).join(halves, ["seq", "depth"]).select(
            "seq", (F.col("depth") + (1 << j)).alias("depth"), _digest(F.concat("name", "half")).alias("name"))
        folder.stored(cut, f"names-{j}")
        tables.append(f"names-{j}")
    return folder.read(names, *tables)


def _grafted(nodes: DataFrame, prefixes: DataFrame, rounds: int, folder: _Folder) -> DataFrame:
    """``nodes`` (name, seq, depth, leaves, saved) with ``leaves`` and ``saved`` summed over each node's subtree."""
    standing = folder.stored(prefixes.join(nodes.select("seq").distinct(), "seq", "left_semi"), "standing")
    for j in range(rounds):
        part = F.shiftright("depth", j + 1)
        roots = nodes.where(F.col("depth") % (2 << j) == 1 << j).select("seq", part.alias("part"), "leaves", "saved")
        above = standing.where(F.col("depth") % (2 << j) < 1 << j).select("seq", part.alias("part"), "depth", "name")
        onto = above.join(roots, ["seq", "part"]).groupBy("name", "depth").agg(
            F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        summed = nodes.join(onto, ["name", "depth"], "left")
        nodes = folder.stored(summed.select(
            "name", "seq", "depth",
            *[(F.col(c) + F.coalesce(F.col(f"_{c}"), F.lit(0))).alias(c) for c in ("leaves", "saved")]), f"totals-{j}")
    return nodes


def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (name, id) rows as texts of at most ``PIECE_IDS`` ids."""
    def piece():
        return pa.RecordBatch.from_pydict({"name": [name], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

    name, ids = None, []
    for batch in batches:
        for at, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (at != name or len(ids) >= PIECE_IDS):
                yield piece()
                ids = []
            name = at
            ids.append(value)
    if ids:
        yield piece()


def _joined_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 per name over its pieces, which come one after the other: only the digest's state is held."""
    name, state = None, None
    for batch in batches:
        for at, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at != name:
                if state:
                    yield pa.RecordBatch.from_pydict({"name": [name], "ends": [state.hexdigest()]})
                name, state = at, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state:
        yield pa.RecordBatch.from_pydict({"name": [name], "ends": [state.hexdigest()]})


def end_digests(ends: DataFrame) -> DataFrame:
    """(``name``, ``ends``): SHA-256 of each name's ids, ascending in decimal, joined by commas.

    Ids meet as texts made per sorted range. The digest itself runs through a name's pieces one by one, as SHA-256 must; the task
    that does so holds one piece at a time.
    """
    runs = ends.select("name", "seq").repartitionByRange("name", "seq").sortWithinPartitions("name", "seq")
    pieces = runs.mapInArrow(_id_pieces, "name binary, first bigint, ids string")
    ordered = pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return ordered.mapInArrow(_joined_digest, "name binary, ends string")


def prefix_trie(items: DataFrame, members: DataFrame) -> DataFrame:
    """A row per node of the trie of the members' sequences.

    ``items``: ``seq`` (bigint), ``place`` (bigint, 1, 2, ... without gaps per seq), ``token`` (binary, equal for equal items),
    ``weight`` (bigint, equal for equal items). ``members``: ``seq``, each once; a member without items ends at the root.

    Returns ``seq`` (the smallest member, which with ``depth`` identifies the node), ``depth``, ``parent_seq`` (null for the
    root), ``n_members``, ``n_children``, ``n_leaves`` (childless nodes of the subtree, itself included), ``saved`` (the sum over
    the subtree of (members - 1) * weight of the last item) and ``ends`` (digest of the members that end here). No members: no rows.
    Other columns of the inputs are ignored.
    """
    folder = _Folder(items.sparkSession)
    items = folder.stored(items.select("seq", "place", "token", "weight"), "items")
    members = folder.stored(members.select("seq"), "members")
    rounds = int(items.agg(F.max("place")).first()[0] or 0).bit_length()
    prefixes = _prefix_names(items, members, rounds, folder)

    weights = items.select("seq", F.col("place").alias("depth"), "weight")
    nodes = folder.stored(prefixes.join(weights, ["seq", "depth"], "left").groupBy("name", "depth").agg(
        F.min("seq").alias("seq"), F.count("seq").alias("n_members"), F.coalesce(F.max("weight"), F.lit(0)).alias("weight")), "nodes")
    before = prefixes.select("seq", (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    linked = folder.stored(nodes.join(before, ["seq", "depth"], "left"), "linked")
    children = linked.where(F.col("parent").isNotNull()).groupBy("parent", (F.col("depth") - 1).alias("depth")).agg(
        F.count("seq").alias("n_children")).withColumnRenamed("parent", "name")
    counted = folder.stored(linked.join(children, ["name", "depth"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)).cast("bigint")), "counted")

    own = counted.select(
        "name", "seq", "depth", (F.col("n_children") == 0).cast("bigint").alias("leaves"),
        ((F.col("n_members") - 1) * F.col("weight")).alias("saved"))
    totals = _grafted(own, prefixes, rounds, folder)

    ended = prefixes.groupBy("seq").agg(F.max("depth").alias("depth"))
    ends = end_digests(prefixes.join(ended, ["seq", "depth"]))
    parents = nodes.select(F.col("name").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("seq").alias("parent_seq"))
    out = counted.join(parents, ["parent", "depth"], "left")
    out = out.join(totals.select("name", "depth", F.col("leaves").alias("n_leaves"), "saved"), ["name", "depth"])
    out = out.join(ends, "name", "left")
    return out.select(
        "seq", "depth", "parent_seq", "n_members", "n_children", "n_leaves", "saved",
        F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends"))


def conversation_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """``prefix_trie`` of conversations: ``turns`` has ``conv_id``, ``place`` (1, 2, ...), ``role`` and ``text``; ``members`` has
    ``conv_id``. Null roles and texts count as empty, conversations with a null id are left out, a repeated id counts once.
    ``saved`` counts the words of the last text. Other columns are ignored, whatever their names."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    items = turns.where("conv_id is not null").select(
        F.col("conv_id").alias("seq"), F.col("place").cast("bigint").alias("place"), turn_name(role, text).alias("token"),
        word_count(text).alias("weight"))
    return prefix_trie(items, members.where("conv_id is not null").select(F.col("conv_id").alias("seq")).distinct())
