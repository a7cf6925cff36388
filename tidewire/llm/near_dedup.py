"""Near-duplicate documents by MinHash, banding and groups of linked documents.

A document is the set of its five-word shingles. Documents with equal sets form a class, of which one stands for all from
the start. Classes get ``bands * rows`` minima of universal hash functions, kept as one byte each; classes that agree in all
rows of a band share a bucket. ``bands_for`` chooses so many bands that a pair at the threshold is missed with probability
below 1e-6.

Pairs within a bucket are not listed. In each round every bucket picks one centre at random (by a hash of the round), and
every member that is not yet in the centre's component is tried against the ``TRIES`` centres it meets in most buckets.
Tried pairs are estimated by their signatures, those that may be links confirmed on the full shingle sets, and links joined
into groups by alternating large-star and small-star. After ``ROUNDS`` rounds most buckets lie in one component and are
done. Members of the others are compared by signature across groups, in blocks of bounded size, and a pair is only
written where it may be a link, in the first bucket the two share. So every pair that shares a bucket is in one component or
was compared, and no link is lost.

Words are cut at ASCII white space; A-Z are lower-cased. With fewer than five words the whole sequence is the one shingle.
Null texts and texts without words have an empty set and are linked with nothing. Rows with one key are one document; a null
key is linked with nothing. An empty table gives an empty table; columns other than key and text are not read, so their names
do not matter. Shingles are compared by 64-bit hashes, classes by 128-bit ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from ..plans.binding import bind
from ..plans.joins import copied_to_pieces, dealt_to_pieces, hot_keys
from ..session import new_run_folder
from .arrow import Memo, texts_of
from .linked_groups import group_roots, stored

WORDS = 5
MISSED = 1e-6
ROUNDS = 2
TRIES = 6
SIGNATURE = 704  # minima kept at least, for the estimates
SURE = 4.5  # standard errors an estimate may lie below the threshold
BLOCK = 1_024
MIX = np.uint64(0x9E3779B97F4A7C15)
SKETCH = pa.struct([("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sig", pa.binary())])


def bands_for(percent: int, rows: int) -> int:
    """Bands of ``rows`` rows that miss a pair of ``percent`` similarity with probability below ``MISSED``."""
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** rows))


def word_hashes(words: Sequence[bytes]) -> list[bytes]:
    return [xxhash.xxh64_digest(w)[::-1] for w in words]


def shingle_sets(texts: Sequence[str], memo: Memo) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    rows = [text.encode("utf-8", "surrogatepass").lower().split() for text in texts]
    lengths = [len(r) for r in rows]
    words = np.frombuffer(b"".join(b"".join(v) for v in memo.resolve(rows)), dtype="<u8")
    rolled = np.zeros(max(0, len(words) - WORDS + 1), dtype=np.uint64)
    for k in range(WORDS):
        rolled = rolled * MIX + words[k:k + len(rolled)]
    rolled = _mixed(rolled)
    start = 0
    for n in lengths:
        if n >= WORDS:
            yield np.unique(rolled[start:start + n - WORDS + 1])
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[start:start + n]:
                    whole = whole * MIX + w
            yield _mixed(np.array([whole ^ np.uint64(0x5851F42D4C957F2D)]))
        else:
            yield np.zeros(0, dtype=np.uint64)
        start += n


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """One byte of the minimum of each hash function a * x + b (mod 2^32)."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(least, (a[:, None] * x[None, at:at + 1024] + b[:, None]).min(axis=1), out=least)
    return ((least * np.uint32(0x85EBCA6B)) >> np.uint32(24)).astype(np.uint8).tobytes()


def sketcher(n_hashes: int) -> Callable[[Column], Column]:
    """A column function text -> number of shingles, 128-bit hash of the set, signature (null for an empty set)."""
    rng = np.random.Generator(np.random.PCG64(7))
    a = rng.integers(0, 1 << 31, n_hashes, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, n_hashes, dtype=np.uint32)

    @F.arrow_udf(from_arrow_type(SKETCH))
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = Memo(word_hashes)
        for batch in batches:
            rows = []
            for shingles in shingle_sets(texts_of(batch), memo):
                if len(shingles):
                    h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), dtype="<i8").tolist()
                    rows.append({"n": len(shingles), "h1": h1, "h2": h2, "sig": signature(shingles, a, b)})
                else:
                    rows.append({"n": 0, "h1": None, "h2": None, "sig": None})
            yield pa.array(rows, type=SKETCH)

    return sketch


@F.arrow_udf(T.BinaryType())
def shingle_bytes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    memo = Memo(word_hashes)
    for batch in batches:
        yield pa.array([s.tobytes() for s in shingle_sets(texts_of(batch), memo)], type=pa.binary())


@F.arrow_udf(T.IntegerType())
def equal_bytes(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in batches:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(len(x), -1) for x in (left, right))
        yield pa.array((a == b).sum(axis=1), type=pa.int32())


@F.arrow_udf(T.LongType())
def shared_shingles(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in batches:
        sets = ((np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")) for a, b in zip(left.to_pylist(), right.to_pylist()))
        yield pa.array([len(np.intersect1d(a, b, assume_unique=True)) for a, b in sets], type=pa.int64())


def _comparer(n_bands: int, rows: int, least: int, percent: int) -> Callable:
    """Pairs of one group (consecutive rows, two blocks of a bucket) that may be links and first meet in its band."""

    def pairs(group: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rep, comp, n = (group[c].to_numpy() for c in ("rep", "comp", "n"))
        low, high, band = group["low"].to_numpy(), group["high"].to_numpy(), group["band"].iat[0]
        sig = np.frombuffer(b"".join(group["sig"]), np.uint8).reshape(len(group), -1)
        bands = sig[:, :n_bands * rows].reshape(len(group), n_bands, rows)
        for at in range(0, len(group), 32):
            i, j = np.nonzero(
                (comp[at:at + 32, None] != comp) & (rep[at:at + 32, None] != rep)
                & np.where(low[at:at + 32, None] & high[at:at + 32, None], rep[at:at + 32, None] < rep, low[at:at + 32, None] & ~low)
                & (np.minimum(n[at:at + 32, None], n) * 100 >= percent * np.maximum(n[at:at + 32, None], n)))
            i += at
            for part in range(0, len(i), 16_384):
                a, b = i[part:part + 16_384], j[part:part + 16_384]
                likely = (sig[a] == sig[b]).sum(axis=1) >= least
                a, b = a[likely], b[likely]
                first = (bands[a] == bands[b]).all(axis=2).argmax(axis=1) == band
                a, b = rep[a[first]], rep[b[first]]
                if len(a):
                    yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            group = batch["group"].to_numpy()
            cuts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
            for start, stop in zip(cuts, cuts[1:]):
                if held and held[0]["group"].iat[0] != group[start]:
                    yield from pairs(pd.concat(held))
                    held = []
                held.append(batch[start:stop])
        if held:
            yield from pairs(pd.concat(held))

    return compare


class _Search:
    """The tables of one run: classes (rep, n, sig), bucket entries (bucket, rep), shingle sets (rep, shingles)."""

    def __init__(self, docs: DataFrame, key: str, text: str, percent: int, rows: int):
        self.folder = new_run_folder(docs.sparkSession, "near")
        self.percent, self.n_bands = percent, bands_for(percent, rows)
        self.n_hashes, self.rows = max(self.n_bands * rows, SIGNATURE), rows
        t = percent / 100
        self.least = math.floor(self.n_hashes * (t - SURE * math.sqrt(t * (1 - t) / self.n_hashes)))
        texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        sketched = texts.select("key", sketcher(self.n_hashes)(F.col("text")).alias("s")).select("key", "s.*")
        self.sketches = stored(sketched, self.folder, "sketches")
        linked = self.sketches.where("n > 0 and key is not null")
        reps = linked.groupBy("h1", "h2").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"))
        self.reps = stored(reps, self.folder, "reps")
        first = linked.withColumnRenamed("key", "rep").join(self.reps, ["h1", "h2", "rep"], "left_semi")
        self.classes = stored(first.dropDuplicates(["rep", "h1", "h2"]).select("rep", "n", "sig"), self.folder, "classes")
        hashes = F.transform(F.sequence(F.lit(0), F.lit(self.n_bands - 1)), lambda k: F.xxhash64(
            k, F.substring(F.col("sig"), k * rows + 1, F.lit(rows))))
        entries = self.classes.select("rep", F.posexplode(hashes).alias("band", "bucket"))
        shared = entries.groupBy("bucket").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).where("x <> y")
        self.entries = stored(entries.join(shared, "bucket", "left_semi"), self.folder, "entries")
        self.n_entries = self.entries.count()
        if self.n_entries:
            wanted = self.entries.select(F.col("rep").alias("key")).distinct()
            sets = texts.join(wanted, "key", "left_semi").select(F.col("key").alias("rep"), shingle_bytes("text").alias("shingles"))
            self.sets = stored(sets, self.folder, "sets")
        self.tried: DataFrame | None = None
        self.labels: DataFrame | None = None  # (rep, comp) of classes that are not their component's root
        self.round = 0

    def labelled(self) -> DataFrame:
        if self.labels is None:
            return self.entries.withColumn("comp", F.col("rep"))
        joined = self.entries.join(self.labels, "rep", "left")
        return joined.select("bucket", "band", "rep", F.coalesce("comp", "rep").alias("comp"))

    def star_pairs(self) -> DataFrame:
        entries = stored(self.labelled(), self.folder, f"labelled-{self.round}")
        centre = entries.groupBy("bucket").agg(
            F.min("comp").alias("x"), F.max("comp").alias("y"),
            F.min(F.struct(F.xxhash64("rep", F.lit(self.round)), "rep", "comp")).alias("c"),
        ).where("x <> y").select("bucket", F.col("c.rep").alias("centre"), F.col("c.comp").alias("centre_comp"))
        met = entries.join(centre, "bucket").where("comp <> centre_comp")
        met = self.untried(met.groupBy(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b"), "rep").agg(
            F.count(F.lit(1)).alias("times")))
        # a member has one centre in each of its buckets, so at most as many as there are bands
        best = met.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("times", "a", "b")), asc=False).alias("p"))
        return best.select(F.explode(F.slice("p", 1, TRIES)).alias("p")).select("p.a", "p.b").distinct()

    def open_pairs(self) -> DataFrame:
        """All pairs that share a bucket, are in different groups, and may be links by their signatures.

        A bucket of m members is cut into blocks; a task sees two blocks at a time.
        """
        entries = stored(self.labelled(), self.folder, f"labelled-{self.round}")
        mixed = entries.groupBy("bucket").agg(
            F.min("comp").alias("x"), F.max("comp").alias("y"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")
        ).where("x <> y").select("bucket", "blocks")
        members = entries.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        members = members.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
        lo, hi = F.least("block", "other"), F.greatest("block", "other")
        dealt = members.select(
            F.xxhash64("bucket", lo, hi).alias("group"), "band", "rep", "comp", (F.col("block") == lo).alias("low"),
            (F.col("block") == hi).alias("high"))
        full = dealt.join(self.classes, "rep").repartition("group").sortWithinPartitions("group", "rep")
        kind = self.classes.schema["rep"].dataType.simpleString()
        found = full.select("group", "band", "rep", "comp", "low", "high", "n", "sig").mapInPandas(
            _comparer(self.n_bands, self.rows, self.least, self.percent), f"a {kind}, b {kind}")
        return self.untried(found.distinct())

    def untried(self, pairs: DataFrame) -> DataFrame:
        return pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti")

    def try_pairs(self, pairs: DataFrame, estimated: bool = False) -> int:
        """Compare pairs of classes, add the links to the groups, and return how many links there were.

        ``estimated``: their signatures have been compared already.
        """
        pairs = stored(pairs, self.folder, f"pairs-{self.round}")
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        def beside(df: DataFrame, table: DataFrame, column: str) -> DataFrame:
            for side in ("a", "b"):
                df = df.join(table.select(F.col("rep").alias(side), F.col(column).alias(f"{column}_{side}")), side)
            return df

        likely = pairs
        if not estimated:
            guessed = bind(beside(pairs, self.classes, "sig"), "equal", equal_bytes("sig_a", "sig_b"))
            likely = guessed.where(F.col("equal") >= self.least).select("a", "b").distinct()
            likely = stored(likely, self.folder, f"likely-{self.round}")
        shared = bind(beside(likely, self.sets, "shingles"), "shared", shared_shingles("shingles_a", "shingles_b"))
        union = (F.length("shingles_a") + F.length("shingles_b")) / 8 - F.col("shared")
        links = stored(shared.where(F.col("shared") * 100 >= union * self.percent).select("a", "b"), self.folder, f"links-{self.round}")
        n = links.count()
        if n:
            self.merge(links)
        self.round += 1
        return n

    def merge(self, links: DataFrame) -> None:
        here = f"{self.folder}/merge-{self.round}"
        if self.labels is None:
            self.labels = group_roots(links, here).select(F.col("node").alias("rep"), F.col("root").alias("comp"))
            return
        for side in ("a", "b"):  # links between groups instead of classes
            of = self.labels.select(F.col("rep").alias(side), F.col("comp").alias("_c"))
            links = links.join(of, side, "left").withColumn(side, F.coalesce("_c", side)).drop("_c")
        moved = stored(group_roots(links.select("a", "b").distinct(), here), here, "moved")
        old = self.labels.join(moved, self.labels["comp"] == moved["node"], "left").select(
            "rep", F.coalesce("root", "comp").alias("comp"))
        new = moved.join(self.labels, moved["node"] == self.labels["rep"], "left_anti")
        self.labels = stored(old.unionByName(new.select(F.col("node").alias("rep"), F.col("root").alias("comp"))), here, "labels")

    def run(self) -> None:
        if not self.n_entries:
            return
        for _ in range(ROUNDS):
            self.try_pairs(self.star_pairs())
        self.try_pairs(self.open_pairs(), estimated=True)


def near_duplicates(docs: DataFrame, percent: int = 80, rows: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id (smallest key reachable by links of at least ``percent``
    similarity, its own included), kept (whether it is that one)."""
    search = _Search(docs, key, text, percent, rows)
    search.run()
    equal = ["h1", "h2"]
    hot = hot_keys(search.reps, equal, "copies")  # a class of many exact copies meets its row in pieces
    classes = search.reps.drop("copies")
    if search.labels is not None:
        classes = classes.join(search.labels, "rep", "left").withColumn("rep", F.coalesce("comp", "rep")).drop("comp")
    members = dealt_to_pieces(search.sketches.select("key", "n", *equal), hot, equal, ["key"])
    found = members.join(copied_to_pieces(classes, hot, equal), [*equal, "_piece"], "left")
    component = F.when(F.col("key").isNotNull(), F.coalesce("rep", "key"))
    return found.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"))
