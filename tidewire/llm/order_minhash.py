"""Order MinHash fingerprints of texts, with DataFrame functions only.

A text is a sequence of tokens (words, cut after 16 letters; single characters in scripts without spaces; runs of up to four
other signs). Its k-mers are runs of ``k`` tokens, numbered by occurrence, so a repeated k-mer counts as often as it stands.
Each of the ``m`` parts of a fingerprint orders the numbered k-mers, takes the ``l`` smallest, puts them back into
text order and hashes the tuple. Two texts agree in a component when they share the chosen k-mers in the same order, so
the share of equal parts falls with the edit distance, moved passages included.

One hash per numbered k-mer serves all parts: hashes are sorted once, and the order of component c begins at the c-th
of m equal parts of the hash range and wraps around. A text's work is a few sorts of its own k-mers, inside one row and
without Python; nothing is shuffled.

K-mers are told apart by 40 bits of their hash within a text. Places are kept modulo 2^24, so the order of k-mers is the text's
order in texts of up to 16.7 million tokens.

Null and empty texts, and texts of white space alone, have no k-mers; all their parts are 0. A text of fewer than ``k``
tokens is one k-mer. Texts are used whole. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.binding import bind
from ..plans.ordering import slice_of

K, L, M_BITS = 2, 2, 6
TOKEN = (
    r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}]|[\p{L}\p{M}\p{N}]{1,16}|[^\s\p{L}\p{M}\p{N}]{1,4}"
)
PLACE_BITS = 24  # an item is 40 bits of hash and 24 of place, so that sorting sorts plain numbers
PLACES = (1 << PLACE_BITS) - 1


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), 0)


def item(value: Column, place: Column) -> Column:
    return value.bitwiseAND(F.lit(~PLACES)).bitwiseOR(place.bitwiseAND(F.lit(PLACES)))


def hash_of(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def numbered(found: Column) -> Column:
    """Items of (k-mer, occurrence) in hash order, from k-mer items in hash order."""

    def again(x: Column, i: Column) -> Column:
        return (i > 0) & (hash_of(F.get(found, i - 1)) == hash_of(x))

    def first(x: Column) -> Column:
        return item(F.xxhash64(hash_of(x), F.lit(0)), x)

    def repeats(later: Column) -> Column:
        """Second and later occurrences; ``later`` are their places in ``found``. Neighbouring places are one run."""

        def runs(heads: Column) -> Column:
            def run(head: Column, j: Column) -> Column:
                stop = F.coalesce(F.get(heads, j + 1), F.size(later)) - 1
                return let(F.get(later, head), lambda begin: F.transform(F.sequence(begin, begin + stop - head), lambda p: let(
                    F.get(found, p), lambda x: item(F.xxhash64(hash_of(x), p - begin + 1), x))))

            return F.flatten(F.transform(heads, run))

        heads = F.array_compact(F.transform(later, lambda i, j: F.when((j == 0) | (F.get(later, j - 1) != i - 1), j)))
        return let(heads, runs)

    def joined(firsts: Column) -> Column:
        later = F.array_compact(F.transform(found, lambda x, i: F.when(again(x, i), i)))
        return F.when(F.size(firsts) == F.size(found), firsts).otherwise(F.concat(firsts, let(later, repeats)))

    firsts = F.array_compact(F.transform(found, lambda x, i: F.when(~again(x, i), first(x))))
    return F.sort_array(let(firsts, joined))


def fingerprint(text: Column, k: int = K, l: int = L, m_bits: int = M_BITS) -> Column:  # noqa: E741
    """The text's fingerprint, an array of 2 ** ``m_bits`` integers."""
    m = 1 << m_bits

    def kmers(tokens: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(tokens) - k, F.lit(0)))
        return F.when(F.size(tokens) > 0, F.sort_array(F.transform(
            starts, lambda i: item(F.xxhash64(*[F.get(tokens, i + j) for j in range(k)]), i.cast("bigint")))))

    def part(x: Column) -> Column:  # which m-th of the hash range
        return (F.shiftright(x, 64 - m_bits) + m // 2).cast("int")

    def chosen_parts(ring: Column) -> Column:
        def taken(places: Column) -> Column:
            def component(c: Column) -> Column:
                begin = F.coalesce(F.get(places, c), F.lit(0))
                def turned(x: Column) -> Column:  # place first, so that sorting restores text order
                    return F.shiftleft(x, 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS))

                chosen = F.sort_array(F.array(*[turned(F.get(ring, (begin + j) % F.size(ring))) for j in range(l)]))
                hashed = let(chosen, lambda c: F.xxhash64(*[
                    F.get(c, j).bitwiseAND(F.lit((1 << (64 - PLACE_BITS)) - 1)) for j in range(l)]))
                return (hashed.bitwiseAND(F.lit(0xFFFFFFFF)) - (1 << 31)).cast("int")

            return F.transform(F.sequence(F.lit(0), F.lit(m - 1)), component)

        def jumps(leaders: Column) -> Column:
            # place of the first item in or after each part; parts behind the last item wrap around to place 0
            return F.flatten(F.transform(leaders, lambda i, j: F.array_repeat(i, part(F.get(ring, i)) - F.when(
                j == 0, F.lit(-1)).otherwise(part(F.get(ring, F.get(leaders, j - 1)))))))

        leaders = F.array_compact(F.transform(ring, lambda x, i: F.when(
            (i == 0) | (part(F.get(ring, i - 1)) != part(x)), i)))
        return let(let(leaders, jumps), taken)

    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))
    found = let(let(tokens, kmers), lambda s: F.when(s.isNotNull(), let(numbered(s), chosen_parts)))
    return F.coalesce(found, F.array_repeat(F.lit(0), m))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts, 0 to 1."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", **options: int) -> DataFrame:
    """Add the fingerprint of ``text``."""
    return bind(df.drop(out), out, fingerprint(F.col(text), **options))


def with_next(df: DataFrame, key: str, columns: list[str], slices_per_partition: int = 8,
              computed: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Add ``next_<column>`` for each of ``columns``: the value in the row with the next larger ``key``; the last row's
    next is the first.

    The key range is cut at quantiles into slices, and the first rows of each slice are handed to the slice before as
    guests, so every row finds its next one inside its slice and no task sees more than a slice. Keys are numbers; null
    keys come first; rows with equal keys are ordered by ``columns``. ``computed`` gives further columns as functions of
    the row, to be worked out once per row; they and their next ones are added too.
    """
    computed = dict(computed or {})
    spark = df.sparkSession
    slices = slices_per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    points = df.agg(F.percentile_approx(key, [i / slices for i in range(1, slices)], 20 * slices).alias("p")).first()["p"]
    rows = df.select(F.struct(*df.columns).alias("_row"), F.col(key).alias("_key"))
    sliced = bind(rows, "_slice", F.coalesce(slice_of(F.col("_key"), sorted(set(points or []))), F.lit(0)))
    # at most one row per slice
    heads = sorted(
        (r["_slice"], r["_head"][0]) for r in sliced.groupBy("_slice").agg(F.min(F.struct("_key")).alias("_head")).collect())
    kind = df.schema[key].dataType.simpleString()
    before = spark.createDataFrame([(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)], f"_head {kind}, _to int")
    guests = sliced.join(F.broadcast(before), F.col("_key").eqNullSafe(F.col("_head"))).drop("_slice", "_head")
    both = sliced.withColumn("_guest", F.lit(0)).unionByName(
        guests.withColumnRenamed("_to", "_slice").withColumn("_guest", F.lit(1)))
    for i, fn in enumerate(computed.values()):
        both = bind(both, f"_new_{i}", fn(F.col("_row")))
    order = Window.partitionBy("_slice").orderBy("_guest", "_key", *[F.col("_row")[c] for c in columns])
    values = {c: F.col("_row")[c] for c in columns} | {c: F.col(f"_new_{i}") for i, c in enumerate(computed)}
    led = both.withColumns({f"_lead_{i}": F.lead(v).over(order) for i, v in enumerate(values.values())}).where("_guest = 0")
    named = {c: values[c].alias(c) for c in computed}
    named |= {f"next_{c}": F.col(f"_lead_{i}").alias(f"next_{c}") for i, c in enumerate(values)}
    return led.select(*[F.col("_row")[c].alias(c) for c in df.columns if c not in named], *named.values())
