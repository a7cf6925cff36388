"""Removal of long passages that an earlier document has, found by recompression.

A text is a sequence of words. Rounds make it shorter: in a run round every maximal run of one symbol becomes one symbol, in a pair
round symbols are split in two halves by a bit of their names, and every left one that stands before a right one becomes one symbol
with it. A new symbol's name is a hash of the names (and of the run's length, and the round) that it is made of. So names are global
without a table of them: every task gives equal runs and pairs the same name, in every document. Whether a symbol is made depends on
its neighbours alone. Hence equal substrings are parsed alike except near their ends, where each round may lose a symbol on each
side; ``interiors`` keeps count of that, by rules that look at the substring only.

1. Spark joins the names of the last round globally: a symbol is shared if documents with different texts have it.
2. A window of ``window`` words can only stand in another document if every symbol in its interior is shared. Such windows (and the
   few with an empty interior) are named by 128 bits over all their words, which verifies what the symbols reveal, and the smallest
   document of each name is found. Where it is smaller than the window's own, the window's words go.

No window is lost: what is left out has a symbol that no other document has. Both exchanges are pre-aggregated in the tasks: of the
windows of one name that a task sees, those above its smallest document are decided there, and one row goes on. So a passage that a
third of all documents share is a few rows per task. Texts go to Python in bounded batches, and what a task holds back for its
pre-aggregation is bounded as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from .arrow import Memo, texts_of

ROUNDS = "rppprppp"  # runs, pairs
WORDS_AT_ONCE = 500_000
HOT_NAMES = 200_000  # remembered per task, for pre-aggregation
MIX = np.uint64(0x9E3779B97F4A7C15)
NULL_KEY = -(1 << 63)
DOC = ["_key", "_row"]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def word_names(words: Sequence[bytes]) -> list[bytes]:
    return [xxhash.xxh64_digest(w)[::-1] for w in words]


def words_of(text: str) -> list[bytes]:
    """Words of a text: ``bytes.split`` cuts at exactly the white space of ASCII."""
    return text.encode("utf-8", "surrogatepass").split()


def _round(kind: str, number: int, names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Where the symbols of the next round start, their names, and (pair rounds) which of the present ones are right ones."""
    same_doc = doc[1:] == doc[:-1]
    salt = np.uint64((2 * number + 1) * int(MIX) & 0xFFFFFFFFFFFFFFFF)
    head = np.ones(len(names), dtype=bool)
    if kind == "r":
        head[1:] = ~((names[1:] == names[:-1]) & same_doc)
        starts = np.flatnonzero(head)
        lengths = np.diff(np.append(starts, len(names))).astype(np.uint64)
        own = names[starts]
        return starts, np.where(lengths > 1, _mixed(own * MIX + lengths + salt), own), None
    right = ((names * (salt | np.uint64(1))) >> np.uint64(63)).astype(bool)
    joined = ~right[:-1] & right[1:] & same_doc
    head[1:] = ~joined
    starts = np.flatnonzero(head)
    own = names[starts]
    follows = np.append(joined, False)[starts]
    made = _mixed(_mixed(own * MIX + salt) + names[np.minimum(starts + 1, len(names) - 1)])
    return starts, np.where(follows, made, own), right


def recompress(words: np.ndarray, doc: np.ndarray, window: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names and documents of the symbols after the last round, and for each window its interior [from, to) among them.

    ``words`` are the names of all words, ``doc`` the number of the document that each stands in. Windows are given for every
    place at which one fits (none for ``window`` 0); an interior may be empty.
    """
    names = words
    first = np.flatnonzero(doc[:len(doc) - window + 1] == doc[window - 1:]) if 0 < window <= len(doc) else np.zeros(0, np.int64)
    low, high = first, first + window
    for number, kind in enumerate(ROUNDS):
        if not len(names):
            break
        starts, made, right = _round(kind, number, names, doc)
        if len(first):
            head = np.zeros(len(names), dtype=np.int32)
            head[starts] = 1
            group = np.cumsum(head, dtype=np.int32) - 1
            last = np.maximum(high - 1, 0)
            if kind == "r":  # the runs at both ends may go on outside
                low, high = group[np.minimum(low, len(names) - 1)] + 1, group[last]
            else:  # a right one may belong to what stands before, a left one to what follows
                at = np.minimum(low, len(names) - 1)
                low, high = group[at] + right[at], group[last] + right[last]
            high = np.maximum(low, high)
        names, doc = made, doc[starts]
    return names, doc, low, high


class Portion:
    """Named words of some documents of at least ``window`` words: ``words``, and for each the document it stands in."""

    def __init__(self, part: pa.RecordBatch, texts: Sequence[str], memo: Memo, window: int):
        rows = [row if len(row) >= window else [] for row in map(words_of, texts)]
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.words = np.frombuffer(b"".join(b"".join(v) for v in memo.resolve(rows)), dtype="<u8")
        self.doc = np.repeat(np.arange(len(rows)), lengths)
        self.start = np.cumsum(lengths) - lengths
        self.key, self.row = (part.column(i).to_numpy() for i in range(2))


def _portions(batches: Iterator[pa.RecordBatch], text: str, window: int) -> Iterator[tuple[pa.RecordBatch, Portion]]:
    """Parts of batches (``_key``, ``_row``, ``_doc``, ...) with about ``WORDS_AT_ONCE`` words; a longer document is one part."""
    memo = Memo(word_names)
    for batch in batches:
        texts = texts_of(batch.column(2).field(text))
        start, held = 0, 0
        for i, t in enumerate(texts):
            if i > start and held + len(t) > 6 * WORDS_AT_ONCE:
                part = batch.slice(start, i - start)
                yield part, Portion(part, texts[start:i], memo, window)
                start, held = i, 0
            held += len(t)
        if len(texts):
            part = batch.slice(start)
            yield part, Portion(part, texts[start:], memo, window)


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where rows sorted by ``columns`` start a new group."""
    head = np.ones(len(columns[0]), dtype=bool)
    if len(head):
        head[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return head


def _lists(values: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """``values`` cut before each of ``starts``; an empty list is null."""
    ends = np.append(starts, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind), mask=pa.array(np.diff(ends) == 0))


def _name_asker(window: int, text: str) -> Callable:
    """Rows (``name``, ``_key``, ``_row``, ``known``): a document asks who else has a name; or has found out about several names
    in its own task (``known``), where it meets nobody under ``name``."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = np.zeros(0, dtype=np.uint64)

        def rows(name: np.ndarray, doc: np.ndarray, known: pa.Array | None, portion: Portion) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(name.view(np.int64)), pa.array(portion.key[doc]), pa.array(portion.row[doc]),
                pa.nulls(len(name), pa.list_(pa.int64())) if known is None else known], names=["name", *DOC, "known"])

        for _, portion in _portions(batches, text, window):
            names, doc, _, _ = recompress(portion.words, portion.doc)
            if not len(names):
                continue
            order = np.lexsort((doc, names))
            order = order[_heads(names[order], doc[order])]  # each name once per document
            names, doc = names[order], doc[order]
            row = portion.row[doc]
            group = np.cumsum(_heads(names)) - 1
            first = np.flatnonzero(_heads(names))
            several = np.zeros(len(first), dtype=bool)
            several[group[row != row[first][group]]] = True
            heard = np.isin(names[first], hot)
            known = (several | heard)[group]
            told = first[several & ~heard]  # one row tells the other tasks
            if known.any():
                mine = np.flatnonzero(known)
                mine = mine[np.argsort(doc[mine], kind="stable")]
                starts = np.flatnonzero(_heads(doc[mine]))
                own = doc[mine][starts]
                yield rows(_mixed(portion.row[own].view(np.uint64)), own, _lists(names[mine].view(np.int64), starts, pa.int64()), portion)
                hot = np.unique(np.concatenate([hot[-HOT_NAMES:], names[told]]))
            asked = np.concatenate([np.flatnonzero(~known), told])
            asked = asked[np.argsort(doc[asked], kind="stable")]  # a document's rows together: they compress
            yield rows(names[asked], doc[asked], None, portion)

    return ask


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def window_names(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of the words of each window that starts ``at``: polynomials mod 2^64, by prefix sums."""
    out = []
    for base, salt in ((0xC2B2AE3D27D4EB4F, 0), (0x27D4EB2F165667C5, 0xA24BAED4963EE407)):
        inverse = np.uint64(pow(base, -1, 1 << 64))
        named = _mixed(words ^ np.uint64(salt))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(named * _powers(inverse, len(words)), dtype=np.uint64)])
        out.append(_mixed((sums[at + window] - sums[at]) * _powers(np.uint64(base), len(words))[at]))
    return out[0], out[1]


def _window_asker(window: int, text: str) -> Callable:
    """Rows (``s1``, ``s2``, ``_key``, ``_row``, ``place``, ``more``) for windows that may stand elsewhere.

    A row with a ``place`` asks for the smallest document with the window; ``more`` are further places of it in the document. A row
    without one gives places (``more``) whose windows a smaller document of the same task has.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot1, hot2, least = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def rows(s1, s2, doc, place, more, portion) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.array(portion.key[doc]), pa.array(portion.row[doc]),
                place, more], names=["s1", "s2", *DOC, "place", "more"])

        for part, portion in _portions(batches, text, window):
            names, doc, low, high = recompress(portion.words, portion.doc, window)
            if not len(names):
                continue
            shared = part.column(3).flatten().to_numpy(zero_copy_only=False)
            lone = np.concatenate([[0], np.cumsum(~np.isin(names.view(np.int64), shared))])
            fits = np.flatnonzero(portion.doc[:len(portion.doc) - window + 1] == portion.doc[window - 1:])
            at = fits[lone[high] == lone[low]]
            if not len(at):
                continue
            s1, s2 = window_names(portion.words, at, window)
            doc = portion.doc[at]
            place = (at - portion.start[doc]).astype(np.int32)
            order = np.lexsort((place, portion.row[doc], portion.key[doc], s2, s1))
            s1, s2, doc, place = s1[order], s2[order], doc[order], place[order]
            key = portion.key[doc]
            head = _heads(s1, s2)
            group = np.cumsum(head) - 1
            smallest = key[head]
            met = np.searchsorted(hot1, s1[head])
            if len(hot1):
                met = np.minimum(met, len(hot1) - 1)
                same = (hot1[met] == s1[head]) & (hot2[met] == s2[head])
                smallest = np.where(same, np.minimum(smallest, least[met]), smallest)
            decided = key > smallest[group]
            if decided.any():
                mine = np.flatnonzero(decided)
                again = np.unique(group[mine])
                mine = mine[np.argsort(doc[mine], kind="stable")]
                starts = np.flatnonzero(_heads(doc[mine]))
                own = doc[mine][starts]
                salt = _mixed(portion.row[own].view(np.uint64))
                yield rows(salt, salt, own, pa.nulls(len(own), pa.int32()), _lists(place[mine], starts, pa.int32()), portion)
                hot1 = np.concatenate([hot1[-HOT_NAMES:], s1[head][again]])
                hot2 = np.concatenate([hot2[-HOT_NAMES:], s2[head][again]])
                least = np.concatenate([least[-HOT_NAMES:], smallest[again]])
                by = np.lexsort((least, hot2, hot1))
                by = by[_heads(hot1[by])]  # of two names with one first half, one is remembered
                hot1, hot2, least = hot1[by], hot2[by], least[by]
            open_ = np.flatnonzero(~decided)
            s1, s2, doc, place = s1[open_], s2[open_], doc[open_], place[open_]
            once = _heads(s1, s2, doc)  # rows of one key and text are neighbours only per document of the batch
            starts = np.flatnonzero(once)
            extra = np.flatnonzero(~once)
            more = _lists(place[extra], np.searchsorted(extra, starts), pa.int32())
            by = np.lexsort((place[starts], doc[starts]))  # a document's rows together: they compress
            starts = starts[by]
            yield rows(s1[starts], s2[starts], doc[starts], pa.array(place[starts]), more.take(pa.array(by)), portion)

    return ask


KEPT = pa.struct([("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])


def _without(window: int):
    @F.arrow_udf(from_arrow_type(KEPT))
    def without(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """Texts without the windows that start at the given places, their words joined by one space."""
        for texts, places in batches:
            out = []
            for text, at in zip(texts_of(texts), places.to_pylist()):
                words = words_of(text)
                n = len(words)
                if at:
                    change = np.zeros(n + 1, dtype=np.int32)
                    np.add.at(change, at, 1)
                    np.add.at(change, np.asarray(at) + window, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) <= 0)]
                kept = b" ".join(words).decode("utf-8", "surrogatepass")
                out.append({"text": kept, "n_words": n, "n_removed": n - len(words)})
            yield pa.array(out, type=KEPT)

    return without


def remove_repeats(docs: DataFrame, window: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents without the words covered by a window of ``window`` words that a document with a smaller ``key`` has too.

    Adds ``n_words`` and ``n_removed``; ``text`` becomes the kept words joined by one space. Windows are judged on the given texts.
    Words are cut at ASCII white space and compared as they are. ``key`` is a whole number; a null key is smaller than all others.
    Rows of one key take nothing from each other, repeated rows lose the same words. A null text has no words and becomes empty; a
    text with fewer words than the window only loses its spacing. An empty table gives an empty one. All other columns stay; ones
    named ``n_words`` or ``n_removed`` are replaced, other names do not matter.
    """
    number = F.coalesce(F.col(key).cast("bigint"), F.lit(NULL_KEY))
    named = docs.select(number.alias("_key"), F.xxhash64(key, text).alias("_row"), F.struct(*docs.columns).alias("_doc"))
    keys = "_key bigint, _row bigint"

    names = named.mapInArrow(_name_asker(window, text), f"name bigint, {keys}, known array<bigint>")
    by_name = Window.partitionBy("name")
    met = names.withColumn("_shared", F.min("_row").over(by_name) != F.max("_row").over(by_name))
    shared = met.where(F.col("_shared") | F.col("known").isNotNull()).groupBy(*DOC).agg(F.array_distinct(F.concat(
        F.collect_list(F.when(F.col("known").isNull(), F.col("name"))), F.flatten(F.collect_list("known")))).alias("_names"))

    # a document without shared names is asked all the same: a window of few words over and over has no interior
    asked = named.join(shared, DOC, "left").select(*DOC, "_doc", "_names")
    windows = asked.mapInArrow(_window_asker(window, text), f"s1 bigint, s2 bigint, {keys}, place int, more array<int>")
    least = F.min("_key").over(Window.partitionBy("s1", "s2"))
    found = windows.withColumn("_least", least).where((F.col("_least") < F.col("_key")) | F.col("place").isNull())
    places = found.groupBy(*DOC).agg(F.array_distinct(F.concat(
        F.collect_list("place"), F.flatten(F.collect_list("more")))).alias("_places"))

    joined = named.join(places, DOC, "left").select("_doc", _without(window)(F.col("_doc")[text], F.col("_places")).alias("_kept"))
    new = {text: F.col("_kept.text"), "n_words": F.col("_kept.n_words"), "n_removed": F.col("_kept.n_removed")}
    columns = [*docs.columns, *[c for c in new if c not in docs.columns]]
    return joined.select(*[(new[c] if c in new else F.col("_doc")[c]).alias(c) for c in columns])
