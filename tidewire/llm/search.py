"""Exact top-k BM25 search over an inverted index per shard and merged.

Texts are cut into terms once. Each task packs the documents it reads into shards of at most ``SHARD_DOCS`` rows and about
``SHARD_PARTS * PART_POSTINGS`` postings and writes each as one row, already inverted: its terms and, per term, postings in document order.
Everything after reads those rows; no posting is shuffled. Queries are written in blocks of about ``QUERY_BLOCK`` rows or
``PART_POSTINGS`` terms, a row each. Each shard meets each block in a cross join of those rows, which reads what is written
and shuffles nothing either, so disk and shuffles grow with the corpus although the comparisons grow with its square.

A term in more than one in ``COMMON`` of all documents is common (at most ``COMMON_TERMS`` are). A shard has a matrix of the
common terms' contributions to each of its documents, and of every term its postings in lines of ``LINE``. A block's queries are
written so that neighbours have the same common terms, and scored ``GROUP`` at a time: a common term that many of the group's
queries and the shard's documents have goes into one matrix product of the group, the other terms' lines are added to it. These
sums are of single precision, so they only choose: documents whose sum comes, but for what rounding may have cost it, up to the
k-th best of the shard, or to what the task's earlier shards reached, are scored again in double precision, term by term. A task
takes up to ``TASK_SHARDS`` shards, as each leaves fewer documents of the next to be scored again, and meets ``TASK_BLOCKS`` blocks
with them. Document frequencies, number of documents, average length and common terms are those of the whole corpus and terms are
added in one order, so scores do not depend on the shard and the k best of all shards' k best are exact. Ties go to the smaller
key. (Bounds by block maxima were tried for this: they left 97 of 100 ranges of 64 documents to be scored, as whole documents as
queries share many words with every range.) Every query still meets every document: disk and shuffles grow with the corpus, the
work of the cross join with its square.

Rows and postings of shards and blocks are bounded (but for a single longer document), so a task's memory does not grow with
the corpus or with long texts.

A term is a maximal run of word characters, lower-cased; a query weighs a term by how often it has it. Null or empty
texts match nothing; queries without terms give no rows; documents that share no term with a query are not in its result.
Repeated rows are documents of their own. Null keys are not searched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_run_folder
from .arrow import texts_of

K1, B = 1.2, 0.75
SHARD_DOCS = 8_192
PART_POSTINGS = 500_000  # of a block of queries
SHARD_PARTS = 2  # a shard has as many postings as so many blocks
QUERY_BLOCK = 8_192
PRODUCT_CELLS = 2_000_000  # of queries times documents at once
ADDED_AT_ONCE = 131_072  # of postings, filled-up lines included
COMMON, COMMON_TERMS, ALIKE_TERMS = 32, 2_048, 512
GROUP = 256  # of queries scored together
LINE = 8  # of postings, a multiple of the 4 numbers in a word
NARROW = 1 << 16  # of cells numbered by 16 bits; more than SHARD_DOCS
EACH = 0x0001000100010001  # 1 in each of a word's numbers of 16 bits
POSTING_COST = 200  # of a posting added, as times that of a cell of a matrix product for one term
TABLE_CELLS = 1 << 20  # of documents times terms
FLUSH_TERMS = 1_000_000
HELD_QUERIES = 100_000
TASK_SHARDS, TASK_BLOCKS = 128, 4
SMALLEST = np.finfo(np.float32).tiny
WORD = re.compile(r"\w+")
ASCII_WORDS = bytes(ord(chr(i).lower()) if i < 128 and WORD.match(chr(i)) else 32 for i in range(256))


def words_of(text: str) -> Sequence[str | bytes]:
    """Lower-cased runs of word characters; those of an ASCII text as bytes."""
    return text.encode().translate(ASCII_WORDS).split() if text.isascii() else WORD.findall(text.lower())


def text_terms(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of the terms of all texts, one after the other, and the number of each text's."""
    rows = [words_of(text) for text in texts]
    lengths = np.array([len(row) for row in rows], np.int64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, chain.from_iterable(rows)), np.uint64, lengths.sum())
    return (hashes >> np.uint64(1)).astype(np.int64), lengths


def _distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each of the batch's texts (second column), and its distinct terms, ascending, with their numbers."""
    terms, lengths = text_terms(texts_of(batch.column(1)))
    ends = np.cumsum(lengths)
    return lengths, [np.unique(terms[end - n:end], return_counts=True) for end, n in zip(ends, lengths)]


def _bytes(values: np.ndarray, kind: str) -> pa.Array:
    return pa.array([values.astype(kind).tobytes()], pa.binary())


def _narrow(values: np.ndarray) -> pa.Array:
    """Numbers >= 0 in as few bytes as the largest one takes."""
    return _bytes(values, np.min_scalar_type(values.max(initial=0)).newbyteorder("<"))


def _wide(value: pa.Scalar, n: int) -> np.ndarray:
    """The ``n`` numbers that ``_narrow`` packed."""
    return _read(value, f"<u{len(value.as_buffer()) // n}") if n else np.zeros(0, np.uint8)


def _read(value: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), kind)


def written_shards(docs: DataFrame, key: str, text: str, folder: str) -> DataFrame:
    """A row per shard: ``keys`` ascending, ``lengths`` in words, ``terms`` ascending, ``counts`` of their postings, and the
    postings' ``places`` (numbers of documents, ascending within a term) and ``times``; number of documents and of words."""
    kind = docs.schema[key].dataType.simpleString()

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        keys = pa.concat_arrays([row[0] for row in rows])
        order = np.argsort(keys.to_numpy(zero_copy_only=False), kind="stable")
        lengths, found = np.concatenate([row[1] for row in rows])[order], [x for row in rows for x in row[2]]
        found = [found[i] for i in order]
        places = np.repeat(np.arange(len(found), dtype=np.int32), [len(t) for t, _ in found])
        terms, times = (np.concatenate([x[side] for x in found]) for side in (0, 1))
        by_term = np.argsort(terms, kind="stable")
        names, counts = np.unique(terms, return_counts=True)
        keys = keys.take(pa.array(order))
        return pa.RecordBatch.from_arrays([
            pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys), _bytes(lengths, "<i8"), _bytes(names, "<i8"),
            _narrow(counts), _narrow(places[by_term]), _narrow(times[by_term]),
            pa.array([len(keys)], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
        ], ["keys", "lengths", "terms", "counts", "places", "times", "n_docs", "n_words"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_docs, n_postings = [], 0, 0
        for batch in batches:
            lengths, found = _distinct(batch)
            begin = 0
            for i, (terms, _) in enumerate(found):
                n_docs, n_postings = n_docs + 1, n_postings + len(terms)
                if n_docs >= SHARD_DOCS or n_postings >= SHARD_PARTS * PART_POSTINGS:
                    held.append((batch.column(0)[begin:i + 1], lengths[begin:i + 1], found[begin:i + 1]))
                    yield packed(held)
                    held, n_docs, n_postings, begin = [], 0, 0, i + 1
            if begin < len(found):
                held.append((batch.column(0)[begin:], lengths[begin:], found[begin:]))
        if held:
            yield packed(held)

    docs.select(key, text).mapInArrow(
        cut, f"keys array<{kind}>, lengths binary, terms binary, counts binary, places binary, times binary, n_docs bigint, n_words bigint",
    ).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def document_frequencies(shards: DataFrame, folder: str) -> DataFrame:
    """(term, df) over all documents, written. Added up in the tasks first."""

    def added(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        terms, counts = (np.concatenate([x[side] for x in held]) for side in (0, 1))
        names, at = np.unique(terms, return_inverse=True)
        sums = np.bincount(at, counts, len(names)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(sums)], ["term", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for terms, counts in zip(*(batch.column(side) for side in (0, 1))):
                terms = _read(terms, "<i8")
                held.append((terms, _wide(counts, len(terms))))
                if sum(len(t) for t, _ in held) > FLUSH_TERMS:
                    yield added(held)
                    held = []
        if held:
            yield added(held)

    counts = shards.select("terms", "counts").mapInArrow(count, "term bigint, df bigint")
    counts.groupBy("term").agg(F.sum("df").alias("df")).write.parquet(folder)
    return shards.sparkSession.read.parquet(folder)


class ShardIndex:
    """The inverted index of one shard, from a row of ``written_shards``. ``common``: the corpus's common terms, ascending."""

    def __init__(
        self, lengths: pa.Scalar, terms: pa.Scalar, counts: pa.Scalar, places: pa.Scalar, times: pa.Scalar, common: np.ndarray, average: float,
    ):
        lengths, self.terms, self.common = _read(lengths, "<i8"), _read(terms, "<i8"), common
        counts = _wide(counts, len(self.terms)).astype(np.int64)
        self.places, self.tf = (_wide(x, int(counts.sum())) for x in (places, times))
        self.norm = K1 * (1 - B + B * lengths / average)
        rough = (self.tf * (K1 + 1) / (self.tf + self.norm[self.places])).astype(np.float32)
        self.start = start = np.cumsum(counts) - counts
        # the last column and the rest of a term's last line stand for no document
        row, here = _places_of(common, self.terms)
        self.common_counts = np.where(here, np.append(counts, 0)[row], 0)
        postings, n = _slices(start[row[here]], start[row[here]] + counts[row[here]])
        self.full = np.zeros((len(common), len(lengths) + 1), np.float32)
        self.full[np.repeat(np.flatnonzero(here), n), self.places[postings]] = rough[postings]
        lines = -(-counts // LINE)
        self.last = np.cumsum(lines)
        self.first = self.last - lines
        cells = np.arange(len(rough)) + np.repeat(self.first * LINE - start, counts)
        self.lines = np.full((lines.sum(), LINE), len(lengths), "<u2")
        self.lines.reshape(-1)[cells] = self.places
        self.lines = self.lines.view(np.uint64)
        self.line_values = np.zeros((lines.sum(), LINE), np.float32)
        self.line_values.reshape(-1)[cells] = rough
        self.by_doc, self.table = None, np.zeros(0, np.int32)

    def top(
        self, terms: np.ndarray, at: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int, least: np.ndarray,
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of queries, ascending, places and scores of their ``k`` best documents, best first, but for those that score
        below the query's ``least``; some queries at a time.

        ``sizes``: how many of ``at`` (places among the distinct ``terms``, ascending within a query) and ``weights`` belong to each
        query.
        """
        n_docs, width = len(self.norm), len(self.norm) + 1
        # a rounded sum of n numbers >= 0 is off by at most n + 3 roundings, and so is what it is compared with
        margin = np.maximum(0, 1 - 3 * (sizes + 8.0) * 2.0 ** -24)
        row, is_common = _places_of(terms, self.common)
        row[~is_common] = len(self.common)
        rank, here = _places_of(terms, self.terms)
        rank[~here] = -1
        rank = rank[at]
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        rough_weights = weights.astype(np.float32)
        step = max(1, min(GROUP, PRODUCT_CELLS // width))
        held: list[tuple[np.ndarray, np.ndarray]] = []  # queries and documents that may be among their best
        for low in range(0, len(sizes), step):
            high = min(low + step, len(sizes))
            own = slice(ends[low], ends[high])
            query = np.repeat(np.arange(high - low), sizes[low:high])
            # a term of many of these queries and documents goes into a matrix product
            rows = row[at[own]]
            asking = np.bincount(rows, minlength=len(self.common) + 1)[:-1]
            dense = np.flatnonzero(asking * self.common_counts * POSTING_COST > (high - low) * n_docs)
            column = np.full(len(self.common) + 1, -1)
            column[dense] = np.arange(len(dense))
            column = column[rows]
            often = np.flatnonzero(column >= 0)
            asked = _added(query[often] * len(dense) + column[often], weights[own][often], (high - low) * len(dense))
            sums = asked.reshape(high - low, len(dense)).astype(np.float32) @ self.full[dense]
            # the others' postings are added to it
            rare = np.flatnonzero((column < 0) & (rank[own] >= 0))
            query, rare_rank, rare_weights = query[rare], rank[own][rare], rough_weights[own][rare]
            first, last = self.first[rare_rank], self.last[rare_rank]
            rare_ends = np.searchsorted(query, np.arange(high - low + 1))
            work = np.append(0, np.cumsum(last - first))[rare_ends] * LINE
            begin = 0
            while begin < high - low:
                end = int(np.searchsorted(work, work[begin] + ADDED_AT_ONCE, "right")) - 1
                end = max(begin + 1, min(end, begin + NARROW // width))
                own = slice(rare_ends[begin], rare_ends[end])
                lines, n = _slices(first[own], last[own])
                cells, values = self.lines.take(lines, axis=0), self.line_values.take(lines, axis=0)
                before = np.repeat((query[own] - begin).astype(np.uint64) * np.uint64(width * EACH), n)
                for side in range(cells.shape[1]):  # all numbers of a word at once
                    cells[:, side] += before
                values *= np.repeat(rare_weights[own], n)[:, None]
                np.add.at(sums[begin:end].reshape(-1), cells.view("<u2").reshape(-1).astype(np.intp), values.reshape(-1))
                begin = end
            limit = np.maximum(least[low:high] * margin[low:high], SMALLEST).astype(np.float32)
            some = np.flatnonzero(sums.max(axis=1) >= limit)
            sums, limit = sums[some], limit[some]
            chosen = sums >= limit[:, None]
            many = np.flatnonzero(np.count_nonzero(chosen, axis=1) > k)
            if len(many):
                kth = np.partition(sums[many], width - k, axis=1)[:, width - k]
                chosen[many] &= sums[many] >= (kth * margin[low + some[many]]).astype(np.float32)[:, None]
            found, doc = np.divmod(np.flatnonzero(chosen), width)
            held.append((low + some[found], doc))
            if sum(len(x) for x, _ in held) >= ADDED_AT_ONCE or high == len(sizes):
                number, doc = (np.concatenate([x[side] for x in held]) for side in (0, 1))
                held = []
                exact = self._exact(number, doc, rank, weights, ends)
                order = np.lexsort((doc, -exact, number))
                places = np.arange(len(number)) - np.searchsorted(number, number)
                order = order[(places < k) & (exact[order] >= least[number[order]])]
                yield number[order], doc[order], exact[order]

    def _exact(self, number: np.ndarray, doc: np.ndarray, rank: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Scores of pairs of a query and a document, in double precision, term by term. ``rank``: places of the queries' terms
        among this shard's, -1 for none."""
        if self.by_doc is None:
            order = np.argsort(self.places, kind="stable")
            counts = np.diff(np.append(self.start, len(order)))
            self.by_doc = (np.repeat(np.arange(len(self.terms)), counts)[order], self.tf[order],
                           np.append(0, np.cumsum(np.bincount(self.places, minlength=len(self.norm)))))
        ranks, times, doc_ends = self.by_doc
        by_doc = np.argsort(doc, kind="stable")
        docs, begins = np.unique(doc[by_doc], return_index=True)
        begins = np.append(begins, len(doc))
        some = max(1, TABLE_CELLS // max(1, len(self.terms)))
        if not len(self.table):
            self.table = np.zeros(some * len(self.terms), np.int32)
        exact = np.zeros(len(doc))
        for begin in range(0, len(docs), some):
            # how often these documents have each term
            these = docs[begin:begin + some]
            postings, n = _slices(doc_ends[these], doc_ends[these + 1])
            cells = np.repeat(np.arange(len(these)) * len(self.terms), n) + ranks[postings]
            self.table[cells] = times[postings]
            pairs = by_doc[begins[begin]:begins[begin + len(these)]]
            slot = np.searchsorted(these, doc[pairs])
            work = np.append(0, np.cumsum(ends[number[pairs] + 1] - ends[number[pairs]]))
            part = 0
            while part < len(pairs):
                stop = max(part + 1, int(np.searchsorted(work, work[part] + 4 * ADDED_AT_ONCE, "right")) - 1)
                asking = number[pairs[part:stop]]
                own, n = _slices(ends[asking], ends[asking + 1])
                at = rank[own]
                tf = self.table[np.repeat(slot[part:stop] * len(self.terms), n) + at]
                hits = np.flatnonzero((tf > 0) & (at >= 0))
                of, tf = np.repeat(np.arange(stop - part), n)[hits], tf[hits]
                values = weights[own[hits]] * (tf * (K1 + 1) / (tf + self.norm[doc[pairs[part:stop]]][of]))
                exact[pairs[part:stop]] = _added(of, values, stop - part)
                part = stop
            self.table[cells] = 0
        return exact


def _alike_together(of: np.ndarray, columns: np.ndarray, n: int, n_columns: int) -> np.ndarray:
    """An order of ``n`` queries in which neighbours have many common terms alike: halved along the direction they differ most in,
    and again. ``of``, ``columns``: query and number of each common term in a query."""
    has = np.zeros((n, n_columns), np.float32)
    has[of, columns] = 1

    def halved(rows: np.ndarray) -> Iterator[np.ndarray]:
        if len(rows) <= GROUP or not n_columns:
            yield rows
            return
        apart = has[rows]
        apart -= apart.mean(axis=0)
        axis = apart.std(axis=0)
        for _ in range(8):
            axis = (apart @ axis) @ apart
            axis /= max(np.linalg.norm(axis), SMALLEST)
        rows = rows[np.argsort(apart @ axis, kind="stable")]
        half = len(rows) // 2
        del apart
        yield from halved(rows[:half])
        yield from halved(rows[half:])

    return np.concatenate([*halved(np.arange(n))])


def _added(places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values at each of ``n`` places, added in their order."""
    return np.bincount(places, values, n) if len(places) else np.zeros(n)


def _places_of(values: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``values`` stand in ``among`` (ascending), and whether they do."""
    at = np.searchsorted(among, values)
    here = at < len(among)
    here[here] = among[at[here]] == values[here]
    return at, here


def _slices(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, one after the other, and the length of each."""
    n = stops - starts
    return np.arange(n.sum()) + np.repeat(starts - (np.cumsum(n) - n), n), n


def written_queries(
    queries: DataFrame, frequencies: DataFrame, n_docs: int, key: str, text: str, folder: str, common: np.ndarray = np.zeros(0, np.int64),
) -> DataFrame:
    """A row per block of queries: ``ids``, ``sizes`` (numbers of distinct terms), the block's distinct ``terms``, ascending, and of
    each query after the other ``at``, its terms' places among them, ascending, and ``times``; ``idf`` of the distinct terms. Queries
    that have the same of ``common`` (ascending) stand together."""
    kind = queries.schema[key].dataType.simpleString()

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            found = _distinct(batch)[1]
            row = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
            terms, times = (np.concatenate([x[side] for x in found]) for side in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(terms), pa.array(times)], ["query_id", "term", "n"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids, terms, times, idf = (pa.concat_arrays([x.column(side) for x in held]) for side in range(4))
            names, first, at = np.unique(terms.flatten().to_numpy(), return_index=True, return_inverse=True)
            sizes = terms.value_lengths().to_numpy().astype(np.int64)
            row, is_common = _places_of(names, common)
            often = np.flatnonzero(is_common[at])
            order = _alike_together(np.repeat(np.arange(len(ids)), sizes)[often], row[at[often]], len(ids), len(common))
            ends = np.cumsum(sizes)
            own = _slices((ends - sizes)[order], ends[order])[0]
            ids = ids.take(pa.array(order))
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), _bytes(sizes[order], "<i4"),
                _bytes(names, "<i8"), _bytes(at[own], "<i4"), _narrow(times.flatten().to_numpy()[own]),
                _bytes(idf.flatten().to_numpy()[first], "<f8")], ["ids", "sizes", "terms", "at", "query_times", "idf"])

        held, n, size = [], 0, 0
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            n, size = n + len(batch), size + len(batch.column(1).flatten())
            if n >= 2 * QUERY_BLOCK or size >= 2 * PART_POSTINGS:
                yield packed(held)
                held, n, size = [], 0, 0
        if held:
            yield packed(held)

    rows = queries.select(key, text).mapInArrow(flat, f"query_id {kind}, term bigint, n bigint")
    idf = F.log(1 + (F.lit(n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighted = rows.join(frequencies, "term").select("query_id", F.struct("term", "n", idf.alias("idf")).alias("t"))
    lists = weighted.groupBy("query_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    lists = lists.select("query_id", F.col("t.term").alias("terms"), F.col("t.n").alias("times"), F.col("t.idf").alias("idf"))
    lists.write.parquet(f"{folder}-lists")
    lists = queries.sparkSession.read.parquet(f"{folder}-lists")
    total = lists.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    blocks = max(1, math.ceil(total["n"] / QUERY_BLOCK), math.ceil(total["terms"] / PART_POSTINGS))
    lists.repartition(blocks).mapInArrow(
        pack, f"ids array<{kind}>, sizes binary, terms binary, at binary, query_times binary, idf binary").write.parquet(folder)
    return queries.sparkSession.read.parquet(folder)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, ``key``, score): the ``k`` best documents for each row of ``queries`` (same column names)."""
    docs, queries = (d.select(key, text).where(F.col(key).isNotNull()) for d in (docs, queries))
    folder = new_run_folder(docs.sparkSession, "search")
    shards = written_shards(docs, key, text, f"{folder}/shards")
    frequencies = document_frequencies(shards, f"{folder}/frequencies")
    total = shards.agg(
        F.count("*").alias("shards"), F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
    n_docs, average = total["n"], max(1.0, total["words"] / max(1, total["n"]))
    often = frequencies.where(F.col("df") * COMMON > n_docs).orderBy(F.desc("df"), "term").limit(COMMON_TERMS)
    often = np.array([r["term"] for r in often.collect()], np.int64)
    blocks = written_queries(queries, frequencies, n_docs, key, text, f"{folder}/queries", np.sort(often[:ALIKE_TERMS]))
    common = np.sort(often)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, index, keys, key_type = None, None, None, None
        best: dict = {}  # of this task's shards so far, by query

        def found() -> pa.RecordBatch:
            rows = [(query, *hit) for query, hits in best.items() for hit in hits]
            best.clear()
            query, score, hit = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(query, key_type), pa.array(hit, key_type), pa.array(score, pa.float64())], ["query_id", "key", "score"])

        for batch in batches:
            key_type = batch.schema.field("keys").type.value_type
            for i in range(len(batch)):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                if row["shard"].as_py() != number:
                    number, keys = row["shard"].as_py(), row["keys"].values.to_pylist()
                    index = ShardIndex(*(row[c] for c in ("lengths", "doc_terms", "counts", "places", "times")), common, average)
                sizes, queries = _read(row["sizes"], "<i4"), row["ids"].values.to_pylist()
                terms, at, idf = (_read(row[c], kind) for c, kind in (("terms", "<i8"), ("at", "<i4"), ("idf", "<f8")))
                weights = _wide(row["query_times"], len(at)) * idf[at]
                least = np.array([hits[-1][0] if len(hits := best.get(query, ())) == k else 0.0 for query in queries])
                for hits in index.top(terms, at, weights, sizes, k, least):
                    for i, group in groupby(zip(*(side.tolist() for side in hits)), itemgetter(0)):
                        hits = [*best.get(queries[i], ()), *((score, keys[place]) for _, place, score in group)]
                        best[queries[i]] = sorted(hits, key=lambda hit: (-hit[0], hit[1]))[:k]
                if len(best) > HELD_QUERIES:
                    yield found()
        if best:
            yield found()

    numbered = shards.select(
        F.monotonically_increasing_id().alias("shard"), "keys", "lengths", F.col("terms").alias("doc_terms"), "counts", "places", "times")
    # the more shards a task has seen, the fewer documents of the next one are scored again
    n_parts = math.ceil(blocks.count() / TASK_BLOCKS) or 1
    tasks = max(math.ceil(total["shards"] / TASK_SHARDS), math.ceil(2 * docs.sparkSession.sparkContext.defaultParallelism / n_parts))
    pairs = numbered.coalesce(tasks).hint("shuffle_replicate_nl").crossJoin(blocks.coalesce(n_parts))
    hits = pairs.mapInArrow(run, f"query_id {kind}, key {kind}, score double")
    # a task passes on the k best of a query only
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("key").alias(key), "score")
