"""Byte-level BPE encoding and decoding by a public rank file.

A text is cut by the vocabulary's pattern; each match is encoded on its own. Distinct pieces of a batch are merged
together: pieces of similar length form the rows of a padded matrix of token ids, and in each round every row merges its
leftmost pair of minimum rank, all rows at once. Ranks of pairs come from an open-addressing hash table in numpy; after a
merge each row is compacted by one place.

Nulls and empty texts have no ids. A text of any length is encoded whole; one single piece longer than ``MATRIX_BYTES``
(a run of letters without a break) is merged by a heap, so that its cost stays n log n. Results depend on the text only.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, cut_at_spaces, texts_of

MATRIX_BYTES = 512
MATRIX_CELLS = 1 << 20
NONE = np.uint32(0xFFFFFFFF)


class PairRanks:
    """(left id, right id) -> id of the merged token, for arrays of pairs."""

    def __init__(self, pairs: Sequence[tuple[int, int, int]]):
        left, right, merged = (np.array(x, dtype=np.uint64) for x in zip(*pairs)) if pairs else [np.zeros(0, np.uint64)] * 3
        keys = left << np.uint64(32) | right
        bits = max(4, int(len(pairs) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.iinfo(np.uint64).max, dtype=np.uint64)
        self.ids = np.full(1 << bits, NONE, dtype=np.uint32)
        slots, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.ids[slots[todo]] == NONE]
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            self.keys[slots[placed]], self.ids[slots[placed]] = keys[placed], merged[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slots[todo] = (slots[todo] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merged ids, ``NONE`` where the pair does not merge."""
        keys = (left.astype(np.uint64) << np.uint64(32) | right).ravel()
        slots = self._slots(keys)
        out = self.ids[slots]
        miss = np.flatnonzero((self.keys[slots] != keys) & (out != NONE))
        while len(miss):
            slots[miss] = (slots[miss] + 1) & self.mask
            out[miss] = self.ids[slots[miss]]
            miss = miss[(self.keys[slots[miss]] != keys[miss]) & (out[miss] != NONE)]
        return out.reshape(left.shape)


class Vocabulary:
    """Token bytes by id, and the merges that follow from their ranks (a token's id is its rank)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.uint32)
        self.merges = PairRanks([
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in ranks.items() for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks
        ])

    def encode_pieces(self, pieces: Sequence[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit numbers. A piece that is itself a token is that token."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif not piece:
                out[i] = b""
            elif len(piece) > MATRIX_BYTES:
                out[i] = self._by_heap(piece)
            else:
                buckets.setdefault((len(piece) + 1) // 2, []).append(i)
        for width, rows in buckets.items():
            step = max(1, MATRIX_CELLS // (2 * width))
            for at in range(0, len(rows), step):
                self._by_matrix(pieces, rows[at:at + step], out)
        return out

    def _by_matrix(self, pieces: Sequence[bytes], rows: list[int], out: list) -> None:
        """Merge ``pieces[i]`` for all i in ``rows`` in one padded matrix and put the results into ``out[i]``."""
        lengths = np.array([len(pieces[i]) for i in rows])
        width = int(lengths.max())
        flat = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in rows]), dtype=np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < lengths[:, None], self.single[flat], NONE)
        padding = np.full((len(rows), 1), NONE, dtype=np.uint32)
        # NONE is no token, so padding never merges
        ranks = np.concatenate([self.merges(ids[:, :-1], ids[:, 1:]), padding], axis=1)
        rows = np.array(rows)
        while True:
            n = np.arange(len(rows))
            at = ranks.argmin(axis=1)  # the leftmost of the smallest
            best = ranks[n, at]
            over = best == NONE
            if over.any():
                ended, n_ids = ids[over], lengths[over]
                buffer = ended[np.arange(ended.shape[1]) < n_ids[:, None]].astype("<u4").tobytes()
                end = 0
                for i, size in zip(rows[over].tolist(), (n_ids * 4).tolist()):
                    out[i] = buffer[end:end + size]
                    end += size
                keep = ~over
                rows, lengths, at, best = rows[keep], lengths[keep], at[keep], best[keep]
                if not len(rows):
                    return
                width = int(lengths.max())
                ids, ranks, n = ids[keep, :width], ranks[keep, :width], np.arange(len(rows))
            # compact: drop the place behind the merge
            places = np.arange(ids.shape[1] - 1)
            flat = (n * ids.shape[1])[:, None] + places + (places > at[:, None])
            ids[n, at] = best
            ids, ranks = ids.ravel()[flat], ranks.ravel()[flat]
            lengths -= 1
            # the merged token has a new pair on either side
            padded = np.concatenate([ids, padding[:len(n)]], axis=1)
            ranks[n, at] = self.merges(best, padded[n, at + 1])
            inner = np.flatnonzero(at)
            ranks[inner, at[inner] - 1] = self.merges(ids[inner, at[inner] - 1], best[inner])

    def _by_heap(self, piece: bytes) -> bytes:
        """The same merges for one long piece, with a linked list of tokens and a heap of (rank, place)."""
        ids = [int(x) for x in self.single[np.frombuffer(piece, dtype=np.uint8)]]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        texts = [piece[i:i + 1] for i in range(len(ids))]

        def rank(i: int) -> int | None:
            return self.ranks.get(texts[i] + texts[after[i]]) if after[i] < len(ids) else None

        heap = [(r, i) for i in range(len(ids)) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if texts[i] is None or rank(i) != r:
                continue
            gone = after[i]
            ids[i], texts[i], texts[gone], after[i] = r, texts[i] + texts[gone], None, after[gone]
            if after[i] < len(ids):
                before[after[i]] = i
            for j in (before[i], i):
                if j >= 0 and (new := rank(j)) is not None:
                    heapq.heappush(heap, (new, j))
        return np.array([x for x, t in zip(ids, texts) if t is not None], dtype="<u4").tobytes()

    def encode_chunks(self, chunks: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers; distinct pieces are merged once."""
        found = [self.pattern.findall(chunk) for chunk in chunks]
        distinct = {piece: i for i, piece in enumerate(dict.fromkeys(p for pieces in found for p in pieces))}
        ids = self.encode_pieces([p.encode() for p in distinct])
        return [b"".join([ids[distinct[p]] for p in pieces]) for pieces in found]


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """Read a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return Vocabulary(ranks, pattern)


@lru_cache(maxsize=4)
def _memo(path: str, pattern: str) -> Memo:
    return Memo(vocabulary(path, pattern).encode_chunks)


def id_arrays(buffers: Sequence[bytes]) -> pa.Array:
    """Arrow lists of ids from little-endian buffers."""
    ends = np.cumsum([0, *(len(b) // 4 for b in buffers)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(buffers), dtype="<i4")))


def bpe_encoder(path: str, pattern: str) -> Callable:
    """A column function text -> array of ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memo = _memo(path, pattern)
        for batch in batches:
            chunks = [cut_at_spaces(text) for text in texts_of(batch)]
            yield id_arrays([b"".join(values) for values in memo.resolve(chunks)])

    return encode


def bpe_decoder(path: str, pattern: str) -> Callable:
    """A column function array of ids -> bytes. Ids outside the vocabulary are an error."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = vocabulary(path, pattern).tokens.__getitem__
        for batch in batches:
            ends, ids = batch.offsets.to_pylist(), batch.values.to_pylist()
            yield pa.array([b"".join(map(token, ids[a:b])) for a, b in zip(ends, ends[1:])], type=pa.binary())

    return decode


def bpe_encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the ids of ``text``."""
    return df.withColumn(ids, bpe_encoder(path, pattern)(F.col(text)))


def bpe_decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the bytes that ``ids`` stand for; no ids (or null) give no bytes."""
    return df.withColumn(decoded, bpe_decoder(path, pattern)(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
