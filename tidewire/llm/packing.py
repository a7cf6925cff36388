"""Best-fit packing of tokenized documents into sequences of bounded length.

Every document is encoded, closed by an end id, and cut into pieces only when it is longer than a sequence. Pieces are
then packed by vector best-fit: a sequence has three capacities (tokens, documents, attention cost, the sum of squared
piece lengths), a piece goes where it fits under all of them, and among those to the sequence that the rule selects:
the largest weighted dot product of the piece's demand and what is left, or the smallest weighted norm of what would be
left.

Pieces are narrow rows (no texts). They are dealt out by a hash and packed in blocks of at most ``BLOCK`` pieces, longest
first, so that a task's memory is bounded and a repeated task gives the same sequences. A block leaves at most about one
sequence partly filled, which is all that packing in blocks costs.

Null texts are empty documents of one end id. Repeated rows are packed as often as they occur. An empty table gives no
pieces.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import Memo, cut_at_spaces, texts_of

BLOCK = 16_384
REMEMBERED = 100_000  # parts of texts whose ids a worker remembers
LATIN_END = "\u0250"
LONG_RUN = 100_000  # white space characters in a row; the rank file's library gives up at some more
_BLANKS = re.compile(rf"(?<!\s)\s{{{LONG_RUN}}}")
PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


@dataclass(frozen=True)
class Limits:
    """Capacities of a sequence, the weight of each in the choice of a sequence, and the rule of choice."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"

    @property
    def capacity(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.float64)


def pack_block(lengths: Iterable[int], limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` in descending order."""
    lengths = np.asarray(lengths, dtype=np.int64)
    cap, weights = limits.capacity, np.array(limits.weights)
    if len(lengths) and (lengths.max() > limits.tokens or int(lengths.max()) ** 2 > limits.attention):
        raise ValueError("a piece is larger than a sequence")
    left = np.empty((len(lengths), 3))  # of every sequence that was opened
    live = np.empty(len(lengths), dtype=np.int64)  # those with room for the smallest piece
    used, n_live = 0, 0
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    smallest = int(lengths[-1]) if len(lengths) else 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1, length * length], dtype=np.float64)
        chosen = -1
        if n_live and length < limits.tokens:
            rest = left[live[:n_live]]
            fits = np.flatnonzero((rest >= need).all(axis=1))
            if len(fits):
                rest = rest[fits]
                if limits.rule == "dot":
                    best = np.argmax((rest / cap * (need / cap * weights)).sum(axis=1))
                else:
                    best = np.argmin((((rest - need) / cap) ** 2 * weights).sum(axis=1))
                chosen, slot = int(live[fits[best]]), int(fits[best])
        if chosen < 0:
            chosen, used = used, used + 1
            left[chosen] = cap
            live[n_live], slot, n_live = chosen, n_live, n_live + 1
        sequence[i], offset[i] = chosen, limits.tokens - int(left[chosen, 0])
        left[chosen] -= need
        if left[chosen, 0] < smallest or left[chosen, 1] < 1 or left[chosen, 2] < smallest * smallest:
            n_live -= 1
            live[slot] = live[n_live]
    return sequence, offset


@lru_cache(maxsize=2)
def _memo(path: str, ranks: tuple[str, str] | None) -> Memo:
    tokenizer, _ = _tokenizer(path)
    quick = rank_encoder(*ranks) if ranks else None

    def encode(chunks: list[str]) -> list[bytes]:
        out: list = [None] * len(chunks)
        plain, rare = [], []
        for i, chunk in enumerate(chunks):
            (plain if quick and _is_latin(chunk) else rare).append(i)
        for i, ids in zip(plain, quick([chunks[i] for i in plain]) if plain else ()):
            out[i] = ids
        for i, e in zip(rare, tokenizer.encode_batch_fast([chunks[i] for i in rare], add_special_tokens=False)):
            out[i] = array("I", e.ids).tobytes()
        return out

    return Memo(encode, REMEMBERED)


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple:
    """The tokenizer file as it is, and the strings that it takes out of a text before anything else; None without any."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = sorted(token.content for token in tokenizer.get_added_tokens_decoder().values())
    return tokenizer, re.compile("|".join(map(re.escape, added))) if added else None


def encoded_texts(texts: list[str], path: str, ranks: tuple[str, str] | None = None) -> Iterator[bytes]:
    """Little-endian ids of each text, as the tokenizer file gives them without special tokens put around it.

    With ``ranks`` a text below ``LATIN_END`` is encoded whole by the rank file, others by remembered parts; one that holds an
    added token's string (``<|endoftext|>``) or ``LONG_RUN`` goes to the tokenizer whole.
    """
    tokenizer, added = _tokenizer(path)
    whole = {i for i, text in enumerate(texts) if added and added.search(text) or len(text) >= LONG_RUN and _BLANKS.search(text)}
    library = rank_library(*ranks)[0] if ranks else None
    latin = {i for i, text in enumerate(texts) if library and i not in whole and _is_latin(text)}
    parts = _memo(path, ranks).resolve([[] if i in whole or i in latin else cut_at_spaces(text) for i, text in enumerate(texts)])
    for i, values in enumerate(parts):
        if i in latin:
            yield library.encode_to_numpy(texts[i]).astype("<u4", copy=False).tobytes()
        else:
            yield array("I", tokenizer.encode(texts[i], add_special_tokens=False).ids).tobytes() if i in whole else b"".join(values)


def _is_latin(text: str) -> bool:
    return text.isascii() or max(text) < LATIN_END


@lru_cache(maxsize=2)
def rank_library(path: str, pattern: str) -> tuple:
    """The library's encoding of a rank file (a base64 token and its rank per line), and each token's number of bytes."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    sizes[list(ranks.values())] = list(map(len, ranks))
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def rank_encoder(path: str, pattern: str) -> Callable[[list[str]], list[bytes]]:
    """A function parts -> little-endian ids of each, by a rank file.

    The pattern always cuts before a lone space, so parts that begin with one are encoded in one call, joined, and told apart by
    their numbers of bytes.
    """
    library, sizes = rank_library(path, pattern)

    def encode(parts: list[str]) -> list[bytes]:
        out: list = [None] * len(parts)
        spaced = [i for i, part in enumerate(parts) if part[:1] == " " and not (part[1:2] or " ").isspace()]
        if spaced:
            ids = library.encode_to_numpy("".join([parts[i] for i in spaced]))
            ends, stops = np.cumsum(sizes[ids]), np.cumsum([len(parts[i].encode()) for i in spaced])
            cuts = np.searchsorted(ends, stops)
            if (ends[cuts] == stops).all():
                raw, start = ids.astype("<u4").tobytes(), 0
                for i, stop in zip(spaced, (4 * (cuts + 1)).tolist()):
                    out[i], start = raw[start:stop], stop
        for i, part in enumerate(parts):
            if out[i] is None:
                out[i] = array("I", library.encode_ordinary(part)).tobytes()
        return out

    return encode


def piece_cutter(path: str, limit: int, end_id: int, ranks: tuple[str, str] | None = None) -> Callable:
    """A column function text -> pieces, by a byte-level tokenizer file without normalisation.

    ``ranks``: path and pattern of the same vocabulary as a rank file. It is several times quicker and is used for texts
    and parts of them below ``LATIN_END``, where both libraries class all characters alike.
    """
    end = np.array([end_id], "<u4").tobytes()

    @F.arrow_udf(PIECES)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ends, piece, start, length, crc = [0], [], [], [], []
            for encoded in encoded_texts(texts_of(batch), path, ranks):
                ids = encoded + end
                total = len(ids) // 4
                cuts = [0, *range(total % limit or limit, total + 1, limit)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a:4 * b]))
                ends.append(len(piece))
            items = pa.StructArray.from_arrays(
                [pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                ["piece", "start", "length", "ids_crc32"])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)

    return cut


def tokenized_pieces(df: DataFrame, path: str, limit: int = 2048, end_id: int = 0, key: str = "doc_id",
                     text: str = "text", ranks: tuple[str, str] | None = None) -> DataFrame:
    """One narrow row per piece: ``key``, piece, start, length, ids_crc32. A first piece may be shorter than the rest."""
    pieces = df.select(F.col(key), F.explode(piece_cutter(path, limit, end_id, ranks)(F.col(text))).alias("_p"))
    return pieces.select(key, "_p.*")


def pack(pieces: DataFrame, limits: Limits = Limits(), key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """Add sequence_id and offset to pieces (``key``, piece, start, length, ids_crc32).

    Sequence ids are unique, not dense. Offsets of a sequence are gapless from 0.
    """
    columns = [key, "piece", "start", "length", "ids_crc32"]

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        waiting, n = [], 0

        def close(rows: pd.DataFrame) -> pd.DataFrame:
            nonlocal base
            rows = rows.sort_values("length", ascending=False, kind="stable", ignore_index=True)
            sequence, offset = pack_block(rows["length"], limits)
            rows = rows.assign(sequence_id=sequence + base, offset=offset)
            base += int(sequence.max()) + 1
            return rows

        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            while n >= block:
                rows = pd.concat(waiting, ignore_index=True)
                yield close(rows[:block])
                waiting, n = [rows[block:]], n - block
        if n:
            yield close(pd.concat(waiting, ignore_index=True))

    kind = pieces.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    dealt = pieces.select(*columns, F.xxhash64(key, "piece").alias("_deal")).repartition("_deal")
    ordered = dealt.sortWithinPartitions("_deal", *columns)
    return ordered.select(*columns).mapInPandas(packed, schema)


def pack_documents(df: DataFrame, path: str, limits: Limits = Limits(), end_id: int = 0, key: str = "doc_id",
                   text: str = "text", ranks: tuple[str, str] | None = None) -> DataFrame:
    """Tokenize and pack: one row per piece with its place."""
    return pack(tokenized_pieces(df, path, limits.tokens, end_id, key, text, ranks), limits, key)
