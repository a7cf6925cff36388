"""Bounded samples of labelled documents for fitting."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_DOCS = (3_000, 1_000)
SAMPLE_CHARS = 10_000


def sample(docs: DataFrame, labels: DataFrame, label: str, fold: Column | None = None, key: str = "doc_id",
           text: str = "text", per_class: tuple[int, int] = SAMPLE_DOCS, longest: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class[label]`` documents of each label, texts of at most ``longest`` characters.

    ``fold`` selects the rows that may be learned from. The choice follows a hash of the key, so it is the same in
    every run and at every partitioning. Labels other than 0 and 1 and null keys are not used; a key that is labelled both
    ways is not used either. Key lists are bounded by ``per_class`` and small enough to send to every task.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    if fold is not None:
        known = known.where(fold)
    agreed = known.groupBy(key).agg(F.min(label).alias("_y"), F.max(label).alias("_z")).where("_y = _z")
    order = [F.xxhash64(F.col(key), F.lit(17)), F.col(key)]
    # twice as many keys as documents: some have no text or one that is too long
    chosen = None
    for y in (0, 1):
        part = agreed.where(F.col("_y") == y).orderBy(*order).limit(2 * per_class[y]).select(F.col(key).alias("_key"), "_y")
        chosen = part if chosen is None else chosen.unionByName(part)
    keys = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    fit = (F.length(text) <= longest) & F.col(text).isNotNull()
    rows = docs.where(fit).select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(keys), "_key")
    out: list[tuple[str, int]] = []
    for y in (0, 1):
        part = rows.where(F.col("_y") == y).orderBy(F.xxhash64("_key", F.lit(17)), "_key", "_text").limit(per_class[y])
        out += [(r["_text"], int(r["_y"])) for r in part.select("_text", "_y").collect()]
    return out


def unlike(rows: Sequence[tuple[str, int]], hashes: int = 8, alike: int = 3) -> list[tuple[str, int]]:
    """The rows without copies and near copies of earlier ones, which would count one text's words many times.

    A row is left out when ``alike`` of its ``hashes`` smallest word-triple hashes (in as many classes) were seen together
    with an earlier row. Texts of fewer than three words are compared as a whole.
    """
    seen: dict[tuple[int, int], int] = {}
    out = []
    for text, label in rows:
        words = text.split()
        least: dict[int, int] = {}
        for i in range(max(1, len(words) - 2)):
            h = xxhash.xxh64_intdigest(" ".join(words[i:i + 3]))
            k = h % hashes
            if h < least.get(k, 1 << 64):
                least[k] = h
        votes = Counter(seen[item] for item in least.items() if item in seen)
        if votes and votes.most_common(1)[0][1] >= min(alike, len(least)):
            continue
        for item in least.items():
            seen.setdefault(item, len(out))
        out.append((text, label))
    return out


def crc_fold(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus
