"""Small helpers for operators that hand texts to Python in Arrow batches."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_ROWS = 500
BATCH_BYTES = 16 << 20
CACHED_CHUNKS = 400_000
LONGEST_CACHED = 64
SPACED_RUN = re.compile(r"\s \s|^ | $")


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold few enough texts that a worker's memory does not depend on how long they are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def find_package(spark: SparkSession) -> None:
    """Let Python workers that start from now on find this package where the driver has it. On a cluster that does not share
    the folder, ship the package with ``--py-files``; the entry is of no effect there."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def texts_of(column: pa.Array) -> list[str]:
    """The batch's texts; a null is an empty text."""
    return [text or "" for text in column.to_pylist()]


class Memo:
    """Remembers results per short string in bounded memory: two generations, of which the older one is dropped.

    ``compute`` takes a list of distinct strings and returns their results in order. It is called once for a batch.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable], size: int = CACHED_CHUNKS):
        self.compute, self.size = compute, size
        self.now: dict = {}
        self.before: dict = {}

    def resolve(self, rows: list[list[str]]) -> Iterator[list]:
        """The results of every row's strings, row by row."""
        found = [list(map(self.now.get, row)) for row in rows]
        missing: dict = {}
        for row, values in zip(rows, found):
            if None in values:
                missing.update((x, None) for x, value in zip(row, values) if value is None)
        old = {x: self.before[x] for x in missing if x in self.before}
        new = [x for x in missing if x not in old]
        missing.update(old)
        missing.update(zip(new, self.compute(new)) if new else ())
        if len(self.now) > self.size:
            self.before, self.now = self.now, {}
        self.now.update((x, value) for x, value in missing.items() if len(x) <= LONGEST_CACHED)
        for row, values in zip(rows, found):
            if None in values:
                values = [missing[x] if value is None else value for x, value in zip(row, values)]
            yield values


def cut_at_spaces(text: str) -> list[str]:
    """Cut before lone spaces, where a byte-level pre-tokenizer with an optional leading space always cuts too.

    A space between two other characters starts the next token, whatever stands around it. Only a space with white space
    on both sides belongs to a longer run; such places are left uncut. Joining the parts gives the text.
    """
    head, *rest = text.split(" ")
    if not SPACED_RUN.search(text):
        return [head, *[" " + word for word in rest]]
    parts, ended = [head], head[-1:].isspace()  # ended: white space stands before the next space
    for word in rest:
        if ended and word[:1].isspace() or not word:
            parts[-1] += " " + word
        else:
            parts.append(" " + word)
        ended = not word or word[-1].isspace()
    return parts
