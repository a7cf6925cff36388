"""Document quality from a linear-chain conditional random field over lines.

The items of a sequence are a document's lines that are not blank. A line's features are binned measures of the whole
line: its length, the length of its words, how many of its letters are capitals, the shares of digits, sentence marks,
brackets and bars, other symbols, how often its words repeat (at once and anywhere in the line), whether it ends a sentence,
and whether it stood in the document before. Neighbouring lines count through the same features under weights of their own.

Training starts from every line carrying its document's label. A bad document may hold good lines, so the lines of bad
documents that the first model finds good are relabelled (the worst line of each stays bad) and the model is fitted again.
Marginals, weighted by line length, are averaged over a document and mapped to a probability by a logistic regression, on
the same bounded sample (``labelled.sample``). The model has a fixed size and is sent to the tasks.

Null, empty and blank texts score 0: they hold nothing to keep. Texts and lines of any length are measured whole. Equal texts
score equally. Without labelled rows of both classes every text that is not blank scores the labelled share of good ones (1
without labels).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from . import crf, labelled
from .arrow import texts_of

SCORED = pa.struct([("score", pa.float64()), ("good_share", pa.float64()), ("n_lines", pa.int64())])
SAMPLE = (1_200, 1_800)  # bad and good documents to fit to

# character classes
LOWER, UPPER, DIGIT, SPACE, MARK, BRACKET, SYMBOL, BREAK = range(8)
_CODES = 0x3000  # code points from here on count as lower-case letters


def _classes() -> np.ndarray:
    table = np.full(_CODES, LOWER, dtype=np.uint8)
    for code in range(_CODES):
        c = chr(code)
        if c == "\n":
            table[code] = BREAK
        elif c.isspace():
            table[code] = SPACE
        elif c.isupper():
            table[code] = UPPER
        elif c.isdigit():
            table[code] = DIGIT
        elif c in ".,;:?'\"-¿¡’“”«»–—":
            table[code] = MARK
        elif c in "()[]{}|<>/\\":
            table[code] = BRACKET
        elif not c.isalpha() and code < 0x0300:
            table[code] = SYMBOL
    return table


CLASSES = _classes()
SHARES = np.array([0.001, 0.01, 0.03, 0.06, 0.1, 0.15, 0.22, 0.3, 0.4, 0.55, 0.75, 0.95])
SIZES = np.array([2, 4, 7, 11, 16, 25, 40, 70, 120, 250])
WORDS = np.array([2, 2.8, 3.5, 4.2, 5, 6, 7.5, 9.5, 13, 20])
MEASURES = 12
BINS = 16
N_FEATURES = MEASURES * BINS


def line_features(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids of all lines that are not blank, the number of such lines of each text, and the lines' lengths."""
    lines: list[str] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    seen_before: list[bool] = []
    for i, text in enumerate(texts):
        kept = [line for line in text.split("\n") if line and not line.isspace()]
        counts[i] = len(kept)
        lines += kept
        if len(kept) > 1:
            seen: set[str] = set()
            for line in kept:
                seen_before.append(line in seen)
                seen.add(line)
        else:
            seen_before += [False] * len(kept)
    if not lines:
        return np.zeros((0, MEASURES), np.int32), counts, np.zeros(0)
    joined = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = CLASSES[np.minimum(joined, _CODES - 1)]
    chars = np.array([len(line) for line in lines])
    starts = np.cumsum(chars + 1) - chars - 1
    per = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(7)])
    distinct, words, repeats = np.empty(len(lines)), np.empty(len(lines)), np.empty(len(lines))
    for i, line in enumerate(lines):
        row = line.split()
        words[i], distinct[i] = len(row), len(set(row))
        repeats[i] = sum(map(str.__eq__, row, row[1:])) if distinct[i] < len(row) else 0
    letters = np.maximum(per[LOWER] + per[UPPER], 1)
    full = np.maximum(chars - per[SPACE], 1)
    ends = kinds[starts + chars - 1]
    expected = np.sqrt(words)  # longer lines repeat more words by themselves
    measures = [
        np.searchsorted(SIZES, words, side="right"),
        np.searchsorted(WORDS, full / np.maximum(words, 1), side="right"),
        np.searchsorted(SHARES, per[UPPER] / letters, side="right"),
        np.searchsorted(SHARES, per[DIGIT] / full, side="right"),
        np.searchsorted(SHARES, per[MARK] / full, side="right"),
        np.searchsorted(SHARES, per[BRACKET] / full, side="right"),
        np.searchsorted(SHARES, per[SYMBOL] / full, side="right"),
        np.searchsorted(SHARES, repeats / np.maximum(words - 1, 1), side="right"),
        np.searchsorted(SHARES, (words - distinct) / np.maximum(words, 1), side="right"),
        np.searchsorted(np.array([0.5, 1, 2, 3, 5, 8, 13, 20]), (words - distinct) / expected, side="right"),
        ends.astype(np.int64),
        np.array(seen_before, dtype=np.int64) + 2 * (per[UPPER] > per[LOWER]),
    ]
    return np.stack([m + BINS * k for k, m in enumerate(measures)], axis=1).astype(np.int32), counts, chars.astype(float)


@dataclass
class Quality:
    """The fitted line labeller and the map from line marginals to a document score. Picklable; of fixed size."""

    labeller: crf.Model | None
    scorer: np.ndarray | None
    share: float

    def score(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Score, length-weighted share of good lines, and number of lines of each text."""
        features, counts, chars = line_features(texts)
        score, good, full = np.zeros(len(texts)), np.zeros(len(texts)), counts > 0
        if not full.any():
            return score, good, counts
        if self.labeller is None:
            score[full] = good[full] = self.share
            return score, good, counts
        p = _line_marginals(self.labeller, features, counts)
        x = _aggregate(p, counts[full], chars)
        good[full] = x[:, 0]
        score[full] = crf.logistic(np.column_stack([x, np.ones(len(x))]) @ self.scorer)
        return score, good, counts


def _line_marginals(model: crf.Model, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
    emission = crf.emissions(model, features, np.arange(len(features)), *crf.bounds_of(counts))
    return crf.marginals(emission, counts, model.move, counted=False)[0]


def _aggregate(p: np.ndarray, counts: np.ndarray, chars: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    size = np.add.reduceat(chars, starts)
    share = np.add.reduceat(p * chars, starts) / size
    return np.column_stack([share, np.log(share + 0.02), np.log(1.02 - share)])


def fit_quality(rows: Sequence[tuple[str, int]], relabel: int = 2, rounds: int = 80) -> Quality:
    """Fit to (text, 0 or 1)."""
    y = np.array([label for _, label in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Quality(None, None, float(y.mean()) if len(y) else 1.0)
    features, counts, chars = line_features([text for text, _ in rows])
    full = counts > 0
    y, counts = y[full], counts[full]
    if not len(y):
        return Quality(None, None, 1.0)
    labels, doc = np.repeat(y, counts), np.repeat(np.arange(len(y)), counts)
    starts = np.cumsum(counts) - counts
    items = np.arange(len(features))
    model = crf.fit(features, items, counts, labels, N_FEATURES, rounds=rounds)
    for _ in range(relabel):
        p = _line_marginals(model, features, counts)
        worst = np.minimum.reduceat(p, starts)
        labels = np.where(y[doc] == 1, 1.0, ((p > 0.5) & (p > worst[doc])).astype(float))
        model = crf.fit(features, items, counts, labels, N_FEATURES, rounds=rounds)
    x = _aggregate(_line_marginals(model, features, counts), counts, chars)
    return Quality(model, crf.fit_logistic(x, y), float(y.mean()))


def quality_scorer(model: Quality) -> Callable[[Column], Column]:
    """A column function text -> struct of score, share of good lines, number of lines."""

    @F.arrow_udf(from_arrow_type(SCORED))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.StructArray.from_arrays([pa.array(x) for x in model.score(texts_of(batch))], fields=list(SCORED))

    return score


def learn_quality(docs: DataFrame, labels: DataFrame, fold: Column | None = None, label: str = "quality",
                  key: str = "doc_id", text: str = "text") -> Quality:
    """Fit on a bounded sample of the labelled rows that ``fold`` (a condition on labels) admits."""
    return fit_quality(labelled.sample(docs, labels, label, fold, key, text, per_class=SAMPLE))


def score_quality(docs: DataFrame, model: Quality, text: str = "text", out: str = "quality") -> DataFrame:
    """Add ``out``: struct of score, good_share, n_lines."""
    return docs.withColumn(out, quality_scorer(model)(F.col(text)))
