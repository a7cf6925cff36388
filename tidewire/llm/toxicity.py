"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Words (maximal runs without white space) are the items of a sequence; a document is one sequence, whatever its length. A
word's features are hashes of its case-folded core (letters and digits, common look-alikes undone), the core's first three
to seven letters, its ending, and its shape; neighbours count through the same features under weights of their own.

Training needs labelled tokens; documents are labelled. A word of a toxic document is labelled toxic when one of its
features marks toxic documents (``_telling``). All other words are labelled clean. The model is fitted on the driver to a bounded sample (``labelled.sample``) and sent to the
tasks; it has a fixed size. Forward-backward marginals are summed up per document (largest, expected number of toxic words,
length) and mapped to a probability by a logistic regression on the same sample; words with a marginal of at least one
half form the offending spans, given as code point ranges.

Null and empty texts score 0 and have no spans. Texts of any length are scored whole. Equal texts score equally. With no
labelled row of one of the two classes every score is the labelled share of toxic documents (0 without labels).
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from . import crf, labelled
from .arrow import Memo, texts_of

N_FEATURES = 1 << 16
WIDTH = 8  # features per word
EVIDENCE = 6.5
PURITY = 0.9
NEW_DOCS = 4
FITTED_WORDS = 4_096  # distinct words whose names are held at once while fitting
_CORE = re.compile(r"[^\w\n]+|_+")
_WORD = re.compile(r"\S+")
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")

SCORED = pa.struct([
    ("score", pa.float64()), ("toxic_words", pa.float64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())]))),
])


def _slot(name: str) -> int:
    """Feature id of a name; 0 is no feature."""
    return xxhash.xxh64_intdigest(name) % (N_FEATURES - 1) + 1 if name else 0


def words_names(words: Sequence[str]) -> Iterator[tuple[str, ...]]:
    """``WIDTH`` names of each word's features ("" for none); the first ``WIDTH - 1`` can be evidence for a label.

    Words hold no white space, so that all of them are folded and stripped at once, joined by line feeds.
    """
    joined = "\n".join(words)
    folded = joined.casefold()
    plains = _CORE.sub("", folded).split("\n")
    cores = _CORE.sub("", folded.translate(LOOKALIKES)).split("\n")
    for word, plain, core in zip(words, plains, cores):
        digits = False
        if not plain.isalpha():
            digits = any(map(str.isdigit, word))
            if not any(map(str.isalpha, plain)):
                core = plain
        n = len(core)
        yield (
            "w" + core, "3" + core[:3] if n >= 3 else "", "4" + core[:4] if n >= 4 else "", "5" + core[:5] if n >= 5 else "",
            "6" + core[:6] if n >= 6 else "", "7" + core[:7] if n >= 7 else "", "e" + core[-4:] if n > 4 else "",
            f"s{'U' if word.isupper() else 'l'}{'d' if digits else ''}{min(n, 12)}",
        )


def word_features(words: Sequence[str]) -> np.ndarray:
    """A row of feature ids per word."""
    names = chain.from_iterable(words_names(words))
    return np.fromiter(map(_slot, names), np.int32, len(words) * WIDTH).reshape(-1, WIDTH)


def _in_parts(rows_of: Callable[[Sequence[str]], np.ndarray], words: Sequence[str]) -> np.ndarray:
    """``rows_of`` all ``words``, a few at a time, so that names and their hashes need not be in memory together: the driver
    fits, and what it once took for small objects it hardly gives back."""
    return np.concatenate([rows_of(words[at:at + FITTED_WORDS]) for at in range(0, max(1, len(words)), FITTED_WORDS)])


@dataclass
class Toxicity:
    """The fitted tagger and the map from its marginals to a score. Picklable; of fixed size."""

    tagger: crf.Model | None
    scorer: np.ndarray | None
    share: float

    def word_weights(self, words: Sequence[str]) -> list[bytes]:
        """What each word adds to its own, its right and its left neighbour's emission."""
        features, model = word_features(words), self.tagger
        sums = [w[features].sum(axis=1) for w in (model.own, model.left, model.right)]
        return [row.tobytes() for row in np.column_stack(sums).astype(np.float32)]

    def tag(self, texts: Sequence[str], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all words of all texts, one after the other, and the number of words of each text."""
        rows = [text.split() for text in texts]
        lengths = np.array([len(r) for r in rows], dtype=np.int64)
        if not lengths.sum():
            return np.zeros(0), lengths
        weights = np.frombuffer(b"".join(b"".join(v) for v in memo.resolve(rows)), dtype=np.float32).reshape(-1, 3)
        emission = crf.combined(*weights.T.astype(np.float64), self.tagger.bias, *crf.bounds_of(lengths))
        return crf.marginals(emission, lengths, self.tagger.move, counted=False)[0], lengths

    def score(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lengths))
        full = lengths > 0
        if full.any():
            out[full] = crf.logistic(np.column_stack([_aggregate(p, lengths[full]), np.ones(full.sum())]) @ self.scorer)
        return out


def _aggregate(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    starts = np.cumsum(lengths) - lengths
    most, total = np.maximum.reduceat(p, starts), np.add.reduceat(np.where(p >= 0.05, p, 0), starts)
    return np.column_stack([most, np.log1p(total), np.minimum(total / lengths * 20, 1)])


def _telling(marks_in: Sequence[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` features mark toxic documents, chosen greedily: each explains ``NEW_DOCS`` or more toxic documents that
    the ones before it leave unexplained, and all but a few of the documents it stands in are toxic. A word that merely
    keeps company with a marked one explains nothing new and is not chosen."""
    toxic = np.flatnonzero(y)
    clean_in = np.bincount(np.concatenate([marks_in[i] for i in np.flatnonzero(y == 0)]), minlength=n)
    marks = np.concatenate([marks_in[i] for i in toxic])
    order = np.argsort(marks, kind="stable")
    docs = np.repeat(toxic, [len(marks_in[i]) for i in toxic])[order]
    ends = np.cumsum(np.bincount(marks, minlength=n))
    sizes = np.diff(ends, prepend=0)
    share, open_docs, chosen = y.mean(), y > 0, np.zeros(n, bool)
    pure = (sizes > 0) & (sizes >= PURITY * (sizes + clean_in))
    heap = [(-int(sizes[m]), int(m)) for m in np.flatnonzero(pure & (sizes >= NEW_DOCS))]
    heapq.heapify(heap)
    while heap:
        gain, m = heapq.heappop(heap)
        here = docs[ends[m] - sizes[m]:ends[m]]
        fresh = int(open_docs[here].sum())
        if heap and fresh < -heap[0][0] and fresh < -gain:
            heapq.heappush(heap, (-fresh, m))  # its gain has shrunk meanwhile
            continue
        if fresh < NEW_DOCS or -fresh * np.log(share) < EVIDENCE:
            break
        chosen[m] = True
        open_docs[here] = False
    # features that alone would have been chosen, had their documents not been explained already
    return chosen | (pure & (sizes >= 0.02 * y.sum()) & (-sizes * np.log(share) > 3 * EVIDENCE))


def _marks(words: Sequence[str]) -> tuple[np.ndarray, int]:
    """Numbers of the features of each word that can mark a document (0 for none), and how many numbers there are."""
    def hashes(part: Sequence[str]) -> np.ndarray:
        names = chain.from_iterable(row[:WIDTH - 1] for row in words_names(part))
        each = (xxhash.xxh64_intdigest(n) | 1 if len(n) > 3 else 0 for n in names)
        return np.fromiter(each, np.uint64, len(part) * (WIDTH - 1)).reshape(-1, WIDTH - 1)

    none = np.zeros((1, WIDTH - 1), dtype=np.uint64)
    distinct, marks = np.unique(np.concatenate([none, _in_parts(hashes, words)]), return_inverse=True)
    return marks.reshape(-1, WIDTH - 1)[1:].astype(np.int32), len(distinct)


def fit_toxicity(rows: Sequence[tuple[str, int]], rounds: int = 40) -> Toxicity:
    """Fit to (text, 0 or 1)."""
    rows = labelled.unlike(rows)
    y = np.array([label for _, label in rows], dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return Toxicity(None, None, float(y.mean()) if len(y) else 0.0)
    kinds: dict[str, int] | list[str] = {}
    words = [np.array([kinds.setdefault(w, len(kinds)) for w in text.split()], dtype=np.int64) for text, _ in rows]
    if not kinds:
        return Toxicity(None, None, float(y.mean()))
    kinds = list(kinds)
    features = _in_parts(word_features, kinds)
    marks, n = _marks(kinds)
    del rows, kinds
    telling = _telling([np.setdiff1d(marks[row], [0]) for row in words], y, n)
    telling[0] = False
    is_telling = telling[marks].any(axis=1)
    # the tagger learns from as many clean documents as toxic ones
    fitted = np.sort(np.concatenate([np.flatnonzero(y == 1), np.flatnonzero(y == 0)[:int((y == 1).sum())]]))
    del marks, telling
    words, y, share = [words[i] for i in fitted], y[fitted], y.mean()
    lengths = np.array([len(r) for r in words], dtype=np.int64)
    items = np.concatenate(words)
    labels = (is_telling[items] & (np.repeat(y, lengths) > 0)).astype(np.int8) if len(items) else np.zeros(0, np.int8)
    full = lengths > 0
    model = Toxicity(crf.fit(features, items, lengths[full], labels, N_FEATURES, rounds=rounds), None, float(share))
    for weights in (model.tagger.own, model.tagger.left, model.tagger.right):
        weights[0] = 0.0
    first, last = crf.bounds_of(lengths[full])
    emission = crf.emissions(model.tagger, features, items, first, last)
    p = crf.marginals(emission, lengths[full], model.tagger.move)[0]
    model.scorer = crf.fit_logistic(_aggregate(p, lengths[full]), y[full])
    return model


def toxicity_scorer(model: Toxicity) -> Callable[[Column], Column]:
    """A column function text -> struct of score, expected number of toxic words, and offending spans."""
    @F.arrow_udf(from_arrow_type(SCORED))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = Memo(model.word_weights)
        for batch in batches:
            texts = texts_of(batch)
            if model.tagger is None:
                rows = [{"score": model.share if t else 0.0, "toxic_words": 0.0, "spans": []} for t in texts]
                yield pa.array(rows, type=SCORED)
                continue
            p, lengths = model.tag(texts, known)
            scores, ends = model.score(p, lengths), np.cumsum(lengths)
            hits = np.flatnonzero(p >= 0.5)
            rows = []
            for text, end, n, s in zip(texts, ends, lengths, scores):
                a, b = np.searchsorted(hits, (end - n, end))
                rows.append({"score": s, "toxic_words": float(p[end - n:end].sum()),
                             "spans": _spans(text, hits[a:b] - (end - n), p[hits[a:b]]) if b > a else []})
            yield pa.array(rows, type=SCORED)

    return score


def _spans(text: str, at: np.ndarray, p: np.ndarray) -> list[dict]:
    """Runs of neighbouring toxic words as code point ranges, with the largest marginal of each."""
    wanted, out, before = dict(zip(at.tolist(), p.tolist())), [], -2
    for i, word in enumerate(_WORD.finditer(text)):
        if i in wanted:
            if i == before + 1:
                out[-1]["stop"], out[-1]["p"] = word.end(), max(out[-1]["p"], wanted[i])
            else:
                out.append({"start": word.start(), "stop": word.end(), "p": wanted[i]})
            before = i
    return out


def learn_toxicity(docs: DataFrame, labels: DataFrame, fold: Column | None = None, label: str = "toxic",
                   key: str = "doc_id", text: str = "text") -> Toxicity:
    """Fit on a bounded sample of the labelled rows that ``fold`` (a condition on labels) admits."""
    return fit_toxicity(labelled.sample(docs, labels, label, fold, key, text))


def score_toxicity(docs: DataFrame, model: Toxicity, text: str = "text", out: str = "toxicity") -> DataFrame:
    """Add ``out``: struct of score, toxic_words, spans."""
    return docs.withColumn(out, toxicity_scorer(model)(F.col(text)))
