"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has the probability
``sigmoid(bias + sum of its words' weights)``, a word's weight is the sum of the
weights of its features (the word and its character 3- to 5-grams, hashed) over
the root of their number, and
the document is toxic with the noisy-or ``1 - prod(1 - p)`` of its sentences.
Only documents carry labels; the weights are fitted to them through the
noisy-or, and the sentences that reach ``threshold`` are then the offending ones.

The classifier is fitted on a bounded sample of labelled rows: at most
``max_positive`` and ``max_negative`` documents, those with the smallest hash of
their id, and of a document at most ``max_chars`` characters; of a repeated id the
least text is learned from. Both bounds hold before anything reaches the driver.
Scoring is one pass over all rows and whole texts.

Defined cases: null and empty texts have no sentence and score 0; labels other
than 0 and 1, null ids and ids without a document are not learned from; a
document labelled both 0 and 1 counts as 1; without a positive and a negative
row every score is 0. A sentence of over ``SENTENCE_WORDS`` words is read in parts
of that many. A word of over ``LONG`` characters counts as several, parts of ``PART``
that overlap by ``OVERLAP``, so that each of its n-grams is in one; this also serves
scripts without spaces, whose sentence ends count like ``.``. Other columns pass through :func:`reject_toxic` untouched, whatever
their names.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layertables.llm.common import crc_of_id, map_rows, small_batches, text_or_empty

BUCKETS = 1 << 18
SENTENCE_WORDS = 32
MIN_DOCS = 3
SIGNIFICANT = 2.5
POSITIVE_WEIGHT = 2.0
MAX_POSITIVE = 1000
MAX_NEGATIVE = 2000
MAX_CHARS = 1 << 18
MEMO_WORDS = 1 << 19
LONG = 40
# About a word's length: the root of the number of features divides a part's weight.
PART = 12
OVERLAP = 4
# Stands at the end of a part where its word goes on; no character of any text.
MORE = "\ufdd0"
# Full stops, question and exclamation marks of other scripts, line and paragraph separators.
SENTENCE = re.compile(r"[^.!?\n。｡．！？।॥؟۔።។။։\u2028\u2029]+")
WORD = re.compile(r"\S+")
EDGES = "\"'()[]{}<>,;:*_-–—«»„“”‘’¿¡"


def word_features(word: str) -> list[int]:
    """Hashed features of a lower-case word, of at most ``LONG`` characters, or part of one."""
    w = word.strip(EDGES)
    if not w:
        return []
    core = w.strip(MORE)
    padded = f"{'' if w[0] == MORE else '^'}{core}{'' if w[-1] == MORE else '$'}"
    grams = ({w} if w == core else set()) | {padded[i : i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in grams]


def _parts(sentence: str):
    """``(start, end, word)`` of the words of a sentence, long ones in parts."""
    for m in WORD.finditer(sentence):
        w = m.group()
        core = w.strip(EDGES) if len(w) > LONG else ""
        if len(core) <= LONG:
            yield m.start(), m.end(), w
            continue
        first = m.start() + len(w) - len(w.lstrip(EDGES))
        for at in range(0, len(core) - OVERLAP, PART - OVERLAP):
            end = min(at + PART, len(core))
            yield first + at, first + end, MORE * (at > 0) + core[at:end] + MORE * (end < len(core))


def sentences(text: str):
    """``(start, end, words)`` of every sentence or part of one."""
    for m in SENTENCE.finditer(text):
        words = m.group().split()
        if len(words) <= SENTENCE_WORDS and max(map(len, words), default=0) <= LONG:
            if words:
                yield m.start(), m.end(), words
            continue
        places = _parts(m.group())
        while part := list(islice(places, SENTENCE_WORDS)):
            yield m.start() + part[0][0], m.start() + part[-1][1], [w for _, _, w in part]


@dataclass
class Model:
    bias: float
    weights: np.ndarray

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self._m = model
        self._memo: dict[str, float] = {}

    def word(self, w: str) -> float:
        f = word_features(w)
        value = float(self._m.weights[f].sum() / np.sqrt(len(f))) if f else 0.0
        if len(self._memo) >= MEMO_WORDS:
            self._memo.clear()
        self._memo[w] = value
        return value

    def logits(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        get, word = self._memo.get, self.word
        spans, z = [], []
        for a, b, words in sentences(text.lower()):
            total = self._m.bias
            for w in words:
                v = get(w)
                total += word(w) if v is None else v
            spans.append((a, b))
            z.append(total)
        return spans, np.array(z)

    def document(self, text: str) -> tuple[float, list[tuple[int, int]], np.ndarray]:
        spans, z = self.logits(text)
        if not len(z):
            return 0.0, [], z
        # log(1 - p) of a sentence is -log(1 + e^z).
        return float(-np.expm1(-np.logaddexp(0, z).sum())), spans, 1 / (1 + np.exp(-z))


def learn(bags: Iterable[list[list[str]]], labels: list[int], *, steps: int = 100, rate: float = 0.05, decay: float = 1e-3) -> Model:
    """Fit by Adam on the mean noisy-or log-likelihood of whole documents.

    Features begin with the evidence that documents give for them: the log ratio of
    their shares of toxic and of other documents, where it is significant. (From
    zero, the noisy-or would first explain toxic documents by all their sentences.)"""
    weights = np.zeros(BUCKETS, np.float32)
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        return Model(-np.inf, weights)
    # Words, sentences and features as flat arrays of 32-bit numbers.
    vocabulary: dict[str, int] = {}
    word_list, start_list, owner_list = array("i"), array("i"), array("i")
    for d, bag in enumerate(bags):
        for s in bag:
            start_list.append(len(word_list))
            owner_list.append(d)
            word_list.extend(vocabulary.setdefault(w, len(vocabulary)) for w in s)
    feature_list, size_list = array("i"), array("i")
    for w in vocabulary:
        f = word_features(w)
        feature_list.extend(f)
        size_list.append(len(f))
    n_words = len(vocabulary)
    del vocabulary
    words, starts, owner, flat, sizes = (np.array(x, np.int32) for x in (word_list, start_list, owner_list, feature_list, size_list))
    del word_list, feature_list
    sentence_of = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(starts, append=len(words)))

    # Documents of each feature, toxic and other.
    first = np.cumsum(sizes) - sizes
    doc_of = owner[sentence_of]
    bounds = np.searchsorted(doc_of, np.arange(len(y) + 1))
    seen = np.zeros((2, BUCKETS))
    for d in range(len(y)):
        at = np.unique(words[bounds[d] : bounds[d + 1]])
        n = sizes[at]
        f = flat[np.repeat(first[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        seen[int(y[d]), np.unique(f)] += 1
    toxic, other = y.sum(), (1 - y).sum()
    p, q = (seen[1] + 0.5) / (toxic + 1), (seen[0] + 0.5) / (other + 1)
    z = (p - q) / np.sqrt((p * (1 - p) + q * (1 - q) * toxic / other + 0.25 / toxic) / toxic)
    start = np.log(p / q)
    used = np.flatnonzero((z > SIGNIFICANT) & (seen[1] >= MIN_DOCS))
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    keep = place[flat] >= 0
    word_of = np.repeat(np.arange(n_words, dtype=np.int32), sizes)[keep]
    flat = place[flat[keep]]
    share = 1 / np.sqrt(sizes[word_of])
    theta = np.append(start[used], -7.0)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = np.where(y == 1, POSITIVE_WEIGHT, 1.0) / len(y)
    for t in range(1, steps + 1):
        f = np.bincount(word_of, theta[flat] * share, n_words)
        z = theta[-1] + np.bincount(sentence_of, f[words], len(starts))
        quiet = np.bincount(owner, np.logaddexp(0, z), len(y))
        ratio = 1 / np.maximum(np.expm1(np.minimum(quiet, 500)), 1e-12)  # (1 - P) / P
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        g = p * (weight * np.where(y == 1, -ratio, 1.0))[owner]
        per_word = np.bincount(words, g[sentence_of], n_words)
        grad = np.append(np.bincount(flat, per_word[word_of] * share, len(used)), g.sum())
        grad[:-1] += decay * theta[:-1] / len(used)
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        step = rate * (1 if t < 0.7 * steps else 0.2)
        theta -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
    weights[used] = theta[:-1]
    return Model(float(theta[-1]), weights)


def sample_labels(labels: DataFrame, learn_from: Column, max_positive: int, max_negative: int) -> DataFrame:
    """``(doc_id, y)``: the labelled rows with the smallest hash of their id, at most so many a class."""
    y = F.col("toxic").cast("int").alias("y")
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & learn_from).select(F.col("doc_id").cast("bigint"), y)
    rows = rows.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return rows.filter("y = 1").orderBy(*order).limit(max_positive).unionByName(rows.filter("y = 0").orderBy(*order).limit(max_negative))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    learn_from: Column | None = None,
    max_positive: int = MAX_POSITIVE,
    max_negative: int = MAX_NEGATIVE,
    max_chars: int = MAX_CHARS,
    text_col: str = "text",
) -> Model:
    """Learn from documents with a label; ``learn_from`` says which ids may be used."""
    learn_from = F.lit(True) if learn_from is None else learn_from
    sample = sample_labels(labels, learn_from, max_positive, max_negative)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.substring(text_or_empty(text_col), 1, max_chars).alias("text"))
    # The sample has at most max_positive + max_negative rows; one text for each is left before the collect.
    got = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = got.orderBy("doc_id").collect()
    return learn(([w for _, _, w in sentences(r["text"].lower())] for r in rows), [r["y"] for r in rows])


def score(df: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``doc_id, score, predicted, spans``; spans are the offending sentences
    (code points, end exclusive, with their probability), only where predicted."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # one vector of BUCKETS weights

    def make():
        scorer = shared.value.scorer()

        def run(b: pa.RecordBatch) -> dict:
            s, at = [], []
            for t in b.column("text").to_pylist():
                doc, spans, p = scorer.document(t)
                s.append(doc)
                hits = [(x, *spans[x]) for x in np.flatnonzero(p >= threshold)] if doc >= threshold else []
                if doc >= threshold and not hits:
                    k = int(p.argmax())
                    hits = [(k, *spans[k])]
                at.append([{"start": a, "end": e, "p": float(p[k])} for k, a, e in hits])
            return {"score": s, "predicted": [int(x >= threshold) for x in s], "spans": at}

        return run

    rows = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    return map_rows(
        rows, make, "doc_id bigint, score double, predicted int, spans array<struct<start:int,end:int,p:double>>"
    )


def reject_toxic(df: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df``, all columns, whose text scores below ``threshold``."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def run(batches):
        scorer = shared.value.scorer()
        for b in batches:
            keep = [scorer.document(t or "")[0] < threshold for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)


HELD_OUT = 0
FOLDS = 5


def held_out() -> Column:
    return crc_of_id() % FOLDS == HELD_OUT
