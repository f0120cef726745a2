"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts stand against a sample of all texts, whose labels are not
looked at. With the share of toxic texts among all, ``prior``, the risk on the
negatives is the risk of calling all texts negative less ``prior`` times that
of calling toxic ones so; where this estimate falls below zero the model has
begun to learn single texts by heart, and the step goes back instead. The model
is linear over a text's different words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.quality import sampled_features, score_texts
from ledgerline.llm.tokens import tokens
from ledgerline.llm.training import class_sample, sampling_number

#: Confirmed toxic texts, and texts without a label, that a model is fitted on, about.
POSITIVES = 3000
UNLABELLED = 9000
#: Words of a model: all whose shares differ by so many standard deviations at least, each in at least so many texts of the sample.
LEAST_STRENGTH = 3.0
LEAST_TEXTS = 4
#: The prior where the labels hold no negatives.
PRIOR = 0.1
STEPS = 600
RATE = 0.05
RIDGE = 1e-5
THRESHOLD = 0.5


def words_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of texts, ascending, and the different words of each whole text, in lower case, as 31-bit hashes."""
    t = tokens(texts)
    codes = np.unique(t.owner[t.word].astype(np.uint64) << np.uint64(31) | t.hashed[t.word] >> np.uint64(33))
    return (codes >> np.uint64(31)).astype(np.int64), (codes & np.uint64(0x7FFFFFFF)).astype(np.int64)


def word_hashes(text: str | None) -> np.ndarray:
    """The words of one text, ascending."""
    return words_of([text])[1]


@dataclass
class WordModel:
    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        owner, found = words_of(texts)
        at = np.searchsorted(self.words, found)
        at[at == len(self.words)] = 0
        hit = self.words[at] == found if len(self.words) else np.zeros(len(found), bool)
        z = np.bincount(owner[hit], self.weights[at[hit]], len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def word_strengths(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All words of both samples, and by how many standard deviations the shares of texts with the word differ; -1 for words of too few texts."""
    words, counts = [], []
    for own in (positive, unlabelled):
        w, n = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        words.append(w)
        counts.append(n)
    every = np.union1d(*words)
    share = []
    total = np.zeros(len(every))
    for w, n, own in zip(words, counts, (positive, unlabelled), strict=True):
        count = np.zeros(len(every))
        count[np.searchsorted(every, w)] = n
        total += count
        share.append((count + 0.5) / (len(own) + 1))
    spread = np.sqrt(share[0] * (1 - share[0]) / (len(positive) + 1) + share[1] * (1 - share[1]) / (len(unlabelled) + 1))
    return every, np.where(total >= LEAST_TEXTS, np.abs(share[0] - share[1]) / spread, -1)


def chosen_words(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> np.ndarray:
    """The words that tell the samples apart, all of them."""
    every, strength = word_strengths(positive, unlabelled)
    return every[strength >= LEAST_STRENGTH]


def _rows(texts: list[np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Column numbers of the known words of each text, end to end, and where each text starts."""
    found = []
    for t in texts:
        at = np.searchsorted(words, t)
        at[at == len(words)] = 0
        found.append(at[words[at] == t] if len(words) else at[:0])
    return np.concatenate([*found, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)


def risk_slopes(z: np.ndarray, p: int, prior: float) -> tuple[float, float, np.ndarray]:
    """Of margins ``z``, the first ``p`` of which are of positives: the risk of the positives, the estimated risk of the negatives, and the direction of a step, by margin.

    Where the negatives' estimate is below zero the step goes back along that
    estimate alone; elsewhere it follows the whole risk.
    """
    s, calling_negative = 1 / (1 + np.exp(-np.clip(z, -40, 40))), np.logaddexp(0, z)
    negative = calling_negative[p:].mean() - prior * calling_negative[:p].mean()
    g = np.empty(len(z))
    if negative >= 0:
        g[:p] = prior * (s[:p] - 1) / p - prior * s[:p] / p
        g[p:] = s[p:] / (len(z) - p)
    else:
        g[:p] = prior * s[:p] / p
        g[p:] = -s[p:] / (len(z) - p)
    return prior * float(np.logaddexp(0, -z[:p]).mean()), float(negative), g


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> WordModel:
    """Minimises the non-negative risk by Adam's steps over both samples. Equal texts count once; without toxic texts all scores are the prior."""
    once = lambda texts: [np.frombuffer(b, np.int64) for b in sorted({t.astype(np.int64).tobytes() for t in texts})]
    positive, unlabelled = once(positive), once(unlabelled)
    prior = min(max(prior, 1e-3), 0.999)
    start = float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return WordModel(np.zeros(0, np.int64), np.zeros(0), start)
    words = chosen_words(positive, unlabelled)
    columns, starts = _rows(positive + unlabelled, words)
    n, p = len(positive) + len(unlabelled), len(positive)
    w, bias = np.zeros(len(words)), start
    first, second = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    row = np.repeat(np.arange(n), np.diff(starts))
    for turn in range(1, STEPS + 1):
        g = risk_slopes(np.bincount(row, w[columns], n) + bias, p, prior)[2]
        gradient = np.append(np.bincount(columns, g[row], len(words)) + RIDGE * w, g.sum())
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient**2 - second)
        step = RATE * (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
        w -= step[:-1]
        bias -= step[-1]
    return WordModel(words, w, float(bias))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED, prior: float | None = None, seed: int = 0, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> WordModel:
    """A model from toxic rows of ``labels`` and from ``docs``, whose labels aren't asked. ``prior`` defaults to the share of toxic rows among the labels, or PRIOR where they hold one class.

    Null labels and ids are left out; an id with several texts counts by one of
    them, equal texts count once; null and empty texts have no words, long
    ones count whole. Without toxic texts, or without any, all scores are the
    prior.
    """
    counts = {r[0]: r[1] for r in labels.groupBy(F.col(label_col).cast("int")).count().collect() if r[0] in (0, 1)}
    if prior is None:
        prior = counts.get(1, 0) / sum(counts.values()) if len(counts) == 2 else PRIOR
    toxic = class_sample(labels.filter(F.col(label_col) == 1), label_col, positives, seed)
    total = docs.count()
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id")).filter(F.col("doc_id").isNotNull())
    some = ids.filter(sampling_number("doc_id", seed + 1) < unlabelled / max(1, total)).distinct().select("doc_id", F.lit(0).alias("label"))
    both = toxic.select("doc_id", "label").unionByName(some)
    rows = sampled_features(docs, both, words_of, id_col, text_col)
    return fit([f for _, y, f in rows if y == 1], [f for _, y, f in rows if y == 0], prior)


def toxicity_scores(docs: DataFrame, model: WordModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score``, and ``kept_`` before each column of ``keep``: each whole text's score from 0 to 1, a row for each input row, null ids and repeated rows included. Null and empty texts have the score of no words; an empty table gives an empty one; other columns are not read."""
    return score_texts(docs, model, id_col, text_col, keep)
