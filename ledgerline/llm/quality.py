"""A quality classifier by naive Bayes support vectors.

A text's features are indicators of hashed n-grams: its tokens (words and runs
of marks) and pairs of them, and pairs and triples of their shapes. They are made
for many texts at once. Each indicator is scaled by its class log-count ratio, and a linear model with squared hinge loss is
fitted to the scaled indicators by dual coordinate descent. Scores are the
model's margins through a logistic curve that is fitted to held-back rows of
the sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.store import small_batches
from ledgerline.llm.tokens import UPPER, Tokens, character_tables, groups, split_by_owner, tokens
from ledgerline.llm.training import class_sample

#: Hashed features, a power of two.
BITS = 18
FEATURES = 1 << BITS
#: Labelled rows of each class that a model is fitted on, about.
PER_CLASS = 4000
#: Added to both classes' document counts of a feature.
SMOOTHING = 1.0
#: The cost of a violated margin, and passes over the rows.
COST = 0.1
PASSES = 20
#: One in so many rows of the sample is held back for the logistic curve.
CURVE_FOLD = 5
THRESHOLD = 0.7
_PAIRS, _SHAPES, _TRIPLES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _shapes(t: Tokens) -> np.ndarray:
    """A number for a word's letter case and digits, and for a run of marks' ends and length by powers of two."""
    first_upper = character_tables()[1][t.first] & UPPER
    words = t.traits.astype(np.uint64) | first_upper.astype(np.uint64) << np.uint64(3) | (t.size > 1).astype(np.uint64) << np.uint64(4)
    marks = (t.first.astype(np.uint64) << np.uint64(21) | t.last) << np.uint64(6) | np.floor(np.log2(np.maximum(t.size, 1))).astype(np.uint64) | np.uint64(1 << 62)
    mixed = np.where(t.word, words, marks) * _SHAPES
    return (mixed ^ mixed >> np.uint64(29)) * _PAIRS


def indicators(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of texts, ascending, and their different hashed features, over whole texts: single tokens, pairs of neighbouring tokens, and pairs and triples of neighbouring tokens' shapes, with whether a token comes again at once or after one other. None for an empty text."""
    t = tokens(texts)
    h, s, owner = t.hashed, _shapes(t), t.owner.astype(np.uint64)
    two, three = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
    again, later = (h[:-1] == h[1:]).astype(np.uint64), (h[:-2] == h[2:]).astype(np.uint64)
    pairs = (s[:-1] * np.uint64(31) + s[1:] + np.uint64(7) + again) * _SHAPES
    triples = (pairs[:-1] ^ (s[2:] + later) * _TRIPLES) * _PAIRS
    bigrams = (h[:-1] * np.uint64(31) + h[1:]) * _TRIPLES
    at = np.concatenate([owner, owner[:-1][two], owner[:-1][two], owner[:-2][three]])
    found = np.concatenate([h * _PAIRS, bigrams[two], pairs[two], triples[three]]) >> np.uint64(64 - BITS)
    codes = np.unique(at << np.uint64(BITS) | found)
    return (codes >> np.uint64(BITS)).astype(np.int64), (codes & np.uint64(FEATURES - 1)).astype(np.int64)


def features(text: str | None) -> np.ndarray:
    """The features of one text, ascending."""
    return indicators([text])[1]


def sampled_features(docs: DataFrame, sample: DataFrame, extract: Callable, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[int, int, np.ndarray]]:
    """``doc_id, label, features`` of the sample's documents, by id; ``extract`` gives the owners and features of a list of texts. An id with several texts counts by one of them, the least by its features' bytes. The sample is bounded by whoever drew it, and only hashes of whole texts come to the driver."""
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("features", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[bytes] = []
            for _, texts in groups(batch.column(2).to_pylist()):
                found += [f.astype(np.int32).tobytes() for f in split_by_owner(*extract(texts), len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.binary())], names=["doc_id", "label", "features"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    joined = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
    each = small_batches(joined).mapInArrow(run, kind).groupBy("doc_id", "label").agg(F.min("features").alias("features"))
    return sorted(((r[0], r[1], np.frombuffer(bytes(r[2]), np.int32)) for r in each.collect()), key=lambda r: r[:2])


@dataclass
class LinearModel:
    """``weights`` of indicators, and the logistic curve of the margin."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, owner: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
        """Margins of ``n`` texts from the features of each."""
        counts = np.bincount(owner, minlength=n)
        return np.bincount(owner, self.weights[found], n) / np.sqrt(np.maximum(1, counts)) + self.bias

    def scores(self, texts: list[str | None]) -> np.ndarray:
        owner, found = indicators(texts)
        z = self.slope * self.margins(owner, found, len(texts)) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Each feature's share among the positive rows' features over its share among the negative rows', as a logarithm."""
    sums = []
    for label in (1, 0):
        own = [f for f, y in zip(rows, labels, strict=True) if y == label]
        count = smoothing + (np.bincount(np.concatenate(own), minlength=FEATURES) if own else np.zeros(FEATURES))
        sums.append(count / count.sum())
    return np.log(sums[0] / sums[1])


def dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, labels: np.ndarray, cost: np.ndarray, passes: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the least |w|^2 / 2 plus squared hinge losses, one dual variable at a time; a row's values are ``scale`` over the root of its feature count."""
    signs = np.where(labels == 1, 1.0, -1.0)
    roots = np.array([np.sqrt(max(1, len(r))) for r in rows])
    diagonal = 0.5 / cost
    curvature = np.array([float((scale[r] ** 2).sum()) for r in rows]) / roots**2 + 1.0 + diagonal
    alpha, w, bias = np.zeros(len(rows)), np.zeros(len(scale)), 0.0
    order = np.random.default_rng(seed)
    for _ in range(passes):
        for k in order.permutation(len(rows)):
            r, y = rows[k], signs[k]
            v = scale[r] / roots[k]
            gradient = y * (float(w[r] @ v) + bias) - 1 + diagonal[k] * alpha[k]
            new = max(alpha[k] - gradient / curvature[k], 0.0)
            if step := (new - alpha[k]) * y:
                w[r] += step * v
                bias += step
                alpha[k] = new
    return w * scale, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of the margins, by Newton's steps on smoothed labels; classes weigh alike."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    x, theta = np.stack([margins, np.ones_like(margins)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -40, 40)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-6 * theta)
        theta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(theta[0]), 1e-3), float(theta[1])


def fit(sample: list[tuple[int, int, np.ndarray]], seed: int = 0) -> LinearModel:
    """Fits on four fifths of the sample and draws the curve on the rest, then fits on all. One class alone gives a model that answers it."""
    labels = np.array([y for _, y, _ in sample], np.int64)
    if len(set(labels.tolist())) < 2:
        return LinearModel(np.zeros(FEATURES), 0.0, 1.0, 0.0 if not len(labels) else 3.0 * (2 * int(labels[0]) - 1))
    rows = [f for _, _, f in sample]

    def model(of: np.ndarray) -> LinearModel:
        own, y = [rows[k] for k in of], labels[of]
        cost = COST * len(y) / (2 * np.where(y == 1, max(1, (y == 1).sum()), max(1, (y == 0).sum())))
        return LinearModel(*dual_coordinate_descent(own, log_count_ratios(own, y), y, cost, PASSES, seed))

    back = np.arange(len(rows)) % CURVE_FOLD == 0
    first = model(np.flatnonzero(~back))
    held = [rows[k] for k in np.flatnonzero(back)]
    owner = np.repeat(np.arange(len(held)), [len(r) for r in held])
    slope, offset = logistic_curve(first.margins(owner, np.concatenate(held), len(held)), labels[back])
    out = model(np.arange(len(rows)))
    out.slope, out.offset = slope, offset
    return out


def score_texts(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score``, and ``kept_`` before the name of each column of ``keep``: a row for each input row. The model goes to every executor once; FEATURES, or its words, fix its size."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), *[T.StructField(f"kept_{c}", docs.schema[c].dataType) for c in keep]])
    names = [f.name for f in kind]
    # A text that is kept anyway travels once.
    at = 1 + keep.index(text_col) if text_col in keep and isinstance(docs.schema[text_col].dataType, T.StringType) else len(keep) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            parts = [m.scores(texts) for _, texts in groups(batch.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([*parts, np.zeros(0)])), *batch.columns[1 : len(keep) + 1]], names=names)

    own = [F.col(id_col).cast("long").alias("doc_id")] + [F.col(c).alias(f"kept_{c}") for c in keep]
    own += [F.col(text_col).cast("string").alias("text")] if at > len(keep) else []
    return small_batches(docs.select(*own)).mapInArrow(run, kind)


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 0, label_col: str = "quality") -> LinearModel:
    """A model from the labelled rows given, about ``per_class`` of each class.

    Ids without a document, and null labels, are left out; an id with several
    labels has the largest, one with several texts counts by one of them. Null
    and empty texts have no features; long texts count whole. Without labelled
    rows every score is 0.5, with one class alone the model answers it.
    """
    return fit(sampled_features(docs, class_sample(labels, label_col, per_class, seed), indicators), seed)


def quality_scores(docs: DataFrame, model: LinearModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, score``, and ``kept_`` before each column of ``keep``: each whole text's score from 0 to 1, a row for each input row, null ids and repeated rows included. Null and empty texts have the score of no features; an empty table gives an empty one; other columns are not read."""
    return score_texts(docs, model, id_col, text_col, keep)
