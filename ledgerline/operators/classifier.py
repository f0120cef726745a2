"""A classifier of candidate pairs, and its threshold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.scoring import best_threshold, macro_threshold_sweep

FEATURES = ("jaccard", "edit_distance")


@dataclass
class PairClassifier:
    """A fitted logistic regression over ``columns`` of pairs, and from which score on a pair is a match."""

    model: PipelineModel
    columns: tuple[str, ...]
    threshold: float = 0.5

    def scored(self, pairs: DataFrame) -> DataFrame:
        """``s1_id, target_id, score``: a pair's probability; pairs with a null feature count it as 0."""
        rows = pairs.na.fill(0.0, list(self.columns)).select("s1_id", "target_id", *self.columns)
        return self.model.transform(rows).select("s1_id", "target_id", vector_to_array("probability")[1].alias("score"))

    def matches(self, pairs: DataFrame) -> DataFrame:
        return self.scored(pairs).filter(F.col("score") >= self.threshold)


def fit_pairs(pairs: DataFrame, truth: DataFrame, columns: tuple[str, ...] = FEATURES, regularisation: float = 1e-4) -> PairClassifier:
    """Learns which ``pairs`` (``s1_id, target_id`` and ``columns``) are among ``truth``; the loss is summed by the executors, only the weights pass over the driver. Raises ValueError where the pairs hold one class alone."""
    label = truth.select("s1_id", "target_id", F.lit(1.0).alias("label")).distinct()
    rows = pairs.na.fill(0.0, list(columns)).join(label, ["s1_id", "target_id"], "left").select(*columns, F.coalesce("label", F.lit(0.0)).alias("label"))
    if rows.select("label").distinct().count() < 2:
        raise ValueError("pairs of both classes are needed")
    stages = [VectorAssembler(inputCols=list(columns), outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features"), LogisticRegression(regParam=regularisation)]
    return PairClassifier(Pipeline(stages=stages).fit(rows), tuple(columns))


def tuned(classifier: PairClassifier, pairs: DataFrame, entities: DataFrame, truth: DataFrame, steps: int = 100) -> PairClassifier:
    """The classifier with the threshold of the greatest macro F0.5 over ``entities``, best those of a fold that it hasn't learnt from."""
    best = best_threshold(macro_threshold_sweep(entities, truth, classifier.scored(pairs), steps)).first()
    return PairClassifier(classifier.model, classifier.columns, float(best["threshold"]) if best else classifier.threshold)
