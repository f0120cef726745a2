"""Bounded samples of labelled rows, for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def sampling_number(id_col: str, seed: int) -> Column:
    """A number from 0 to 1 that follows from the id alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 11) / float(1 << 53)


def class_sample(labels: DataFrame, label_col: str, per_class: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """``doc_id, label``: about ``per_class`` rows of each class (0 and 1), all where there are fewer, by a random number that follows from the id.

    Rows with a null id or label are left out; an id with several labels has
    the largest. The sample's size varies as a binomial's does; the classes'
    counts are all that comes to the driver.
    """
    rows = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("label") == 1, F.lit(per_class / max(1, counts.get(1, 0)))).otherwise(F.lit(per_class / max(1, counts.get(0, 0))))
    return rows.filter(sampling_number("doc_id", seed) < share).groupBy("doc_id").agg(F.max("label").alias("label"))
