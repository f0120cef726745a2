"""Tags, buckets, ratios and the F0.5 of a set, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Multiplicity buckets in order.
BUCKETS = ("bucket_0", "bucket_1", "bucket_2_4", "bucket_5_plus")


def source_tag(target_id: Column) -> Column:
    """``S2`` or ``S3`` by the id's prefix, else ``OTHER``."""
    return F.when(target_id.startswith("S2-"), "S2").when(target_id.startswith("S3-"), "S3").otherwise("OTHER")


def multiplicity_bucket(m: Column) -> Column:
    return F.when(m == 0, BUCKETS[0]).when(m == 1, BUCKETS[1]).when(m <= 4, BUCKETS[2]).otherwise(BUCKETS[3])


def fine_bucket(m: Column) -> Column:
    """1 to 5 as they are, and ``6+``."""
    return F.when(m <= 5, m.cast("string")).otherwise("6+")


def ratio(part: Column, whole: Column, empty: float) -> Column:
    """``part / whole`` as a double, ``empty`` where there is no whole."""
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(empty))


def percentage(part: Column, whole: Column, digits: int | None = None) -> Column:
    """Of ``whole``, 0.0 without one; rounded to ``digits`` where given."""
    value = F.when(whole > 0, part.cast("double") / whole * 100.0).otherwise(F.lit(0.0))
    return value if digits is None else F.round(value, digits)


def f_half(tp: Column, n_true: Column, n_pred: Column) -> Column:
    """F0.5 of a predicted set: 1 where both sets are empty, 0 where one is, else 1.25 tp / (0.25 true + predicted)."""
    both = F.lit(1.25) * tp / (F.lit(0.25) * n_true + n_pred)
    return F.when((n_true == 0) & (n_pred == 0), F.lit(1.0)).when((n_true == 0) | (n_pred == 0), F.lit(0.0)).otherwise(both)


def or_unknown(country: Column, empty_too: bool = False) -> Column:
    """``Unknown`` for a missing country; for an empty one only with ``empty_too``."""
    known = F.coalesce(country, F.lit("Unknown"))
    return F.when(known == "", "Unknown").otherwise(known) if empty_too else known
