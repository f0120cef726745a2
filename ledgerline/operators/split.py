"""Stratified, deterministic splits and samples, and what folds share.

Order within a stratum is that of ``md5(seed:id)``, so membership follows from
the id alone and doesn't change with the partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.functions.measures import source_tag

#: Ranks are found in this many slices of the hash's range, so no stratum is ordered in one task.
SLICES = 256
#: A stratum of so many entities has one validation entity at least.
LEAST_STRATUM = 5
#: Fixed value: the warning where folds share targets.
LEAKAGE_WARNING = "Potential target-level leakage exists; E2 exclusivity scan is required before interpreting cross-S1 target reuse."


def split_hash(seed: int, s1_id: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), s1_id).cast("binary"))


def ranked(entities: DataFrame, seed: int, strata: tuple[str, ...] = ("country", "bucket")) -> DataFrame:
    """``entities`` with ``rank`` (from 1) in its stratum by the hash, and the stratum's size ``n``."""
    rows = entities.withColumn("h", split_hash(seed, F.col("s1_id")))
    rows = rows.withColumn("slice", (F.conv(F.substring("h", 1, 4), 16, 10).cast("int") * SLICES / 65536).cast("int"))
    sizes = rows.groupBy(*strata, "slice").agg(F.count(F.lit(1)).alias("in_slice"))
    own = Window.partitionBy(*strata)
    before = own.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*strata, "slice", F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("first"), F.sum("in_slice").over(own).alias("n"))
    within = Window.partitionBy(*strata, "slice").orderBy("h", "s1_id")
    rows = rows.withColumn("at", F.row_number().over(within))
    return rows.join(sizes, [*strata, "slice"]).withColumn("rank", F.col("first") + F.col("at")).drop("h", "slice", "first", "at")


def stratified_split(entities: DataFrame, val_fraction: float = 0.1, seed: int = 42, strata: tuple[str, ...] = ("country", "bucket")) -> DataFrame:
    """``entities`` with ``fold``: the first ``rint(n * val_fraction)`` of each stratum are ``val``; one of LEAST_STRATUM or more where that is none."""
    rows = ranked(entities, seed, strata)
    n_val = F.rint(F.col("n") * F.lit(val_fraction))
    n_val = F.when((n_val == 0) & (F.col("n") >= LEAST_STRATUM) & F.lit(val_fraction > 0), 1.0).otherwise(n_val)
    return rows.withColumn("fold", F.when(F.col("rank") <= n_val, "val").otherwise("train")).drop("rank", "n")


def stratified_sample(entities: DataFrame, fraction: float = 0.01, seed: int = 42, strata: tuple[str, ...] = ("country", "bucket")) -> DataFrame:
    """The first ``rint(n * fraction)`` entities of each stratum, one at least."""
    rows = ranked(entities, seed, strata)
    return rows.filter(F.col("rank") <= F.greatest(F.lit(1.0), F.rint(F.col("n") * F.lit(fraction)))).drop("rank", "n")


def split_summary(folds: DataFrame, strata: tuple[str, ...] = ("country", "bucket")) -> DataFrame:
    """Totals, fold sizes and validation share of each stratum."""
    total, val = F.count(F.lit(1)), F.count_if(F.col("fold") == "val")
    rows = folds.groupBy(*strata).agg(total.alias("total_s1"), (total - val).alias("train_s1"), val.alias("val_s1"), (val / total * 100.0).alias("val_percentage"))
    return rows.withColumnRenamed("bucket", "multiplicity_bucket")


def target_parents(folds: DataFrame, edges: DataFrame) -> DataFrame:
    """``target_id, source, train, val``: a target's parents in each fold."""
    distinct = edges.select("s1_id", "target_id").distinct().join(folds.select("s1_id", "fold"), "s1_id")
    parents = distinct.groupBy("target_id").agg(F.count_if(F.col("fold") == "train").alias("train"), F.count_if(F.col("fold") == "val").alias("val"))
    return parents.withColumn("source", source_tag(F.col("target_id"))).filter(F.col("source") != "OTHER")


def target_overlap(folds: DataFrame, edges: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """``category, unique_targets, multi_s1_occurrences, train_val_shared_count`` for each source and fold; ``parents`` are ``target_parents`` where they are there already."""
    t = target_parents(folds, edges) if parents is None else parents
    shared = F.count_if((F.col("train") > 0) & (F.col("val") > 0))
    wide = t.groupBy("source").agg(
        *[F.count_if(F.col(f) > 0).alias(f"u_{f}") for f in ("train", "val")], *[F.count_if(F.col(f) > 1).alias(f"m_{f}") for f in ("train", "val")], shared.alias("shared")
    )
    names = wide.sparkSession.createDataFrame([("S2",), ("S3",)], "s string")
    wide = names.join(wide, F.col("s") == F.col("source"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    one = lambda f, name: F.struct(F.concat("s", F.lit(f" Targets in {name}")).alias("category"), zero(f"u_{f}").alias("unique_targets"), zero(f"m_{f}").alias("multi_s1_occurrences"), zero("shared").alias("train_val_shared_count"))
    return wide.select(F.explode(F.array(one("train", "Train"), one("val", "Val"))).alias("r")).select("r.*")


def leakage_summary(folds: DataFrame, edges: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """One row: fold sizes, targets in each fold, shared and multi-parent targets by source, and a warning where any is shared, else null."""
    t = target_parents(folds, edges) if parents is None else parents
    is_source = lambda s: F.col("source") == s.upper()
    columns = [F.count_if(is_source(s) & (F.col(f) > 0)).alias(f"{f}_{s}_target_count") for f in ("train", "val") for s in ("s2", "s3")]
    columns += [F.count_if(is_source(s) & (F.col("train") > 0) & (F.col("val") > 0)).alias(f"shared_{s}_target_count") for s in ("s2", "s3")]
    columns += [F.count_if(is_source(s) & (F.col("train") + F.col("val") > 1)).alias(f"{s}_targets_under_multiple_s1") for s in ("s2", "s3")]
    sizes = folds.agg(F.count_if(F.col("fold") == "train").alias("train_s1_count"), F.count_if(F.col("fold") == "val").alias("val_s1_count"))
    row = sizes.crossJoin(t.agg(*columns))
    return row.withColumn("warning", F.when(F.col("shared_s2_target_count") + F.col("shared_s3_target_count") > 0, LEAKAGE_WARNING))
