"""Set scores of predictions against truth: one row an entity, and their summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.measures import f_half, ratio


def matched_counts(entities: DataFrame, truth: DataFrame, found: DataFrame) -> DataFrame:
    """``entities`` with ``n_true, n_found, n_both``; edges count once, and those of unknown entities not at all.

    Pairs are grouped by both ids and summed by task before they are dealt out
    by entity, so an entity with a large share of all edges meets many tasks.
    """
    flagged = truth.select("s1_id", "target_id", F.lit(1).alias("t"), F.lit(0).alias("f")).unionByName(found.select("s1_id", "target_id", F.lit(0).alias("t"), F.lit(1).alias("f")))
    pairs = flagged.groupBy("s1_id", "target_id").agg(F.max("t").alias("t"), F.max("f").alias("f"))
    counts = pairs.groupBy("s1_id").agg(F.sum("t").alias("n_true"), F.sum("f").alias("n_found"), F.sum(F.col("t") * F.col("f")).alias("n_both"))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_true", "n_found", "n_both")}
    return entities.join(counts, "s1_id", "left").withColumns(zero)


def duplicate_pairs(predictions: DataFrame) -> DataFrame:
    """Pairs that are predicted more than once."""
    return predictions.groupBy("s1_id", "target_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def per_entity_scores(entities: DataFrame, truth: DataFrame, predictions: DataFrame, check_duplicates: bool = False) -> DataFrame:
    """Counts and F0.5 of every entity. ``check_duplicates`` raises ValueError where a pair is predicted twice."""
    if check_duplicates and (bad := duplicate_pairs(predictions).limit(1).collect()):
        raise ValueError(f"{bad[0]['s1_id']}: {bad[0]['target_id']} is predicted {bad[0]['n']} times")
    c = matched_counts(entities, truth, predictions)
    return c.select(
        F.col("s1_id").alias("source1_entity_id"),
        *[x for x in c.columns if x not in ("s1_id", "n_true", "n_found", "n_both")],
        F.col("n_true").alias("true_count"),
        F.col("n_found").alias("predicted_count"),
        F.col("n_both").alias("true_positive_count"),
        (F.col("n_found") - F.col("n_both")).alias("false_positive_count"),
        (F.col("n_true") - F.col("n_both")).alias("false_negative_count"),
        f_half(F.col("n_both"), F.col("n_true"), F.col("n_found")).alias("f0_5"),
    )


def _summary_columns() -> list:
    n = F.count(F.lit(1))
    true, found = F.col("true_count"), F.col("predicted_count")
    tp, fp, fn = (F.sum(f"{k}_count") for k in ("true_positive", "false_positive", "false_negative"))
    zero = lambda x: F.coalesce(x, F.lit(0)).cast("long")
    share = lambda cond: ratio(F.count_if(cond), n, 0.0)
    mean = lambda x: F.coalesce(F.avg(x), F.lit(0.0))
    return [
        mean("f0_5").alias("macro_f0_5"),
        n.alias("num_entities"),
        F.count_if(true == 0).alias("num_singletons"),
        ratio(F.count_if((true == 0) & (found == 0)), F.count_if(true == 0), 1.0).alias("singleton_accuracy"),
        F.count_if(found == 0).alias("empty_predictions"),
        F.count_if(found > 0).alias("non_empty_predictions"),
        mean(true).alias("mean_true_matches"),
        mean(found).alias("mean_predicted_matches"),
        F.coalesce(F.median(found), F.lit(0.0)).alias("median_predicted_matches"),
        share(found > true).alias("overprediction_rate"),
        share(found < true).alias("underprediction_rate"),
        share((F.col("true_positive_count") == true) & (F.col("true_positive_count") == found)).alias("exact_set_accuracy"),
        zero(tp).alias("pooled_tp"),
        zero(fp).alias("pooled_fp"),
        zero(fn).alias("pooled_fn"),
        ratio(zero(tp), zero(tp) + zero(fp), 0.0).alias("pooled_precision"),
        ratio(zero(tp), zero(tp) + zero(fn), 0.0).alias("pooled_recall"),
    ]


def score_summary(scores: DataFrame, *by: str) -> DataFrame:
    """The summary of ``per_entity_scores``, over all or by groups: macro F0.5, singletons, means, over- and underprediction, pooled counts."""
    return scores.groupBy(*by).agg(*_summary_columns()) if by else scores.agg(*_summary_columns())


def exact_matches(scores: DataFrame) -> DataFrame:
    """Entities whose predicted set is their true one."""
    same = (F.col("true_positive_count") == F.col("true_count")) & (F.col("true_positive_count") == F.col("predicted_count"))
    return scores.select("source1_entity_id", same.alias("exact_match"))


def threshold_sweep(scored_pairs: DataFrame, n_true: int, steps: int = 100) -> DataFrame:
    """``threshold, tp, fp, precision, recall, f0_5`` for pairs with ``score`` (0 to 1) and ``is_match``, kept from each threshold up. Pairs are counted by step before anything is ordered."""
    from pyspark.sql.window import Window

    step = F.least(F.floor(F.col("score") * steps), F.lit(steps - 1)).cast("int")
    counts = scored_pairs.groupBy(step.alias("step")).agg(F.count_if("is_match").alias("tp"), F.count_if(~F.col("is_match")).alias("fp"))
    above = Window.orderBy(F.desc("step"))
    rows = counts.select("step", F.sum("tp").over(above).alias("tp"), F.sum("fp").over(above).alias("fp"))
    found = F.col("tp") + F.col("fp")
    f = F.when(F.col("tp") > 0, F.lit(1.25) * F.col("tp") / (F.lit(0.25 * n_true) + found)).otherwise(0.0)
    return rows.select((F.col("step") / float(steps)).alias("threshold"), "tp", "fp", ratio(F.col("tp"), found, 0.0).alias("precision"), ratio(F.col("tp"), F.lit(n_true), 0.0).alias("recall"), f.alias("f0_5"))


def macro_threshold_sweep(entities: DataFrame, truth: DataFrame, scored_pairs: DataFrame, steps: int = 100) -> DataFrame:
    """``threshold, macro_f0_5``: the mean F0.5 of all ``entities`` if their pairs of at least that ``score`` (0 to 1) are predicted, for each threshold, and 1.0 for none predicted.

    ``truth`` has ``s1_id, target_id``, ``scored_pairs`` also ``score``. An
    entity's F0.5 changes at the steps where it has pairs; the changes are summed
    by step, so entities are grouped once whatever the number of thresholds.
    """
    from pyspark.sql.window import Window

    true = truth.select("s1_id", "target_id").distinct()
    n_true = entities.select("s1_id").distinct().join(true.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n_true")), "s1_id", "left").select("s1_id", F.coalesce("n_true", F.lit(0)).alias("n_true"))
    step = F.least(F.floor(F.col("score") * steps), F.lit(steps - 1)).cast("int")
    pairs = scored_pairs.groupBy("s1_id", "target_id").agg(F.max("score").alias("score")).join(true.withColumn("hit", F.lit(1)), ["s1_id", "target_id"], "left")
    counts = pairs.groupBy("s1_id", step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("tp")).join(n_true, "s1_id")
    down = Window.partitionBy("s1_id").orderBy(F.desc("step"))
    rows = counts.select("s1_id", "step", "n_true", F.sum("n").over(down).alias("found"), F.sum("tp").over(down).alias("both"), "n", "tp")
    after = f_half(F.col("both"), F.col("n_true"), F.col("found"))
    before = f_half(F.col("both") - F.col("tp"), F.col("n_true"), F.col("found") - F.col("n"))
    changes = rows.groupBy("step").agg(F.sum(after - before).alias("change"))
    every = entities.sparkSession.range(steps + 1).select(F.col("id").cast("int").alias("step")).join(changes, "step", "left")
    total = n_true.agg(F.count(F.lit(1)).alias("entities"), F.count_if(F.col("n_true") == 0).cast("double").alias("start"))
    sums = every.select("step", F.coalesce(F.sum("change").over(Window.orderBy(F.desc("step"))), F.lit(0.0)).alias("change")).crossJoin(total)
    return sums.select((F.col("step") / float(steps)).alias("threshold"), F.when(F.col("entities") > 0, (F.col("start") + F.col("change")) / F.col("entities")).otherwise(0.0).alias("macro_f0_5"))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The one row of a sweep with the greatest macro F0.5; ties go to the higher threshold."""
    return sweep.orderBy(F.desc("macro_f0_5"), F.desc("threshold")).limit(1)
