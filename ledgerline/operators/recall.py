"""Candidate generation: its recall, coverage, sizes, reduction, and what is wrong with a candidate set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.measures import multiplicity_bucket, ratio, source_tag
from ledgerline.operators.scoring import matched_counts

#: Records of the two target sources that a reduction ratio is taken against by default.
S2_RECORDS, S3_RECORDS = 5_034_616, 5_285_603


def edge_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: true edges, those recovered and their share, over all and by target source; 1.0 without any edge."""
    true = truth.select("s1_id", "target_id").distinct()
    hit = candidates.select("s1_id", "target_id").distinct().withColumn("hit", F.lit(1))
    joined = true.join(hit, ["s1_id", "target_id"], "left").withColumn("src", source_tag(F.col("target_id")))
    out = []
    for name, cond in (("global", F.lit(True)), ("s2", F.col("src") == "S2"), ("s3", F.col("src") == "S3")):
        total, found = F.count_if(cond), F.count_if(cond & F.col("hit").isNotNull())
        out += [total.alias(f"{name}_gt_edges"), found.alias(f"{name}_recovered_edges"), ratio(found, total, 1.0).alias(f"{name}_edge_recall")]
    return joined.agg(*out)


def entity_coverage(counts: DataFrame) -> DataFrame:
    """One row from ``matched_counts``: entities with and without truth, those with one or all edges recovered."""
    has = F.col("n_true") > 0
    with_truth, one, every = F.count_if(has), F.count_if(has & (F.col("n_both") > 0)), F.count_if(has & (F.col("n_both") == F.col("n_true")))
    return counts.agg(
        F.count(F.lit(1)).alias("total_entities"),
        with_truth.alias("entities_with_gt"),
        F.count_if(~has).alias("singleton_entities"),
        one.alias("at_least_one_recovered"),
        every.alias("all_recovered"),
        ratio(one, with_truth, 1.0).alias("at_least_one_rate"),
        ratio(every, with_truth, 1.0).alias("all_recovered_rate"),
    )


def candidate_distribution(counts: DataFrame) -> DataFrame:
    """One row: total, mean, median, 90th, 95th and 99th percentile (exact, interpolated), most and least candidates of an entity."""
    n = F.col("n_found")
    p = F.percentile(n, F.array(F.lit(0.9), F.lit(0.95), F.lit(0.99)))
    row = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_candidates"), F.coalesce(F.avg(n), F.lit(0.0)).alias("mean_candidates"), F.coalesce(F.median(n), F.lit(0.0)).alias("median_candidates"),
        p.alias("p"), F.coalesce(F.max(n), F.lit(0)).alias("max_candidates"), F.coalesce(F.min(n), F.lit(0)).alias("min_candidates"),
    )
    at = lambda k, name: F.coalesce(F.col("p")[k], F.lit(0.0)).alias(name)
    return row.select("total_candidates", "mean_candidates", "median_candidates", at(0, "p90_candidates"), at(1, "p95_candidates"), at(2, "p99_candidates"), "max_candidates", "min_candidates")


def reduction_ratio(counts: DataFrame, s2_records: int = S2_RECORDS, s3_records: int = S3_RECORDS) -> DataFrame:
    """One row: the pairs that candidates spare of all pairs; 1.0 where there are none."""
    row = counts.agg(F.count(F.lit(1)).alias("num_s1"), F.coalesce(F.sum("n_found"), F.lit(0)).alias("total_candidate_edges"))
    pairs = F.col("num_s1") * F.lit(s2_records + s3_records)
    return row.select("num_s1", pairs.alias("total_possible_pairs"), "total_candidate_edges", F.when(pairs > 0, 1 - F.col("total_candidate_edges").cast("double") / pairs).otherwise(1.0).alias("reduction_ratio"))


def recall_by(counts: DataFrame, by: str) -> DataFrame:
    """True and recovered edges, recall and candidates of each group."""
    true, both = F.sum("n_true"), F.sum("n_both")
    return counts.groupBy(by).agg(true.alias("total_gt_edges"), both.alias("recovered_gt_edges"), ratio(both, true, 1.0).alias("edge_recall"), F.sum("n_found").alias("total_candidates"))


def evaluate_blocking(entities: DataFrame, truth: DataFrame, candidates: DataFrame, metadata: DataFrame | None = None, s2_records: int = S2_RECORDS, s3_records: int = S3_RECORDS) -> dict[str, DataFrame]:
    """All of the above. ``metadata`` has ``s1_id, country, bucket``; entities that it lacks have their computed bucket, and no country."""
    counts = matched_counts(entities.select("s1_id"), truth, candidates)
    meta = counts if metadata is None else counts.join(metadata.select("s1_id", "country", F.col("bucket").alias("given")), "s1_id", "left")
    bucket = multiplicity_bucket(F.col("n_true"))
    meta = meta.withColumn("bucket", bucket if metadata is None else F.coalesce("given", bucket))
    out = {
        "edge_recall": edge_recall(truth.join(entities.select("s1_id"), "s1_id", "left_semi"), candidates),
        "entity_coverage": entity_coverage(counts),
        "candidate_distribution": candidate_distribution(counts),
        "reduction_ratio": reduction_ratio(counts, s2_records, s3_records),
        "multiplicity_breakdown": recall_by(meta, "bucket"),
    }
    if metadata is not None:
        out["country_breakdown"] = recall_by(meta.filter(F.col("country").isNotNull()), "country")
    return out


def not_in(pairs: DataFrame, allowed: DataFrame) -> DataFrame:
    """Distinct pairs of ``pairs`` that ``allowed`` lacks."""
    return pairs.select("s1_id", "target_id").distinct().join(allowed.select("s1_id", "target_id"), ["s1_id", "target_id"], "left_anti")


def candidate_issues(candidates: DataFrame, allowed_s1: DataFrame | None = None, matched: DataFrame | None = None) -> DataFrame:
    """``rule, s1_id, detail`` of every broken rule: unknown entity, repeated id, id of the own source, id of no source, match that is no candidate."""
    pairs = candidates.groupBy("s1_id", "target_id").agg(F.count(F.lit(1)).alias("n"))
    issue = lambda rows, rule: rows.select(F.lit(rule).alias("rule"), "s1_id", F.col("target_id").alias("detail"))
    own = F.col("target_id").startswith("S1-")
    checks = F.array_compact(
        F.array(
            F.when(F.col("n") > 1, "repeated_id"),
            F.when(own, "self_match"),
            F.when(~own & (source_tag(F.col("target_id")) == "OTHER"), "wrong_prefix"),
        )
    )
    found = pairs.select(F.explode(checks).alias("rule"), "s1_id", F.col("target_id").alias("detail"))
    if allowed_s1 is not None:
        unknown = candidates.select("s1_id").distinct().join(allowed_s1.select("s1_id"), "s1_id", "left_anti")
        found = found.unionByName(unknown.select(F.lit("unknown_s1").alias("rule"), "s1_id", F.lit("").alias("detail")))
    return found if matched is None else found.unionByName(issue(not_in(matched, candidates), "match_not_candidate"))


#: Rules in the order in which a reader is told of the first one broken.
ISSUE_ORDER = ("unknown_s1", "repeated_id", "self_match", "wrong_prefix", "match_not_candidate")


def first_issue(issues: DataFrame) -> DataFrame:
    """The one issue of ``candidate_issues`` that comes first by rule, entity and detail; no row for a sound set."""
    order = F.array_position(F.array(*[F.lit(r) for r in ISSUE_ORDER]), F.col("rule"))
    return issues.orderBy(order, "s1_id", "detail").limit(1)
