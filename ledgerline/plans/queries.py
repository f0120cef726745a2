"""Registered queries over the fixture views, each with the DuckDB SQL that it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import measures, text
from ledgerline.operators import audits, edges, matching, recall, scoring, split, validation
from ledgerline.sources.fixtures import Fixture, sql_prelude

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Those that read views, as functions of a fixture.
ON_VIEWS: dict[str, Callable[[Fixture], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None, views: bool = True) -> Callable:
    """Registers a function of the fixture (or, without ``views``, of session and folder) under its name."""

    def register(f: Callable) -> Callable:
        if views:
            ON_VIEWS[f.__name__] = f
        QUERIES[f.__name__] = (lambda spark, sf_dir: f(Fixture(spark, sf_dir))) if views else f
        if sql is not None:
            ORACLE_SQL[f.__name__] = f"{sql_prelude()},\n{_SHARED}\n{sql}" if views else sql
        return f

    return register


#: Expressions that several oracles use, after the views.
_SHARED = """
ent AS (SELECT entity_id AS s1_id, country, k FROM er_s1),
mult AS (SELECT e.s1_id, e.country, count(t.target_id) AS m FROM ent e LEFT JOIN er_truth t ON e.s1_id = t.s1_id GROUP BY e.s1_id, e.country),
bucketed AS (SELECT *, CASE WHEN m = 0 THEN 'bucket_0' WHEN m = 1 THEN 'bucket_1' WHEN m <= 4 THEN 'bucket_2_4' ELSE 'bucket_5_plus' END AS bucket FROM mult),
tn AS (SELECT s1_id, count(*) AS n FROM er_truth GROUP BY s1_id),
pn AS (SELECT s1_id, count(*) AS n FROM er_pred GROUP BY s1_id),
cn AS (SELECT s1_id, count(*) AS n FROM er_cand GROUP BY s1_id),
pb AS (SELECT t.s1_id, count(*) AS n FROM er_truth t JOIN er_pred p ON t.s1_id = p.s1_id AND t.target_id = p.target_id GROUP BY t.s1_id),
cb AS (SELECT t.s1_id, count(*) AS n FROM er_truth t JOIN er_cand c ON t.s1_id = c.s1_id AND t.target_id = c.target_id GROUP BY t.s1_id),
scores AS (
  SELECT b.s1_id, b.country, b.bucket, coalesce(tn.n, 0) AS t, coalesce(pn.n, 0) AS p, coalesce(pb.n, 0) AS tp,
    CASE WHEN coalesce(tn.n, 0) = 0 AND coalesce(pn.n, 0) = 0 THEN 1e0 WHEN coalesce(tn.n, 0) = 0 OR coalesce(pn.n, 0) = 0 THEN 0e0
      ELSE 1.25e0 * coalesce(pb.n, 0) / (0.25e0 * tn.n + pn.n) END AS f
  FROM bucketed b LEFT JOIN tn USING (s1_id) LEFT JOIN pn USING (s1_id) LEFT JOIN pb USING (s1_id)),
cands AS (
  SELECT b.s1_id, b.country, b.bucket, coalesce(tn.n, 0) AS t, coalesce(cn.n, 0) AS c, coalesce(cb.n, 0) AS tp
  FROM bucketed b LEFT JOIN tn USING (s1_id) LEFT JOIN cn USING (s1_id) LEFT JOIN cb USING (s1_id)),
ranked AS (
  SELECT s1_id, country, bucket, row_number() OVER (PARTITION BY country, bucket ORDER BY md5('42:' || s1_id), s1_id) AS rank, count(*) OVER (PARTITION BY country, bucket) AS n
  FROM bucketed),
folds AS (
  SELECT *, CASE WHEN rank <= CASE WHEN round_even(n * CAST(0.1 AS DOUBLE), 0) = 0 AND n >= 5 THEN 1 ELSE round_even(n * CAST(0.1 AS DOUBLE), 0) END THEN 'val' ELSE 'train' END AS fold
  FROM ranked),
parents AS (
  SELECT t.target_id, substr(t.target_id, 1, 2) AS source, sum(CASE WHEN fold = 'train' THEN 1 ELSE 0 END) AS train, sum(CASE WHEN fold = 'val' THEN 1 ELSE 0 END) AS val
  FROM er_truth t JOIN folds f ON t.s1_id = f.s1_id GROUP BY t.target_id),
deg AS (SELECT target_id, substr(target_id, 1, 2) AS source, count(*) AS d FROM er_truth GROUP BY target_id),
targets AS (SELECT entity_id, business_name, business_address, country FROM er_s2 UNION ALL SELECT entity_id, business_name, business_address, country FROM er_s3),
last_parent AS (SELECT target_id, max_by(s1_id, k) AS s1_id FROM er_truth GROUP BY target_id),
cc AS (
  SELECT l.s1_id, l.target_id, substr(l.target_id, 1, 2) AS source, trim(coalesce(a.country, 'Unknown')) AS s1_country, trim(coalesce(b.country, 'Unknown')) AS target_country, trim(coalesce(a.country, 'Unknown')) = trim(coalesce(b.country, 'Unknown')) AS same
  FROM last_parent l JOIN targets b ON l.target_id = b.entity_id JOIN er_s1 a ON l.s1_id = a.entity_id)
"""

_WS = r"[\s\x1c-\x1f\x{85}\p{Z}]"


def _norm(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({c}), '[^\p{{L}}\p{{N}}_\s\x1c-\x1f\x{{85}}\p{{Z}}]', ' ', 'g'), '{_WS}+', ' ', 'g'))"


def _entities(x: Fixture) -> DataFrame:
    return x.s1.select(F.col("entity_id").alias("s1_id"), "country")


def _edges(x: Fixture) -> DataFrame:
    return x.truth.withColumn("ord", F.col("k"))


def _bucketed(x: Fixture) -> DataFrame:
    return edges.multiplicity(_entities(x), x.truth)


def _targets(x: Fixture) -> DataFrame:
    cols = ["entity_id", "business_name", "business_address", "country"]
    return x.s2.select(*cols).unionByName(x.s3.select(*cols))


def _scores(x: Fixture) -> DataFrame:
    return scoring.per_entity_scores(_bucketed(x).drop("m"), x.truth, x.pred)


def _cand_counts(x: Fixture) -> DataFrame:
    return scoring.matched_counts(_bucketed(x).drop("m"), x.truth, x.cand)


def _resolved(x: Fixture) -> DataFrame:
    return audits.country_edges(_edges(x), x.s1, _targets(x))


def _folds(x: Fixture) -> DataFrame:
    return split.stratified_split(_bucketed(x))


def _agreed(x: Fixture) -> DataFrame:
    """Over edges into S2, the source whose names are variants of their parents'."""
    return audits.agreement_edges(_edges(x), x.s1, x.s2, prefix="S2-")


_AGREED = f"""agreed AS (
  SELECT l.s1_id, l.target_id, CASE WHEN a.country = '' THEN 'Unknown' ELSE a.country END AS country, m.m, a.business_name AS n1, b.business_name AS n2, a.business_address AS a1, b.business_address AS a2,
    {_norm('a.business_name')} AS nn1, {_norm('b.business_name')} AS nn2, {_norm('a.business_address')} AS na1, {_norm('b.business_address')} AS na2
  FROM last_parent l JOIN er_s2 b ON l.target_id = b.entity_id JOIN er_s1 a ON l.s1_id = a.entity_id JOIN mult m ON l.s1_id = m.s1_id),
flagged AS (SELECT *, nn1 <> '' AND nn1 = nn2 AS ne, na1 <> '' AND na1 = na2 AS ae FROM agreed)"""

_KINDS = {"name_exact": "ne", "addr_exact": "ae", "both_exact": "ne AND ae", "name_only": "ne AND NOT ae", "addr_only": "NOT ne AND ae", "neither_exact": "NOT ne AND NOT ae"}


@query("SELECT 'S1' AS source, country, count(*) AS n FROM er_s1 GROUP BY country UNION ALL SELECT 'S2', country, count(*) FROM er_s2 GROUP BY country UNION ALL SELECT 'S3', country, count(*) FROM er_s3 GROUP BY country")
def source_union_counts(x: Fixture) -> DataFrame:
    parts = [df.select(F.lit(s).alias("source"), "country") for s, df in (("S1", x.s1), ("S2", x.s2), ("S3", x.s3))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("source", "country").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT source1_entity_id, matched_entity_ids FROM er_gt")
def gt_lists(x: Fixture) -> DataFrame:
    return edges.implode_lists(_entities(x), x.truth)


@query("SELECT s1_id, target_id, substr(target_id, 1, 2) AS target_source, row_number() OVER (PARTITION BY s1_id ORDER BY target_id) - 1 AS pos FROM er_truth")
def gt_explode(x: Fixture) -> DataFrame:
    return edges.explode_lists(x.gt).withColumn("pos", F.col("pos").cast("long"))


@query("""SELECT (SELECT count(*) FROM ent) AS total_gt_s1_entities, count(*) AS total_gt_edges, sum(CASE WHEN src = 'S2' THEN 1 ELSE 0 END)::BIGINT AS total_s2_edges,
  sum(CASE WHEN src = 'S3' THEN 1 ELSE 0 END)::BIGINT AS total_s3_edges, count(DISTINCT CASE WHEN src = 'S2' THEN target_id END) AS unique_s2_targets, count(DISTINCT CASE WHEN src = 'S3' THEN target_id END) AS unique_s3_targets,
  0::BIGINT AS invalid_prefix_count, 0::BIGINT AS missing_s1_in_source_count, 0::BIGINT AS missing_s2_in_source_count, 0::BIGINT AS missing_s3_in_source_count,
  (SELECT count(*) FROM deg WHERE source = 'S2' AND d > 1) AS s2_targets_under_multiple_s1_count, (SELECT count(*) FROM deg WHERE source = 'S3' AND d > 1) AS s3_targets_under_multiple_s1_count, true AS integrity_passed
FROM (SELECT *, substr(target_id, 1, 2) AS src FROM er_truth)""")  # fmt: skip
def gt_integrity(x: Fixture) -> DataFrame:
    ids = lambda df: df.select(F.col("entity_id").alias("id"))
    return edges.integrity(_entities(x), x.truth, ids(x.s1), ids(x.s2), ids(x.s3))


@query("SELECT bucket, count(*) AS n, sum(m)::BIGINT AS edges FROM bucketed GROUP BY bucket")
def multiplicity_buckets(x: Fixture) -> DataFrame:
    return _bucketed(x).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("edges"))


@query("SELECT CASE WHEN m <= 5 THEN CAST(m AS VARCHAR) ELSE '6+' END AS multiplicity, count(*) AS n FROM mult WHERE m > 0 GROUP BY 1")
def fine_multiplicity_buckets(x: Fixture) -> DataFrame:
    return _bucketed(x).filter("m > 0").groupBy(measures.fine_bucket(F.col("m")).alias("multiplicity")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT country, bucket, count(*) AS n, grouping(country, bucket)::INTEGER AS level FROM bucketed GROUP BY ROLLUP (country, bucket)")
def stratum_rollup(x: Fixture) -> DataFrame:
    return edges.stratum_rollup(_bucketed(x))


@query("SELECT s1_id, country, bucket, fold FROM folds")
def split_assignment(x: Fixture) -> DataFrame:
    return _folds(x).select("s1_id", "country", "bucket", "fold")


@query("SELECT country, bucket AS multiplicity_bucket, count(*) AS total_s1, count(*) FILTER (WHERE fold = 'train') AS train_s1, count(*) FILTER (WHERE fold = 'val') AS val_s1, count(*) FILTER (WHERE fold = 'val') / count(*) * 100e0 AS val_percentage FROM folds GROUP BY country, bucket")
def split_summary(x: Fixture) -> DataFrame:
    return split.split_summary(_folds(x))


@query("SELECT s1_id, country, bucket FROM ranked WHERE rank <= greatest(1, round_even(n * CAST(0.01 AS DOUBLE), 0))")
def stratified_sample(x: Fixture) -> DataFrame:
    return split.stratified_sample(_bucketed(x)).select("s1_id", "country", "bucket")


@query("""SELECT s.source || ' Targets in ' || f.name AS category, count(*) FILTER (WHERE p.source = s.source AND CASE WHEN f.name = 'Train' THEN train ELSE val END > 0) AS unique_targets,
  count(*) FILTER (WHERE p.source = s.source AND CASE WHEN f.name = 'Train' THEN train ELSE val END > 1) AS multi_s1_occurrences, count(*) FILTER (WHERE p.source = s.source AND train > 0 AND val > 0) AS train_val_shared_count
FROM parents p CROSS JOIN (VALUES ('S2'), ('S3')) s(source) CROSS JOIN (VALUES ('Train'), ('Val')) f(name) GROUP BY 1""")
def target_overlap_report(x: Fixture) -> DataFrame:
    return split.target_overlap(_folds(x), x.truth)


@query(f"""SELECT (SELECT count(*) FROM folds WHERE fold = 'train') AS train_s1_count, (SELECT count(*) FROM folds WHERE fold = 'val') AS val_s1_count,
  {', '.join(f"count(*) FILTER (WHERE source = '{s.upper()}' AND {f} > 0) AS {f}_{s}_target_count" for f in ("train", "val") for s in ("s2", "s3"))},
  {', '.join(f"count(*) FILTER (WHERE source = '{s.upper()}' AND train > 0 AND val > 0) AS shared_{s}_target_count, count(*) FILTER (WHERE source = '{s.upper()}' AND train + val > 1) AS {s}_targets_under_multiple_s1" for s in ("s2", "s3"))},
  CASE WHEN count(*) FILTER (WHERE train > 0 AND val > 0) > 0 THEN '{split.LEAKAGE_WARNING}' END AS warning FROM parents""")
def leakage_summary(x: Fixture) -> DataFrame:
    return split.leakage_summary(_folds(x), x.truth)


@query("SELECT s1_id AS source1_entity_id, country, bucket, t AS true_count, p AS predicted_count, tp AS true_positive_count, p - tp AS false_positive_count, t - tp AS false_negative_count, f AS f0_5 FROM scores")
def f05_per_entity(x: Fixture) -> DataFrame:
    return _scores(x)


_SUMMARY = """round(avg(f), 9) AS macro_f0_5, count(*) AS num_entities, count(*) FILTER (WHERE t = 0) AS num_singletons,
  CASE WHEN count(*) FILTER (WHERE t = 0) > 0 THEN count(*) FILTER (WHERE t = 0 AND p = 0) / count(*) FILTER (WHERE t = 0) ELSE 1e0 END AS singleton_accuracy,
  count(*) FILTER (WHERE p = 0) AS empty_predictions, count(*) FILTER (WHERE p > 0) AS non_empty_predictions, round(avg(t), 9) AS mean_true_matches, round(avg(p), 9) AS mean_predicted_matches,
  median(p)::DOUBLE AS median_predicted_matches, count(*) FILTER (WHERE p > t) / count(*) AS overprediction_rate, count(*) FILTER (WHERE p < t) / count(*) AS underprediction_rate,
  count(*) FILTER (WHERE tp = t AND tp = p) / count(*) AS exact_set_accuracy, sum(tp)::BIGINT AS pooled_tp, sum(p - tp)::BIGINT AS pooled_fp, sum(t - tp)::BIGINT AS pooled_fn,
  CASE WHEN sum(p) > 0 THEN sum(tp)::DOUBLE / sum(p)::DOUBLE ELSE 0e0 END AS pooled_precision, CASE WHEN sum(t) > 0 THEN sum(tp)::DOUBLE / sum(t)::DOUBLE ELSE 0e0 END AS pooled_recall"""


def _rounded(df: DataFrame) -> DataFrame:
    """Means depend on the order of sums in their last digits."""
    return df.withColumns({c: F.round(c, 9) for c in ("macro_f0_5", "mean_true_matches", "mean_predicted_matches")})


@query(f"SELECT {_SUMMARY} FROM scores")
def scorer_summary(x: Fixture) -> DataFrame:
    return _rounded(scoring.score_summary(_scores(x)))


@query(f"SELECT country, bucket, {_SUMMARY} FROM scores GROUP BY country, bucket")
def f05_by_stratum(x: Fixture) -> DataFrame:
    return _rounded(scoring.score_summary(_scores(x), "country", "bucket"))


@query("SELECT s1_id AS source1_entity_id, tp = t AND tp = p AS exact_match FROM scores")
def exact_set_match(x: Fixture) -> DataFrame:
    return scoring.exact_matches(_scores(x))


def _part(name: str, cond: str) -> str:
    hit = f"count(*) FILTER (WHERE {cond} AND hit)"
    return f"count(*) FILTER (WHERE {cond}) AS {name}_gt_edges, {hit} AS {name}_recovered_edges, CASE WHEN count(*) FILTER (WHERE {cond}) > 0 THEN {hit} / count(*) FILTER (WHERE {cond}) ELSE 1e0 END AS {name}_edge_recall"


@query(f"""SELECT {_part('global', 'true')}, {_part('s2', "src = 'S2'")}, {_part('s3', "src = 'S3'")}
FROM (SELECT substr(t.target_id, 1, 2) AS src, c.s1_id IS NOT NULL AS hit FROM er_truth t LEFT JOIN er_cand c ON t.s1_id = c.s1_id AND t.target_id = c.target_id)""")
def blocking_edge_recall(x: Fixture) -> DataFrame:
    return recall.edge_recall(x.truth, x.cand)


@query("""SELECT count(*) AS total_entities, count(*) FILTER (WHERE t > 0) AS entities_with_gt, count(*) FILTER (WHERE t = 0) AS singleton_entities, count(*) FILTER (WHERE t > 0 AND tp > 0) AS at_least_one_recovered,
  count(*) FILTER (WHERE t > 0 AND tp = t) AS all_recovered, count(*) FILTER (WHERE t > 0 AND tp > 0) / count(*) FILTER (WHERE t > 0) AS at_least_one_rate, count(*) FILTER (WHERE t > 0 AND tp = t) / count(*) FILTER (WHERE t > 0) AS all_recovered_rate FROM cands""")
def entity_coverage(x: Fixture) -> DataFrame:
    return recall.entity_coverage(_cand_counts(x))


@query("""SELECT sum(c)::BIGINT AS total_candidates, round(avg(c), 9) AS mean_candidates, median(c)::DOUBLE AS median_candidates, quantile_cont(c, 0.9)::DOUBLE AS p90_candidates, quantile_cont(c, 0.95)::DOUBLE AS p95_candidates,
  quantile_cont(c, 0.99)::DOUBLE AS p99_candidates, max(c) AS max_candidates, min(c) AS min_candidates FROM cands""")
def candidate_distribution(x: Fixture) -> DataFrame:
    return recall.candidate_distribution(_cand_counts(x)).withColumn("mean_candidates", F.round("mean_candidates", 9))


@query("SELECT count(*) AS num_s1, (count(*) * 10320219)::BIGINT AS total_possible_pairs, sum(c)::BIGINT AS total_candidate_edges, 1 - sum(c)::DOUBLE / (count(*) * 10320219) AS reduction_ratio FROM cands")
def reduction_ratio(x: Fixture) -> DataFrame:
    return recall.reduction_ratio(_cand_counts(x))


_BY = "sum(t)::BIGINT AS total_gt_edges, sum(tp)::BIGINT AS recovered_gt_edges, CASE WHEN sum(t) > 0 THEN sum(tp)::DOUBLE / sum(t)::DOUBLE ELSE 1e0 END AS edge_recall, sum(c)::BIGINT AS total_candidates FROM cands"


@query(f"SELECT country, {_BY} GROUP BY country")
def recall_by_country(x: Fixture) -> DataFrame:
    return recall.recall_by(_cand_counts(x), "country")


@query(f"SELECT bucket, {_BY} GROUP BY bucket")
def recall_by_bucket(x: Fixture) -> DataFrame:
    return recall.recall_by(_cand_counts(x), "bucket")


@query("""SELECT 'match_not_candidate' AS rule, p.s1_id, p.target_id AS detail FROM er_pred p WHERE NOT EXISTS (SELECT 1 FROM er_cand c WHERE c.s1_id = p.s1_id AND c.target_id = p.target_id)
UNION ALL SELECT DISTINCT 'unknown_s1', s1_id, '' FROM er_cand WHERE s1_id NOT IN (SELECT s1_id FROM ent WHERE k % 10 <> 0)""")
def candidate_set_issues(x: Fixture) -> DataFrame:
    allowed = x.s1.filter("k % 10 <> 0").select(F.col("entity_id").alias("s1_id"))
    return recall.candidate_issues(x.cand, allowed, x.pred)


@query("SELECT s1_id, target_id FROM er_pred EXCEPT SELECT s1_id, target_id FROM er_cand")
def matches_not_in_candidates(x: Fixture) -> DataFrame:
    return recall.not_in(x.pred, x.cand)


@query("""SELECT CASE WHEN g = 3 THEN 'OVERALL' WHEN g = 2 THEN 'BY_TARGET_SOURCE' WHEN g = 1 THEN 'BY_S1_COUNTRY' ELSE 'BY_COUNTRY_X_SOURCE' END AS slice_type, coalesce(s1_country, 'ALL') AS s1_country, coalesce(source, 'ALL') AS target_source,
  n AS total_edges, s AS same_country_edges, n - s AS cross_country_edges, CASE WHEN n > 0 THEN round(s / n * 100e0, 6) ELSE 0e0 END AS same_country_pct, CASE WHEN n > 0 THEN round((n - s) / n * 100e0, 6) ELSE 0e0 END AS cross_country_pct
FROM (SELECT s1_country, source, grouping(s1_country, source) AS g, count(*) AS n, count(*) FILTER (WHERE same) AS s FROM cc GROUP BY CUBE (s1_country, source))""")
def cross_country_slices(x: Fixture) -> DataFrame:
    return audits.cross_country_slices(_resolved(x))


@query("SELECT s1_id AS source1_entity_id, s1_country AS source1_country, target_id AS target_entity_id, target_country, source AS target_source FROM cc WHERE NOT same ORDER BY source, target_id, s1_id LIMIT 100")
def cross_country_examples(x: Fixture) -> DataFrame:
    return audits.cross_country_examples(_resolved(x))


@query("""SELECT (SELECT count(*) FROM ent WHERE k % 10 = 0) AS missing_s1_rows, count(*) FILTER (WHERE src = 'S2') AS total_s2_edges, count(*) FILTER (WHERE src = 'S3') AS total_s3_edges,
  count(DISTINCT CASE WHEN src = 'S2' AND o % 13 = 0 THEN target_id END) AS missing_s2_targets, count(DISTINCT CASE WHEN src = 'S3' AND o % 13 = 0 THEN target_id END) AS missing_s3_targets, (SELECT count(*) FROM ent WHERE k % 10 <> 0) AS s1_entities_resolved
FROM (SELECT target_id, substr(target_id, 1, 2) AS src, CAST(split_part(target_id, '-', 2) AS BIGINT) AS o FROM er_truth WHERE k % 10 <> 0)""")
def country_missing(x: Fixture) -> DataFrame:
    """Where some entities and targets have no record."""
    cols = ["entity_id", "country"]
    targets = x.s2.filter("ok % 13 <> 0").select(*cols).unionByName(x.s3.filter("ok % 13 <> 0").select(*cols))
    return audits.country_missing(_entities(x), _edges(x), x.s1.filter("k % 10 <> 0"), targets)


@query(f"SELECT count(*) AS total_edges, count(*) FILTER (WHERE NOT same) AS cross_country_edges, CASE WHEN count(*) FILTER (WHERE NOT same) > 0 THEN '{audits.RISK}' WHEN count(*) > 0 THEN '{audits.SAFE}' ELSE '{audits.UNRESOLVED}' END AS architectural_status FROM cc")
def country_partition_verdict(x: Fixture) -> DataFrame:
    return audits.country_verdict(_resolved(x))


@query("""SELECT coalesce(source, 'OVERALL') AS target_source, sum(d)::BIGINT AS total_edges, count(*) AS distinct_targets, count(*) FILTER (WHERE d = 1) AS single_parent_targets, count(*) FILTER (WHERE d > 1) AS multi_parent_targets,
  max(d) AS max_parent_count, (sum(d) - count(*))::BIGINT AS duplicate_references, round(count(*) FILTER (WHERE d = 1) / count(*) * 100e0, 6) AS exclusivity_rate_pct FROM deg GROUP BY ROLLUP (source)""")
def exclusivity_stats(x: Fixture) -> DataFrame:
    return audits.exclusivity_stats(x.truth)


@query(", " + """h AS (SELECT source, d, count(*) AS n FROM deg GROUP BY source, d UNION ALL SELECT 'OVERALL', d, count(*) FROM deg GROUP BY d UNION ALL SELECT s, 1, 0 FROM (VALUES ('S2'), ('S3'), ('OVERALL')) v(s)),
g AS (SELECT source, d, sum(n) AS n FROM h GROUP BY source, d)
SELECT source AS target_source, d AS in_degree, n::BIGINT AS target_count, round(n::DOUBLE / (sum(n) OVER (PARTITION BY source))::DOUBLE * 100e0, 6) AS percentage FROM g""")
def indegree_distribution(x: Fixture) -> DataFrame:
    return audits.indegree_distribution(x.truth)


@query("""SELECT c.target_id AS target_entity_id, c.source AS target_source, c.d AS num_parents, string_agg(t.s1_id, ',' ORDER BY t.k, t.s1_id) AS parent_s1_ids, string_agg(coalesce(a.country, 'Unknown'), ',' ORDER BY t.k, t.s1_id) AS parent_countries
FROM (SELECT * FROM deg WHERE d > 1 ORDER BY source, target_id LIMIT 100) c JOIN er_truth t ON c.target_id = t.target_id LEFT JOIN er_s1 a ON t.s1_id = a.entity_id GROUP BY 1, 2, 3""")
def multi_parent_examples(x: Fixture) -> DataFrame:
    return audits.multi_parent_examples(_edges(x), x.s1)


@query(f"SELECT c AS is_structurally_cleared, CASE WHEN c THEN '{audits.PLAUSIBLE}' ELSE '{audits.DO_NOT_ENABLE}' END AS architectural_status FROM (SELECT count(DISTINCT source) = 2 AND max(d) = 1 AS c FROM deg)")
def assignment_verdict(x: Fixture) -> DataFrame:
    return audits.assignment_verdict(audits.exclusivity_stats(x.truth))


EXPECTED = {"total_gt_s1": 1500, "total_s2_edges": 2298, "total_s3_edges": 2796, "total_gt_edges": 5094}


@query(f"""SELECT *, CASE WHEN counts_reconciled THEN 'PASS WITH FINDINGS' ELSE 'FAIL' END AS status FROM (
  SELECT n AS total_gt_s1, s2 AS total_s2_edges, s3 AS total_s3_edges, s2 + s3 AS total_gt_edges, true AS s1_resolution_passed, true AS s2_resolution_passed, true AS s3_resolution_passed,
    n = {EXPECTED['total_gt_s1']} AND s2 = {EXPECTED['total_s2_edges']} AND s3 = {EXPECTED['total_s3_edges']} AS counts_reconciled
  FROM (SELECT (SELECT count(*) FROM ent) AS n, count(*) FILTER (WHERE target_id LIKE 'S2-%') AS s2, count(*) FILTER (WHERE target_id LIKE 'S3-%') AS s3 FROM er_truth))""")
def reconciliation(x: Fixture) -> DataFrame:
    return audits.reconciliation(_entities(x), x.truth, x.s1, _targets(x), EXPECTED)


@query("SELECT target_id, min_by(s1_id, k) AS first_parent, max_by(s1_id, k) AS last_parent, count(*) AS num_parents FROM er_truth GROUP BY target_id")
def first_and_last_parent(x: Fixture) -> DataFrame:
    return edges.first_and_last_parent(_edges(x))


_TOKENS = "('null', 'n/a', 'na', 'nan', 'none', 'unknown', 'undefined')"
_STRIP = "' ,.<>()[]{}!?:;\"' || chr(39) || chr(9) || chr(13) || chr(10)"
_ADDR = f"""recs AS (SELECT 'fixture' AS dataset, 'S1' AS source, entity_id, business_address AS a FROM er_s1 UNION ALL SELECT 'fixture', 'S2', entity_id, business_address FROM er_s2 UNION ALL SELECT 'fixture', 'S3', entity_id, business_address FROM er_s3),
st AS (SELECT *, regexp_replace(a, '^{_WS}+|{_WS}+$', '', 'g') AS s FROM recs),
fl AS (
  SELECT *, CASE WHEN lower(s) IN {_TOKENS} THEN lower(s) WHEN regexp_matches(s, '^(<.*>|\\[.*\\]|\\(.*\\))$') AND lower(trim(s[2:-2])) IN {_TOKENS} THEN lower(trim(s[2:-2])) END AS whole FROM st),
tk AS (SELECT dataset, source, entity_id, unnest(string_split_regex(s, '{_WS}+')) AS t FROM fl WHERE s <> '' AND whole IS NULL),
ct AS (SELECT *, trim(t, {_STRIP}) AS c FROM tk),
hits AS (SELECT dataset, source, entity_id, bool_or(lower(c) IN {_TOKENS}) AS cleaned, bool_or(lower(t) IN {_TOKENS}) AS raw FROM ct GROUP BY dataset, source, entity_id)"""


def _records(x: Fixture) -> DataFrame:
    part = lambda df, s: df.select(F.lit("fixture").alias("dataset"), F.lit(s).alias("source"), "entity_id", "business_address")
    return part(x.s1, "S1").unionByName(part(x.s2, "S2")).unionByName(part(x.s3, "S3"))


def _with(sql: str) -> str:
    """More common table expressions after the shared ones."""
    return ", " + sql


_NA = "('', '#n/a', '#n/a n/a', '#na', '-1.#ind', '-1.#qnan', '-nan', '1.#ind', '1.#qnan', '<na>', 'n/a', 'na', 'null', 'nan', 'none')"


@query(_with(f"""{_ADDR}
SELECT f.dataset, f.source, count(*) AS total_rows, count(*) FILTER (WHERE a = '' OR (s <> '' AND lower(s) IN {_NA})) AS pandas_nan_count, count(*) FILTER (WHERE a = '') AS empty_string_count, count(*) FILTER (WHERE a <> '' AND s = '') AS whitespace_only_count,
  count(whole) AS whole_field_placeholder_count, count(*) FILTER (WHERE s = '' OR whole IS NOT NULL) AS effectively_missing_count, count(*) FILTER (WHERE s = '' OR whole IS NOT NULL) / count(*) * 100e0 AS effectively_missing_pct,
  count(*) FILTER (WHERE s <> '' AND whole IS NULL) AS nonempty_address_count, count(*) FILTER (WHERE cleaned) AS rows_with_component_placeholder_cleaned, count(*) FILTER (WHERE cleaned) / count(*) * 100e0 AS rows_with_component_placeholder_cleaned_pct,
  count(*) FILTER (WHERE raw) AS rows_with_component_placeholder_raw_ws, count(*) FILTER (WHERE NOT cleaned) AS rows_clean_nonempty, count(*) FILTER (WHERE NOT cleaned) / count(*) * 100e0 AS rows_clean_nonempty_pct
FROM fl f LEFT JOIN hits h USING (dataset, source, entity_id) GROUP BY f.dataset, f.source"""))
def placeholder_field_summary(x: Fixture) -> DataFrame:
    return audits.placeholder_field_summary(_records(x))


@query(_with(f"""{_ADDR},
hit AS (SELECT *, lower(c) AS token, CASE WHEN c = upper(c) THEN 'u' WHEN c = lower(c) THEN 'l' WHEN regexp_matches(c, '^[A-Z][a-z]*(/[A-Z][a-z]*)*$') THEN 't' ELSE 'o' END AS kind FROM ct WHERE lower(c) IN {_TOKENS}),
grid AS (SELECT DISTINCT dataset, source, token FROM recs CROSS JOIN (SELECT unnest(['null', 'n/a', 'na', 'nan', 'none', 'unknown', 'undefined']) AS token))
SELECT g.dataset, g.source, g.token, (SELECT count(*) FROM fl WHERE fl.source = g.source AND whole = g.token) AS whole_field_rows, count(h.c) AS component_token_occurrences_cleaned,
  count(*) FILTER (WHERE lower(h.t) = g.token) AS component_token_occurrences_raw_ws, count(DISTINCT h.entity_id) AS component_rows_cleaned, count(DISTINCT CASE WHEN lower(h.t) = g.token THEN h.entity_id END) AS component_rows_raw_ws,
  count(*) FILTER (WHERE kind = 'u') AS case_uppercase, count(*) FILTER (WHERE kind = 'l') AS case_lowercase, count(*) FILTER (WHERE kind = 't') AS case_titlecase, count(*) FILTER (WHERE kind = 'o') AS case_other,
  count(*) FILTER (WHERE t <> c) AS punct_surrounded, count(*) FILTER (WHERE t = c) AS whitespace_isolated
FROM grid g LEFT JOIN hit h ON g.dataset = h.dataset AND g.source = h.source AND g.token = h.token GROUP BY g.dataset, g.source, g.token"""))
def placeholder_token_summary(x: Fixture) -> DataFrame:
    return audits.placeholder_token_summary(_records(x))


@query(_with(f"""{_ADDR},
parts AS (SELECT *, CASE WHEN s <> '' AND whole IS NULL THEN string_split_regex(s, '{_WS}+') ELSE [] END AS ts FROM fl)
SELECT source, entity_id, a = '' AS is_empty, a <> '' AND s = '' AS is_blank, whole AS whole_token, s = '' OR whole IS NOT NULL AS is_missing,
  len(list_filter(ts, lambda t: lower(trim(t, {_STRIP})) IN {_TOKENS})) > 0 AS has_cleaned, len(list_filter(ts, lambda t: lower(t) IN {_TOKENS})) > 0 AS has_raw FROM parts"""))
def placeholder_row_flags(x: Fixture) -> DataFrame:
    return audits.placeholder_flags(_records(x)).select("source", "entity_id", "is_empty", "is_blank", "whole_token", "is_missing", "has_cleaned", "has_raw")


@query(f"SELECT entity_id, {_norm('business_name')} AS name, {_norm('business_address')} AS address FROM er_s2")
def normalize_names(x: Fixture) -> DataFrame:
    return x.s2.select("entity_id", text.normalise(F.col("business_name")).alias("name"), text.normalise(F.col("business_address")).alias("address"))


@query(f"SELECT doc_id, {_norm('text')} AS text FROM documents", views=False)
def normalize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", text.normalise(F.col("text")).alias("text"))


_STATUS = {"both_present": "na1 <> '' AND na2 <> ''", "s1_missing": "na1 = '' AND na2 <> ''", "s3_missing": "na1 <> '' AND na2 = ''", "both_missing": "na1 = '' AND na2 = ''"}


@query(_with(_AGREED + "\n" + " UNION ALL ".join(f"SELECT '{k}' AS metric, count(*) FILTER (WHERE {c}) AS count, count(*) FILTER (WHERE {c}) / count(*) * 100e0 AS percentage FROM flagged" for k, c in ({"total_edges": "true"} | _KINDS | {f"address_{k}": c for k, c in _STATUS.items()}).items())))
def exact_audit_summary(x: Fixture) -> DataFrame:
    return audits.exact_summary(_agreed(x))


@query(_with(_AGREED + "\nSELECT country, count(*) AS total_edges, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}, count(*) FILTER (WHERE {c}) / count(*) * 100e0 AS {k}_pct" for k, c in _KINDS.items()) + " FROM flagged GROUP BY country"))
def exact_by_country(x: Fixture) -> DataFrame:
    return audits.exact_by_country(_agreed(x))


@query(_with(_AGREED + "\nSELECT CASE WHEN m <= 5 THEN CAST(m AS VARCHAR) ELSE '6+' END AS multiplicity, count(*) AS total_edges, " + ", ".join(f"count(*) FILTER (WHERE {c}) AS {k}" for k, c in _KINDS.items()) + " FROM flagged GROUP BY 1"))
def exact_by_multiplicity(x: Fixture) -> DataFrame:
    return audits.exact_by_multiplicity(_agreed(x))


@query(_with(_AGREED + "\nSELECT s1_id AS source1_entity_id, target_id AS source3_entity_id, country, m AS multiplicity, n1 AS s1_name_raw, n2 AS s3_name_raw, a1 AS s1_address_raw, a2 AS s3_address_raw, nn1 AS normalized_name, na1 AS normalized_address FROM flagged WHERE ne AND ae ORDER BY s1_id, target_id LIMIT 50"))
def exact_examples(x: Fixture) -> DataFrame:
    return audits.exact_examples(_agreed(x))


@query(_with(_AGREED + "\nSELECT CASE " + " ".join(f"WHEN {c} THEN '{k}'" for k, c in _STATUS.items()) + " END AS address_status, count(*) AS n FROM flagged GROUP BY 1"))
def address_status(x: Fixture) -> DataFrame:
    return _agreed(x).groupBy("address_status").agg(F.count(F.lit(1)).alias("n"))


def _submission(x: Fixture) -> DataFrame:
    """Result lines with planted faults: repeated entities, ids of the own source, wrong prefixes."""
    k = F.col("k").cast("string")
    lists = edges.implode_lists(_entities(x), x.pred, "ids").join(x.s1.select(F.col("entity_id").alias("source1_entity_id"), "k"), "source1_entity_id").filter("k % 31 <> 3")
    ids = F.when(F.col("k") % 29 == 1, F.concat_ws(",", "source1_entity_id", F.concat(F.lit("X-"), k))).otherwise(F.col("ids"))
    lines = lists.select("k", F.concat_ws("\t", "source1_entity_id", ids).alias("value"))
    again = lists.filter("k % 37 = 2").select("k", F.concat_ws("\t", "source1_entity_id", F.lit("S2-1,S2-1")).alias("value"))
    return validation.parsed_lines(lines.unionByName(again).withColumnRenamed("k", "line"))


@query(_with("""base AS (SELECT e.s1_id, e.k, coalesce(l.ids, '') AS ids FROM ent e LEFT JOIN (SELECT s1_id, string_agg(target_id, ',') AS ids FROM er_pred GROUP BY s1_id) l ON e.s1_id = l.s1_id WHERE e.k % 31 <> 3),
ids AS (SELECT DISTINCT unnest(string_split(ids, ',')) AS id FROM base WHERE k % 29 <> 1 AND ids <> '' UNION SELECT s1_id FROM base WHERE k % 29 = 1 UNION SELECT 'X-' || k FROM base WHERE k % 29 = 1 UNION SELECT 'S2-1' FROM base WHERE k % 37 = 2)
SELECT 'duplicate_row' AS rule, s1_id AS offender FROM base WHERE k % 37 = 2 UNION ALL SELECT 'repeated_id', s1_id FROM base WHERE k % 37 = 2 UNION ALL SELECT 'self_match', id FROM ids WHERE id LIKE 'S1-%'
UNION ALL SELECT 'wrong_prefix', id FROM ids WHERE id LIKE 'X-%' UNION ALL SELECT 'unknown_id', id FROM ids WHERE id LIKE 'S2-%' AND id NOT IN (SELECT entity_id FROM er_s2 WHERE ok % 13 <> 0)
UNION ALL SELECT 'unknown_id', id FROM ids WHERE id LIKE 'S3-%' AND id NOT IN (SELECT entity_id FROM er_s3) UNION ALL SELECT 'missing_s1', s1_id FROM ent WHERE k % 31 = 3 AND k % 41 <> 5 UNION ALL SELECT 'unexpected_s1', s1_id FROM base WHERE k % 41 = 5"""))
def submission_findings(x: Fixture) -> DataFrame:
    required = x.s1.filter("k % 41 <> 5").select(F.col("entity_id").alias("s1_id"))
    valid = x.s2.filter("ok % 13 <> 0").select(F.col("entity_id").alias("id")).unionByName(x.s3.select(F.col("entity_id").alias("id")))
    return validation.findings(_submission(x), required, valid)


@query("SELECT CASE WHEN k % 31 = 3 THEN 'only_a' WHEN k % 41 = 5 THEN 'only_b' ELSE 'both' END AS side, s1_id AS id FROM ent WHERE NOT (k % 31 = 3 AND k % 41 = 5)")
def required_vs_seen(x: Fixture) -> DataFrame:
    ids = x.s1.select(F.col("entity_id").alias("id"), "k")
    return edges.id_set_operations(ids.filter("k % 41 <> 5"), ids.filter("k % 31 <> 3"))


@query("SELECT CASE WHEN t.target_id IS NULL THEN 'only_b' WHEN p.target_id IS NULL THEN 'only_a' ELSE 'both' END AS side, coalesce(t.target_id, p.target_id) AS id FROM (SELECT DISTINCT target_id FROM er_truth) t FULL JOIN (SELECT DISTINCT target_id FROM er_pred) p ON t.target_id = p.target_id")
def id_set_ops(x: Fixture) -> DataFrame:
    ids = lambda df: df.select(F.col("target_id").alias("id"))
    return edges.id_set_operations(ids(x.truth), ids(x.pred))


@query("SELECT bucket, count(*) AS total, array_to_string(list(s1_id ORDER BY s1_id)[1:5], ', ') AS examples FROM bucketed GROUP BY bucket")
def top_examples(x: Fixture) -> DataFrame:
    return edges.top_examples(_bucketed(x), "bucket", "s1_id")


@query(f"""SELECT s1_id, target_id, string_agg(lane, ',' ORDER BY lane) AS lanes FROM (
  SELECT a.entity_id AS s1_id, b.entity_id AS target_id, 'name' AS lane FROM er_s1 a JOIN er_s2 b ON a.country = b.country AND {_norm('a.business_name')} = {_norm('b.business_name')}
  UNION ALL SELECT a.entity_id, b.entity_id, 'sorted' FROM er_s1 a JOIN er_s2 b ON a.country = b.country AND list_sort(string_split({_norm('a.business_name')}, ' ')) = list_sort(string_split({_norm('b.business_name')}, ' '))) GROUP BY s1_id, target_id""")
def blocking_pairs(x: Fixture) -> DataFrame:
    return matching.blocking_pairs(x.s1, x.s2)


_FEATURES = "SELECT c.s1_id, c.target_id, a.business_name AS a, b.business_name AS b FROM er_cand c JOIN er_s1 a ON c.s1_id = a.entity_id JOIN er_s2 b ON c.target_id = b.entity_id"


@query(f"""SELECT s1_id, target_id, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) AS jaccard, levenshtein(na, nb) / greatest(length(na), length(nb)) AS edit_distance
FROM (SELECT *, list_distinct(string_split(na, ' ')) AS x, list_distinct(string_split(nb, ' ')) AS y FROM (SELECT s1_id, target_id, {_norm('a')} AS na, {_norm('b')} AS nb FROM ({_FEATURES})))""")
def pair_features(x: Fixture) -> DataFrame:
    name = lambda df, i, n: df.select(F.col("entity_id").alias(i), text.normalise(F.col("business_name")).alias(n))
    pairs = x.cand.join(name(x.s1, "s1_id", "a"), "s1_id").join(name(x.s2, "target_id", "b"), "target_id")
    return matching.pair_features(pairs, "a", "b").select("s1_id", "target_id", "jaccard", "edit_distance")


@query("SELECT CAST(sum(len(string_split(matched_entity_ids, ','))) AS BIGINT) AS edges FROM er_gt WHERE matched_entity_ids <> ''")
def naive_edge_count(x: Fixture) -> DataFrame:
    return edges.naive_edge_count(x.gt)


@query(f"""SELECT a.country, 'name' AS lane, a.key, a.n AS left_n, b.n AS right_n, a.n * b.n AS pairs
FROM (SELECT country, {_norm('business_name')} AS key, count(*) AS n FROM er_s1 GROUP BY 1, 2) a JOIN (SELECT country, {_norm('business_name')} AS key, count(*) AS n FROM er_s2 GROUP BY 1, 2) b ON a.country = b.country AND a.key = b.key""")
def block_sizes(x: Fixture) -> DataFrame:
    return matching.block_sizes(x.s1, x.s2, ("name",))


_NUMBERED = f"SELECT entity_id, country, array_to_string(list_sort(regexp_extract_all({_norm('business_name')}, '[0-9]+')), ' ') AS key, list_filter(string_split({_norm('business_address')}, ' '), lambda t: t <> '' AND t NOT IN {_TOKENS}) AS words"


@query(_with(f"""blocks AS (SELECT a.entity_id AS s1_id, b.entity_id AS target_id, a.words AS x, b.words AS y, count(*) OVER (PARTITION BY a.country, a.key) AS pairs
  FROM ({_NUMBERED} FROM er_s1) a JOIN ({_NUMBERED} FROM er_s2) b ON a.country = b.country AND a.key = b.key WHERE a.key <> '')
SELECT s1_id, target_id, 'numbers' AS lanes FROM blocks WHERE pairs <= 12 OR len(list_intersect(x, y)) > 0"""))
def crowded_blocks(x: Fixture) -> DataFrame:
    return matching.blocking_pairs(x.s1, x.s2, ("numbers",), most_pairs=12)


def _scored(x: Fixture) -> DataFrame:
    """Candidates with a score that follows from the pair, and whether they are true."""
    score = F.conv(F.substring(F.md5(F.concat("s1_id", "target_id").cast("binary")), 1, 4), 16, 10).cast("double") / 65536
    flag = x.truth.select("s1_id", "target_id", F.lit(True).alias("m"))
    return x.cand.join(flag, ["s1_id", "target_id"], "left").select("s1_id", "target_id", score.alias("score"), F.coalesce("m", F.lit(False)).alias("is_match"))


_SCORED = "scored AS (SELECT c.s1_id, c.target_id, CAST('0x' || substr(md5(c.s1_id || c.target_id), 1, 4) AS BIGINT) / 65536e0 AS score, t.s1_id IS NOT NULL AS is_match FROM er_cand c LEFT JOIN er_truth t ON c.s1_id = t.s1_id AND c.target_id = t.target_id)"


@query(_with(f"""{_SCORED}, steps AS (SELECT least(floor(score * 100), 99)::INTEGER AS step, count(*) FILTER (WHERE is_match) AS tp, count(*) FILTER (WHERE NOT is_match) AS fp FROM scored GROUP BY 1),
sums AS (SELECT step, sum(tp) OVER (ORDER BY step DESC) AS tp, sum(fp) OVER (ORDER BY step DESC) AS fp FROM steps)
SELECT step / 100e0 AS threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp)::DOUBLE ELSE 0e0 END AS precision, tp::DOUBLE / 5000e0 AS recall, CASE WHEN tp > 0 THEN 1.25e0 * tp::DOUBLE / (0.25e0 * 5000 + (tp + fp)::DOUBLE) ELSE 0e0 END AS f0_5 FROM sums"""))
def threshold_sweep(x: Fixture) -> DataFrame:
    return scoring.threshold_sweep(_scored(x), 5000)


@query(_with(f"""{_SCORED}, steps AS (SELECT s1_id, least(floor(score * 20), 19)::INTEGER AS step, is_match FROM scored),
grid AS (SELECT e.s1_id, t.step, coalesce(tn.n, 0) AS n FROM ent e CROSS JOIN (SELECT unnest(range(21))::INTEGER AS step) t LEFT JOIN tn ON e.s1_id = tn.s1_id),
counts AS (SELECT g.s1_id, g.step, g.n, count(s.s1_id) AS p, count(*) FILTER (WHERE s.is_match) AS tp FROM grid g LEFT JOIN steps s ON g.s1_id = s.s1_id AND s.step >= g.step GROUP BY g.s1_id, g.step, g.n)
SELECT step / 20e0 AS threshold, round(avg(CASE WHEN n = 0 AND p = 0 THEN 1e0 WHEN n = 0 OR p = 0 THEN 0e0 ELSE 1.25e0 * tp / (0.25e0 * n + p) END), 9) AS macro_f0_5 FROM counts GROUP BY step"""))
def macro_threshold_sweep(x: Fixture) -> DataFrame:
    out = scoring.macro_threshold_sweep(_entities(x), x.truth, _scored(x), 20)
    return out.withColumn("macro_f0_5", F.round("macro_f0_5", 9))


@query(_with(f"{_SCORED} SELECT arg_min(s1_id, (-score, s1_id)) AS s1_id, target_id, max(score) AS score FROM (SELECT DISTINCT s1_id, target_id, score FROM scored) GROUP BY target_id"))
def exclusive_assignment(x: Fixture) -> DataFrame:
    return matching.exclusive_assignment(_scored(x))


@query("SELECT 'unknown_s1' AS rule, min(s1_id) AS s1_id, '' AS detail FROM er_cand WHERE s1_id NOT IN (SELECT s1_id FROM ent WHERE k % 10 <> 0)")
def first_candidate_issue(x: Fixture) -> DataFrame:
    allowed = x.s1.filter("k % 10 <> 0").select(F.col("entity_id").alias("s1_id"))
    return recall.first_issue(recall.candidate_issues(x.cand, allowed, x.pred))


_TERMS = f"""docs AS (SELECT entity_id AS id, {_norm('business_name')} AS t FROM er_s1 UNION ALL SELECT entity_id, {_norm('business_name')} FROM er_s2),
terms AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(string_split(t, ' ')) AS term FROM docs) WHERE term <> '' GROUP BY id, term),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM docs))::DOUBLE / (1 + count(*))::DOUBLE) + 1 AS idf FROM terms GROUP BY term),
w AS (SELECT id, term, tf * idf AS w FROM terms JOIN idf USING (term)),
u AS (SELECT w.id, w.term, w.w / n.n AS w FROM w JOIN (SELECT id, sqrt(sum(w * w)) AS n FROM w GROUP BY id) n ON w.id = n.id)"""


@query(_with(f"""{_TERMS}
SELECT c.s1_id, c.target_id, round(coalesce(sum(a.w * b.w), 0), 9) AS cosine FROM (SELECT * FROM er_cand WHERE target_id LIKE 'S2-%') c LEFT JOIN u a ON c.s1_id = a.id LEFT JOIN u b ON c.target_id = b.id AND a.term = b.term GROUP BY c.s1_id, c.target_id"""))
def pair_tfidf_cosine(x: Fixture) -> DataFrame:
    texts = lambda df: df.select(F.col("entity_id").alias("id"), text.normalise(F.col("business_name")).alias("text"))
    out = matching.tfidf_cosine(x.cand.filter(F.col("target_id").startswith("S2-")), texts(x.s1), texts(x.s2))
    return out.withColumn("cosine", F.round("cosine", 9))
